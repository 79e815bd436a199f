"""The E8 lattice: nearest points and neighbouring cells of batches of points."""

from __future__ import annotations

import numpy as np

from gridlap.llm.common import mix


def nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with integer coordinates of even sum."""
    whole = np.rint(x)
    odd = np.flatnonzero(whole.sum(axis=1) % 2 != 0)
    if len(odd):
        rest = x[odd] - whole[odd]
        worst = np.abs(rest).argmax(axis=1)
        at = np.arange(len(odd))
        whole[odd, worst] += np.where(rest[at, worst] >= 0, 1.0, -1.0)
    return whole


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8, which is D8 and D8 moved by one half in every coordinate."""
    a, b = nearest_d8(x), nearest_d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1))[:, None], a, b)


def roots() -> np.ndarray:
    """The 240 shortest vectors, which lead from a point to the cells that touch its own across a face."""
    whole = [np.eye(8)[i] * s + np.eye(8)[j] * t for i in range(8) for j in range(i) for s in (1, -1) for t in (1, -1)]
    signs = np.array(np.meshgrid(*[[0.5, -0.5]] * 8)).reshape(8, -1).T
    return np.vstack([np.array(whole), signs[(signs < 0).sum(axis=1) % 2 == 0]])


def cells(x: np.ndarray, probes: int) -> np.ndarray:
    """(rows, 1 + probes, 8): each point's own lattice point, then the neighbours whose cells are closest to it."""
    own = nearest_e8(x)
    if not probes:
        return own[:, None, :]
    steps = roots()
    # All steps have length sqrt(2), so the closest neighbours are those most in the direction of the rest.
    toward = (x - own) @ steps.T
    best = np.argpartition(-toward, probes - 1, axis=1)[:, :probes]
    return np.concatenate([own[:, None, :], own[:, None, :] + steps[best]], axis=1)


def keys(points: np.ndarray, table: int) -> np.ndarray:
    """64-bit identifiers of lattice points of one table; twice the coordinates are integers."""
    h = np.full(points.shape[:-1], table + 1, dtype=np.uint64)
    for k in range(8):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + np.rint(points[..., k] * 2).astype(np.int64).astype(np.uint64))
    return h
