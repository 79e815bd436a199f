from __future__ import annotations

import numpy as np

from gridlap.llm import embedding_dups as ed
from gridlap.llm import lattice

SCHEMA = "vec_id long, embedding array<float>, label int, id int"


def turned(rng, v, cosine):
    """A unit vector at this cosine from a unit vector."""
    n = rng.standard_normal(len(v))
    n -= (n @ v) * v
    return cosine * v + np.sqrt(1 - cosine**2) * n / np.linalg.norm(n)


def test_same_as_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((300, 64))
    base /= np.linalg.norm(base, axis=1)[:, None]
    vectors = list(base) + [turned(rng, base[k % 40], c) for k, c in enumerate(rng.uniform(0.85, 1.0, 200))]
    vectors += [vectors[0] * 3, vectors[0]]
    stored = [[float(np.float32(x)) for x in v] for v in vectors]
    odd = [None, [], [0.0] * 64, [float("nan")] * 64, [float("inf")] + [1.0] * 63, [None] + [1.0] * 63, [1.0, 2.0], [1.0, 2.0]]
    rows = [(k, v, 0, 5) for k, v in enumerate(stored + odd)]
    found = {r.vec_id: r for r in ed.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    block = np.array(stored)
    block /= np.linalg.norm(block, axis=1)[:, None]
    near = block @ block.T >= 0.9
    degree = near.sum(axis=1) - 1
    assert [found[k].n_links for k in range(len(stored))] == degree.tolist()
    root = np.arange(len(stored))
    for _ in range(len(stored)):
        root = np.where(near, root[None, :], len(stored)).min(axis=1)
    assert [found[k].component_id for k in range(len(stored))] == root.tolist()
    first_odd = len(stored)
    assert [found[k].n_links for k in range(first_odd, first_odd + 8)] == [0, 0, 0, 0, 0, 0, 1, 1]
    assert found[first_odd + 7].component_id == first_odd + 6 and not found[first_odd + 7].kept and found[first_odd].kept


def test_repeated_rows_and_empty_table(spark):
    v = [1.0, 0.5, 0.0]
    rows = ed.near_duplicates(spark.createDataFrame([(3, v, 1, 1), (3, v, 1, 1), (9, v, 2, 1), (None, v, 2, 1)], SCHEMA)).collect()
    assert sorted((r.vec_id or -1, r.component_id or -1, r.n_links) for r in rows) == [(-1, -1, 0), (3, 3, 1), (3, 3, 1), (9, 3, 1)]
    assert ed.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_recall_at_the_threshold():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((2000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = np.array([turned(rng, v, 0.9) for v in a])
    met = (ed.cell_keys(a, 0.9)[:, :, None] == ed.cell_keys(b, 0.9)[:, None, :]).any(axis=(1, 2))
    assert met.mean() >= 0.98


def test_nearest_lattice_point():
    rng = np.random.default_rng(3)
    x = rng.uniform(-2, 2, (200, 8))
    own, steps = lattice.nearest_e8(x), lattice.roots()
    assert len(steps) == 240 and np.allclose((steps**2).sum(axis=1), 2)
    doubled = np.rint(own * 2).astype(int)
    assert ((doubled % 2).min(axis=1) == (doubled % 2).max(axis=1)).all() and (own.sum(axis=1) % 2 == 0).all()
    assert (((x - own) ** 2).sum(axis=1) <= ((x[:, None, :] - own[:, None, :] - steps[None]) ** 2).sum(axis=2).min(axis=1) + 1e-9).all()
