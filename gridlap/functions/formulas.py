"""Derived observables: inputs and formulas, and the registry that holds them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

Formula = Callable[[dict[str, Column]], Column]


@dataclass(frozen=True)
class DerivedObservable:
    name: str
    inputs: tuple[str, ...]
    formula: Formula


_REGISTRY: dict[str, DerivedObservable] = {}


def register_derived(name: str, inputs: list[str], formula: Formula) -> DerivedObservable:
    """Add a derived observable; ``formula`` maps the input columns by name to a Column."""
    if not inputs:
        raise ValueError(f"derived observable {name!r} needs at least one input")
    if name in inputs:
        raise ValueError(f"derived observable {name!r} cannot be its own input")
    _REGISTRY[name] = DerivedObservable(name, tuple(inputs), formula)
    return _REGISTRY[name]


def derived(name: str) -> DerivedObservable:
    if name not in _REGISTRY:
        raise KeyError(f"unknown derived observable {name!r}; known: {sorted(_REGISTRY)}")
    return _REGISTRY[name]


def derived_names() -> list[str]:
    return list(_REGISTRY)


def derived_order() -> list[str]:
    """Derived observables so that each comes after those among its inputs."""
    order: list[str] = []
    waiting = list(_REGISTRY)
    while waiting:
        ready = [n for n in waiting if not set(_REGISTRY[n].inputs) & set(waiting)]
        if not ready:
            raise ValueError(f"derived observables need each other: {sorted(waiting)}")
        order += ready
        waiting = [n for n in waiting if n not in ready]
    return order


def derived_from(observable: str) -> list[str]:
    """Names of the derived observables that take ``observable`` as an input."""
    return [d.name for d in _REGISTRY.values() if observable in d.inputs]


def derived_from_all(observable: str) -> list[str]:
    """Names of the derived observables that ``observable`` is needed for, directly or through others."""
    found: list[str] = []
    for name in derived_order():
        if {observable, *found} & set(_REGISTRY[name].inputs):
            found.append(name)
    return found


def digestion_index(c: dict[str, Column]) -> Column:
    good, bad = c["good_droppings"], c["bad_droppings"]
    return F.try_divide(good, bad + good) * 100


def effective_temperature(c: dict[str, Column]) -> Column:
    # Coefficients of the formula.
    t, h, a = c["temperature"], c["humidity"], c["airspeed"]
    wet_bulb = (
        t * F.atan(0.1515977 * F.sqrt(h + 8.31659))
        + F.atan(t + h)
        - F.atan(h - 1.676331)
        + 0.00391838 * F.pow(h, F.lit(1.5)) * F.atan(0.023101 * h)
        - 4.686035
    )
    wind_chill = 0.15 * (41 - t) * (F.exp(a) - F.exp(F.lit(0.2)))
    return 0.94 * t + 0.25 * wet_bulb + 0.7 - wind_chill


def humidex(c: dict[str, Column]) -> Column:
    # Coefficients of the formula; the tenth power is applied to the quotient.
    t, h = c["temperature"], c["humidity"]
    vapour = 6.112 * F.pow(F.try_divide(7.5 * t, 237.7 + t), F.lit(10.0)) * (h / 100.0)
    return t + (vapour - 10) * (5.0 / 9.0)


def heat_stress_index(c: dict[str, Column]) -> Column:
    return c["temperature"] + c["humidity"]


register_derived("humidex", ["temperature", "humidity"], humidex)
register_derived("heat_stress_index", ["temperature", "humidity"], heat_stress_index)
register_derived("effective_temperature", ["temperature", "humidity", "airspeed"], effective_temperature)
register_derived("digestion_index", ["good_droppings", "bad_droppings"], digestion_index)
