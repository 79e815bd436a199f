"""Time columns: truncation, quadrants of the day, calendar units, exact mean time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Quadrants of the day and the hour each one starts at; NIGHT runs into the next morning.
MORNING, AFTERNOON, EVENING, NIGHT = 1, 2, 3, 4
QUADRANT_STARTS = {MORNING: 8, AFTERNOON: 12, EVENING: 16, NIGHT: 20}

ORDER_KEY_TYPE = "decimal(38,0)"
_TIE_OFFSET = 1 << 31


def _tie_range() -> Column:
    return F.lit(1 << 32).cast("decimal(10,0)")


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def trunc(unit: str, time: Column) -> Column:
    """``date_trunc`` that stays zone-free (the session zone is UTC)."""
    return F.date_trunc(unit, time).cast("timestamp_ntz")


def hours(n) -> Column:
    return F.make_dt_interval(hours=F.lit(n) if isinstance(n, int) else n)


def midnight(day: Column) -> Column:
    return day.cast("timestamp_ntz")


def noon(time: Column) -> Column:
    return trunc("DAY", time) + hours(12)


def seconds(time: Column) -> Column:
    return F.unix_seconds(time.cast("timestamp"))


def from_seconds(secs: Column) -> Column:
    return F.timestamp_seconds(secs).cast("timestamp_ntz")


def order_key(time: Column, tie: Column) -> Column:
    """Microseconds and any int in one decimal, ordered by time and then by ``tie``.

    ``max_by(value, struct(time, tie))`` would leave the hash aggregate for a sort of all input rows; a decimal is a fixed-width
    aggregate buffer and keeps it.
    """
    micros = F.unix_micros(time.cast("timestamp")).cast("decimal(19,0)")
    return (micros * _tie_range() + (tie.cast("long") + _TIE_OFFSET).cast("decimal(11,0)")).cast(ORDER_KEY_TYPE)


def _tie_part(key: Column) -> Column:
    return F.pmod(key, _tie_range())


def key_time(key: Column) -> Column:
    micros = F.call_function("div", key - _tie_part(key), _tie_range())
    return F.timestamp_micros(micros).cast("timestamp_ntz")


def key_tie(key: Column) -> Column:
    return (_tie_part(key).cast("long") - _TIE_OFFSET).cast("int")


def time_parts(time: Column) -> dict[str, Column]:
    """Summable parts of a timestamp: days, seconds of the day, microseconds of the second.

    A plain sum of microseconds overflows a long after a few thousand rows and a decimal sum is slow; these three stay exact for
    more rows than any group can hold.
    """
    micros = F.unix_micros(time.cast("timestamp"))
    day = F.unix_date(time.cast("date")).cast("long")
    return {
        "time_days": day,
        "time_seconds": seconds(time) - day * 86400,
        "time_micros": F.pmod(micros, F.lit(1_000_000)),
    }


def mean_time(days: Column, secs: Column, micros: Column, rows: Column) -> Column:
    """Mean of the summed parts, cut to the second."""
    whole = F.lit(1_000_000).cast("decimal(10,0)")
    total = (
        days.cast("decimal(20,0)") * F.lit(86400).cast("decimal(6,0)") + secs.cast("decimal(20,0)")
    ) * whole + micros.cast("decimal(20,0)")
    mean = F.floor(total / (rows.cast("decimal(20,0)") * whole))
    return from_seconds(mean.cast("long"))


def quadrant(time: Column) -> Column:
    h = F.hour(time)
    return (
        F.when((h >= QUADRANT_STARTS[MORNING]) & (h < QUADRANT_STARTS[AFTERNOON]), MORNING)
        .when((h >= QUADRANT_STARTS[AFTERNOON]) & (h < QUADRANT_STARTS[EVENING]), AFTERNOON)
        .when((h >= QUADRANT_STARTS[EVENING]) & (h < QUADRANT_STARTS[NIGHT]), EVENING)
        .otherwise(NIGHT)
    )


def window_start(time: Column) -> Column:
    """Start of the quadrant window that holds ``time``; hours before the morning belong to the night of the day before."""
    h = F.hour(time)
    offset = (
        F.when(h < QUADRANT_STARTS[MORNING], QUADRANT_STARTS[NIGHT] - 24)
        .when(h < QUADRANT_STARTS[AFTERNOON], QUADRANT_STARTS[MORNING])
        .when(h < QUADRANT_STARTS[EVENING], QUADRANT_STARTS[AFTERNOON])
        .when(h < QUADRANT_STARTS[NIGHT], QUADRANT_STARTS[EVENING])
        .otherwise(QUADRANT_STARTS[NIGHT])
    )
    return trunc("DAY", time) + hours(offset)


def window_end(start: Column) -> Column:
    """Last second of the window that begins at ``start``."""
    length = F.when(F.hour(start) == QUADRANT_STARTS[NIGHT], 12).otherwise(4)
    return start + hours(length) - F.make_dt_interval(secs=F.lit(1))


def window_midpoint(start: Column) -> Column:
    return start + hours(F.when(F.hour(start) == QUADRANT_STARTS[NIGHT], 6).otherwise(2))


def week_of_year(time: Column) -> Column:
    """Week number 0..53 with weeks that start on Sunday."""
    return F.floor((F.dayofyear(time) + 7 - F.dayofweek(time)) / 7).cast("int")
