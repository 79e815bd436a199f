"""The packed key of time and tie: no limit on the tie, microseconds kept, and no sort of the input."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from gridlap.functions import timeparts as tp
from gridlap.operators.marks import first_rows, last_rows

CELLS = "round_id string, observable_name string, round_number int, day_of_production int, time timestamp_ntz"


def test_large_ties_and_fractions(spark):
    late, earlier = datetime(2024, 1, 1, 10, 0, 0, 7), datetime(2024, 1, 1, 10, 0, 0, 6)
    rows = [("a", "t", 9_000_000, -5, late), ("a", "t", 2**31 - 1, 3, earlier), ("b", "t", -(2**31), 1, datetime(1969, 12, 31, 23, 59, 59, 1))]
    cells = spark.createDataFrame(rows, CELLS)
    last = {r.round_id: r for r in last_rows(cells).collect()}
    first = {r.round_id: r for r in first_rows(cells).collect()}
    assert (last["a"].last_round_number, last["a"].last_day) == (9_000_000, -5)
    assert (first["a"].first_round_number, first["a"].first_day) == (2**31 - 1, 3)
    assert last["b"].last_round_number == -(2**31)
    key = tp.order_key(F.col("time"), F.col("round_number"))
    back = cells.select("time", tp.key_time(key).alias("t"), "round_number", tp.key_tie(key).alias("n")).collect()
    assert all(r.time == r.t and r.round_number == r.n for r in back)


def test_stays_in_the_hash_aggregate(spark):
    cells = spark.createDataFrame([], CELLS)
    plan = last_rows(cells)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
