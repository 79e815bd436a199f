"""Insert-or-update of keyed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(existing: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """``existing`` with the rows of ``new`` put in; a key present in both takes the new row.

    ``new`` holds one row per key, as every roll-up does. Only the keys of ``new`` travel to the existing rows.
    """
    kept = existing.join(new.select(*key), key, "left_anti")
    return kept.select(*existing.columns).unionByName(new.select(*existing.columns))


def upsert_newest(existing: DataFrame, new: DataFrame, key: list[str], time: str = "time") -> DataFrame:
    """Like :func:`upsert`, but a row never gives way to an older one; of rows with one time the new one stays."""
    ranked = existing.withColumn("_new", F.lit(0)).unionByName(new.select(*existing.columns).withColumn("_new", F.lit(1)))
    rest = [c for c in existing.columns if c not in key]
    newest = ranked.groupBy(*key).agg(F.max(F.struct(time, "_new", *[c for c in rest if c != time])).alias("r"))
    return newest.select(*key, *[f"r.{c}" for c in rest]).select(*existing.columns)
