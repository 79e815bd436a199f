"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlap.llm.common import new_folder, remove_folder


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b); the component is the smallest id that links reach.

    A large-star step hangs the larger neighbours of every id on its smallest neighbour, a small-star step does the same with the
    smaller ones; both keep what is connected, and the number of rounds grows with the logarithm of the longest path. Each round is a
    table in the shared folder, of which only the last is kept. Null ids and links of an id with itself are left out.
    """
    spark = links.sparkSession
    edges = links.where("a IS NOT NULL AND b IS NOT NULL AND a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    before, old_path = None, None
    while True:
        path = new_folder(spark, "components")
        edges.distinct().write.parquet(path)
        edges = spark.read.schema("a long, b long").parquet(path)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()  # one row
        if old_path:
            remove_folder(spark, old_path)
        if now == before:
            return edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component")).union(
                edges.select("b", F.col("b").alias("component")).distinct()
            )
        before, old_path = now, path
        edges = _small_star(_large_star(edges))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    return edges.join(least, "a").where("b != low").select("b", "low").union(least).toDF("a", "b")
