"""Session settings and the shared staging folder."""

from __future__ import annotations

import tempfile
import uuid
from collections import Counter
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from threading import Lock
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

# Timestamps are zone-free; date_trunc and the epoch functions go through the session zone, so it is pinned.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every operator relies on; sizes such as the number of shuffle partitions stay the caller's."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("gridlap")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


_own_folders: dict[str, str] = {}


def staging_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary folder stands in only where the master is this machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _own_folders:  # the setting belongs to the running context and cannot be given to it now
        _own_folders[app] = tempfile.mkdtemp(prefix="gridlap-stage-")
    return _own_folders[app]


_counting = Lock()
_scope: ContextVar[tuple[str, Counter] | None] = ContextVar("gridlap_stage", default=None)


@contextmanager
def staging_scope(name: str):
    """Staged frames inside this block go to a folder of their own, and a later block of the same name writes over them.

    A stream that stages for every batch thus keeps the space of one batch.
    """
    token = _scope.set((name, Counter()))
    try:
        yield
    finally:
        _scope.reset(token)


def stage(df: DataFrame, name: str, spark: SparkSession | None = None) -> DataFrame:
    """Write a frame that several branches read to the shared folder and read it back (with ``spark``, if given).

    The lineage is cut at files that outlive any executor, the branches scan columnar data with pruning, and the planner gets
    the real size of the result.
    """
    spark = spark or df.sparkSession
    scope = _scope.get()
    if scope is None:
        folder = f"{name}-{uuid.uuid4().hex}"
    else:
        with _counting:  # jobs that run side by side share the scope
            scope[1][name] += 1
            folder = f"{scope[0]}/{name}-{scope[1][name]}"
    path = f"{staging_dir(spark).rstrip('/')}/gridlap/{folder}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def side_by_side(*tasks: Callable[[], T]) -> list[T]:
    """Run independent jobs at the same time and return their results; the first error is raised."""
    with ThreadPoolExecutor(len(tasks)) as pool:
        return [done.result() for done in [pool.submit(copy_context().run, task) for task in tasks]]
