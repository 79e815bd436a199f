"""Streams over the stored triggers, each with its own checkpoint, so that roll-ups and display rows run at their own pace."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans.pipeline import Controls
from ..plans.triggered import run_events, run_frontend
from ..schemas import STORED_DDL
from ..session import configure, stage, staging_scope
from .fence import Files, open_writer
from .store import Store


def trigger_rows(store: Store, table: str, max_files: int = 200) -> DataFrame:
    """Rows of a trigger table as they are written, with the batch that raised them.

    A batch that is written again replaces its files; they arrive once more, and the jobs may run again.
    """
    Files(store.spark).make_folder(store.path(table))
    reader = store.spark.readStream.schema(f"{STORED_DDL[table]}, batch_id bigint").option("maxFilesPerTrigger", max_files)
    return reader.option("ignoreMissingFiles", "true").parquet(store.path(table))


def _start(rows: DataFrame, store: Store, work: Callable, controls: Callable[[], Controls], checkpoint: str, role: str, available_now: bool) -> StreamingQuery:
    writer = open_writer(store.spark, store.root, checkpoint, role)

    def run(batch: DataFrame, batch_id: int) -> None:
        with staging_scope(f"{role}-{hashlib.sha256(store.root.encode()).hexdigest()[:16]}"):
            work(store, controls(), stage(batch, f"{role}-rows", configure(store.spark)), writer.number(batch_id))

    stream = rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (stream.trigger(availableNow=True) if available_now else stream).start()


def start_events(store: Store, controls: Callable[[], Controls], checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Roll-ups by the triggers of measured and derived observables."""
    rows = trigger_rows(store, "triggers").unionByName(trigger_rows(store, "derived_triggers"))
    return _start(rows, store, run_events, controls, checkpoint, "events", available_now)


def start_frontend(store: Store, controls: Callable[[], Controls], checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Display rows by the triggers that finished roll-ups leave behind."""
    return _start(trigger_rows(store, "frontend_triggers"), store, run_frontend, controls, checkpoint, "frontend", available_now)
