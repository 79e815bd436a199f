"""Structured Streaming wiring: queue messages in, stored tables out."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.pipeline import Controls, process_batch
from ..session import configure, stage, staging_scope
from ..sources.messages import parse_envelopes
from .fence import open_writer
from .store import Store


def message_files(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Messages dropped as text files, one JSON message per line. For a broker, pass its stream of ``value`` columns instead."""
    return spark.readStream.schema("value string").option("maxFilesPerTrigger", max_files).text(path)


def start_ingest(
    messages: DataFrame,
    store: Store,
    controls: Callable[[], Controls],
    checkpoint: str,
    available_now: bool = False,
    frontend: bool = True,
    rollups: bool = True,
) -> StreamingQuery:
    """Run every micro-batch of ``messages`` (column ``value``) through the pipeline.

    A message counts as read only once its batch is written: the offsets are committed after ``foreachBatch`` returns, and a
    batch that is delivered again replaces its own rows. ``controls`` is called per batch, so that new laps and cycles are seen. The
    store numbers the batches, so a stream with a fresh checkpoint goes on behind the earlier ones, and a start shuts out whoever wrote before.
    Without ``rollups`` the stream ends at cells and triggers (see :mod:`gridlap.streaming.triggered`).
    """
    writer = open_writer(store.spark, store.root, checkpoint, "ingest")

    def run(batch: DataFrame, batch_id: int) -> None:
        # The batch is written out once; all further work runs in the store's session, with adaptive execution.
        with staging_scope(f"stream-{hashlib.sha256(store.root.encode()).hexdigest()[:16]}"):
            envelopes = stage(parse_envelopes(batch), "envelopes", configure(store.spark))
            process_batch(store, envelopes, controls(), writer.number(batch_id), frontend, rollups)

    stream = messages.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (stream.trigger(availableNow=True) if available_now else stream).start()
