"""Incremental ingest: each run loads the export files that arrived since the last one."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from palaver.plans.ingest import ingest
from palaver.sources.exports import stream_exports
from palaver.sources.store import Store


def _utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query, which its checkpoint holds from before the first batch on."""
    metadata = spark.read.text(f"{checkpoint.rstrip('/')}/metadata")
    return metadata.select(F.get_json_object("value", "$.id")).first()[0]


def incremental_ingest(
    spark: SparkSession,
    exports_path: str,
    store: Store,
    checkpoint: str,
    clock: Callable[[], datetime] = _utc_now,
    max_files: int | None = None,
) -> StreamingQuery:
    """Start a run over the new files; it ends by itself (``awaitTermination``).

    The stream carries no state and needs no watermark: a late or edited message meets its
    stored row in the keyed merge. A load id names the stream and the batch. The stream's name is the
    id that Spark draws for a new checkpoint and keeps in it: a repeated batch carries the same
    load id, which the store's ledger knows, while two streams, or a checkpoint that was deleted and
    made again at the same path, never share one.
    """

    def load(documents: DataFrame, batch_id: int) -> None:
        ingest(documents, store, clock(), f"stream-{_stream_id(spark, checkpoint)}-{batch_id:012d}")

    return (
        stream_exports(spark, exports_path, max_files)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
