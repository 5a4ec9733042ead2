"""Change feed: files arriving in a folder, applied to a stored target batch by batch.

Late and repeated changes are settled by the version column, which deleted items keep too. A batch replayed
after a failure gives the same table, so no batch numbers are kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from nestloom.sources.keyed import KeyedTable


def file_feed(
    spark: SparkSession, folder: str, schema: str, files_per_batch: int = 1000, pattern: str | None = None
) -> DataFrame:
    """Parquet files of a folder as a stream, each taken once, in batches of bounded size."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(folder)


def apply_feed(
    store: KeyedTable,
    feed: DataFrame,
    checkpoint: str,
    version: str,
    op: str | None = None,
    to_changes: Callable[[DataFrame], DataFrame] | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the feed; with ``available_now`` it stops after taking what is there. One feed per table at a time."""

    def take(batch: DataFrame, number: int) -> None:
        store.upsert(batch if to_changes is None else to_changes(batch), version, op)

    writer = feed.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
