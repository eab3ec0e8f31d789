"""Buffered writes: each micro-batch is pushed as one idempotent commit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def ingest(
    stream: DataFrame,
    group,
    table: str,
    *,
    checkpoint: str,
    name: str,
    pace: str = "10 seconds",
    available_now: bool = False,
    **push_options,
) -> StreamingQuery:
    """Push a stream into a stored table.

    The batch id is made of ``name`` and the epoch, so a batch that is repeated after a
    failure does not add its rows twice. ``push_options`` as for ``TableGroup.push``.
    """

    def on_batch(batch: DataFrame, epoch: int) -> None:
        if not batch.isEmpty():
            group.push({table: batch}, batch_id=f"{name}-{epoch}", **push_options)

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(on_batch)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=pace)
    return writer.start()
