"""Follow a table: every transaction in the change log delivers its rows once.

Which log lines were delivered is state of the stream: a state store keyed by the line (log
time, transaction, table), dealt over the shuffle partitions and kept with the checkpoint.
A micro-batch reads and writes the keys of its own lines only, however many epochs there
were, and a line may be as late as it likes. State and delivery advance together: an epoch
that is repeated after a failure finds the same lines as before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.ranges import replay
from tidemark.session import checkpoint as save

LINE = ["log_ts", "transaction_id", "table"]


def unseen(lines: DataFrame) -> DataFrame:
    """The lines of a streamed change log, each once. There is no watermark, so none is too late."""
    return lines.dropDuplicates(LINE)


def needed_ranges(spans: DataFrame) -> DataFrame:
    """Time ranges (begin, end) of the spans, ends excluded and rounded up to a second."""
    return spans.select("begin", (F.col("end") + F.expr("INTERVAL '1' SECOND")).alias("end")).distinct()


def follow(
    log: DataFrame,
    rows: Callable[[DataFrame], DataFrame],
    deliver: Callable[[DataFrame, int], None],
    *,
    checkpoint: str,
    table: str | None = None,
    pace: str = "100 milliseconds",
    available_now: bool = False,
    lines: Callable[[DataFrame], DataFrame] | None = None,
    **replay_options,
) -> StreamingQuery:
    """Stream a change log, look up each new transaction's rows and deliver them.

    ``rows`` is called per micro-batch with the time ranges it needs (begin, end), and gives
    the current table or at least those parts of it. ``deliver`` gets the rows with log time
    and transaction id, and the epoch, which stays the same when a batch is repeated after a
    failure. The checkpoint is the resume point and holds the lines delivered so far. If
    ``log`` holds something else, each row of which stands for lines of its own, ``lines``
    turns a micro-batch of it into log lines.
    """
    if lines is None:
        log = unseen(log if table is None else log.where(F.col("table") == table))

    def on_batch(batch: DataFrame, epoch: int) -> None:
        spans = save(batch if lines is None else lines(batch))
        if lines is not None and table is not None:
            spans = spans.where(F.col("table") == table)
        if not spans.isEmpty():
            deliver(replay(spans, rows(needed_ranges(spans)), **replay_options), epoch)

    writer = log.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=pace)
    return writer.foreachBatch(on_batch).start()


def to_folder(folder: str) -> Callable[[DataFrame, int], None]:
    """A delivery that writes Parquet below ``folder``; repeating an epoch overwrites it."""

    def write(df: DataFrame, epoch: int) -> None:
        df.write.mode("overwrite").parquet(f"{folder}/epoch={epoch}")

    return write


def subscribe(group, table: str, deliver, *, checkpoint: str, **options) -> StreamingQuery:
    """Follow one table of a ``TableGroup``; each of its commits is one row of the stream, and new once."""
    group.schema(table)
    current = lambda ranges: group.read([table], ranges=ranges)
    return follow(
        group.commit_stream().dropDuplicates(["number", "version"]), current, deliver, checkpoint=checkpoint, table=table, lines=group.changes_of, **options
    )

