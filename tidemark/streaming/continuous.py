"""Queries that are evaluated again and again at a pace.

``new`` delivers what changed since the last delivery, and keeps it until it was read.
``full`` delivers the whole current result, which replaces the one before: a reader that is
slow sees the latest. How the whole result is kept follows from its plan: an aggregate is
state of the engine; a selection that looks at one row at a time only ever gains rows, so
each micro-batch adds its own to those delivered before; anything else is computed again
from all rows so far.

An error of the query is raised once, by the next call that reads; the call after that finds
the query running again, from its checkpoint.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.errors import InvalidArgument


def _epochs(fs, path) -> list[int]:
    """Published deliveries, oldest first."""
    if not fs.exists(path):
        return []
    names = [re.fullmatch(r"epoch=(\d+)", s.getPath().getName()) for s in fs.listStatus(path)]
    return sorted(int(name.group(1)) for name in names if name)


class ContinuousQuery:
    """Handle of a running query: ``probe``, ``results``, ``latest``, ``stop``."""

    def __init__(self, start: Callable[[], StreamingQuery], spark, folder: str, mode: str):
        self.query = start()
        self._start = start
        self._spark = spark
        self._folder = folder
        self._every = mode == "new"
        self._grows = mode == "grows"
        self._delivered = -1
        self._read: list[int] = []
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._path = path(folder)
        self._fs = self._path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _raise_failure(self) -> None:
        error = self.query.exception()
        if error is not None:
            self.query = self._start()
            raise error

    def _deliveries(self, epochs: list[int]) -> DataFrame:
        return self._spark.read.option("basePath", self._folder).parquet(*[f"{self._folder}/epoch={e}" for e in epochs])

    def latest(self) -> DataFrame | None:
        """The newest delivery, whether or not it was read before."""
        self._raise_failure()
        epochs = _epochs(self._fs, self._path)
        if not epochs:
            return None
        self._delivered = max(self._delivered, epochs[-1])
        return self._deliveries(epochs if self._grows else epochs[-1:]).drop("epoch")

    def probe(self, number: str | None = None) -> DataFrame | None:
        """What was not read yet: in full mode the newest delivery, else all of them.

        ``number`` names a column for the number of the delivery. A result can be used until
        the next one is asked for.
        """
        self._raise_failure()
        epochs = _epochs(self._fs, self._path)
        new = [e for e in epochs if e > self._delivered]
        if not new:
            return None
        if self._every:
            for epoch in self._read:
                self._fs.delete(self._path.suffix(f"/epoch={epoch}"), True)
            self._read = new
        else:
            new = epochs if self._grows else new[-1:]
        self._delivered = new[-1]
        found = self._deliveries(new)
        return found.drop("epoch") if number is None else found.withColumnRenamed("epoch", number)

    def results(self, timeout: float | None = None, poll: float = 0.1) -> DataFrame:
        """Wait for the next delivery. Ends with StopIteration after ``stop``."""
        limit = None if timeout is None else time.monotonic() + timeout
        while True:
            found = self.probe()
            if found is not None:
                return found
            if not self.query.isActive:
                self._raise_failure()
                raise StopIteration("the query was stopped")
            if limit is not None and time.monotonic() > limit:
                raise TimeoutError("no new result")
            time.sleep(poll)

    def __iter__(self):
        while True:
            try:
                yield self.results()
            except StopIteration:
                return

    def stop(self) -> None:
        self.query.stop()


def _snapshots(folder: str, mode: str):
    """foreachBatch writer: one folder per epoch, published by rename.

    ``whole`` results replace older ones, also empty ones. ``new`` parts stay until the reader
    has had them, those that ``grow`` for good; empty ones are not delivered, but for a first
    one that tells that the whole result is empty.
    """

    def write(result: DataFrame, epoch: int) -> None:
        session = result.sparkSession
        path = session.sparkContext._jvm.org.apache.hadoop.fs.Path
        staging, final = f"{folder}-staging/epoch={epoch}", path(f"{folder}/epoch={epoch}")
        fs = final.getFileSystem(session.sparkContext._jsc.hadoopConfiguration())
        result.write.mode("overwrite").parquet(staging)
        kept = mode == "whole" or (mode == "grows" and not _epochs(fs, path(folder)))
        if not kept and session.read.schema(result.schema).parquet(staging).isEmpty():
            fs.delete(path(staging), True)
            return
        fs.mkdirs(path(folder))
        fs.delete(final, True)
        fs.rename(path(staging), final)
        if mode == "whole":
            # Keep the one before, a reader may be using it.
            for old in _epochs(fs, path(folder))[:-2]:
                fs.delete(path(f"{folder}/epoch={old}"), True)

    return write


# Plan nodes that make a row of one row, or pass rows on, and those that gather rows.
_ROW_BY_ROW = {
    "Project", "Filter", "Union", "SubqueryAlias", "StreamingRelation", "StreamingRelationV2", "StreamingExecutionRelation",
    "EventTimeWatermark", "Generate",
}


def _kept_as(result: DataFrame) -> str:
    """How the whole result of a stream is kept: ``aggregate``, ``grows`` or ``again``."""
    nodes, todo = set(), [result._jdf.queryExecution().analyzed()]
    while todo:
        node = todo.pop()
        nodes.add(node.getClass().getSimpleName())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    if "Aggregate" in nodes:
        return "aggregate"
    return "grows" if nodes <= _ROW_BY_ROW else "again"


def continuous(
    stream: DataFrame,
    fn: Callable[[DataFrame], DataFrame],
    *,
    mode: str,
    folder: str,
    pace: str | None = None,
    available_now: bool = False,
) -> ContinuousQuery:
    """Start ``fn(stream)`` as a continuous query; state and results live in ``folder``.

    A wrong ``fn`` is an error here and now. A result that is neither an aggregate nor made
    row by row is computed from all rows so far, which are kept in ``folder``: its cost grows
    with them.
    """
    if mode not in ("full", "new"):
        raise InvalidArgument(f"the mode is 'full' or 'new', not {mode!r}")
    spark = stream.sparkSession
    out = f"{folder}/results"
    result = fn(stream)
    kept = "new" if mode == "new" else _kept_as(result)

    def start(df: DataFrame, output: str, write) -> Callable[[], StreamingQuery]:
        def run() -> StreamingQuery:
            writer = (
                df.writeStream.outputMode(output)
                .option("checkpointLocation", f"{folder}/checkpoint-{output}")
                .foreachBatch(write)
            )
            if available_now:
                writer = writer.trigger(availableNow=True)
            elif pace is not None:
                writer = writer.trigger(processingTime=pace)
            return writer.start()

        return run

    if kept == "new":
        return ContinuousQuery(start(result, "update", _snapshots(out, "new")), spark, out, "new")
    if kept == "aggregate":
        return ContinuousQuery(start(result, "complete", _snapshots(out, "whole")), spark, out, "whole")
    if kept == "grows":
        return ContinuousQuery(start(result, "append", _snapshots(out, "grows")), spark, out, "grows")
    rows, snapshot = f"{folder}/rows", _snapshots(out, "whole")

    def again(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{rows}/epoch={epoch}")
        so_far = batch.sparkSession.read.schema(batch.schema).parquet(rows)
        snapshot(fn(so_far), epoch)

    return ContinuousQuery(start(stream, "append", again), spark, out, "whole")
