"""Replay of a log of operations on floating point values, one operation after the other.

Sums of floating point numbers depend on the order of addition, so a log that adds to such
values is folded in order, each segment between two resets by itself. A segment longer than
the limit is folded in rounds, each of which takes a bounded number of its rows and hands
its end state to the next. ``oplog`` replays all other logs without this.
"""

from __future__ import annotations

import operator
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.time import floor_div
from tidemark.operators.running import GROUP_ROWS, group_position, prefix_scan
from tidemark.session import checked_broadcast, checkpoint, scratch_path

# The fold travels to the workers with the job; they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RESETS = ("update", "remove", "get_and_remove")
KEPT = ("key", "seg", "seq", "op", "comparand")
ABSENT = object()


def step(state, op: str, value, comparand):
    """State of one key after one operation."""
    if op == "update":
        return value
    if op in ("remove", "get_and_remove"):
        return ABSENT
    if state is ABSENT:
        return value if op == "put" else ABSENT
    if op == "add":
        total = operator.add(state, value)
        if isinstance(total, int) and not -(2**63) <= total < 2**63:
            raise OverflowError(f"{state} + {value} leaves the range of int64")
        return total
    if op == "get_and_update" or (op == "cas" and state == comparand):
        return value
    if op == "remove_if" and state == comparand:
        return ABSENT
    if op in ("get", "put", "cas", "remove_if"):
        return state
    raise ValueError(f"unknown operation {op!r}")


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fold sorted rows; only the state of the current segment is held."""
    current, state = None, ABSENT
    for batch in batches:
        rows = batch.to_pydict()
        before, after = [], []
        for key, seg, op, value, comparand, start, known in zip(
            rows["key"], rows["seg"], rows["op"], rows["value"], rows["comparand"],
            rows["start_value"], rows["start_present"], strict=True,
        ):
            if (key, seg) != current:
                current, state = (key, seg), start if known else ABSENT
            before.append(state)
            state = step(state, op, value, comparand)
            after.append(state)
        columns = [batch.column(n) for n in KEPT]
        kind = batch.schema.field("value").type
        for states in (before, after):
            present = [s is not ABSENT for s in states]
            columns.append(pa.array([s if p else None for s, p in zip(states, present, strict=True)], kind))
            columns.append(pa.array(present, pa.bool_()))
        yield pa.RecordBatch.from_arrays(
            columns,
            [*KEPT, "before_value", "before_present", "after_value", "after_present"],
        )


def _folded(rows: DataFrame) -> DataFrame:
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    out = T.StructType(
        [T.StructField(n, kinds[n]) for n in KEPT]
        + [
            T.StructField("before_value", kinds["value"]), T.StructField("before_present", T.BooleanType()),
            T.StructField("after_value", kinds["value"]), T.StructField("after_present", T.BooleanType()),
        ]
    )
    return rows.repartition("key", "seg").sortWithinPartitions("key", "seg", "seq").mapInArrow(_fold, out)


def _last(by: list[str], folded: DataFrame) -> DataFrame:
    """State after the last operation of each group."""
    state = F.struct(F.col("after_value").alias("value"), F.col("after_present").alias("present"))
    return folded.groupBy(*by).agg(F.max_by(state, "seq").alias("_s")).select(*by, "_s.value", "_s.present")


def replay(kv: DataFrame, oplog: DataFrame, limit: int = GROUP_ROWS) -> tuple[DataFrame, DataFrame]:
    """Apply the log to ``kv (key, value)``; returns the new state and one result per operation."""
    known = checked_broadcast(
        kv.select("key", F.col("value").alias("start_value"), F.lit(True).alias("start_present"))
    )
    is_reset = F.col("op").isin(*RESETS)
    staged = prefix_scan(
        oplog.select("key", "seq", "op", "value", "comparand"),
        ["key"], "seq", sums={"seg": is_reset.cast("long")}, limit=limit,
    )
    longest = staged.groupBy("key", "seg").count().agg(F.max("count")).first()[0] or 0
    if longest <= limit:
        started = staged.join(known, "key", "left")
        folded = checkpoint(_folded(_begin(started)))
    else:
        folded = _in_rounds(staged, known, limit)
    return _state(kv, folded), _results(known, folded)


def _begin(rows: DataFrame) -> DataFrame:
    """Only the first segment of a key begins with the stored value."""
    first = F.col("seg") == 0
    return rows.withColumns(
        {
            "start_value": F.when(first, F.col("start_value")),
            "start_present": first & F.coalesce("start_present", F.lit(False)),
        }
    )


def _in_rounds(staged: DataFrame, known: DataFrame, limit: int) -> DataFrame:
    """Each round takes the next ``limit`` rows of every segment."""
    spark = staged.sparkSession
    source, target = scratch_path(spark, "oplog"), scratch_path(spark, "folded")
    numbered = group_position(staged, ["key", "seg"], "seq", "_pos", limit)
    chunked = numbered.withColumn("_chunk", floor_div(F.col("_pos") - 1, limit)).drop("_pos")
    chunked.write.partitionBy("_chunk").parquet(source)
    rows = spark.read.parquet(source)
    carried: DataFrame | None = None
    # The number of rounds is the length of the longest segment over the limit.
    for (chunk,) in rows.select("_chunk").distinct().orderBy("_chunk").toLocalIterator():
        part = rows.where(F.col("_chunk") == chunk).drop("_chunk")
        started = _begin(part.join(known, "key", "left"))
        if carried is not None:
            side = carried.select(
                "key", "seg", F.col("value").alias("_value"), F.col("present").alias("_present")
            )
            going = F.col("_present").isNotNull()
            started = started.join(side, ["key", "seg"], "left").withColumns(
                {
                    "start_value": F.when(going, F.col("_value")).otherwise(F.col("start_value")),
                    "start_present": F.coalesce("_present", "start_present"),
                }
            ).drop("_value", "_present")
        _folded(started).write.parquet(f"{target}/round={chunk}")
        done = spark.read.parquet(f"{target}/round={chunk}")
        # Only segments with a full round can go on.
        full = part.groupBy("key", "seg").count().where(F.col("count") >= limit).select("key", "seg")
        carried = checkpoint(_last(["key", "seg"], done).join(full, ["key", "seg"], "left_semi"))
    return spark.read.parquet(target).drop("round")


def _state(kv: DataFrame, folded: DataFrame) -> DataFrame:
    """Stored values that no operation touched, and the last state of the others."""
    ends = _last(["key"], folded)
    kept = kv.select("key", "value").join(ends.select("key"), "key", "left_anti")
    return kept.unionByName(ends.where("present").select("key", "value"))


def _results(known: DataFrame, folded: DataFrame) -> DataFrame:
    """What each operation returns; a reset looks up the end of the segment before it."""
    ends = _last(["key", "seg"], folded).select(
        "key", (F.col("seg") + 1).alias("seg"), F.col("value").alias("_end"), F.col("present").alias("_ended")
    )
    joined = folded.join(ends, ["key", "seg"], "left").join(known, "key", "left")
    reset, first = F.col("op").isin(*RESETS), F.col("seg") == 1
    start = lambda c: F.when(first, F.col(c))
    ended = F.col("_ended").isNotNull()
    value: Column = F.when(
        reset, F.when(ended, F.col("_end")).otherwise(start("start_value"))
    ).otherwise(F.col("before_value"))
    present = F.coalesce(
        F.when(reset, F.when(ended, F.col("_ended")).otherwise(start("start_present"))).otherwise(
            F.col("before_present")
        ),
        F.lit(False),
    )
    staged = joined.withColumns({"_before": value, "_present": present})
    op, before, there = F.col("op"), F.col("_before"), F.col("_present")
    matched = there & (before == F.col("comparand"))
    ok = (
        F.when(op == "update", True).when(op == "put", ~there)
        .when(op == "remove_if", there & ~F.col("after_present"))
        .when(op == "cas", F.coalesce(matched, F.lit(False)))
        .otherwise(there)
    )
    result = (
        F.when(op.isin("get", "get_and_update", "get_and_remove"), before)
        .when(op == "add", F.col("after_value"))
        .when((op == "cas") & ~F.coalesce(matched, F.lit(False)), before)
    )
    return staged.select("key", "seq", "op", ok.alias("ok"), result.alias("result"))
