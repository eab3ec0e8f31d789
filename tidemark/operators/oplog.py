"""Replay of an ordered log of key-value operations.

Log: ``(key, seq, op, value, comparand)``, ``seq`` an integer unique per key, of at
most 2 ** 62 either way. Operations: get, put, update, remove, remove_if, cas, add, get_and_update,
get_and_remove.

No operation is applied after another. Additions shift whatever is there, so values and
comparands are taken less the sum of additions so far; then only *writes* change a state, and
what a write leaves behind does not depend on what was there before. ``update``, ``remove``
and ``get_and_remove`` always write. ``put`` writes where nothing is, ``get_and_update`` where
something is, ``cas`` and ``remove_if`` where the value equals the comparand. So each write
has one successor: the first later operation that its state lets write. Successors are found
by running values, per key and per (key, value). The writes that happen are those reached
from the beginning of a segment, a reset or the stored value; they are marked by pointer
doubling, in as many rounds as the longest chain of writes has binary digits. The state
before any operation is that of the last write before it, plus what was added since.

Null values are equal to each other. Logs that add to floating point values are folded in
order instead (``oplog_fold``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import oplog_fold
from tidemark.operators.running import GROUP_ROWS, prefix_scan
from tidemark.session import checkpoint

RESETS = oplog_fold.RESETS
WRITES = ("put", "cas", "remove_if", "get_and_update")
OPERATIONS = (*RESETS, *WRITES, "get", "add")


def replay(kv: DataFrame, oplog: DataFrame, limit: int = GROUP_ROWS) -> tuple[DataFrame, DataFrame]:
    """Apply the log to ``kv (key, value)``; returns the new state and one result per operation."""
    log = oplog.select("key", "seq", "op", "value", "comparand")
    kind = log.schema["value"].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)) and not log.where("op = 'add'").isEmpty():
        return oplog_fold.replay(kv, oplog, limit)
    staged = _staged(log, kind, limit)
    begun = _begun(kv, staged)
    marked = _marked(_successors(staged, begun, limit))
    played = checkpoint(_played(staged, begun, marked, kind, limit))
    return _state(kv, played), _results(played)


def _same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Null-safe equality; the right side's columns have a ``_`` before their name."""
    same = F.lit(True)
    for name in names:
        same = same & left[name].eqNullSafe(right[f"_{name}"])
    return same


def _adds(kind: T.DataType) -> bool:
    return isinstance(kind, (T.IntegralType, T.DecimalType))


def _staged(log: DataFrame, kind: T.DataType, limit: int) -> DataFrame:
    """The log with segment, sum of additions so far (``shift``), and values less that sum."""
    added = F.col("op") == "add"
    unknown = F.raise_error(F.concat(F.lit("unknown operation "), F.coalesce("op", F.lit("null"))))
    log = log.withColumn("op", F.when(F.col("op").isin(*OPERATIONS), F.col("op")).otherwise(unknown))
    sums = {"seg": F.col("op").isin(*RESETS).cast("long")}
    if _adds(kind):
        wide = T.DecimalType(38, kind.scale if isinstance(kind, T.DecimalType) else 0)
        scanned = prefix_scan(log, ["key"], "seq", sums=sums | {"_sum": F.when(added, F.col("value").cast(wide))}, limit=limit)
        scanned = scanned.withColumn("shift", F.coalesce("_sum", F.lit(0).cast(wide))).drop("_sum")
        less = lambda c: (F.col(c).cast(wide) - F.col("shift")).cast(wide)
    else:
        refused = F.when(added, F.raise_error(F.lit(f"{kind.simpleString()} values cannot be added"))).otherwise(F.col("op"))
        scanned = prefix_scan(log.withColumn("op", refused), ["key"], "seq", sums=sums, limit=limit)
        scanned = scanned.withColumn("shift", F.lit(None).cast("decimal(38,0)"))
        less = F.col
    present = ~F.col("op").isin("remove", "get_and_remove", "remove_if")
    # What each write leaves behind, and what cas and remove_if ask for.
    return checkpoint(
        scanned.withColumns({"present": present, "left": F.when(present, less("value")), "asked": less("comparand")})
    )


def _begun(kv: DataFrame, staged: DataFrame) -> DataFrame:
    """One row per key before its first operation, with what is stored."""
    keys = staged.groupBy("key").agg((F.min("seq") - 1).alias("seq"))
    stored = kv.select(F.col("key").alias("_key"), F.col("value").alias("_value"), F.lit(True).alias("_there"))
    kind = staged.schema["left"].dataType
    return keys.join(stored, _same(keys, stored, "key"), "left").select(
        "key", "seq", F.lit(0).cast("long").alias("seg"), F.coalesce("_there", F.lit(False)).alias("present"),
        F.col("_value").cast(kind).alias("left"),
    )


def _successors(staged: DataFrame, begun: DataFrame, limit: int) -> DataFrame:
    """(key, seq, next, hit): each possible write with its successor; hit where a segment begins."""
    op = F.col("op")
    writes = staged.where(op.isin(*RESETS, *WRITES)).select("key", "seg", "seq", "op", "present", "left", "asked")
    begun = begun.select("key", "seg", "seq", F.lit("begin").alias("op"), "present", "left")
    writes = writes.unionByName(begun, allowMissingColumns=True).withColumn("_back", -F.col("seq"))
    ahead = prefix_scan(
        writes, ["key", "seg"], "_back", limit=limit,
        previous={"_put": F.when(op == "put", F.col("seq")), "_update": F.when(op == "get_and_update", F.col("seq"))},
    )
    asks = ahead.where(op.isin("cas", "remove_if")).select(
        "key", "seg", F.col("asked").alias("left"), (-2 * F.col("seq")).alias("_back"), F.col("seq").alias("_asks")
    )
    leaves = ahead.where("present").select("key", "seg", "left", "seq", "op", "_update", (-2 * F.col("seq") - 1).alias("_back"))
    found = prefix_scan(
        leaves.unionByName(asks, allowMissingColumns=True), ["key", "seg", "left"], "_back", limit=limit,
        previous={"_match": F.col("_asks")},
    )
    hit = op.isin("begin", *RESETS).alias("hit")
    filled = found.where("seq IS NOT NULL").select("key", "seq", F.least("_update", "_match").alias("next"), hit)
    return filled.unionByName(ahead.where("NOT present").select("key", "seq", F.col("_put").alias("next"), hit))


def _marked(pointers: DataFrame) -> DataFrame:
    """(_key, _seq) of the writes that happen: all that is reached from a hit."""
    pointers = checkpoint(pointers)
    while not pointers.where("hit AND next IS NOT NULL").isEmpty():
        # Writes on one chain have different successors, so nothing is marked twice.
        reached = pointers.where("hit AND next IS NOT NULL").select(
            F.col("key").alias("_key"), F.col("next").alias("_seq"), F.lit(True).alias("_reached")
        )
        going = pointers.where("next IS NOT NULL")
        further = pointers.select(F.col("key").alias("_key"), F.col("seq").alias("_next"), F.col("next").alias("_further"))
        moved = going.join(further, _same(going, further, "key", "next"), "left").select(
            "key", "seq", F.col("_further").alias("next"), "hit"
        )
        both = moved.unionByName(pointers.where("next IS NULL"))
        pointers = checkpoint(
            both.join(reached, _same(both, reached, "key", "seq"), "left").select(
                "key", "seq", "next", (F.col("hit") | F.coalesce("_reached", F.lit(False))).alias("hit")
            )
        )
    return pointers.where("hit").select(F.col("key").alias("_key"), F.col("seq").alias("_seq"), F.lit(True).alias("_hit"))


def _played(staged: DataFrame, begun: DataFrame, marked: DataFrame, kind: T.DataType, limit: int) -> DataFrame:
    """Every operation with the state before and after it, and whether it wrote."""
    rows = staged.join(marked, _same(staged, marked, "key", "seq"), "left").withColumn("hit", F.coalesce("_hit", F.lit(False)))
    rows = rows.drop("_key", "_seq", "_hit", "asked").unionByName(
        begun.withColumn("hit", F.lit(True)), allowMissingColumns=True
    )
    written = F.when(F.col("hit"), F.struct("present", "left"))
    scanned = prefix_scan(rows, ["key"], "seq", previous={"_last": written}, limit=limit).where("op IS NOT NULL")
    added = F.col("op") == "add"
    there, base = F.col("_last.present"), F.col("_last.left")
    before = after = base
    if _adds(kind):
        own = F.when(added, F.col("value")).otherwise(F.lit(0))
        before, after = (base + F.col("shift") - own).cast(kind), (base + F.col("shift")).cast(kind)
    hit = F.col("hit")
    return scanned.select(
        "key", "seq", "op", "hit", there.alias("before_present"), F.when(there, before).alias("before_value"),
        F.when(hit, F.col("present")).otherwise(there).alias("after_present"),
        F.when(hit, F.when(F.col("present"), F.col("value"))).otherwise(F.when(there, after)).alias("after_value"),
    )


def _state(kv: DataFrame, played: DataFrame) -> DataFrame:
    """Stored values that no operation touched, and the last state of the others."""
    state = F.struct(F.col("after_value").alias("value"), F.col("after_present").alias("present"))
    ends = played.groupBy("key").agg(F.max_by(state, "seq").alias("_s")).select(F.col("key").alias("_key"), "_s.*")
    stored = kv.select("key", "value")
    kept = stored.join(ends, _same(stored, ends, "key"), "left_anti")
    return kept.unionByName(ends.where("present").select(F.col("_key").alias("key"), "value"))


def _results(played: DataFrame) -> DataFrame:
    """What each operation returns."""
    op, before, there = F.col("op"), F.col("before_value"), F.col("before_present")
    ok = (
        F.when(op == "update", True).when(op == "put", ~there)
        .when(op.isin("cas", "remove_if"), F.col("hit")).otherwise(there)
    )
    result = (
        F.when(op.isin("get", "get_and_update", "get_and_remove"), before)
        .when(op == "add", F.col("after_value"))
        .when((op == "cas") & ~F.col("hit"), before)
    )
    return played.select("key", "seq", "op", ok.alias("ok"), result.alias("result"))
