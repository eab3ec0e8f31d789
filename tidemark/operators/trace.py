"""Performance traces ``(profile, seq, label, ns)``: spans and folded stacks.

Spans of one profile nest to any depth; an operation never nests in itself. Everything is
computed by running values along ``seq`` and joins by position; a profile of any length may
be spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import op_split
from tidemark.operators.running import GROUP_ROWS, group_position, prefix_scan
from tidemark.session import checkpoint


def profiles(trace: DataFrame, limit: int = GROUP_ROWS) -> DataFrame:
    """Ordered measurements per profile: position, label, nanoseconds."""
    return group_position(trace, ["profile"], "seq", "pos", limit).select("profile", "pos", "label", "ns")


def edges(trace: DataFrame) -> DataFrame:
    """Span starts and ends only, as (profile, seq, is_start, op, ns)."""
    return (
        trace.withColumn("_op", op_split(F.col("label")))
        .where("_op.op IS NOT NULL")
        .select("profile", "seq", "_op.is_start", "_op.op", "ns")
    )


def span_pairs(trace: DataFrame, limit: int = GROUP_ROWS) -> DataFrame:
    """Each closed span with its start and end, and its number among spans of the operation.

    An operation does not nest in itself, so an end belongs to the last start before it.
    """
    begun = F.when(F.col("is_start"), F.struct("seq", "ns"))
    scanned = prefix_scan(
        edges(trace), ["profile", "op"], "seq",
        sums={"nth": F.col("is_start").cast("long")}, lasts={"_start": begun}, limit=limit,
    )
    return scanned.where("NOT is_start").select(
        "profile", "op", "nth",
        F.col("_start.seq").alias("start_seq"), F.col("seq").alias("end_seq"),
        F.col("_start.ns").alias("start_ns"), F.col("ns").alias("end_ns"),
        (F.col("ns") - F.col("_start.ns")).alias("elapsed_ns"),
    )


def _links(trace: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """Starts (profile, seq, op, up: the start around it) and ends (profile, seq, ns, start).

    The depth of an edge is a running sum. The last start of a depth is what an end at that
    depth closes, and what a start one deeper lies in, so one running pass over (profile,
    depth) finds both, however deep the stack is.
    """
    steps = edges(trace)
    step = F.when(F.col("is_start"), 1).otherwise(-1).cast("long")
    depth = prefix_scan(steps, ["profile"], "seq", sums={"_after": step}, limit=limit)
    # Depth of the span an edge belongs to: after its start, before its end.
    own = F.col("_after") + F.when(F.col("is_start"), 0).otherwise(1)
    role = lambda level, asks: F.struct(level.alias("level"), F.lit(asks).alias("asks"))
    roles = F.when(F.col("is_start"), F.array(role(own, False), role(own - 1, True))).otherwise(F.array(role(own, True)))
    marks = depth.select("profile", "seq", "is_start", "op", "ns", F.explode(roles).alias("_r")).select("*", "_r.*").drop("_r")
    opened = F.when(~F.col("asks"), F.struct("seq", "ns"))
    asked = prefix_scan(marks, ["profile", "level"], "seq", lasts={"_open": opened}, limit=limit).where("asks")
    starts = asked.where("is_start").select("profile", "seq", "op", F.col("_open.seq").alias("up"))
    return starts, asked.where("NOT is_start").select("profile", "seq", "ns", F.col("_open").alias("start"))


def _paths(starts: DataFrame) -> DataFrame:
    """(profile, seq, path): the operations from the outermost one down to each start.

    Each round joins every start with the one its path ends below, which doubles the length
    of all paths: as many rounds as the greatest depth has binary digits.
    """
    paths = checkpoint(starts.select("profile", "seq", F.col("op").alias("path"), "up"))
    while not paths.where("up IS NOT NULL").isEmpty():
        above = paths.select(
            F.col("profile").alias("_profile"), F.col("seq").alias("_seq"), F.col("path").alias("_path"), F.col("up").alias("_up")
        )
        below = paths.where("up IS NOT NULL")
        same = below["profile"].eqNullSafe(above["_profile"]) & (below["up"] == above["_seq"])
        longer = below.join(above, same).select(
            "profile", "seq", F.concat_ws(";", "_path", "path").alias("path"), F.col("_up").alias("up")
        )
        paths = checkpoint(longer.unionByName(paths.where("up IS NULL")))
    return paths.select("profile", "seq", "path")


def flamegraph(trace: DataFrame, limit: int = GROUP_ROWS) -> DataFrame:
    """Folded stacks ``profile;op;op <ns>``, one per closed span; ``seq`` is its end."""
    starts, ends = _links(trace, limit)
    paths = _paths(starts).select(F.col("profile").alias("_profile"), F.col("seq").alias("_seq"), "path")
    same = ends["profile"].eqNullSafe(paths["_profile"]) & (ends["start.seq"] == paths["_seq"])
    stack, elapsed = F.concat_ws(";", "profile", "path"), F.col("ns") - F.col("start.ns")
    return ends.join(paths, same).select(
        "profile", "seq", stack.alias("stack"), elapsed.alias("ns"),
        F.concat_ws(" ", stack, elapsed.cast("string")).alias("line"),
    )
