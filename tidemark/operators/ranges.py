"""Time ranges: literal ranges, range sets as data, and change-log replay.

Ranges are end-exclusive, change-log spans end-inclusive. Large range sets never
meet the rows in a nested loop: ranges are put on a grid whose cell size follows
their own length (one grid per factor of 16), and rows look up their cell by an
equi-join, so the work follows rows plus results, not rows times ranges.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.errors import InvalidArgument
from tidemark.functions.time import MICROS, ending, floor_div, from_micros, micros, nanosecond, timestamp
from tidemark.schema import SHARD, TABLE, TS, nanos, quoted
from tidemark.session import BROADCAST_ROWS, checkpoint, fits


def between(ts: Column, begin, end, closed: bool = False) -> Column:
    """``begin <= ts < end``, or ``<= end`` if ``closed``; ``end`` may be a duration."""
    lower = timestamp(begin)
    upper = ending(lower, end)
    return (ts >= lower) & (ts <= upper if closed else ts < upper)


def between_fine(ts: Column, rest: Column, begin, end, closed: bool = False, rests: tuple[int, int] | None = None) -> Column:
    """``between`` for a time and its nanoseconds; those of the bounds may be given apart."""
    low, high = rests or (nanosecond(begin), nanosecond(end))
    lower = timestamp(begin)
    upper = ending(lower, end)
    rest = F.coalesce(rest, F.lit(0))
    inside = rest <= high if closed else rest < high
    # The first pair of bounds reaches the scan.
    return (ts >= lower) & (ts <= upper) & ((ts > lower) | (rest >= low)) & ((ts < upper) | inside)


def in_range(
    df: DataFrame,
    begin,
    end,
    *,
    ts: str = TS,
    closed: bool = False,
    shard_size: timedelta | None = None,
) -> DataFrame:
    """Rows inside one range."""
    return in_ranges(df, [(begin, end)], ts=ts, closed=closed, shard_size=shard_size)


def in_ranges(
    df: DataFrame,
    ranges,
    *,
    ts: str = TS,
    closed: bool = False,
    shard_size: timedelta | None = None,
) -> DataFrame:
    """Rows inside any of the literal ranges, each row once; no ranges = all rows.

    Bounds may have nanoseconds if the rows have (see ``schema.nanos``).

    If the data is partitioned by ``_shard``, pass ``shard_size``: the derived
    shard predicate prunes directories, which a timestamp predicate cannot do.
    """
    ranges = list(ranges or [])
    if not ranges:
        return df
    stamp = F.col(quoted(ts))
    if nanos(ts) in df.columns:
        rest = F.col(quoted(nanos(ts)))
        hit = reduce(Column.__or__, [between_fine(stamp, rest, b, e, closed) for b, e in ranges])
    else:
        hit = reduce(Column.__or__, [between(stamp, b, e, closed) for b, e in ranges])
    if shard_size is not None and SHARD in df.columns:
        hit = hit & reduce(Column.__or__, [_shards(b, e, shard_size) for b, e in ranges])
    return df.where(hit)


def _shards(begin, end, shard_size: timedelta) -> Column:
    lower = timestamp(begin)
    upper = ending(lower, end)
    width = shard_size // MICROS
    first, last = floor_div(micros(lower), width), floor_div(micros(upper), width)
    return (F.col(SHARD) >= first) & (F.col(SHARD) <= last)


def _level(length: Column) -> Column:
    """Grid of a range: level n holds lengths in (16^(n-1), 16^n], cells of 16^(n-1) us."""
    return F.length(F.hex(length - 1))


def _cell(us: str, level: str) -> Column:
    return F.expr(f"shiftright({us}, 4 * ({level} - 1))")


def _grids(df: DataFrame, low: str, high: str) -> tuple[list[int], int, int]:
    """Grids in use (at most 16 small integers) and the extent of all ranges."""
    rows = df.groupBy("level").agg(F.min(low), F.max(high)).collect()
    return sorted(r[0] for r in rows), min((r[1] for r in rows), default=0), max((r[2] for r in rows), default=0)


def _within(ts: Column, low: int, high: int) -> Column:
    """Literal bounds, both included, that reach the scan."""
    return ts.between(from_micros(F.lit(low)), from_micros(F.lit(high)))


def in_range_set(
    df: DataFrame,
    ranges: DataFrame,
    *,
    ts: str = TS,
    begin: str = "begin",
    end: str = "end",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Rows inside any range of a DataFrame of ranges, each row once.

    Two ranges of one grid that begin in the same cell overlap, because both are at
    least one cell long. So the set shrinks by a plain group-by to one range per
    (grid, cell), and inside any cell the covered part is a prefix, a suffix or both.
    A row then needs one lookup by unique key per grid in use (usually one to three).
    """
    bounds = ranges.select(
        micros(F.col(quoted(begin))).alias("b"), micros(F.col(quoted(end))).alias("e")
    ).where("b < e")
    merged = (
        bounds.withColumn("level", _level(F.col("e") - F.col("b")))
        .groupBy("level", _cell("b", "level").alias("start"))
        .agg(F.min("b").alias("b"), F.max("e").alias("e"))
    )
    cells = merged.withColumn(
        "cell", F.explode(F.sequence(_cell("b", "level"), _cell("e - 1", "level")))
    ).withColumns(
        {
            "low": F.expr("shiftleft(cell, 4 * (level - 1))"),
            "high": F.expr("shiftleft(cell + 1, 4 * (level - 1))"),
        }
    )
    lookup = checkpoint(
        cells.groupBy("level", "cell").agg(
            F.max(F.when(F.col("b") <= F.col("low"), F.least("e", "high"))).alias("prefix_end"),
            F.min(F.when(F.col("e") >= F.col("high"), F.greatest("b", "low"))).alias("suffix_begin"),
        )
    )
    small = fits(lookup, broadcast_rows)
    us = micros(F.col(quoted(ts)))
    found, hits, extra = df, [], []
    extents = lookup.withColumns(
        {"low": F.expr("shiftleft(cell, 4 * (level - 1))"), "high": F.expr("shiftleft(cell + 1, 4 * (level - 1))")}
    )
    levels, low, high = _grids(extents, "low", "high")
    found = found.where(_within(F.col(quoted(ts)), low, high))
    for level in levels:
        side = lookup.where(F.col("level") == level).select(
            F.col("cell").alias(f"_cell{level}"),
            F.col("prefix_end").alias(f"_end{level}"),
            F.col("suffix_begin").alias(f"_begin{level}"),
        )
        found = found.join(
            F.broadcast(side) if small else side,
            F.shiftright(us, 4 * (level - 1)) == F.col(f"_cell{level}"),
            "left",
        )
        hits.append(
            F.coalesce(us < F.col(f"_end{level}"), F.lit(False))
            | F.coalesce(us >= F.col(f"_begin{level}"), F.lit(False))
        )
        extra += side.columns
    if not hits:
        return df.where(F.lit(False))
    return found.where(reduce(Column.__or__, hits)).drop(*extra)


def replay(
    log: DataFrame,
    df: DataFrame,
    *,
    ts: str = TS,
    table: str = TABLE,
    log_ts: str = "log_ts",
    transaction: str = "transaction_id",
    log_table: str = "table",
    begin: str = "begin",
    end: str = "end",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Rows of every logged transaction: ``begin <= ts <= end`` in the logged table.

    A row inside k transactions appears k times; the result carries the log time and
    the transaction id, so ``orderBy(log_ts, transaction_id, ts)`` gives log order.
    A log line repeated at the same log time counts once.
    """
    spans = (
        log.select(
            F.col(quoted(log_ts)).alias("log_ts"),
            F.col(quoted(transaction)).alias("transaction_id"),
            F.col(quoted(log_table)).alias("_log_table"),
            micros(F.col(quoted(begin))).alias("_b"),
            micros(F.col(quoted(end))).alias("_e"),
        )
        .dropDuplicates(["log_ts", "transaction_id", "_log_table"])
        .where("_b <= _e")
        .withColumn("level", _level(F.col("_e") - F.col("_b") + 1))
    )
    spans = checkpoint(spans)
    levels, low, high = _grids(spans, "_b", "_e")
    levels = levels or [1]
    cells = spans.withColumn(
        "cell", F.explode(F.sequence(_cell("_b", "level"), _cell("_e", "level")))
    )
    rows = (
        df.where(_within(F.col(quoted(ts)), low, high))
        .withColumn("_us", micros(F.col(quoted(ts))))
        .withColumn("_row_level", F.explode(F.array(*[F.lit(n) for n in levels])))
        .withColumn("_row_cell", _cell("_us", "_row_level"))
    )
    side = F.broadcast(cells) if fits(cells, broadcast_rows) else cells
    matched = rows.join(
        side,
        (F.col(quoted(table)) == F.col("_log_table"))
        & (F.col("_row_level") == F.col("level"))
        & (F.col("_row_cell") == F.col("cell"))
        & F.col("_us").between(F.col("_b"), F.col("_e")),
        "inner",
    )
    return matched.select("log_ts", "transaction_id", *[df[quoted(c)] for c in df.columns])


def split_range(spark, begin: datetime, end: datetime, delta: timedelta) -> DataFrame:
    """Consecutive chunks of ``delta`` that cover ``[begin, end)``; the last may be shorter."""
    if delta <= timedelta(0):
        raise InvalidArgument("the chunk length must be positive")
    count = max(0, -((begin - end) // delta))
    step = delta // MICROS
    start = micros(timestamp(begin))
    return (
        spark.range(count)
        .select(
            F.col("id").alias("chunk"),
            from_micros(start + F.col("id") * step).alias("begin"),
            F.least(from_micros(start + (F.col("id") + 1) * step), timestamp(end)).alias("end"),
        )
    )


def chunk_of(ts: Column, begin, delta: timedelta) -> Column:
    """Number of the chunk of ``split_range`` a time falls into."""
    return floor_div(micros(ts) - micros(timestamp(begin)), delta // MICROS)


def aggregate_chunks(
    df: DataFrame, begin: datetime, end: datetime, delta: timedelta, *aggregates: Column, ts: str = TS
) -> DataFrame:
    """One aggregate row per non-empty chunk of the split range."""
    if delta <= timedelta(0):
        raise InvalidArgument("the chunk length must be positive")
    return (
        in_range(df, begin, end, ts=ts)
        .groupBy(chunk_of(F.col(quoted(ts)), begin, delta).alias("chunk"))
        .agg(*aggregates)
    )

