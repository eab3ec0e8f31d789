"""Running values and positions that survive one very large group.

A plain window puts a whole group into one task. That is the best plan while all groups
are moderate, so the largest one is measured first. Groups beyond the limit are cut
into chunks of about equally many rows, at quantiles of their integer order column;
windows run inside chunks, a second window runs over one summary row per chunk, and both
are combined by an equi-join. Groups below the limit stay whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.time import floor_div
from tidemark.schema import INDEX, TS, quoted
from tidemark.session import checked_broadcast, checkpoint

# Rows one task may take for one group.
GROUP_ROWS = 1_000_000
# Most chunks of one group; a group of more rows than this times the limit gets larger ones.
MOST_CHUNKS = 65_536
# Most stretches that positions are counted in, and sampled keys for each stretch or chunk.
MOST_STRETCHES, SAMPLED_KEYS = 16_384, 32
# Bytes of bounds that may be broadcast.
BOUND_BYTES = 64_000_000


def chunk_bounds(df: DataFrame, by: list[str], order: str, limit: int = GROUP_ROWS) -> DataFrame | None:
    """Bounds of ``order`` that cut each group of over ``limit`` rows; None if there is none.

    One row per such group: its keys as ``_k0``, ``_k1`` ... and ``_bounds``, the sorted last
    values of its chunks as a list of lists of about equal length. Bounds are taken from a
    sample of each group, a fixed number of rows per chunk, so chunks are of about equal size.
    """
    keys = [quoted(k) for k in by]
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    largest = sizes.agg(F.max("_n")).first()[0]
    if largest is None or largest <= limit:
        return None
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    names = [f"_k{i}" for i in range(len(by))]
    chunks = F.least(F.lit(MOST_CHUNKS), F.ceil(F.col("_n") / limit))
    large = sizes.where(F.col("_n") > limit).select(*named, (SAMPLED_KEYS * chunks / F.col("_n")).alias("_share"))
    large = _small(large, 8 * len(by))
    rows = df.select(*[F.col(k).alias(f"_of{i}") for i, k in enumerate(keys)], F.col(quoted(order)).alias("_at"))
    same = F.lit(True)
    for i, name in enumerate(names):
        same = same & rows[f"_of{i}"].eqNullSafe(large[name])
    sample = rows.join(large, same).where(F.rand(11) < F.col("_share")).select(*names, "_at")
    numbered = sample.withColumn("_i", F.row_number().over(W.partitionBy(*names).orderBy("_at")))
    cuts = numbered.where(F.col("_i") % SAMPLED_KEYS == 0).groupBy(*names).agg(F.array_sort(F.collect_list("_at")).alias("_cuts"))
    width = F.ceil(F.sqrt(F.size("_cuts"))).cast("int")
    parts = F.transform(
        F.sequence(F.lit(0), F.expr("(size(_cuts) - 1) div CAST(ceil(sqrt(size(_cuts))) AS INT)")),
        lambda i: F.slice("_cuts", (i * width + 1).cast("int"), width),
    )
    return checkpoint(cuts.select(*names, parts.alias("_bounds")))


def _small(side: DataFrame, row_bytes: int) -> DataFrame:
    return checked_broadcast(side, max(1, BOUND_BYTES // row_bytes))


def chunk_number(at: Column, bounds: Column) -> Column:
    """Number of bounds before ``at``, found in two steps; 0 without bounds."""
    width = F.size(bounds[0])
    full = F.size(F.filter(bounds, lambda part: F.element_at(part, -1) < at))
    inside = F.coalesce(F.size(F.filter(F.get(bounds, full), lambda b: b < at)), F.lit(0))
    return F.when(bounds.isNull(), F.lit(0)).otherwise(full * width + F.when(full < F.size(bounds), inside).otherwise(0)).cast("long")


def prefix_scan(
    df: DataFrame,
    by: list[str],
    order: str,
    *,
    sums: dict[str, Column] | None = None,
    lasts: dict[str, Column] | None = None,
    previous: dict[str, Column] | None = None,
    limit: int = GROUP_ROWS,
    bounds: DataFrame | None | str = "measure",
) -> DataFrame:
    """Add running columns per group ``by`` along the integer column ``order``.

    ``sums``: running sum including the row. ``lasts``: last non-null value up to the
    row. ``previous``: last non-null value before the row. ``order`` must be unique
    within a group. ``bounds`` are the ``chunk_bounds`` if they were measured before.
    """
    sums, lasts, previous = sums or {}, lasts or {}, previous or {}
    if isinstance(bounds, str):
        bounds = chunk_bounds(df, by, order, limit)
    if bounds is not None:
        return _chunked_scan(df, by, order, sums, lasts, previous, bounds)
    group = W.partitionBy(*[quoted(k) for k in by]).orderBy(quoted(order))
    upto = group.rowsBetween(W.unboundedPreceding, W.currentRow)
    ahead = group.rowsBetween(W.unboundedPreceding, -1)
    return df.withColumns(
        {n: F.sum(v).over(upto) for n, v in sums.items()}
        | {n: F.last(v, True).over(upto) for n, v in lasts.items()}
        | {n: F.last(v, True).over(ahead) for n, v in previous.items()}
    )


def in_chunks(df: DataFrame, by: list[str], order: str, bounds: DataFrame) -> DataFrame:
    """``df`` with the number of each row's chunk as ``_chunk``."""
    side = checked_broadcast(bounds, max_bytes=BOUND_BYTES)
    same = F.lit(True)
    for i, key in enumerate(by):
        same = same & F.col(quoted(key)).eqNullSafe(F.col(f"_k{i}"))
    chunk = chunk_number(F.col(quoted(order)), F.col("_bounds"))
    return df.join(side, same, "left").select(*[F.col(quoted(c)) for c in df.columns], chunk.alias("_chunk"))


def _chunked_scan(df, by, order, sums, lasts, previous, bounds: DataFrame) -> DataFrame:
    names = [*sums, *lasts, *previous]
    values = {**sums, **lasts, **previous}
    staged = in_chunks(df.withColumns({f"_v_{n}": v for n, v in values.items()}), by, order, bounds)
    keys = [quoted(k) for k in by]
    at = F.col(quoted(order))
    set_at = lambda n: F.when(F.col(f"_v_{n}").isNotNull(), at)
    totals = staged.groupBy(*keys, "_chunk").agg(
        *[
            (F.sum(f"_v_{n}") if n in sums else F.max_by(f"_v_{n}", set_at(n))).alias(f"_t_{n}")
            for n in names
        ]
    )
    before = W.partitionBy(*keys).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    carry = lambda n: F.sum(f"_t_{n}") if n in sums else F.last(f"_t_{n}", True)
    carried = totals.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("_chunk").alias("_carry_chunk"),
        *[carry(n).over(before).alias(f"_c_{n}") for n in names],
    )
    same = F.col("_chunk") == F.col("_carry_chunk")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    inside = W.partitionBy(*keys, "_chunk").orderBy(quoted(order))
    upto = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    ahead = inside.rowsBetween(W.unboundedPreceding, -1)
    local = staged.withColumns(
        {f"_w_{n}": F.sum(f"_v_{n}").over(upto) for n in sums}
        | {f"_w_{n}": F.last(f"_v_{n}", True).over(upto) for n in lasts}
        | {f"_w_{n}": F.last(f"_v_{n}", True).over(ahead) for n in previous}
    )
    joined = local.join(carried, same, "left")
    zero = F.lit(0)
    combined = {
        n: F.when(
            F.col(f"_w_{n}").isNotNull() | F.col(f"_c_{n}").isNotNull(),
            F.coalesce(F.col(f"_w_{n}"), zero) + F.coalesce(F.col(f"_c_{n}"), zero),
        )
        if n in sums
        else F.coalesce(F.col(f"_w_{n}"), F.col(f"_c_{n}"))
        for n in names
    }
    return joined.select(
        *[F.col(quoted(c)) for c in df.columns], *[v.alias(n) for n, v in combined.items()]
    )


def group_position(
    df: DataFrame, by: list[str], order: str, name: str = "pos", limit: int = GROUP_ROWS
) -> DataFrame:
    """Position 1..n of each row within its group."""
    return prefix_scan(df, by, order, sums={name: F.lit(1).cast("long")}, limit=limit)


def position_bounds(df: DataFrame, keys: list[str], limit: int) -> DataFrame | None:
    """One row ``_bounds`` that cuts ``df`` along ``keys`` into stretches of about ``limit`` rows.

    None if one stretch takes all. Only the key columns are read, and a sample of them kept.
    """
    rows = df.count()
    if rows <= limit:
        return None
    stretches = min(MOST_STRETCHES, math.ceil(2 * rows / limit))
    share = min(1.0, SAMPLED_KEYS * stretches / rows)
    at = F.struct(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)])
    sample = checkpoint(df.select(at.alias("_at")).sample(share, 11))
    # A bounded number of keys is ordered in one task, and every 32nd is a bound.
    numbered = sample.withColumn("_n", F.row_number().over(W.orderBy("_at")))
    cuts = numbered.where(F.col("_n") % SAMPLED_KEYS == 0).agg(F.sort_array(F.collect_list("_at")).alias("_cuts"))
    width = math.ceil(math.sqrt(stretches))
    last = F.expr(f"(size(_cuts) - 1) div {width}")
    parts = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("_cuts", i * width + 1, width))
    return checkpoint(cuts.select(F.when(F.size("_cuts") > 0, parts).alias("_bounds")))


def row_index(
    df: DataFrame, order_by: list[str] | None = None, name: str = INDEX, limit: int = GROUP_ROWS
) -> DataFrame:
    """Global position 0..n-1 along ``order_by``, which must identify rows uniquely.

    Fixed bounds cut the rows into stretches, a pass over the key columns counts them, and a
    row's position is its stretch's offset plus its rank inside. Bounds and offsets are kept,
    rows are not: a task that is rerun gives its rows the same positions.
    """
    keys = [quoted(c) for c in order_by or [TS]]
    names = [F.col(quoted(c)) for c in df.columns]
    bounds = position_bounds(df, keys, limit)
    if bounds is None:
        rank = F.row_number().over(W.partitionBy(F.lit(0)).orderBy(*keys))
        return df.select((rank - 1).cast("long").alias(name), *names)
    at = F.struct(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)])
    placed = df.crossJoin(F.broadcast(bounds)).select(*names, chunk_number(at, F.col("_bounds")).alias("_stretch"))
    before = W.orderBy("_stretch").rowsBetween(W.unboundedPreceding, -1)
    offsets = checkpoint(
        placed.groupBy("_stretch").agg(F.count("*").alias("_n"))
        .select(F.col("_stretch").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    ranked = placed.withColumn("_rank", F.row_number().over(W.partitionBy("_stretch").orderBy(*keys)))
    # At most MOST_STRETCHES + 1 offsets.
    return ranked.join(F.broadcast(offsets), F.col("_stretch") == F.col("_of")).select(
        (F.col("_offset") + F.col("_rank") - 1).alias(name), *names
    )


def batches(df: DataFrame, size: int, order_by: list[str] | None = None, limit: int = GROUP_ROWS) -> DataFrame:
    """Number rows into consecutive batches of at most ``size`` rows (0 = one batch)."""
    numbered = row_index(df, order_by, "_index", limit)
    batch = floor_div(F.col("_index"), size) if size > 0 else F.lit(0).cast("long")
    return numbered.select(batch.alias("batch_id"), *[F.col(quoted(c)) for c in df.columns])
