"""Write semantics as pure functions ``(existing, batch, options) -> new rows``.

``sources.tables`` persists the same semantics shard by shard.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import IncompatibleTypes, InvalidArgument
from tidemark.functions.nulls import normalise
from tidemark.operators.ranges import between
from tidemark.schema import SHARD, TABLE, TS, TableSchema, quoted
from tidemark.session import checked_broadcast, small_side


# ---------------------------------------------------------------- shaping a batch


def forced_types(force, schema: TableSchema) -> dict[str, str] | None:
    """Types by column name; a list goes by position, and one type is a list of one."""
    if force is None or isinstance(force, dict):
        return force
    kinds = [force] if isinstance(force, str) else list(force)
    if len(kinds) > len(schema.columns):
        raise InvalidArgument(f"{len(kinds)} types for {len(schema.columns)} columns")
    return {c.name: kind for c, kind in zip(schema.columns, kinds) if kind is not None}


def align(df: DataFrame, schema: TableSchema, extra: tuple[str, ...] = (TABLE,)) -> DataFrame:
    """Table column order; missing columns become null, unknown ones are dropped."""
    if TS not in df.columns:
        raise InvalidArgument(f"the data has no {TS} column")
    columns = [F.col(quoted(TS))] + [F.col(quoted(c)) for c in extra if c in df.columns]
    for info in schema.columns:
        if info.name in df.columns:
            columns.append(F.col(quoted(info.name)))
        else:
            columns.append(F.lit(None).cast(info.type.spark_type).alias(info.name))
    return df.select(*columns)


def cast_to(
    df: DataFrame,
    schema: TableSchema,
    force: dict[str, str] | None = None,
    infer: bool = True,
) -> DataFrame:
    """Coerce columns to the table's types and turn null sentinels into null.

    ``force`` casts single columns to a named Spark type first. With ``infer=False``
    nothing else is cast, and all columns that do not fit are reported together.
    Values that cannot be converted raise, values that are null never do.
    """
    force = force or {}
    for name in force:
        schema.column(name)
    forced = df.withColumns({n: F.col(quoted(n)).cast(t) for n, t in force.items() if n in df.columns})
    problems, columns = [], []
    kinds = {c.name: c.type for c in schema.with_index()}
    for fld in forced.schema.fields:
        value = normalise(F.col(quoted(fld.name)), fld.dataType)
        kind = kinds.get(fld.name)
        if kind is not None and not kind.accepts(fld.dataType):
            if infer:
                value = value.cast(kind.spark_type)
            elif not isinstance(fld.dataType, T.NullType):
                problems.append(
                    f"column '{fld.name}' of type {kind.value} got {fld.dataType.simpleString()}"
                )
        if kind is not None and not problems:
            value = normalise(value.cast(kind.spark_type), kind.spark_type)
        columns.append(value.alias(fld.name))
    if problems:
        raise IncompatibleTypes(problems)
    return forced.select(*columns)


def prepare(df: DataFrame, schema: TableSchema, force=None, infer: bool = True) -> DataFrame:
    """Align, coerce and clean a batch for ``schema``."""
    return align(cast_to(df, schema, force, infer), schema)


def check_batch(frames: list[DataFrame]) -> None:
    """A push needs at least one row."""
    if not frames or all(df.isEmpty() for df in frames):
        raise InvalidArgument("nothing to push")


def sort_for_write(df: DataFrame, shard: Column, *more: str) -> DataFrame:
    """Rows grouped by shard and in time order.

    Tasks get ranges of (shard, time), so one huge shard is written by many tasks.
    """
    keys = [SHARD, *[quoted(c) for c in (TS, *more)]]
    return df.withColumn(SHARD, shard).repartitionByRange(*keys).sortWithinPartitions(*keys)


def rows_to_columns(
    cells: DataFrame,
    columns: dict[str, T.DataType],
    *,
    by: list[str],
    column: str = "column",
    value: str = "value",
) -> DataFrame:
    """Sparse cells (row, column, value) -> full rows; unset cells are null.

    Setting one cell twice is an error. ``value`` holds text, or bytes for blob columns; it
    is cast per column before the aggregate, so numbers and times need no sort.
    """
    is_column = lambda name: F.col(quoted(column)) == name
    measures = []
    for name, dtype in columns.items():
        times = F.count(F.when(is_column(name), F.lit(1)))
        measures.append(
            F.when(times > 1, F.raise_error(F.lit(f"cell of column '{name}' set twice")).cast(dtype))
            .otherwise(F.max(F.when(is_column(name), F.col(quoted(value)).cast(dtype))))
            .alias(name)
        )
    return cells.groupBy(*[quoted(k) for k in by]).agg(*measures)


# ---------------------------------------------------------------- combining with stored rows


def append(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Plain push: all rows of both, duplicates kept."""
    return existing.unionByName(batch)


def extent(batch: DataFrame, ts: str = TS):
    """First and last time of a batch (two scalars, so later filters push down)."""
    begin, end = batch.agg(F.min(quoted(ts)), F.max(quoted(ts))).first()
    if begin is None:
        raise InvalidArgument("nothing to push")
    return begin, end


def truncate_implicit(existing: DataFrame, batch: DataFrame, ts: str = TS) -> DataFrame:
    """Replace what lies in the batch's own time extent, both ends included."""
    begin, end = extent(batch, ts)
    kept = existing.where(~between(F.col(quoted(ts)), begin, end, closed=True))
    return kept.unionByName(batch)


def truncate_range(existing: DataFrame, batch: DataFrame, begin, end, ts: str = TS) -> DataFrame:
    """Delete ``[begin, end)`` and insert the batch, even where the batch has no rows."""
    check_batch([batch])
    return existing.where(~between(F.col(quoted(ts)), begin, end)).unionByName(batch)


def dedup_keys(deduplicate, mode: str, columns: list[str]) -> list[str] | None:
    """Validated key columns: all (``True``), a list, ``"$timestamp"``, or none."""
    if mode not in ("drop", "upsert"):
        raise InvalidArgument(f"the deduplication mode is 'drop' or 'upsert', not {mode!r}")
    if deduplicate is False or deduplicate is None:
        return None
    if deduplicate is True:
        return list(columns)
    if deduplicate == TS:
        deduplicate = [TS]
    if not isinstance(deduplicate, (list, tuple)):
        raise TypeError(f"deduplicate is a bool or a list of columns, not {type(deduplicate).__name__}")
    for name in deduplicate:
        if name != TS and name not in columns:
            raise InvalidArgument(f"deduplication column '{name}' is not in the table")
    return list(deduplicate)


def one_per_key(batch: DataFrame, keys: list[str], seq: str | None, keep: str) -> DataFrame:
    """First or last row by ``seq`` of each key.

    The rank filter is applied per task before the shuffle, so a hot key sends at
    most one row per task. Without ``seq`` rows of a key must not differ: the job fails
    if they do.
    """
    rest = [c for c in batch.columns if c not in keys]
    if seq is None and not rest:
        return batch.distinct()
    if seq is None:
        whole = F.struct(*[F.col(quoted(c)) for c in rest])
        found = batch.groupBy(*[quoted(k) for k in keys]).agg(F.min(whole).alias("_low"), F.max(whole).alias("_high"))
        differ = F.raise_error(F.lit(f"rows with equal {', '.join(keys)} differ: their order is needed (seq)"))
        same = F.col("_low").eqNullSafe(F.col("_high"))
        # A filter, so that it is checked whatever columns are used later.
        one = found.where(F.when(same, F.lit(True)).otherwise(differ.cast("boolean")))
        return one.select(*[F.col(quoted(c)) if c in keys else F.col("_low")[c].alias(c) for c in batch.columns])
    order = F.col(quoted(seq)).asc() if keep == "first" else F.col(quoted(seq)).desc()
    ranked = W.partitionBy(*[quoted(k) for k in keys]).orderBy(order)
    return batch.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def same_key(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe key equality (nulls are equal to each other)."""
    return reduce(Column.__and__, [left[quoted(k)].eqNullSafe(right[quoted(f"_key_{k}")]) for k in keys])


def _key_side(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*[F.col(quoted(k)).alias(f"_key_{k}") for k in keys]).distinct()


def dedup_new_rows(existing: DataFrame, batch: DataFrame, keys: list[str], seq: str | None = None) -> DataFrame:
    """Batch rows whose key is not stored yet; of equal keys the first one.

    The keys of a small batch are sent to the stored rows, so that those are scanned
    but not shuffled.
    """
    fresh = one_per_key(batch, keys, seq, "first")
    stored = _stored_keys(existing, batch, keys)
    return fresh.join(stored, same_key(fresh, stored, keys), "left_anti")


def _stored_keys(existing: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    asked, rows = small_side(_key_side(batch, keys))
    if rows is not None:
        existing = existing.join(F.broadcast(asked), same_key(existing, asked, keys), "left_semi")
    return _key_side(existing, keys)


def dedup_drop(existing: DataFrame, batch: DataFrame, keys: list[str], seq: str | None = None) -> DataFrame:
    """Stored rows win: new rows with a stored key are dropped."""
    return existing.unionByName(dedup_new_rows(existing, batch, keys, seq))


def dedup_upsert(existing: DataFrame, batch: DataFrame, keys: list[str], seq: str | None = None) -> DataFrame:
    """New rows win: stored rows with a key of the batch are replaced."""
    replaced = checked_broadcast(_key_side(batch, keys))
    kept = existing.join(replaced, same_key(existing, replaced, keys), "left_anti")
    return kept.unionByName(one_per_key(batch, keys, seq, "last"))


def without_stored(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Batch rows not stored with equal values in all columns; repeats in the batch stay."""
    stored = _stored_keys(existing, batch, batch.columns)
    return batch.join(stored, same_key(batch, stored, batch.columns), "left_anti")


def expire(df: DataFrame, now, ttl, ts: str = TS) -> DataFrame:
    """Rows younger than the retention; zero means no limit."""
    from tidemark.functions.time import timestamp

    if not ttl:
        return df
    return df.where(F.col(quoted(ts)) >= timestamp(now) - F.lit(ttl))
