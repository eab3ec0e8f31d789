"""Aggregates over tables and tagged groups; all combine before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.nulls import normalise
from tidemark.functions.time import micros
from tidemark.schema import TABLE, TS, quoted


def count_and_sum(df: DataFrame, columns: list[str]) -> list[Column]:
    """``count(c)`` and ``sum(c)`` with null sentinels left out."""
    out = []
    for name in columns:
        clean = normalise(F.col(quoted(name)), df.schema[name].dataType)
        out += [F.count(clean).alias(f"count({name})"), F.sum(clean).alias(f"sum({name})")]
    return out


def agg_all(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: count and sum of each column over all given tables."""
    return df.agg(*count_and_sum(df, columns))


def agg_per_table(df: DataFrame, columns: list[str], table: str = TABLE) -> DataFrame:
    """Count and sum of each column per table."""
    return df.groupBy(quoted(table)).agg(*count_and_sum(df, columns))


def ohlc(
    df: DataFrame,
    price: str,
    volume: str | None = None,
    *,
    by: list[str] | None = None,
    width: str = "1 minute",
    ts: str = TS,
    seq: str | None = None,
) -> DataFrame:
    """Open, high, low, close per key and tumbling bar; works on streams too.

    ``seq`` orders prices that share a timestamp. A whole number is packed with the time
    into one decimal, which is aggregated by hash; other kinds need a sort.
    """
    value = F.col(quoted(price))
    order = F.col(quoted(ts))
    if seq is not None and isinstance(df.schema[seq].dataType, T.IntegralType):
        order = micros(order).cast("decimal(19,0)") * F.lit("20000000000000000000").cast("decimal(20,0)")
        order = (order + F.col(quoted(seq)).cast("decimal(19,0)")).cast("decimal(38,0)")
    elif seq is not None:
        order = F.struct(quoted(ts), quoted(seq))
    measures = [
        F.min_by(value, order).alias("open"),
        F.max(value).alias("high"),
        F.min(value).alias("low"),
        F.max_by(value, order).alias("close"),
    ]
    if volume is not None:
        measures.append(F.sum(quoted(volume)).alias("volume"))
    keys = [F.col(quoted(k)) for k in by or []]
    bars = df.where(value.isNotNull()).groupBy(*keys, F.window(quoted(ts), width).alias("_bar")).agg(*measures)
    names = [m for m in bars.columns if m not in (by or []) and m != "_bar"]
    return bars.select(*keys, F.col("_bar.start").alias("bar"), *names)


def time_extent(df: DataFrame, ts: str = TS) -> DataFrame:
    """One row: first and last time, whether or not the rows are sorted."""
    return df.agg(F.min(quoted(ts)).alias("begin"), F.max(quoted(ts)).alias("end"))


def batch_stats(df: DataFrame, by: list[str] | None = None, lead: tuple[str, ...] = (TS, TABLE)) -> DataFrame:
    """Rows and set points of a batch; ``lead`` columns are no points."""
    points = [
        F.count(normalise(F.col(quoted(f.name)), f.dataType))
        for f in df.schema.fields
        if f.name not in lead and f.name not in (by or [])
    ]
    total = points[0]
    for point in points[1:]:
        total = total + point
    return df.groupBy(*[quoted(k) for k in by or []]).agg(
        F.count("*").alias("row_count"), total.alias("point_count")
    )


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per column: rows, set values and whether it is all null, none null or mixed."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    counted = df.agg(
        F.count("*").alias("_rows"),
        *[F.count(normalise(F.col(quoted(f.name)), f.dataType)).alias(f"_n{i}") for i, f in enumerate(fields)],
    )
    entries = F.array(
        *[F.struct(F.lit(f.name).alias("column"), F.col(f"_n{i}").alias("n")) for i, f in enumerate(fields)]
    )
    state = (
        F.when(F.col("n") == F.col("_rows"), "none_null").when(F.col("n") == 0, "all_null").otherwise("mixed")
    )
    return (
        counted.select("_rows", F.explode(entries).alias("e"))
        .select("_rows", "e.column", "e.n")
        .select("column", F.col("_rows").alias("row_count"), F.col("n").alias("set_count"), state.alias("state"))
    )
