"""Reading: column choice, union of tables, ordering, result index."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.errors import AliasNotFound, InvalidArgument
from tidemark.operators.ranges import in_ranges
from tidemark.operators.running import row_index
from tidemark.operators.tags import find
from tidemark.schema import INDEX, TABLE, TS, nanos, quoted
from tidemark.session import small_side


def project(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Requested columns in requested order behind the time index (with its nanoseconds) and the table name."""
    if isinstance(columns, str):
        raise TypeError("columns must be a list of names, not one text")
    if not columns:
        return df
    lead = [c for c in (TS, nanos(TS), TABLE) if c in df.columns]
    return df.select(*[quoted(c) for c in lead + [c for c in columns if c not in lead]])


def scan_table(df: DataFrame, table: str, columns=None, ranges=None) -> DataFrame:
    """One table without the table name column."""
    rows = in_ranges(df.where(F.col(quoted(TABLE)) == table), ranges)
    return project(rows.drop(TABLE), columns)


def scan_tables(df: DataFrame, tables: list[str], columns=None, ranges=None) -> DataFrame:
    """Several tables; every row carries its table name."""
    if isinstance(tables, str):
        raise TypeError("tables must be a list of names, not one text")
    return project(in_ranges(df.where(F.col(quoted(TABLE)).isin(list(tables))), ranges), columns)


def scan_tagged(
    df: DataFrame, tags: DataFrame, all_of: list[str], ranges=None, *, alias: str = "alias"
) -> DataFrame:
    """Rows of every table that carries all the tags; unknown tags are an error."""
    names, count = small_side(find(tags, all_of=all_of))
    if count == 0:
        raise AliasNotFound(f"no entry carries the tags {list(all_of)}")
    rows = in_ranges(df, ranges)
    side = names.select(F.col(alias).alias("_tagged"))
    side = side if count is None else F.broadcast(side)
    return rows.join(side, F.col(quoted(TABLE)) == F.col("_tagged"), "left_semi")


def union_tables(frames: dict[str, DataFrame]) -> DataFrame:
    """All rows of several tables, columns by name, with the table name."""
    if not frames:
        raise InvalidArgument("no table given")
    named = [df.withColumn(TABLE, F.lit(name)) for name, df in frames.items()]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)
    lead = [c for c in (TS, TABLE) if c in union.columns]
    return union.select(*[quoted(c) for c in lead + [c for c in union.columns if c not in lead]])


def ordered(df: DataFrame, *more: str) -> DataFrame:
    """Time order, by nanoseconds too where the rows have them; further columns break ties."""
    fine = [F.coalesce(F.col(quoted(nanos(TS))), F.lit(0))] if nanos(TS) in df.columns else []
    return df.orderBy(quoted(TS), *fine, *[quoted(c) for c in more])


def first_rows(df: DataFrame, n: int, *more: str) -> DataFrame:
    return ordered(df, *more).limit(n)


def newest(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def result_index(df: DataFrame, index: str | int | None = None, *, order_by: list[str] | None = None) -> DataFrame:
    """Put an index first: a column by name or offset, or a new 0..n-1 ``$index``."""
    if index is None:
        return row_index(df, order_by, INDEX)
    if isinstance(index, bool) or not isinstance(index, (str, int)):
        raise TypeError(f"an index is a name or an offset, not {type(index).__name__}")
    if isinstance(index, str) and index not in df.columns:
        raise KeyError(f"no column '{index}' in the result")
    if isinstance(index, int) and not -len(df.columns) <= index < len(df.columns):
        raise IndexError(f"no column number {index} in the result")
    name = index if isinstance(index, str) else df.columns[index]
    if not df.where(F.col(quoted(name)).isNull()).isEmpty():
        raise ValueError(f"column '{name}' has nulls and cannot be the index")
    return df.select(quoted(name), *[quoted(c) for c in df.columns if c != name])


def validate(spark, query: str, count: bool = False) -> DataFrame:
    """Check a query and return its column names and types.

    It is analysed, not run, unless ``count`` asks for its number of rows (``n_rows``) too.
    """
    result = spark.sql(query)
    fields = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(result.schema.fields)]
    described = spark.createDataFrame(fields, "position int, name string, type string")
    return described.crossJoin(F.broadcast(result.agg(F.count("*").alias("n_rows")))) if count else described
