"""Null rules: NaN, the smallest int64, pre-epoch times, '' and empty bytes are null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schema import quoted

INT64_NULL = -(2**63)


def _is_epoch_negative(c: Column) -> Column:
    return c < F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


# Spark type -> "this non-null value stands for null"
NULLS_OF = {
    T.DoubleType: F.isnan,
    T.FloatType: F.isnan,
    T.LongType: lambda c: c == F.lit(INT64_NULL),
    T.TimestampNTZType: _is_epoch_negative,
    T.StringType: lambda c: c == F.lit(""),
    T.BinaryType: lambda c: F.octet_length(c) == 0,
}


def is_null_value(c: Column, dtype: T.DataType) -> Column:
    """True for SQL null and for the type's null sentinel."""
    rule = NULLS_OF.get(type(dtype))
    return c.isNull() if rule is None else c.isNull() | rule(c)


def normalise(c: Column, dtype: T.DataType) -> Column:
    """``c`` with the type's null sentinel replaced by SQL null."""
    rule = NULLS_OF.get(type(dtype))
    return c if rule is None else F.when(~rule(c), c)


def normalise_nulls(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Apply ``normalise`` to the given columns (default: all)."""
    wanted = set(df.columns if columns is None else columns)
    return df.select(
        *[
            normalise(F.col(quoted(f.name)), f.dataType).alias(f.name)
            if f.name in wanted
            else F.col(quoted(f.name))
            for f in df.schema.fields
        ]
    )
