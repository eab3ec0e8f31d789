"""Table model: six column types, a mandatory time index, shards and retention."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import timedelta
from enum import Enum

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.errors import IncompatibleTypes, InvalidArgument

TS = "$timestamp"
TABLE = "$table"
INDEX = "$index"
SHARD = "_shard"


def nanos(name: str) -> str:
    """The column that holds the nanoseconds, 0 to 999, beyond the microseconds of a time column.

    A table whose index has one orders, cuts and deduplicates by both together.
    """
    return f"{name}$nanos"


def quoted(name: str) -> str:
    """A column name that Spark reads literally (``$``, dots)."""
    return "`" + name.replace("`", "``") + "`"


class ColumnType(Enum):
    DOUBLE = "double"
    INT64 = "int64"
    TIMESTAMP = "timestamp"
    STRING = "string"
    SYMBOL = "symbol"
    BLOB = "blob"

    @property
    def spark_type(self) -> T.DataType:
        return _SPARK_TYPE[self]

    def accepts(self, dtype: T.DataType) -> bool:
        """Whether a column of this type takes ``dtype`` without any coercion."""
        return isinstance(dtype, _ACCEPTED[self])


_SPARK_TYPE = {
    ColumnType.DOUBLE: T.DoubleType(),
    ColumnType.INT64: T.LongType(),
    ColumnType.TIMESTAMP: T.TimestampNTZType(),
    ColumnType.STRING: T.StringType(),
    ColumnType.SYMBOL: T.StringType(),
    ColumnType.BLOB: T.BinaryType(),
}

_ACCEPTED = {
    ColumnType.DOUBLE: (T.DoubleType, T.FloatType),
    ColumnType.INT64: (T.LongType, T.IntegerType, T.ShortType),
    ColumnType.TIMESTAMP: (T.TimestampNTZType,),
    ColumnType.STRING: (T.StringType,),
    ColumnType.SYMBOL: (T.StringType,),
    ColumnType.BLOB: (T.BinaryType,),
}

# What a Spark column becomes when a table is created from a DataFrame.
_INFERRED = {
    T.DoubleType: ColumnType.DOUBLE,
    T.FloatType: ColumnType.DOUBLE,
    T.LongType: ColumnType.INT64,
    T.IntegerType: ColumnType.INT64,
    T.ShortType: ColumnType.INT64,
    T.TimestampNTZType: ColumnType.TIMESTAMP,
    T.TimestampType: ColumnType.TIMESTAMP,
    T.StringType: ColumnType.STRING,
    T.BinaryType: ColumnType.BLOB,
}


@dataclass(frozen=True)
class ColumnInfo:
    name: str
    type: ColumnType
    symtable: str | None = None

    def __post_init__(self):
        if not self.name:
            raise InvalidArgument("a column needs a name")
        if (self.type is ColumnType.SYMBOL) != bool(self.symtable):
            raise InvalidArgument(
                f"column '{self.name}': a symbol table is needed for symbol columns and only for them"
            )


@dataclass(frozen=True)
class TableSchema:
    """Columns after the time index, shard size and retention of one table."""

    name: str
    columns: tuple[ColumnInfo, ...] = ()
    shard_size: timedelta = timedelta(hours=24)
    ttl: timedelta = field(default=timedelta(0))

    def __post_init__(self):
        columns = tuple(self.columns)
        for position, column in enumerate(columns):
            if column.name == TS:
                if column.type is not ColumnType.TIMESTAMP or position != 0:
                    raise InvalidArgument(f"{TS} must be a timestamp and the first column")
        columns = tuple(c for c in columns if c.name != TS)
        names = [c.name for c in columns]
        if len(set(names)) != len(names):
            raise InvalidArgument(f"table '{self.name}' names a column twice")
        if self.shard_size < timedelta(milliseconds=1):
            raise InvalidArgument("the shard size must be at least 1 ms")
        if self.ttl < timedelta(0):
            raise InvalidArgument("the ttl must not be negative")
        object.__setattr__(self, "columns", columns)

    @property
    def shard_ms(self) -> int:
        return self.shard_size // timedelta(milliseconds=1)

    @property
    def has_ttl(self) -> bool:
        return self.ttl > timedelta(0)

    def with_index(self) -> tuple[ColumnInfo, ...]:
        return (ColumnInfo(TS, ColumnType.TIMESTAMP), *self.columns)

    def column(self, name: str) -> ColumnInfo:
        for column in self.with_index():
            if column.name == name:
                return column
        raise InvalidArgument(f"table '{self.name}' has no column '{name}'")

    def column_at(self, index: int) -> ColumnInfo:
        """The ``index``-th column, not counting the time index."""
        if not 0 <= index < len(self.columns):
            raise InvalidArgument(f"table '{self.name}' has no column number {index}")
        return self.columns[index]

    @property
    def fine(self) -> bool:
        """Whether the time index has nanoseconds."""
        return any(c.name == nanos(TS) for c in self.columns)

    def position(self, name: str) -> int:
        self.column(name)
        return [c.name for c in self.columns].index(name)

    def struct(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c.name, c.type.spark_type, c.name != TS) for c in self.with_index()]
        )

    def extended(self, columns) -> "TableSchema":
        return TableSchema(self.name, (*self.columns, *columns), self.shard_size, self.ttl)

    @staticmethod
    def infer(name: str, df: DataFrame, shard_size: timedelta | None = None) -> "TableSchema":
        """Schema for a new table that holds ``df``; unsupported types are refused."""
        problems, columns = [], []
        for fld in df.schema.fields:
            if fld.name in (TS, TABLE):
                continue
            kind = _INFERRED.get(type(fld.dataType))
            if kind is None:
                problems.append(f"column '{fld.name}': type {fld.dataType.simpleString()} is not supported")
            else:
                columns.append(ColumnInfo(fld.name, kind))
        if problems:
            raise IncompatibleTypes(problems)
        return TableSchema(name, tuple(columns), shard_size or timedelta(hours=24))
