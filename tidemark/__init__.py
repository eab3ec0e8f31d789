"""Time-series tables and streams on Spark."""

from tidemark.schema import INDEX, TABLE, TS, ColumnInfo, ColumnType, TableSchema
from tidemark.session import build_session

__all__ = ["INDEX", "TABLE", "TS", "ColumnInfo", "ColumnType", "TableSchema", "build_session"]
