"""Symbol columns: text <-> number through a dictionary shared per symbol table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.running import row_index
from tidemark.schema import quoted
from tidemark.session import checked_broadcast


def build_dictionary(df: DataFrame, column: str) -> DataFrame:
    """(symbol_id, symbol): dense numbers from 0 in symbol order, for any number of symbols."""
    symbols = df.select(F.col(quoted(column)).alias("symbol")).where("symbol IS NOT NULL").distinct()
    return row_index(symbols, ["symbol"], "symbol_id")


def extend_dictionary(dictionary: DataFrame, df: DataFrame, column: str) -> DataFrame:
    """``dictionary`` with the unknown symbols of ``df`` numbered from its end on.

    Numbers that were given stay, so rows that were encoded before need no change.
    """
    symbols = df.select(F.col(quoted(column)).alias("symbol")).where("symbol IS NOT NULL").distinct()
    known = dictionary.select(F.col("symbol").alias("_known"))
    fresh = symbols.join(known, F.col("symbol") == F.col("_known"), "left_anti")
    begin = dictionary.agg(F.coalesce(F.max("symbol_id") + 1, F.lit(0))).first()[0]
    added = row_index(fresh, ["symbol"], "symbol_id").withColumn("symbol_id", F.col("symbol_id") + begin)
    return dictionary.select("symbol_id", "symbol").unionByName(added.select("symbol_id", "symbol"))


def symbol_encode(df: DataFrame, column: str, dictionary: DataFrame) -> DataFrame:
    """Replace symbol text by its number in ``<column>_id``; null stays null."""
    side = dictionary.select(F.col("symbol_id").alias(f"{column}_id"), F.col("symbol").alias("_symbol"))
    joined = df.join(checked_broadcast(side), df[quoted(column)] == F.col("_symbol"), "left")
    return joined.drop(column, "_symbol")


def symbol_decode(df: DataFrame, column: str, dictionary: DataFrame) -> DataFrame:
    """Inverse of ``symbol_encode``."""
    side = dictionary.select(F.col("symbol_id").alias("_id"), F.col("symbol").alias(column))
    joined = df.join(checked_broadcast(side), df[quoted(f"{column}_id")] == F.col("_id"), "left")
    return joined.drop(f"{column}_id", "_id")
