"""Server statistics kept as keys ``<prefix><metric>[.uid_<n>][.type|.unit]``."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import int_or_text
from tidemark.session import checked_broadcast

# What the keys of statistics begin with, unless the caller says otherwise.
PREFIX = "$statistics."
# The codes of types and units.
TYPES = {"accumulator": 1, "gauge": 2, "label": 3}
UNITS = {
    "none": 0,
    "count": 1,
    "bytes": 32,
    "epoch": 64,
    "nanoseconds": 65,
    "microseconds": 66,
    "milliseconds": 67,
    "seconds": 68,
}


def enum_code(text: Column, codes: dict[str, int], what: str) -> Column:
    """Code of a type or unit name; an unknown name is an error, null stays null."""
    known = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    code = F.try_element_at(known, text)
    return F.when(text.isNull(), F.lit(None).cast("int")).otherwise(
        F.coalesce(code, F.raise_error(F.concat(F.lit(f"unknown {what} "), text)).cast("int"))
    )


def _is_stat(key: Column, prefix: str) -> Column:
    return key.startswith(prefix)


def parse_key(key: Column, prefix: str = PREFIX) -> Column:
    """Key -> struct(metric, uid, suffix); ``suffix`` is value, type or unit.

    The metric has no user part. All null if the key is no statistic.
    """
    is_stat = _is_stat(key, prefix)
    body = F.regexp_replace(key, "^" + re.escape(prefix), "")
    # Types and units are the same for all users, so the user part goes wherever it is;
    # a value belongs to a user only if the user part comes last.
    shared = F.regexp_replace(body, r"\.uid_[0-9]+", "")
    kind = F.regexp_extract(shared, r"\.(type|unit)$", 1)
    metric = F.when(kind == "", F.regexp_replace(body, r"\.uid_[0-9]+$", "")).otherwise(
        F.regexp_replace(shared, r"\.(type|unit)$", "")
    )
    uid = F.when(kind == "", F.regexp_extract(body, r"\.uid_([0-9]+)$", 1)).otherwise("")
    return F.struct(
        F.when(is_stat, metric).alias("metric"),
        F.when(is_stat & (uid != ""), uid.cast("bigint")).alias("uid"),
        F.when(is_stat, F.when(kind == "", "value").otherwise(kind)).alias("suffix"),
    )


def parse_stats(kv: DataFrame, prefix: str = PREFIX) -> DataFrame:
    """(node, key, value text) -> node, key, metric, uid, suffix, value."""
    return (
        kv.withColumn("_p", F.when(_is_stat(F.col("key"), prefix), parse_key(F.col("key"), prefix)))
        .where("_p IS NOT NULL")
        .select("node", "key", "_p.metric", "_p.uid", "_p.suffix", "value")
    )


def stat_metadata(parsed: DataFrame) -> DataFrame:
    """Type and unit code per node and metric; the first key in key order decides."""
    text = lambda suffix: F.min_by(
        "value", F.when(F.col("suffix") == suffix, F.col("key"))
    )
    found = (
        parsed.where("suffix IN ('type', 'unit')")
        .groupBy("node", "metric")
        .agg(text("type").alias("_type"), text("unit").alias("_unit"))
    )
    return found.select(
        "node",
        "metric",
        enum_code(F.col("_type"), TYPES, "type").alias("type"),
        enum_code(F.col("_unit"), UNITS, "unit").alias("unit"),
    )


def _described(parsed: DataFrame) -> DataFrame:
    """Values of metrics that have a type or unit, with both; internal ones left out."""
    values = parsed.where((F.col("suffix") == "value") & ~F.col("metric").startswith("serialized"))
    # One row per metric, so this side stays far below the values.
    typed = values.join(checked_broadcast(stat_metadata(parsed)), ["node", "metric"], "inner")
    return typed.withColumn("_v", int_or_text(F.col("value")))


def _stat_columns(*lead: str) -> list[Column]:
    return [
        *[F.col(c) for c in lead],
        F.col("_v.int_value").alias("int_value"),
        F.col("_v.text_value").alias("text_value"),
        F.col("type"),
        F.col("unit"),
    ]


def stats_by_uid(kv: DataFrame) -> DataFrame:
    """Per node and user: metric, value, type, unit."""
    return _described(parse_stats(kv)).where("uid IS NOT NULL").select(*_stat_columns("node", "uid", "metric"))


def stats_cumulative(kv: DataFrame) -> DataFrame:
    """Per node: metric, value, type, unit of the keys without a user part."""
    return _described(parse_stats(kv)).where("uid IS NULL").select(*_stat_columns("node", "metric"))


def stats_by_node(kv: DataFrame) -> DataFrame:
    """Both of the above in one pass; ``uid`` is null for cumulative values."""
    return _described(parse_stats(kv)).select(*_stat_columns("node", "uid", "metric"))
