"""Accumulated nanoseconds per operation id: totals and differences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import micros
from tidemark.operators.running import prefix_scan


def metric_totals(samples: DataFrame) -> DataFrame:
    """Sum per id."""
    return samples.groupBy("id").agg(F.sum("ns").alias("ns"))


def snapshot_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Both totals and their difference per id, for ids on either side."""
    b = before.select("id", F.col("ns").alias("ns_before"))
    a = after.select("id", F.col("ns").alias("ns_after"))
    return b.join(a, "id", "full").withColumn(
        "delta", F.coalesce("ns_after", F.lit(0)) - F.coalesce("ns_before", F.lit(0))
    )


def metric_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """What a scope added: new ids in full, grown ids by difference, others left out."""
    diff = snapshot_diff(before, after)
    return diff.where("ns_after IS NOT NULL AND (ns_before IS NULL OR delta > 0)").select(
        "id", F.col("delta").alias("ns")
    )


def metric_delta_series(snapshots: DataFrame) -> DataFrame:
    """Growth per id from one snapshot to the next; snapshots without growth left out.

    An id may have any number of snapshots.
    """
    ordered = snapshots.groupBy("id", "snapshot_ts").agg(F.max("ns").alias("ns"))
    staged = ordered.withColumn("_us", micros(F.col("snapshot_ts")))
    scanned = prefix_scan(staged, ["id"], "_us", previous={"_before": F.col("ns")})
    return scanned.where("_before IS NULL OR ns > _before").select(
        "id", "snapshot_ts", (F.col("ns") - F.coalesce("_before", F.lit(0))).alias("ns")
    )
