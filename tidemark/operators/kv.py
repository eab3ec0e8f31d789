"""Keyed values as a table ``(key, value, modified_at, expires_at)``.

Every call applies a set of requests at once and returns ``(new table, result)``.
``requests`` holds one row per key; where several may come, ``seq`` orders them and
the rule of the call decides (the first put, the last update or expiry, the sum of adds).
Without ``seq``, and for conditional calls, requests of a key must not differ: the job
fails if they do. ``oplog.replay`` applies any sequence of requests in order.
A null ``expires_at`` means never.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import timestamp
from tidemark.operators.write import one_per_key
from tidemark.session import small_side


def _never() -> Column:
    return F.lit(None).cast("timestamp_ntz")


def alive(df: DataFrame, now) -> DataFrame:
    """Entries that have not expired at ``now``."""
    return df.where(F.col("expires_at").isNull() | (F.col("expires_at") > timestamp(now)))


def _asked(requests: DataFrame, seq: str | None, keep: str) -> DataFrame:
    rows = one_per_key(requests, ["key"], seq, keep)
    return rows.select(*[F.col(c).alias(c if c == "key" else f"_req_{c}") for c in rows.columns])


def _joined(kv: DataFrame, asked: DataFrame) -> DataFrame:
    """Full join of table and requests with the flags ``_stored`` and ``_asked``.

    Few requests are sent to the table, which is then only scanned; the keys they did
    not find are added behind. Many requests meet the table in one shuffle.
    """
    left = kv.withColumn("_stored", F.lit(True))
    side, rows = small_side(asked.withColumn("_asked", F.lit(True)))
    if rows is None:
        both = left.join(side, "key", "full")
    else:
        found = kv.select("key").join(F.broadcast(side.select("key")), "key", "left_semi")
        unknown = side.join(found, "key", "left_anti")
        both = left.join(F.broadcast(side), "key", "left").unionByName(unknown, allowMissingColumns=True)
    return both.withColumns(
        {"_stored": F.coalesce("_stored", F.lit(False)), "_asked": F.coalesce("_asked", F.lit(False))}
    )


def get(kv: DataFrame, requests: DataFrame) -> DataFrame:
    """Values of the asked keys; ``missing`` where there is none."""
    found = _joined(kv, _asked(requests.select("key"), None, "first")).where("_asked")
    return found.select("key", "value", (~F.col("_stored")).alias("missing"))


def put(kv: DataFrame, requests: DataFrame, now, seq: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Insert absent keys; ``created`` is false for keys that exist already."""
    asked = _asked(requests.select("key", "value", *([seq] if seq else [])), seq, "first")
    both = _joined(kv, asked)
    new = both.select(
        "key",
        F.when(F.col("_stored"), F.col("value")).otherwise(F.col("_req_value")).alias("value"),
        F.when(F.col("_stored"), F.col("modified_at")).otherwise(timestamp(now)).alias("modified_at"),
        "expires_at",
    )
    return new, both.where("_asked").select("key", (~F.col("_stored")).alias("created"))


def update(kv: DataFrame, requests: DataFrame, now, seq: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Insert or replace; the expiry goes back to never. ``created`` tells new keys."""
    asked = _asked(requests.select("key", "value", *([seq] if seq else [])), seq, "last")
    both = _joined(kv, asked)
    new = both.select(
        "key",
        F.when(F.col("_asked"), F.col("_req_value")).otherwise(F.col("value")).alias("value"),
        F.when(F.col("_asked"), timestamp(now)).otherwise(F.col("modified_at")).alias("modified_at"),
        F.when(F.col("_asked"), _never()).otherwise(F.col("expires_at")).alias("expires_at"),
    )
    return new, both.where("_asked").select("key", (~F.col("_stored")).alias("created"))


def remove(kv: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Delete the asked keys; ``removed`` is false for missing ones."""
    asked = _asked(requests.select("key"), None, "first")
    both = _joined(kv, asked)
    return both.where("NOT _asked").select(*kv.columns), both.where("_asked").select(
        "key", F.col("_stored").alias("removed")
    )


def remove_if(kv: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Delete keys whose value equals ``comparand``; others stay."""
    asked = _asked(requests.select("key", "comparand"), None, "first")
    both = _joined(kv, asked)
    hit = F.col("_stored") & F.col("_asked") & F.col("value").eqNullSafe(F.col("_req_comparand"))
    new = both.where(F.col("_stored") & ~hit).select(*kv.columns)
    return new, both.where("_asked").select("key", hit.alias("removed"))


def get_and_update(kv: DataFrame, requests: DataFrame, now) -> tuple[DataFrame, DataFrame]:
    """Replace the values of existing keys and return the old ones."""
    asked = _asked(requests.select("key", "value"), None, "first")
    both = _joined(kv, asked)
    new = both.where("_stored").select(
        "key",
        F.when(F.col("_asked"), F.col("_req_value")).otherwise(F.col("value")).alias("value"),
        F.when(F.col("_asked"), timestamp(now)).otherwise(F.col("modified_at")).alias("modified_at"),
        F.when(F.col("_asked"), _never()).otherwise(F.col("expires_at")).alias("expires_at"),
    )
    return new, both.where("_asked").select(
        "key", F.col("value").alias("old_value"), (~F.col("_stored")).alias("missing")
    )


def get_and_remove(kv: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Delete the asked keys and return their values."""
    asked = _asked(requests.select("key"), None, "first")
    both = _joined(kv, asked)
    return both.where("NOT _asked").select(*kv.columns), both.where("_asked").select(
        "key", F.col("value").alias("old_value"), (~F.col("_stored")).alias("missing")
    )


def compare_and_swap(kv: DataFrame, requests: DataFrame, now) -> tuple[DataFrame, DataFrame]:
    """Set ``value`` where the stored value equals ``comparand``.

    The result is null after a swap and the kept value otherwise.
    """
    asked = _asked(requests.select("key", "value", "comparand"), None, "first")
    both = _joined(kv, asked)
    swap = F.col("_stored") & F.col("_asked") & F.col("value").eqNullSafe(F.col("_req_comparand"))
    new = both.where("_stored").select(
        "key",
        F.when(swap, F.col("_req_value")).otherwise(F.col("value")).alias("value"),
        F.when(swap, timestamp(now)).otherwise(F.col("modified_at")).alias("modified_at"),
        F.when(swap, _never()).otherwise(F.col("expires_at")).alias("expires_at"),
    )
    result = both.where("_asked").select(
        "key",
        swap.alias("swapped"),
        F.when(~swap, F.col("value")).alias("current"),
        (~F.col("_stored")).alias("missing"),
    )
    return new, result


def add(kv: DataFrame, requests: DataFrame, now) -> tuple[DataFrame, DataFrame]:
    """Add all addends of a key to its value, a number or a time; returns the new totals.

    Requests are summed before the shuffle. An overflow raises.
    """
    asked = requests.groupBy("key").agg(F.sum("addend").alias("_req_addend"))
    both = _joined(kv, asked)
    changed = F.col("_req_addend").isNotNull()
    total = F.when(changed, F.col("value") + F.col("_req_addend")).otherwise(F.col("value"))
    new = both.where("_stored").select(
        "key",
        total.cast(kv.schema["value"].dataType).alias("value"),
        F.when(F.col("_asked"), timestamp(now)).otherwise(F.col("modified_at")).alias("modified_at"),
        "expires_at",
    )
    return new, both.where("_asked").select(
        "key", total.cast(kv.schema["value"].dataType).alias("total"), (~F.col("_stored")).alias("missing")
    )


def expire_at(kv: DataFrame, requests: DataFrame, seq: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Set an absolute expiry, kept to the millisecond; missing keys are reported."""
    asked = _asked(requests.select("key", "expires_at", *([seq] if seq else [])), seq, "last")
    both = _joined(kv, asked)
    when = F.date_trunc("MILLISECOND", F.col("_req_expires_at")).cast("timestamp_ntz")
    new = both.where("_stored").select(
        "key", "value", "modified_at",
        F.when(F.col("_asked"), when).otherwise(F.col("expires_at")).alias("expires_at"),
    )
    return new, both.where("_asked").select("key", (~F.col("_stored")).alias("missing"))


def expire_from_now(
    kv: DataFrame, requests: DataFrame, now, seq: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Set the expiry to ``now`` plus the request's ``after`` interval."""
    when = (timestamp(now) + F.col("after")).cast("timestamp_ntz").alias("expires_at")
    return expire_at(kv, requests.select("key", when, *([seq] if seq else [])), seq)


def metadata(kv: DataFrame, requests: DataFrame, entry_type: str) -> DataFrame:
    """Type, size in bytes, modification time (seconds) and expiry of the asked keys."""
    found = _joined(kv, _asked(requests.select("key"), None, "first")).where("_asked")
    text = F.col("value") if entry_type in ("string", "blob") else None
    size = F.octet_length(text) if text is not None else F.when(F.col("_stored"), F.lit(8))
    return found.select(
        "key",
        F.when(F.col("_stored"), F.lit(entry_type)).alias("type"),
        size.cast("long").alias("size"),
        F.date_trunc("SECOND", "modified_at").cast("timestamp_ntz").alias("modified_at"),
        "expires_at",
        F.col("_stored").alias("exists"),
    )
