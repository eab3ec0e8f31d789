"""Plan registry and the inputs plans share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schema import INDEX, TABLE, TS, quoted

BASE_TABLES = ("events", "orders", "customer", "part", "documents", "pages")


@dataclass(frozen=True)
class Plan:
    name: str
    build: Callable[["Inputs"], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Inputs(spark, sf_dir))


PLANS: dict[str, Plan] = {}


def plan(name: str, sql: str | None = None):
    """Register a plan; ``sql`` computes the same with another engine."""

    def register(build):
        if name in PLANS:
            raise ValueError(f"plan {name} is registered twice")
        PLANS[name] = Plan(name, build, sql)
        return build

    return register


def plain(df: DataFrame) -> DataFrame:
    """Result columns without ``$``."""
    names = {TS: "ts", TABLE: "tbl", INDEX: "idx"}
    return df.select(*[F.col(quoted(c)).alias(names.get(c, c)) for c in df.columns])


# ---------------------------------------------------------------------------------
# Derived inputs as SQL that both engines read, so both start from the same rows.

# Values in which null, NaN, '', the smallest int64 and pre-epoch times occur.
DIRTY = """
SELECT event_id, ts, event_type AS tbl,
       CASE WHEN event_id % 3 = 0 THEN NULL
            WHEN event_id % 7 = 0 THEN CAST('NaN' AS DOUBLE) ELSE value END AS the_double,
       CASE WHEN event_id % 11 = 0 THEN CAST(-9223372036854775808 AS BIGINT)
            ELSE user_id END AS the_int64,
       CASE WHEN event_id % 5 = 0 THEN '' WHEN event_id % 17 = 0 THEN NULL ELSE props END AS the_string,
       CASE WHEN event_id % 13 = 0 THEN ts - INTERVAL '100' YEAR ELSE ts END AS the_ts,
       event_type AS the_symbol
FROM events
"""

# The same rows with the sentinels turned into null.
CLEAN = f"""
SELECT event_id, ts, tbl,
       CASE WHEN isnan(the_double) THEN NULL ELSE the_double END AS the_double,
       CASE WHEN the_int64 = CAST(-9223372036854775808 AS BIGINT) THEN NULL ELSE the_int64 END AS the_int64,
       CASE WHEN the_string = '' THEN NULL ELSE the_string END AS the_string,
       CASE WHEN the_ts < TIMESTAMP '1970-01-01 00:00:00' THEN NULL ELSE the_ts END AS the_ts,
       the_symbol
FROM ({DIRTY}) AS dirty
"""

# Entries with their tags: event types are tables, documents and users are other entries.
TAGS = """
SELECT DISTINCT event_type AS alias, 'timeseries' AS entry_type, 'web' AS tag FROM events
UNION SELECT DISTINCT event_type, 'timeseries', 'money' FROM events WHERE event_type IN ('purchase', 'signup')
UNION SELECT DISTINCT event_type, 'timeseries', concat('len', CAST(length(event_type) AS STRING)) FROM events
UNION SELECT concat('doc-', CAST(doc_id AS STRING)), 'blob', lang FROM documents
UNION SELECT concat('doc-', CAST(doc_id AS STRING)), 'blob', source FROM documents
UNION SELECT concat('doc-', CAST(doc_id AS STRING)), 'blob', 'web' FROM documents WHERE n_chars > 500
UNION SELECT concat('user-', CAST(user_id AS STRING)), 'integer', event_type FROM events
UNION SELECT concat('user-', CAST(user_id AS STRING)), 'integer', 'web' FROM events WHERE value > 50
"""

# Change log: one transaction per table and hour, its span reaching into the next hour.
CHANGES = """
SELECT CAST(max(event_id) AS BIGINT) AS transaction_id, event_type AS table_name,
       min(ts) AS begin_ts, max(ts) + INTERVAL '30' MINUTE AS end_ts,
       max(ts) + INTERVAL '31' MINUTE AS log_ts
FROM events
GROUP BY event_type, CAST(ts AS DATE), extract(HOUR FROM ts)
"""

# Server statistics, with types and units, unindexed and internal keys.
STATS = """
SELECT node, concat('$statistics.requests.', event_type, '.uid_', CAST(user_id AS STRING)) AS key,
       CAST(n AS STRING) AS value
FROM (SELECT concat('node', CAST(user_id % 3 AS STRING)) AS node, event_type, user_id, count(*) AS n
      FROM events GROUP BY 1, 2, 3) AS per_user
UNION ALL
SELECT concat('node', CAST(user_id % 3 AS STRING)), concat('$statistics.requests.', event_type),
       CAST(count(*) AS STRING) FROM events GROUP BY 1, 2
UNION ALL
SELECT DISTINCT concat('node', CAST(user_id % 3 AS STRING)),
       concat('$statistics.requests.', event_type, '.type'),
       CASE WHEN event_type = 'error' THEN 'gauge' ELSE 'accumulator' END FROM events
UNION ALL
SELECT DISTINCT concat('node', CAST(user_id % 3 AS STRING)),
       concat('$statistics.requests.', event_type, '.uid_', CAST(user_id AS STRING), '.unit'),
       'count' FROM events WHERE event_type <> 'view'
UNION ALL
SELECT concat('node', CAST(user_id % 3 AS STRING)), concat('$statistics.serialized.', event_type),
       CAST(count(*) AS STRING) FROM events GROUP BY 1, 2
UNION ALL
SELECT DISTINCT concat('node', CAST(user_id % 3 AS STRING)),
       concat('$statistics.serialized.', event_type, '.type'), 'gauge' FROM events
UNION ALL
SELECT concat('node', CAST(user_id % 3 AS STRING)), concat('$statistics.loose.', event_type),
       CAST(count(*) AS STRING) FROM events GROUP BY 1, 2
UNION ALL
SELECT concat('node', CAST(user_id % 3 AS STRING)), '$statistics.engine.last_type', max(event_type)
FROM events GROUP BY 1
UNION ALL
SELECT DISTINCT concat('node', CAST(user_id % 3 AS STRING)), '$statistics.engine.last_type.type',
       'label' FROM events
UNION ALL
SELECT DISTINCT concat('node', CAST(user_id % 3 AS STRING)), '$statistics.engine.last_type.unit',
       'none' FROM events
"""

# Keyed values: the last value of each user, every third user with an expiry.
KV = """
SELECT user_id AS key, max(CAST(round(value * 100) AS BIGINT)) AS value, max(ts) AS modified_at,
       CASE WHEN user_id % 3 = 0 THEN max(ts) + INTERVAL '12' HOUR ELSE NULL END AS expires_at
FROM events GROUP BY user_id
"""

# Requests: one per customer, so some keys exist and some do not.
REQUESTS = """
SELECT c_custkey AS key, CAST(round(c_acctbal) AS BIGINT) AS value,
       COALESCE(kv.value, 0) + CASE WHEN c_nationkey < 12 THEN 0 ELSE 1 END AS comparand
FROM customer LEFT JOIN ({kv}) AS kv ON kv.key = c_custkey
""".replace("{kv}", KV)

# Accumulated nanoseconds per operation.
SAMPLES = """
SELECT event_type AS id, ts AS snapshot_ts, CAST(round(value * 100) AS BIGINT) * 10 AS ns FROM events
"""

# Rows already stored, and a batch that overlaps them in keys, with repeated keys.
STORED = """
SELECT o_orderdate AS ts, o_custkey AS custkey, o_orderkey AS orderkey, o_totalprice AS price,
       CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS priority
FROM orders WHERE o_orderstatus <> 'P'
"""
BATCH = """
SELECT CASE WHEN o_orderpriority LIKE '1%' THEN o_orderdate + INTERVAL '1' DAY ELSE o_orderdate END AS ts,
       o_custkey AS custkey, o_orderkey AS orderkey, o_totalprice + 1 AS price,
       CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS priority
FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00'
"""

DERIVED = {
    "dirty": DIRTY, "clean": CLEAN, "tags": TAGS, "changes": CHANGES, "stats": STATS, "kv": KV,
    "requests": REQUESTS, "samples": SAMPLES, "stored": STORED, "batch": BATCH,
}


def with_inputs(*names: str) -> str:
    """WITH clause that defines derived inputs for a counterpart query."""
    return "WITH " + ", ".join(f"{n} AS ({DERIVED[n]})" for n in names) + " "


class Inputs:
    """The given tables of one scale factor as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def derived(self, name: str) -> DataFrame:
        """A derived input; the tables it reads are passed by argument, not as views."""
        sql = DERIVED[name]
        frames = {t: self.table(t) for t in BASE_TABLES if t in sql}
        for table in frames:
            sql = _replace_table(sql, table)
        return self.spark.sql(sql, **frames)

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def series(self) -> DataFrame:
        """``events`` as time-series tables, one per event type."""
        return self.events.select(
            F.col("ts").alias(TS), F.col("event_type").alias(TABLE), "event_id", "user_id", "value", "props"
        )

    @cached_property
    def tags(self) -> DataFrame:
        return self.derived("tags")

    def stream(self, name: str = "events") -> DataFrame:
        """A given table as a file stream."""
        return (
            self.spark.readStream.schema(self.table(name).schema)
            .option("pathGlobFilter", f"{name}.parquet")
            .parquet(self.sf_dir)
        )


def _replace_table(sql: str, table: str) -> str:
    return sql.replace(f"FROM {table}", "FROM {" + table + "}")


# Columns of ``Inputs.series`` in counterpart queries.
SERIES_SQL = "SELECT ts, event_type AS tbl, event_id, user_id, value, props FROM events"
