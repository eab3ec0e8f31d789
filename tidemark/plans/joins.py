"""Plans for the workflow joins: tags, change log, deduplication, snapshots."""

from pyspark.sql import functions as F

from tidemark.operators import metrics, ranges, scan, tags, write
from tidemark.plans.registry import SERIES_SQL, plain, plan, with_inputs


@plan(
    "j_tag_semi",
    with_inputs("tags") + f"{SERIES_SQL} WHERE event_type IN (SELECT alias FROM tags WHERE tag = 'len5')",
)
def j_tag_semi(t):
    return plain(scan.scan_tagged(t.series, t.tags, ["len5"]))


@plan(
    "j_tag_and",
    with_inputs("tags")
    + """SELECT alias FROM tags WHERE tag IN ('web', 'purchase') AND entry_type = 'integer'
         GROUP BY alias HAVING count(DISTINCT tag) = 2""",
)
def j_tag_and(t):
    return tags.find(t.tags, all_of=["web", "purchase"], entry_type="integer")


REPLAY_SQL = with_inputs("changes") + (
    """SELECT log_ts, transaction_id, s.* FROM (SELECT DISTINCT * FROM changes) AS c
       JOIN (""" + SERIES_SQL + """) AS s ON s.tbl = c.table_name AND s.ts >= c.begin_ts AND s.ts <= c.end_ts"""
)


def change_log(t):
    return t.derived("changes").select(
        "log_ts", "transaction_id", F.col("table_name").alias("table"),
        F.col("begin_ts").alias("begin"), F.col("end_ts").alias("end"),
    )


@plan("j_cdc_range", REPLAY_SQL)
def j_cdc_range(t):
    """Rows of every transaction; the log holds each line twice, as after a retried write."""
    log = change_log(t)
    return plain(ranges.replay(log.unionByName(log), t.series))


KEYS = ["custkey", "priority"]
ANTI_SQL = """SELECT b.* FROM (SELECT * FROM batch QUALIFY row_number() OVER (
                  PARTITION BY custkey, priority ORDER BY orderkey) = 1) AS b
              WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT custkey, priority FROM stored) AS s
                  WHERE s.custkey = b.custkey AND s.priority IS NOT DISTINCT FROM b.priority)"""


@plan("j_dedup_anti", with_inputs("stored", "batch") + ANTI_SQL)
def j_dedup_anti(t):
    return write.dedup_new_rows(t.derived("stored"), t.derived("batch"), KEYS, "orderkey")


UPSERT_SQL = """SELECT s.* FROM stored AS s WHERE NOT EXISTS (
                    SELECT 1 FROM (SELECT DISTINCT custkey, priority FROM batch) AS b
                    WHERE s.custkey = b.custkey AND s.priority IS NOT DISTINCT FROM b.priority)
                UNION ALL SELECT * FROM (SELECT * FROM batch QUALIFY row_number() OVER (
                    PARTITION BY custkey, priority ORDER BY orderkey DESC) = 1) AS newest"""


@plan("j_upsert", with_inputs("stored", "batch") + UPSERT_SQL)
def j_upsert(t):
    return write.dedup_upsert(t.derived("stored"), t.derived("batch"), KEYS, "orderkey")


TOTALS_SQL = """, a AS (SELECT id, CAST(sum(ns) AS BIGINT) AS ns FROM {after} GROUP BY id),
    b AS (SELECT id, CAST(sum(ns) AS BIGINT) AS ns FROM samples
          WHERE snapshot_ts < TIMESTAMP '2024-01-15' AND id <> 'signup' GROUP BY id)"""


def totals_before(t):
    """Totals at mid-month, one id not seen yet."""
    early = t.derived("samples").where((F.col("snapshot_ts") < "2024-01-15") & (F.col("id") != "signup"))
    return metrics.metric_totals(early)


def totals_after(t):
    """Totals at the end; one id has not grown since."""
    grown = (F.col("id") != "view") | (F.col("snapshot_ts") < "2024-01-15")
    return metrics.metric_totals(t.derived("samples").where(grown))


AFTER_SQL = "(SELECT * FROM samples WHERE id <> 'view' OR snapshot_ts < TIMESTAMP '2024-01-15') AS x"


@plan(
    "j_snapshot_diff",
    with_inputs("samples") + TOTALS_SQL.replace("{after}", AFTER_SQL)
    + """SELECT id, b.ns AS ns_before, a.ns AS ns_after, coalesce(a.ns, 0) - coalesce(b.ns, 0) AS delta
         FROM b FULL JOIN a USING (id)""",
)
def j_snapshot_diff(t):
    return metrics.snapshot_diff(totals_before(t), totals_after(t))


@plan(
    "a_metric_delta",
    with_inputs("samples") + TOTALS_SQL.replace("{after}", AFTER_SQL)
    + """SELECT a.id, a.ns - coalesce(b.ns, 0) AS ns FROM a LEFT JOIN b ON a.id = b.id
         WHERE b.id IS NULL OR a.ns > b.ns""",
)
def a_metric_delta(t):
    return metrics.metric_delta(totals_before(t), totals_after(t))


@plan(
    "a_metric_totals",
    with_inputs("samples") + "SELECT id, CAST(sum(ns) AS BIGINT) AS ns FROM samples GROUP BY id",
)
def a_metric_totals(t):
    return metrics.metric_totals(t.derived("samples"))


@plan(
    "w_metric_delta",
    with_inputs("samples")
    + """, daily AS (SELECT id, CAST(CAST(snapshot_ts AS DATE) AS TIMESTAMP) AS snapshot_ts, sum(ns) AS day_ns
                     FROM samples GROUP BY 1, 2),
           snap AS (SELECT id, snapshot_ts, CAST(sum(day_ns) OVER (PARTITION BY id ORDER BY snapshot_ts) AS BIGINT)
                           AS ns FROM daily)
         SELECT * FROM (SELECT id, snapshot_ts, ns - coalesce(lag(ns) OVER (PARTITION BY id ORDER BY snapshot_ts), 0)
                               AS ns FROM snap) AS d WHERE ns > 0""",
)
def w_metric_delta(t):
    """Growth between snapshots; the snapshots are running totals at each day."""
    from tidemark.functions.time import micros
    from tidemark.operators.running import prefix_scan

    day = F.date_trunc("day", "snapshot_ts").cast("timestamp_ntz").alias("snapshot_ts")
    daily = t.derived("samples").groupBy("id", day).agg(F.sum("ns").alias("day_ns"))
    staged = daily.withColumn("_us", micros(F.col("snapshot_ts")))
    snapshots = prefix_scan(staged, ["id"], "_us", sums={"ns": F.col("day_ns")})
    return metrics.metric_delta_series(snapshots)

