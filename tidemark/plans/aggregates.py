"""Plans for aggregates, statistics and traces."""

from pyspark.sql import functions as F

from tidemark.operators import agg, stats, tags, trace
from tidemark.plans.queries import rounded
from tidemark.plans.registry import plain, plan, with_inputs
from tidemark.plans.scans import ALIASES_SQL, _aliases
from tidemark.schema import TABLE, TS
from tidemark.session import checkpoint


@plan("a_count", with_inputs("clean") + 'SELECT count(the_double) AS n_double, count(the_string) AS n_string FROM clean')
def a_count(t):
    counted = agg.agg_all(t.derived("dirty"), ["the_double"]).select(F.col("`count(the_double)`").alias("n_double"))
    strings = agg.null_profile(t.derived("dirty"), ["the_string"]).select(F.col("set_count").alias("n_string"))
    return counted.select("n_double", strings.scalar().alias("n_string"))


@plan("a_sum", with_inputs("clean") + "SELECT CAST(sum(the_int64) AS BIGINT) AS total FROM clean")
def a_sum(t):
    return agg.agg_all(t.derived("dirty"), ["the_int64"]).select(F.col("`sum(the_int64)`").alias("total"))


@plan(
    "a_per_table",
    """SELECT event_type AS tbl, count(value) AS "count(value)", round(sum(value), 2) AS "sum(value)",
              count(user_id) AS "count(user_id)", CAST(sum(user_id) AS BIGINT) AS "sum(user_id)"
       FROM events GROUP BY event_type""",
)
def a_per_table(t):
    return plain(rounded(agg.agg_per_table(t.series, ["value", "user_id"]), "sum(value)"))


@plan(
    "a_ohlc_bar",
    """SELECT event_type AS tbl, date_trunc('minute', ts)::TIMESTAMP AS bar,
              first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
              last(value ORDER BY ts, event_id) AS close, CAST(sum(user_id) AS BIGINT) AS volume
       FROM events GROUP BY 1, 2""",
)
def a_ohlc_bar(t):
    return plain(agg.ohlc(t.series, "value", "user_id", by=[TABLE], seq="event_id"))


@plan("a_time_extent", 'SELECT min(ts) AS begin, max(ts) AS "end" FROM events')
def a_time_extent(t):
    return agg.time_extent(t.series)


@plan(
    "a_row_point_count",
    with_inputs("clean")
    + """SELECT tbl, count(*) AS row_count,
                count(event_id) + count(the_double) + count(the_int64) + count(the_string) + count(the_ts)
                + count(the_symbol) AS point_count FROM clean GROUP BY tbl""",
)
def a_row_point_count(t):
    dirty = t.derived("dirty").withColumnsRenamed({"ts": TS, "tbl": TABLE})
    return plain(agg.batch_stats(dirty, by=[TABLE]))


@plan(
    "a_tag_count", with_inputs("tags") + "SELECT tag, count(DISTINCT alias) AS entries FROM tags GROUP BY tag"
)
def a_tag_count(t):
    return tags.tag_counts(t.tags)


@plan("a_prefix_count", f"SELECT count(*) AS matches FROM {ALIASES_SQL} WHERE starts_with(alias, 'Customer#00000')")
def a_prefix_count(t):
    return tags.count_affix(_aliases(t), prefix="Customer#00000")


@plan("a_suffix_count", f"SELECT count(*) AS matches FROM {ALIASES_SQL} WHERE suffix(alias, 'no such end')")
def a_suffix_count(t):
    return tags.count_affix(_aliases(t), suffix="no such end")


# ---------------------------------------------------------------- statistics

STAT_SQL = with_inputs("stats") + r""", parsed AS (
    SELECT node, key, value, replace(key, '$statistics.', '') AS body,
           regexp_replace(replace(key, '$statistics.', ''), '\.uid_[0-9]+', '', 'g') AS shared FROM stats),
    meta AS (
    SELECT node, regexp_replace(shared, '\.(type|unit)$', '') AS metric,
           first(value ORDER BY key) FILTER (suffix(shared, '.type')) AS type_name,
           first(value ORDER BY key) FILTER (suffix(shared, '.unit')) AS unit_name
    FROM parsed WHERE suffix(shared, '.type') OR suffix(shared, '.unit') GROUP BY 1, 2),
    vals AS (
    SELECT node, regexp_replace(body, '\.uid_[0-9]+$', '') AS metric,
           TRY_CAST(nullif(regexp_extract(body, '\.uid_([0-9]+)$', 1), '') AS BIGINT) AS uid, value
    FROM parsed WHERE NOT suffix(shared, '.type') AND NOT suffix(shared, '.unit')),
    described AS (
    SELECT node, uid, metric, TRY_CAST(value AS BIGINT) AS int_value,
           CASE WHEN TRY_CAST(value AS BIGINT) IS NULL THEN value END AS text_value,
           CASE type_name WHEN 'accumulator' THEN 1 WHEN 'gauge' THEN 2 WHEN 'label' THEN 3 END AS "type",
           CASE unit_name WHEN 'none' THEN 0 WHEN 'count' THEN 1 WHEN 'bytes' THEN 32 END AS unit
    FROM vals JOIN meta USING (node, metric) WHERE NOT starts_with(metric, 'serialized'))
"""


def stats_of(t):
    """The statistics keys, derived once: the operators read them for types and for values."""
    return checkpoint(t.derived("stats"))


@plan("a_stats_cumulative", STAT_SQL + "SELECT * EXCLUDE (uid) FROM described WHERE uid IS NULL")
def a_stats_cumulative(t):
    return stats.stats_cumulative(stats_of(t))


@plan("a_stats_by_uid", STAT_SQL + "SELECT * FROM described WHERE uid IS NOT NULL")
def a_stats_by_uid(t):
    return stats.stats_by_uid(stats_of(t))


@plan("a_stats_by_node", STAT_SQL + "SELECT * FROM described")
def a_stats_by_node(t):
    return stats.stats_by_node(stats_of(t))


@plan(
    "j_stat_meta",
    STAT_SQL
    + """SELECT node, metric, CASE type_name WHEN 'accumulator' THEN 1 WHEN 'gauge' THEN 2 WHEN 'label' THEN 3 END
                AS "type", CASE unit_name WHEN 'none' THEN 0 WHEN 'count' THEN 1 END AS unit FROM meta""",
)
def j_stat_meta(t):
    return stats.stat_metadata(stats.parse_stats(stats_of(t)))


# ---------------------------------------------------------------- traces

# Eight measurements per event: two spans inside one, and labels that are no span edges.
TRACE_STEPS = [
    (0, "received", 0),
    (1, "processing_starts", 10),
    (2, "dispatch", 15),
    (3, "ts_evaluating_starts", 20),
    (4, "{inner}_starts", 30),
    (5, "{inner}_ends", 47),
    (6, "ts_evaluating_ends", 60),
    (7, "processing_ends", 90),
]
INNER_SQL = "CASE WHEN event_type IN ('click', 'view') THEN 'content_reading' ELSE 'entry_writing' END"


def _label_sql(label):
    return f"concat({INNER_SQL}, '{label[len('{inner}'):]}')" if label.startswith("{inner}") else f"'{label}'"


TRACE_SQL = "WITH trace AS (" + " UNION ALL ".join(
    f"""SELECT concat('user-', CAST(user_id AS STRING)) AS profile, event_id * 8 + {seq} AS seq,
        {_label_sql(label)} AS label, event_id * 1000 + {ns} + user_id * {seq} AS ns FROM events"""
    for seq, label, ns in TRACE_STEPS
) + ") "


def trace_of(t):
    steps = F.array(
        *[
            F.struct(
                F.lit(seq).alias("k"), F.expr(_label_sql(label)).alias("label"), F.lit(ns).alias("at")
            )
            for seq, label, ns in TRACE_STEPS
        ]
    )
    return t.events.select("event_id", "user_id", F.explode(steps).alias("m")).select(
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("profile"),
        (F.col("event_id") * 8 + F.col("m.k")).alias("seq"),
        F.col("m.label").alias("label"),
        (F.col("event_id") * 1000 + F.col("m.at") + F.col("user_id") * F.col("m.k")).alias("ns"),
    )


PAIRS_SQL = TRACE_SQL + """, e AS (
    SELECT profile, seq, ns, suffix(label, '_starts') AS is_start, regexp_replace(label, '_(starts|ends)$', '') AS op
    FROM trace WHERE suffix(label, '_starts') OR suffix(label, '_ends')),
    n AS (SELECT *, row_number() OVER (PARTITION BY profile, op, is_start ORDER BY seq) AS nth FROM e),
    spans AS (SELECT *, end_ns - start_ns AS elapsed_ns FROM (
        SELECT profile, op, nth, max(seq) FILTER (is_start) AS start_seq, max(seq) FILTER (NOT is_start) AS end_seq,
               max(ns) FILTER (is_start) AS start_ns, max(ns) FILTER (NOT is_start) AS end_ns
        FROM n GROUP BY profile, op, nth) AS paired
        WHERE start_seq IS NOT NULL AND end_seq IS NOT NULL)"""


@plan("j_span_pair", PAIRS_SQL + " SELECT * FROM spans")
def j_span_pair(t):
    return trace.span_pairs(trace_of(t))


@plan(
    "a_flamegraph",
    PAIRS_SQL
    + """ SELECT i.profile, i.end_seq AS seq, concat(i.profile, ';', string_agg(o.op, ';' ORDER BY o.start_seq)) AS stack,
               i.elapsed_ns AS ns,
               concat(i.profile, ';', string_agg(o.op, ';' ORDER BY o.start_seq), ' ', i.elapsed_ns) AS line
          FROM spans AS i JOIN spans AS o ON o.profile = i.profile AND o.start_seq <= i.start_seq
               AND o.end_seq >= i.end_seq
          GROUP BY i.profile, i.end_seq, i.elapsed_ns""",
)
def a_flamegraph(t):
    return trace.flamegraph(trace_of(t))


@plan(
    "a_profile_table",
    TRACE_SQL
    + "SELECT profile, row_number() OVER (PARTITION BY profile ORDER BY seq) AS pos, label, ns FROM trace",
)
def a_profile_table(t):
    return trace.profiles(trace_of(t))


@plan(
    "a_null_profile",
    with_inputs("clean")
    + """, p AS (SELECT 'the_double' AS "column", count(*) AS row_count, count(the_double) AS set_count FROM clean
         UNION ALL SELECT 'the_string', count(*), count(the_string) FROM clean
         UNION ALL SELECT 'the_symbol', count(*), count(the_symbol) FROM clean
         UNION ALL SELECT 'nothing', count(*), 0 FROM clean)
         SELECT *, CASE WHEN set_count = row_count THEN 'none_null' WHEN set_count = 0 THEN 'all_null'
                        ELSE 'mixed' END AS state FROM p""",
)
def a_null_profile(t):
    dirty = t.derived("dirty").withColumn("nothing", F.lit(float("nan")))
    return agg.null_profile(dirty, ["the_double", "the_string", "the_symbol", "nothing"])

