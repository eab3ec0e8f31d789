"""Plans for the query surface: selection, ranges, aggregates, index, time zone, DDL."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.functions.time import in_zone, timestamp
from tidemark.operators import agg, ranges, scan, write
from tidemark.plans.registry import SERIES_SQL, plain, plan, with_inputs
from tidemark.schema import TABLE, TS, ColumnInfo, ColumnType, TableSchema, quoted
from tidemark.session import scratch_path
from tidemark.sources.tables import TableGroup

NOW = datetime(2024, 2, 1)
WEEK = [("2024-01-05", "2024-01-12")]
WEEK_SQL = "ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12'"


def rounded(df, *columns):
    """Money columns to cents, so that the order of addition cannot show."""
    return df.withColumns({c: F.round(quoted(c), 2) for c in columns})


@plan("q_select_star", f"{SERIES_SQL} WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-04-10'")
def q_select_star(t):
    return plain(ranges.in_range(t.series, "2024-01-01", timedelta(days=100)))


@plan("q_select_cols", "SELECT ts, event_type AS tbl, value FROM events")
def q_select_cols(t):
    return plain(t.series.select(quoted(TS), quoted(TABLE), "value"))


@plan("q_in_range_abs", f"{SERIES_SQL} WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-09 12:30:00'")
def q_in_range_abs(t):
    return plain(ranges.in_range(t.series, "2024-01-03", "2024-01-09 12:30:00"))


@plan("q_in_range_rel", f"{SERIES_SQL} WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-13'")
def q_in_range_rel(t):
    return plain(ranges.in_range(t.series, "2024-01-03", timedelta(days=10)))


@plan("q_where_eq", f"{SERIES_SQL} WHERE event_type = 'signup'")
def q_where_eq(t):
    return plain(t.series.where(F.col(quoted(TABLE)) == "signup"))


@plan("q_order_by_ts", f"{SERIES_SQL} ORDER BY ts")
def q_order_by_ts(t):
    return plain(scan.ordered(t.series))


@plan("q_count_col", with_inputs("clean") + 'SELECT count(the_double) AS "count(the_double)" FROM clean')
def q_count_col(t):
    return agg.agg_all(t.derived("dirty"), ["the_double"]).select(quoted("count(the_double)"))


@plan("q_sum_col", with_inputs("clean") + 'SELECT round(sum(the_double), 2) AS "sum(the_double)" FROM clean')
def q_sum_col(t):
    return rounded(agg.agg_all(t.derived("dirty"), ["the_double"]), "sum(the_double)").select(
        quoted("sum(the_double)")
    )


TAGGED_SQL = (
    with_inputs("tags")
    + """, named AS (SELECT DISTINCT alias FROM tags WHERE tag = 'money')
    SELECT {key} count(value) AS "count(value)", round(sum(value), 2) AS "sum(value)"
    FROM events WHERE event_type IN (SELECT alias FROM named) AND """
    + WEEK_SQL
)


@plan("q_agg_tagged", TAGGED_SQL.replace("{key}", ""))
def q_agg_tagged(t):
    tagged = scan.scan_tagged(t.series, t.tags, ["money"], WEEK)
    return rounded(agg.agg_all(tagged, ["value"]), "sum(value)")


@plan("q_agg_tagged_per_table", TAGGED_SQL.replace("{key}", "event_type AS tbl,") + " GROUP BY event_type")
def q_agg_tagged_per_table(t):
    tagged = scan.scan_tagged(t.series, t.tags, ["money"], WEEK)
    return plain(rounded(agg.agg_per_table(tagged, ["value"]), "sum(value)"))


@plan(
    "q_validate",
    """SELECT *, (SELECT count(*) FROM (SELECT DISTINCT ts, event_type FROM events) AS g) AS n_rows
       FROM (VALUES (0, 'ts', 'timestamp_ntz'), (1, 'event_type', 'string'), (2, 'n', 'bigint'))
       AS fields(position, name, type)""",
)
def q_validate(t):
    """Names and types of a valid query on a given table, and how many rows it has."""
    t.events.createOrReplaceTempView("validated_events")
    query = "SELECT ts, event_type, count(*) AS n FROM validated_events GROUP BY ts, event_type"
    return scan.validate(t.spark, query, count=True)


@plan("q_limit", f"{SERIES_SQL} ORDER BY ts LIMIT 1")
def q_limit(t):
    return plain(scan.first_rows(t.series, 1))


@plan(
    "q_insert_values",
    f"""{SERIES_SQL} UNION ALL
        SELECT TIMESTAMP '2024-02-01 00:00:00', 'click', CAST(-1 AS BIGINT), CAST(7 AS BIGINT), 1.25, NULL""",
)
def q_insert_values(t):
    """One literal row at the clock's time; columns that are not named are null."""
    row = t.spark.range(1).select(
        timestamp(NOW).alias(TS), F.lit("click").alias(TABLE), F.lit(-1).cast("bigint").alias("event_id"),
        F.lit(7).cast("bigint").alias("user_id"), F.lit(1.25).alias("value"),
        F.lit(None).cast("string").alias("props"),
    )
    return plain(write.append(t.series, row))


EVENT_COLUMNS = (
    ColumnInfo("event_id", ColumnType.INT64),
    ColumnInfo("user_id", ColumnType.INT64),
    ColumnInfo("value", ColumnType.DOUBLE),
    ColumnInfo("props", ColumnType.STRING),
)


@plan("q_create_table", "SELECT ts, event_id, user_id, value, props FROM events")
def q_create_table(t):
    """Create a table, push all events into it, read it back."""
    group = TableGroup(t.spark, scratch_path(t.spark, "tables"))
    group.create(TableSchema("all", EVENT_COLUMNS))
    group.push({"all": t.series.drop(TABLE)}, now=NOW)
    return plain(group.read("all"))


@plan(
    "q_drop_table",
    "SELECT ts, 'again' AS tbl, event_id, user_id, value, props FROM events WHERE event_type = 'click'",
)
def q_drop_table(t):
    """After a drop the rows are gone, also if the name is used again."""
    group = TableGroup(t.spark, scratch_path(t.spark, "tables"))
    group.create(TableSchema("again", EVENT_COLUMNS), TableSchema("other", EVENT_COLUMNS))
    group.push({"again": t.series.drop(TABLE), "other": t.series.drop(TABLE)}, now=NOW)
    group.drop("again")
    group.drop("other")
    group.create(TableSchema("again", EVENT_COLUMNS))
    group.push({"again": t.series.where(F.col(quoted(TABLE)) == "click").drop(TABLE)}, now=NOW)
    return plain(group.read(["again"]))


@plan("q_result_index", f"SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS idx, * FROM ({SERIES_SQL}) AS s")
def q_result_index(t):
    return plain(scan.result_index(t.series, order_by=[TS, "event_id"]))


@plan("q_result_index_column", "SELECT event_id, ts, event_type AS tbl, user_id, value, props FROM events")
def q_result_index_column(t):
    return plain(scan.result_index(t.series, "event_id"))


@plan(
    "q_timezone",
    """SELECT event_id, ts AS utc, ts + INTERVAL 1 HOUR AS amsterdam, ts + INTERVAL 7 HOUR AS bangkok
       FROM events""",
)
def q_timezone(t):
    ts = F.col("ts")
    return t.events.select(
        "event_id", in_zone(ts, "UTC").alias("utc"), in_zone(ts, "Europe/Amsterdam").alias("amsterdam"),
        in_zone(ts, "Asia/Bangkok").alias("bangkok"),
    )


STEP = timedelta(days=1, hours=7)


@plan(
    "q_split_range",
    """WITH s AS (SELECT min(ts) AS b, max(ts) AS e FROM events)
       SELECT n AS chunk, b + n * INTERVAL 31 HOUR AS begin, least(b + (n + 1) * INTERVAL 31 HOUR, e) AS "end"
       FROM s, range(0, 1000) AS r(n) WHERE b + n * INTERVAL 31 HOUR < e""",
)
def q_split_range(t):
    """The whole extent of the table in chunks; the last one is shorter."""
    begin, end = write.extent(t.series)
    return ranges.split_range(t.spark, begin, end, STEP)


@plan(
    "q_split_range_agg",
    """SELECT CAST(floor((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-02')) / 111600000000) AS BIGINT) AS chunk,
              count(*) AS n, round(sum(value), 2) AS total
       FROM events WHERE ts >= TIMESTAMP '2024-01-02' AND ts < TIMESTAMP '2024-01-29' GROUP BY 1""",
)
def q_split_range_agg(t):
    return ranges.aggregate_chunks(
        t.series, datetime(2024, 1, 2), datetime(2024, 1, 29), STEP,
        F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"),
    )


@plan("q_blobs_opt", "SELECT event_id, hex(encode(props)) AS as_blob, props AS as_text FROM events")
def q_blobs_opt(t):
    """Text columns as bytes and back."""
    blob = F.encode("props", "utf-8")
    return t.events.select("event_id", F.hex(blob).alias("as_blob"), F.decode(blob, "utf-8").alias("as_text"))

