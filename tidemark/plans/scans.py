"""Plans for scans, sources, predicates, ordering and set operations."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.functions.nulls import is_null_value, normalise
from tidemark.functions.time import shard_of
from tidemark.operators import ranges, running, scan, tags, write
from tidemark.operators.kv import alive
from tidemark.plans.registry import SERIES_SQL, plain, plan, with_inputs
from tidemark.schema import TABLE, TS, quoted
from tidemark.session import scratch_path
from tidemark.sources.frames import from_pandas, to_pandas, write_frames
from tidemark.sources.minutes_csv import name_map, read_minutes, table_name_of, ticker_tags
from tidemark.sources.tables import TableGroup

DAY = timedelta(days=1)
# Adjacent, overlapping and empty ranges.
RANGES = [
    ("2024-01-05", "2024-01-06"),
    ("2024-01-06", "2024-01-07 12:00:00"),
    ("2024-01-06 10:00:00", "2024-01-06 20:00:00"),
    ("2024-01-20 06:30:00", "2024-01-21"),
    ("2024-02-10", "2024-02-10"),
]
RANGES_SQL = " OR ".join(f"(ts >= TIMESTAMP '{b}' AND ts < TIMESTAMP '{e}')" for b, e in RANGES)


@plan("scan_table", "SELECT ts, event_id, user_id, value, props FROM events WHERE event_type = 'click'")
def scan_table(t):
    return plain(scan.scan_table(t.series, "click"))


@plan("scan_multi_table", f"{SERIES_SQL} WHERE event_type IN ('click', 'purchase', 'view')")
def scan_multi_table(t):
    return plain(scan.scan_tables(t.series, ["click", "purchase", "view"]))


@plan("scan_project", "SELECT ts, event_type AS tbl, value, user_id FROM events")
def scan_project(t):
    return plain(scan.project(t.series, ["value", "user_id"]))


@plan("scan_ranges", f"{SERIES_SQL} WHERE {RANGES_SQL}")
def scan_ranges(t):
    return plain(ranges.in_ranges(t.series, RANGES))


@plan(
    "scan_ranges_join",
    f"""{SERIES_SQL} WHERE EXISTS (
        SELECT 1 FROM events AS r WHERE r.event_type = 'error'
        AND events.ts >= r.ts AND events.ts < r.ts + to_minutes(CAST(1 + r.user_id % 40 AS INTEGER)))""",
)
def scan_ranges_join(t):
    """Rows within some minutes after any error: as many ranges as there are errors."""
    after = t.events.where("event_type = 'error'").select(
        F.col("ts").alias("begin"),
        F.expr("ts + make_dt_interval(0, 0, CAST(1 + user_id % 40 AS INT), 0)").alias("end"),
    )
    return plain(ranges.in_range_set(t.series, after))


@plan(
    "scan_batches",
    f"""SELECT (row_number() OVER (ORDER BY ts, event_id) - 1) // 4096 AS batch_id, *
        FROM ({SERIES_SQL}) AS s""",
)
def scan_batches(t):
    return plain(running.batches(t.series, 4096, [TS, "event_id"]))


@plan(
    "scan_concat",
    f"""SELECT tbl, count(*) AS row_count, count(DISTINCT event_id) AS ids,
               min(ts) AS first_ts, max(ts) AS last_ts FROM ({SERIES_SQL}) AS s GROUP BY tbl""",
)
def scan_concat(t):
    """All batches of a read, and an empty read, put together again."""
    whole = running.batches(t.series, 1000, [TS, "event_id"]).drop("batch_id")
    empty = ranges.in_range(t.series, "2030-01-01", "2030-01-01")
    return plain(
        whole.unionByName(empty)
        .groupBy(quoted(TABLE))
        .agg(
            F.count("*").alias("row_count"),
            F.count_distinct("event_id").alias("ids"),
            F.min(quoted(TS)).alias("first_ts"),
            F.max(quoted(TS)).alias("last_ts"),
        )
    )


DAILY_SQL = """SELECT event_type AS tbl, date_trunc('day', ts)::TIMESTAMP AS ts, count(*) AS n
               FROM events GROUP BY 1, 2"""


def _daily(t):
    return t.series.groupBy(quoted(TABLE), F.date_trunc("day", quoted(TS)).cast("timestamp_ntz").alias(TS)).agg(
        F.count("*").alias("n")
    )


@plan("source_pandas", DAILY_SQL)
def source_pandas(t):
    """A small result leaves as a frame and comes back."""
    return plain(from_pandas(t.spark, to_pandas(_daily(t))))


@plan("sink_pandas", DAILY_SQL)
def sink_pandas(t):
    """A result per table is written from frames, with the tables made to fit, and read back."""
    daily = to_pandas(_daily(t))
    group = TableGroup(t.spark, scratch_path(t.spark, "tables"))
    frames = {str(name): part.drop(columns=TABLE) for name, part in daily.groupby(TABLE)}
    write_frames(group, frames, create=True, now=datetime(2024, 2, 1))
    return plain(group.read(list(frames)))


TICKER_SQL = """CASE event_type WHEN 'click' THEN 'aapl' WHEN 'view' THEN 'ibm' WHEN 'error' THEN 'trv'
                WHEN 'purchase' THEN 'jnj' ELSE 'zzz' END"""
NAMES_SQL = """CASE event_type WHEN 'click' THEN 'stocks.apple' WHEN 'view' THEN 'stocks.ibm'
               WHEN 'error' THEN 'stocks.travelers_companies' WHEN 'purchase' THEN 'stocks.johnson_and_johnson'
               ELSE 'stocks.zzz' END"""


@plan(
    "source_csv_minutes",
    f"""SELECT {NAMES_SQL} AS tbl, {TICKER_SQL} AS ticker, date_trunc('minute', ts)::TIMESTAMP AS ts,
               arg_min(value, ts) AS open, max(value) AS high, min(value) AS low, arg_max(value, ts) AS close,
               count(*) AS volume
        FROM events GROUP BY event_type, date_trunc('minute', ts)""",
)
def source_csv_minutes(t):
    """Minute bars written as CSV, one folder per ticker, and imported from there."""
    bars = t.events.groupBy(
        F.expr(TICKER_SQL).alias("ticker"), F.date_trunc("minute", "ts").cast("timestamp_ntz").alias(TS)
    ).agg(
        F.min_by("value", "ts").alias("open"),
        F.max("value").alias("high"),
        F.min("value").alias("low"),
        F.max_by("value", "ts").alias("close"),
        F.count("*").alias("volume"),
    )
    folder = scratch_path(t.spark, "minutes")
    bars.write.partitionBy("ticker").csv(folder)
    return plain(read_minutes(t.spark, folder, ticker=F.regexp_extract("_metadata.file_path", "ticker=([^/]+)", 1)))


@plan(
    "source_csv_tags",
    f"""WITH s AS (SELECT DISTINCT {NAMES_SQL} AS alias, {TICKER_SQL} AS ticker FROM events)
        SELECT alias, 'table' AS entry_type, ticker AS tag FROM s
        UNION SELECT alias, 'table', unnest(['dji', 'usd']) FROM s WHERE ticker <> 'zzz'
        UNION SELECT alias, 'table', 'nyse' FROM s WHERE ticker IN ('ibm', 'jnj', 'trv')
        UNION SELECT alias, 'table', 'nasdaq' FROM s WHERE ticker = 'aapl'""",
)
def source_csv_tags(t):
    tickers = t.events.select(F.expr(TICKER_SQL).alias("ticker"))
    return ticker_tags(tickers.select("ticker", table_name_of(F.col("ticker")).alias(TABLE)))


# ---------------------------------------------------------------- predicates


@plan("f_time_range", f"{SERIES_SQL} WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15'")
def f_time_range(t):
    return plain(ranges.in_range(t.series, datetime(2024, 1, 8), datetime(2024, 1, 15)))


@plan(
    "f_range_inclusive",
    """WITH s AS (SELECT event_type, min(ts) AS b, max(ts) AS e FROM events
                  WHERE ts < TIMESTAMP '2024-01-10' GROUP BY 1)
       SELECT events.ts, event_type AS tbl, event_id, user_id, value, props FROM events JOIN s USING (event_type)
       WHERE ts >= b AND ts <= e""",
)
def f_range_inclusive(t):
    """Both ends are rows of the table, and both are in the result."""
    early = ranges.in_range(t.series, "2000-01-01", "2024-01-10")
    spans = early.groupBy(F.col(quoted(TABLE)).alias("table")).agg(
        F.min(quoted(TS)).alias("begin"), F.max(quoted(TS)).alias("end"),
        F.max(quoted(TS)).alias("log_ts"), F.max("event_id").alias("transaction_id"),
    )
    return plain(ranges.replay(spans, t.series).drop("log_ts", "transaction_id"))


@plan("f_eq", f"{SERIES_SQL} WHERE user_id = 7 AND event_type = 'view'")
def f_eq(t):
    return plain(t.series.where((F.col("user_id") == 7) & (F.col(quoted(TABLE)) == "view")))


ALIASES_SQL = "(SELECT c_name AS alias FROM customer UNION ALL SELECT DISTINCT p_name FROM part)"


def _aliases(t):
    return (
        t.table("customer").select(F.col("c_name").alias("alias"))
        .unionByName(t.table("part").select(F.col("p_name").alias("alias")).distinct())
    )


@plan("f_prefix", f"SELECT alias FROM {ALIASES_SQL} WHERE starts_with(alias, 'Customer#0000001') ORDER BY alias LIMIT 25")
def f_prefix(t):
    return tags.by_affix(_aliases(t), prefix="Customer#0000001", limit=25)


@plan("f_suffix", f"SELECT alias FROM {ALIASES_SQL} WHERE suffix(alias, ' gear') ORDER BY alias LIMIT 5")
def f_suffix(t):
    return tags.by_affix(_aliases(t), suffix=" gear", limit=5)


@plan("f_entry_type", with_inputs("tags") + "SELECT DISTINCT alias FROM tags WHERE entry_type = 'integer'")
def f_entry_type(t):
    return tags.find(t.tags, entry_type="integer")


@plan(
    "f_is_null",
    with_inputs("clean")
    + """SELECT event_id, the_double IS NULL AS the_double, the_int64 IS NULL AS the_int64,
                the_string IS NULL AS the_string, the_ts IS NULL AS the_ts,
                the_string IS NULL AS the_blob FROM clean""",
)
def f_is_null(t):
    dirty = t.derived("dirty").withColumn("the_blob", F.encode("the_string", "utf-8"))
    names = ["the_double", "the_int64", "the_string", "the_ts", "the_blob"]
    return dirty.select(
        "event_id", *[is_null_value(F.col(n), dirty.schema[n].dataType).alias(n) for n in names]
    )


@plan(
    "f_not_expired",
    with_inputs("kv") + "SELECT * FROM kv WHERE expires_at IS NULL OR expires_at > TIMESTAMP '2024-01-30 20:00:00'",
)
def f_not_expired(t):
    return alive(t.derived("kv"), datetime(2024, 1, 30, 20))


# ---------------------------------------------------------------- order and limits


@plan("s_sort_on_write", f"SELECT *, CAST(floor(epoch(ts) / 86400) AS BIGINT) AS _shard FROM ({SERIES_SQL}) AS s")
def s_sort_on_write(t):
    return plain(write.sort_for_write(t.series, shard_of(F.col(quoted(TS)), DAY), "event_id"))


@plan("s_time_order_read", f"{SERIES_SQL} ORDER BY ts, event_id")
def s_time_order_read(t):
    return plain(scan.ordered(t.series, "event_id"))


@plan(
    "s_stable_sort",
    """SELECT row_number() OVER (ORDER BY date_trunc('day', ts), event_id) - 1 AS pos,
              event_id, date_trunc('day', ts)::TIMESTAMP AS day FROM events""",
)
def s_stable_sort(t):
    """Sort permutation over times with very many ties; input order decides those."""
    days = t.events.select("event_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"))
    return running.row_index(days, ["day", "event_id"], "pos")


@plan("s_limit", f"{SERIES_SQL} ORDER BY ts DESC, event_id DESC LIMIT 17")
def s_limit(t):
    return plain(scan.newest(t.series, [F.col(quoted(TS)).desc(), F.col("event_id").desc()], 17))


# ---------------------------------------------------------------- set operations


@plan(
    "u_union_tables",
    """SELECT ts, 'prices' AS tbl, value, NULL::BIGINT AS user_id FROM events WHERE event_type = 'purchase'
       UNION ALL SELECT ts, 'visits', NULL, user_id FROM events WHERE event_type <> 'purchase'""",
)
def u_union_tables(t):
    kind = t.series[quoted(TABLE)]
    prices = t.series.where(kind == "purchase").select(quoted(TS), "value")
    visits = t.series.where(kind != "purchase").select(quoted(TS), "user_id")
    return plain(scan.union_tables({"prices": prices, "visits": visits}))


@plan(
    "u_tag_intersect",
    with_inputs("tags") + "SELECT alias FROM tags WHERE tag = 'en' INTERSECT SELECT alias FROM tags WHERE tag = 'web'",
)
def u_tag_intersect(t):
    return tags.intersect(t.tags, "en", "web")


@plan(
    "u_except_dups",
    with_inputs("stored", "batch")
    + """, b AS (SELECT ts, custkey, priority FROM batch), s AS (SELECT DISTINCT ts, custkey, priority FROM stored)
       SELECT b.* FROM b WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.ts = b.ts AND s.custkey = b.custkey
              AND s.priority IS NOT DISTINCT FROM b.priority)""",
)
def u_except_dups(t):
    columns = ["ts", "custkey", "priority"]
    return write.without_stored(t.derived("stored").select(columns), t.derived("batch").select(columns))


@plan(
    "j_name_map",
    f"""SELECT event_id, {TICKER_SQL} AS ticker,
               CASE event_type WHEN 'click' THEN 'apple' WHEN 'view' THEN 'ibm'
               WHEN 'error' THEN 'travelers companies inc' WHEN 'purchase' THEN 'johnson and johnson'
               ELSE 'zzz' END AS company FROM events""",
)
def j_name_map(t):
    from tidemark.sources.minutes_csv import COMPANIES

    mapping = t.spark.createDataFrame(sorted(COMPANIES.items()), "ticker string, company string")
    return name_map(t.events.select("event_id", F.expr(TICKER_SQL).alias("ticker")), "ticker", mapping)


@plan(
    "x_shard",
    """SELECT event_id, CAST(floor(epoch_us(ts) / 86400000000) AS BIGINT) AS day_shard,
              epoch_us(ts) // 1000 AS ms_shard, epoch_us(ts) // (52 * 7 * 86400000000) AS year_shard FROM events""",
)
def x_shard(t):
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        shard_of(ts, DAY).alias("day_shard"),
        shard_of(ts, timedelta(milliseconds=1)).alias("ms_shard"),
        shard_of(ts, timedelta(weeks=52)).alias("year_shard"),
    )


@plan("w_normalise_nulls", with_inputs("clean") + "SELECT * FROM clean")
def w_normalise_nulls(t):
    dirty = t.derived("dirty")
    return dirty.select(*[normalise(F.col(f.name), f.dataType).alias(f.name) for f in dirty.schema.fields])
