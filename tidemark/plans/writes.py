"""Plans for table definition, writes and upkeep.

Those that test semantics only use the pure functions; those about stored tables go
through a table group in the shared folder.
"""

from datetime import datetime, timedelta

import numpy as np
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import TidemarkError
from tidemark.operators import ranges, scan, write
from tidemark.plans.joins import ANTI_SQL, UPSERT_SQL
from tidemark.plans.queries import EVENT_COLUMNS
from tidemark.plans.registry import SERIES_SQL, plain, plan, with_inputs
from tidemark.schema import TABLE, TS, ColumnInfo, ColumnType, TableSchema, nanos, quoted
from tidemark.session import scratch_path
from tidemark.sources.tables import TableGroup

NOW = datetime(2024, 2, 1)
# The batch of the truncate and append plans: a stretch of days with changed values.
LATER_SQL = """SELECT ts, event_type AS tbl, event_id, user_id, value + 1 AS value, props FROM events
               WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-13' AND event_type <> 'error'"""


def later(t):
    days = ranges.in_range(t.series, "2024-01-05", "2024-01-13").where(F.col(quoted(TABLE)) != "error")
    return days.withColumn("value", F.col("value") + 1)


def by_table(df, names):
    return {n: df.where(F.col(quoted(TABLE)) == n).drop(TABLE) for n in names}


NAMES = ("click", "error", "purchase", "signup", "view")


def stored_group(t, batch=None, names=NAMES, columns=EVENT_COLUMNS, **options):
    """A table group that holds ``batch`` (default: all events), one table per type."""
    options.setdefault("shard_size", timedelta(days=7))
    group = TableGroup(t.spark, scratch_path(t.spark, "tables"))
    group.create(*[TableSchema(n, columns, **options) for n in names])
    group.push(t.series if batch is None else batch, now=NOW)
    return group


# ---------------------------------------------------------------- definition


@plan(
    "ddl_create",
    """SELECT event_type AS tbl, count(*) AS row_count, count(DISTINCT CAST(floor(epoch(ts) / 86400) AS BIGINT)) AS shards
       FROM events GROUP BY 1""",
)
def ddl_create(t):
    """Tables with daily shards; how many shards each one fills."""
    group = stored_group(t, shard_size=timedelta(days=1), ttl=timedelta(days=90))
    from tidemark.functions.time import shard_of

    shard = shard_of(F.col(quoted(TS)), timedelta(days=1))
    return plain(
        group.read(list(NAMES)).groupBy(quoted(TABLE)).agg(
            F.count("*").alias("row_count"), F.count_distinct(shard).alias("shards")
        )
    )


@plan("ddl_create_from_df", "SELECT ts, event_id, user_id, value, props FROM events WHERE event_type = 'view'")
def ddl_create_from_df(t):
    """Schema taken from the data; the second call finds the table and leaves it."""
    views = t.series.where(F.col(quoted(TABLE)) == "view").drop(TABLE)
    group = TableGroup(t.spark, scratch_path(t.spark, "tables"))
    group.create_from("views", views, timedelta(hours=6))
    group.create_from("views", views)
    group.push({"views": views}, now=NOW)
    return plain(group.read("views"))


@plan(
    "ddl_add_columns",
    """SELECT ts, value, NULL::BIGINT AS user_id, NULL::VARCHAR AS props FROM events WHERE event_type = 'view'
       UNION ALL SELECT ts, value, user_id, props FROM events WHERE event_type = 'click'""",
)
def ddl_add_columns(t):
    """Rows written before the new columns have nulls there."""
    group = TableGroup(t.spark, scratch_path(t.spark, "tables"))
    group.create(TableSchema("grown", (ColumnInfo("value", ColumnType.DOUBLE),)))
    parts = by_table(t.series, ("view", "click"))
    group.push({"grown": parts["view"]}, now=NOW)
    group.add_columns(
        "grown", [ColumnInfo("user_id", ColumnType.INT64), ColumnInfo("props", ColumnType.SYMBOL, "props")]
    )
    group.push({"grown": parts["click"]}, now=NOW)
    return plain(group.read("grown"))


DESCRIBED = (
    ("ts", "$timestamp", "timestamp"), ("event_id", "event_id", "int64"), ("user_id", "user_id", "int64"),
    ("event_type", "event_type", "string"), ("value", "value", "double"), ("props", "props", "string"),
)


@plan(
    "ddl_describe",
    " UNION ALL ".join(
        f"""SELECT {i - 1} AS "index", '{name}' AS name, '{kind}' AS type, CAST(NULL AS VARCHAR) AS symtable, count({column}) AS points
            FROM events"""
        for i, (column, name, kind) in enumerate(DESCRIBED)
    ),
)
def ddl_describe(t):
    """Columns of a table that was made from a given table and filled with it, and how many values each holds."""
    group = TableGroup(t.spark, scratch_path(t.spark, "tables"))
    rows = t.events.withColumnRenamed("ts", TS)
    group.create_from("events", rows)
    group.push({"events": rows}, now=NOW)
    return group.describe("events", points=True)


@plan(
    "f_range_fine",
    """SELECT ts, event_id % 1000 AS nanos, event_id, value FROM events
       WHERE (ts, event_id % 1000) >= (SELECT (min(ts), 300) FROM events WHERE ts >= TIMESTAMP '2024-01-08')
         AND (ts, event_id % 1000) < (SELECT (min(ts), 700) FROM events WHERE ts >= TIMESTAMP '2024-01-15')""",
)
def f_range_fine(t):
    """A table with nanoseconds, cut at bounds that lie within a microsecond."""
    group = TableGroup(t.spark, scratch_path(t.spark, "tables"))
    group.create(TableSchema("fine", (ColumnInfo(nanos(TS), ColumnType.INT64), *EVENT_COLUMNS)))
    rows = t.events.withColumnRenamed("ts", TS).withColumn(nanos(TS), F.col("event_id") % 1000)
    group.push({"fine": rows}, now=NOW)
    first = lambda day: t.events.where(F.col("ts") >= F.lit(day).cast("timestamp_ntz")).agg(F.min("ts")).first()[0]
    low, high = (np.datetime64(first(day), "ns") + rest for day, rest in (("2024-01-08", 300), ("2024-01-15", 700)))
    found = group.read("fine", columns=["event_id", "value"], ranges=[(low, high)])
    return plain(found.withColumnRenamed(nanos(TS), "nanos"))


SYMBOLS_SQL = """WITH first_push AS (SELECT DISTINCT props FROM events WHERE ts < TIMESTAMP '2024-01-16' AND event_type IN ('click', 'view')),
    second_push AS (SELECT DISTINCT props FROM events WHERE ts >= TIMESTAMP '2024-01-16' AND event_type IN ('click', 'view')
                    AND props NOT IN (SELECT props FROM first_push WHERE props IS NOT NULL)),
    numbers AS (SELECT props, row_number() OVER (ORDER BY props) - 1 AS n FROM first_push WHERE props IS NOT NULL AND props <> ''
                UNION ALL
                SELECT props, (SELECT count(*) FROM first_push WHERE props IS NOT NULL AND props <> '')
                       + row_number() OVER (ORDER BY props) - 1 FROM second_push WHERE props IS NOT NULL AND props <> '')"""


@plan(
    "x_symbol_stored",
    SYMBOLS_SQL
    + """ SELECT event_type AS tbl, event_id, nullif(e.props, '') AS props, n AS props_id
          FROM events AS e LEFT JOIN numbers ON numbers.props = e.props WHERE event_type IN ('click', 'view')""",
)
def x_symbol_stored(t):
    """Two tables share a symbol table that grows in two pushes; numbers as stored, and the text they stand for."""
    group = TableGroup(t.spark, scratch_path(t.spark, "tables"))
    columns = (ColumnInfo("event_id", ColumnType.INT64), ColumnInfo("props", ColumnType.SYMBOL, "props"))
    group.create(TableSchema("click", columns), TableSchema("view", columns))
    rows = t.series.where(F.col(quoted(TABLE)).isin("click", "view")).select(quoted(TS), quoted(TABLE), "event_id", "props")
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    for part in (rows.where(F.col(quoted(TS)) < middle), rows.where(F.col(quoted(TS)) >= middle)):
        group.push(part, tables=["click", "view"], now=NOW)
    numbers = group.read(["click", "view"], decode=False).select(F.col("event_id").alias("_event"), F.col("props").alias("props_id"))
    texts = group.read(["click", "view"])
    joined = texts.join(numbers, F.col("event_id") == F.col("_event"))
    return joined.select(F.col(quoted(TABLE)).alias("tbl"), "event_id", "props", "props_id")


@plan("ddl_drop", f"{SERIES_SQL} WHERE event_type IN ('click', 'signup', 'view')")
def ddl_drop(t):
    group = stored_group(t)
    group.drop("error")
    group.drop("purchase")
    return plain(group.read(group.tables()))


@plan("ddl_exists", "SELECT event_type AS tbl, event_type <> 'error' AS exists, count(*) AS row_count FROM events GROUP BY 1")
def ddl_exists(t):
    """Per event type: whether its table exists after one was dropped."""
    group = stored_group(t, batch=t.series, names=NAMES)
    group.drop("error")
    counts = t.series.groupBy(quoted(TABLE)).agg(F.count("*").alias("row_count"))
    known = F.col(quoted(TABLE)).isin([n for n in NAMES if group.exists(n)])
    return plain(counts.select(quoted(TABLE), known.alias("exists"), "row_count"))


@plan("ttl_expire", f"{SERIES_SQL} WHERE ts >= TIMESTAMP '2024-01-20 07:00:00'")
def ttl_expire(t):
    """Whole shards are retired, the rest of the limit's shard is hidden on reading."""
    group = stored_group(t, ttl=timedelta(days=10), shard_size=timedelta(days=1))
    now = datetime(2024, 1, 30, 7)
    group.expire(now)
    return plain(group.read(list(NAMES), now=now))


@plan("ttl_expire_rows", f"{SERIES_SQL} WHERE ts >= TIMESTAMP '2024-01-20 07:00:00'")
def ttl_expire_rows(t):
    return plain(write.expire(t.series, datetime(2024, 1, 30, 7), timedelta(days=10)))


# ---------------------------------------------------------------- appending


@plan("w_append", f"{SERIES_SQL} UNION ALL {LATER_SQL}")
def w_append(t):
    return plain(write.append(t.series, later(t)))


@plan("w_append_fast", f"{SERIES_SQL} UNION ALL {LATER_SQL}")
def w_append_fast(t):
    group = stored_group(t)
    group.push(later(t), "fast", now=NOW)
    return plain(group.read(list(NAMES)))


@plan("w_append_async", SERIES_SQL)
def w_append_async(t):
    """A stream pushed batch by batch."""
    from tidemark.streaming.ingest import ingest

    group = TableGroup(t.spark, scratch_path(t.spark, "tables"))
    group.create(TableSchema("all", (ColumnInfo("tbl", ColumnType.SYMBOL, "types"), *EVENT_COLUMNS)))
    stream = t.stream().select(
        F.col("ts").alias(TS), F.col("event_type").alias("tbl"), "event_id", "user_id", "value", "props"
    )
    query = ingest(
        stream, group, "all", checkpoint=scratch_path(t.spark, "ingest"), name="events", available_now=True,
        mode="async", now=NOW,
    )
    query.awaitTermination()
    return plain(group.read("all"))


# ---------------------------------------------------------------- replacing


TRUNCATED_SQL = """SELECT * FROM ({series}) AS s WHERE NOT EXISTS (
    SELECT 1 FROM (SELECT min(ts) AS b, max(ts) AS e FROM ({later}) AS l) AS x WHERE s.ts >= b AND s.ts <= e)
    UNION ALL {later}""".replace("{series}", SERIES_SQL).replace("{later}", LATER_SQL)


@plan("w_truncate_implicit", TRUNCATED_SQL)
def w_truncate_implicit(t):
    """Pushed twice: the second time changes nothing."""
    once = write.truncate_implicit(t.series, later(t))
    return plain(write.truncate_implicit(once, later(t)))


@plan(
    "w_truncate_stored",
    f"""WITH b AS (SELECT * FROM ({LATER_SQL}) AS l WHERE tbl = 'click')
        SELECT ts, event_id, user_id, value, props FROM ({SERIES_SQL}) AS s
        WHERE tbl = 'click' AND NOT (ts >= (SELECT min(ts) FROM b) AND ts <= (SELECT max(ts) FROM b))
        UNION ALL SELECT ts, event_id, user_id, value, props FROM b""",
)
def w_truncate_stored(t):
    """The same on a stored table: only the shards in the extent are written again."""
    group = stored_group(t)
    batch = by_table(later(t), ["click"])
    group.push(batch, "truncate", now=NOW)
    group.push(batch, "truncate", now=NOW)
    return plain(group.read("click"))


@plan(
    "w_truncate_range",
    f"""SELECT * FROM ({SERIES_SQL}) AS s
        WHERE tbl = 'purchase' OR NOT (ts >= TIMESTAMP '2024-01-03 05:00:00' AND ts < TIMESTAMP '2024-01-20 21:00:00')
        UNION ALL SELECT * FROM ({LATER_SQL}) AS l WHERE tbl <> 'purchase'""",
)
def w_truncate_range(t):
    """Several tables; shards in the range without new rows are emptied as well."""
    group = stored_group(t)
    some = [n for n in NAMES if n != "purchase"]
    group.push(
        by_table(later(t), some), "truncate", range=(datetime(2024, 1, 3, 5), datetime(2024, 1, 20, 21)), now=NOW
    )
    return plain(group.read(list(NAMES)))


@plan(
    "w_truncate_range_rows",
    f"""SELECT * FROM ({SERIES_SQL}) AS s
        WHERE NOT (ts >= TIMESTAMP '2024-01-03 05:00:00' AND ts < TIMESTAMP '2024-01-20 21:00:00')
        UNION ALL {LATER_SQL}""",
)
def w_truncate_range_rows(t):
    return plain(write.truncate_range(t.series, later(t), "2024-01-03 05:00:00", "2024-01-20 21:00:00"))


# ---------------------------------------------------------------- deduplication


@plan("w_dedup_drop", with_inputs("stored", "batch") + "SELECT * FROM stored UNION ALL " + ANTI_SQL)
def w_dedup_drop(t):
    return write.dedup_drop(t.derived("stored"), t.derived("batch"), ["custkey", "priority"], "orderkey")


@plan("w_dedup_upsert", with_inputs("stored", "batch") + UPSERT_SQL)
def w_dedup_upsert(t):
    return write.dedup_upsert(t.derived("stored"), t.derived("batch"), ["custkey", "priority"], "orderkey")


ORDER_COLUMNS = (
    ColumnInfo("custkey", ColumnType.INT64), ColumnInfo("orderkey", ColumnType.INT64),
    ColumnInfo("price", ColumnType.DOUBLE), ColumnInfo("priority", ColumnType.SYMBOL, "priorities"),
)


def order_group(t):
    group = TableGroup(t.spark, scratch_path(t.spark, "tables"))
    group.create(TableSchema("orders", ORDER_COLUMNS, timedelta(weeks=26)))
    group.push({"orders": t.derived("stored").withColumnRenamed("ts", TS)}, now=NOW)
    return group


BY_TIME = "s.ts = b.ts AND s.custkey = b.custkey"


@plan(
    "w_dedup_drop_stored",
    with_inputs("stored", "batch")
    + f"""SELECT * FROM stored UNION ALL
          SELECT * FROM (SELECT * FROM batch QUALIFY row_number() OVER (PARTITION BY ts, custkey ORDER BY orderkey) = 1)
          AS b WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT ts, custkey FROM stored) AS s WHERE {BY_TIME})""",
)
def w_dedup_drop_stored(t):
    """Stored tables: new rows are appended, nothing is written again."""
    group = order_group(t)
    batch = t.derived("batch").withColumnRenamed("ts", TS)
    group.push({"orders": batch}, deduplicate=[TS, "custkey"], deduplication_mode="drop", seq="orderkey", now=NOW)
    return plain(group.read("orders"))


@plan(
    "w_dedup_upsert_stored",
    with_inputs("stored", "batch")
    + f"""SELECT * FROM stored AS s WHERE NOT EXISTS (
              SELECT 1 FROM (SELECT DISTINCT ts, custkey FROM batch) AS b WHERE {BY_TIME})
          UNION ALL SELECT * FROM (SELECT * FROM batch QUALIFY row_number() OVER (
              PARTITION BY ts, custkey ORDER BY orderkey DESC) = 1) AS newest""",
)
def w_dedup_upsert_stored(t):
    """Stored tables: only shards that hold a replaced row are written again."""
    group = order_group(t)
    batch = t.derived("batch").withColumnRenamed("ts", TS)
    group.push({"orders": batch}, deduplicate=[TS, "custkey"], deduplication_mode="upsert", seq="orderkey", now=NOW)
    return plain(group.read("orders"))


# ---------------------------------------------------------------- shaping


@plan("w_multi_table", f"{SERIES_SQL}")
def w_multi_table(t):
    """Five tables in one commit, handed over as a frame per table."""
    group = TableGroup(t.spark, scratch_path(t.spark, "tables"))
    group.create(*[TableSchema(n, EVENT_COLUMNS, timedelta(days=1 + i)) for i, n in enumerate(NAMES)])
    group.push(by_table(t.series, NAMES), now=NOW)
    return plain(group.read(list(NAMES)))


@plan(
    "w_align_columns",
    "SELECT ts, value, NULL::VARCHAR AS missing, user_id, props FROM events",
)
def w_align_columns(t):
    schema = TableSchema(
        "aligned",
        (
            ColumnInfo("value", ColumnType.DOUBLE), ColumnInfo("missing", ColumnType.STRING),
            ColumnInfo("user_id", ColumnType.INT64), ColumnInfo("props", ColumnType.STRING),
        ),
    )
    shuffled = t.series.select("props", "event_id", quoted(TS), "user_id", "value")
    return plain(write.align(shuffled, schema))


@plan(
    "w_infer_types",
    """SELECT ts, CAST(user_id AS BIGINT) AS user_id, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value,
              CAST(event_id AS VARCHAR) AS props FROM events""",
)
def w_infer_types(t):
    """Types from the table; ``value`` is forced through a narrower type first."""
    schema = TableSchema(
        "typed",
        (
            ColumnInfo("user_id", ColumnType.INT64), ColumnInfo("value", ColumnType.DOUBLE),
            ColumnInfo("props", ColumnType.STRING),
        ),
    )
    raw = t.series.select(
        quoted(TS), F.col("user_id").cast("string"), F.col("value").cast("string").alias("value"),
        F.col("event_id").alias("props"),
    )
    return plain(write.prepare(raw, schema, force={"value": "float"}))


CELLS_SQL = """SELECT event_id AS row_id, ts, event_type AS tbl, 'value' AS "column", CAST(event_id AS STRING) AS value
    FROM events WHERE event_type <> 'view'
    UNION ALL SELECT event_id, ts, event_type, 'props', props FROM events WHERE user_id < 100
    UNION ALL SELECT event_id, ts, event_type, 'user', CAST(user_id AS STRING) FROM events"""


def cells_of(t):
    row = ["event_id", "ts", "event_type"]
    cell = lambda name, value: F.struct(F.lit(name).alias("column"), value.cast("string").alias("value"))
    cells = F.array(
        F.when(F.col("event_type") != "view", cell("value", F.col("event_id"))),
        F.when(F.col("user_id") < 100, cell("props", F.col("props"))),
        cell("user", F.col("user_id")),
    )
    return (
        t.events.select(*row, F.explode(cells).alias("c")).where("c IS NOT NULL")
        .select(F.col("event_id").alias("row_id"), "ts", F.col("event_type").alias("tbl"), "c.*")
    )


@plan(
    "w_rows_to_columns",
    """SELECT event_id AS row_id, ts, CASE WHEN event_type <> 'view' THEN CAST(event_id AS DOUBLE) END AS value,
              CASE WHEN user_id < 100 THEN props END AS props, user_id AS "user" FROM events""",
)
def w_rows_to_columns(t):
    kinds = {"value": T.DoubleType(), "props": T.StringType(), "user": T.LongType()}
    return write.rows_to_columns(cells_of(t), kinds, by=["row_id", "ts"])


@plan(
    "w_flat_columns",
    """SELECT event_id AS row_id, ts, event_type AS tbl,
              CASE WHEN event_type <> 'view' THEN event_id END AS value, user_id AS "user" FROM events""",
)
def w_flat_columns(t):
    """One flat list of (table, column) cells for several tables."""
    flat = cells_of(t).where(F.col("column") != "props")
    return write.rows_to_columns(flat, {"value": T.LongType(), "user": T.LongType()}, by=["row_id", "ts", "tbl"])


@plan("w_idempotent_retry", SERIES_SQL)
def w_idempotent_retry(t):
    """A batch pushed again under the same id adds nothing."""
    group = TableGroup(t.spark, scratch_path(t.spark, "tables"))
    group.create(*[TableSchema(n, EVENT_COLUMNS, timedelta(days=7)) for n in NAMES])
    first = group.push(t.series, batch_id="load-1", now=NOW)
    again = group.push(t.series, batch_id="load-1", now=NOW)
    assert first == again
    return plain(group.read(list(NAMES)))


@plan("maint_compact", f"{SERIES_SQL} UNION ALL {LATER_SQL}")
def maint_compact(t):
    """Rows of two versions per shard end up in one; nothing else changes."""
    group = stored_group(t)
    group.push(later(t), now=NOW)
    group.compact(["click", "view"])
    group.compact()
    return plain(group.read(list(NAMES)))


@plan(
    "w_change_log",
    f"""SELECT TIMESTAMP '2024-02-01' AS log_ts, CAST(2 AS BIGINT) AS transaction_id, event_type AS "table",
               min(ts) AS begin, max(ts) AS "end" FROM events GROUP BY event_type
        UNION ALL SELECT TIMESTAMP '2024-02-01', 3, tbl, min(ts), max(ts) FROM ({LATER_SQL}) AS l GROUP BY tbl""",
)
def w_change_log(t):
    """Every push logs the inclusive extent of each table it wrote."""
    group = stored_group(t)
    group.push(later(t), now=NOW)
    return group.changes()


# ---------------------------------------------------------------- checks


def outcomes(t, cases):
    """Run each case over the given tables: its row count, or the name of its error."""
    rows = []
    for name, run in cases:
        try:
            rows.append((name, None, run().count()))
        except (TidemarkError, TypeError, AnalysisException, ParseException) as error:
            rows.append((name, type(error).__name__, None))
    return t.spark.createDataFrame(rows, "option string, error string, row_count bigint")


@plan(
    "w_dedup_validate",
    with_inputs("stored", "batch")
    + """, n AS (SELECT count(*) AS c FROM stored)
    SELECT 'mode' AS option, 'InvalidArgument' AS error, CAST(NULL AS BIGINT) AS row_count
    UNION ALL SELECT 'column', 'InvalidArgument', NULL
    UNION ALL SELECT 'kind', 'TypeError', NULL
    UNION ALL SELECT 'time', NULL, c + (SELECT count(DISTINCT ts) FROM batch WHERE ts NOT IN (SELECT ts FROM stored)) FROM n
    UNION ALL SELECT 'list', NULL, c + (SELECT count(DISTINCT custkey) FROM batch
                                        WHERE custkey NOT IN (SELECT custkey FROM stored)) FROM n""",
)
def w_dedup_validate(t):
    """Which deduplication options are refused, and what the accepted ones give."""
    stored = t.derived("stored").withColumnRenamed("ts", TS)
    batch = t.derived("batch").withColumnRenamed("ts", TS)
    columns = ["custkey", "orderkey", "price", "priority"]

    def run(deduplicate, mode="drop"):
        keys = write.dedup_keys(deduplicate, mode, columns)
        return write.dedup_drop(stored, batch, keys, "orderkey")

    return outcomes(
        t,
        [
            ("mode", lambda: run(True, "merge")), ("column", lambda: run(["no_such_column"])),
            ("kind", lambda: run("custkey")), ("time", lambda: run(TS)), ("list", lambda: run(["custkey"])),
        ],
    )


@plan(
    "w_cardinality_check",
    """SELECT 'rows' AS option, CAST(NULL AS VARCHAR) AS error, count(*) AS row_count FROM events
       UNION ALL SELECT 'nothing', 'InvalidArgument', NULL
       UNION ALL SELECT 'no_index', 'InvalidArgument', NULL""",
)
def w_cardinality_check(t):
    """A push needs rows and a time index."""
    schema = TableSchema("events", EVENT_COLUMNS)

    def run(df):
        shaped = write.prepare(df, schema)
        write.check_batch([shaped])
        return shaped

    return outcomes(
        t,
        [
            ("rows", lambda: run(t.series)), ("nothing", lambda: run(ranges.in_range(t.series, "2030-01-01", "2031-01-01"))),
            ("no_index", lambda: run(t.series.drop(TS))),
        ],
    )


@plan(
    "q_errors",
    """SELECT 'good' AS option, CAST(NULL AS VARCHAR) AS error, count(*) AS row_count FROM events
       UNION ALL SELECT 'empty', 'ParseException', NULL
       UNION ALL SELECT 'syntax', 'ParseException', NULL
       UNION ALL SELECT 'table', 'AnalysisException', NULL
       UNION ALL SELECT 'column', 'AnalysisException', NULL
       UNION ALL SELECT 'tag', 'AliasNotFound', NULL""",
)
def q_errors(t):
    """Kinds of error that bad queries on a given table end with."""
    sql = lambda text: lambda: t.spark.sql(text, events=t.events)
    return outcomes(
        t,
        [
            ("good", sql("SELECT * FROM {events}")), ("empty", sql("")), ("syntax", sql("SELEC * FROM {events}")),
            ("table", sql("SELECT * FROM no_such_table")), ("column", sql("SELECT no_such_column FROM {events}")),
            ("tag", lambda: scan.scan_tagged(t.series, t.tags, ["no such tag"])),
        ],
    )
