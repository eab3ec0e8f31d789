"""Plans for continuous queries, subscriptions and ingest.

Each one drives a stream over a given table to its end and returns what arrived.
"""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.operators import agg
from tidemark.plans.joins import REPLAY_SQL, change_log
from tidemark.plans.queries import EVENT_COLUMNS
from tidemark.plans.registry import plain, plan, with_inputs
from tidemark.schema import TABLE, TS, ColumnInfo, ColumnType, TableSchema, quoted
from tidemark.session import scratch_path
from tidemark.sources.tables import TableGroup
from tidemark.streaming.continuous import continuous
from tidemark.streaming.ingest import ingest
from tidemark.streaming.subscribe import follow, subscribe, to_folder, unseen

NOW = datetime(2024, 2, 1)
TOTALS_SQL = "SELECT event_type, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS users FROM events GROUP BY event_type"


def totals(df):
    return df.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("user_id").alias("users"))


def chosen(df):
    return df.where("event_type <> 'view'").select("ts", "event_type", "event_id", "value")


CHOSEN_SQL = "SELECT ts, event_type, event_id, value FROM events WHERE event_type <> 'view'"


def in_pieces(t, df, pieces=3):
    """``df`` as a stream of several micro-batches."""
    folder = scratch_path(t.spark, "stream")
    df.repartition(pieces).write.parquet(folder)
    return t.spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def finished(t, stream, fn, mode, number=None):
    running = continuous(stream, fn, mode=mode, folder=scratch_path(t.spark, "query"), available_now=True)
    running.query.awaitTermination()
    return running.probe(number)


@plan("st_continuous_full", TOTALS_SQL)
def st_continuous_full(t):
    return finished(t, in_pieces(t, t.events), totals, "full")


@plan("st_continuous_full_rows", CHOSEN_SQL)
def st_continuous_full_rows(t):
    """A plain selection: the last delivery has the rows of all micro-batches."""
    return finished(t, in_pieces(t, t.events), chosen, "full")


@plan("st_continuous_new", CHOSEN_SQL)
def st_continuous_new(t):
    """Several deliveries that nobody reads meanwhile: all of them are there."""
    return finished(t, in_pieces(t, t.events), chosen, "new")


@plan("st_pace", TOTALS_SQL)
def st_pace(t):
    """A running query with a pace; stopped once all input was delivered."""
    running = continuous(
        t.stream(), totals, mode="full", folder=scratch_path(t.spark, "query"), pace="200 milliseconds"
    )
    running.query.processAllAvailable()
    running.stop()
    return running.latest()


@plan("st_latest_snapshot", TOTALS_SQL)
def st_latest_snapshot(t):
    """Three deliveries happen before anyone reads: only the last one is seen, once."""
    running = continuous(
        in_pieces(t, t.events), totals, mode="full", folder=scratch_path(t.spark, "query"), available_now=True
    )
    running.query.awaitTermination()
    latest = running.probe()
    assert running.probe() is None
    return latest


@plan("st_stop", TOTALS_SQL)
def st_stop(t):
    """Reading goes on until the stopped query has nothing new."""
    running = continuous(t.stream(), totals, mode="full", folder=scratch_path(t.spark, "query"), pace="200 milliseconds")
    running.query.processAllAvailable()
    running.stop()
    return [result for result in running][-1]


def log_folder(t, folder, log):
    log.repartition(2).write.mode("append").parquet(folder)
    return t.spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def delivered(t, out, like):
    columns = ["log_ts", "transaction_id", *like.columns]
    return t.spark.read.parquet(out).select(*[quoted(c) for c in columns])


@plan("st_subscribe", REPLAY_SQL)
def st_subscribe(t):
    """The whole change log, with every line twice, followed to its end."""
    log, out = change_log(t), scratch_path(t.spark, "delivered")
    stream = log_folder(t, scratch_path(t.spark, "log"), log.unionByName(log))
    query = follow(
        stream, lambda ranges: t.series, to_folder(out), checkpoint=scratch_path(t.spark, "follow"), available_now=True
    )
    query.awaitTermination()
    return plain(delivered(t, out, t.series))


@plan("st_checkpoint", REPLAY_SQL)
def st_checkpoint(t):
    """The subscription ends half-way and a second one takes over from its checkpoint."""
    log, out = change_log(t), scratch_path(t.spark, "delivered")
    folder, state = scratch_path(t.spark, "log"), scratch_path(t.spark, "follow")
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    for part in (log.where(F.col("log_ts") < middle), log.where(F.col("log_ts") >= middle)):
        stream = log_folder(t, folder, part)
        query = follow(stream, lambda ranges: t.series, to_folder(out), checkpoint=state, available_now=True)
        query.awaitTermination()
    return plain(delivered(t, out, t.series))


@plan("st_seen_set", with_inputs("changes") + "SELECT DISTINCT log_ts, transaction_id, table_name FROM changes")
def st_seen_set(t):
    """A change log that is written twice, the second time half a log later: each line comes once."""
    log, out, state = change_log(t), scratch_path(t.spark, "seen"), scratch_path(t.spark, "state")
    folder = scratch_path(t.spark, "log")
    for _ in range(2):  # the second query knows what the first one has seen
        query = (
            unseen(log_folder(t, folder, log)).writeStream.option("checkpointLocation", state)
            .trigger(availableNow=True).foreachBatch(to_folder(out)).start()
        )
        query.awaitTermination()
    return t.spark.read.parquet(out).select("log_ts", "transaction_id", F.col("table").alias("table_name"))


@plan("st_late_data", "SELECT ts, event_id, user_id, value, props FROM events")
def st_late_data(t):
    """Old rows that arrive after newer ones, and log lines that are days late, are delivered all the same."""
    group, out = TableGroup(t.spark, scratch_path(t.spark, "tables")), scratch_path(t.spark, "delivered")
    group.create(TableSchema("late", EVENT_COLUMNS, timedelta(days=7)))
    state = scratch_path(t.spark, "follow")
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    rows = t.series.drop(TABLE)
    for hour, part in enumerate((rows.where(F.col(quoted(TS)) >= middle), rows.where(F.col(quoted(TS)) < middle))):
        group.push({"late": part}, now=NOW - timedelta(days=9 * hour))
        subscribe(group, "late", to_folder(out), checkpoint=state, available_now=True).awaitTermination()
    return plain(delivered(t, out, group.read("late")).drop("log_ts", "transaction_id"))


@plan("st_async_ingest", "SELECT max(ts) AS ts, user_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id")
def st_async_ingest(t):
    """A stream of several micro-batches upserted into a table: the last row per user stays."""
    group = TableGroup(t.spark, scratch_path(t.spark, "tables"))
    columns = (ColumnInfo("user_id", ColumnType.INT64), ColumnInfo("value", ColumnType.DOUBLE))
    group.create(TableSchema("users", columns, timedelta(weeks=8)))
    rows = t.events.select(F.col("ts").alias(TS), "user_id", "value", "event_id")
    folder = scratch_path(t.spark, "stream")
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    state = scratch_path(t.spark, "ingest")
    for part in (rows.where(F.col(quoted(TS)) < middle), rows.where(F.col(quoted(TS)) >= middle)):
        part.coalesce(1).write.mode("append").parquet(folder)
        stream = t.spark.readStream.schema(rows.schema).parquet(folder)
        ingest(
            stream, group, "users", checkpoint=state, name="users", available_now=True,
            deduplicate=["user_id"], deduplication_mode="upsert", seq="event_id", now=NOW,
        ).awaitTermination()
    return plain(group.read("users"))


@plan(
    "st_ohlc",
    """SELECT event_type, date_trunc('minute', ts)::TIMESTAMP AS bar,
              first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
              last(value ORDER BY ts, event_id) AS close, CAST(sum(user_id) AS BIGINT) AS volume
       FROM events GROUP BY 1, 2""",
)
def st_ohlc(t):
    """Minute bars on a stream. There is no watermark: prices may be as late as they like, and bars stay state."""
    def bars(stream):
        timed = stream.withColumn("time", F.col("ts").cast("timestamp"))
        made = agg.ohlc(timed, "value", "user_id", by=["event_type"], ts="time", seq="event_id")
        return made.withColumn("bar", F.col("bar").cast("timestamp_ntz"))

    found = finished(t, in_pieces(t, t.events, 4), bars, "new", "delivery")
    newest = F.max_by(F.struct("open", "high", "low", "close", "volume"), "delivery").alias("b")
    return found.groupBy("event_type", "bar").agg(newest).select("event_type", "bar", "b.*")

