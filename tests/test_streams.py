"""Continuous queries, subscription and ingest."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.errors import InvalidArgument
from tidemark.schema import TABLE, TS, ColumnInfo, ColumnType, TableSchema
from tidemark.session import scratch_path
from tidemark.sources.tables import TableGroup
from tidemark.streaming.continuous import continuous
from tidemark.streaming.ingest import ingest
from tidemark.streaming.subscribe import follow, needed_ranges, subscribe, to_folder

START = datetime(2024, 1, 1)


@pytest.fixture
def source(spark):
    folder = scratch_path(spark, "source")

    def add(*numbers):
        spark.createDataFrame([(n,) for n in numbers], "n bigint").coalesce(1).write.mode("append").parquet(folder)

    add(1, 2)
    return spark.readStream.schema("n bigint").parquet(folder), add


def test_new_and_probe(spark, source):
    stream, add = source
    running = continuous(stream, lambda d: d.where("n > 1"), mode="new", folder=scratch_path(spark, "q"), pace="100 milliseconds")
    try:
        assert [r.n for r in running.results(60).collect()] == [2]
        assert running.probe() is None
        for more in ((5, 6), (7,)):  # two deliveries before anyone reads
            add(*more)
            running.query.processAllAvailable()
        assert sorted(r.n for r in running.results(60).collect()) == [5, 6, 7]
        add(0)  # brings nothing: the last delivery stays
        running.query.processAllAvailable()
        assert running.probe() is None
        assert sorted(r.n for r in running.latest().collect()) == [7]
        with pytest.raises(TimeoutError):
            running.results(0.5)
    finally:
        running.stop()
    with pytest.raises(StopIteration):
        running.results()


@pytest.mark.parametrize("grouped", [True, False])
def test_full(spark, source, grouped):
    stream, add = source
    fn = (lambda d: d.groupBy().agg(F.sum("n").alias("n"))) if grouped else (lambda d: d.where("n <> 2"))
    folder = scratch_path(spark, "q")
    for more, want in (((), [3] if grouped else [1]), ((4,), [7] if grouped else [1, 4])):
        if more:
            add(*more)
        running = continuous(stream, fn, mode="full", folder=folder, available_now=True)
        running.query.awaitTermination()
        assert sorted(r.n for r in running.latest().collect()) == want


def test_full_of_rows_writes_new_rows_only(spark, source):
    """Each delivery of a plain selection writes what its micro-batch brought."""
    stream, add = source
    folder = scratch_path(spark, "q")
    for k in range(4):
        running = continuous(stream, lambda d: d.where("n <> 2").selectExpr("n * 10 AS m"), mode="full", folder=folder, available_now=True)
        running.query.awaitTermination()
        assert sorted(r.m for r in running.probe().collect()) == [10, *range(100, 100 + 10 * k, 10)]
        add(10 + k)
    found = spark.read.parquet(f"{folder}/results")
    assert sorted(r["count"] for r in found.groupBy("epoch").count().collect()) == [1, 1, 1, 1]
    assert not os.path.exists(f"{folder.removeprefix('file:')}/rows")


def test_full_of_anything_else_starts_from_all_rows(spark, source):
    stream, add = source
    latest = lambda d: d.orderBy(F.desc("n")).limit(1) if not d.isStreaming else d.join(d.sparkSession.range(9), F.col("n") == F.col("id"))
    folder = scratch_path(spark, "q")
    for want in ([2], [7]):
        running = continuous(stream, latest, mode="full", folder=folder, available_now=True)
        running.query.awaitTermination()
        assert [r.n for r in running.latest().collect()] == want
        add(7)


def test_a_misspelt_column_is_an_error_at_once(spark, source):
    stream, _ = source
    for mode in ("full", "new"):
        with pytest.raises(AnalysisException, match="nn"):
            continuous(stream, lambda d: d.where("nn > 1"), mode=mode, folder=scratch_path(spark, "q"))


def test_errors_reach_the_reader_once(spark, source):
    """A delivery fails; the next call raises that, and the one after it gets the delivery."""
    stream, add = source
    switch = scratch_path(spark, "switch").removeprefix("file:")

    @F.udf("bigint")
    def checked(n):
        if not os.path.exists(switch):
            raise ValueError("broken on purpose")
        return n

    running = continuous(stream, lambda d: d.select(checked("n").alias("n")), mode="new", folder=scratch_path(spark, "q"), pace="100 milliseconds")
    try:
        with pytest.raises(Exception, match="broken on purpose"):
            running.results(60)
        os.mkdir(switch)
        while True:  # the restarted query may have failed once more meanwhile
            try:
                found = running.results(60)
                break
            except Exception as error:  # noqa: BLE001
                assert "broken on purpose" in str(error)
        assert sorted(r.n for r in found.collect()) == [1, 2]
    finally:
        running.stop()
    with pytest.raises(InvalidArgument):
        continuous(stream, lambda d: d, mode="some", folder="x")


def test_subscription_resumes(spark):
    group, out, state = TableGroup(spark, scratch_path(spark, "g")), scratch_path(spark, "out"), scratch_path(spark, "c")
    group.create(TableSchema("t", (ColumnInfo("v", ColumnType.INT64),)), TableSchema("u", (ColumnInfo("v", ColumnType.INT64),)))
    rows = lambda *vs: spark.createDataFrame([(START + timedelta(hours=v), v) for v in vs], f"`{TS}` timestamp_ntz, v bigint")
    for hour, batch in enumerate(((5, 7), (1, 2), (6,))):
        group.push({"t": rows(*batch), "u": rows(100)}, now=START + timedelta(hours=hour))
        subscribe(group, "t", to_folder(out), checkpoint=state, available_now=True).awaitTermination()
    got = sorted((r.transaction_id, r.v) for r in spark.read.parquet(out).collect())
    # Transactions 2 to 4; 6 lies inside the first one's span but was not there yet.
    assert got == [(2, 5), (2, 7), (3, 1), (3, 2), (4, 6)]


def test_late_log_lines(spark):
    """Lines hours and days behind the newest are delivered, each once."""
    group, out, state = TableGroup(spark, scratch_path(spark, "g")), scratch_path(spark, "out"), scratch_path(spark, "c")
    group.create(TableSchema("t", (ColumnInfo("v", ColumnType.INT64),)))
    for v, hour in enumerate((5, 6, 1, 7, -240)):
        row = spark.createDataFrame([(START + timedelta(hours=v), v)], f"`{TS}` timestamp_ntz, v bigint")
        group.push({"t": row}, now=START + timedelta(hours=hour))
        subscribe(group, "t", to_folder(out), checkpoint=state, available_now=True).awaitTermination()
    assert sorted((r.transaction_id, r.v) for r in spark.read.parquet(out).collect()) == [(2 + v, v) for v in range(5)]


LOG = "log_ts timestamp_ntz, transaction_id bigint, table string, begin timestamp_ntz, end timestamp_ntz"


@pytest.fixture
def change_log(spark):
    folder = scratch_path(spark, "log")

    def add(*lines):
        rows = [(START + timedelta(days=day), number, "t", START, START + timedelta(days=1)) for day, number in lines]
        spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(folder)

    add((0, 0))
    return spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(folder), add


def test_a_repeated_epoch_finds_the_same_lines(spark, change_log):
    """The first run fails while it delivers; nothing is lost, and nothing comes twice later."""
    log, add = change_log
    rows = lambda ranges: spark.createDataFrame([(START, "t")], f"`{TS}` timestamp_ntz, `{TABLE}` string")
    state, seen, broken = scratch_path(spark, "c"), [], [True]

    def deliver(df, epoch):
        found = [(epoch, r.transaction_id) for r in df.collect()]
        if broken and epoch == 1:
            broken.pop()
            raise RuntimeError("no delivery")
        seen.extend(found)

    add((0, 0), (0, 1), (-300, 2))
    for _ in range(2):
        query = follow(log, rows, deliver, checkpoint=state, table="t", available_now=True)
        try:
            query.awaitTermination()
        except Exception as error:  # noqa: BLE001
            assert "no delivery" in str(error)
    add((0, 1), (9, 3), (-300, 2))
    follow(log, rows, deliver, checkpoint=state, table="t", available_now=True).awaitTermination()
    assert sorted(seen) == [(0, 0), (1, 1), (1, 2), (2, 3)]


def test_many_epochs_leave_no_folders(spark, change_log):
    """Folders next to a subscription do not grow with its epochs: lines are keys of a state store."""
    log, add = change_log
    rows = lambda ranges: spark.createDataFrame([(START, "t")], f"`{TS}` timestamp_ntz, `{TABLE}` string")
    state, seen, counts = scratch_path(spark, "c"), [], []
    for block in range(3):
        for k in range(6):
            add((k % 2, 6 * block + k))
        deliver = lambda df, epoch: seen.extend(r.transaction_id for r in df.collect())
        follow(log, rows, deliver, checkpoint=state, table="t", available_now=True).awaitTermination()
        root = state.removeprefix("file:")
        counts.append(sum(len(folders) for _, folders, _ in os.walk(root)))
    assert sorted(seen) == list(range(18)) and counts[0] == counts[1] == counts[2]
    assert not os.path.exists(f"{root}-delivered")


def test_needed_ranges(spark):
    spans = spark.createDataFrame([(START, START + timedelta(hours=h)) for h in (1, 1, 2)], "begin timestamp_ntz, end timestamp_ntz")
    assert sorted(tuple(r) for r in needed_ranges(spans).collect()) == [
        (START, START + timedelta(hours=1, seconds=1)), (START, START + timedelta(hours=2, seconds=1))
    ]


def test_ingest_repeats_no_batch(spark, source):
    stream, add = source
    group = TableGroup(spark, scratch_path(spark, "g"))
    group.create(TableSchema("t", (ColumnInfo("n", ColumnType.INT64),)))
    timed = stream.select(F.lit(START).cast("timestamp_ntz").alias(TS), "n")
    # A second run without the first one's checkpoint repeats epoch 0.
    for _ in range(2):
        ingest(timed, group, "t", checkpoint=scratch_path(spark, "c"), name="job", available_now=True).awaitTermination()
    assert sorted(r.n for r in group.read("t").collect()) == [1, 2]
