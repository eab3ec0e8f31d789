"""Range operators against brute force, on rows at the very ends of ranges."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.errors import InvalidArgument
from tidemark.operators import ranges
from tidemark.schema import SHARD, TABLE, TS

START = datetime(2024, 1, 1)
US = timedelta(microseconds=1)


def plan_of(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def rows(spark):
    """A third of all rows share one time; others lie around powers of 16."""
    rng = random.Random(3)
    times = [START + timedelta(hours=5)] * 200
    times += [START + timedelta(microseconds=rng.choice([0, 1, 15, 16, 17, 255, 256, 4096])) for _ in range(80)]
    times += [START + timedelta(microseconds=rng.randrange(10**rng.randint(1, 12))) for _ in range(320)]
    data = [(t, rng.choice("ab"), i) for i, t in enumerate(times)]
    return spark.createDataFrame(data, f"`{TS}` timestamp_ntz, `{TABLE}` string, id int").cache(), data


@pytest.fixture(scope="module")
def spans():
    """Ranges of very different lengths, overlapping, adjacent, empty, and ending at rows."""
    rng = random.Random(4)
    out = [(START, START), (START, START + 16 * US), (START + 16 * US, START + 17 * US)]
    out += [(START + timedelta(hours=4), START + timedelta(hours=5))]
    for _ in range(150):
        begin = START + timedelta(microseconds=rng.randrange(10**rng.randint(1, 12)))
        out.append((begin, begin + timedelta(microseconds=rng.choice([1, 2, 15, 16, 17, 10**5, 10**7, 10**9]))))
    return out


@pytest.mark.parametrize("broadcast_rows", [0, 100_000])
def test_range_set(spark, rows, spans, broadcast_rows):
    df, data = rows
    sides = spark.createDataFrame(spans, "begin timestamp_ntz, end timestamp_ntz")
    found = ranges.in_range_set(df, sides, broadcast_rows=broadcast_rows)
    want = sorted(i for t, _, i in data if any(b <= t < e for b, e in spans))
    assert sorted(r.id for r in found.collect()) == want
    assert 0 < len(want) < len(data)
    assert "NestedLoop" not in plan_of(found) and "Cartesian" not in plan_of(found)


def test_empty_range_set(spark, rows):
    none = spark.createDataFrame([], "begin timestamp_ntz, end timestamp_ntz")
    assert ranges.in_range_set(rows[0], none).count() == 0


@pytest.mark.parametrize("broadcast_rows", [0, 100_000])
def test_replay(spark, rows, spans, broadcast_rows):
    df, data = rows
    log = [(START + timedelta(days=i % 3), i, "ab"[i % 2], b, e) for i, (b, e) in enumerate(spans)]
    log += log[:40]  # repeated lines count once
    columns = "log_ts timestamp_ntz, transaction_id bigint, table string, begin timestamp_ntz, end timestamp_ntz"
    found = ranges.replay(spark.createDataFrame(log, columns), df, broadcast_rows=broadcast_rows)
    want = sorted(
        (tx, i) for _, tx, table, b, e in set(log) for t, name, i in data if name == table and b <= t <= e
    )
    assert sorted((r.transaction_id, r.id) for r in found.collect()) == want
    assert "NestedLoop" not in plan_of(found)


def test_replay_emits_reused_ids_at_a_later_time(spark, rows):
    df, data = rows
    log = [(START, 1, "a", START, START), (START + US, 1, "a", START, START)]
    columns = "log_ts timestamp_ntz, transaction_id bigint, table string, begin timestamp_ntz, end timestamp_ntz"
    found = ranges.replay(spark.createDataFrame(log, columns), df).count()
    assert found == 2 * sum(1 for t, name, _ in data if name == "a" and t == START)


def test_literal_ranges(rows):
    df, data = rows
    wanted = [(START, START + 16 * US), (START + 10 * US, START + 20 * US), (START, START)]
    got = ranges.in_ranges(df, wanted)
    assert got.count() == sum(1 for t, _, _ in data if any(b <= t < e for b, e in wanted))
    assert ranges.in_ranges(df, []).count() == len(data)
    closed = ranges.in_range(df, START, START + 16 * US, closed=True).count()
    assert closed == sum(1 for t, _, _ in data if START <= t <= START + 16 * US)


def test_shards_are_pruned(spark, rows, tmp_path):
    from tidemark.functions.time import shard_of

    day = timedelta(hours=1)
    path = str(tmp_path / "sharded")
    rows[0].withColumn(SHARD, shard_of(F.col(f"`{TS}`"), day)).write.partitionBy(SHARD).parquet(path)
    stored = spark.read.parquet(path)
    got = ranges.in_range(stored, START, START + timedelta(hours=1), shard_size=day)
    assert f"PartitionFilters: [isnotnull({SHARD}" in plan_of(got)
    assert got.count() == ranges.in_range(rows[0], START, START + timedelta(hours=1)).count()


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
@pytest.mark.parametrize("delta", [timedelta(hours=1), timedelta(hours=7), timedelta(days=2), timedelta(days=1)])
def test_split_range(spark, delta, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        _split_range(spark, delta)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _split_range(spark, delta):
    end = START + timedelta(days=1)
    want, at = [], START
    while at < end:
        want.append((at, min(at + delta, end)))
        at += delta
    got = [(r.begin, r.end) for r in ranges.split_range(spark, START, end, delta).orderBy("chunk").collect()]
    assert got == want
    assert ranges.split_range(spark, end, START, delta).count() == 0


def test_split_range_needs_a_positive_step(spark):
    with pytest.raises(InvalidArgument):
        ranges.split_range(spark, START, START + US, timedelta(0))
