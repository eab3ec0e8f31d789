"""CSV minutes and pandas."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.errors import InvalidArgument
from tidemark.schema import INDEX, TABLE, TS, ColumnInfo, ColumnType, nanos
from tidemark.session import scratch_path
from tidemark.sources.frames import (
    from_pandas, iter_arrow, iter_pandas, query_frame, read_frame, stream_frames, to_pandas, write_frames,
)
from tidemark.sources.minutes_csv import read_minutes, ticker_tags
from tidemark.sources.tables import TableGroup


def test_csv_files_by_ticker(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "AAPL.csv").write_text("2024-01-01 00:00:00,1.0,2.0,0.5,1.5,10\n2024-01-01 00:01:00,1.5,2.0,1.0,,20\n")
    (tmp_path / "sub" / "ko.csv").write_text("2024-01-01 00:00:00,5.0,6.0,4.0,5.5,7\n")
    rows = read_minutes(spark, str(tmp_path))
    got = sorted((r.ticker, r[TABLE], r.open, r.close, r.volume) for r in rows.where("open <> 1.5").collect())
    assert got == [("aapl", "stocks.apple", 1.0, 1.5, 10), ("ko", "stocks.coca_cola", 5.0, 5.5, 7)]
    assert rows.where("close IS NULL").count() == 1
    tags = {(r.alias, r.tag) for r in ticker_tags(rows).collect()}
    assert tags == {("stocks.apple", t) for t in ("aapl", "dji", "usd", "nasdaq")} | {
        ("stocks.coca_cola", t) for t in ("ko", "dji", "usd", "nyse")
    }


def test_broken_csv(spark, tmp_path):
    (tmp_path / "ibm.csv").write_text("2024-01-01 00:00:00,not a number,2,3,4,5\n")
    with pytest.raises(Exception, match="MALFORMED"):
        read_minutes(spark, str(tmp_path)).collect()


def test_pandas_round_trip(spark):
    index = pd.DatetimeIndex(np.datetime64("2022-09-08T12:00:00") + np.arange(1000).astype("timedelta64[s]"))
    frame = pd.DataFrame({"val": np.r_[np.full(500, np.nan), np.full(500, 1.11)], "n": np.arange(1000)}, index=index)
    df = from_pandas(spark, frame)
    assert df.schema[TS].dataType.typeName() == "timestamp_ntz"
    back = to_pandas(df.orderBy(f"`{TS}`"))
    assert back.index.name == TS and (back.index == index).all()
    np.testing.assert_array_equal(back["val"].to_numpy(), frame["val"].to_numpy())


@pytest.mark.parametrize("size", [1, 56, 224, 10_000])
def test_frames_of_a_read(inputs, size):
    df = inputs.series.where("event_id < 500").select(f"`{TS}`", "event_id")
    frames = list(iter_pandas(df, size, "event_id"))
    assert all(0 < len(f) <= size for f in frames)
    assert [i for f in frames for i in f["event_id"]] == [r.event_id for r in df.orderBy(f"`{TS}`", "event_id").collect()]
    assert list(iter_pandas(df.where("false"), size)) == []


def test_times_keep_microseconds(spark):
    frame = pd.DataFrame({"at": [datetime(2024, 1, 1, 0, 0, 0, 7)]}, index=pd.DatetimeIndex(["2024-01-01 00:00:00.000009"]))
    row = from_pandas(spark, frame).select(F.col("at"), F.col(f"`{TS}`").alias("ts")).first()
    assert row.at.microsecond == 7 and row.ts.microsecond == 9


def test_frames_into_tables(spark):
    group = TableGroup(spark, scratch_path(spark, "frames"))
    index = pd.DatetimeIndex(["2019-02-02", "2019-02-01"])
    stocks = pd.DataFrame({"open": [3.5, 3.4], "volume": [7500, 10000], "raw": [b"b", b"a"], "note": ["y", None]}, index=index)
    with pytest.raises(InvalidArgument):
        write_frames(group, {"stocks": stocks}, shard_size=timedelta(hours=1))
    write_frames(group, {"stocks": stocks, "copy": stocks[["open"]]}, create=True, shard_size=timedelta(hours=1))
    frame = read_frame(group, "stocks")
    assert frame.index.name == TS and list(frame["volume"]) == [10000, 7500]
    assert list(frame["note"]) == [None, "y"] and bytes(frame["raw"].iloc[0]) == b"a"
    assert [len(f) for f in stream_frames(group, ["stocks", "copy"], size=3)] == [3, 1]
    assert read_frame(group, "stocks", ranges=[("2030-01-01", "2031-01-01")]).empty
    group.register()
    total = query_frame(spark, "select sum(volume) as total from stocks")
    assert total.index.name == INDEX and total["total"].iloc[0] == 17500
    by_time = query_frame(spark, f"select `{TS}`, `{TABLE}`, open from stocks", index=TS)
    assert by_time.index.name == TS and set(by_time[TABLE]) == {"stocks"}


def test_sparse_integers_stay_integers(spark):
    group = TableGroup(spark, scratch_path(spark, "frames"))
    index = pd.date_range("2024-01-01", periods=3, freq="s")
    frame = pd.DataFrame({"n": pd.array([2**60 + 1, None, 3], dtype="Int64")}, index=index)
    write_frames(group, {"t": frame}, create=True)
    assert [r.n for r in group.read("t").orderBy(f"`{TS}`").collect()] == [2**60 + 1, None, 3]


@pytest.fixture
def fine():
    """8,192 rows one nanosecond apart, in any order, with a time column that is as fine."""
    steps = np.random.default_rng(3).permutation(8192)
    index = pd.DatetimeIndex(np.datetime64("2024-01-01T00:00:00.000000000") + steps.astype("timedelta64[ns]"))
    seen = pd.Series(index + pd.Timedelta(7, "ns"))
    seen[::5] = pd.NaT
    return pd.DataFrame({"n": steps, "seen": seen.to_numpy()}, index=index)


def same_frames(found, expected):
    expected = expected.sort_index()
    assert found.index.dtype == "datetime64[ns]" and (found.index == expected.index).all()
    assert list(found["n"]) == list(expected["n"])
    assert found["seen"].isna().equals(expected["seen"].isna())
    assert (found["seen"].dropna().to_numpy() == expected["seen"].dropna().to_numpy()).all()


def test_nanoseconds_come_back(spark, fine):
    group = TableGroup(spark, scratch_path(spark, "frames"))
    write_frames(group, {"t": fine}, create=True)
    same_frames(read_frame(group, "t"), fine)
    same_frames(pd.concat(list(stream_frames(group, "t", size=1000))), fine)
    assert read_frame(group, "t", columns=["n"]).columns.tolist() == ["n"]
    low, high = fine.index.min() + pd.Timedelta(1500, "ns"), np.datetime64("2024-01-01T00:00:00.000002003")
    part = read_frame(group, "t", ranges=[(low, high)])
    assert list(part["n"]) == list(range(1500, 2003))
    both = read_frame(group, "t", ranges=[(low, high), (low + pd.Timedelta(9, "ns"), high + pd.Timedelta(9, "ns"))])
    assert list(both["n"]) == list(range(1500, 2012))


def test_nanoseconds_tell_rows_apart(spark, fine):
    """Deduplication and truncating go by whole times."""
    group = TableGroup(spark, scratch_path(spark, "frames"))
    write_frames(group, {"t": fine[fine["n"] < 4000]}, create=True)
    write_frames(group, {"t": fine}, deduplicate=TS)
    same_frames(read_frame(group, "t"), fine)
    newer = fine[fine["n"].between(100, 2999)].assign(n=lambda f: f["n"] + 10_000)
    write_frames(group, {"t": newer}, deduplicate=[TS], deduplication_mode="upsert")
    expected = pd.concat([fine[~fine["n"].between(100, 2999)], newer])
    same_frames(read_frame(group, "t"), expected)
    few = fine[fine["n"].isin([1001, 7100])]
    for _ in range(2):
        write_frames(group, {"t": few}, mode="truncate")
        same_frames(read_frame(group, "t"), pd.concat([expected[(expected.index < few.index.min()) | (expected.index > few.index.max())], few]))
    begin = fine.index.min()
    write_frames(group, {"t": few[:1]}, mode="truncate", range=(begin + pd.Timedelta(10, "ns"), begin + pd.Timedelta(8190, "ns")))
    assert len(read_frame(group, "t")) == 10 + 2 + 1


def test_tables_of_microseconds_refuse_finer_times(spark, fine):
    group = TableGroup(spark, scratch_path(spark, "frames"))
    write_frames(group, {"t": fine.set_index(fine.index.floor("s"))[["n"]][:3]}, create=True)
    with pytest.raises(InvalidArgument, match="finer"):
        write_frames(group, {"t": fine[["n"]]})
    group.add_columns("t", [ColumnInfo(nanos(TS), ColumnType.INT64)])
    write_frames(group, {"t": fine[["n"]]})
    assert len(read_frame(group, "t")) == 3 + 8192
    assert from_pandas(spark, fine[["n"]].set_index(fine.index.floor("us"))).columns == [TS, "n"]


def test_arrow_tables_of_a_read(inputs):
    df = inputs.series.where("event_id < 700")
    tables = list(iter_arrow(df, 100, "event_id"))
    assert [t.num_rows for t in tables[:-1]] == [100] * (len(tables) - 1) and 0 < tables[-1].num_rows <= 100
    order = [tuple(r) for r in df.orderBy(f"`{TS}`", "event_id").collect()]
    assert [tuple(r.values()) for t in tables for r in t.to_pylist()] == order


def test_index_by_offset(spark):
    frame = query_frame(spark, "SELECT 5 AS a, 9 AS b", index=1)
    assert frame.index.tolist() == [9] and frame.index.name == "b" and list(frame.columns) == ["a"]
