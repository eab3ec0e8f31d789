"""Query surface: errors, indexes, projection, tags."""

from datetime import datetime

import pytest
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import functions as F

from tidemark.errors import AliasNotFound, InvalidArgument
from tidemark.operators import agg, scan, tags, write
from tidemark.schema import INDEX, TABLE, TS, ColumnInfo, ColumnType, TableSchema


def test_bad_queries(spark, inputs):
    inputs.events.createOrReplaceTempView("some_events")
    for text, error in [
        ("", ParseException), ("selec 1", ParseException), ("select * from no_such_table", AnalysisException),
        ("select no_such_column from some_events", AnalysisException),
    ]:
        with pytest.raises(error):
            scan.validate(spark, text)
    got = scan.validate(spark, "select event_id, value from some_events").orderBy("position").collect()
    assert [(r.name, r.type) for r in got] == [("event_id", "bigint"), ("value", "double")]


def test_unknown_tags(inputs):
    with pytest.raises(AliasNotFound):
        scan.scan_tagged(inputs.series, inputs.tags, ["no such tag"])
    with pytest.raises(AliasNotFound):
        scan.scan_tagged(inputs.series, inputs.tags, ["web", "no such tag"])
    with pytest.raises(InvalidArgument):
        tags.find(inputs.tags)


def test_result_index(inputs):
    df = inputs.series
    assert scan.result_index(df, "value").columns[0] == "value"
    assert scan.result_index(df, 0).columns == df.columns
    assert scan.result_index(df, 2).columns[0] == "event_id"
    assert scan.result_index(df, order_by=[TS, "event_id"]).columns[0] == INDEX
    with pytest.raises(KeyError):
        scan.result_index(df, "nope")
    with pytest.raises(TypeError):
        scan.result_index(df, 1.5)
    with pytest.raises(ValueError, match="nulls"):
        scan.result_index(df.withColumn("value", F.when(F.col("value") > 1, F.col("value"))), "value")


def test_projection(inputs):
    assert scan.project(inputs.series, ["value", "event_id"]).columns == [TS, TABLE, "value", "event_id"]
    assert scan.project(inputs.series, []).columns == scan.project(inputs.series).columns == inputs.series.columns
    with pytest.raises(TypeError):
        scan.project(inputs.series, "value")
    with pytest.raises(TypeError):
        scan.scan_tables(inputs.series, "click")


def test_only_asked_columns_are_read(inputs):
    plan = scan.project(inputs.series, ["value"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in plan


def test_sum_ignores_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (1.5,), (None,), (2.0,)], "v double")
    row = agg.agg_all(df, ["v"]).first()
    assert (row["count(v)"], row["sum(v)"]) == (2, 3.5)


def test_bars_with_equal_times(spark):
    at = datetime(2024, 1, 1, 0, 0, 30)
    rows = [(at, 5.0, 2), (at, 7.0, 1), (at, 6.0, 3), (at, None, 0), (at.replace(minute=1), 1.0, 4)]
    df = spark.createDataFrame(rows, f"`{TS}` timestamp_ntz, p double, seq int")
    got = [tuple(r) for r in agg.ohlc(df, "p", seq="seq").orderBy("bar").collect()]
    minute = at.replace(second=0)
    assert got == [(minute, 7.0, 7.0, 5.0, 6.0), (minute.replace(minute=1), 1.0, 1.0, 1.0, 1.0)]


def test_null_profile_of_no_rows(inputs):
    none = inputs.series.where("false")
    assert {r.state for r in agg.null_profile(none).collect()} == {"none_null"}


def test_cells_set_twice(spark):
    cells = spark.createDataFrame([(1, "a", "1"), (1, "a", "2")], "row int, column string, value string")
    from pyspark.sql import types as T

    with pytest.raises(Exception, match="set twice"):
        write.rows_to_columns(cells, {"a": T.LongType()}, by=["row"]).collect()


def test_null_keys_are_equal(spark):
    old = spark.createDataFrame([(None, 1), (2, 2)], "k int, v int")
    new = spark.createDataFrame([(None, 10), (3, 30), (None, 11)], "k int, v int")
    drop = write.dedup_drop(old, new, ["k"], "v")
    assert sorted(drop.collect(), key=str) == sorted([(None, 1), (2, 2), (3, 30)], key=str)
    upsert = write.dedup_upsert(old, new, ["k"], "v")
    assert sorted(upsert.collect(), key=str) == sorted([(2, 2), (3, 30), (None, 11)], key=str)


@pytest.mark.parametrize("small", [True, False])
def test_hot_keys_are_cut_before_the_shuffle(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(write, "small_side", lambda df, *_: (df, None))
        monkeypatch.setattr(write, "checked_broadcast", lambda df, *_: df)
    hot = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    old = spark.range(0, 20_000, 2).select(F.col("id").alias("k"), (-F.col("id")).alias("v"))
    fresh = write.dedup_new_rows(old, hot, ["k"], "v")
    assert "WindowGroupLimit" in fresh._jdf.queryExecution().executedPlan().toString()
    want = {}
    for i in range(20_000):
        want.setdefault(0 if i % 3 == 0 else i, i)
    assert sorted((r.k, r.v) for r in fresh.collect()) == sorted((k, v) for k, v in want.items() if k % 2)


def test_align_needs_the_time_index(spark):
    with pytest.raises(InvalidArgument):
        write.align(spark.range(1), TableSchema("t", (ColumnInfo("id", ColumnType.INT64),)))


def test_values_under_null_do_not_fail_a_cast(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), ""), (datetime(2024, 1, 1), "4")], f"`{TS}` timestamp_ntz, n string")
    got = write.cast_to(df, TableSchema("t", (ColumnInfo("n", ColumnType.INT64),)))
    assert [r.n for r in got.collect()] == [None, 4]


def test_affixes(spark):
    names = spark.createDataFrame([(n,) for n in ("b_x", "a_x", "a_y", "c%x")], "alias string")
    found = lambda **k: [r.alias for r in tags.by_affix(names, **k).collect()]
    assert found(prefix="a_", limit=5) == ["a_x", "a_y"]
    assert found(suffix="_x", limit=1) == ["a_x"]
    assert found(prefix="c%") == ["c%x"]
    assert tags.count_affix(names, prefix="zz").first().matches == 0
