"""Which sides of a join are broadcast: rows, bytes, and how often they are evaluated."""

import pytest
from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import kv, tags, write
from tidemark.session import measured, small_side

NOW = "2024-01-01"


@pytest.fixture
def wide(spark):
    """2,000 values of 100 KB: few rows, many bytes."""
    return spark.range(2000).select("id", F.repeat(F.lit("x"), 100_000).alias("value"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_measure(spark, wide):
    rows, size = measured(wide)
    assert rows == 2000 and 200_000_000 <= size <= 201_000_000
    nested = spark.sql("SELECT array('abc', NULL) AS a, map('k', 1) AS m, struct('xy' AS s, 1.5D AS d) AS t, X'00' AS b")
    assert measured(nested)[0] == 1 and 50 <= measured(nested)[1] <= 300
    assert measured(nested.where("false")) == (0, 0)


def test_bytes_count_as_well_as_rows(spark, wide):
    narrow = spark.range(2000)
    assert small_side(narrow)[1] == 2000
    assert small_side(wide)[1] is None
    assert small_side(narrow, max_rows=1999)[1] is None
    assert small_side(wide, max_bytes=10**9)[1] == 2000


def test_no_limit_through_one_task(spark, monkeypatch, tmp_path):
    """A side is evaluated once, by all its tasks, whether or not it turns out to be small."""
    tasks = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            tasks.add(batch.num_rows)
            yield batch

    for top in (10, 3000):
        before = tasks.value
        side, rows = small_side(spark.range(0, 3000, 1, 8).mapInArrow(seen, "id long"), max_rows=top)
        assert (rows is None) == (top == 10)
        assert side.count() == 3000 and tasks.value - before == 3000


def test_sides_known_to_be_huge_are_left_alone(spark, monkeypatch, inputs):
    monkeypatch.setattr(session, "checkpoint", lambda df: pytest.fail("evaluated"))
    huge = inputs.table("lineitem")
    assert small_side(huge, max_bytes=100) == (huge, None)


def test_large_values_are_shuffled(spark, wide):
    table = spark.range(0, 4000, 2).select(
        F.col("id").alias("key"), F.lit("old").alias("value"), F.lit(NOW).cast("timestamp_ntz").alias("modified_at"),
        F.lit(None).cast("timestamp_ntz").alias("expires_at"),
    )
    asked = wide.withColumnRenamed("id", "key")
    for op in (kv.put, kv.update, kv.get_and_update):
        new, result = op(table, asked, NOW)
        assert "BroadcastHashJoin" not in plan_of(new) and "GlobalLimit" not in plan_of(new)
    swapped = kv.compare_and_swap(table, asked.withColumn("comparand", F.lit("old")), NOW)[0]
    assert "BroadcastHashJoin" not in plan_of(swapped)
    assert swapped.where("octet_length(value) = 100000").count() == 1000
    small = kv.update(table, asked.limit(3), NOW)[0]
    assert "BroadcastHashJoin" in plan_of(small)


def test_whole_rows_that_are_too_large(spark, wide):
    """The batch is not sent to the stored rows; what is stored may still be small."""
    kept = write.without_stored(wide.where("id < 10"), wide)
    assert "LeftSemi" not in plan_of(kept) and kept.count() == 1990
    assert "LeftSemi" in plan_of(write.without_stored(wide, wide.where("id < 10")))


def test_scratch_can_be_cleared(spark, monkeypatch):
    monkeypatch.setattr(session, "_scratch", [])
    paths = [session.scratch_path(spark, "mine") for _ in range(3)]
    for path in paths[:2]:
        spark.range(3).write.parquet(path)
    assert session.clear_scratch(spark) == 2 and session._scratch == []
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(paths[0])
    assert session.clear_scratch(spark) == 0


def test_rows_behind_tags_are_combined_before_they_meet_many_keys(spark):
    """A frequent alias is made of many rows, which must not all go to one task of the join."""
    rows = spark.range(20_000).select(F.when(F.col("id") % 4 == 0, None).otherwise("hot").alias("alias"), (F.col("id") % 3).alias("n"))
    made = rows.select("alias", F.lit("t").alias("entry_type"), F.concat(F.lit("a"), "n").alias("tag")).union(
        rows.select(F.concat("alias", "n"), F.lit("t"), F.lit("b"))
    ).distinct()
    asked = spark.range(210_000).select(F.concat(F.lit("x"), "id").alias("alias"), F.lit("b").alias("tag")).union(
        spark.sql("SELECT a, t FROM VALUES ('hot'), ('hot'), ('hot1'), (NULL) AS n(a), VALUES ('a0'), ('b'), (NULL) AS m(t)")
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64m")  # the planner underestimates the keys
    try:
        got, had = tags.tags_of(made, asked), tags.has_tag(made, asked)
        left, gone = tags.detach(made, asked)
        plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (got, had, left)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for plan in plans:
        assert plan.rindex("Join") < plan.rindex("Aggregate") < plan.rindex("Union")
    assert sorted(map(tuple, got.collect())) == [("hot", "a0"), ("hot", "a1"), ("hot", "a2"), ("hot1", "b")]
    true = [("hot", "a0")] * 2 + [("hot1", "b")]
    assert sorted((r.alias, r.tag) for r in had.where("has_tag").collect()) == true and had.count() == asked.count()
    assert sorted((r.alias, r.tag) for r in gone.where("changed").collect()) == sorted(set(true))
    none = [(r.alias, r.tag) for r in left.where("alias IS NULL").collect()]
    assert sorted(none) == [(None, "a0"), (None, "a1"), (None, "a2"), (None, "b")]
    assert sorted((r.alias, r.tag) for r in left.where("alias IS NOT NULL").collect()) == [
        ("hot", "a1"), ("hot", "a2"), ("hot0", "b"), ("hot2", "b"),
    ]
