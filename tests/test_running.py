"""Running values, positions and replay against brute force, with one dominant group."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import oplog, trace
from tidemark.operators.running import batches, chunk_bounds, group_position, in_chunks, prefix_scan, row_index
from tidemark.plans import aggregates, keyed
from tidemark.schema import TS


@pytest.fixture(scope="module")
def skewed(spark):
    """Group 'hot' holds most rows; order has gaps and starts below zero."""
    rng = random.Random(7)
    rows, at = [], {"hot": -500, "a": 0, "b": 3}
    for _ in range(3000):
        group = rng.choices(["hot", "a", "b"], [8, 1, 1])[0]
        at[group] += rng.randint(1, 4)
        rows.append((group, at[group], rng.choice([None, 1, 2, 5])))
    return spark.createDataFrame(rows, "g string, o bigint, v bigint").cache(), sorted(rows, key=lambda r: (r[0], r[1]))


@pytest.mark.parametrize("limit", [50, 1000, 10_000_000])
def test_prefix_scan(skewed, limit):
    df, rows = skewed
    scanned = prefix_scan(
        df, ["g"], "o", sums={"s": F.col("v")}, lasts={"l": F.col("v")}, previous={"p": F.col("v")}, limit=limit
    )
    got = sorted((r.g, r.o, r.s, r.l, r.p) for r in scanned.collect())
    want, state = [], {}
    for g, o, v in rows:
        total, last = state.get(g, (None, None))
        before = last
        if v is not None:
            total, last = (total or 0) + v, v
        state[g] = (total, last)
        want.append((g, o, total, last, before))
    assert [tuple(x) for x in got] == sorted(want)


def uneven(kind):
    """Rows (g, o): one hot group next to a single row, a far outlier, or a burst."""
    hot = {
        "sparse": [i * 1_000_000 for i in range(4000)],
        "outlier": [*range(4000), 10**15],
        "burst": [*range(0, 10**9, 10**6), *range(5 * 10**8 + 1, 5 * 10**8 + 3001)],
    }[kind]
    return [("hot", o) for o in hot] + [("one", 7)] + [(None, o) for o in range(30)]


@pytest.mark.parametrize("kind", ["sparse", "outlier", "burst"])
def test_chunks_hold_equally_many_rows(spark, kind):
    limit, rows = 100, uneven(kind)
    df = spark.createDataFrame(rows, "g string, o bigint")
    bounds = chunk_bounds(df, ["g"], "o", limit)
    sizes = in_chunks(df, ["g"], "o", bounds).groupBy("g", "_chunk").count().collect()
    hot = [r["count"] for r in sizes if r.g == "hot"]
    assert sum(hot) == sum(g == "hot" for g, _ in rows)
    assert max(hot) <= 2 * limit and len(hot) <= 1.2 * sum(hot) / limit + 1
    assert {(r.g, r["count"]) for r in sizes if r.g != "hot"} == {("one", 1), (None, 30)}
    order = sorted(in_chunks(df, ["g"], "o", bounds).where("g = 'hot'").select("o", "_chunk").collect())
    assert [r._chunk for r in order] == sorted(r._chunk for r in order)
    got = {(r.g, r.o): r.pos for r in group_position(df, ["g"], "o", limit=limit).collect()}
    for group in ("hot", "one", None):
        own = sorted(o for g, o in rows if g == group)
        assert [got[group, o] for o in own] == list(range(1, len(own) + 1))


def test_no_bounds_for_moderate_groups(spark):
    df = spark.createDataFrame(uneven("sparse"), "g string, o bigint")
    assert chunk_bounds(df, ["g"], "o", 5000) is None
    assert chunk_bounds(df.limit(0), ["g"], "o", 5) is None


@pytest.mark.parametrize("limit", [64, 10_000_000])
def test_group_position(skewed, limit):
    df, rows = skewed
    got = {(r.g, r.o): r.pos for r in group_position(df, ["g"], "o", limit=limit).collect()}
    seen = {}
    for g, o, _ in rows:
        seen[g] = seen.get(g, 0) + 1
        assert got[g, o] == seen[g]


def test_row_index_and_batches(inputs):
    numbered = row_index(inputs.series, [TS, "event_id"]).select("`$index`", "event_id").collect()
    order = [r.event_id for r in inputs.events.orderBy("ts", "event_id").select("event_id").collect()]
    assert [r.event_id for r in sorted(numbered, key=lambda r: r[0])] == order
    for size in (1, 7, 300, 10_000):
        parts = batches(inputs.series, size, [TS, "event_id"]).groupBy("batch_id").count().collect()
        counts = [r["count"] for r in sorted(parts, key=lambda r: r.batch_id)]
        assert sum(counts) == len(order)
        assert all(n == size for n in counts[:-1]) and 0 < counts[-1] <= size
    assert batches(inputs.series, 0, [TS, "event_id"]).select("batch_id").distinct().count() == 1


@pytest.mark.parametrize("limit", [20, 333])
def test_positions_in_stretches(spark, inputs, limit, capsys):
    """One time holds a third of the rows, some have none; values are not written anywhere."""
    third = F.when(F.col("event_id") % 3 == 0, F.lit("2024-01-01 06:00").cast("timestamp_ntz"))
    time = third.when(F.col("event_id") % 17 == 1, None).otherwise(F.col(TS))
    rows = inputs.series.withColumn(TS, time).repartition(7)
    numbered = row_index(rows, [TS, "event_id"], limit=limit)
    first, again = (sorted((r["$index"], r.event_id, r.value) for r in numbered.collect()) for _ in range(2))
    order = rows.orderBy(TS, "event_id").select("event_id", "value").collect()
    assert first == again == [(i, r.event_id, r.value) for i, r in enumerate(order)]
    assert batches(rows, 100, [TS, "event_id"], limit).groupBy("batch_id").count().where("count > 100").isEmpty()
    capsys.readouterr()
    numbered.explain("formatted")
    text = capsys.readouterr().out
    kept = [line for line in text.split("\n\n") if "Scan ExistingRDD" in line]
    assert kept and not any("value" in part or "props" in part for part in kept)


def test_row_index_of_equal_times(spark):
    df = spark.range(500).select(F.lit("2024-01-01").cast("timestamp_ntz").alias(TS), F.col("id").alias("seq"))
    got = sorted((r["$index"], r.seq) for r in row_index(df, [TS, "seq"]).collect())
    assert got == [(i, i) for i in range(500)]


@pytest.mark.parametrize("limit", [40, 1_000_000])
def test_flamegraph_does_not_depend_on_the_limit(inputs, limit):
    rows = aggregates.trace_of(inputs).withColumn("profile", F.lit("one"))
    lines = [r.line for r in trace.flamegraph(rows, limit).orderBy("seq").collect()]
    stack, open_at, want = ["one"], {}, []
    for r in rows.orderBy("seq").collect():
        if r.label.endswith("_starts"):
            name = r.label[:-7]
            stack.append(f"{stack[-1]};{name}")
            open_at[name] = r.ns
        elif r.label.endswith("_ends"):
            want.append(f"{stack.pop()} {r.ns - open_at.pop(r.label[:-5])}")
    assert lines == want


def test_flamegraph_of_deep_stacks(spark, capsys):
    """Depth 200, twice; the plan does not widen with it."""
    rows = []
    for profile in ("a", "b"):
        order = [*((f"op{d}", "starts") for d in range(200)), *((f"op{d}", "ends") for d in reversed(range(200)))]
        rows += [(profile, seq, f"{op}_{edge}", seq * 10) for seq, (op, edge) in enumerate(order)]
    df = spark.createDataFrame(rows, "profile string, seq bigint, label string, ns bigint")
    flames = trace.flamegraph(df)
    got = {(r.profile, r.seq): (r.stack, r.ns) for r in flames.collect()}
    assert len(got) == 400
    for d in (0, 1, 57, 199):
        stack = ";".join(["b", *(f"op{k}" for k in range(d + 1))])
        assert got["b", 399 - d] == (stack, (399 - 2 * d) * 10)
    sizes = []
    for part in (df, df.where("seq IN (0, 1, 398, 399)")):
        again = trace.flamegraph(part)
        capsys.readouterr()
        again.explain("formatted")
        sizes.append(len(capsys.readouterr().out))
    assert sizes[0] <= 1.1 * sizes[1]


@pytest.mark.parametrize("kind", ["bigint", "double", "decimal(12,2)", "string"])
@pytest.mark.parametrize("limit", [30, 1_000_000])
@pytest.mark.parametrize("hot", [False, True])
def test_oplog_replay(inputs, limit, hot, kind):
    log = keyed.operations(inputs)
    if hot:  # one key takes all, and without resets it is one long segment
        log = log.where(~F.col("op").isin(*oplog.RESETS)).withColumn("key", F.lit(5).cast("bigint"))
    if kind == "string":  # nothing to add to; some operations have no value
        log = log.where("op <> 'add'").withColumn("value", F.when(F.col("value") != 6, F.col("value")))
    log = log.withColumns({c: F.col(c).cast(kind) for c in ("value", "comparand")})
    kv = inputs.derived("kv").select("key", F.col("value").cast(kind).alias("value"))
    new, results = oplog.replay(kv, log, limit)
    state = {r.key: r.value for r in kv.collect()}
    want = {}
    for r in sorted(log.collect(), key=lambda r: r.seq):
        has, old = r.key in state, state.get(r.key)
        ok, result = has, None
        if r.op == "get":
            result = old
        elif r.op == "put":
            ok = not has
            if ok:
                state[r.key] = r.value
        elif r.op == "update":
            ok, state[r.key] = True, r.value
        elif r.op in ("remove", "get_and_remove"):
            result = old if r.op == "get_and_remove" else None
            state.pop(r.key, None)
        elif r.op == "remove_if":
            ok = has and old == r.comparand
            if ok:
                del state[r.key]
        elif r.op == "cas":
            ok = has and old == r.comparand
            if ok:
                state[r.key] = r.value
            else:
                result = old
        elif r.op == "add":
            if has:
                state[r.key] = result = old + r.value
        elif r.op == "get_and_update":
            result = old
            if has:
                state[r.key] = r.value
        want[r.key, r.seq] = (r.op, ok, result)
    got = {(r.key, r.seq): (r.op, r.ok, r.result) for r in results.collect()}
    assert got == want
    assert {r.key: r.value for r in new.collect()} == state


def test_oplog_plan_has_no_python(inputs, capsys):
    """Segments of any length take as many rounds as their longest chain has digits."""
    new, results = oplog.replay(inputs.derived("kv"), keyed.operations(inputs))
    for df in (new, results):
        df.explain("formatted")
    assert not {"MapInArrow", "ArrowEvalPython", "FlatMapGroupsInPandas"} & set(capsys.readouterr().out.split())


def test_oplog_long_chains_of_writes(spark, monkeypatch):
    """Each operation lets the next one write: 4,000 writes need a dozen rounds."""
    from tidemark.session import checkpoint

    rounds = []
    monkeypatch.setattr(oplog, "checkpoint", lambda df: rounds.append(1) or checkpoint(df))
    log = spark.range(4000).selectExpr("'k' AS key", "id AS seq", "'cas' AS op", "id + 1 AS value", "id AS comparand")
    kv = spark.createDataFrame([("k", 0)], "key string, value bigint")
    new, results = oplog.replay(kv, log)
    assert new.collect() == [("k", 4000)] and results.where("ok").count() == 4000
    assert len(rounds) <= 3 + 13


def test_oplog_overflow_is_an_error(spark):
    top = 2**63 - 1
    log = spark.createDataFrame(
        [("a", 1, "add", 5, None), ("a", 2, "add", -5, None), ("a", 3, "update", 1, None)],
        "key string, seq bigint, op string, value bigint, comparand bigint",
    )
    with pytest.raises(Exception, match="OUT_OF_RANGE|overflow"):
        oplog.replay(spark.createDataFrame([("a", top)], "key string, value bigint"), log)
    # Sums of additions may leave the range while values do not.
    many = spark.range(6).selectExpr(
        "'a' AS key", "id AS seq", "IF(id % 2 = 0, 'add', 'update') AS op", f"IF(id % 2 = 0, {top - 5}, 5) AS value",
        "CAST(NULL AS BIGINT) AS comparand",
    )
    new, results = oplog.replay(spark.createDataFrame([("a", 5)], "key string, value bigint"), many)
    assert [r.result for r in results.orderBy("seq").collect()] == [top, None, top, None, top, None]


def test_oplog_refuses_unknown_operations(spark, inputs):
    log = spark.createDataFrame([(1, 1, "pop", 1, 1)], "key bigint, seq bigint, op string, value bigint, comparand bigint")
    with pytest.raises(Exception, match="unknown operation"):
        oplog.replay(inputs.derived("kv"), log)
