"""Stored tables: definition, commits, replacing, deduplication, upkeep."""

import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.errors import (
    AliasAlreadyExists, AliasNotFound, CommitConflict, DamagedCommit, IncompatibleTypes, InvalidArgument,
)
from tidemark.schema import TABLE, TS, ColumnInfo, ColumnType, TableSchema
from tidemark.session import scratch_path
from tidemark.sources import tables
from tidemark.sources.tables import TableGroup

START = datetime(2024, 1, 1)
HOUR = timedelta(hours=1)
COLUMNS = (ColumnInfo("v", ColumnType.DOUBLE), ColumnInfo("s", ColumnType.SYMBOL, "names"))


@pytest.fixture
def group(spark):
    return TableGroup(spark, scratch_path(spark, "group"))


def frame(spark, rows, columns=f"`{TS}` timestamp_ntz, v double, s string"):
    return spark.createDataFrame(rows, columns)


def hours(*numbers, value=1.0, name="x"):
    return [(START + n * HOUR, value + n, name) for n in numbers]


def values(df):
    return sorted(((r[TS] - START) // HOUR, r.v) for r in df.collect())


def test_schema_rules():
    ts = ColumnInfo(TS, ColumnType.TIMESTAMP)
    assert [c.name for c in TableSchema("t", (ts, *COLUMNS)).columns] == ["v", "s"]
    for wrong in (
        lambda: ColumnInfo("a", ColumnType.SYMBOL),
        lambda: ColumnInfo("a", ColumnType.INT64, "names"),
        lambda: TableSchema("t", (*COLUMNS, ts)),
        lambda: TableSchema("t", (ColumnInfo(TS, ColumnType.INT64),)),
        lambda: TableSchema("t", COLUMNS, timedelta(0)),
        lambda: TableSchema("t", (*COLUMNS, *COLUMNS)),
        lambda: TableSchema("t", COLUMNS).column("nope"),
        lambda: TableSchema("t", COLUMNS).column_at(2),
    ):
        with pytest.raises(InvalidArgument):
            wrong()
    for size in (timedelta(milliseconds=1), timedelta(weeks=52)):
        assert TableSchema("t", (), size).shard_size == size


def test_definition(spark, group):
    group.create(TableSchema("t", COLUMNS, HOUR, timedelta(days=1)), TableSchema("bare"))
    assert group.tables() == ["bare", "t"] and group.exists("t") and not group.exists("u")
    assert [(r["index"], r.name, r.type, r.symtable) for r in group.describe("t").orderBy("index").collect()] == [
        (-1, TS, "timestamp", None), (0, "v", "double", None), (1, "s", "symbol", "names")
    ]
    group.push({"t": frame(spark, [*hours(1, 2), (START, None, "y")])})
    assert {r.name: r.points for r in group.describe("t", points=True).collect()} == {TS: 3, "v": 2, "s": 3}
    schema = TableGroup(spark, group.root).schema("t")  # as another process sees it
    assert schema == TableSchema("t", COLUMNS, HOUR, timedelta(days=1)) and schema.has_ttl
    with pytest.raises(AliasAlreadyExists):
        group.create(TableSchema("t"))
    group.drop("t")
    for call in (lambda: group.drop("t"), lambda: group.schema("t"), lambda: group.read("t"),
                 lambda: group.push({"t": frame(spark, hours(1))})):
        with pytest.raises(AliasNotFound):
            call()
    group.drop("t", missing_ok=True)


def test_inferred_tables(spark, group):
    df = spark.range(1).select(F.lit(START).cast("timestamp_ntz").alias(TS), F.lit(True).alias("flag"), F.array(F.lit(1)).alias("xs"))
    with pytest.raises(IncompatibleTypes) as caught:
        group.create_from("t", df)
    assert "flag" in str(caught.value) and "xs" in str(caught.value)


def test_append_and_ranges(spark, group):
    group.create(TableSchema("t", COLUMNS, HOUR))
    assert group.read("t").count() == 0
    group.push({"t": frame(spark, hours(3, 1, 2))})
    group.push({"t": frame(spark, hours(2))}, "fast")
    assert values(group.read("t")) == [(1, 2.0), (2, 3.0), (2, 3.0), (3, 4.0)]
    edge = group.read("t", ranges=[(START + HOUR, START + 2 * HOUR), (START + 3 * HOUR, START + 4 * HOUR)])
    assert values(edge) == [(1, 2.0), (3, 4.0)]
    many = spark.createDataFrame([(START, START + HOUR), (START + 3 * HOUR, START + 9 * HOUR)], "begin timestamp_ntz, end timestamp_ntz")
    assert values(group.read("t", ranges=many)) == [(3, 4.0)]
    assert group.read("t", ranges=many.where("false")).count() == 0
    assert group.read(["t"], columns=["s"]).columns == [TS, TABLE, "s"]
    with pytest.raises(InvalidArgument):
        group.push({"t": frame(spark, [])})
    with pytest.raises(InvalidArgument):
        group.push({"t": frame(spark, hours(1))}, "sideways")
    with pytest.raises(InvalidArgument):
        group.push({"t": frame(spark, hours(1))}, range=(START, START + HOUR))
    with pytest.raises(InvalidArgument):
        group.push([("t", frame(spark, hours(1))), ("t", frame(spark, hours(2)))])


def test_null_sentinels_are_stored_as_null(spark, group):
    group.create(TableSchema("t", COLUMNS))
    group.push({"t": frame(spark, [(START, float("nan"), ""), (START, 1.0, "x"), (START, None, None)])})
    assert sorted((r.v is None, r.s is None) for r in group.read("t").collect()) == [(False, False), (True, True), (True, True)]


def test_truncate(spark, group):
    group.create(TableSchema("t", COLUMNS, 4 * HOUR), TableSchema("u", COLUMNS, HOUR))
    all_day = frame(spark, hours(*range(24)))
    group.push({"t": all_day, "u": all_day})
    batch = {"t": frame(spark, hours(5, 9, value=100.0))}
    for _ in range(2):  # doing it again changes nothing
        group.push(batch, "truncate")
        assert values(group.read("t")) == [(n, 1.0 + n) for n in range(5)] + [(5, 105.0), (9, 109.0)] + [
            (n, 1.0 + n) for n in range(10, 24)
        ]
    both = {"t": frame(spark, hours(2, value=50.0)), "u": frame(spark, hours(3, value=50.0))}
    with pytest.raises(InvalidArgument):
        group.push(both, "truncate")
    group.push(both, "truncate", range=(START, START + 23 * HOUR))
    assert values(group.read("t")) == [(2, 52.0), (23, 24.0)]
    assert values(group.read("u")) == [(3, 53.0), (23, 24.0)]


@pytest.mark.parametrize("keys", [[TS], TS, [TS, "s"], ["s"], True])
@pytest.mark.parametrize("mode", ["drop", "upsert"])
def test_deduplicate(spark, group, keys, mode):
    group.create(TableSchema("t", COLUMNS, HOUR))
    first = [(START, 1.0, "a"), (START, 1.0, None), (START + HOUR, 2.0, "b"), (START + 9 * HOUR, 2.0, "z")]
    then = [(START, 1.0, "a"), (START, 7.0, None), (START + HOUR, 3.0, "c"), (START + 2 * HOUR, 4.0, "b")]
    group.push({"t": frame(spark, first)})
    order = "row"
    batch = spark.createDataFrame([(*r, i) for i, r in enumerate(then)], f"`{TS}` timestamp_ntz, v double, s string, row int")
    group.push({"t": batch}, deduplicate=keys, deduplication_mode=mode, seq=order)
    names = [TS, "v", "s"] if keys is True else [keys] if isinstance(keys, str) else keys
    key = lambda r: tuple(dict(zip((TS, "v", "s"), r, strict=True))[n] for n in names)
    if mode == "drop":
        want, seen = list(first), {key(r) for r in first}
        for r in then:
            if key(r) not in seen:
                want.append(r)
                seen.add(key(r))
    else:
        want = [r for r in first if key(r) not in {key(x) for x in then}] + list({key(r): r for r in then}.values())
    got = sorted(((r[TS], r.v, r.s) for r in group.read("t").collect()), key=str)
    assert got == sorted(want, key=str)


def test_deduplication_options(spark, group):
    group.create(TableSchema("t", COLUMNS))
    batch = {"t": frame(spark, hours(1))}
    with pytest.raises(InvalidArgument):
        group.push(batch, deduplicate=True, deduplication_mode="merge")
    with pytest.raises(InvalidArgument):
        group.push(batch, deduplicate=["nope"])
    with pytest.raises(TypeError):
        group.push(batch, deduplicate="v")
    assert group.read("t").count() == 0


def test_only_touched_shards_are_opened(spark, group):
    from tidemark.sources.tables import _of_shards

    group.create(TableSchema("t", COLUMNS, HOUR))
    group.push({"t": frame(spark, hours(*range(48)))})
    rows = group._rows(["t"], group._catalog())
    some = rows.where("v__double < 3").select("_table", "_shard").distinct()
    got = _of_shards(rows, some)
    assert got.count() == 2
    scans = [line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
    assert "_shard" in scans[0].split("PartitionFilters: [")[1].split("]")[0]


def test_one_frame_for_many_tables(spark, group):
    names = [f"fleet.{i}" for i in range(300)]
    group.create(*[TableSchema(n, COLUMNS, timedelta(seconds=60) if i % 2 else HOUR) for i, n in enumerate(names)])
    rows = spark.range(3000).select(
        F.expr(f"timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, id div 300)").alias(TS),
        F.concat(F.lit("fleet."), (F.col("id") % 300).cast("string")).alias(TABLE),
        F.col("id").cast("double").alias("v"), F.lit("x").alias("s"),
    )
    group.push(rows)
    counts = {r[TABLE]: r["count"] for r in group.read(names).groupBy(f"`{TABLE}`").count().collect()}
    assert counts == dict.fromkeys(names, 10)
    with pytest.raises(Exception, match="no such table in this push"):
        group.push(rows.withColumn(TABLE, F.lit("elsewhere")))
    assert group.read(names).count() == 3000


def test_same_name_different_types(spark, group):
    group.create(TableSchema("a", (ColumnInfo("x", ColumnType.DOUBLE),)), TableSchema("b", (ColumnInfo("x", ColumnType.STRING),)))
    group.push({
        "a": frame(spark, [(START, 1.5)], f"`{TS}` timestamp_ntz, x double"),
        "b": frame(spark, [(START, "text")], f"`{TS}` timestamp_ntz, x string"),
    })
    assert group.read("a").first().x == 1.5 and group.read("b").first().x == "text"
    with pytest.raises(InvalidArgument):
        group.read(["a", "b"])


def test_unpublished_versions_are_invisible(spark, group):
    group.create(TableSchema("t", COLUMNS))
    group.push({"t": frame(spark, hours(1))})
    live = spark.read.parquet(f"{group.root}/data")
    live.drop("_v").write.partitionBy("_shard").parquet(f"{group.root}/data/_v=3-{uuid.uuid4().hex}")
    assert group.read("t").count() == 1


def test_conflicting_commit(spark, group):
    group.create(TableSchema("t", COLUMNS))
    late = TableGroup(spark, group.root)
    number = late._next()
    group.push({"t": frame(spark, hours(1))})
    with pytest.raises(CommitConflict):
        late._publish(number, {"kind": "test"})


def test_a_damaged_commit_is_not_skipped(spark, group):
    from pathlib import Path

    group.create(TableSchema("t", COLUMNS))
    broken = Path(group.root.removeprefix("file:")) / "log" / f"{2:020d}.json"
    broken.write_text('{"number": 2, "kin')
    with pytest.raises(DamagedCommit):
        group.push({"t": frame(spark, hours(1))})
    with pytest.raises(DamagedCommit):
        TableGroup(spark, group.root).read("t")


def test_overlapping_writers(spark, group, monkeypatch):
    """A writer that was overtaken fails, and its retry keeps both writers' rows."""
    group.create(TableSchema("t", COLUMNS))
    group.push({"t": frame(spark, hours(0))})
    slow, publish = TableGroup(spark, group.root), TableGroup._publish

    def overtaken(self, number, entry):
        monkeypatch.setattr(TableGroup, "_publish", publish)
        group.push({"t": frame(spark, hours(3))}, mode="truncate", range=(START, START + HOUR))
        return publish(self, number, entry)

    monkeypatch.setattr(TableGroup, "_publish", overtaken)
    with pytest.raises(CommitConflict):
        slow.push({"t": frame(spark, hours(2))}, batch_id="slow")
    assert [h for h, *_ in values(group.read("t"))] == [3]
    slow.push({"t": frame(spark, hours(2))}, batch_id="slow")
    assert sorted(h for h, *_ in values(group.read("t"))) == [2, 3]
    assert sorted(r.transaction_id for r in group.changes().collect()) == [2, 3, 4]


def test_a_driver_lost_before_the_commit(spark, group, monkeypatch):
    """The change log has a line for each published push, and for no other."""
    group.create(TableSchema("t", COLUMNS))

    def lost(self, number, entry):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(TableGroup, "_publish", lost)
        with pytest.raises(RuntimeError):
            group.push({"t": frame(spark, hours(1))}, batch_id="b")
    assert group.read("t").count() == 0 and group.changes().count() == 0
    group.push({"t": frame(spark, hours(1))}, batch_id="b")
    assert group.read("t").count() == 1 and group.changes().count() == 1


def test_ten_thousand_tables(spark, group):
    schemas = [TableSchema(f"t{i}", COLUMNS, HOUR, timedelta(hours=1 + i % 50)) for i in range(10_000)]
    group.create(*schemas)
    rows = frame(spark, hours(*range(24))).crossJoin(spark.range(3).selectExpr("concat('t', id * 10) AS `$table`"))
    group.push(rows)
    names = group.tables()
    now = START + timedelta(hours=24)
    young = group.read(names, now=now)
    assert {tuple(r) for r in young.groupBy("`$table`").count().collect()} == {("t0", 1), ("t10", 11), ("t20", 21)}
    group.expire(now)
    assert group.read(names).count() == 33


def test_a_long_history(spark, group):
    group.create(*[TableSchema(f"t{i}") for i in range(2)])
    for i in range(120):
        group.add_columns("t0", [ColumnInfo(f"c{i}", ColumnType.INT64)])
    assert len(TableGroup(spark, group.root).schema("t0").columns) == 120


def test_batch_id(spark, group):
    group.create(TableSchema("t", COLUMNS))
    first = group.push({"t": frame(spark, hours(1))}, batch_id="b1")
    other = TableGroup(spark, group.root)
    assert other.push({"t": frame(spark, hours(1))}, batch_id="b1") == first
    assert group.read("t").count() == 1


def test_compact_and_expire(spark, group):
    group.create(TableSchema("t", COLUMNS, HOUR, timedelta(hours=10)), TableSchema("u", COLUMNS, HOUR))
    for value in (1.0, 2.0):
        group.push({"t": frame(spark, hours(*range(24), value=value)), "u": frame(spark, hours(0, value=value))})
    before = values(group.read("t"))
    group.compact(["t"])
    assert group.compact(["t"]) is None
    assert values(group.read("t")) == before
    group.compact()
    assert group.compact() is None
    assert values(group.read("t")) == before and group.read("u").count() == 2
    assert len(group._filled()) == 2  # the two pushes are read no more
    now = START + timedelta(hours=20, minutes=30)
    group.expire(now)
    assert min(values(group.read("t")))[0] == 10  # the shard of the limit is kept
    assert min(values(group.read("t", now=now)))[0] == 11
    assert group.read("u", now=now).count() == 2
    group.expire(now)


def test_compaction_in_steps(spark, group):
    """Only what is spread over versions is rewritten; it tells how far it is and can be ended."""
    group.create(TableSchema("t", COLUMNS, HOUR))
    group.push({"t": frame(spark, hours(*range(24)))})
    group.push({"t": frame(spark, hours(*range(2, 12), value=2.0))})
    before, seen = values(group.read("t")), []
    group.compact(step=3, progress=lambda done, total: seen.append((done, total)) or done < 6)
    assert seen == [(3, 10), (6, 10)] and values(group.read("t")) == before
    rewritten = spark.read.option("basePath", f"{group.root}/data").parquet(*[f"{group.root}/data/_v={c['version']}" for c in group._filled()[2:]])
    assert rewritten.count() == 12
    group.compact(step=100, progress=lambda done, total: seen.append((done, total)))
    assert seen[2:] == [(4, 4)] and values(group.read("t")) == before
    assert [c["kind"] for c in group._filled()] == ["transactional", "compact", "compact", "compact"]


def test_infer_types_off(spark, group):
    group.create(TableSchema("t", (ColumnInfo("v", ColumnType.DOUBLE), ColumnInfo("n", ColumnType.INT64))))
    wrong = frame(spark, [(START, "1.5", 2.0)], f"`{TS}` timestamp_ntz, v string, n double")
    with pytest.raises(IncompatibleTypes) as caught:
        group.push({"t": wrong}, infer_types=False)
    assert len(caught.value.problems) == 2
    group.push({"t": wrong})
    assert (group.read("t").first().v, group.read("t").first().n) == (1.5, 2)
    group.push({"t": wrong.drop("n")}, dtype={"v": "float"})
    with pytest.raises(InvalidArgument):
        group.push({"t": wrong}, dtype={"nope": "float"})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        group.push({"t": frame(spark, [(START, "abc", 1.0)], f"`{TS}` timestamp_ntz, v string, n double")})


def test_a_row_without_time_is_refused(spark, group):
    group.create(TableSchema("t", COLUMNS))
    for time in (None, datetime(1969, 5, 5)):
        with pytest.raises(Exception, match="has no"):
            group.push({"t": frame(spark, [(time, 1.0, "x"), *hours(1)])})
    assert group.read("t").count() == 0


def test_equal_keys_without_an_order(spark, group):
    group.create(TableSchema("t", COLUMNS))
    twice = hours(1) + hours(1, value=5.0)
    for mode in ("drop", "upsert"):
        with pytest.raises(Exception, match="differ"):
            group.push({"t": frame(spark, twice)}, deduplicate=TS, deduplication_mode=mode)
    group.push({"t": frame(spark, hours(1) * 2)}, deduplicate=TS)
    assert values(group.read("t")) == [(1, 2.0)]


def test_types_by_position(spark, group):
    group.create(TableSchema("t", (ColumnInfo("v", ColumnType.DOUBLE), ColumnInfo("n", ColumnType.INT64))))
    rows = frame(spark, [(START, "1.5", "7")], f"`{TS}` timestamp_ntz, v string, n string")
    group.push({"t": rows}, dtype=["float", None])
    group.push({"t": rows}, dtype="double")
    assert [(r.v, r.n) for r in group.read("t").collect()] == [(1.5, 7)] * 2
    with pytest.raises(InvalidArgument):
        group.push({"t": rows}, dtype=["float"] * 3)


def test_symbols_keep_their_numbers(spark):
    from tidemark.operators.symbols import build_dictionary, extend_dictionary

    first = spark.createDataFrame([("b",), ("d",), (None,)], "s string")
    more = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "s string")
    known = build_dictionary(first, "s")
    grown = {r.symbol: r.symbol_id for r in extend_dictionary(known, more, "s").collect()}
    assert grown == {"b": 0, "d": 1, "a": 2, "c": 3}
    empty = known.limit(0)
    assert {r.symbol: r.symbol_id for r in extend_dictionary(empty, more, "s").collect()} == {"a": 0, "b": 1, "c": 2}


# ---------------------------------------------------------------- symbols


def numbers(group, table):
    """Symbol -> numbers as stored."""
    ids = {r.symbol_id: r.symbol for r in group.symbols("names").collect()}
    rows = group.read(table, decode=False).collect()
    assert all(r.s is None or isinstance(r.s, int) for r in rows)
    return {None if r.s is None else ids[r.s]: r.s for r in rows}


def test_symbol_tables_grow(spark, group):
    """Two tables share numbers, which never change; another symbol table has its own."""
    other = (ColumnInfo("s", ColumnType.SYMBOL, "others"),)
    group.create(TableSchema("t", COLUMNS), TableSchema("u", COLUMNS), TableSchema("w", other))
    row = lambda *names: frame(spark, [(START + n * HOUR, 1.0, name) for n, name in enumerate(names)])
    group.push({"t": row("b", "d", "b", None, ""), "u": row("d", "a")})
    assert numbers(group, "t") == {"b": 1, "d": 2, None: None} and numbers(group, "u") == {"d": 2, "a": 0}
    group.push({"t": row("c", "a"), "w": row("b").drop("v")})
    assert numbers(group, "t") == {"b": 1, "d": 2, "c": 3, "a": 0, None: None}
    assert [(r.symbol_id, r.symbol) for r in group.symbols("others").collect()] == [(0, "b")]
    again = TableGroup(spark, group.root)  # as another process sees it
    again.push({"u": row("d", "e", "c")})
    assert numbers(again, "u") == {"d": 2, "a": 0, "e": 4, "c": 3}
    assert sorted(r.s for r in again.read("u").collect()) == ["a", "c", "d", "d", "e"]
    assert sorted((r[TABLE], r.s or "") for r in again.read(["t", "w"]).collect()) == [
        ("t", ""), ("t", ""), ("t", "a"), ("t", "b"), ("t", "b"), ("t", "c"), ("t", "d"), ("w", "b")
    ]
    again.push({"t": row("b")}, "truncate", range=(START, START + HOUR))
    again.push({"t": frame(spark, [(START, 9.0, "d")])}, deduplicate=[TS], deduplication_mode="upsert")
    again.compact()
    assert numbers(again, "t") == {"d": 2, "a": 0, "b": 1, None: None}
    assert again.read("t", columns=["v"]).columns == [TS, "v"]


def test_symbol_tables_do_not_grow_twice_at_once(spark, group, monkeypatch):
    group.create(TableSchema("t", COLUMNS))
    late = TableGroup(spark, group.root)
    publish = late._publish

    def behind(number, entry):
        group.push({"t": frame(spark, hours(1, name="first"))})
        return publish(number, entry)

    monkeypatch.setattr(late, "_publish", behind)
    with pytest.raises(CommitConflict):
        late.push({"t": frame(spark, hours(2, name="second"))})
    monkeypatch.undo()
    late.push({"t": frame(spark, hours(2, name="second"))})
    assert numbers(late, "t") == {"first": 0, "second": 1}
    assert late.symbols().count() == 2


# ---------------------------------------------------------------- pruning


def files_read(spark, df):
    """Files that the scans of a plan open."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = df.select("*")
        df.collect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        scans = [leaves.apply(i) for i in range(leaves.size())]
        return sum(s.metrics().apply("numFiles").value() for s in scans if "Scan parquet" in s.nodeName())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.fixture(scope="module")
def long_table(spark):
    """A table of 1,500 shards, each a file or two."""
    group = TableGroup(spark, scratch_path(spark, "long"))
    group.create(TableSchema("t", COLUMNS[:1], HOUR))
    rows = spark.range(1500).select(
        F.expr("timestamp_ntz '2024-01-01' + make_dt_interval(0, CAST(id AS INT), 30)").alias(TS), F.col("id").cast("double").alias("v")
    )
    group.push({"t": rows})
    return group


def test_many_ranges_open_their_shards_only(spark, long_table):
    far = spark.createDataFrame(
        [(START + timedelta(hours=15 * k, minutes=10), START + timedelta(hours=15 * k, minutes=50)) for k in range(100)],
        "begin timestamp_ntz, end timestamp_ntz",
    )
    found = long_table.read("t", ranges=far)
    assert files_read(spark, found) <= 100 and found.count() == 100
    nearly_all = far.selectExpr("begin", "begin + INTERVAL '14' HOUR AS end")
    found = long_table.read("t", ranges=nearly_all)
    assert files_read(spark, found) <= 1500 and found.count() == 1400


def test_many_shards_are_a_pruning_set_too(spark, long_table):
    stored = long_table._rows(["t"], long_table._catalog())
    odd = stored.where("v__double % 15 = 7 OR v__double > 1400").select("_table", "_shard").distinct()
    found = tables._of_shards(stored, tables.checkpoint(odd))
    assert files_read(spark, found) == odd.count() == found.count()
    most = stored.where("v__double > 2").select("_table", "_shard").distinct()
    assert files_read(spark, tables._of_shards(stored, tables.checkpoint(most))) == 1497


def test_truncate_reads_the_shards_at_its_ends(spark, long_table, monkeypatch):
    opened = []
    commit = TableGroup._commit
    monkeypatch.setattr(TableGroup, "_commit", lambda self, kind, rows, *rest, **more: opened.append(files_read(spark, rows)) or commit(self, kind, rows, *rest, **more))
    group = long_table
    span = (START + timedelta(hours=100, minutes=45), START + timedelta(hours=1400, minutes=15))
    group.push({"t": frame(spark, [(START + timedelta(hours=700), -1.0)], f"`{TS}` timestamp_ntz, v double")}, "truncate", range=span)
    # The two shards at the ends, and nothing of the 1,299 between them.
    assert opened[0] <= 2
    left = sorted(r.v for r in group.read("t").collect())
    assert left == [-1.0, *map(float, range(101)), *map(float, range(1400, 1500))]


def test_intervals():
    from tidemark.sources import pruning

    assert pruning.joined([(5, 6), (1, 2), (3, 3), (9, 9)]) == [(1, 3), (5, 6), (9, 9)]
    assert pruning.joined([(1, 9), (2, 3)]) == [(1, 9)]
    assert pruning.cut([(1, 5), (9, 9), (20, 22)], 4) == [[(1, 4)], [(5, 5), (9, 9), (20, 21)], [(22, 22)]]
    assert pruning.cut([], 4) == [] and pruning.cut([(1, 5)], None) == [[(1, 5)]]
