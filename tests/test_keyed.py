"""Keyed values and tags, with few and with many requests."""

from datetime import datetime, timedelta

import pytest

from tidemark.operators import kv, tags

NOW = datetime(2024, 2, 1)
LATER = NOW + timedelta(hours=1)
KV = "key bigint, value bigint, modified_at timestamp_ntz, expires_at timestamp_ntz"


@pytest.fixture(params=["few", "many"])
def stored(spark, request, monkeypatch):
    if request.param == "many":
        monkeypatch.setattr(kv, "small_side", lambda df, *_: (df, None))
        monkeypatch.setattr(tags, "checked_broadcast", lambda df, *_: df)
    return spark.createDataFrame([(1, 10, NOW, LATER), (2, 20, NOW, None), (3, None, NOW, NOW)], KV)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def ask(spark, data, columns="key bigint, value bigint, comparand bigint"):
    return spark.createDataFrame(data, columns)


def test_get_put_update(spark, stored):
    asked = ask(spark, [(1, 11, 0), (3, 33, 0), (4, 44, 0)])
    assert rows(kv.get(stored, asked), "key", "value", "missing") == [(1, 10, False), (3, None, False), (4, None, True)]
    new, made = kv.put(stored, asked, LATER)
    assert rows(new, "key", "value") == [(1, 10), (2, 20), (3, None), (4, 44)]
    assert rows(made, "key", "created") == [(1, False), (3, False), (4, True)]
    new, made = kv.update(stored, asked, LATER)
    assert rows(new, *new.columns) == sorted(
        [(1, 11, LATER, None), (2, 20, NOW, None), (3, 33, LATER, None), (4, 44, LATER, None)], key=str
    )
    assert rows(made, "key", "created") == [(1, False), (3, False), (4, True)]


def test_several_requests_per_key(spark, stored):
    asked = ask(spark, [(9, 1, 1), (9, 2, 2), (1, 3, 3), (1, 4, 4)], "key bigint, value bigint, seq bigint")
    assert rows(kv.put(stored, asked, NOW, "seq")[0].where("key = 9"), "value") == [(1,)]
    assert rows(kv.update(stored, asked, NOW, "seq")[0].where("key in (1, 9)"), "value") == [(2,), (4,)]


def test_requests_that_differ_are_refused(spark, stored):
    twice = ask(spark, [(1, 5, 10), (1, 6, 99)])
    same = ask(spark, [(1, 5, 10), (1, 5, 10)])
    for call in (lambda r: kv.compare_and_swap(stored, r, NOW), lambda r: kv.remove_if(stored, r),
                 lambda r: kv.get_and_update(stored, r, NOW), lambda r: kv.update(stored, r, NOW)):
        with pytest.raises(Exception, match="differ"):
            call(twice)[1].collect()
        assert len(call(same)[1].collect()) == 1
    times = spark.createDataFrame([(1, NOW, 1), (1, LATER, 2)], "key bigint, expires_at timestamp_ntz, seq int")
    assert rows(kv.expire_at(stored, times, "seq")[0].where("key = 1"), "expires_at") == [(LATER,)]


def test_add_to_times(spark, stored):
    times = stored.select("key", "modified_at").selectExpr("key", "modified_at AS value", "modified_at", "CAST(NULL AS timestamp_ntz) AS expires_at")
    asked = spark.createDataFrame([(1, timedelta(minutes=40)), (1, timedelta(minutes=20)), (9, timedelta(1))], "key bigint, addend interval day to second")
    new, result = kv.add(times, asked, LATER)
    assert rows(new.where("key < 3"), "key", "value") == [(1, LATER), (2, NOW)]
    assert rows(result, "key", "total", "missing") == [(1, LATER, False), (9, None, True)]


def test_conditional_changes(spark, stored):
    asked = ask(spark, [(1, 100, 10), (2, 200, 99), (4, 400, 4)])
    new, result = kv.compare_and_swap(stored, asked, LATER)
    assert rows(new, "key", "value") == [(1, 100), (2, 20), (3, None)]
    assert rows(result, "key", "swapped", "current", "missing") == [
        (1, True, None, False), (2, False, 20, False), (4, False, None, True)
    ]
    new, result = kv.remove_if(stored, asked)
    assert rows(new, "key") == [(2,), (3,)]
    assert rows(result, "key", "removed") == [(1, True), (2, False), (4, False)]
    new, result = kv.remove(stored, asked)
    assert rows(new, "key") == [(3,)]
    assert rows(result, "key", "removed") == [(1, True), (2, True), (4, False)]
    new, result = kv.get_and_update(stored, asked, LATER)
    assert rows(new, "key", "value") == [(1, 100), (2, 200), (3, None)]
    assert rows(result, "key", "old_value", "missing") == [(1, 10, False), (2, 20, False), (4, None, True)]
    new, result = kv.get_and_remove(stored, asked)
    assert rows(new, "key") == [(3,)]
    assert rows(result, "key", "old_value", "missing") == [(1, 10, False), (2, 20, False), (4, None, True)]


def test_add(spark, stored):
    asked = ask(spark, [(1, 5), (1, 6), (2, -20), (7, 1)], "key bigint, addend bigint")
    new, result = kv.add(stored, asked, LATER)
    assert rows(new, "key", "value") == [(1, 21), (2, 0), (3, None)]
    assert rows(result, "key", "total", "missing") == [(1, 21, False), (2, 0, False), (7, None, True)]
    with pytest.raises(Exception, match="OVERFLOW"):
        kv.add(stored, ask(spark, [(1, 2**63 - 1)], "key bigint, addend bigint"), NOW)[0].collect()


def test_expiry(spark, stored):
    assert rows(kv.alive(stored, NOW), "key") == [(1,), (2,)]
    assert rows(kv.alive(stored, LATER), "key") == [(2,)]
    asked = ask(spark, [(2, NOW.replace(microsecond=1999)), (8, NOW)], "key bigint, expires_at timestamp_ntz")
    new, result = kv.expire_at(stored, asked)
    assert rows(new.where("key = 2"), "expires_at") == [(NOW.replace(microsecond=1000),)]
    assert rows(result, "key", "missing") == [(2, False), (8, True)]


def test_tags(spark, stored):
    held = spark.createDataFrame([("a", "blob", "t1"), ("a", "blob", "t2"), ("b", "table", "t1")], "alias string, entry_type string, tag string")
    asked = spark.createDataFrame([("a", "blob", "t1"), ("a", "blob", "t3"), ("a", "blob", "t3")], held.schema)
    new, result = tags.attach(held, asked)
    assert rows(new, "alias", "tag") == [("a", "t1"), ("a", "t2"), ("a", "t3"), ("b", "t1")]
    assert rows(result, "tag", "changed") == [("t1", False), ("t3", True)]
    new, result = tags.detach(held, asked)
    assert rows(new, "alias", "tag") == [("a", "t2"), ("b", "t1")]
    assert rows(result, "tag", "changed") == [("t1", True), ("t3", False)]
    assert rows(tags.find(held, ["t1", "t2"]), "alias") == [("a",)]
    assert rows(tags.find(held, ["t1"], "table"), "alias") == [("b",)]
    assert rows(tags.find(held, ["t1", "t1"]), "alias") == [("a",), ("b",)]
