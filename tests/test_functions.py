"""Column functions against plain Python."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.nulls import INT64_NULL, normalise_nulls
from tidemark.functions.text import clean_blob, clean_name, file_stem, int_or_text, op_split
from tidemark.functions.time import from_micros, micros, ns_join, ns_split, timestamp, to_utc, trunc_ms
from tidemark.operators.stats import TYPES, UNITS, enum_code, parse_key


def column(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.select(fn(F.col("x")).alias("y"), "i").orderBy("i").select("y").collect()]


@pytest.mark.parametrize(
    ("name", "want"),
    [
        ("Coca-Cola", "coca_cola"),
        ("DowDuPont Inc", "dowdupont"),
        ("Travelers Companies Inc", "travelers_companies"),
        ("  A & B (Holding), Ltd.  ", "a_b_holding_ltd"),
        ("X Group Corp Inc", "x"),
        ("amazon.com Inc", "amazon"),
        ("Foo Co. Bar", "foo"),
        ("a - b", "a__b"),
        ("O'Neil", "oneil"),
        ("Incorporated", "incorporated"),
        ("tab\t", "tab"),
        ("", ""),
    ],
)
def test_clean_name(spark, name, want):
    assert column(spark, [name], clean_name) == [want]


def test_file_stem(spark):
    paths = ["/a/b/AAPL.csv", "ibm.CSV.gz", "plain", "/x.y/ge", ".hidden", "s3://bucket/d/V.csv"]
    assert column(spark, paths, file_stem) == ["aapl", "ibm.csv", "plain", "ge", ".hidden", "v"]


def test_clean_blob(spark):
    raw = [b"ok\x00\x00", b"\xff\xfeab", "zürich\x00".encode(), b"", b"cut \xe2\x82", b"\xf0\x9f\x98x\xc3\x28"]
    assert column(spark, raw, clean_blob, "binary") == [
        x.decode("utf-8", "replace").replace("\0", "") for x in raw
    ]


def test_int_or_text(spark):
    got = column(spark, ["12", "-9", "1.5", "x", "", None, "9223372036854775808"], int_or_text)
    assert [tuple(g) for g in got] == [
        (12, None), (-9, None), (None, "1.5"), (None, "x"), (None, ""), (None, None), (None, "9223372036854775808"),
    ]


def test_op_split(spark):
    got = column(spark, ["a_b_starts", "a_b_ends", "received", "_starts", None], op_split)
    assert [tuple(g) for g in got] == [(True, "a_b"), (False, "a_b"), (None, None), (True, ""), (None, None)]


def test_parse_key(spark):
    p = "$statistics."
    keys = [
        p + "requests.out", p + "requests.out.type", p + "requests.out.uid_1", p + "requests.out.uid_12.type",
        p + "requests.out.uid_12.unit", "other.key", p + "a.uid_3.b", p + "uid_4", p + "node.prototype",
    ]
    assert [tuple(g) for g in column(spark, keys, parse_key)] == [
        ("requests.out", None, "value"), ("requests.out", None, "type"), ("requests.out", 1, "value"),
        ("requests.out", None, "type"), ("requests.out", None, "unit"), (None, None, None),
        ("a.uid_3.b", None, "value"), ("uid_4", None, "value"), ("node.prototype", None, "value"),
    ]


def test_enum_code(spark):
    assert column(spark, [*TYPES, None], lambda c: enum_code(c, TYPES, "type")) == [*TYPES.values(), None]
    assert column(spark, list(UNITS), lambda c: enum_code(c, UNITS, "unit")) == list(UNITS.values())
    with pytest.raises(Exception, match="unknown unit furlongs"):
        column(spark, ["furlongs"], lambda c: enum_code(c, UNITS, "unit"))


def test_nanoseconds(spark):
    values = [0, 1, 999_999_999, 1_000_000_000, 2**62, -1]
    got = column(spark, values, ns_split, "bigint")
    assert [None if g is None else tuple(g) for g in got] == [divmod(v, 10**9) if v >= 0 else None for v in values]
    assert column(spark, values[:5], lambda c: ns_join(ns_split(c).sec, ns_split(c).nsec), "bigint") == values[:5]


def test_times(spark):
    at = datetime(2024, 7, 1, 12, 0, 0, 123_999)
    old = datetime(1969, 12, 31, 23, 59, 59, 999_999)
    assert column(spark, [at, old], micros, "timestamp_ntz") == [1_719_835_200_123_999, -1]
    assert column(spark, [at, old], lambda c: from_micros(micros(c)), "timestamp_ntz") == [at, old]
    assert column(spark, [at], trunc_ms, "timestamp_ntz") == [at.replace(microsecond=123_000)]
    assert column(spark, [at], lambda c: to_utc(c, "Europe/Amsterdam"), "timestamp_ntz") == [at.replace(hour=10)]
    aware = datetime.fromisoformat("2024-07-01T12:00:00+02:00")
    assert spark.range(1).select(timestamp(aware)).first()[0] == datetime(2024, 7, 1, 10)


def test_null_sentinels(spark):
    kinds = T.StructType([
        T.StructField("d", T.DoubleType()), T.StructField("n", T.LongType()), T.StructField("t", T.TimestampNTZType()),
        T.StructField("s", T.StringType()), T.StructField("b", T.BinaryType()),
    ])
    good = (1.0, 0, datetime(1970, 1, 1), " ", b"\0")
    rows = [(float("nan"), INT64_NULL, datetime(1969, 12, 31), "", b""), (None,) * 5, good]
    got = [tuple(r) for r in normalise_nulls(spark.createDataFrame(rows, kinds)).collect()]
    assert got == [(None,) * 5, (None,) * 5, (*good[:4], bytearray(b"\0"))]


def test_time_arithmetic_in_any_zone(spark):
    from tidemark.functions.time import from_micros, micros

    rows = [(t,) for t in ("1969-12-31 23:59:59.999999", "1970-01-01", "2024-03-10 02:30:00.000001", "2024-03-10 03:30:00", "2290-11-03 01:30:00")]
    df = spark.createDataFrame(rows, "text string").selectExpr("CAST(text AS timestamp_ntz) AS ts")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        found = df.select("ts", micros(F.col("ts")).alias("us")).select("*", from_micros(F.col("us")).alias("back")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    for r in found:
        assert r.us == (r.ts - datetime(1970, 1, 1)) // timedelta(microseconds=1) and r.back == r.ts


def test_years_and_calendar_durations(spark):
    from tidemark.functions.time import Calendar
    from tidemark.operators.ranges import between

    days = spark.sql("SELECT explode(sequence(DATE'2017-12-30', DATE'2020-03-01')) AS d").selectExpr("CAST(d AS timestamp_ntz) AS ts")
    count = lambda begin, end: days.where(between(F.col("ts"), begin, end)).count()
    assert count(2018, 2019) == 365 and count(2018, timedelta(days=100)) == 100
    assert count(2018, Calendar(years=1)) == 365 and count("2020-01-31", Calendar(months=1)) == 29
