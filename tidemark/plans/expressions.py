"""Plans for the column functions."""

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import clean_blob, clean_name, file_stem, int_or_text, op_split
from tidemark.functions.time import micros, ns_join, ns_split, to_utc, trunc_ms
from tidemark.operators import stats, symbols, write
from tidemark.plans.aggregates import TRACE_SQL, trace_of
from tidemark.plans.registry import plan, with_inputs
from tidemark.schema import TS, ColumnInfo, ColumnType, TableSchema

COMPANY_SQL = """CASE c_mktsegment
    WHEN 'HOUSEHOLD' THEN concat('  The Home-Store Group of ', c_name, ' Inc')
    WHEN 'MACHINERY' THEN concat(c_name, ' & Sons (Tools), Inc.')
    WHEN 'FURNITURE' THEN concat('O''Neil - ', c_name, ' Co. Ltd.')
    WHEN 'BUILDING' THEN concat(c_name, '.com Limited')
    ELSE concat('Mc.', c_name, ' LLC and Corp') END"""


def _cut(text, ending):
    return f"""(CASE WHEN strpos({text}, '{ending}') > 0
                     THEN left({text}, strpos({text}, '{ending}') - 1) ELSE {text} END)"""


_CUT_STEPS = ""
for _n, _ending in enumerate([" group", " corp", " inc", " co.", " llc", " limited", ".com"]):
    _CUT_STEPS += f", n{_n + 1} AS (SELECT c_custkey, {_cut('x', _ending)} AS x FROM n{_n})"


@plan(
    "x_clean_name",
    f"""WITH n0 AS (SELECT c_custkey, lower({COMPANY_SQL}) AS x FROM customer) {_CUT_STEPS}
        SELECT c_custkey, replace(translate(trim(x), '- ,.&'')(', '__'), '__', '_') AS name FROM n7""",
)
def x_clean_name(t):
    return t.table("customer").select("c_custkey", clean_name(F.expr(COMPANY_SQL.replace("''", "\\'"))).alias("name"))


PATH_SQL = "concat('/data/', lang, '.d/', source, '-', CAST(doc_id AS STRING), '.Part.CSV')"


@plan(
    "x_file_stem",
    f"""SELECT doc_id, lower(concat(source, '-', doc_id, '.part')) AS stem, lower(source) AS bare
        FROM documents""",
)
def x_file_stem(t):
    """Stem of a path with dots in it, and of a name without folder and extension."""
    return t.table("documents").select(
        "doc_id", file_stem(F.expr(PATH_SQL)).alias("stem"), file_stem(F.col("source")).alias("bare")
    )


@plan(
    "x_stat_parse",
    with_inputs("stats")
    + r""", p AS (SELECT node, key, replace(key, '$statistics.', '') AS body,
                  regexp_replace(replace(key, '$statistics.', ''), '\.uid_[0-9]+', '', 'g') AS shared FROM stats)
    SELECT node, key, CASE WHEN suffix(shared, '.type') OR suffix(shared, '.unit')
                           THEN regexp_replace(shared, '\.(type|unit)$', '')
                           ELSE regexp_replace(body, '\.uid_[0-9]+$', '') END AS metric,
           CASE WHEN suffix(shared, '.type') OR suffix(shared, '.unit') THEN NULL
                ELSE TRY_CAST(nullif(regexp_extract(body, '\.uid_([0-9]+)$', 1), '') AS BIGINT) END AS uid,
           CASE WHEN suffix(shared, '.type') THEN 'type' WHEN suffix(shared, '.unit') THEN 'unit'
                ELSE 'value' END AS "suffix" FROM p""",
)
def x_stat_parse(t):
    return stats.parse_stats(t.derived("stats")).drop("value")


@plan("x_clean_blob", "SELECT doc_id, replace(text, chr(0), '') AS text FROM documents")
def x_clean_blob(t):
    """Whole texts as bytes with added zero bytes come out as before."""
    raw = F.concat(F.encode("text", "utf-8"), F.lit(bytearray(b"\x00\x00")))
    return t.table("documents").select("doc_id", clean_blob(raw).alias("text"))


@plan(
    "x_enum_map",
    """SELECT event_id, CASE event_type WHEN 'error' THEN 2 WHEN 'view' THEN 3 ELSE 1 END AS "type",
              CASE event_type WHEN 'error' THEN 0 WHEN 'view' THEN 32 WHEN 'click' THEN 65
              WHEN 'signup' THEN 68 ELSE 1 END AS unit FROM events""",
)
def x_enum_map(t):
    kind = F.expr("CASE event_type WHEN 'error' THEN 'gauge' WHEN 'view' THEN 'label' ELSE 'accumulator' END")
    unit = F.expr(
        """CASE event_type WHEN 'error' THEN 'none' WHEN 'view' THEN 'bytes' WHEN 'click' THEN 'nanoseconds'
           WHEN 'signup' THEN 'seconds' ELSE 'count' END"""
    )
    return t.events.select(
        "event_id",
        stats.enum_code(kind, stats.TYPES, "type").alias("type"),
        stats.enum_code(unit, stats.UNITS, "unit").alias("unit"),
    )


MIXED_SQL = "CASE WHEN event_type = 'view' THEN props ELSE CAST(user_id * 1000003 AS STRING) END"


@plan(
    "x_int_or_text",
    f"""SELECT event_id, TRY_CAST(v AS BIGINT) AS int_value,
               CASE WHEN TRY_CAST(v AS BIGINT) IS NULL THEN v END AS text_value
        FROM (SELECT event_id, {MIXED_SQL} AS v FROM events) AS m""",
)
def x_int_or_text(t):
    return t.events.select("event_id", int_or_text(F.expr(MIXED_SQL)).alias("v")).select("event_id", "v.*")


@plan(
    "x_op_split",
    TRACE_SQL
    + r"""SELECT profile, seq, CASE WHEN suffix(label, '_starts') THEN TRUE WHEN suffix(label, '_ends') THEN FALSE END
                 AS is_start, CASE WHEN suffix(label, '_starts') OR suffix(label, '_ends')
                 THEN regexp_replace(label, '_(starts|ends)$', '') END AS op FROM trace""",
)
def x_op_split(t):
    return trace_of(t).select("profile", "seq", op_split(F.col("label")).alias("o")).select("profile", "seq", "o.*")


NS_SQL = "(epoch_us(ts) - 1704800000000000) * 1000 + user_id"


@plan(
    "x_ns_split",
    f"""SELECT event_id, CASE WHEN ns >= 0 THEN ns // 1000000000 END AS sec,
               CASE WHEN ns >= 0 THEN ns % 1000000000 END AS nsec
        FROM (SELECT event_id, {NS_SQL} AS ns FROM events) AS n""",
)
def x_ns_split(t):
    """Early events come before zero and give null."""
    ns = (micros(F.col("ts")) - F.lit(1_704_800_000_000_000)) * 1000 + F.col("user_id")
    split = t.events.select("event_id", ns_split(ns).alias("n"))
    return split.select("event_id", "n.sec", "n.nsec")


@plan("x_ns_join", "SELECT event_id, epoch_us(ts) * 1000 + user_id AS ns FROM events")
def x_ns_join(t):
    split = ns_split(micros(F.col("ts")) * 1000 + F.col("user_id"))
    return t.events.select("event_id", split.alias("n")).select(
        "event_id", ns_join(F.col("n.sec"), F.col("n.nsec")).alias("ns")
    )


@plan(
    "x_to_utc",
    """SELECT event_id, ts - INTERVAL 1 HOUR AS from_amsterdam, ts - INTERVAL 7 HOUR AS from_bangkok,
              ts + INTERVAL 5 HOUR AS from_new_york FROM events""",
)
def x_to_utc(t):
    ts = F.col("ts")
    return t.events.select(
        "event_id", to_utc(ts, "Europe/Amsterdam").alias("from_amsterdam"),
        to_utc(ts, "Asia/Bangkok").alias("from_bangkok"), to_utc(ts, "America/New_York").alias("from_new_york"),
    )


@plan("x_trunc_ms", "SELECT event_id, date_trunc('millisecond', ts)::TIMESTAMP AS ts FROM events")
def x_trunc_ms(t):
    return t.events.select("event_id", trunc_ms(F.col("ts")).alias("ts"))


DICTIONARY_SQL = "(SELECT p, row_number() OVER (ORDER BY p) - 1 AS id FROM (SELECT DISTINCT props AS p FROM events) AS d)"


@plan(
    "x_symbol_encode",
    f"SELECT event_id, d.id AS props_id FROM events LEFT JOIN {DICTIONARY_SQL} AS d ON d.p = props",
)
def x_symbol_encode(t):
    rows = t.events.select("event_id", "props")
    return symbols.symbol_encode(rows, "props", symbols.build_dictionary(rows, "props"))


@plan("x_symbol_decode", "SELECT event_id, props FROM events")
def x_symbol_decode(t):
    rows = t.events.select("event_id", "props")
    dictionary = symbols.build_dictionary(rows, "props")
    return symbols.symbol_decode(symbols.symbol_encode(rows, "props", dictionary), "props", dictionary)


def narrow_digits(value: Column, name: str, kind: str, bits: int) -> dict[str, Column]:
    """A 64-bit number as digits of so many bits, lowest first, each in a column of the narrow type."""
    last = 63 // bits
    digits = [F.shiftright(value, bits * n) for n in range(last + 1)]
    # The last digit has the sign, the others have none.
    digits[:last] = [digit.bitwiseAND(F.lit((1 << bits) - 1).cast("long")) for digit in digits[:last]]
    return {f"{name}_{n}": digit.cast(kind) for n, digit in enumerate(digits)}


def from_digits(names: Iterable[str], bits: int) -> Column:
    """The number whose digits came out of a cast as 64-bit numbers."""
    return reduce(Column.bitwiseOR, [F.shiftleft(F.col(name), bits * n) for n, name in enumerate(names)])


@plan(
    "x_cast_matrix",
    """SELECT ts, CAST(user_id AS BIGINT) AS from_short, CAST(user_id AS BIGINT) AS from_int,
              CAST(CAST(value AS FLOAT) AS DOUBLE) AS from_float, CAST(user_id AS DOUBLE) AS int_to_double,
              date_trunc('second', ts)::TIMESTAMP AS from_seconds, CAST(user_id AS BIGINT) AS from_text,
              event_type AS as_text, CAST(NULL AS DOUBLE) AS nothing FROM events""",
)
def x_cast_matrix(t):
    """Narrow and foreign types come out in the table's types.

    A user number of any size travels in as many short, or int, columns as it needs.
    """
    user, seconds = F.col("user_id"), F.date_trunc("second", "ts")
    shorts, ints = narrow_digits(user, "from_short", "short", 15), narrow_digits(user, "from_int", "int", 31)
    kinds = {
        **dict.fromkeys([*shorts, *ints], ColumnType.INT64), "from_float": ColumnType.DOUBLE,
        "int_to_double": ColumnType.DOUBLE, "from_seconds": ColumnType.TIMESTAMP, "from_text": ColumnType.INT64,
        "as_text": ColumnType.STRING, "nothing": ColumnType.DOUBLE,
    }
    schema = TableSchema("cast", tuple(ColumnInfo(n, k) for n, k in kinds.items()))
    raw = t.events.select(
        F.col("ts").alias(TS), *[digit.alias(n) for n, digit in {**shorts, **ints}.items()],
        F.col("value").cast("float").alias("from_float"), user.alias("int_to_double"),
        seconds.alias("from_seconds"), user.cast("string").alias("from_text"),
        F.col("event_type").alias("as_text"), F.lit(None).alias("nothing"),
    )
    cast = write.cast_to(raw, schema)
    return cast.select(
        F.col(TS).alias("ts"), from_digits(shorts, 15).alias("from_short"), from_digits(ints, 31).alias("from_int"),
        "from_float", "int_to_double", "from_seconds", "from_text", "as_text", "nothing",
    )
