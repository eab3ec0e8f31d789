"""Plans for keyed values and tags."""

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators import kv, oplog, tags
from tidemark.plans.registry import plan, with_inputs

NOW = datetime(2024, 2, 1)
AT = "TIMESTAMP '2024-02-01 00:00:00'"
JOINED = "kv FULL JOIN requests AS r ON kv.key = r.key"
BOTH = with_inputs("kv", "requests")


def state(t, op, *more):
    return op(t.derived("kv"), t.derived("requests"), *more)


@plan("kv_get", BOTH + """SELECT r.key, kv.value, kv.key IS NULL AS missing FROM requests AS r LEFT JOIN kv ON kv.key = r.key""")
def kv_get(t):
    return kv.get(t.derived("kv"), t.derived("requests"))


@plan(
    "kv_put",
    BOTH + f"""SELECT coalesce(kv.key, r.key) AS key, CASE WHEN kv.key IS NULL THEN r.value ELSE kv.value END AS value,
               CASE WHEN kv.key IS NULL THEN {AT} ELSE kv.modified_at END AS modified_at, kv.expires_at FROM {JOINED}""",
)
def kv_put(t):
    return state(t, kv.put, NOW)[0]


@plan("kv_put_conflicts", BOTH + "SELECT r.key, kv.key IS NULL AS created FROM requests AS r LEFT JOIN kv ON kv.key = r.key")
def kv_put_conflicts(t):
    return state(t, kv.put, NOW)[1]


@plan(
    "kv_update",
    BOTH + f"""SELECT coalesce(kv.key, r.key) AS key, CASE WHEN r.key IS NULL THEN kv.value ELSE r.value END AS value,
               CASE WHEN r.key IS NULL THEN kv.modified_at ELSE {AT} END AS modified_at,
               CASE WHEN r.key IS NULL THEN kv.expires_at END AS expires_at FROM {JOINED}""",
)
def kv_update(t):
    return state(t, kv.update, NOW)[0]


@plan("kv_remove", BOTH + "SELECT kv.* FROM kv WHERE key NOT IN (SELECT key FROM requests WHERE value < 0)")
def kv_remove(t):
    """Requests come from customers in debt."""
    return kv.remove(t.derived("kv"), t.derived("requests").where("value < 0"))[0]


@plan(
    "kv_remove_result",
    BOTH + "SELECT r.key, kv.key IS NOT NULL AS removed FROM requests AS r LEFT JOIN kv ON kv.key = r.key",
)
def kv_remove_result(t):
    return kv.remove(t.derived("kv"), t.derived("requests"))[1]


@plan(
    "kv_remove_if",
    BOTH + """SELECT kv.* FROM kv LEFT JOIN requests AS r ON kv.key = r.key
              WHERE r.key IS NULL OR r.comparand <> kv.value""",
)
def kv_remove_if(t):
    return state(t, kv.remove_if)[0]


@plan(
    "kv_get_and_update",
    BOTH + "SELECT r.key, kv.value AS old_value, kv.key IS NULL AS missing FROM requests AS r LEFT JOIN kv ON kv.key = r.key",
)
def kv_get_and_update(t):
    return state(t, kv.get_and_update, NOW)[1]


@plan(
    "kv_get_and_update_state",
    BOTH + f"""SELECT kv.key, coalesce(r.value, kv.value) AS value,
               CASE WHEN r.key IS NULL THEN kv.modified_at ELSE {AT} END AS modified_at,
               CASE WHEN r.key IS NULL THEN kv.expires_at END AS expires_at
               FROM kv LEFT JOIN requests AS r ON kv.key = r.key""",
)
def kv_get_and_update_state(t):
    return state(t, kv.get_and_update, NOW)[0]


@plan(
    "kv_get_and_remove",
    BOTH + "SELECT r.key, kv.value AS old_value, kv.key IS NULL AS missing FROM requests AS r LEFT JOIN kv ON kv.key = r.key",
)
def kv_get_and_remove(t):
    return state(t, kv.get_and_remove)[1]


@plan(
    "kv_cas",
    BOTH + f"""SELECT kv.key, CASE WHEN r.comparand = kv.value THEN r.value ELSE kv.value END AS value,
               CASE WHEN r.comparand = kv.value THEN {AT} ELSE kv.modified_at END AS modified_at,
               CASE WHEN r.comparand = kv.value THEN NULL ELSE kv.expires_at END AS expires_at
               FROM kv LEFT JOIN requests AS r ON kv.key = r.key""",
)
def kv_cas(t):
    return state(t, kv.compare_and_swap, NOW)[0]


@plan(
    "kv_cas_result",
    BOTH + """SELECT r.key, coalesce(r.comparand = kv.value, FALSE) AS swapped,
              CASE WHEN r.comparand = kv.value THEN NULL ELSE kv.value END AS current, kv.key IS NULL AS missing
              FROM requests AS r LEFT JOIN kv ON kv.key = r.key""",
)
def kv_cas_result(t):
    return state(t, kv.compare_and_swap, NOW)[1]


ADDENDS_SQL = "SELECT o_custkey AS key, CAST(round(o_totalprice) AS BIGINT) AS addend FROM orders"
ADD_SQL = with_inputs("kv") + f", adds AS (SELECT key, CAST(sum(addend) AS BIGINT) AS addend FROM ({ADDENDS_SQL}) AS a GROUP BY key) "


def addends(t):
    """Every order adds to its customer's value: many requests per key."""
    return t.table("orders").select(
        F.col("o_custkey").alias("key"), F.round("o_totalprice").cast("bigint").alias("addend")
    )


@plan(
    "kv_add",
    ADD_SQL + f"""SELECT kv.key, kv.value + coalesce(adds.addend, 0) AS value,
                  CASE WHEN adds.key IS NULL THEN kv.modified_at ELSE {AT} END AS modified_at, expires_at
                  FROM kv LEFT JOIN adds ON kv.key = adds.key""",
)
def kv_add(t):
    return kv.add(t.derived("kv"), addends(t), NOW)[0]


@plan(
    "kv_add_result",
    ADD_SQL + """SELECT adds.key, kv.value + adds.addend AS total, kv.key IS NULL AS missing
                 FROM adds LEFT JOIN kv ON kv.key = adds.key""",
)
def kv_add_result(t):
    return kv.add(t.derived("kv"), addends(t), NOW)[1]


@plan(
    "kv_expire_at",
    BOTH + """SELECT kv.key, kv.value, modified_at, CASE WHEN r.key IS NULL THEN expires_at
              ELSE date_trunc('millisecond', TIMESTAMP '2024-02-02 03:04:05.678912')::TIMESTAMP END AS expires_at
              FROM kv LEFT JOIN requests AS r ON kv.key = r.key""",
)
def kv_expire_at(t):
    when = F.lit("2024-02-02 03:04:05.678912").cast("timestamp_ntz")
    return kv.expire_at(t.derived("kv"), t.derived("requests").select("key", when.alias("expires_at")))[0]


@plan(
    "kv_expire_from_now",
    BOTH + f"""SELECT kv.key, kv.value, modified_at, CASE WHEN r.key IS NULL THEN expires_at
               ELSE {AT} + to_hours(CAST(r.key % 5 AS INTEGER)) END AS expires_at
               FROM kv LEFT JOIN requests AS r ON kv.key = r.key""",
)
def kv_expire_from_now(t):
    after = F.expr("make_dt_interval(0, CAST(key % 5 AS INT), 0, 0)")
    return kv.expire_from_now(t.derived("kv"), t.derived("requests").select("key", after.alias("after")), NOW)[0]


@plan(
    "kv_metadata",
    BOTH + """SELECT r.key, CASE WHEN kv.key IS NOT NULL THEN 'integer' END AS type,
              CASE WHEN kv.key IS NOT NULL THEN CAST(8 AS BIGINT) END AS size,
              date_trunc('second', modified_at)::TIMESTAMP AS modified_at, expires_at, kv.key IS NOT NULL AS exists
              FROM requests AS r LEFT JOIN kv ON kv.key = r.key""",
)
def kv_metadata(t):
    return kv.metadata(t.derived("kv"), t.derived("requests"), "integer")


@plan(
    "kv_metadata_text",
    """SELECT doc_id AS key, 'string' AS type, CAST(octet_length(encode(text)) AS BIGINT) AS size,
              TIMESTAMP '2024-02-01' AS modified_at, CAST(NULL AS TIMESTAMP) AS expires_at, TRUE AS exists
       FROM documents""",
)
def kv_metadata_text(t):
    """Size of whole texts in bytes."""
    from tidemark.functions.time import timestamp

    texts = t.table("documents").select(
        F.col("doc_id").alias("key"), F.col("text").alias("value"), timestamp(NOW).alias("modified_at"),
        F.lit(None).cast("timestamp_ntz").alias("expires_at"),
    )
    return kv.metadata(texts, texts.select("key"), "string")


def operations(t):
    """Events as operations on their user's value; which one follows from type and value."""
    cents = F.round(F.col("value") * 100).cast("bigint")
    chosen = F.expr(
        """CASE event_type WHEN 'click' THEN 'add' WHEN 'view' THEN 'get' WHEN 'purchase' THEN 'update'
           WHEN 'signup' THEN CASE WHEN value < 10 THEN 'get_and_remove' WHEN value < 40 THEN 'put'
                              ELSE 'get_and_update' END
           ELSE CASE WHEN value < 20 THEN 'cas' WHEN value < 40 THEN 'remove_if' ELSE 'remove' END END"""
    )
    return t.events.select(
        F.col("user_id").alias("key"), F.col("event_id").alias("seq"), chosen.alias("op"),
        (cents % 7).alias("value"), (cents % 3).alias("comparand"),
    )


# The same log, folded one operation of each key after the other.
REPLAY_SQL = with_inputs("kv").replace("WITH ", "WITH RECURSIVE ", 1) + """, log AS (
    SELECT user_id AS key, event_id AS seq, CAST(round(value * 100) AS BIGINT) % 7 AS value,
           CAST(round(value * 100) AS BIGINT) % 3 AS comparand,
           CASE event_type WHEN 'click' THEN 'add' WHEN 'view' THEN 'get' WHEN 'purchase' THEN 'update'
           WHEN 'signup' THEN CASE WHEN value < 10 THEN 'get_and_remove' WHEN value < 40 THEN 'put'
                              ELSE 'get_and_update' END
           ELSE CASE WHEN value < 20 THEN 'cas' WHEN value < 40 THEN 'remove_if' ELSE 'remove' END END AS op,
           row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n
    FROM events
), folded(key, n, seq, op, had, before, has, after) AS (
    SELECT key, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), FALSE, CAST(NULL AS BIGINT), kv.key IS NOT NULL, kv.value
    FROM (SELECT DISTINCT key FROM log) AS keys LEFT JOIN kv USING (key)
    UNION ALL
    SELECT l.key, l.n, l.seq, l.op, f.has, f.after,
           CASE WHEN l.op IN ('update', 'put') THEN TRUE WHEN l.op IN ('remove', 'get_and_remove') THEN FALSE
                WHEN l.op = 'remove_if' AND f.after = l.comparand THEN FALSE ELSE f.has END,
           CASE WHEN l.op = 'update' THEN l.value WHEN l.op IN ('remove', 'get_and_remove') THEN NULL
                WHEN l.op = 'put' THEN CASE WHEN f.has THEN f.after ELSE l.value END
                WHEN NOT f.has THEN NULL WHEN l.op = 'add' THEN f.after + l.value WHEN l.op = 'get_and_update' THEN l.value
                WHEN l.op = 'cas' AND f.after = l.comparand THEN l.value
                WHEN l.op = 'remove_if' AND f.after = l.comparand THEN NULL ELSE f.after END
    FROM folded AS f JOIN log AS l ON l.key = f.key AND l.n = f.n + 1
) """


@plan(
    "kv_replay",
    REPLAY_SQL
    + """SELECT l.key, l.seq, l.op,
              CASE WHEN l.op = 'update' THEN TRUE WHEN l.op = 'put' THEN NOT f.had
                   WHEN l.op = 'remove_if' THEN f.had AND NOT f.has
                   WHEN l.op = 'cas' THEN f.had AND f.before = l.comparand ELSE f.had END AS ok,
              CASE WHEN l.op IN ('get', 'get_and_update', 'get_and_remove') THEN f.before WHEN l.op = 'add' THEN f.after
                   WHEN l.op = 'cas' AND f.before <> l.comparand THEN f.before END AS result
       FROM folded AS f JOIN log AS l ON l.key = f.key AND l.n = f.n""",
)
def kv_replay(t):
    """Result of every operation of the log, in log order per key."""
    return oplog.replay(t.derived("kv"), operations(t))[1]


@plan(
    "kv_replay_state",
    REPLAY_SQL
    + """SELECT key, value FROM kv WHERE key NOT IN (SELECT key FROM log)
       UNION ALL SELECT key, after FROM folded WHERE has AND (key, n) IN (SELECT (key, max(n)) FROM log GROUP BY key)""",
)
def kv_replay_state(t):
    """Values after the whole log."""
    return oplog.replay(t.derived("kv"), operations(t))[0]


# ---------------------------------------------------------------- tags

# Every customer asks for a tag on the user of the same number; some users have it.
TAG_REQUESTS_SQL = """SELECT DISTINCT concat('user-', CAST(c_custkey AS STRING)) AS alias, 'integer' AS entry_type,
    CASE WHEN c_nationkey < 12 THEN 'web' ELSE lower(c_mktsegment) END AS tag FROM customer"""
TAG_SQL = with_inputs("tags") + f", asked AS ({TAG_REQUESTS_SQL}) "


def tag_requests(t):
    tag = F.when(F.col("c_nationkey") < 12, "web").otherwise(F.lower("c_mktsegment"))
    return t.table("customer").select(
        F.concat(F.lit("user-"), F.col("c_custkey").cast("string")).alias("alias"),
        F.lit("integer").alias("entry_type"), tag.alias("tag"),
    )


@plan("tag_attach", TAG_SQL + "SELECT * FROM tags UNION SELECT * FROM asked")
def tag_attach(t):
    return tags.attach(t.tags, tag_requests(t))[0]


@plan(
    "tag_attach_result",
    TAG_SQL + """SELECT alias, tag, NOT EXISTS (SELECT 1 FROM tags WHERE tags.alias = asked.alias
                 AND tags.tag = asked.tag) AS changed FROM asked""",
)
def tag_attach_result(t):
    return tags.attach(t.tags, tag_requests(t))[1]


@plan(
    "tag_detach",
    TAG_SQL + """SELECT * FROM tags WHERE NOT EXISTS (
                 SELECT 1 FROM asked WHERE tags.alias = asked.alias AND tags.tag = asked.tag)""",
)
def tag_detach(t):
    return tags.detach(t.tags, tag_requests(t))[0]


@plan(
    "tag_detach_result",
    TAG_SQL + """SELECT alias, tag, EXISTS (SELECT 1 FROM tags WHERE tags.alias = asked.alias
                 AND tags.tag = asked.tag) AS changed FROM asked""",
)
def tag_detach_result(t):
    return tags.detach(t.tags, tag_requests(t))[1]


@plan(
    "tag_has",
    TAG_SQL + """SELECT alias, tag, EXISTS (SELECT 1 FROM tags WHERE tags.alias = asked.alias
                 AND tags.tag = asked.tag) AS has_tag FROM asked""",
)
def tag_has(t):
    return tags.has_tag(t.tags, tag_requests(t))


@plan("tag_get_tags", TAG_SQL + "SELECT DISTINCT alias, tag FROM tags WHERE alias IN (SELECT alias FROM asked)")
def tag_get_tags(t):
    return tags.tags_of(t.tags, tag_requests(t))


@plan("tag_entries", TAG_SQL + "SELECT DISTINCT alias, entry_type FROM tags WHERE tag = 'web'")
def tag_entries(t):
    return tags.entries_of(t.tags, "web")


@plan(
    "find",
    TAG_SQL + """SELECT alias FROM tags WHERE tag IN ('en', 'web') AND entry_type = 'blob'
                 GROUP BY alias HAVING count(DISTINCT tag) = 2""",
)
def find(t):
    return tags.find(t.tags, all_of=["en", "web"], entry_type="blob")

