"""The operators on the given tables, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, exact_dedup, lexical_search, line_dedup, lm_scoring, near_dedup, packing, quality_model
from tidemark.llm import quality_rules, sharding, spelling, token_counts, warc
from tidemark.llm.common import id_bucket, reachable, stored

BYTE_RANKS = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"
WORD_BPE = "word_bpe_49k.json"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name; ``sql`` gives the same rows elsewhere."""

    def register(build):
        QUERIES[build.__name__] = build
        if sql is not None:
            SQL[build.__name__] = sql
        return build

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def vocabulary(name: str) -> str:
    """Where the files of the public tokenizers are; the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query(
    r"""
    WITH l AS (
        SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
    ), w AS (
        SELECT doc_id, place, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS words FROM l
    ), c AS (
        SELECT doc_id, place, line, words, len(words) AS n, list_sum(list_transform(words, lambda x: length(x))) AS chars,
               length(line) - length(translate(line, '#*$%&|<>', '')) AS symbols,
               len(regexp_extract_all(line || ' ', '[!?#*$%&~^=+<>|]{2,}[\x20\x09-\x0D]')) AS marked,
               len(list_filter(words, lambda x: length(x) <= 2 AND translate(x, '|»«›‹•·>/', '') = '')) AS separators
        FROM w WHERE len(words) > 0
    ), f AS (
        SELECT *, 100 * marked > 30 * n OR 2 * symbols > n OR (separators >= 2 AND 100 * separators >= 15 * n)
                  OR (n <= 10 AND NOT regexp_matches(words[-1], '[.!?…:;"''”’»)\]}。！？]$')
                      AND (n <= 3 OR len(list_filter(words, lambda x: NOT regexp_matches(x, '^\p{Lu}'))) = 0))
                  OR (n <= 20 AND regexp_matches(line, '(?i){PHRASES}'))
                  OR (n >= 10 AND 100 * len(list_distinct(words)) < 30 * n) AS fails
        FROM c
    ), d AS (
        SELECT doc_id, sum(n) AS n_words, sum(chars) AS word_chars, sum(symbols) AS n_symbols,
               count(*) - count(DISTINCT line) AS n_dup_lines, count(*) FILTER (fails) AS n_removed_lines,
               coalesce(sum(chars) FILTER (fails), 0) AS removed_chars, count(*) AS n_lines,
               flatten(list(words ORDER BY place)) AS words
        FROM f GROUP BY doc_id
    ), p AS (
        SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS i FROM d
    ), q AS (
        SELECT doc_id, i, word, lead(word) OVER o AS second, lead(word, 2) OVER o AS third
        FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)
    ), t AS (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, word, second, third) AS times FROM q WHERE third IS NOT NULL
    ), r AS (
        SELECT doc_id, count(DISTINCT i + k) AS repeats FROM t, (VALUES (0), (1), (2)) AS o(k) WHERE times > 1 GROUP BY doc_id
    ), b AS (
        SELECT docs.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
               coalesce(n_symbols, 0) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
               coalesce(repeats, 0) AS n_repeat_words, coalesce(n_removed_lines, 0) AS n_removed_lines,
               coalesce(removed_chars, 0) AS removed_chars, coalesce(n_lines, 0) AS n_lines
        FROM documents AS docs LEFT JOIN d USING (doc_id) LEFT JOIN r USING (doc_id)
    )
    SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines,
           n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_lines > n_removed_lines
               AND 100 * removed_chars <= 30 * word_chars AS kept,
           n_removed_lines, removed_chars::BIGINT AS removed_chars
    FROM b
    """.replace("{PHRASES}", quality_rules.PHRASES.pattern.replace("'", "''"))
)
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return docs.select("doc_id", quality_rules.assess(F.col("text")).alias("q")).select("doc_id", "q.*")


@query(
    r"""
    WITH n AS (
        SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
    ), g AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY body)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM n JOIN g USING (body)
    """
)
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.mark(documents(spark, sf_dir))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


@query()
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir).select("doc_id", "text"), vocabulary(WORD_BPE))


def quality_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels that may be learned from; every fifth id, by its hash, is held out."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return labels.where(id_bucket(F.col("doc_id"), 5) != 0).select("doc_id", "quality")


@query()
def op4_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = spark.sparkContext.broadcast(quality_model.fit(docs, quality_labels(spark, sf_dir)))
    return docs.select("doc_id", quality_model.score(F.col("text"), model).alias("score")).select(
        "doc_id", (id_bucket(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= quality_model.THRESHOLD).cast("int").alias("predicted"),
    )


@query()
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = vocabulary(BYTE_RANKS)
    coded = byte_bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(byte_bpe.decode(F.col("ids"), ranks), 256).alias("decoded_sha256"),
    )


@query()
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.add_counts(documents(spark, sf_dir).select("doc_id", "text"), vocabulary(PIECES)).drop("text")


@query()
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = documents(spark, sf_dir).select(
        "doc_id", (F.octet_length(data) + 16).cast("long").alias("size"), F.crc32(data).alias("text_crc32")
    )
    return sharding.assign(rows, F.col("doc_id"), shards=40).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query(
    r"""
    WITH l AS (
        SELECT doc_id, list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: {
            line: x,
            key: translate(regexp_replace(x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')}) AS lines
        FROM documents
    ), k AS (
        SELECT key, max(doc_id) AS keeper FROM (SELECT DISTINCT doc_id, unnest(lines).key AS key FROM l)
        WHERE length(key) >= 20 GROUP BY key HAVING count(*) >= 3
    ), e AS (
        SELECT doc_id, place, line, keeper IS NOT NULL AND keeper <> doc_id AS gone
        FROM (SELECT doc_id, unnest(lines).line AS line, unnest(lines).key AS key, unnest(range(len(lines))) AS place FROM l)
        LEFT JOIN k USING (key)
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
    FROM e GROUP BY doc_id
    """
)
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated(documents(spark, sf_dir).select("doc_id", "text"))
    sha = F.sha2(F.col("text").cast("binary"), 256)
    return kept.select("doc_id", "n_lines", "n_dropped", sha.alias("kept_sha256"))


@query()
def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.find(documents(spark, sf_dir).select("doc_id", "text"), words=2, percent=80)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


@query()
def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = id_bucket(F.col("doc_id"), 7) == 2
    docs = documents(spark, sf_dir).select("doc_id", held_out.alias("held_out"), "text")
    return lm_scoring.score(docs, ~held_out, code_length=True)


@query(
    r"""
    WITH table_rows AS (
        SELECT i, list_reduce(list_concat([i], range(8)), lambda c, k: xor(c >> 1, (c & 1) * 3988292384)) AS value
        FROM (SELECT unnest(range(256)) AS i)
    ), crc AS (SELECT list(value ORDER BY i) AS steps FROM table_rows
    ), d AS (
        SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[a-zÀ-ÿ]+')) AS run FROM documents
    ), r AS (
        SELECT doc_id, run, count(*) AS times FROM d WHERE length(run) >= 6 GROUP BY ALL
    ), h AS (
        SELECT run, times, xor(list_reduce(
            list_concat([4294967295], list_transform(range(1, strlen(bytes) // 2 + 1), lambda k: ('0x' || substr(bytes, 2 * k - 1, 2))::BIGINT)),
            lambda c, b: xor(c >> 8, steps[xor(c & 255, b) + 1])), 4294967295) AS hash
        FROM (SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS bytes FROM r), crc
    ), w AS (
        SELECT word, sum(times)::BIGINT AS n FROM (
            SELECT times, CASE WHEN hash % 199 <> 0 THEN run
                               ELSE substr(run, 1, hash % length(run)) || substr(run, hash % length(run) + 2) END AS word FROM h)
        WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5
    ), x AS (
        SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w
    ), y AS (
        SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM x
    ), near AS (
        SELECT a.word, b.word AS other, b.n AS other_n FROM y AS a JOIN y AS b
            ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word AND length(a.word) = length(b.word)
        UNION SELECT y.word, w.word, w.n FROM y JOIN w ON y.rest = w.word
        UNION SELECT w.word, y.word, y.n FROM y JOIN w ON y.rest = w.word
    ), best AS (
        SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM near GROUP BY word
    ), f AS (
        SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * n THEN other END AS form,
               CASE WHEN other_n >= 5 * n THEN other_n END AS form_n
        FROM w LEFT JOIN best USING (word)
    ), walk AS (
        WITH RECURSIVE s(word, root, steps) AS (
            SELECT word, word, 0 FROM f UNION ALL SELECT s.word, f.form, steps + 1 FROM s JOIN f ON f.word = s.root WHERE f.form IS NOT NULL
        ) SELECT word, arg_max(root, steps) AS root FROM s GROUP BY word
    )
    SELECT word, form, root, n, n_near, form_n FROM f JOIN walk USING (word)
    """
)
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    words = spelling.count_words(docs, least_length=6, least_count=5, change=spelling.delete_one, every=199)
    return spelling.variants(words, times=5)


@query(
    r"""
    WITH d AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
    ), i AS (
        SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
    ), q AS (SELECT item_id, term, count(*) AS times FROM i GROUP BY ALL
    ), s AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0
    ), t AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY ALL
    ), w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM t, s GROUP BY term, n_docs
    ), c AS (
        SELECT item_id, doc_id,
               sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
        FROM q JOIN t USING (term) JOIN w USING (term), s GROUP BY item_id, doc_id
    )
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
    FROM c WHERE score > 0 QUALIFY rank <= 10
    """
)
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return lexical_search.search(documents(spark, sf_dir), items, k=10)


@query(
    r"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages
    ), h AS (
        SELECT page_id, octet_length(encode(payload)) AS payload_bytes, sha1(payload) AS hex,
               max(page_id) OVER (PARTITION BY payload) AS response FROM p
    )
    SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
           array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
               (('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)), '') AS payload_digest,
           CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> response THEN response END AS refers_to
    FROM h
    """
)
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    reachable(spark)
    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet")
    folder = warc.archive_folder(spark)
    index = warc.write(pages, folder, least_bytes=0)
    records = stored(warc.read(index, folder, payloads=False).drop("payload", "url"), "warc-records")
    return warc.resolve(records).select(
        "page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to"
    )
