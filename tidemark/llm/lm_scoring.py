"""Language-model scores of texts by context-tree weighting over bytes.

A text is lower-cased (A-Z) and coded byte by byte, from its first byte to its end, by a
context tree (see ``context_tree``) that is learned from the training rows. Every context
that training texts hold is a node, so the tree grows with the corpus; it is kept in pieces.

1. Documents are put into blocks. A block lists its distinct words and grams (a byte and the
   ``DEPTH`` before it) with their counts in training texts, and deals them out to buckets:
   words by their hash, grams by the end of their context.
2. Buckets sum the counts of all blocks, and weigh their part of the tree. What all parts
   share, contexts of two bytes and less, is made by the driver and broadcast; it is
   bounded by 2 ** 24 grams of three bytes, whatever the corpus.
3. Buckets score each of their distinct grams once, and send scores and counts back to the
   blocks. There each document adds up its own.

The baseline next to it is the smoothed unigram: the sum over a text's words and its end of
log10((c + 1) / (N + V + 1)), c the token's count, N that of all and V of distinct training
tokens.

A null text is empty: one empty line and the end. Without training rows every count is 0
and each bit has an even chance. Repeated rows count as often as they occur. Other columns
are carried; names of added columns are changed if taken.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.blocks import BUCKETS_PER_PARTITION, pack_numbers, pack_words, text_blocks, unpack_numbers, unpack_words
from tidemark.llm.common import WORD, column, fresh_name, lower_ascii, partitions, stored
from tidemark.llm.context_tree import TOP, TEXT_END, Branch, Crown, branch_of, cut, stream, stream_grams, summed

FIGURES = ["n_tokens", "distinct"]
LISTS = "words binary, counts binary, grams binary, times binary"
LINK = "struct<block:bigint,words:binary,grams:binary>"
ADDED = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
CODE_LENGTH = ["coded_bytes", "bits_per_byte"]
FINE = 2.0**40
BITS = math.log2(10)


def tokens(text: str) -> list[str]:
    """The words of a text in lower case, and its end."""
    return [*WORD.findall(text), TEXT_END.decode()]


def pack_array(values: np.ndarray) -> bytes:
    """64-bit numbers or floats, byte plane by byte plane, compressed."""
    size = values.dtype.itemsize
    return zlib.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, size).T).tobytes(), 1)


def unpack_array(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def pack_sorted(codes: np.ndarray) -> bytes:
    return pack_array(np.diff(codes, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack_array(data, np.uint64), dtype=np.uint64)


def distinct_grams(streams: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct grams of all streams with their counts."""
    found = [np.unique(codes, return_counts=True) for codes, _ in stream_grams(streams)]
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return summed(np.concatenate([c for c, _ in found]), np.concatenate([n for _, n in found]))


def dealt(buckets_of: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in bucket order, and where each bucket starts among them."""
    order = np.argsort(buckets_of, kind="stable")
    return order, np.searchsorted(buckets_of[order], np.arange(buckets + 1))


def word_bucket(words: list[bytes], buckets: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))


def _list_blocks(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of documents with their packed texts, and of their block's lists by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for part in text_blocks(batches):
            texts = [lower_ascii(t) for t in part.column("text").to_pylist()]
            counted = part.column("counts").to_pylist()
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for text, counts in zip(texts, counted):
                seen[counts].update(tokens(text))
            known = {w.encode(): seen[True][w] for w in seen[False].keys() | seen[True].keys()}
            words = sorted(known)
            trained, many = distinct_grams([stream(t) for t, c in zip(texts, counted) if c])
            others, none = distinct_grams([stream(t) for t, c in zip(texts, counted) if not c])
            codes, times = summed(np.concatenate([trained, others]), np.concatenate([many, none * 0]))
            by_word, word_at = dealt(word_bucket(words, buckets), buckets)
            by_gram, gram_at = dealt(branch_of(codes, buckets), buckets)
            filled, lists = [], []
            for k in range(buckets):
                own, grams = by_word[word_at[k] : word_at[k + 1]], by_gram[gram_at[k] : gram_at[k + 1]]
                if len(own) or len(grams):
                    filled.append(k)
                    mine = [words[i] for i in own]
                    counts = np.array([known[w] for w in mine], np.int64)
                    lists.append((pack_words(mine) if mine else None, pack_array(counts), pack_sorted(codes[grams]), pack_array(times[grams])))
            nulls = pa.nulls(len(part), pa.binary())
            rest, empty = pa.nulls(len(filled), part.column("row").type), pa.nulls(len(filled), pa.binary())
            yield pa.RecordBatch.from_pydict({
                "row": pa.concat_arrays([part.column("row"), rest]),
                "block": pa.array([block] * (len(part) + len(filled)), pa.int64()),
                "bucket": pa.array([-1] * len(part) + filled, pa.int32()),
                "text": pa.concat_arrays([pa.array([zlib.compress(t.encode(), 1) for t in texts], pa.binary()), empty]),
                **{
                    name: pa.concat_arrays([nulls, pa.array([row[i] for row in lists], pa.binary())])
                    for i, name in enumerate(["words", "counts", "grams", "times"])
                },
            })
            block += 1

    return run


def _bucket_row(bucket: int, rows: list[tuple]) -> dict:
    """One bucket's distinct words and grams, their training counts, and where each block uses them."""
    place: dict[bytes, int] = {}
    word_places, word_counts = [], []
    for _, words, counts, _, _ in rows:
        word_places.append(np.array([place.setdefault(w, len(place)) for w in unpack_words(words)] if words else [], np.int64))
        word_counts.append(unpack_array(counts, np.int64))
    known = np.zeros(len(place), np.int64)
    for at, counts in zip(word_places, word_counts):
        known[at] += counts  # a block lists each word once
    grams = [unpack_sorted(row[3]) for row in rows]
    codes, times = summed(np.concatenate(grams), np.concatenate([unpack_array(row[4], np.int64) for row in rows]))
    links = [
        {"block": row[0], "words": pack_numbers(at), "grams": pack_numbers(np.diff(np.searchsorted(codes, own), prepend=0))}
        for row, at, own in zip(rows, word_places, grams)
    ]
    return {
        "bucket": bucket, "known": pack_array(known), "codes": pack_sorted(codes), "times": pack_array(times), "links": links,
        "n_tokens": int(known.sum()), "distinct": int((known > 0).sum()),
    }


def _sum_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("bucket", pa.int32()), ("known", pa.binary()), ("codes", pa.binary()), ("times", pa.binary()),
         ("links", pa.list_(pa.struct([("block", pa.int64()), ("words", pa.binary()), ("grams", pa.binary())])))]
        + [(f, pa.int64()) for f in FIGURES]
    )
    own, rows = None, []
    for batch in batches:
        for bucket, *row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "block", "words", "counts", "grams", "times"))):
            if bucket != own and rows:
                yield pa.RecordBatch.from_pylist([_bucket_row(own, rows)], schema)
                rows = []
            own = bucket
            rows.append(tuple(row))
    if rows:
        yield pa.RecordBatch.from_pylist([_bucket_row(own, rows)], schema)


def trained_branch(codes: np.ndarray, times: np.ndarray) -> Branch:
    return Branch.build(codes[times > 0], times[times > 0])


def _weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (code, n, whole, fine): codes cut to ``TOP`` with counts, and log weights by key (n is null).

    Log weights are split into whole numbers, so that their sums do not depend on the order.
    """
    for batch in batches:
        for packed, counts in zip(batch.column("codes").to_pylist(), batch.column("times").to_pylist()):
            codes, times = unpack_sorted(packed), unpack_array(counts, np.int64)
            short, many = summed(cut(codes, TOP)[times > 0], times[times > 0])
            keys, product = trained_branch(codes, times).product()
            whole = np.floor(product)
            fine = np.rint((product - whole) * FINE)
            none = [pa.nulls(len(short), pa.int64()), pa.nulls(len(keys), pa.int64())]
            yield pa.RecordBatch.from_pydict({
                "code": pa.array(np.concatenate([short, keys]).view(np.int64)),
                "n": pa.concat_arrays([pa.array(many), none[1]]),
                "whole": pa.concat_arrays([none[0], pa.array(whole.astype(np.int64))]),
                "fine": pa.concat_arrays([none[0], pa.array(fine.astype(np.int64))]),
            })


@dataclass
class Learned:
    """What every task needs to score: the crown of the tree, and two totals."""

    crown: Crown
    n_tokens: int
    distinct: int


def learn(buckets: DataFrame) -> Learned:
    """The crown and the totals from the stored buckets."""
    figures = buckets.agg(*[F.coalesce(F.sum(f), F.lit(0)).alias(f) for f in FIGURES]).first()
    found = buckets.select("codes", "times").mapInArrow(_weigh, "code long, n long, whole long, fine long")
    sums = [F.sum(c).alias(c) for c in ("n", "whole", "fine")]
    # Bounded: at most 2 ** 24 codes of three bytes, and keys of two bytes and some bits.
    found = found.groupBy("code", F.col("n").isNull().alias("is_key")).agg(*sums).toPandas().sort_values("code")
    codes, keys = found[~found["is_key"].astype(bool)], found[found["is_key"].astype(bool)]
    product = keys["whole"].to_numpy(np.float64) + keys["fine"].to_numpy(np.float64) / FINE
    crown = Crown.build(
        codes["code"].to_numpy(np.int64).view(np.uint64), codes["n"].to_numpy(np.float64).astype(np.int64),
        keys["code"].to_numpy(np.int64).view(np.uint64), product,
    )
    return Learned(crown, figures.n_tokens, figures.distinct)


def _score_grams(learned: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (block, bucket, known, grams, value) for each block that uses a bucket's words or grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, counts, packed, many, links in zip(*(batch.column(c).to_pylist() for c in ("bucket", "known", "codes", "times", "links"))):
                known, codes, times = unpack_array(counts, np.int64), unpack_sorted(packed), unpack_array(many, np.int64)
                value = trained_branch(codes, times).under(learned.value.crown).log10(codes).astype(np.float32)
                out = []
                for link in links:
                    words = unpack_numbers(link["words"]).astype(np.int64)
                    grams = np.cumsum(unpack_numbers(link["grams"]), dtype=np.int64)
                    out.append((link["block"], bucket, pack_array(known[words]), pack_sorted(codes[grams]), pack_array(value[grams])))
                kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], ["block", "bucket", "known", "grams", "value"]
                )

    return run


def stream_scores(streams: list[bytes], codes: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The sum of each stream's values; ``codes`` are sorted and hold all grams of the streams."""
    out = np.zeros(len(streams))
    for grams, owner in stream_grams(streams):
        order = np.argsort(grams)
        ordered = grams[order]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        found = value[np.searchsorted(codes, ordered[first])]
        each = np.empty(len(grams))
        each[order] = np.repeat(found, np.diff(first, append=len(grams)))
        out += np.bincount(owner, each, len(streams))
    return out


def _add_up(learned: Broadcast, buckets: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        model: Learned = learned.value
        texts = [zlib.decompress(t).decode() for t in docs.column("text").to_pylist()]
        found = found.take(pc.sort_indices(found.column("bucket")))
        streams = [stream(t) for t in texts]
        codes = np.concatenate([unpack_sorted(g) for g in found.column("grams").to_pylist()])
        value = np.concatenate([unpack_array(v, np.float32) for v in found.column("value").to_pylist()])
        by_code = np.argsort(codes)
        codes, value = codes[by_code], value[by_code]
        # The block's words again, in the order in which they were dealt out.
        distinct: set[str] = set()
        for text in texts:
            distinct.update(tokens(text))
        words = sorted(w.encode() for w in distinct)
        known = np.zeros(len(words), np.int64)
        known[dealt(word_bucket(words, buckets), buckets)[0]] = np.concatenate([unpack_array(v, np.int64) for v in found.column("known").to_pylist()])
        count = dict(zip((w.decode() for w in words), known.tolist()))
        divisor = np.log10(model.n_tokens + model.distinct + 1.0)
        out: dict[str, list] = {c: [] for c in ADDED}
        for text in texts:
            own = tokens(text)
            counts = np.fromiter(map(count.__getitem__, own), np.int64, len(own))
            out["n_tokens"].append(len(own))
            out["n_known"].append(int((counts > 0).sum()))
            out["train_tokens"].append(model.n_tokens)
            out["base_score"].append(float(np.log10(counts + 1.0).sum() - len(own) * divisor))
        out["score"] = stream_scores(streams, codes, value).tolist()
        out["coded_bytes"] = [len(data) for data in streams]
        out["bits_per_byte"] = [-s * BITS / n for s, n in zip(out["score"], out["coded_bytes"])]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.float64()]
        return pa.table({"row": docs.column("row")} | {c: pa.array(out[c], k) for c, k in zip(ADDED + CODE_LENGTH, kinds)})

    return run


def score(docs: DataFrame, training: Column, text_col: str = "text", code_length: bool = False) -> DataFrame:
    """``docs`` without their text, with n_tokens, n_known, train_tokens, base_score and score.

    Rows where ``training`` holds are learned from. With ``code_length``, coded_bytes and
    bits_per_byte follow: the bytes that the tree codes for the text, and the bits for each.
    """
    spark = docs.sparkSession
    others = [c for c in docs.columns if c != text_col]
    row = F.struct(*[column(docs, c).alias(c) for c in others]) if others else F.struct(F.lit(0).alias("_"))
    source = docs.select(row.alias("row"), F.coalesce(column(docs, text_col), F.lit("")).alias("text"), F.coalesce(training, F.lit(False)).alias("counts"))
    kind = source.schema["row"].dataType.simpleString()
    count = partitions(spark, source)
    number = BUCKETS_PER_PARTITION * count
    listed = stored(source.mapInArrow(_list_blocks(number), f"row {kind}, block long, bucket int, text binary, {LISTS}"), "listed-texts")
    lists = listed.where("bucket >= 0").select("bucket", "block", "words", "counts", "grams", "times")
    lists = lists.repartition(count, "bucket").sortWithinPartitions("bucket")
    schema = f"bucket int, known binary, codes binary, times binary, links array<{LINK}>, " + ", ".join(f"{f} long" for f in FIGURES)
    buckets = stored(lists.mapInArrow(_sum_buckets, schema), "counted-grams")
    learned = spark.sparkContext.broadcast(learn(buckets))
    scored = buckets.select("bucket", "known", "codes", "times", "links").mapInArrow(
        _score_grams(learned), "block long, bucket int, known binary, grams binary, value binary"
    )
    coded = listed.where("bucket < 0").select("block", "row", "text")
    joined = coded.groupBy("block").cogroup(scored.groupBy("block")).applyInArrow(
        _add_up(learned, number), f"row {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double, coded_bytes long, bits_per_byte double",
    )
    added = ADDED + CODE_LENGTH if code_length else ADDED
    return joined.select(*[F.col("row")[c].alias(c) for c in others], *[F.col(c).alias(fresh_name(docs, c)) for c in added])
