"""Ranked lexical search that scores each distinct bag of words once.

Terms are runs of ASCII letters, digits and code points beyond ASCII, A-Z in lower case. An
item's score of a document sums, over the item's terms with repeats, the term's weight times
a saturated frequency (``frequency``), in whole numbers, so that equal documents tie exactly.

1. One pass reduces each document to its bag: the terms that any item has, with their
   frequencies. Its length, N, L and the terms' document counts come from all documents.
2. Documents whose bag and length norm ``m`` are equal score the same for every item. They
   form a class: rows meet by a hash of both and are told apart by the full bags.
3. Each class is scored once, against all items of a block, by way of the items' postings.
   The k best classes of an item (by score, then smallest id) hold its k best documents.
4. Only the best classes are expanded to their members, in ascending order of ids.

Items are taken in blocks of at most ``BLOCK_CHARS`` characters (a longer item is a block by
itself), each of which reads all documents; a block's vocabulary is broadcast. Classes are
combined in each task before they are shuffled, so a bag that a third of all documents have
is no burden.

Null, empty and termless texts have no terms: such documents count nowhere, such items find
nothing. Repeated documents, also those with equal ids, each have a rank; null ids come
last. Items with equal ids are told apart by their place in the result only. Other columns
play no part. Without documents or items the result is empty.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable
from functools import reduce
from itertools import chain, repeat
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import column, stored

BLOCK_CHARS = 4_000_000
PART_BYTES = 4_000_000
SCORED_CELLS = 4_000_000  # scores held at once: classes times items
# Bytes of terms: ASCII letters (in lower case) and digits, and all bytes of other code points.
TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower())


def term_lists(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of a few megabytes."""
    data = (text or "").encode().translate(TERM_BYTES)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PART_BYTES)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def packed(keys: np.ndarray, width: int, documents: int) -> pa.Array:
    """Bags from ``document * width + term`` per occurrence: (term, frequency) as 32-bit numbers."""
    found, times = np.unique(keys, return_counts=True)
    pairs = np.stack([found % width, times], axis=1).astype("<u4")
    ends = np.zeros(documents + 1, np.int32)
    np.cumsum(8 * np.bincount(found // width, minlength=documents), out=ends[1:])
    return pa.Array.from_buffers(pa.binary(), documents, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(pairs))])


def unpacked(bags: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and frequency of every entry of the bags."""
    pairs = np.frombuffer(b"".join(bags), "<u4").reshape(-1, 2).astype(np.int64)
    return np.repeat(np.arange(len(bags)), [len(b) // 8 for b in bags]), pairs[:, 0], pairs[:, 1]


def _bags(vocabulary) -> Callable:
    """Documents with terms: id, number of terms, bag."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value
        width = max(1, len(number))
        for batch in batches:
            start, held, sizes, keys = 0, 0, [], []
            for row, text in enumerate(batch.column("text")):
                size = 0
                for words in term_lists(text.as_py()):
                    known = np.fromiter(map(number.get, words, repeat(-1)), np.int64, len(words))
                    keys.append(known[known >= 0] + len(sizes) * width)
                    size += len(words)
                sizes.append(size)
                held += size
                if held > PART_BYTES // 4 or row + 1 == len(batch):
                    found = pa.RecordBatch.from_arrays(
                        [
                            batch.column("id").slice(start, len(sizes)), pa.array(sizes, pa.int64()),
                            packed(np.concatenate([np.zeros(0, np.int64), *keys]), width, len(sizes)),
                        ],
                        ["id", "n", "bag"],
                    )
                    yield found.filter(pa.array(np.array(sizes) > 0))
                    start, held, sizes, keys = row + 1, 0, [], []

    return run


def _document_counts(width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for batch in batches:
            total += np.bincount(unpacked(batch.column("bag").to_pylist())[1], minlength=width)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["term", "df"])

    return run


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def frequency(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term's occurrences count for, saturated, in millionths."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def norm(n: str, documents: int, length: int) -> str:
    """SQL for m: a quarter, and three quarters of a document's length over the mean length, in hundredths."""
    return f"25 + CAST((75 * CAST({n} AS DECIMAL(20, 0)) * {documents}) div CAST({max(1, length)} AS DECIMAL(20, 0)) AS BIGINT)"


def summed(cells: np.ndarray, values: np.ndarray, size: int, bound: float) -> np.ndarray:
    """Sums of whole numbers per cell, exact; in two halves where a sum may exceed 2 ** 53."""
    if bound < 2**53:
        return np.bincount(cells, values, size).astype(np.int64)
    halves = np.bincount(cells, values >> 24, size), np.bincount(cells, values & 0xFFFFFF, size)
    return (halves[0].astype(np.int64) << 24) + halves[1].astype(np.int64)


class Postings:
    """Items by term, each with its repeats times the term's weight."""

    def __init__(self, items: list[Counter], weights: np.ndarray) -> None:
        entries = sorted((t, i, times * int(weights[t])) for i, counts in enumerate(items) for t, times in counts.items())
        found = np.array(entries, np.int64).reshape(-1, 3)
        self.items, self.values, self.size = found[:, 1], found[:, 2], len(items)
        self.starts = np.searchsorted(found[:, 0], np.arange(len(weights) + 1))
        self.bound = 1e6 * max((sum(int(weights[t]) * n for t, n in c.items()) for c in items), default=0)

    def scores(self, bags: list[bytes], m: np.ndarray) -> np.ndarray:
        """One row per bag and one column per item."""
        row, term, tf = unpacked(bags)
        gain = frequency(tf, m[row])
        many = self.starts[term + 1] - self.starts[term]
        entry = np.repeat(self.starts[term] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        cells = np.repeat(row, many) * self.size + self.items[entry]
        found = summed(cells, np.repeat(gain, many) * self.values[entry], len(bags) * self.size, self.bound)
        return found.reshape(len(bags), self.size)


def _best_classes(postings, k: int) -> Callable:
    """A task's k best classes of each item, by score and smallest id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = postings.value
        best: list[list[tuple]] = [[] for _ in range(index.size)]
        least = np.ones(index.size, np.int64)
        step = max(1, SCORED_CELLS // max(1, index.size))
        kind = None
        for batch in batches:
            kind = batch.schema.field("first").type
            for at in range(0, len(batch), step):
                rows = batch.slice(at, step).to_pydict()
                firsts = rows["first"]
                order = sorted(range(len(firsts)), key=lambda i: (firsts[i] is None, firsts[i] if firsts[i] is not None else 0))
                rank = np.zeros(len(firsts), np.int64)
                rank[order] = np.arange(len(firsts))
                scores = index.scores(rows["bag"], np.array(rows["m"], np.int64))
                for item in np.flatnonzero((scores >= least).any(0)).tolist():
                    own = scores[:, item]
                    some = np.flatnonzero(own >= least[item])
                    for i in some[np.lexsort((rank[some], -own[some]))][:k].tolist():
                        key = (-int(own[i]), firsts[i] is None, 0 if firsts[i] is None else firsts[i])
                        best[item].append((key, rows["h"][i], rows["m"][i], rows["bag"][i]))
                    best[item] = sorted(best[item], key=lambda b: b[0])[:k]
                    if len(best[item]) == k:
                        least[item] = -best[item][-1][0][0]
        if kind is not None:
            flat = [(item, -key[0], None if key[1] else key[2], h, m, bag) for item, own in enumerate(best) for key, h, m, bag in own]
            kinds = [pa.int64(), pa.int64(), kind, pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[i] for f in flat], t) for i, t in enumerate(kinds)], ["item", "score", "first", "h", "m", "bag"]
            )

    return run


def _blocks(items: DataFrame) -> Iterator[list[tuple[object, str]]]:
    block, chars = [], 0
    for item, text in items.toLocalIterator():
        if block and chars + len(text or "") > BLOCK_CHARS:
            yield block
            block, chars = [], 0
        block.append((item, text or ""))
        chars += len(text or "")
    if block:
        yield block


def _search_block(docs: DataFrame, block: list[tuple[object, str]], kind, k: int) -> DataFrame:
    spark = docs.sparkSession
    counted = [Counter(chain.from_iterable(term_lists(text))) for _, text in block]
    number = {t: i for i, t in enumerate(sorted(set().union(*counted)))}
    id_type = docs.schema["id"].dataType.simpleString()
    bags = stored(
        docs.mapInArrow(_bags(spark.sparkContext.broadcast(number)), f"id {id_type}, n long, bag binary"), "bags"
    )
    documents, length = bags.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(number), np.int64)
    counts = bags.mapInArrow(_document_counts(len(number)), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for term, times in counts.collect():
        df[term] = times
    weights = np.array([weight(documents, int(n)) for n in df], np.int64)
    postings = Postings([Counter({number[t]: n for t, n in c.items()}) for c in counted], weights)

    members = bags.where("octet_length(bag) > 0").select(
        "id", F.xxhash64("bag").alias("h"), F.expr(norm("n", documents, length)).alias("m"), "bag"
    )
    classes = members.groupBy("h", "m", "bag").agg(F.min("id").alias("first"))
    scored = classes.mapInArrow(
        _best_classes(spark.sparkContext.broadcast(postings), k),
        f"item long, score long, first {id_type}, h long, m long, bag binary",
    )
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("first"))
    # At most k classes of each item of the block.
    winners = stored(scored.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k), "best-classes")
    chosen = winners.select("h", "m", "bag").distinct()
    within = Window.partitionBy("h", "m", "bag").orderBy(F.asc_nulls_last("id"))
    expanded = members.join(chosen, ["h", "m", "bag"], "left_semi").withColumn("place", F.row_number().over(within))
    expanded = expanded.where(F.col("place") <= k).select("id", "h", "m", "bag")
    rank = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = winners.select("item", "score", "h", "m", "bag").join(expanded, ["h", "m", "bag"])
    ranked = ranked.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
    ids = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], f"item long, item_id {kind}")
    return ranked.join(F.broadcast(ids), "item").select("item_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("doc_id"), "score")


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank (from 1), doc_id, score (above 0)."""
    rows = docs.select(column(docs, id_col).alias("id"), column(docs, text_col).alias("text"))
    asked = items.select(column(items, item_id_col).alias("id"), column(items, item_text_col).alias("text"))
    kind = asked.schema["id"].dataType.simpleString()
    found = [_search_block(rows, block, kind, k) for block in _blocks(asked)]
    if not found:
        of = rows.schema["id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id {of}, score long")
    return reduce(DataFrame.unionByName, found)
