"""A text quality classifier: random-indexing vectors, pooled, and a two-layer network.

Each word counts by two terms: itself (hashed to a fixed number of buckets) and its shape
(case, digits and marks, and whether it repeats the word before). Every term has a fixed
sparse random index vector; a term's word vector is the sum of the index vectors of the
terms around its occurrences. A document is the mean and the spread of its words' vectors.
A network with one hidden layer gives a logit, and a temperature, fitted on training rows
that the network did not see, turns it into a calibrated probability.

Word vectors come from all documents, labelled or not. They are summed up by tasks as whole
numbers, so the result does not depend on their order. The network and the temperature are
fitted on a bounded sample of labelled rows, ``SAMPLE_ROWS`` with the least hashed ids. The
model is 5 MB whatever the input. All rows are scored.

Null and empty texts have no words and score 0. Labels other than 0 and 1, and labels
without an id, are left out; if an id has several labels or rows, each pair is a training
row. If the sample does not hold both labels, every score is the share of label 1 in it
(0.5 if it is empty). Other columns of the documents play no part.
"""

from __future__ import annotations

import re
import sys
import zlib
from dataclasses import dataclass
from typing import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, stored

SAMPLE_ROWS = 6_000
WORD_BUCKETS, SHAPE_BUCKETS, DIM, NONZERO, WINDOW = 1 << 14, 1 << 10, 64, 4, 2
HIDDEN, EPOCHS, BATCH, RATE, DECAY, HOLDOUT = 32, 60, 64, 0.003, 1e-4, 0.2
SAMPLE_PARTS = 8
SLICE = 256
THRESHOLD = 0.3
RUNS = re.compile(r"(.)\1{2,}")
TABLE_WORDS = 200_000
STEP_CHARS = 1_000_000
# Places taken at a time, and most of them whose sums stay below half a lane: each adds at most 2 * 2 * WINDOW * NONZERO.
PLACES, MOST_PLACES, LANE = 1 << 17, 1 << 19, float(1 << 26)


class Kinds(dict):
    """Code point -> ``A``, ``a``, ``0`` or itself, found out once per code point."""

    def __missing__(self, point: int) -> str:
        c = chr(point)
        self[point] = kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        return kind


KINDS = Kinds()


def shape(word: str) -> str:
    """Letters as ``a`` or ``A``, digits as ``0``, other marks as they are, in runs of two at most.

    The whole word counts, however long it is.
    """
    return RUNS.sub(r"\1\1", word.translate(KINDS))


def binaries(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    """Stretches of ``data``, one after the other, as an Arrow array."""
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def split_words(texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of texts one after the other, and how many words each text has.

    White space is found among bytes: no byte of a longer character looks like it.
    """
    coded = [text.encode() for text in texts]
    data = np.frombuffer(b"\n".join([b"", *coded, b""]), np.uint8)
    inside = (data != 0x20) & (data - np.uint8(0x09) > 4)
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1  # where a word begins, where it has ended, in turn
    starts = edges[::2]
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(edges[1::2] - starts, out=offsets[1:])
    bounds = np.cumsum([1, *(len(c) + 1 for c in coded)])
    return binaries(offsets, data[inside]).dictionary_encode(), np.diff(np.searchsorted(starts, bounds))


class Terms:
    """Word and shape numbers of texts. Shapes come after the words.

    Each distinct word of some texts is looked at once: all of them together, as arrays of
    code points, of which only the distinct shapes become Python strings.
    """

    def __init__(self) -> None:
        # Shape in UTF-32 -> its number, its number after the same word; TABLE_WORDS, or what some texts hold.
        self.known: dict[bytes, tuple[int, int]] = {}
        self.kinds = np.zeros(sys.maxunicode + 1, np.uint32)  # one more than a code point's kind, 0 until found out

    def _kinds(self, points: np.ndarray) -> np.ndarray:
        found = self.kinds[points]
        if not found.all():
            for point in np.unique(points[found == 0]).tolist():
                self.kinds[point] = ord(KINDS[point]) + 1
            found = self.kinds[points]
        return found - np.uint32(1)

    def _numbers(self, shapes: list[bytes]) -> np.ndarray:
        new = set(shapes).difference(self.known)
        if new and len(self.known) + len(new) > TABLE_WORDS:
            self.known, new = {}, set(shapes)
        for coded in new:
            kind = coded.decode("utf-32-le")
            self.known[coded] = tuple(WORD_BUCKETS + zlib.crc32(k.encode()) % SHAPE_BUCKETS for k in (kind, kind + " again"))
        return np.array(list(map(self.known.__getitem__, shapes)), np.int64).reshape(-1, 2)

    def _shapes(self, words: pa.Array) -> np.ndarray:
        """Numbers of the shapes of distinct words, as such and after the same word; see ``shape``."""
        if not len(words):
            return np.zeros((0, 2), np.int64)
        offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
        data = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        kinds = self._kinds(np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32))
        # Where words begin in code points instead of bytes. No word is empty.
        lengths = np.add.reduceat((data & 0xC0) != 0x80, offsets[:-1] - offsets[0], dtype=np.int64)
        at = np.cumsum(lengths) - lengths
        # What equals both places before it goes, unless one of these belongs to another word.
        kept = np.ones(len(kinds), bool)
        kept[2:] = (kinds[2:] != kinds[1:-1]) | (kinds[2:] != kinds[:-2])
        kept[at] = True
        kept[np.minimum(at + 1, len(kinds) - 1)] = True
        bytes_kept = 4 * np.cumsum(np.add.reduceat(kept, at, dtype=np.int64))
        shapes = binaries(np.concatenate([[0], bytes_kept]), kinds[kept]).dictionary_encode()
        return self._numbers(shapes.dictionary.to_numpy(zero_copy_only=False).tolist())[shapes.indices.to_numpy()]

    def of_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word and shape numbers of texts one after the other, and how many words each has."""
        words, counts = split_words(texts)
        at, distinct = words.indices.to_numpy(), words.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers = np.fromiter(map(zlib.crc32, distinct), np.int64, len(distinct)) % WORD_BUCKETS
        same = np.concatenate([[False], at[1:] == at[:-1]])[: len(at)]
        first = (np.cumsum(counts) - counts)[counts > 0]
        same[first] = False
        return numbers[at], self._shapes(words.dictionary)[at, same.astype(np.int64)], counts

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        return self.of_all([text])[:2]


def steps(texts: Iterable[str]) -> Iterator[list[str]]:
    """Lists of texts of a bounded length together, or of one text."""
    some, chars = [], 0
    for text in texts:
        if some and chars + len(text) > STEP_CHARS:
            yield some
            some, chars = [], 0
        some.append(text)
        chars += len(text)
    if some:
        yield some


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of each term's index vector."""
    random = np.random.default_rng(7_919)
    size = (WORD_BUCKETS + SHAPE_BUCKETS, NONZERO)
    return random.integers(0, DIM, size), random.choice(np.array([-1, 1]), size)


def context_sums(texts: Iterable[str]) -> np.ndarray:
    """Sums of the index vectors around each term, over all ``texts``.

    A place's two terms see the same neighbours, so the vectors around it are added up once
    and the sum goes to both. Entries go two by two, the second ``LANE`` times as large as
    the first: a whole number that a float holds exactly for ``MOST_PLACES`` places.
    """
    terms, (places, signs) = Terms(), index_vectors()
    gap = len(places)  # a term without a vector
    index = np.zeros((DIM, gap + 1))
    np.add.at(index, (places, np.arange(gap)[:, None]), signs)
    lanes = index[::2] + LANE * index[1::2]
    total, sums, held = np.zeros((gap, DIM), np.int64), np.zeros(lanes.shape), 0

    def unpack() -> None:
        second = np.rint(sums[:, :gap] / LANE)
        total[:, ::2] += (sums[:, :gap] - LANE * second).T.astype(np.int64)
        total[:, 1::2] += second.T.astype(np.int64)
        sums[:] = 0

    for some in steps(texts):
        words, kinds, counts = terms.of_all(some)
        if not len(words):
            continue
        # Texts are set apart by gaps as wide as the window.
        at = np.arange(len(words)) + WINDOW * (1 + np.repeat(np.arange(len(counts)), counts))
        placed = np.full((2, at[-1] + 1 + WINDOW), gap)
        placed[:, at] = words, kinds
        for start in range(0, placed.shape[1] - 2 * WINDOW, PLACES):
            first, second = placed[:, start : start + PLACES + 2 * WINDOW]
            count = len(first) - 2 * WINDOW
            if held + count > MOST_PLACES:
                unpack()
                held = 0
            held += count
            for lane, own in zip(lanes, sums):
                both, near = lane[first] + lane[second], np.zeros(count)
                for step in range(1, WINDOW + 1):
                    near += both[WINDOW - step : WINDOW - step + count]
                    near += both[WINDOW + step : WINDOW + step + count]
                for of in (first, second):
                    own += np.bincount(of[WINDOW:-WINDOW], near, gap + 1)
    unpack()
    return total


def _task_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row (slice, data) for each stretch of ``SLICE`` terms, from all of a task's texts."""
    total = context_sums(text for batch in batches for text in batch["text"])
    parts = total.reshape(-1, SLICE * DIM)
    filled = np.flatnonzero(parts.any(1))
    yield pd.DataFrame({"slice": filled.astype(np.int32), "data": [zlib.compress(parts[k].tobytes(), 1) for k in filled]})


def _sum_slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The sums of the same slices."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, data in zip(batch["slice"], batch["data"]):
            part = np.frombuffer(zlib.decompress(data), np.int64)
            total[k] = total[k] + part if k in total else part
    yield pd.DataFrame({"slice": np.array(list(total), np.int32), "data": [zlib.compress(v.tobytes(), 1) for v in total.values()]})


def word_vectors(texts: DataFrame) -> np.ndarray:
    """Each term's vector, from the ``text`` of all rows."""
    schema = "slice int, data binary"
    sums = texts.select("text").mapInPandas(_task_sums, schema).repartition(SAMPLE_PARTS, "slice").mapInPandas(_sum_slices, schema)
    total = np.zeros(((WORD_BUCKETS + SHAPE_BUCKETS) // SLICE, SLICE * DIM), np.int64)
    for row in sums.collect():
        total[row.slice] = np.frombuffer(zlib.decompress(row.data), np.int64)
    return unit_rows(total.reshape(-1, DIM))


def unit_rows(sums: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(sums, axis=1, keepdims=True)
    return (sums / np.maximum(lengths, 1)).astype(np.float32)


def pooled(words: np.ndarray, kinds: np.ndarray, vectors: np.ndarray) -> np.ndarray | None:
    """Mean and spread of the vectors of a text's terms; None without words."""
    if not len(words):
        return None
    parts = []
    for numbers in (words, kinds):
        # Terms that repeat are looked up once and weighted.
        distinct, counts = np.unique(numbers, return_counts=True)
        own, weights = vectors[distinct], (counts / len(numbers)).astype(np.float32)
        mean = weights @ own
        parts += [mean, np.sqrt(np.maximum(weights @ (own * own) - mean * mean, 0))]
    return np.concatenate([*parts, [np.log1p(len(words)) / 10]]).astype(np.float32)


def all_pooled(texts: list[str], terms: Terms, vectors: np.ndarray) -> Iterator[np.ndarray | None]:
    for some in steps(texts):
        words, kinds, counts = terms.of_all(some)
        ends = np.cumsum(counts)[:-1]
        for own, shapes in zip(np.split(words, ends), np.split(kinds, ends)):
            yield pooled(own, shapes, vectors)


@dataclass
class Model:
    """``constant`` is set if the sample could not teach anything."""

    vectors: np.ndarray
    constant: float | None = None
    center: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: tuple[np.ndarray, ...] = ()
    temperature: float = 1.0

    def logits(self, features: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.tanh((features - self.center) / self.scale @ w1 + b1) @ w2 + b2

    def scores(self, texts: list[str], terms: Terms) -> np.ndarray:
        out = np.zeros(len(texts))
        found = list(all_pooled(texts, terms, self.vectors))
        filled = [i for i, f in enumerate(found) if f is not None]
        if filled and self.constant is not None:
            out[filled] = self.constant
        elif filled:
            logits = self.logits(np.stack([found[i] for i in filled])) / self.temperature
            out[filled] = 1 / (1 + np.exp(-np.clip(logits, -500, 500)))
        return out


def train(features: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> Model:
    """Adam on the log loss; the temperature is fitted on rows kept apart."""
    if not len(labels) or labels.min() == labels.max():
        return Model(vectors, constant=float(labels.mean()) if len(labels) else 0.5)
    random = np.random.default_rng(104_729)
    order = random.permutation(len(labels))
    apart = order[: int(len(order) * HOLDOUT)]
    used = order[len(apart) :]
    model = Model(vectors, None, features[used].mean(0), features[used].std(0) + 1e-3)
    width = features.shape[1]
    weights = [
        random.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN), random.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)
    ]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    x, y = (features[used] - model.center) / model.scale, labels[used]
    step = 0
    for _ in range(EPOCHS):
        shuffled = random.permutation(len(y))
        for at in range(0, len(y), BATCH):
            rows = shuffled[at : at + BATCH]
            hidden = np.tanh(x[rows] @ weights[0] + weights[1])
            slope = (1 / (1 + np.exp(-(hidden @ weights[2] + weights[3]))) - y[rows]) / len(rows)
            back = np.outer(slope, weights[2]) * (1 - hidden * hidden)
            gradients = [x[rows].T @ back, back.sum(0), hidden.T @ slope, slope.sum(keepdims=True)]
            step += 1
            for k, gradient in enumerate(gradients):
                gradient = gradient + DECAY * weights[k]
                first[k] = 0.9 * first[k] + 0.1 * gradient
                second[k] = 0.999 * second[k] + 0.001 * gradient**2
                weights[k] -= RATE * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    model.weights = tuple(weights)
    if len(apart):
        logits, truth = model.logits(features[apart]), labels[apart]
        losses = [(np.logaddexp(0, -(2 * truth - 1) * logits / t).mean(), t) for t in np.geomspace(0.25, 8, 61)]
        model.temperature = float(min(losses)[1])
    return model


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from the words of all ``docs`` and at most ``sample_rows`` of ``labels`` (id, label)."""
    spark = docs.sparkSession
    id_, label = (F.col(c) for c in labels.columns)
    sample = labels.select(id_.alias("id"), label.cast("int").alias("label")).where("id IS NOT NULL AND label IN (0, 1)")
    # Bounded, hence broadcast; the bound holds again for the rows it meets, of which the same are taken every time.
    chosen = sample.orderBy(F.xxhash64("id"), "label").limit(sample_rows)
    texts = docs.select(column(docs, id_col).alias("id"), F.coalesce(column(docs, text_col), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(chosen), "id").orderBy(F.xxhash64("id"), "label", F.xxhash64("text"))
    rows = rows.select("label", "text").limit(sample_rows)
    rows = stored(rows.repartition(SAMPLE_PARTS), "labelled-sample")

    vectors = word_vectors(texts)
    shared = spark.sparkContext.broadcast(vectors)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms = Terms()
        for batch in batches:
            pairs = zip(all_pooled(list(batch["text"]), terms, shared.value), batch["label"])
            yield pd.DataFrame([(f.tolist(), int(y)) for f, y in pairs if f is not None], columns=["features", "label"])

    table = rows.mapInPandas(features, "features array<float>, label int").toPandas()
    # The same rows in the same order, whatever task delivered them.
    table = table.iloc[sorted(range(len(table)), key=lambda i: (table["label"].iloc[i], tuple(table["features"].iloc[i])))]
    x = np.stack(table["features"].to_list()) if len(table) else np.zeros((0, 4 * DIM + 1))
    return train(np.asarray(x, np.float64), table["label"].to_numpy(np.float64), vectors)


def score(text: Column, model: Broadcast) -> Column:
    """The probability of label 1 for each text."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        terms = Terms()
        for batch in batches:
            yield pd.Series(model.value.scores(["" if t is None else t for t in batch], terms))

    return F.pandas_udf(run, "double").asNondeterministic()(text)
