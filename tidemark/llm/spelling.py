"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

An inserted or deleted letter changes one letter count by one, a replaced letter two counts,
so words one edit apart have count vectors at an L1 distance of at most two: one letter more,
one letter fewer, or both. Each word asks two trees: that of its own length (one more and one
fewer) and that of the next length (one more). The pairs of a length and the next are found
from the shorter word and hold for both.

1. ``grow`` cuts the words of each length by the upper levels of a k-d tree until a leaf
   holds a bounded number of words. Medians come from samples of the oversized leaves; sizes
   are counted over all words, and cutting goes on until none is oversized. A leaf whose
   sampled vectors are all equal (anagrams) cannot be cut and is dealt out to parts by hash.
2. Words are indexed in their leaf, and asked in every leaf whose box is near enough: about
   d * d / 4 of 2 ** d leaves, for d levels.
3. In a task, the words of a leaf are grouped by vector into a k-d tree of their own, and
   the askers stream past it. Boxes prune the search; vectors that are left are within reach,
   and the order of letters decides at the end.

The leaves are sent to all tasks: one for every 16,384 words of the vocabulary or so, some
600 bytes each. Letters are the code points of ``LETTERS``; lengths are bounded by memory
alone. Words must be distinct and not null; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Callable
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, stored

LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
DIMENSIONS = len(LETTERS)
PLACE = np.zeros(256, np.int64)
PLACE[np.frombuffer(LETTERS.encode("latin-1"), np.uint8)] = np.arange(DIMENSIONS)

LEAF_WORDS = 16_384
LEAST_SAMPLE, SAMPLE_CHARS = 512, 16_000_000
BUCKET = 16  # vectors in a leaf of the trees inside a task
SHORT = 64  # words up to this length are verified by look-ups, longer ones pair by pair
TALLY_WORDS = 500_000


def vectors(words: list[str], length: int) -> np.ndarray:
    """Letter counts of words of one length, one row each."""
    out = np.zeros((len(words), DIMENSIONS), np.int16 if length < 1 << 14 else np.int64)
    step = max(1, 4_000_000 // max(1, length))
    for at in range(0, len(words), step):
        part = words[at : at + step]
        codes = PLACE[np.frombuffer("".join(part).encode("latin-1"), np.uint8)]
        cells = np.repeat(np.arange(len(part)) * DIMENSIONS, length) + codes
        out[at : at + step] = np.bincount(cells, minlength=len(part) * DIMENSIONS).reshape(-1, DIMENSIONS)
    return out


def best_cut(points: np.ndarray) -> tuple[int, int] | None:
    """The dimension and the last value of the lower side that halve the points best."""
    half = len(points) // 2
    middle = np.partition(points, half, axis=0)[half]
    best, found = len(points) - half, None
    for bound in (middle, middle - 1):
        lower = (points <= bound).sum(0)
        off = np.where((lower == 0) | (lower == len(points)), len(points), np.abs(lower - half))
        at = int(off.argmin())
        if off[at] < best:
            best, found = off[at], (at, int(bound[at]))
    return found


class Tree:
    """A k-d tree: inner nodes cut one dimension, leaves have numbers, nodes have boxes."""

    def __init__(self) -> None:
        self.cut: list[tuple[int, int, int, int] | None] = []  # dimension, bound, lower node, upper node
        self.leaf: list[int] = []
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []

    def add(self, low: np.ndarray, high: np.ndarray, leaf: int) -> int:
        self.cut.append(None)
        self.leaf.append(leaf)
        self.low.append(low)
        self.high.append(high)
        return len(self.cut) - 1

    def places(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point."""
        out = np.zeros(len(points), np.int64)
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if self.cut[node] is None:
                out[rows] = self.leaf[node]
                continue
            dimension, bound, lower, upper = self.cut[node]
            below = points[rows, dimension] <= bound
            todo += [(lower, rows[below]), (upper, rows[~below])]
        return out

    def reached(self, points: np.ndarray, fewer: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves that may hold a point with one count more and ``fewer`` counts less, with the rows that ask."""
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            own = points[rows]
            lack = np.maximum(self.low[node] - own, 0).sum(1)
            excess = np.maximum(own - self.high[node], 0).sum(1)
            rows = rows[(lack <= 1) & (excess <= fewer)]
            if not len(rows):
                continue
            if self.cut[node] is None:
                yield self.leaf[node], rows
            else:
                todo += [(self.cut[node][2], rows), (self.cut[node][3], rows)]

    def split(self, node: int, points: np.ndarray, enough: Callable[[int], bool], tight: bool) -> list[tuple[int, np.ndarray]]:
        """Cut ``node`` until ``enough`` (a number of points) holds; new leaves with their rows.

        Boxes are those of the points if ``tight``, else what the cuts leave of the node's box.
        """
        ends, todo = [], [(node, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            own = points[rows]
            cut = None if enough(len(rows)) else best_cut(own)
            if cut is None:
                ends.append((node, rows))
                continue
            dimension, bound = cut
            below = own[:, dimension] <= bound
            sides = []
            for side, chosen in enumerate((below, ~below)):
                if tight:
                    low, high = own[chosen].min(0), own[chosen].max(0)
                else:
                    low, high = self.low[node].copy(), self.high[node].copy()
                    if side:
                        low[dimension] = bound + 1
                    else:
                        high[dimension] = bound
                sides.append(self.add(low, high, -1))
                todo.append((sides[-1], rows[chosen]))
            self.cut[node] = (dimension, bound, *sides)
        return ends


class Forest:
    """One tree per length; leaves are numbered over all of them, and large ones have parts."""

    def __init__(self, lengths: list[int]) -> None:
        self.trees: dict[int, Tree] = {}
        self.leaves: list[tuple[int, int]] = []  # length, node
        self.parts: dict[int, int] = {}
        for length in lengths:
            tree = self.trees[length] = Tree()
            self._leaf(length, tree.add(np.zeros(DIMENSIONS, np.int64), np.full(DIMENSIONS, length, np.int64), -1))

    def _leaf(self, length: int, node: int) -> None:
        self.trees[length].leaf[node] = len(self.leaves)
        self.leaves.append((length, node))

    def cut(self, leaf: int, sample: list[str], size: int) -> bool:
        """Cut an oversized leaf along its sample; whether that was possible."""
        length, node = self.leaves[leaf]
        share = size / len(sample)
        ends = self.trees[length].split(
            node, vectors(sample, length), lambda n: n * share <= 0.75 * LEAF_WORDS or n < 16, False
        )
        if len(ends) == 1:
            return False
        for end, _ in ends:
            self._leaf(length, end)
        return True


def by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, list[str]]]:
    """Length, positions and words for each length."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        yield length, rows, [words[i] for i in rows.tolist()]


def _leaves_of(forest) -> Callable:
    """Words with their leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = forest.value.trees
        for batch in batches:
            words = batch.column("word").to_pylist()
            leaf = np.zeros(len(words), np.int64)
            for length, rows, own in by_length(words):
                leaf[rows] = trees[length].places(vectors(own, length))
            yield pa.RecordBatch.from_arrays([pa.array(leaf), batch.column("word")], ["leaf", "word"])

    return run


def grow(words: DataFrame) -> Forest:
    """The upper levels of the trees, until no leaf that can be cut holds over ``LEAF_WORDS`` words."""
    spark = words.sparkSession
    lengths = words.groupBy(F.length("word").alias("length")).count().orderBy("length").collect()
    forest = Forest([r.length for r in lengths])
    sizes = {leaf: r["count"] for leaf, r in enumerate(lengths)}
    whole: set[int] = set()
    while True:
        large = {k: n for k, n in sizes.items() if n > LEAF_WORDS and k not in whole}
        if not large:
            break
        # So many words of each leaf that every leaf to come is met some 64 times.
        wanted = {k: max(LEAST_SAMPLE, 64 * n // LEAF_WORDS) for k, n in large.items()}
        chars = sum(n * forest.leaves[k][0] for k, n in wanted.items())
        shares = {k: min(1.0, n / large[k] * min(1.0, SAMPLE_CHARS / chars)) for k, n in wanted.items()}
        share = spark.createDataFrame(list(shares.items()), "leaf long, share double")
        shared = spark.sparkContext.broadcast(forest)
        placed = words.select("word").mapInArrow(_leaves_of(shared), "leaf long, word string")
        picked = F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < F.col("share") * (1 << 20)
        sample: dict[int, list[str]] = defaultdict(list)
        for leaf, word in placed.join(F.broadcast(share), "leaf").where(picked).select("leaf", "word").collect():
            sample[leaf].append(word)
        for leaf, size in large.items():
            if not sample[leaf] or not forest.cut(leaf, sorted(sample[leaf]), size):
                whole.add(leaf)
        shared = spark.sparkContext.broadcast(forest)
        counted = words.select("word").mapInArrow(_leaves_of(shared), "leaf long, word string").groupBy("leaf").count()
        sizes = {r.leaf: r["count"] for r in counted.collect()}
    forest.parts = {k: math.ceil(sizes[k] / LEAF_WORDS) for k in whole}
    return forest


def _part(word: str, parts: int) -> int:
    return zlib.crc32(word.encode()) % parts


def _deal(forest) -> Callable:
    """Words once as indexed (kind 0) and once per leaf they ask (kind 1: own length, 2: the next)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, parts = forest.value.trees, forest.value.parts
        for batch in batches:
            words = batch.column("word").to_pylist()
            out: list[tuple[int, int, int, np.ndarray]] = []  # kind, leaf, part, rows
            for length, rows, own in by_length(words):
                points = vectors(own, length)
                leaf = trees[length].places(points)
                order = np.argsort(leaf, kind="stable")
                for group in np.split(order, np.flatnonzero(np.diff(leaf[order])) + 1):
                    here = int(leaf[group[0]])
                    if here in parts:
                        out += [(0, here, _part(own[i], parts[here]), rows[i : i + 1]) for i in group.tolist()]
                    else:
                        out.append((0, here, 0, rows[group]))
                for kind, more in ((1, 0), (2, 1)):
                    if length + more in trees:
                        for there, asking in trees[length + more].reached(points, 1 - more):
                            out += [(kind, there, part, rows[asking]) for part in range(parts.get(there, 1))]
            sizes = np.array([len(rows) for *_, rows in out], np.int64)
            taken = pa.array(np.concatenate([rows for *_, rows in out]) if out else np.zeros(0, np.int64))
            columns = [pa.array(np.repeat(np.array([o[i] for o in out], np.int64), sizes)) for i in (1, 2, 0)]
            columns += [batch.column("word").take(taken), batch.column("n").take(taken)]
            yield pa.RecordBatch.from_arrays(columns, ["leaf", "part", "kind", "word", "n"])

    return run


def one_edit(a: str, b: str) -> bool:
    """Whether the words differ by exactly one inserted, deleted or replaced letter."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    x, y = (np.frombuffer(w.encode("utf-32-le"), np.uint32) for w in (a, b))
    if len(a) == len(b):
        return int((x != y).sum()) == 1
    differ = np.flatnonzero(x != y[:-1])
    first = int(differ[0]) if len(differ) else len(a)
    return bool((x[first:] == y[first + 1 :]).all())


class Leaf:
    """The indexed words of a leaf, grouped by vector in a k-d tree."""

    def __init__(self, words: list[str], counts: list[int]) -> None:
        self.length = len(words[0])
        self.count = dict(zip(words, counts))
        points = vectors(words, self.length)
        self.points, group = distinct(points)
        self.words: list[list[str]] = [[] for _ in self.points]
        for word, at in zip(words, group.tolist()):
            self.words[at].append(word)
        self.tree = Tree()
        self.tree.add(self.points.min(0), self.points.max(0), -1)
        self.members = []
        for node, rows in self.tree.split(0, self.points, lambda n: n <= BUCKET, True):
            self.tree.leaf[node] = len(self.members)
            self.members.append(rows)

    def near(self, words: list[str], kind: int) -> Iterator[tuple[str, str]]:
        """Pairs of an asking and an indexed word that are one edit apart."""
        points, group = distinct(vectors(words, len(words[0])))
        asking: list[list[str]] = [[] for _ in points]
        for word, at in zip(words, group.tolist()):
            asking[at].append(word)
        for leaf, rows in self.tree.reached(points, 2 - kind):
            members = self.members[leaf]
            for at in range(0, len(rows), 4096):
                some = rows[at : at + 4096]
                change = self.points[members][None] - points[some][:, None]
                more, fewer = np.maximum(change, 0).sum(2), np.maximum(-change, 0).sum(2)
                for i, j in np.argwhere((more == 1) & (fewer == 2 - kind)).tolist():
                    gained = LETTERS[int(change[i, j].argmax())]
                    lost = LETTERS[int(change[i, j].argmin())] if kind == 1 else ""
                    yield from self._verified(asking[some[i]], int(members[j]), gained, lost)

    def _verified(self, asking: list[str], group: int, gained: str, lost: str) -> Iterator[tuple[str, str]]:
        if self.length > SHORT:
            for word in asking:
                yield from ((word, other) for other in self.words[group] if one_edit(word, other))
        elif lost:
            for word in asking:
                at = word.find(lost)
                while at >= 0:
                    other = word[:at] + gained + word[at + 1 :]
                    if other in self.count:
                        yield word, other
                    at = word.find(lost, at + 1)
        else:
            known = set(asking)
            for other in self.words[group]:
                at, found = other.find(gained), set()
                while at >= 0:
                    found.add(other[:at] + other[at + 1 :])
                    at = other.find(gained, at + 1)
                for word in found & known:
                    yield word, other


def distinct(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows, and the number of each row's distinct one."""
    whole = np.ascontiguousarray(points).view(np.dtype((np.void, points.dtype.itemsize * points.shape[1]))).reshape(-1)
    _, first, group = np.unique(whole, return_index=True, return_inverse=True)
    return points[first], group.reshape(-1)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of leaves: indexed words first, then those that ask."""
    current, words, counts, leaf = None, [], [], None
    for batch in batches:
        rows = [batch.column(c).to_pylist() for c in ("leaf", "part", "kind", "word", "n")]
        keys = list(zip(*rows[:3]))
        out: tuple[list[str], list[str], list[int]] = ([], [], [])
        start = 0
        while start < len(keys):
            end = start
            while end < len(keys) and keys[end] == keys[start]:
                end += 1
            place, kind = keys[start][:2], keys[start][2]
            if place != current:
                current, words, counts, leaf = place, [], [], None
            if kind == 0:
                words += rows[3][start:end]
                counts += rows[4][start:end]
            elif words:
                leaf = leaf or Leaf(words, counts)
                own = dict(zip(rows[3][start:end], rows[4][start:end]))
                for word, other in leaf.near(list(own), kind):
                    out[0].append(word), out[1].append(other), out[2].append(leaf.count[other])
                    if kind == 2:
                        out[0].append(other), out[1].append(word), out[2].append(own[word])
            start = end
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())],
            ["word", "near", "near_n"],
        )


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): all pairs of ``words`` (word, n) one edit apart, in both directions.

    ``words`` is read several times, so store it first.
    """
    forest = words.sparkSession.sparkContext.broadcast(grow(words))
    dealt = words.select("word", F.col("n").cast("long").alias("n")).mapInArrow(
        _deal(forest), "leaf long, part long, kind long, word string, n long"
    )
    return (
        dealt.repartition("leaf", "part").sortWithinPartitions("leaf", "part", "kind")
        .mapInArrow(_search, "word string, near string, near_n long")
    )


def variants(words: DataFrame, times: int = 5) -> DataFrame:
    """``words`` (word, n; distinct words, stored) with form, root, n_near and form_n.

    ``form`` is the commonest near word (of equally common ones the smallest in code-point
    order) if it is at least ``times`` times as common as the word, ``root`` what following
    forms leads to. Forms are ever more common, so they end; each round doubles the number of
    steps that are followed.
    """
    best = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    found = words.join(best, "word", "left")
    common = -F.col("best.less") >= times * F.col("n")
    found = found.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(common, F.col("best.near")).alias("form"), F.when(common, -F.col("best.less")).alias("form_n"),
    )
    found = stored(found, "spelling-forms")
    step = stored(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = stored(step.join(further, "root", "left"), "spelling-roots")
        step = joined.select("word", F.coalesce("next", "root").alias("root"))
        if joined.where("next IS NOT NULL").isEmpty():
            break
    return found.join(step, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _tally(least: int, change: Callable[[str, int], str] | None, every: int) -> Callable:
    """Words and their counts, combined over a task's texts as long as they are few."""
    runs = re.compile(f"[{re.escape(LETTERS[:26])}À-ÿ]{{{least},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def flushed() -> pa.RecordBatch:
            found = pa.RecordBatch.from_arrays(
                [pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"]
            )
            total.clear()
            return found

        for batch in batches:
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                # Only A-Z differ in lower case where bytes are lowered.
                own = runs.findall((text or "").encode().lower().decode())
                total.update(own)
                if change is not None and own:
                    start = zlib.crc32(f"{'' if key is None else key}:".encode())
                    hashes = [(zlib.crc32(w.encode(), start), w) for w in set(own)]
                    hit = {w: h for h, w in hashes if not h % every}
                    if hit:
                        for word, n in Counter(filter(hit.__contains__, own)).items():
                            total[word] -= n
                            total[change(word, hit[word])] += n
                if len(total) > TALLY_WORDS:
                    yield flushed()
        yield flushed()

    return run


def delete_one(word: str, number: int) -> str:
    """``word`` without the letter at ``number`` modulo its length."""
    at = number % len(word)
    return word[:at] + word[at + 1 :]


def count_words(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, least_count: int = 5,
    change: Callable[[str, int], str] | None = None, every: int = 199,
) -> DataFrame:
    """(word, n): maximal runs of letters in whole texts, A-Z in lower case, stored.

    Words have at least ``least_length`` letters and occur ``least_count`` times. ``change``
    misspells: it gets those words of a text, and their hash, whose crc32 of ``id:word`` is
    divisible by ``every``. Null and empty texts have no words, a null id counts as an empty
    one, repeated rows count each time, other columns play no part.
    """
    texts = docs.select(column(docs, id_col).alias("id"), column(docs, text_col).alias("text"))
    counted = texts.mapInArrow(_tally(least_length, change, every), "word string, n long")
    words = counted.groupBy("word").agg(F.sum("n").alias("n"))
    return stored(words.where((F.col("n") >= least_count) & (F.length("word") >= least_length)), "spelling-words")
