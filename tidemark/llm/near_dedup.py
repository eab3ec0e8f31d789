"""Near duplicates by min-max hashing, confirmed on full shingle sets.

A document's set holds its distinct shingles of ``words`` words. Documents are linked when
the Jaccard similarity of their sets reaches the threshold; a component is what links reach.

1. One pass makes, per document, a digest of its set and the band keys of its signature.
   Under each permutation both the least and the greatest value are kept, so one evaluation
   gives two values whose mean estimates the similarity without bias. A band is the hash of
   four permutations' pairs. With 80 bands a pair at similarity 0.8 shares none with a
   probability below one in a million.
2. Equal sets form a class, and one row stands for it from here on.
3. Classes that share a band key hang on the smallest of them; the components of these
   candidate links are clusters. A link that the bands see never leaves its cluster.
4. Clusters are cut into cells of a bounded size. Each cell has its members' full sets and
   finds all links among them with an inverted index; a cluster of one cell is then done.
   The cells of a larger cluster also share a fixed number of pivots, which ties them together.
5. In clusters of several cells, all that is not in the cluster's largest component is then
   compared, block by block, with every cell. So each pair of different components is
   compared on full sets, however large the cluster, and no pair of rows is ever emitted.

Band keys, clusters and digests meet in group-bys that combine first, and in joins that
Spark can split, so a group that holds a third of all rows is spread out.

Texts without words, and null texts, have an empty set and are linked with nothing. With
fewer words than a shingle needs, the whole sequence is one shingle. Rows may repeat: rows
with equal sets are in one component, and exactly one row of a component is kept, one with
the smallest id (null ids come last). Other columns are carried by ``drop_near`` whatever
their names are.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, column, lower_ascii, stored
from tidemark.llm.components import components

WORDS, PERCENT = 5, 80
BANDS, PER_BAND = 80, 4
CELL, PIVOTS = 512, 64
SEEN_NODES = 1_000_000
PART_ROWS = 1_000  # texts that a task has as strings at once
SMALLEST = -(1 << 63)
STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str | None, words: int, known: dict[str, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles. ``known`` remembers hashes of words."""
    found = WORD.findall(lower_ascii(text or ""))
    if not found:
        return np.zeros(0, np.uint64)
    if len(known) > 250_000:
        known.clear()
    for word in set(found).difference(known):
        known[word] = xxhash.xxh3_64_intdigest(word)
    one = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    span = min(words, len(found))
    with np.errstate(over="ignore"):
        out = one[: len(one) - span + 1].copy()
        for shift in range(1, span):
            out = (out ^ (out >> np.uint64(29))) * STEP + one[shift : len(one) - span + 1 + shift]
        out = (out ^ (out >> np.uint64(32))) * STEP + np.uint64(span)
    return np.unique(out)


def multipliers(count: int) -> np.ndarray:
    """Odd 32-bit factors; the products of one factor are a permutation."""
    return (np.random.default_rng(20_011).integers(0, 1 << 32, count, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)


def band_keys(shingles: np.ndarray, factors: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band from the least and greatest values under each permutation."""
    with np.errstate(over="ignore"):
        x = ((shingles ^ (shingles >> np.uint64(31))) * STEP >> np.uint64(32)).astype(np.uint32)
        low = np.full(len(factors), 0xFFFFFFFF, np.uint32)
        high = np.zeros(len(factors), np.uint32)
        for at in range(0, len(x), 512):
            values = x[at : at + 512, None] * factors
            np.minimum(low, values.min(0), out=low)
            np.maximum(high, values.max(0), out=high)
        parts = np.concatenate([low.reshape(bands, -1), high.reshape(bands, -1)], axis=1).astype(np.uint64)
        key = np.arange(1, bands + 1, dtype=np.uint64) * STEP
        for value in parts.T:
            key = (key ^ (key >> np.uint64(29)) ^ value) * STEP
    return (key ^ (key >> np.uint64(32))).view(np.int64)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), PART_ROWS):
            yield batch.slice(at, PART_ROWS)


def _describe(words: int, bands: int, per_band: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, known = multipliers(bands * per_band), {}
        for batch in _parts(batches):
            sizes, digests, keys = [], [], []
            for text in batch.column("text").to_pylist():
                own = shingle_set(text, words, known)
                sizes.append(len(own))
                digests.append(xxhash.xxh3_128_digest(own.tobytes()))
                keys.append(band_keys(own, factors, bands) if len(own) else np.zeros(0, np.int64))
            halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            columns = {c: batch.column(c) for c in batch.schema.names if c != "text"}
            ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            columns |= {
                "n": pa.array(sizes, pa.int64()), "d1": pa.array(halves[:, 0].copy()), "d2": pa.array(halves[:, 1].copy()),
                "bands": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _sets(words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        seen: set[int] = set()  # repeated rows stand for the same class, and may come twice
        for batch in _parts(batches):
            rows = []
            if len(seen) > SEEN_NODES:
                seen.clear()
            for node, text in zip(batch.column("node").to_pylist(), batch.column("text").to_pylist()):
                if node not in seen:
                    seen.add(node)
                    rows.append((node, shingle_set(text, words, known).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["node", "shingles"]
            )

    return run


def linked(index: list[np.ndarray], asked: list[np.ndarray], percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each set of ``asked`` the positions in ``index`` of the sets it is linked with."""
    sizes = np.array([len(s) for s in index], np.int64)
    values, numbers = np.unique(np.concatenate(index), return_inverse=True)
    owners = np.repeat(np.arange(len(index)), sizes)[np.argsort(numbers, kind="stable")]
    counts = np.bincount(numbers, minlength=len(values))
    starts = np.cumsum(counts) - counts
    for k, own in enumerate(asked):
        at = np.searchsorted(values, own)
        at[at == len(values)] = 0
        at = at[values[at] == own]
        many = counts[at]
        before = np.cumsum(many) - many
        hits = owners[np.repeat(starts[at] - before, many) + np.arange(int(many.sum()))]
        common = np.bincount(hits, minlength=len(index))
        yield k, np.flatnonzero(100 * common >= percent * (sizes + len(own) - common))


def _roots(size: int) -> tuple[Callable[[int], int], Callable[[int, int], None]]:
    parent = list(range(size))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(x: int, y: int) -> None:
        x, y = find(x), find(y)
        parent[max(x, y)] = min(x, y)

    return find, join


def _cell(percent: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Rows (node, shingles, asks): links of those that ask with all; (node, root) per node."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["node", "asks"], ascending=[True, False]).drop_duplicates("node")
        sets = [np.frombuffer(s, np.uint64) for s in rows["shingles"]]
        asking = np.flatnonzero(rows["asks"].to_numpy())
        find, join = _roots(len(sets))
        for k, partners in linked(sets, [sets[i] for i in asking], percent):
            for partner in partners.tolist():
                join(int(asking[k]), partner)
        nodes = rows["node"].to_numpy()
        return pd.DataFrame({"node": nodes, "root": nodes[[find(i) for i in range(len(nodes))]]})

    return run


def _candidate_links(described: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, leader) for classes that share a band key."""
    keys = described.join(classes.select(F.col("node").alias("uid")), "uid", "left_semi").select(
        F.col("uid").alias("node"), F.explode("bands").alias("key")
    )
    leaders = keys.groupBy("key").agg(
        F.min("node").alias("leader"), F.count(F.lit(1)).alias("many"), F.min("key").alias("again")
    ).where("many > 1").select(F.col("key").alias("of"), "leader", "again")
    found = keys.join(leaders, (F.col("key") == F.col("of")) & (F.col("key") == F.col("again")))
    return found.where("node <> leader").select("node", "leader").distinct()


def _compared(units: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``units`` (unit columns, node, asks) with their sets; (node, root) within each unit."""
    keys = [c for c in units.columns if c not in ("node", "asks")]
    rows = units.join(sets, "node")
    return rows.groupBy(*keys).applyInPandas(_cell(percent), "node long, root long").where("node <> root")


def _links(members: DataFrame, sets: DataFrame, percent: int, cell: int) -> DataFrame:
    """Links (node, root) that connect what is linked in each cluster.

    ``members`` has node, cluster and the cluster's size.
    """
    cells = F.ceil(F.col("size") / cell)
    members = members.withColumn("cells", cells).withColumn("cell", F.pmod(F.xxhash64("node"), cells))
    large = members.where("cells > 1")
    pivots = (
        large.groupBy("cluster", F.pmod(F.xxhash64("node", F.lit(1)), F.lit(PIVOTS)).alias("pick"))
        .agg(F.min("node").alias("node"), F.max("cells").alias("cells"))
        .select("cluster", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1)).alias("cell"), "node")
    )
    units = members.select("cluster", "cell", "node").unionByName(pivots).withColumn("asks", F.lit(True))
    first = stored(_compared(units, sets, percent), "links-in-cells")
    large = stored(large.select("node", "cluster", "cells", "cell"), "large-clusters")
    if large.isEmpty():
        return first
    inside = first.join(large.select("node"), "node", "left_semi")
    labelled = large.join(components(inside), "node", "left").withColumn("label", F.coalesce("root", "node"))
    labelled = stored(labelled.drop("root"), "labels")
    counts = labelled.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("many"))
    main = counts.groupBy("cluster").agg(
        F.max_by("label", "many").alias("main"), F.count(F.lit(1)).alias("labels"), F.min("cluster").alias("again")
    ).where("labels > 1").withColumnRenamed("cluster", "of")
    mixed = stored(labelled.join(main, (F.col("cluster") == F.col("of")) & (F.col("cluster") == F.col("again"))), "mixed-clusters")
    outside = mixed.where("label <> main")
    blocks = outside.groupBy("cluster").agg(
        F.ceil(F.count(F.lit(1)) / cell).alias("blocks"), F.min("cluster").alias("again")
    ).withColumnRenamed("cluster", "of")
    same = (F.col("cluster") == F.col("of")) & (F.col("cluster") == F.col("again"))
    sized = mixed.drop("of", "again").join(blocks, same).drop("of", "again")
    upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    held = sized.select("cluster", "cell", upto("blocks").alias("block"), "node", F.lit(False).alias("asks"))
    asking = sized.where("label <> main").withColumn("block", F.pmod(F.xxhash64("node", F.lit(2)), F.col("blocks"))).select(
        "cluster", upto("cells").alias("cell"), "block", "node", F.lit(True).alias("asks")
    )
    second = _compared(held.unionByName(asking), sets, percent)
    return first.unionByName(stored(second, "links-across-cells"))


def find(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT,
    bands: int = BANDS, per_band: int = PER_BAND, cell: int = CELL,
) -> DataFrame:
    """One row per document: uid, id, th, size, n_shingles, component_id, kept.

    Ids are whole numbers; ``th`` and ``size`` are a hash and the length of the text.
    """
    id_, text = column(docs, id_col).cast("long"), F.coalesce(column(docs, text_col), F.lit(""))
    identity = {"id": id_, "th": F.xxhash64(text), "size": F.length(text)}
    source = docs.select(*[c.alias(n) for n, c in identity.items()], text.alias("text"))
    schema = "id long, th long, size int, n long, d1 long, d2 long, bands array<long>"
    described = source.mapInArrow(_describe(words, bands, per_band), schema)
    described = stored(described.withColumn("uid", F.monotonically_increasing_id()), "described")

    filled = described.where("n > 0")
    classes = filled.groupBy("d1", "d2").agg(
        F.min("uid").alias("node"), F.min("id").alias("first_id"), F.min_by("uid", "id").alias("first_uid"), F.min("n").alias("n")
    )
    classes = stored(classes, "classes")
    clusters = components(_candidate_links(filled.select("uid", "bands"), classes))
    clusters = stored(clusters.unionByName(clusters.select(F.col("root").alias("node"), "root").distinct()), "clusters")
    sizes = clusters.groupBy("root").agg(F.count(F.lit(1)).alias("size"), F.min("root").alias("again")).withColumnRenamed("root", "of")
    members = clusters.join(sizes, (F.col("root") == F.col("of")) & (F.col("root") == F.col("again"))).select(
        "node", F.col("root").alias("cluster"), "size"
    )
    members = stored(members, "members")

    wanted = described.join(members.select(F.col("node").alias("uid")), "uid", "left_semi").select(
        F.coalesce("id", F.lit(SMALLEST)).alias("id"), "th", "size", F.col("uid").alias("node")
    )
    texts = source.withColumn("id", F.coalesce("id", F.lit(SMALLEST))).join(wanted, ["id", "th", "size"]).select("node", "text")
    sets = stored(texts.mapInArrow(_sets(words), "node long, shingles binary"), "shingle-sets")
    roots = components(_links(members, sets, percent, cell))

    grouped = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    best = grouped.groupBy("root").agg(
        F.min("first_id").alias("component_id"), F.coalesce(F.min_by("first_uid", "first_id"), F.min("node")).alias("keep_uid"),
        F.min("root").alias("again"),
    ).withColumnRenamed("root", "of")
    named = grouped.join(best, (F.col("root") == F.col("of")) & (F.col("root") == F.col("again")))
    named = named.select("d1", "d2", "n", "component_id", "keep_uid")
    result = described.drop("bands").join(named, ["d1", "d2", "n"], "left").select(
        "uid", "id", "th", "size", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        ((F.col("n") == 0) | (F.col("uid") == F.col("keep_uid"))).alias("kept"),
    )
    return result


def drop_near(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, **more: int
) -> DataFrame:
    """``docs`` with one row of each component."""
    found = find(docs, id_col, text_col, words, percent, **more)
    keys = found.groupBy(F.coalesce("id", F.lit(SMALLEST)).alias("id"), "th").agg(
        F.min("size").alias("size"), F.max("kept").alias("kept"), F.count(F.lit(1)).alias("copies")
    ).where("kept")
    keys = stored(keys, "kept")
    text = F.coalesce(column(docs, text_col), F.lit(""))
    rows = docs.select(
        F.struct(*[column(docs, c) for c in docs.columns]).alias("row"),
        F.coalesce(column(docs, id_col).cast("long"), F.lit(SMALLEST)).alias("id"), F.xxhash64(text).alias("th"),
        F.length(text).alias("size"),
    )
    on = ["id", "th", "size"]
    once = rows.join(keys.where("copies = 1"), on)
    # Rows that repeat both id and text: rare, and any of them will do.
    again = rows.join(keys.where("copies > 1"), on).dropDuplicates(on)
    return once.select("row.*").unionByName(again.select("row.*"))
