"""Near duplicates against all pairs."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import near_dedup
from tidemark.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    words = WORD.findall((text or "").translate(FOLD))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if len(words) >= k else frozenset([tuple(words)] if words else [])


def brute(rows, k=2, percent=80):
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    least = {g: min((rows[i][0] for i in m if rows[i][0] is not None), default=None) for g, m in groups.items()}
    return [(rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows))]


def family(draw, size, length, edits):
    """Texts that differ from one of their elders in a few words."""
    texts = [[f"w{draw.randrange(5000)}" for _ in range(length)]]
    while len(texts) < size:
        words = list(draw.choice(texts))
        for _ in range(draw.randrange(1, edits)):
            words[draw.randrange(length)] = f"n{draw.randrange(10**6)}"
        texts.append(words)
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize("cell", [512, 8])
def test_against_all_pairs(spark, cell, monkeypatch):
    monkeypatch.setattr(near_dedup, "PIVOTS", 4)
    draw = random.Random(cell)
    texts = family(draw, 60, 60, 9) + family(draw, 25, 30, 4) + family(draw, 20, 12, 3) + [f"alone {i} with {i * 7} words" for i in range(20)]
    texts += ["A b", "a B", "a", "a", "b", "", None, " \n", "x y z", "x y z w", "x y z w v"]
    draw.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = {r.id: r for r in near_dedup.find(docs, words=2, cell=cell).collect()}
    assert [(i, out[i].n_shingles, out[i].component_id) for i, _ in rows] == brute(rows)
    assert all(r.kept == (r.id == r.component_id) for r in out.values())


def test_exact_boundary(spark):
    """Four of five shingles are linked, seven of nine are not."""
    rows = [(1, "a b c d e f"), (2, "a b c d e"), (11, "k l m n o p q r s t"), (12, "k l m n o p q r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.id: r.component_id for r in near_dedup.find(docs, words=2).collect()}
    assert out == {1: 1, 2: 1, 11: 11, 12: 12}


def test_drop_near_repeats_nulls_and_columns(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(5, text, 1, "a"), (5, text, 2, "b"), (7, text + " thirteen", 3, None), (None, text, 4, "d"), (None, "", 5, "e"), (8, None, 6, "f"), (8, None, 7, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int, node string")
    out = near_dedup.drop_near(docs)
    assert out.columns == docs.columns
    kept = out.collect()
    assert [r.doc_id for r in kept if r.text == text] == [5]
    assert all(r.text != text + " thirteen" for r in kept)
    assert near_dedup.drop_near(docs.limit(0)).count() == 0


def test_components(spark):
    draw = random.Random(1)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(160)] + [(k, k + 1) for k in range(1000, 1200)]
    edges += [(5000, 5001 + k) for k in range(300)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {x: find(x) for x in parent if find(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_min_max_values_estimate_similarity():
    draw = np.random.default_rng(2)
    base = draw.integers(0, 1 << 63, 3000).astype(np.uint64)
    one, two = np.unique(base[:2000]), np.unique(base[1000:])
    factors = near_dedup.multipliers(2000)
    pairs = [near_dedup.band_keys(s, factors, 2000) for s in (one, two)]
    # A band of one permutation agrees where both its least and its greatest value do.
    assert abs((pairs[0] == pairs[1]).mean() - (1 / 3) ** 2) < 0.03


def test_a_task_has_a_bounded_number_of_texts_as_strings():
    texts = [f"a b c d e f {i % 700}" if i % 5 else None for i in range(2 * near_dedup.PART_ROWS + 300)]
    batch = pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "text": texts})
    found = list(near_dedup._describe(5, 4, 2)(iter([batch])))
    assert max(map(len, found)) <= near_dedup.PART_ROWS
    rows = pa.Table.from_batches(found).to_pylist()
    assert [r["id"] for r in rows] == list(range(len(texts)))
    assert [r["n"] for r in rows] == [0 if t is None else 3 for t in texts]
    assert rows[1]["d1"] == rows[701]["d1"] and rows[1]["bands"] == rows[701]["bands"] and rows[1]["d1"] != rows[2]["d1"]
    nodes = pa.RecordBatch.from_pydict({"node": [i // 2 for i in range(len(texts))], "text": texts})
    sets = list(near_dedup._sets(5)(iter([nodes])))
    assert max(map(len, sets)) <= near_dedup.PART_ROWS
    assert [r["node"] for r in pa.Table.from_batches(sets).to_pylist()] == list(range(len(texts) // 2))
