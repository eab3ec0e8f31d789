"""Ranked search against scoring every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return [t.translate({c: c + 32 for c in range(65, 91)}) for t in TERM.findall(text or "")]


def plain_search(docs, items, k):
    bags = [(key, plain_terms(text)) for key, text in docs]
    bags = [(key, terms) for key, terms in bags if terms]
    n, length = len(bags), sum(len(t) for _, t in bags)
    df = Counter(t for _, terms in bags for t in set(terms))
    out = []
    for item, text in items:
        scored = []
        for key, terms in bags:
            tf, m = Counter(terms), 25 + 75 * len(terms) * n // length
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m))
                for t in plain_terms(text) if t in tf
            )
            if score > 0:
                scored.append((-score, key is None, key or 0))
        out += [(item, rank + 1, None if none else key, -score) for rank, (score, none, key) in enumerate(sorted(scored)[:k])]
    return out


ODD = [
    (100, None), (101, ""), (102, " \t.,;"), (103, "Ünïcode 中文 中文 w1 W1 w1_w2"), (104, "w3 " * 3000), (None, "w1 w2 zz"), (105, "é\x85é x\xa0y"),
]


@pytest.mark.parametrize("block,cells,part", [(4_000_000, 4_000_000, 4_000_000), (60, 30, 200)])
def test_same_as_scoring_everything(spark, monkeypatch, block, cells, part):
    """Whole, and in small blocks of items, classes and terms; many documents repeat, some with their ids."""
    for name, value in (("BLOCK_CHARS", block), ("SCORED_CELLS", cells), ("PART_BYTES", part)):
        monkeypatch.setattr(lexical_search, name, value)
    draw = random.Random(4)
    texts = [" ".join(f"w{min(int(draw.expovariate(0.2)), 40)}" for _ in range(draw.randint(1, 30))) for _ in range(60)]
    rows = [(i, draw.choice(texts)) for i in range(300)] + ODD + [(7, texts[0]), (7, texts[0])]
    items = [(i, " ".join(f"w{draw.randint(0, 45)}" for _ in range(draw.randint(1, 12)))) for i in range(15)]
    items += [(50, "中文 W1 W1 w1 nothing"), (51, ""), (52, None), (53, "nowhere"), (None, "w2 zz")]
    docs = spark.createDataFrame([(*r, 1, "t") for r in rows], "doc_id long, text string, score int, bag string").repartition(7)
    asked = spark.createDataFrame(items, "item_id long, text string")
    found = [tuple(r) for r in lexical_search.search(docs, asked, k=10).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(found, key=key) == sorted(plain_search(rows, items, 10), key=key)


def test_members_of_a_hot_class(spark):
    """Half of all documents are equal: the smallest ids of the class are ranked, nulls last."""
    rows = [(i, "a b") for i in range(500, 0, -1)] + [(None, "a b")] * 3 + [(1000 + i, f"a c{i} d") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    items = spark.createDataFrame([(1, "b"), (2, "c7 b")], "item_id int, text string")
    found = lexical_search.search(docs, items, k=4).orderBy("item_id", "rank").collect()
    assert [r.doc_id for r in found] == [1, 2, 3, 4, 1007, 1, 2, 3]
    few = lexical_search.search(spark.createDataFrame([(2, "b"), (None, "b"), (1, "b")], "doc_id long, text string"), items)
    assert [(r.rank, r.doc_id) for r in few.where("item_id = 1").orderBy("rank").collect()] == [(1, 1), (2, 2), (3, None)]


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a")], "doc_id long, text string"), spark.createDataFrame([("x", "a")], "item_id string, text string")
    names = ["item_id", "rank", "doc_id", "score"]
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.limit(0), items.limit(0))):
        found = lexical_search.search(d, i)
        assert found.columns == names and found.count() == 0
    assert lexical_search.search(docs, items).count() == 1


def test_sums_stay_exact():
    cells, values = np.array([0, 1, 0, 1]), np.array([2**52 + 1, 2**54 + 3, 2**52, 1], np.int64)
    assert lexical_search.summed(cells, values, 2, 2.0**60).tolist() == [2**53 + 1, 2**54 + 4]
    assert lexical_search.summed(cells[:1], values[:1], 2, 2.0**52).tolist() == [2**52 + 1, 0]
