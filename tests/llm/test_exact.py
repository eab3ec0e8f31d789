"""Exact duplicates against a dictionary of normalised texts."""

import hashlib
import random
import re
from collections import Counter

from tidemark.llm import exact_dedup


def expected(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    size = Counter(norm)
    first = {}
    for (i, _), t in zip(rows, norm):
        first[t] = min([x for x in (first.get(t), i) if x is not None], default=None)
    return sorted(((i, first[t], size[t], hashlib.sha256(t.encode()).hexdigest()) for (i, _), t in zip(rows, norm)), key=repr)


def check(spark, rows):
    out = exact_dedup.mark(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.id, r.keep_id, r.group_size, r.sha) for r in out), key=repr) == expected(rows)
    kept = Counter(r.sha for r in out if r.kept)
    assert all(n == 1 for n in kept.values()) and len(kept) == len({r.sha for r in out})
    assert all(r.id == r.keep_id for r in out if r.kept)


def test_rounds(spark):
    draw = random.Random(3)
    long = "".join(draw.choice("abcdé \n") for _ in range(9000))
    texts = [None, "", " ", "a", "a\t\nb", "a b", "a  b", long, long, long[:-1] + "z", long[:70] + "é" + long[71:], long[:64], long[:64]]
    # Differences in each block of bytes, and beyond the last one.
    texts += [long[:at] + "#" + long[at + 1 :] for at in (3, 63, 64, 65, 4159, 4160, 5000)] * 2
    check(spark, [(i, t) for i, t in enumerate(texts)])


def test_ties_nulls_and_copies(spark):
    check(spark, [(5, "x"), (5, "x"), (5, "x"), (None, "x"), (None, "y"), (None, "y"), (2, "z"), (3, "z")] + [(9, "same " * 40)] * 50)


def test_empty_and_other_columns(spark):
    assert exact_dedup.mark(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    docs = spark.createDataFrame(
        [(1, "a", "u", None), (2, "a ", "v", 1.0), (3, "a", "w", None)], "doc_id long, text string, uid string, n double"
    )
    out = exact_dedup.drop_copies(docs)
    assert out.columns == docs.columns
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", "u", None), (2, "a ", "v", 1.0)]
