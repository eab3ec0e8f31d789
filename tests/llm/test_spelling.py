"""Spelling variants against all pairs, and the trees against plain distances."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import spelling


def some_words(count, seed, letters="abcdeé×"):
    draw = random.Random(seed)
    return sorted({"".join(draw.choice(letters) for _ in range(draw.randint(1, 7))) for _ in range(count)})


def plain_near(words):
    return {(a, b) for a in words for b in words if a != b and spelling.one_edit(a, b)}


def test_one_edit():
    for a, b in (("ab", "abc"), ("abc", "ac"), ("abc", "abd"), ("", "a"), ("aab", "ab")):
        assert spelling.one_edit(a, b) and spelling.one_edit(b, a)
    for a, b in (("ab", "ab"), ("ab", "ba"), ("a", "abc"), ("abc", "bcd"), ("ab", "cab" + "c")):
        assert not spelling.one_edit(a, b)


@pytest.mark.parametrize("leaf,short", [(16_384, 64), (20, 64), (20, 0)])
def test_all_pairs(spark, monkeypatch, leaf, short):
    """One leaf per length, many small ones, and pairs verified letter by letter."""
    for name, value in (("LEAF_WORDS", leaf), ("SHORT", short), ("LEAST_SAMPLE", 40), ("BUCKET", 4)):
        monkeypatch.setattr(spelling, name, value)
    words = some_words(900, 5)
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n int").repartition(5)
    assert len(spelling.grow(df).leaves) >= (30 if leaf == 20 else 7)
    found = [(r.word, r.near, r.near_n) for r in spelling.near_words(df).collect()]
    assert len(found) == len(set(found))
    assert {(a, b) for a, b, _ in found} == plain_near(words)
    assert all(words[n] == b for _, b, n in found)


def test_anagrams_are_dealt_to_parts(spark, monkeypatch):
    """720 words with one vector cannot be cut; each finds its neighbours in all parts."""
    monkeypatch.setattr(spelling, "LEAF_WORDS", 100)
    from itertools import permutations

    words = ["".join(p) for p in permutations("abcdef")] + ["abcdeg", "abcdefg", "bcdef"]
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n int")
    assert max(spelling.grow(df).parts.values()) == 8
    assert {(r.word, r.near) for r in spelling.near_words(df).collect()} == plain_near(words)


def test_trees_reach_all_that_is_near():
    draw = np.random.default_rng(2)
    points = draw.integers(0, 4, (400, spelling.DIMENSIONS)).astype(np.int16)
    points[:, 5:] = 0
    tree = spelling.Tree()
    tree.add(points.min(0), points.max(0), 0)
    ends = tree.split(0, points, lambda n: n <= 8, True)
    for leaf, (node, _) in enumerate(ends):
        tree.leaf[node] = leaf
    place = tree.places(points)
    for fewer in (0, 1):
        reached = {(i, leaf) for leaf, rows in tree.reached(points, fewer) for i in rows.tolist()}
        change = points[None].astype(int) - points[:, None]
        near = (np.maximum(change, 0).sum(2) <= 1) & (np.maximum(-change, 0).sum(2) <= fewer)
        assert {(i, place[j]) for i, j in np.argwhere(near)} <= reached


def plain_counts(rows, every):
    total = Counter()
    for key, text in rows:
        run = ""
        for char in (text or "") + " ":
            if char in spelling.LETTERS or char in spelling.LETTERS[:26].upper():
                run += char.lower() if char.isascii() else char
            elif run:
                h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
                total[run if h % every else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
                run = ""
    return total


def test_counts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "TALLY_WORDS", 10)
    draw = random.Random(1)
    pool = some_words(60, 3, "abÀéZ") + ["LONGER" * 30, "Straße", "naïve_word", "中文abc", "a-b"]
    rows = [(i, " ".join(draw.choice(pool) for _ in range(40))) for i in range(50)]
    rows += [(None, "some words some words"), (3, None), (4, ""), rows[0], rows[0]]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int")
    found = spelling.count_words(docs, least_length=3, least_count=2, change=spelling.delete_one, every=3)
    expected = {w: n for w, n in plain_counts(rows, 3).items() if len(w) >= 3 and n >= 2}
    assert {r.word: r.n for r in found.collect()} == expected


def test_forms_and_roots(spark):
    """A chain of forms, a tie, a word that is near but too common, and one that is alone."""
    counts = {
        "aaaaaa": 1000, "aaaaab": 100, "aaaabb": 20, "aaabbb": 4, "tie_one": 5, "cccccx": 50, "cccccy": 50, "cccccz": 10,
        "alone": 7, "eeeeee": 10, "eeeeef": 40,
    }
    counts.pop("tie_one")
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = {r.word: r for r in spelling.variants(df, times=5).collect()}
    assert set(found) == set(counts)
    assert [found["aaabbb"].form, found["aaabbb"].root, found["aaabbb"].form_n] == ["aaaabb", "aaaaaa", 20]
    assert found["aaaaaa"].form is None and found["aaaaaa"].root == "aaaaaa" and found["aaaaaa"].n_near == 1
    assert found["cccccz"].form == "cccccx" and found["cccccz"].n_near == 2
    assert found["eeeeee"].form is None and found["eeeeee"].n_near == 1
    assert found["alone"].n_near == 0 and found["alone"].root == "alone" and found["alone"].form_n is None


def test_nothing_to_group(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    words = spelling.count_words(docs)
    assert words.count() == 0 and spelling.variants(words).count() == 0


def test_very_long_words(spark):
    long = "ab" * 20_000
    words = [long, long + "b", long[:-1] + "c", "c" + long[1:], long[::-1]]
    docs = spark.createDataFrame([(i, " ".join(words)) for i in range(5)], "doc_id long, text string")
    found = {r.word: r for r in spelling.variants(spelling.count_words(docs)).collect()}
    assert {w: found[w].n_near for w in words} == {w: sum(spelling.one_edit(w, v) for v in words) for w in words}
