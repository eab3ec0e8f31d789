"""Line dedup against a dictionary, and the perfect hash."""

from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import line_dedup
from tidemark.llm.perfect_hash import PerfectHash

SPACES = " \t\n\x0b\x0c\r"


def expected(rows, min_chars=20, min_docs=3):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(SPACES).translate(fold)
    holders = defaultdict(list)
    low = -(1 << 63)
    for i, text in rows:
        for k in {key(line) for line in (text or "").split("\n")}:
            holders[k].append(low if i is None else i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        gone = [
            len(key(x)) >= min_chars and len(holders[key(x)]) >= min_docs and max(holders[key(x)]) != (low if i is None else i)
            for x in lines
        ]
        out.append((i, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return sorted(out, key=repr)


def test_salts_follow_the_counts(spark, monkeypatch):
    """A line that a third of all documents hold is probed in as many tasks as its count asks for."""
    kept = {}
    save = line_dedup.stored
    monkeypatch.setattr(line_dedup, "stored", lambda df, label: kept.setdefault(label, save(df, label)))
    monkeypatch.setattr(line_dedup, "SALT_PROBES", 100)
    hot = "a line that very many documents have"
    rows = [(i, hot if i % 3 == 0 else f"a line of its own with the number {i}") for i in range(9000)]
    rows += [(i, "a line that only three documents have") for i in (9001, 9002, 9003)]
    out = line_dedup.drop_repeated(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    assert {r.doc_id for r in out if r.n_dropped} == {*range(0, 8997, 3), 9001, 9002}
    salts = sorted(r.salts for r in kept["line-salts"].collect())
    assert salts in ([8, 30], [30])


@pytest.mark.parametrize("probes", [5, 100_000])
def test_against_dictionary(spark, monkeypatch, probes):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 7)
    monkeypatch.setattr(line_dedup, "SALT_PROBES", probes)
    common, other = "A line that many documents hold.", "Été: another LINE that comes back often"
    rows = [(i, f"own line number {i} is long enough\n  {common}\t\nshort\n{other.lower() if i % 2 else other}") for i in range(60)]
    rows += [(3, f"{common}\n{common}\n{common.upper()}"), (3, f"{common}\n{common}\n{common.upper()}"), (None, common), (100, common)]
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, "x" * 20), (204, "x" * 19), (205, "X" * 20), (206, "x" * 19), (207, "x" * 19)]
    rows += [(208, " " * 3 + "x" * 20 + "\x0b")] + [(300 + i, "\n".join(f"shared sentence number {k} of a passage" for k in range(i, 40))) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = line_dedup.drop_repeated(docs).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped or 0, r.text) for r in out), key=repr) == expected(rows)


def test_other_columns_and_empty_table(spark):
    line = "a line of more than twenty characters"
    docs = spark.createDataFrame(
        [(i, line, i, None, None) for i in range(4)], "doc_id long, text string, n_lines int, th string, places array<int>"
    )
    out = line_dedup.drop_repeated(docs)
    assert out.columns == ["doc_id", "text", "n_lines", "th", "places", "n_lines_", "n_dropped"]
    assert {r.doc_id: r.text for r in out.collect()} == {0: "", 1: "", 2: "", 3: line}
    assert line_dedup.drop_repeated(docs.limit(0)).count() == 0


@pytest.mark.parametrize("size", [0, 1, 2, 1000, 50_000])
def test_perfect_hash(size):
    keys = np.unique(np.random.default_rng(size).integers(0, 1 << 63, size, dtype=np.int64).astype(np.uint64))
    table, arrays = PerfectHash.load(PerfectHash.build(keys).dump(extra=np.arange(3)))
    assert sorted(table.order(keys)) == list(range(len(keys)))
    assert arrays["extra"].tolist() == [0, 1, 2]
    if size:
        others = np.random.default_rng(1).integers(0, 1 << 63, 1000).astype(np.uint64)
        assert table.index(others).max() < len(keys)


def test_perfect_hash_of_equal_keys():
    keys = np.array([5, 5, 9], np.uint64)
    table = PerfectHash.build(keys)
    assert sorted(table.order(keys)) == [0, 1, 2] and table.rest.tolist() == [5, 5]
