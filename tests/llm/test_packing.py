"""Packing: whole pieces, gapless sequences, few of them."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from tidemark.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", None, " ", "HẖELLO ẖ İstanbul ΣΣ ABCΣ.", "don't. DON'T, it's!! 'start' a\x1cb x\x85y", "<|endoftext|> hi",
    "café. café.", "你好。 123.45, a1.", "..,,", "😀!? 힣.", "word " * 5000, "The the THE the. the, The!",
]


def reference(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_ids_equal_the_tokenizers():
    words = packing.WordIds(PATH)
    assert [list(i) for i in words.encode([t or "" for t in ODD])] == reference(ODD)


def test_ids_of_random_strings():
    draw = np.random.default_rng(9)
    letters = list("aİIiéß.,:;! \n'Σ中1~")
    texts = ["".join(draw.choice(letters, draw.integers(1, 12))) for _ in range(20_000)]
    assert [list(i) for i in packing.WordIds(PATH).encode(texts)] == reference(texts)


@pytest.mark.parametrize("step", [1, 7, 40])
def test_ids_of_long_texts(monkeypatch, step):
    monkeypatch.setattr(packing, "STEP_CHARS", step)
    assert [list(i) for i in packing.WordIds(PATH).encode([t or "" for t in ODD])] == reference(ODD)


def test_a_full_table_starts_anew(monkeypatch):
    monkeypatch.setattr(packing, "TABLE_WORDS", 5)
    words = packing.WordIds(PATH)
    for _ in range(2):
        assert [list(i) for t in ODD for i in words.encode([t or ""])] == reference(ODD)


@pytest.mark.parametrize("seed", range(3))
def test_rule_minimises_the_sum_of_squares(seed):
    draw = np.random.default_rng(seed)
    size, lengths = 12, draw.integers(1, 12, 60)
    bins, offsets, made = packing.sum_of_squares(lengths, size)
    level = {}
    for s, b, at in zip(lengths.tolist(), bins.tolist(), offsets.tolist()):
        def cost(levels):
            gaps = np.bincount([size - v for v in levels.values() if v < size], minlength=size)
            return int((gaps**2).sum())
        options = [cost(level | {k: v + s}) for k, v in level.items() if v + s <= size] + [cost(level | {-1: s})]
        assert at == level.get(b, 0)
        level[b] = at + s
        assert cost(level) == min(options)
    assert made == len(level) and max(level.values()) <= size


def test_pieces_and_places(spark):
    rows = [(i, t, f"s{i}", None) for i, t in enumerate(ODD)] + [(3, ODD[3], "again", None), (None, "x", "n", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string, offset string")
    out = packing.pack(docs, PATH, with_ids=True)
    assert out.columns == [
        "doc_id", "length", "offset", "piece", "start", "length_", "ids_crc32", "ids", "sequence_id", "offset_"
    ]
    found, filled = defaultdict(dict), defaultdict(list)
    for r in out.collect():
        found[(r.doc_id, r.length)][r.piece] = r
        filled[r.sequence_id].append((r.offset_, r.length_))
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length_
    assert len(found) == len(rows)
    for (i, t, name, _), ids in zip(rows, reference([r[1] for r in rows])):
        pieces = [found[(i, name)][k] for k in range(len(found[(i, name)]))]
        assert np.concatenate([np.frombuffer(p.ids, "<u4") for p in pieces]).tolist() == ids + [0]
        assert [p.start for p in pieces] == list(range(0, len(ids) + 1, 2048))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(docs.limit(0), PATH).count() == 0


def test_few_sequences(spark):
    draw = np.random.default_rng(5)
    lengths = spark.createDataFrame([(int(v),) for v in draw.integers(1, 2049, 3000)], "length int")
    out = packing.place(lengths, group_rows=1000)
    total = out.selectExpr("sum(length)", "count(distinct sequence_id)").first()
    assert total[1] <= 1.05 * -(-total[0] // 2048)
