"""The classifier, the context tree with its scores, and the piece counter."""

import itertools
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import context_tree, lm_scoring, quality_model, token_counts

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- word pieces -------------------------------------------------------------------


def greedy(word, starts, continuations):
    at = count = 0
    while at < len(word):
        entries = starts if at == 0 else continuations
        end = next((e for e in range(len(word), at, -1) if word[at:e] in entries), None)
        if end is None:
            return 0
        at, count = end, count + 1
    return count


def test_counts_equal_greedy_matching():
    draw = random.Random(0)
    for _ in range(300):
        entries = ["".join(draw.choice("abc") for _ in range(draw.randrange(1, 5))) for _ in range(draw.randrange(1, 12))]
        cut = draw.randrange(len(entries) + 1)
        starts, rest = set(entries[:cut]), set(entries[cut:])
        counter = token_counts.PieceCounter(starts, rest)
        for size in range(1, 7):
            for word in itertools.islice(map("".join, itertools.product("abc", repeat=size)), 0, None, 7):
                assert counter.count(word) == greedy(word, starts, rest), (word, starts, rest)


def test_counts_with_the_public_vocabulary(spark):
    starts, rest = map(set, token_counts.read_vocabulary(PIECES))
    texts = ["Hello world, unbelievable!", None, "", "   ", "你好 😀☃x naïve", "word " * 500, "Ünïcödé-" * 40]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(0, texts[0], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    out = token_counts.add_counts(docs, PIECES)
    assert out.columns == ["doc_id", "text", "n_words", "n_words_", "n_tokens", "n_unknown"]
    for r in out.collect():
        words = WORD.findall(r.text or "")
        found = [greedy(w, starts, rest) for w in words]
        assert (r.n_words_, r.n_tokens, r.n_unknown) == (len(words), sum(c or 1 for c in found), found.count(0))
    assert token_counts.add_counts(docs.limit(0), PIECES).count() == 0


# --- quality model -----------------------------------------------------------------


def texts_of(kind, count, seed):
    draw = random.Random(seed)
    words = ["of", "the", "river", "and", "hill", "walks", "green", "slowly", "home", "winter"]
    make = (lambda w: w.upper() + "!!") if kind == 0 else (lambda w: w)
    return [" ".join(make(draw.choice(words) + str(draw.randrange(9))) for _ in range(draw.randrange(20, 80))) for _ in range(count)]


def test_learns_and_scores(spark):
    rows = [(i, t) for i, t in enumerate(texts_of(1, 150, 1) + texts_of(0, 150, 2))]
    extra = [(900, None), (901, ""), (902, " \n"), (902, texts_of(1, 1, 3)[0]), (None, "a b"), (903, "word " * 20000)]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string").withColumn("score", F.lit(None).cast("string"))
    labels = [(i, int(i < 150)) for i in range(0, 300, 2)] + [(None, 1), (4, None), (7777, 1), (5, 3)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    model = spark.sparkContext.broadcast(quality_model.fit(docs, labels))
    out = docs.select("doc_id", quality_model.score(F.col("text"), model).alias("p")).collect()
    scores = [(r.doc_id, r.p) for r in out]
    assert len(scores) == len(rows) + len(extra) and all(0 <= p <= 1 for _, p in scores)
    assert all((p >= 0.5) == (i < 150) for i, p in scores if i is not None and i < 300)
    assert [p for i, p in scores if i in (900, 901)] == [0, 0] and sorted(p for i, p in scores if i == 902)[0] == 0


def test_without_both_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    for labels, expected in (([(1, 1), (2, 1)], 1.0), ([], 0.5)):
        labels = spark.createDataFrame(labels, "doc_id long, quality int")
        model = spark.sparkContext.broadcast(quality_model.fit(docs, labels))
        assert [r[0] for r in docs.select(quality_model.score(F.col("text"), model)).collect()] == [expected] * 2


def test_shape_of_the_whole_word():
    assert quality_model.shape("a" * 64 + "9%") == "aa0%" and quality_model.shape("a" * 64) == "aa"
    assert quality_model.shape("你好" * 40 + "!!!1") == "aa!!0"


def test_word_vectors_come_from_all_documents(spark):
    texts = ["good text here", "bad text there", "unlabelled zebra words", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int")
    model = quality_model.fit(docs, labels)
    expected = quality_model.unit_rows(quality_model.context_sums([t or "" for t in texts]))
    assert (model.vectors == expected).all()
    zebra = quality_model.Terms().of("zebra")[0][0]
    assert model.vectors[zebra].any()


ODD_TEXTS = ["a a a b", "", "one", "x  y\tz\n\nx y z W W W!", "Ünï 中文 123 $$$ a", "a b " * 50, " ", "b"]


def plain_terms(text):
    """Pairs (word, shape) by the definitions."""
    words, out = re.findall(r"[^\x20\x09-\x0D]+", text), []
    for i, word in enumerate(words):
        kind = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
        kind = re.sub(r"(.)\1{2,}", r"\1\1", kind) + (" again" if i and words[i - 1] == word else "")
        out.append((zlib.crc32(word.encode()) % 2**14, 2**14 + zlib.crc32(kind.encode()) % 2**10))
    return out


@pytest.mark.parametrize("step,table", [(1_000_000, 200_000), (5, 200_000), (40, 2)])
def test_word_vectors_by_nested_loops(monkeypatch, step, table):
    monkeypatch.setattr(quality_model, "STEP_CHARS", step)
    monkeypatch.setattr(quality_model, "TABLE_WORDS", table)
    places, signs = quality_model.index_vectors()
    expected = np.zeros((2**14 + 2**10, 64), np.int64)
    for text in ODD_TEXTS:
        terms = plain_terms(text)
        for i, own in enumerate(terms):
            for j in (i - 2, i - 1, i + 1, i + 2):
                for a in own if 0 <= j < len(terms) else ():
                    for b in terms[j]:
                        for place, sign in zip(places[b], signs[b]):
                            expected[a, place] += sign
    assert (quality_model.context_sums(iter(ODD_TEXTS)) == expected).all()


ODDER_TEXTS = [
    "", "\n", "aaa aaa aaaa", "aa a aaa\taab", "x\x0by\x0cz\r\nx", "no\u00a0break\u2028line\x85next\x1cfile\x1fend\x00nul", "😀😀😀😀 𝒳𝒳𝒳a",
    "ÀÉÎ àéî ßßßß", "٣٣٣٣ 12345", "a" * 5000 + "é" * 3 + " tail", " lead", "trail ", "same", "same same", "\u0130\u0130\u0130I i",
]


@pytest.mark.parametrize("table", [200_000, 2])
def test_terms_by_definition(monkeypatch, table):
    """Several texts at once and the same object again, against one word at a time."""
    monkeypatch.setattr(quality_model, "TABLE_WORDS", table)
    draw = random.Random(12)
    mixed = ["".join(draw.choice("aAé0!中😀 \n\t") for _ in range(draw.randrange(60))) for _ in range(200)]
    terms = quality_model.Terms()
    for texts in (ODDER_TEXTS, mixed, ["", " "], mixed[:3], ODD_TEXTS):
        words, kinds, counts = terms.of_all(texts)
        plain = [plain_terms(text) for text in texts]
        assert counts.tolist() == [len(p) for p in plain]
        assert list(zip(words.tolist(), kinds.tolist())) == [pair for p in plain for pair in p]
        for word in (w for text in texts for w in WORD.findall(text)):
            kind = 2**14 + zlib.crc32(quality_model.shape(word).encode()) % 2**10
            assert terms.of(word)[1].tolist() == [kind]


@pytest.mark.parametrize("places,most", [(3, 5), (7, 7), (1 << 17, 1 << 19)])
def test_word_vectors_in_blocks_of_places(monkeypatch, places, most):
    """Blocks inside a text, and sums taken out in between, change nothing."""
    monkeypatch.setattr(quality_model, "PLACES", places)
    monkeypatch.setattr(quality_model, "MOST_PLACES", most)
    index = np.zeros((2**14 + 2**10, 64), np.int64)
    for term, (at, signs) in enumerate(zip(*quality_model.index_vectors())):
        np.add.at(index[term], at, signs)
    expected = np.zeros_like(index)
    for text in ODDER_TEXTS + ODD_TEXTS:
        both = plain_terms(text)
        for i, own in enumerate(both):
            near = sum((index[a] + index[b] for j in (i - 2, i - 1, i + 1, i + 2) if 0 <= j < len(both) for a, b in both[j : j + 1]), np.zeros(64, np.int64))
            expected[list(own)] += near
    assert (quality_model.context_sums(iter(ODDER_TEXTS + ODD_TEXTS)) == expected).all()


def test_lanes_hold_the_most_frequent_terms():
    """Over a million places of the same two terms: no sum runs over into its neighbour."""
    count = 1_100_000
    word, kind = plain_terms("a a")[1]
    places, signs = quality_model.index_vectors()
    index = np.zeros((2, 64), np.int64)
    for row, term in zip(index, (word, kind)):
        np.add.at(row, places[term], signs[term])
    found = quality_model.context_sums(["a " * count])
    # All but the first word repeat the one before, so their shape is another one than its own.
    assert (np.abs(found[word] - 4 * count * index.sum(0)) <= 100).all()
    assert (np.abs(found[kind] - 4 * count * index.sum(0)) <= 100).all() and found.any()


def test_words_cost_little_more_than_finding_them():
    """CPU time per word, most of them rare, in units of the time that a regular expression takes."""
    draw = random.Random(3)
    parts = ["the", "er", "on", "and", "re", "ou", "ti", "st", "en", "ha"]
    words = ["".join(draw.choices(parts, k=draw.randrange(1, 6))) for _ in range(100_000)]
    texts = [" ".join(draw.choices(words, k=500)) + ".\n" for _ in range(800)]

    def least(run):
        took = []
        for _ in range(3):
            began = time.process_time()
            run()
            took.append(time.process_time() - began)
        return min(took)

    unit = least(lambda: [WORD.findall(text) for text in texts])
    assert least(lambda: [quality_model.Terms().of_all(some) for some in quality_model.steps(texts)]) < 1.5 * unit
    assert least(lambda: quality_model.context_sums(texts)) < 4 * unit


def test_forward_pass_by_loops():
    """Scores of a random model, word by word and unit by unit."""
    draw = np.random.default_rng(8)
    vectors = draw.normal(size=(2**14 + 2**10, 64)).astype(np.float32)
    width = 4 * 64 + 1
    weights = (draw.normal(size=(width, 3)) / 9, draw.normal(size=3), draw.normal(size=3), draw.normal(size=1))
    model = quality_model.Model(vectors, None, draw.normal(size=width), draw.random(width) + 0.5, weights, 1.7)
    found = model.scores(ODD_TEXTS, quality_model.Terms())
    for text, score in zip(ODD_TEXTS, found):
        terms = plain_terms(text)
        if not terms:
            assert score == 0
            continue
        features = []
        for side in (0, 1):
            rows = [vectors[t[side]].astype(float) for t in terms]
            mean = sum(rows) / len(rows)
            features += [*mean, *np.sqrt(np.maximum(sum(r * r for r in rows) / len(rows) - mean * mean, 0))]
        features.append(math.log1p(len(terms)) / 10)
        x = [(f - c) / s for f, c, s in zip(features, model.center, model.scale)]
        hidden = [math.tanh(sum(v * weights[0][i, h] for i, v in enumerate(x)) + weights[1][h]) for h in range(3)]
        logit = (sum(h * w for h, w in zip(hidden, weights[2])) + weights[3][0]) / 1.7
        assert abs(score - 1 / (1 + math.exp(-logit))) < 1e-4


def test_empty_tables_and_repeated_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0)], "doc_id long, quality int")
    assert quality_model.fit(empty, labels).constant == 0.5
    model = spark.sparkContext.broadcast(quality_model.fit(empty, labels.limit(0)))
    assert empty.select(quality_model.score(F.col("text"), model)).count() == 0
    # Many rows with one labelled id: the same ones are taken, however they are dealt.
    docs = spark.createDataFrame([(1, t) for t in texts_of(1, 40, 5)] + [(2, t) for t in texts_of(0, 40, 6)], "doc_id long, text string")
    models = [quality_model.fit(docs.repartition(n), labels, sample_rows=30) for n in (1, 7)]
    assert all((a == b).all() for a, b in zip(models[0].weights, models[1].weights))


def test_probabilities_are_calibrated():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(4000, 6))
    chance = 1 / (1 + np.exp(-(x[:, 0] * 2 - x[:, 1])))
    y = (draw.random(4000) < chance).astype(float)
    model = quality_model.train(x[:3000], y[:3000], np.zeros((1, 1), np.float32))
    p = 1 / (1 + np.exp(-model.logits(x[3000:]) / model.temperature))
    assert abs(p.mean() - y[3000:].mean()) < 0.05
    high = p > 0.8
    assert abs(p[high].mean() - y[3000:][high].mean()) < 0.08


# --- context tree ------------------------------------------------------------------


def plain_tree(words, counts, depth, least):
    """Chance of a byte after a context, by the definitions, with dictionaries."""
    tally = {}
    for word, n in zip(words, counts):
        data = b" " * depth + context_tree.coded(word)
        for i in range(depth, len(data)):
            bits = f"{data[i]:08b}"
            for k in range(depth + 1):
                for j in range(8):
                    pair = tally.setdefault((data[i - k : i], bits[:j]), [0, 0])
                    pair[int(bits[j])] += n
    tally = {k: v for k, v in tally.items() if sum(v) >= least}
    block = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weigh(node):
        context, bits = node
        zeros, ones = tally[node]
        below = [(bytes([c]) + context, bits) for c in range(256) if (bytes([c]) + context, bits) in tally]
        if not below or len(context) == depth:
            return block(zeros, ones), 1.0, (0, 0)
        rest = zeros - sum(tally[n][0] for n in below), ones - sum(tally[n][1] for n in below)
        split = sum(weigh(n)[0] for n in below) + block(*rest)
        mixed = np.logaddexp(block(zeros, ones), split) - math.log(2)
        return mixed, math.exp(block(zeros, ones) - math.log(2) - mixed), rest

    def chance(context, bits):
        said, left = 0.0, 1.0
        for k in range(depth + 1):
            node = (context[len(context) - k :], bits)
            if node not in tally:
                return said + left * (rest[1] + 0.5) / (sum(rest) + 1) if k else 0.5
            _, own, rest = weigh(node)
            zeros, ones = tally[node]
            said += left * own * (ones + 0.5) / (zeros + ones + 1)
            left *= 1 - own
        return said

    def log10(context, byte):
        bits = f"{byte:08b}"
        return sum(math.log10(p if b == "1" else 1 - p) for j, b in enumerate(bits) for p in [chance(context, bits[:j])])

    return log10


@pytest.mark.parametrize("least", [1, 3])
def test_tree_equals_the_definition(least, monkeypatch):
    monkeypatch.setattr(context_tree, "DEPTH", 2)
    words, counts = [b"ab", b"abc", b"bca", b"\n", "é".encode()], np.array([3, 2, 4, 5, 1])
    codes, owner = context_tree.grams(words)
    codes, many = context_tree.summed(codes, counts[owner])
    levels = dict(context_tree.all_levels(codes, many, least))
    tree = context_tree.Tree.build([levels[k] for k in range(3)])
    plain = plain_tree(words, counts, 2, least)
    for word in [b"ab", b"abd", b"zz", b"\n", b"bcab"]:
        data = b"  " + context_tree.coded(word)
        expected = sum(plain(data[i - 2 : i], data[i]) for i in range(2, len(data)))
        assert context_tree.word_scores(tree, [word])[0] == pytest.approx(expected)
    every = (np.uint64(ord("a") << 16 | ord("b") << 8)) | np.arange(256, dtype=np.uint64)
    assert (10 ** tree.log10(every)).sum() == pytest.approx(1)


# --- scores ------------------------------------------------------------------------


def test_scores_and_baseline(spark):
    draw = random.Random(4)
    texts = ["\n".join(" ".join(draw.choice(["The", "cat", "sat", "On", "mats", "été"]) for _ in range(6)) for _ in range(4)) for _ in range(60)]
    texts += [None, "", "\n\n", "never seen words here", "The cat " * 2000, texts[0], texts[0]]
    rows = [(i, t, i % 3 != 0, "c") for i, t in enumerate(texts)] + [(None, "The cat", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, train boolean, score string")
    out = lm_scoring.score(docs.repartition(3), F.col("train"))
    assert out.columns == ["doc_id", "train", "score", "n_tokens", "n_known", "train_tokens", "base_score", "score_"]
    found = {r.doc_id: r for r in out.collect()}
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {i: WORD.findall((t or "").translate(fold)) + ["\n"] for i, t, _, _ in rows}
    seen = Counter(w for i, _, train, _ in rows if train for w in tokens[i])
    total, distinct = sum(seen.values()), len(seen)
    assert len(found) == len(rows)
    for i, own in tokens.items():
        r = found[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(seen[w] > 0 for w in own), total)
        assert r.base_score == pytest.approx(sum(math.log10((seen[w] + 1) / (total + distinct + 1)) for w in own))
        assert r.score_ < 0
    # Held-out texts of known words cost far less per character than other words.
    cost = lambda i: -found[i].score_ / len(texts[i])
    assert all(3 * cost(i) < cost(63) for i in range(0, 60, 3))
    assert lm_scoring.score(docs.limit(0), F.col("train")).count() == 0


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id long, text string")
    out = {r.doc_id: r for r in lm_scoring.score(docs, F.lit(False)).collect()}
    assert (out[1].n_tokens, out[1].n_known, out[1].train_tokens, out[1].base_score) == (2, 0, 0, 0.0)
    # Every bit is even: two letters, a blank, a line end, the text's end.
    assert out[1].score == pytest.approx(40 * math.log10(0.5)) and out[2].score == pytest.approx(16 * math.log10(0.5))


def one_tree(training):
    """The tree over whole streams, held in one place."""
    codes, counts = lm_scoring.distinct_grams([context_tree.stream(t) for t in training])
    levels = dict(context_tree.all_levels(codes, counts, 1))
    return context_tree.Tree.build([levels[k] for k in range(context_tree.DEPTH + 1)])


def by_one_tree(tree, text):
    codes, _ = context_tree.windows([context_tree.STREAM_END * context_tree.DEPTH + context_tree.stream(text)])
    return tree.log10(codes).sum()


def test_contexts_cross_words_and_lines(spark):
    draw = random.Random(5)
    chain = {"the": ["cat", "dog"], "cat": ["sat", "ran"], "dog": ["ran", "sat"], "sat": ["on"], "ran": ["on"], "on": ["the"]}
    texts = []
    for _ in range(80):
        words = ["the"]
        while len(words) < 60:
            words.append(draw.choice(chain[words[-1]]))
        texts.append("\n".join(" ".join(words[i : i + 12]) for i in range(0, 60, 12)))
    shuffled = texts[0].split()
    draw.shuffle(shuffled)
    texts += [" ".join(shuffled), " ".join(texts[0].split()), "two  blanks\t", "two blanks", "Été\r\n", None]
    rows = [(i, t, 1 <= i < 80) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, train boolean").repartition(3)
    found = {r.doc_id: r.score for r in lm_scoring.score(docs, F.col("train")).collect()}
    tree = one_tree([t for _, t, train in rows if train])
    for i, text, _ in rows:
        lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
        assert found[i] == pytest.approx(by_one_tree(tree, lower), rel=1e-6)
    assert found[81] > found[80] + 20 and found[82] != found[83]


def test_streams_longer_than_a_step(monkeypatch):
    text = "ab cé\n\nthe end " * 9
    whole = context_tree.windows([context_tree.STREAM_END * context_tree.DEPTH + context_tree.stream(text)])[0]
    monkeypatch.setattr(context_tree, "STEP", 10)
    parts = list(context_tree.stream_grams([b"x", context_tree.stream(text)]))
    codes, owner = (np.concatenate(p) for p in zip(*parts))
    assert len(parts) > 5 and (codes[owner == 1] == whole).all() and (owner == 0).sum() == 1


def test_rare_contexts_are_kept_at_any_size(spark):
    # Over 2 ** 20 bytes, so that a node for any fixed share of them would need several.
    texts = ["the cat sat on the mats " * 2500] * 20 + ["qzxvj wkfyq", "qzxvj wkfyq", "jvxzq qyfkw"]
    rows = [(i, t, i <= 20) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, train boolean").repartition(3)
    found = {r.doc_id: r.score for r in lm_scoring.score(docs, F.col("train")).collect()}
    tree = one_tree([t for _, t, train in rows if train])
    for i in (0, 20, 21, 22):
        assert found[i] == pytest.approx(by_one_tree(tree, texts[i]), rel=1e-6)
    # Seen once, it costs less than half of what the same letters cost in another order.
    assert found[21] > found[22] / 2


def test_code_length(spark):
    texts = ["The cat sat\non the mats", None, "é"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = lm_scoring.score(docs, F.col("doc_id") == 0, code_length=True)
    assert out.columns[-2:] == ["coded_bytes", "bits_per_byte"]
    found = {r.doc_id: r for r in out.collect()}
    # Two lines with blanks and ends, and the text's end; the text's end after an empty line; two bytes of a letter.
    assert [found[i].coded_bytes for i in range(3)] == [11 + 2 + 11 + 2 + 1, 2, 2 + 2 + 1]
    for r in found.values():
        assert r.bits_per_byte == pytest.approx(-r.score * math.log2(10) / r.coded_bytes)
    nothing = lm_scoring.score(docs, F.lit(False), code_length=True).collect()
    assert [r.bits_per_byte for r in nothing] == pytest.approx([8] * 3)
