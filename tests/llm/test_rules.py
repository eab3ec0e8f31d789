"""Quality rules against a plain reading of their definitions."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality_rules
from tidemark.llm.quality_rules import judge, repeated_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLEAN = "\n".join(" ".join(f"word{chr(97 + i)}{chr(97 + k)}" for k in range(14)) + "." for i in range(8))


def plain_repeats(words):
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i, w in enumerate(zip(words, words[1:], words[2:])):
        if windows[w] > 1:
            covered |= {i, i + 1, i + 2}
    return len(covered)


@pytest.mark.parametrize("text", ["", "a", "a a a", "a a a a", "a b c a b c", "a b c d e f", "x y x y x y z", "a b c " * 40 + "d"])
def test_repeated_words(text):
    words = text.split()
    assert repeated_words(words) == plain_repeats(words)


def test_repeated_words_of_many():
    words = [f"w{i % 3000}" for i in range(9000)] + [f"u{i}" for i in range(3000)]
    assert repeated_words(words) == plain_repeats(words)


def test_counts():
    n, chars, symbols, dups, repeats, base_failed, kept, removed, lost, text = judge("a b\n\na b\n \n \nc# <d>\x0b\n")
    assert (n, chars, symbols, dups, repeats) == (6, 9, 3, 1, 0)
    assert base_failed and not kept


@pytest.mark.parametrize("line", [
    "WORDS!! THAT!! ARE!! ALL!! SHOUTED!!", "of%%% the&&& and*** those$$$", "home | news | sport | weather | more words",
    "Read more", "All rights reserved.", " ".join(["again"] * 12) + ".", "Home Products About Contact",
    "Accueil Nos Produits Écrivez Plan", "Released under the MIT License.", "This work is licensed under CC-BY 4.0.",
    "Tous droits réservés.", "© 2024 Beispiel GmbH. Alle Rechte vorbehalten.", "Haga clic aquí para leer el resto.",
    "Conditions d'utilisation et mentions.", "Datenschutzerklärung und mehr dazu.",
])
def test_lines_that_fail(line):
    assert judge(CLEAN + "\n" + line)[7] == 1
    assert judge(CLEAN + "\n" + line)[9] == CLEAN
    assert judge(CLEAN + "\n" + line)[6]


@pytest.mark.parametrize("line", [
    "He came to the house and left", "One Two three Four five", "The End Is Near And We Know It.", "Berlin, London, Paris and Rome are far.",
])
def test_lines_that_stay(line):
    assert judge(CLEAN + "\n" + line)[7] == 0


def test_documents_that_lose_too_much():
    bad = "\n".join(["home | news | sport | weather | more | words | of | this | kind"] * 8)
    assert not judge(CLEAN + "\n" + bad)[6]
    assert judge(CLEAN)[6] and judge(CLEAN)[7] == 0


def test_clean_keeps_columns(spark):
    docs = spark.createDataFrame(
        [(1, CLEAN + "\nRead more", None, "a"), (1, CLEAN + "\nRead more", None, "a"), (2, None, "x", None), (None, "", None, "b")],
        "doc_id long, text string, quality string, kept string",
    )
    out = quality_rules.clean(docs)
    assert out.columns == docs.columns
    assert [(r.doc_id, r.text, r.quality, r.kept) for r in out.collect()] == [(1, CLEAN, None, "a")] * 2
    every = quality_rules.clean(docs, keep_all=True)
    assert every.columns == [*docs.columns, "quality_"] and every.count() == 4
    assert quality_rules.clean(docs.limit(0)).count() == 0
    assert every.select(F.col("quality_").n_words).where("doc_id = 2").first()[0] == 0
