"""Line-first cleaning: lines are judged one by one, then the document by what it lost.

A line fails by one of these rules:

* punctuation: more than 30 % of its words end in a run of marks (``!!``, ``%%%``), or it
  holds more symbols than half its words;
* navigation: at least two words, 15 % or more of all, are separators such as ``|``; or it
  has at most three words and no closing mark (a menu entry), or up to ten, all of them
  capitalised (a menu);
* boilerplate: it has at most 20 words and holds a stock phrase of sites and licences in
  English, French, German or Spanish;
* repetition: it has ten words or more, and fewer than 30 % of them differ.

Failing lines are removed. The document is rejected if more than 30 % of its word
characters went with them, if no word is left, or if it fails the base rules: fewer than
50 words (``min_words``), or more than half of the words in repeated windows of three.

Null and empty texts have no words, fail the base rules and are rejected. Documents are
judged alone, so repeated rows and any other columns have no influence.
"""

from __future__ import annotations

import re
from typing import Iterator
from unicodedata import category

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, WORD, column, fresh_name

SYMBOLS = "#*$%&|<>"
MARKED = re.compile(r"[!?#*$%&~^=+<>|]{2,}(?=[\x20\x09-\x0D]|$)")
SEPARATOR = re.compile(r"(?:^|(?<=[\x20\x09-\x0D]))[|»«›‹•·>/]{1,2}(?=[\x20\x09-\x0D]|$)")
CLOSING = tuple(".!?…:;\"'”’»)]}。！？")
# Stock phrases by language, as parts of one pattern.
PHRASES = re.compile(
    r"all rights reserved|terms of (?:use|service)|privacy policy|cookie policy|use of cookies|accept (?:all )?cookies"
    r"|click here|read more|sign up|log ?in\b|subscribe|skip to content|enable javascript|lorem ipsum|powered by"
    r"|licensed under|under the [a-z0-9. -]* ?licen[sc]e|creative commons"
    r"|tous droits réservés|mentions légales|conditions d[’']utilisation|politique de confidentialité|cliquez ici"
    r"|lire la suite|accepter (?:tous )?les cookies|abonnez-vous|plan du site"
    r"|alle rechte vorbehalten|nutzungsbedingungen|datenschutzerklärung|hier klicken|weiterlesen"
    r"|(?:alle )?cookies akzeptieren|jetzt abonnieren|impressum"
    r"|todos los derechos reservados|aviso legal|condiciones de uso|política de privacidad|haga clic aquí"
    r"|leer más|aceptar (?:todas )?las cookies|suscríbete|mapa del sitio",
    re.IGNORECASE,
)

MIN_WORDS, REPEAT_PERCENT = 50, 50
MARKED_PERCENT, SEPARATOR_PERCENT, DISTINCT_PERCENT, LOST_PERCENT = 30, 15, 30, 30
ENTRY_WORDS, MENU_WORDS, PHRASE_WORDS, REPEAT_WORDS = 3, 10, 20, 10

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SCHEMA = (
    ", ".join(f"{c} long" for c in COUNTS)
    + ", base_failed boolean, kept boolean, n_removed_lines long, removed_chars long"
)


def line_fails(line: str, words: list[str]) -> bool:
    """Whether a line that has words fails one of the rules."""
    n = len(words)
    if 100 * len(MARKED.findall(line)) > MARKED_PERCENT * n or 2 * sum(map(line.count, SYMBOLS)) > n:
        return True
    separators = len(SEPARATOR.findall(line))
    if separators >= 2 and 100 * separators >= SEPARATOR_PERCENT * n:
        return True
    if n <= MENU_WORDS and not line.rstrip(SPACES).endswith(CLOSING):
        if n <= ENTRY_WORDS or all(category(word[0]) == "Lu" for word in words):
            return True
    if n <= PHRASE_WORDS and PHRASES.search(line):
        return True
    return n >= REPEAT_WORDS and 100 * len(set(words)) < DISTINCT_PERCENT * n


def repeated_words(words: list[str]) -> int:
    """Words inside windows of three that occur at least twice, the first one included."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) > 2_000_000:  # products of three would not fit 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    windows = pairs[:-1] * len(number) + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    starts = np.zeros(n - 2, bool)
    starts[order[1:][same]] = True
    starts[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= starts
    return int(covered.sum())


def judge(text: str | None, min_words: int = MIN_WORDS) -> tuple:
    """All figures of one document, and its text without the lines that fail."""
    text = text or ""
    words: list[str] = []
    kept_lines: list[str] = []
    seen: set[str] = set()
    word_chars = dup_lines = removed = lost = left = 0
    for line in text.split("\n"):
        own = WORD.findall(line)
        if not own:
            kept_lines.append(line)
            continue
        words += own
        chars = sum(map(len, own))
        word_chars += chars
        if line in seen:
            dup_lines += 1
        seen.add(line)
        if line_fails(line, own):
            removed += 1
            lost += chars
        else:
            left += 1
            kept_lines.append(line)
    n = len(words)
    repeats = repeated_words(words)
    base_failed = n < min_words or 100 * repeats > REPEAT_PERCENT * n
    kept = not base_failed and left > 0 and 100 * lost <= LOST_PERCENT * word_chars
    symbols = sum(map(text.count, SYMBOLS))
    return n, word_chars, symbols, dup_lines, repeats, base_failed, kept, removed, lost, "\n".join(kept_lines)


def assess(text: Column, with_text: bool = False, min_words: int = MIN_WORDS) -> Column:
    """A struct of the counts, ``base_failed``, ``kept`` and, if asked for, ``clean_text``."""
    fields = SCHEMA + (", clean_text string" if with_text else "")
    names = [f.split()[0] for f in fields.split(", ")]

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([judge(t, min_words)[: len(names)] for t in batch], columns=names)

    # Marked so, because the optimizer would run it again for a filter on its result.
    return F.pandas_udf(run, fields).asNondeterministic()(text)


def clean(
    docs: DataFrame, text_col: str = "text", verdict: str = "quality", keep_all: bool = False, min_words: int = MIN_WORDS
) -> DataFrame:
    """``docs`` with failing lines removed; rejected documents go unless ``keep_all``.

    With ``keep_all`` the figures stand in a struct column called ``verdict`` (renamed if
    taken) and rejected documents keep their rows.
    """
    name = fresh_name(docs, verdict)
    out = docs.withColumn(name, assess(column(docs, text_col), True, min_words))
    if not keep_all:
        out = out.where(F.col(name).kept)
    out = out.withColumn(text_col, F.col(name).clean_text)
    return out.withColumn(name, F.col(name).dropFields("clean_text")) if keep_all else out.drop(name)
