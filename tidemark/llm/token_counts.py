"""Word-piece token counts by a linear longest-match automaton.

Greedy word pieces take the longest vocabulary entry at the start of a word, then again and
again the longest continuation entry. The automaton reads a word once, character by
character: a trie of all entries whose nodes know, for the case that no entry goes on with
the next character, how many pieces are complete by then (the popped count) and the node
for what is left (the failure link). So a word's count needs no pieces and no second look.
A word that cannot be cut into entries counts as one unknown token.

Words are separated by ASCII white space. Each distinct word is counted once per worker (the
table starts anew when it is full). Null and empty texts have no words. Rows are counted
alone, so repeated rows and other columns have no influence.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, column, fresh_name

COUNTS = ["n_words", "n_tokens", "n_unknown"]
TABLE_WORDS = 1_000_000
WORD_START = "▁"
NOWHERE = -1


class PieceCounter:
    """The automaton for entries at the start of a word and entries that continue one."""

    def __init__(self, starts: Iterable[str], continuations: Iterable[str]):
        self.next: list[dict[str, int]] = [{}, {}]  # node 0: start of a word, node 1: continuation
        ends = set()
        for root, entries in ((0, starts), (1, continuations)):
            for entry in entries:
                node = root
                for char in entry:
                    if char not in self.next[node]:
                        self.next[node][char] = len(self.next)
                        self.next.append({})
                    node = self.next[node][char]
                if entry:
                    ends.add(node)
        self.fail = [NOWHERE] * len(self.next)
        self.popped = [0] * len(self.next)
        queue = deque([0, 1])
        while queue:
            parent = queue.popleft()
            for char, node in self.next[parent].items():
                queue.append(node)
                if node in ends:
                    self.fail[node], self.popped[node] = 1, 1
                    continue
                count, back = self.popped[parent], self.fail[parent]
                while back != NOWHERE and char not in self.next[back]:
                    count, back = count + self.popped[back], self.fail[back]
                if back != NOWHERE:
                    self.fail[node], self.popped[node] = self.next[back][char], count
        # The continuation root has nothing left to pop.
        self.fail[0] = self.fail[1] = NOWHERE

    def count(self, word: str) -> int:
        """The number of pieces of a word of at least one character; 0 if it cannot be cut."""
        go, fail, popped = self.next, self.fail, self.popped
        node = total = 0
        for char in word:
            while char not in go[node]:
                total += popped[node]
                node = fail[node]
                if node == NOWHERE:
                    return 0
            node = go[node][char]
        while node != 1:
            total += popped[node]
            node = fail[node]
            if node == NOWHERE:
                return 0
        return total


def read_vocabulary(path: str) -> tuple[list[str], list[str]]:
    """Entries that start a word, and others, from a sentencepiece model that marks starts."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [
        model.id_to_piece(i) for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    starts = [p[1:] for p in pieces if p.startswith(WORD_START) and len(p) > 1]
    return starts, [p for p in pieces if WORD_START not in p]


def counts(text: Column, vocabulary: str) -> Column:
    """A struct of n_words, n_tokens (an unknown word is one) and n_unknown."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = PieceCounter(*read_vocabulary(vocabulary))
        known: dict[str, int] = {}
        for batch in batches:
            rows = []
            for text in batch:
                words = WORD.findall(text or "")
                if len(known) > TABLE_WORDS:
                    known.clear()
                for word in set(words).difference(known):
                    known[word] = counter.count(word)
                found = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                unknown = int((found == 0).sum())
                rows.append((len(words), int(found.sum()) + unknown, unknown))
            yield pd.DataFrame(rows, columns=COUNTS)

    return F.pandas_udf(run, ", ".join(f"{c} long" for c in COUNTS)).asNondeterministic()(text)


def add_counts(docs: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts of its texts (names of added columns are changed if taken)."""
    name = fresh_name(docs, "token_counts")
    out = docs.withColumn(name, counts(column(docs, text_col), vocabulary))
    return out.select(*[column(docs, c) for c in docs.columns], *[F.col(name)[c].alias(fresh_name(docs, c)) for c in COUNTS])
