"""Sum-of-squares packing of tokenized documents into sequences of fixed length.

Documents become ids plus one closing id; only those longer than a sequence are cut. Pieces
that fill a sequence stand alone. The others are dealt at random into groups of a bounded
size, and each group is packed by the sum-of-squares rule: a piece goes where, afterwards,
the sum over all residual gaps of (number of open bins with that gap) squared is smallest; an
exact fit closes its bin, and opening a bin is one of the choices. Ties go to the smallest
gap. Random order leaves only a few dozen bins of a large group open; small groups do better
with the longest pieces first, so both orders are tried and the one with fewer bins stays.

Words between white space are tokenized apart, which the vocabulary's normaliser and
splitter allow, and each distinct word, less its closing marks, is tokenized once per worker.
Memory is bounded: texts are taken by the million characters, longer ones cut at white space,
and the table of words starts anew when it is full.

Null and empty texts give the closing id alone, so every row has at least one piece. Rows
are told apart by a number written with the pieces; repeated ids and other columns (also
those with the names of added columns, which are then renamed) do no harm. An empty table
gives no pieces.
"""

from __future__ import annotations

import os
import re
import unicodedata
from itertools import chain
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE_CLASS, WORD, column, crc, fresh_name, stored

SEQUENCE, CLOSING_ID = 2048, 0
GROUP_ROWS = 50_000
TABLE_WORDS = 1_300_000
STEP_CHARS = 1_000_000
PIECE = "piece int, start long, length long, ids_crc32 long"
MARKS = ".,;:!?"
MARK = "~"
# Characters on which Python's split() and the vocabulary's white space differ.
ODD_SPACES = re.compile("[\x1c-\x1f]")
SPACE = re.compile(f"[{SPACE_CLASS}]")


def folded(text: str) -> str:
    """``text`` composed and, where the vocabulary's normaliser agrees, in lower case.

    Lower case is left to the normaliser where it may differ by library: for letters that
    change their length or depend on their place, and where the result could be composed.
    """
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFC", text)
    low = text.lower()
    safe = len(low) == len(text) and "\u03a3" not in text and unicodedata.is_normalized("NFC", low)
    return low if safe else text


def stem_and_tail(word: str) -> tuple[str, str]:
    """A word without its closing marks, and these, where the splitter parts them.

    It parts letters from marks. One capital (U+0130) ends in a combining mark in lower case.
    """
    if word[-1] in MARKS:
        stem = word.rstrip(MARKS)
        if stem and stem[-1].lower()[-1].isalpha():
            return stem, word[len(stem) :]
    return word, ""


def words(text: str) -> list[str]:
    return WORD.findall(text) if ODD_SPACES.search(text) else text.split()


def steps(texts: list[str]) -> Iterator[list[str]]:
    """Lists of texts of a bounded length together, or of one text."""
    some, chars = [], 0
    for text in texts:
        if some and chars + len(text) > STEP_CHARS:
            yield some
            some, chars = [], 0
        some.append(text)
        chars += len(text)
    if some:
        yield some


def stretches(text: str) -> Iterator[str]:
    """Parts of about ``STEP_CHARS`` characters, cut at white space."""
    at = 0
    while len(text) - at > STEP_CHARS:
        space = SPACE.search(text, at + STEP_CHARS)
        if space is None:
            break
        yield text[at : space.start()]
        at = space.end()
    yield text[at:]


class Pieces:
    """Distinct texts with their ids, one after the other in one array."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.ends = np.zeros(1, np.int64)  # piece p has flat[ends[p] : ends[p + 1]]

    def add(self, texts: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        ends = self.ends[-1] + np.cumsum(sizes)
        if len(ends) and ends[-1] > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat), int(ends[-1])), np.uint32)])
        self.flat[self.ends[-1] : self.ends[-1] + len(ids)] = ids
        self.number.update(zip(texts, range(len(self.number), len(self.number) + len(texts))))
        self.ends = np.concatenate([self.ends, ends])

    def sizes(self, at: np.ndarray) -> np.ndarray:
        return self.ends[at + 1] - self.ends[at]

    def ids(self, at: np.ndarray) -> np.ndarray:
        sizes = self.sizes(at)
        before = np.cumsum(sizes) - sizes
        return self.flat[np.repeat(self.ends[at] - before, sizes) + np.arange(int(sizes.sum()))]


class WordIds:
    """Ids of texts by a tokenizer that never looks beyond white space."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # One id, which no text without the mark can have.
        (self.mark,) = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self._clear()

    def _clear(self) -> None:
        self.pieces = Pieces()

    def _tokenized(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words and how many each has. Words go in together with a mark between them that none of them holds."""
        if any(MARK in word for word in words):
            found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes
        parts = [" ".join([f"{w} {MARK}" for w in words[at : at + 500]]) for at in range(0, len(words), 500)]
        found = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]
        ids = np.concatenate([np.zeros(0, np.uint32), *found])
        ends = ids == self.mark
        return ids[~ends], np.diff(np.flatnonzero(ends), prepend=-1) - 1

    def _learn(self, words: list[str]) -> None:
        """New words; those with closing marks are put together from their stem and the marks."""
        pieces = self.pieces
        pairs = {w: stem_and_tail(w) for w in words if w[-1] in MARKS}
        pairs = {w: pair for w, pair in pairs.items() if pair[1]}
        new = list(set(words).difference(pairs).union(chain.from_iterable(pairs.values())).difference(pieces.number))
        marked = [w for w in new if MARK in w]
        new = list(set(new).difference(marked)) if marked else new
        for some in (new, marked):
            for at in range(0, len(some), 20_000):
                part = some[at : at + 20_000]
                pieces.add(part, *self._tokenized(part))
        parts = map(pieces.number.__getitem__, chain.from_iterable(pairs.values()))
        at = np.fromiter(parts, np.int64, 2 * len(pairs))
        pieces.add(list(pairs), pieces.ids(at), pieces.sizes(at).reshape(-1, 2).sum(1))

    def _ids(self, split: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of lists of words one after the other, and how many each list has."""
        new = set().union(*split).difference(self.pieces.number)
        if new and len(self.pieces.number) + len(new) > TABLE_WORDS:
            self._clear()
            new = set().union(*split)
        self._learn(list(new))
        counts = np.fromiter(map(len, split), np.int64, len(split))
        at = np.fromiter(map(self.pieces.number.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
        ends = np.concatenate([[0], np.cumsum(self.pieces.sizes(at))])
        return self.pieces.ids(at), np.diff(ends[np.concatenate([[0], np.cumsum(counts)])])

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text. Texts are taken together up to ``STEP_CHARS`` characters, longer ones in stretches."""
        for some in steps(texts):
            if len(some) == 1:
                yield np.concatenate([self._ids([words(part)])[0] for part in stretches(folded(some[0]))])
            else:
                ids, sizes = self._ids([words(folded(text)) for text in some])
                yield from np.split(ids, np.cumsum(sizes)[:-1])


_encoders: dict[str, WordIds] = {}


def encoder(path: str) -> WordIds:
    """One table per worker and vocabulary; tasks of one worker share it."""
    if path not in _encoders:
        _encoders[path] = WordIds(path)
    return _encoders[path]


def cut(ids: np.ndarray, size: int, closing_id: int, with_ids: bool) -> list[dict]:
    """Pieces of one document."""
    ids = np.append(ids, np.uint32(closing_id)).astype("<u4")
    pieces = []
    for number, start in enumerate(range(0, len(ids), size)):
        data = ids[start : start + size].tobytes()
        piece = {"piece": number, "start": start, "length": len(data) // 4, "ids_crc32": crc(data)}
        pieces.append(piece | ({"ids": data} if with_ids else {}))
    return pieces


def tokenized(text: Column, vocabulary: str, size: int = SEQUENCE, closing_id: int = CLOSING_ID, with_ids: bool = False) -> Column:
    """The pieces of a text as an array of structs; ``ids`` are little-endian 32-bit numbers."""
    fields = PIECE + (", ids binary" if with_ids else "")

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder(vocabulary).encode
        for batch in batches:
            out: list[list[dict]] = []
            for ids in encode(["" if t is None else t for t in batch]):
                out.append(cut(ids, size, closing_id, with_ids))
            yield pd.Series(out)

    return F.pandas_udf(run, f"array<struct<{fields.replace(' ', ':').replace(',:', ',')}>>").asNondeterministic()(text)


def sum_of_squares(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each length, in the order given, and the number of bins.

    With n bins of gap g and m of gap g - s, moving one adds 2 * (m - n) + 2 to the sum of
    squares, so all choices are compared with one subtraction over the gaps.
    """
    count = np.zeros(size + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(size + 1)]
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    made = 0
    never = np.int64(1) << 60
    for k, s in enumerate(lengths.tolist()):
        change = 2 * (count[: size - s] - count[s:size]) + 2
        change[:1] = 1 - 2 * count[s]
        change[count[s:size] == 0] = never
        rest = int(change.argmin()) if len(change) else 0
        if len(change) and change[rest] <= 2 * count[size - s] + 1:
            gap = s + rest
            number = open_bins[gap].pop()
            count[gap] -= 1
        else:
            gap, number, made = size, made, made + 1
            rest = size - s
        bins[k], offsets[k] = number, size - gap
        if rest:
            count[rest] += 1
            open_bins[rest].append(number)
    return bins, offsets, made


def pack_group(lengths: np.ndarray, uids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bins and offsets of one group; the result depends on the rows, not on their order."""
    mixed = (uids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)
    best = None
    for order in (np.lexsort((uids, mixed)), np.lexsort((uids, -lengths))):
        found = sum_of_squares(lengths[order], size)
        if best is None or found[2] < best[1][2]:
            best = order, found
    order, (bins, offsets, _) = best
    out = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
    out[0][order], out[1][order] = bins, offsets
    return out


def place(pieces: DataFrame, length_col: str = "length", size: int = SEQUENCE, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset`` (renamed if taken).

    Lengths must be 1 to ``size``. The pieces are written once.
    """
    packed = stored(
        pieces.select(
            F.struct(*[column(pieces, c) for c in pieces.columns]).alias("row"), column(pieces, length_col).alias("length"),
            F.monotonically_increasing_id().alias("uid"),
        ),
        "pieces",
    )
    part = packed.where(F.col("length") < size)
    groups = max(1, -(-part.count() // group_rows))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        bins, offsets = pack_group(rows["length"].to_numpy(np.int64), rows["uid"].to_numpy(np.int64), size)
        sequence = (rows["number"].to_numpy(np.int64) << 32) + bins
        return pd.DataFrame({"uid": rows["uid"], "sequence": sequence, "at": offsets})

    numbered = part.select("uid", "length", F.pmod(F.xxhash64("uid"), F.lit(groups)).alias("number"))
    found = numbered.groupBy("number").applyInPandas(pack, "uid long, sequence long, at long")
    sequence, offset = fresh_name(pieces, "sequence_id"), fresh_name(pieces, "offset")
    # Sequences that one piece fills have the negative numbers.
    joined = packed.join(found, "uid", "left")
    return joined.select(
        "row.*", F.coalesce("sequence", -1 - F.col("uid")).alias(sequence), F.coalesce("at", F.lit(0).cast("long")).alias(offset)
    )


def pack(
    docs: DataFrame, vocabulary: str, text_col: str = "text", size: int = SEQUENCE, closing_id: int = CLOSING_ID,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of ``docs``: its columns but the text, the piece, and its place."""
    others = [column(docs, c) for c in docs.columns if c != text_col]
    name = fresh_name(docs, "piece_")
    pieces = docs.select(*others, F.explode(tokenized(column(docs, text_col), vocabulary, size, closing_id, with_ids)).alias(name))
    fields = ["piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    flat = pieces.select(*others, *[F.col(name)[f].alias(fresh_name(docs, f)) for f in fields])
    return place(flat, fresh_name(docs, "length"), size)
