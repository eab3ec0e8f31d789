"""Byte-level BPE by a global shuffle of distinct words, and decoding by the token table.

1. Texts are split into pre-tokens. Documents are taken in blocks of a bounded size; each
   block numbers its distinct words, and every document becomes the list of those numbers
   in order, so a word's positions are the places of its number.
2. The words of all blocks are dealt out by a hash of their bytes, as one compressed list per
   block and bucket. A bucket sees every occurrence of its words and encodes each distinct
   word once (its table starts anew if it grows beyond a bound).
3. The ids go back to the blocks, and each document's ids are put together by position.

A frequent word appears once per block, so no word is hot; blocks and tables have fixed
bounds; the texts are read once. Splits are made with the same rules as the tokenizer's
own; where the two libraries may know different Unicode versions (a text with a code point
that Python does not know), the whole text counts as one word and the tokenizer splits it.

Null and empty texts have no ids. Repeated rows and ids are encoded like any others, and
other columns are carried; names of added columns are changed if taken.
"""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Callable
from functools import lru_cache
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.blocks import by_number, numbered_once, pack_numbers, unpack_numbers, unpack_words
from tidemark.llm.common import column, fresh_name

TABLE_WORDS = 2_000_000


class Assigned:
    """Whether Python's Unicode tables assign all code points of a text; each is looked up once."""

    def __init__(self) -> None:
        self.known: set[str] = set()
        self.unknown: set[str] = set()

    def __call__(self, text: str) -> bool:
        points = set(text)
        for point in points.difference(self.known, self.unknown):
            (self.unknown if unicodedata.category(point) == "Cn" else self.known).add(point)
        return not self.unknown or points.isdisjoint(self.unknown)


def splitter(pattern: str) -> Callable[[str], list[str]]:
    import regex

    find, assigned = regex.compile(pattern).findall, Assigned()

    def split(text: str) -> list[str]:
        return find(text) if text.isascii() or assigned(text) else [text]

    return split


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class WordEncoder:
    """Ids of words, each distinct one encoded once."""

    def __init__(self, ranks_path: str, pattern: str):
        import tiktoken

        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(ranks_path), special_tokens={})
        self.encode = encoding.encode_ordinary
        self.table: dict[bytes, np.ndarray] = {}

    def ids(self, word: bytes) -> np.ndarray:
        found = self.table.get(word)
        if found is None:
            if len(self.table) >= TABLE_WORDS:
                self.table.clear()
            found = self.table[word] = np.array(self.encode(word.decode()), "<u4")
        return found


def _encode_words(ranks_path: str, pattern: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (block, numbers, sizes, ids) from lists of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(ranks_path, pattern)
        for batch in batches:
            sizes, ids = [], []
            for data in batch.column("words").to_pylist():
                found = [encoder.ids(w) for w in unpack_words(data)]
                sizes.append(pack_numbers(np.fromiter(map(len, found), np.int64, len(found))))
                ids.append(pack_numbers(np.concatenate(found)))
            columns = [batch.column("block"), batch.column("numbers"), pa.array(sizes, pa.binary()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["block", "numbers", "sizes", "ids"])

    return run


def _reassemble(docs: pa.Table, words: pa.Table) -> pa.Table:
    """The ids of each document of one block; the rows of its lists are left out."""
    docs = docs.filter(pc.less(docs.column("bucket"), 0))
    places = words.column("numbers").to_pylist()
    sizes = [unpack_numbers(s).astype(np.int64) for s in words.column("sizes").to_pylist()]
    ids = [unpack_numbers(i) for i in words.column("ids").to_pylist()]
    flat = np.concatenate(ids) if ids else np.zeros(0, "<u4")
    # Word by number: how many ids it has, and where they start among all ids.
    size = by_number(places, sizes).astype(np.int64)
    ends = np.cumsum(np.concatenate(sizes)) if sizes else np.zeros(0, np.int64)
    starts = np.split(ends, np.cumsum([len(s) for s in sizes])[:-1]) if sizes else []
    start = by_number(places, starts).astype(np.int64) - size
    out = []
    for data in docs.column("numbers").to_pylist():
        numbers = unpack_numbers(data).astype(np.int64)
        many = size[numbers]
        before = np.cumsum(many) - many
        out.append(flat[np.repeat(start[numbers] - before, many) + np.arange(int(many.sum()))].astype("<u4").tobytes())
    return pa.table({"row": docs.column("row"), "ids": pa.array(out, pa.binary())})


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", ids_col: str = "ids", count_col: str = "n_tokens"
) -> DataFrame:
    """``docs`` without their text, with their ids (little-endian 32-bit numbers) and how many."""
    others = [column(docs, c).alias(c) for c in docs.columns if c != text_col]
    row = F.struct(*others) if others else F.struct(F.lit(0).alias("_"))
    source = docs.select(row.alias("row"), F.coalesce(column(docs, text_col), F.lit("")).alias("text"), F.lit(False).alias("counts"))
    coded, lists = numbered_once(source, lambda: splitter(pattern))
    words = lists.select("block", "numbers", "words").mapInArrow(
        _encode_words(ranks_path, pattern), "block long, numbers binary, sizes binary, ids binary"
    )
    joined = coded.groupBy("block").cogroup(words.groupBy("block")).applyInArrow(
        _reassemble, f"row {source.schema['row'].dataType.simpleString()}, ids binary"
    )
    ids, count = fresh_name(docs, ids_col), fresh_name(docs, count_col)
    flat = [F.col("row")[c].alias(c) for c in docs.columns if c != text_col]
    return joined.select(*flat, F.col("ids").alias(ids), F.expr("octet_length(ids) div 4").alias(count))


@lru_cache(maxsize=4)
def token_bytes(ranks_path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each token's bytes start, how many they are, and the bytes of all tokens."""
    ranks = read_ranks(ranks_path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    return np.cumsum(sizes) - sizes, sizes, np.frombuffer(b"".join(tokens), np.uint8)


def decode_ids(data: bytes, ranks_path: str) -> bytes:
    starts, sizes, flat = token_bytes(ranks_path)
    ids = np.frombuffer(data, "<u4").astype(np.int64)
    many = sizes[ids]
    before = np.cumsum(many) - many
    return flat[np.repeat(starts[ids] - before, many) + np.arange(int(many.sum()))].tobytes()


def decode(ids: Column, ranks_path: str) -> Column:
    """The bytes of a column of ids; null stays null."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([None if d is None else decode_ids(d, ranks_path) for d in batch], dtype=object)

    return F.pandas_udf(run, "binary").asNondeterministic()(ids)
