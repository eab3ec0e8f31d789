"""Documents in blocks, words in buckets: how per-word work is done once per distinct word.

A block is a bounded stretch of one task's documents. It numbers its distinct words, and each
document becomes the list of its words' numbers. The words are dealt out to buckets by a
hash of their bytes, as one packed list per block and bucket, so a word that every document
holds is sent once per block. Buckets see all occurrences of their words; what they find out
goes back to the blocks, which put it together by number.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidemark.llm.common import partitions

BLOCK_CHARS = 16_000_000
BUCKETS_PER_PARTITION = 4
SEPARATOR = b"\xff"  # never part of UTF-8
LIST = ["bucket", "block", "words", "counts", "numbers"]


def pack_numbers(numbers: np.ndarray) -> bytes:
    """32-bit numbers, byte plane by byte plane, compressed."""
    return zlib.compress(np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def unpack_numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def pack_words(words: list[bytes]) -> bytes:
    return zlib.compress(SEPARATOR.join(words), 1)


def unpack_words(data: bytes) -> list[bytes]:
    return zlib.decompress(data).split(SEPARATOR)


def text_parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with a bounded number of characters (or one row)."""
    start = chars = 0
    for row, text in enumerate(batch.column("text")):
        size = len(text.as_py() or "")
        if row > start and chars + size > BLOCK_CHARS:
            yield batch.slice(start, row - start)
            start, chars = row, 0
        chars += size
    yield batch.slice(start)


def text_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents with a bounded number of characters (or one row).

    A block never spans Arrow batches: holding several of them took an executor's memory
    beyond its limit.
    """
    for batch in batches:
        if len(batch):
            yield from text_parts(batch)


def _number(make_split: Callable[[], Callable[[str], list[str]]], buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = make_split()
        block = TaskContext.get().partitionId() << 32
        for part in text_blocks(batches):
            number: dict[str, int] = {}
            coded = []
            for text in part.column("text"):
                words = split(text.as_py() or "")
                for word in dict.fromkeys(words):  # in their order: a repeated task numbers alike
                    number.setdefault(word, len(number))
                coded.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
            counted = np.zeros(len(number), np.int64)
            for numbers, counts in zip(coded, part.column("counts").to_pylist()):
                if counts:
                    np.add.at(counted, numbers, 1)
            lists: list[tuple[list[bytes], list[int]]] = [([], []) for _ in range(buckets)]
            for word, place in number.items():
                data = word.encode()
                words, places = lists[zlib.crc32(data) % buckets]
                words.append(data)
                places.append(place)
            filled = [k for k, (words, _) in enumerate(lists) if words]
            places = [np.array(lists[k][1], np.int64) for k in filled]
            none, rest = pa.nulls(len(part), pa.binary()), pa.nulls(len(filled), part.column("row").type)
            yield pa.RecordBatch.from_pydict({
                "row": pa.concat_arrays([part.column("row"), rest]),
                "block": pa.array([block] * (len(part) + len(filled)), pa.int64()),
                "bucket": pa.array([-1] * len(part) + filled, pa.int32()),
                "numbers": pa.array([pack_numbers(c) for c in coded] + [pack_numbers(np.diff(p, prepend=0)) for p in places], pa.binary()),
                "counts": pa.concat_arrays([none, pa.array([pack_numbers(counted[p]) for p in places], pa.binary())]),
                "words": pa.concat_arrays([none, pa.array([pack_words(lists[k][0]) for k in filled], pa.binary())]),
            })
            block += 1

    return run


def _schema(rows: DataFrame) -> str:
    kind = rows.schema["row"].dataType.simpleString()
    return f"row {kind}, block long, bucket int, numbers binary, counts binary, words binary"


def _lists_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pc.greater_equal(batch.column("bucket"), 0)).select(LIST)


def numbered_once(rows: DataFrame, make_split: Callable[[], Callable[[str], list[str]]]) -> tuple[DataFrame, DataFrame]:
    """Documents as numbers, and lists of words dealt out by bucket, for a query that joins both.

    ``rows`` has row, text and counts (whether the text's words are counted). The first
    result has block, row and numbers; the second, in bucket order, bucket, block, words,
    counts and numbers (the words' numbers, as differences).

    One shuffle by block serves both, and nothing is stored. The first result also has the
    lists' rows (bucket 0 or more), because a filter or a column less would be moved below
    the shuffle, and there would be two.
    """
    count = partitions(rows.sparkSession, rows)
    shared = rows.mapInArrow(_number(make_split, BUCKETS_PER_PARTITION * count), _schema(rows)).repartition(count, "block")
    lists = shared.mapInArrow(_lists_only, "bucket int, block long, words binary, counts binary, numbers binary")
    return shared, lists.repartition(count, "bucket").sortWithinPartitions("bucket")


def by_number(places: list[bytes], values: list[np.ndarray]) -> np.ndarray:
    """What several buckets found out about a block's words, in the order of their numbers."""
    if not places:
        return np.zeros(0)
    out = np.zeros(sum(map(len, values)), values[0].dtype)
    out[np.concatenate([np.cumsum(unpack_numbers(p), dtype=np.int64) for p in places])] = np.concatenate(values)
    return out
