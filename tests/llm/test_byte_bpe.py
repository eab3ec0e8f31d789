"""Byte-level BPE against the library, and the round trip."""

import unicodedata

import numpy as np
import public_tokenizers
import regex
import tiktoken

from tidemark.llm import byte_bpe
from tidemark.llm.common import reachable

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = [
    None, "", " ", "  \n\n  x", "Hello, hello  hello's 123 ½ école 你好 😀‍😀", "a\x00b\x1c\x85c", "tab\tend 　 x",
    "newer letters \U00016ea0 Ᲊ ࢏", "x" * 3000, "word " * 4000, "<|endoftext|>", "힣́",
]


def library():
    ranks = byte_bpe.read_ranks(PATH)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_same_ids_and_round_trip(spark):
    rows = [(i, t, "n", None) for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], "again", None), (None, "null id", "n", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, block string")
    coded = byte_bpe.encode(docs.repartition(3), PATH, public_tokenizers.PATTERN)
    assert coded.columns == ["doc_id", "n_tokens", "block", "ids", "n_tokens_"]
    out = coded.select("*", byte_bpe.decode(coded.ids, PATH).alias("data")).collect()
    expected = {(i, n): t or "" for i, t, n, _ in rows}
    assert len(out) == len(rows)
    encode = library().encode_ordinary
    for r in out:
        text = expected[(r.doc_id, r.n_tokens)]
        assert np.frombuffer(r.ids, "<u4").tolist() == encode(text)
        assert r.n_tokens_ == len(encode(text)) and bytes(r.data) == text.encode()
    assert byte_bpe.encode(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_small_blocks(spark, monkeypatch):
    from tidemark.llm import blocks

    monkeypatch.setattr(blocks, "BLOCK_CHARS", 10)
    part = blocks.text_parts(__import__("pyarrow").RecordBatch.from_pydict({"text": ["a" * 4, "b" * 7, None, "c" * 30, "d"]}))
    assert [p.column("text").to_pylist() for p in part] == [["aaaa"], ["b" * 7, None], ["c" * 30], ["d"]]


def test_blocks_of_batches(monkeypatch):
    import pyarrow as pa

    from tidemark.llm import blocks

    monkeypatch.setattr(blocks, "BLOCK_CHARS", 10)
    batch = lambda *texts: pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    found = blocks.text_blocks(iter([batch("a" * 4, "é" * 5, None), batch(), batch("c" * 30), batch("d", "e" * 9, "f")]))
    assert [b.column("text").to_pylist() for b in found] == [["aaaa", "é" * 5, None], ["c" * 30], ["d", "e" * 9], ["f"]]
    assert list(blocks.text_blocks(iter([batch()]))) == []


def test_partitions_follow_the_input(spark, monkeypatch):
    from tidemark.llm import common

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert common.partitions(spark, docs) == common.partitions(spark) == 4
    monkeypatch.setattr(common, "PARTITION_BYTES", 100_000)
    assert 10 <= common.partitions(spark, docs) <= 20
    monkeypatch.setattr(common, "MOST_PARTITIONS", 6)
    assert common.partitions(spark, docs) == 6


def test_splits_agree_where_python_knows_the_characters():
    """Sampled code points; where the libraries differ, Python does not know the character."""
    ranks = {bytes([i]): i for i in range(256)}
    for kind in (r"\p{L}", r"\p{N}", r"\s"):
        theirs = tiktoken.Encoding("kind", pat_str=kind, mergeable_ranks=ranks, special_tokens={})
        ours = regex.compile(kind)
        for point in [*range(0, 0xD800), *range(0xE000, 0x110000, 7)]:
            char = chr(point)
            if bool(theirs.encode_ordinary(char)) != bool(ours.match(char)):
                assert unicodedata.category(char) == "Cn"
                assert not byte_bpe.Assigned()(char)


def test_workers_give_back_the_memory_of_a_batch(spark):
    reachable(spark)

    def kept(batches):
        import numpy as np
        import pyarrow as pa

        resident = lambda: int(open("/proc/self/statm").read().split()[1]) * 4096
        for _ in batches:
            large = np.ones(30_000_000, np.uint8)
            del large
            before = resident()
            again = np.ones(25_000_000, np.uint8)
            small = [bytes(100_000) for _ in range(3)]
            del again
            yield pa.RecordBatch.from_pydict({"kept": pa.array([resident() - before - len(small)], pa.int64())})

    assert spark.range(1).repartition(1).mapInArrow(kept, "kept long").first().kept < 5_000_000
