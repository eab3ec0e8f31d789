"""Repeated lines, found with a sharded minimal perfect hash over line hashes.

A line's key is the line stripped of white space at both ends, with A-Z in lower case. Keys
that are long enough and stand in enough documents lose all their lines except in the
document with the largest id.

Each line is hashed to 128 bits. Counts and the largest id per hash come from a group-by,
which combines before the shuffle. The hashes of repeated lines are split into shards of a
bounded size, and each shard becomes one compact table: a minimal perfect hash over the
first half of the hashes, and behind it arrays of the second halves (the fingerprints),
the document counts and the largest ids. Documents then send (hash, place) to the shards,
where the stream of probes passes the arrays. Every table goes to several salts, as many as
its lines' known counts ask for, and a document's salt picks one, so a line that a third of
all documents hold meets ever more tasks as documents grow; nothing is gathered there,
whatever the number of probes. Places to drop return to their
document, which is found by its id and a hash of its text, so rows need no stored number.

A null text is empty and has one empty line; a text whose lines all go becomes empty, and
its row stays. A null id counts as the smallest. Rows that repeat an id and text count as
documents of their own and are treated alike; of rows with the largest id all keep the line.
Other columns are carried along; names of added columns are changed if taken.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, column, fresh_name, lower_ascii, partitions, stored
from tidemark.llm.perfect_hash import PerfectHash

MIN_CHARS, MIN_DOCS = 20, 3
SHARD_KEYS, LEAST_SHARDS = 50_000, 32
LEAST_SALTS, SALT_PROBES = 8, 100_000
SMALLEST = -(1 << 63)


def line_hashes(text: str | None, min_chars: int) -> tuple[bytes, list[int]]:
    """The 16-byte hashes of the lines that are long enough, one after the other, and their places."""
    hashes, places = [], []
    for place, line in enumerate(lower_ascii(text or "").split("\n")):
        key = line.strip(SPACES)
        if len(key) >= min_chars:
            hashes.append(xxhash.xxh3_128_digest(key.encode()))
            places.append(place)
    return b"".join(hashes), places


def _lines(min_chars: int, distinct: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (id, th, size, h1, h2, place); with ``distinct`` one per document and key, without th and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 1000):
                batch = whole.slice(at, 1000)
                data, places, counts = [], [], []
                for text in batch.column("text").to_pylist():
                    found, where = line_hashes(text, min_chars)
                    if distinct and len(where) > 1:
                        unique = {found[i : i + 16] for i in range(0, len(found), 16)}
                        found, where = b"".join(sorted(unique)), [0] * len(unique)
                    data.append(found)
                    places += where
                    counts.append(len(where))
                halves = np.frombuffer(b"".join(data), "<i8").reshape(-1, 2)
                row = np.repeat(np.arange(len(batch)), counts)
                columns = {name: batch.column(name).take(pa.array(row)) for name in batch.schema.names if name != "text"}
                columns |= {"h1": pa.array(halves[:, 0].copy()), "h2": pa.array(halves[:, 1].copy())}
                if not distinct:
                    columns["place"] = pa.array(places, pa.int32())
                yield pa.RecordBatch.from_pydict(columns)

    return run


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    keys = rows["h1"].to_numpy(np.int64).view(np.uint64)
    table = PerfectHash.build(keys)
    where = table.order(keys)
    arrays = {}
    for name, source in (("fingerprint", "h2"), ("count", "n"), ("keeper", "keeper")):
        arrays[name] = np.zeros(len(keys), np.int64)
        arrays[name][where] = rows[source].to_numpy(np.int64)
    arrays["count"] = arrays["count"].astype(np.uint32 if arrays["count"].max() < 1 << 32 else np.uint64)
    return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "table": [table.dump(**arrays)]})


def _probe(table: PerfectHash, arrays: dict[str, np.ndarray], h1: np.ndarray, h2: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which of the probed lines are repeated and kept elsewhere."""
    where = table.index(h1.view(np.uint64))
    known = where >= 0
    found = np.where(known, where, 0)
    drop = known & (arrays["fingerprint"][found] == h2) & (arrays["keeper"][found] != ids)
    for number, key in enumerate(table.rest.view(np.int64).tolist()):  # equal first halves: almost never
        at = table.placed + number
        drop |= (h1 == key) & (arrays["fingerprint"][at] == h2) & (arrays["keeper"][at] != ids)
    return drop


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows, each shard's table before its probes; yields the lines to drop."""
    table = arrays = None
    own = -1, -1
    for batch in batches:
        is_table = np.flatnonzero(batch.column("kind").to_numpy(zero_copy_only=False) == 0).tolist()
        for start, end in zip([-1, *is_table], [*is_table, len(batch)]):
            if start >= 0:
                table, arrays = PerfectHash.load(batch.column("table")[start].as_py())
                own = batch.column("shard")[start].as_py(), batch.column("salt")[start].as_py()
            part = batch.slice(start + 1, end - start - 1)
            if table is None or not len(part):
                continue
            shard, salt, h1, h2, ids = (
                part.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("shard", "salt", "h1", "h2", "id")
            )
            # A shard without repeated lines has no table, and its probes find nothing.
            part = part.filter(pa.array((shard == own[0]) & (salt == own[1]) & _probe(table, arrays, h1, h2, ids)))
            yield pa.RecordBatch.from_arrays([part.column(c) for c in ("id", "th", "size", "place")], ["id", "th", "size", "place"])


def _without(texts: pd.Series, places: pd.Series) -> pd.DataFrame:
    out = []
    for text, drop in zip(texts, places):
        if text is None:
            out.append((None, 0))
            continue
        gone = set(drop.tolist())
        out.append(("\n".join([line for i, line in enumerate(text.split("\n")) if i not in gone]), len(gone)))
    return pd.DataFrame(out, columns=["text", "n_dropped"])


def repeated_places(docs: DataFrame, identity: list[Column], text: Column, min_chars: int, min_docs: int) -> DataFrame:
    """Per document with lines to drop: id, th, size, places."""
    spark = docs.sparkSession
    id_, th, size = identity
    source = docs.select(id_.alias("id"), th.alias("th"), size.alias("size"), text.alias("text"))
    counted = source.select("id", "text").mapInArrow(_lines(min_chars, True), "id long, h1 long, h2 long")
    repeated = stored(
        counted.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("keeper")).where(F.col("n") >= min_docs),
        "repeated-lines",
    )
    shards = max(LEAST_SHARDS, -(-repeated.count() // SHARD_KEYS))
    shard = F.pmod(F.xxhash64("h1"), F.lit(shards)).alias("shard")
    tables = repeated.select("*", shard).groupBy("shard").applyInPandas(_build, "shard long, table binary")
    # A short row per shard. Repeated lines in one text are one probe here and several later: salts are a little few.
    least = F.lit(LEAST_SALTS).cast("long")
    salted = stored(
        repeated.groupBy(shard).agg(F.greatest(least, F.expr(f"sum(n) div {SALT_PROBES}")).alias("salts")), "line-salts"
    )
    # Tables are written once: their copies then come from a plain read.
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))
    sent = stored(tables, "line-tables").join(F.broadcast(salted), "shard").select(
        "shard", copies.alias("salt"), F.lit(0).alias("kind"), "table"
    )
    probes = source.mapInArrow(_lines(min_chars, False), "id long, th long, size int, h1 long, h2 long, place int")
    salt = F.pmod(F.xxhash64("id", "th"), F.coalesce("salts", least))
    probes = probes.select("*", shard).join(F.broadcast(salted), "shard", "left").select(
        *probes.columns, "shard", salt.alias("salt"), F.lit(1).alias("kind")
    )
    both = sent.unionByName(probes, allowMissingColumns=True)
    streamed = both.repartition(partitions(spark), "shard", "salt").sortWithinPartitions("shard", "salt", "kind")
    dropped = streamed.mapInArrow(_stream, "id long, th long, size int, place int")
    return dropped.groupBy("id", "th").agg(F.min("size").alias("size"), F.collect_set("place").alias("places"))


def drop_repeated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
    lines_col: str = "n_lines", dropped_col: str = "n_dropped",
) -> DataFrame:
    """``docs`` without repeated lines, with the number of lines before and of those dropped.

    Ids are whole numbers. Null texts become empty.
    """
    text = F.coalesce(column(docs, text_col), F.lit(""))
    # The size is one key more than the group-by of the other side has, so that both sides
    # are shuffled for the join and Spark can split what is hot.
    identity = [F.coalesce(column(docs, id_col).cast("long"), F.lit(SMALLEST)), F.xxhash64(text), F.length(text)]
    found = repeated_places(docs, identity, text, min_chars, min_docs)
    others = [column(docs, c) for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*others).alias("row"), text.alias("text"), *[
        c.alias(n) for c, n in zip(identity, ("id", "th", "size"))
    ])
    joined = rows.join(found, ["id", "th", "size"], "left")
    without = F.pandas_udf(_without, "text string, n_dropped long").asNondeterministic()
    joined = joined.withColumn("cut", without(F.when(F.col("places").isNotNull(), F.col("text")), "places"))
    lines, dropped = fresh_name(docs, lines_col), fresh_name(docs, dropped_col)
    out = joined.select(
        *[
            F.coalesce("cut.text", "text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns
        ],
        F.size(F.split("text", "\n", -1)).cast("long").alias(lines), F.col("cut.n_dropped").alias(dropped),
    )
    return out
