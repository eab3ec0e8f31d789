"""What several operators of this subpackage share."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

# ASCII white space separates words; every other code point belongs to one.
SPACE_CLASS = r"\x20\x09-\x0D"
WORD = re.compile(rf"[^{SPACE_CLASS}]+")
SPACES = " \t\n\x0b\x0c\r"
# Input bytes for each partition of a shuffle that no one merges or splits later, and most of them.
PARTITION_BYTES, MOST_PARTITIONS = 64_000_000, 8_192
# Python workers live on from task to task; with these they give back what a batch took.
WORKER_MEMORY = {
    "ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2", "MALLOC_MMAP_THRESHOLD_": "4194304",
    "MALLOC_TRIM_THRESHOLD_": "8388608",
}


def lower_ascii(text: str) -> str:
    """``text`` with A-Z in lower case and everything else untouched, as bytes do it."""
    return text.lower() if text.isascii() else text.encode().lower().decode()


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that no column of ``df`` has (names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def column(df: DataFrame, name: str) -> Column:
    """The column called ``name``, whatever characters the name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read from there.

    Later steps then agree on its rows whatever is lost meanwhile, and lineage ends here.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def reachable(spark: SparkSession) -> None:
    """Let Python workers look for this package where the driver found it.

    Enough where they share a file system with the driver, or have the package installed.
    Workers also get memory settings, unless the session has its own.
    """
    root = str(Path(__file__).resolve().parents[2])
    settings = spark.sparkContext.environment
    paths = [p for p in settings.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        settings["PYTHONPATH"] = os.pathsep.join([root, *paths])
    for name, value in WORKER_MEMORY.items():
        settings.setdefault(name, value)


def partitions(spark: SparkSession, source: DataFrame | None = None) -> int:
    """How many partitions to shuffle to: as many as the session says, or more if ``source`` is large."""
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if source is None:
        return count
    try:
        expected = int(source._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except ValueError:  # a product of sizes with too many digits: the planner does not know
        return count
    return count if expected >= 1 << 60 else max(count, min(MOST_PARTITIONS, -(-expected // PARTITION_BYTES)))


def id_bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def crc(data: bytes) -> int:
    return zlib.crc32(data)


def texts(batch: Iterable[str | None]) -> list[str]:
    """Null texts as empty ones."""
    return ["" if t is None else t for t in batch]
