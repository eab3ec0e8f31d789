"""Exact duplicates by distributed MSD radix partitioning.

Documents are split by successive blocks of their bytes, most significant first, until a
group has one member or its texts have ended; texts are compared as bytes, never as
digests. The first digit is the length in bytes with the first 64 bytes, so members of a
group end together; each later block is 64 times as long as the one before, so a text of
L bytes needs about log64(L) rounds, and only rows that still have partners take part in
the next round and carry the rest of their text.

A round is a group-by on (group, block), which combines copies before the shuffle, and a
join back to the rows. The join has the length as one more key than the group-by, so both
sides are shuffled for it and Spark can split a partition that a huge group of copies fills.
Each round is written to the shared folder.

Texts are equal when identical after each run of ASCII white space is replaced by one
space; null counts as empty. Of equal texts the row with the smallest id stays; a null id
comes after all others, and of rows that repeat an id exactly one stays. Other columns are
carried by ``drop_copies`` whatever their names are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, stored

FIRST_BLOCK, FACTOR = 64, 64
RESULT = ["id", "row", "sha", "keep_id", "group_size", "kept"]


def normalised(text: Column) -> Column:
    """The text with each run of white space as one space; single spaces are left alone."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def _rows(docs: DataFrame, id_col: str, text_col: str, carry: bool) -> DataFrame:
    body = normalised(column(docs, text_col)).cast("binary")
    row = F.struct(*[column(docs, c) for c in docs.columns]) if carry else F.lit(None).cast("string")
    rows = docs.select(column(docs, id_col).alias("id"), row.alias("row"), body.alias("body"))
    return rows.withColumn("size", F.octet_length("body")).withColumn("block", F.substring("body", 1, FIRST_BLOCK))


def _classes(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per group that has several members."""
    return (
        rows.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("uid").alias("gid_next"),
            F.min("id").alias("keep_id"),
            F.min_by("uid", "id").alias("keep_uid"),
            F.min("size").alias("size_again"),
        )
        .where("n > 1")
    )


def _split(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the figures of their group; null where a row is alone."""
    groups = groups.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in groups.columns if c not in keys])
    on = [F.col(k) == F.col(f"_{k}") for k in keys] + [F.col("size") == F.col("size_again")]
    return rows.join(groups, reduce(lambda a, b: a & b, on), "left")


def _finished(rows: DataFrame) -> DataFrame:
    """Rows whose group is known: they are alone, or their group's texts have ended."""
    kept = F.col("n").isNull() | (F.col("uid") == F.coalesce("keep_uid", "gid_next"))
    return rows.where("n IS NULL OR body IS NULL").select(
        "id", "row", "sha", F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"), kept.alias("kept"),
    )


def mark(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """One row per document: id, row, sha, keep_id, group_size, kept.

    ``sha`` is the SHA-256 of the normalised text; ``row`` holds all columns if ``carry``.
    """
    rows = _rows(docs, id_col, text_col, carry)
    heads = (
        rows.groupBy("size", "block").agg(F.count(F.lit(1)).alias("n"), F.min("size").alias("size_again")).where("n > 1")
    )
    first = _split(rows, heads, ["size", "block"]).select(
        F.monotonically_increasing_id().alias("uid"), "id", "row", F.sha2("body", 256).alias("sha"), "size",
        F.col("block").alias("gid"), "n",
        F.when(F.col("n") > 1, F.expr(f"substring(body, {FIRST_BLOCK + 1})")).alias("body"),
    )
    # Rows that are alone drop their text here; groups get a number in the next round.
    alive = stored(first, "radix-0")
    alone = F.col("n").isNull()
    done = [
        alive.where(alone).select(
            "id", "row", "sha", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
            F.lit(True).alias("kept"),
        )
    ]
    longest = alive.where(~alone).agg(F.max("size")).first()[0]
    alive = alive.where(~alone).drop("n")
    at, length, keys = FIRST_BLOCK, FIRST_BLOCK * FACTOR, ["size", "gid", "block"]
    while longest is not None:
        cut = alive.withColumn("block", F.substring("body", 1, length))
        rest = F.when((F.col("n") > 1) & (F.col("size") > at + length), F.expr(f"substring(body, {length + 1})"))
        split = _split(cut, _classes(cut, keys), keys).select(
            "uid", "id", "row", "sha", "size", F.col("gid_next").alias("gid"), "n", "keep_id", "keep_uid", "gid_next",
            rest.alias("body"),
        )
        split = stored(split, f"radix-{at}")
        done.append(_finished(split))
        at, length, keys = at + length, length * FACTOR, ["gid", "block"]
        if longest <= at:
            break
        alive = split.where("body IS NOT NULL").select("uid", "id", "row", "sha", "size", "gid", "body")
    return reduce(DataFrame.unionByName, [d.select(*RESULT) for d in done])


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts."""
    return mark(docs, id_col, text_col, carry=True).where("kept").select("row.*")
