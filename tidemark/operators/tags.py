"""Tags (alias, entry_type, tag), find, and name search by prefix or suffix."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.errors import InvalidArgument
from tidemark.session import small_side


def find(tags: DataFrame, all_of: list[str] | None = None, entry_type: str | None = None) -> DataFrame:
    """Aliases that carry every tag and have the given type."""
    all_of = list(all_of or [])
    if not all_of and entry_type is None:
        raise InvalidArgument("find needs a tag or a type")
    rows = tags if entry_type is None else tags.where(F.col("entry_type") == entry_type)
    if not all_of:
        return rows.select("alias").distinct()
    rows = rows.where(F.col("tag").isin(all_of))
    if len(set(all_of)) == 1:
        return rows.select("alias").distinct()
    # One flag per tag: combined before the shuffle, so a hot tag costs nothing extra.
    flags = [F.bool_or(F.col("tag") == tag).alias(f"_f{i}") for i, tag in enumerate(all_of)]
    hit = reduce(Column.__and__, [F.col(f"_f{i}") for i in range(len(all_of))])
    return rows.groupBy("alias").agg(*flags).where(hit).select("alias")


def intersect(tags: DataFrame, first: str, second: str) -> DataFrame:
    """Aliases that carry both tags, as a set operation."""
    carry = lambda tag: tags.where(F.col("tag") == tag).select("alias")
    return carry(first).intersect(carry(second))


def _held(tags: DataFrame, keys: DataFrame) -> DataFrame:
    """Distinct (alias, tag) of the tags that agree with a row of ``keys`` in all its columns."""
    side, rows = small_side(keys.distinct())
    if rows is not None:
        return tags.join(F.broadcast(side), keys.columns, "left_semi").select("alias", "tag").distinct()
    # A semi join would be moved below the unions and group-bys that make the tags, and all
    # rows behind a frequent alias would meet in one task before they are combined.
    return tags.select("alias", "tag").distinct().join(side, keys.columns).select("alias", "tag")


def _without(tags: DataFrame, keys: DataFrame) -> DataFrame:
    """The tags that agree with no row of ``keys``."""
    side, rows = small_side(keys.distinct())
    if rows is not None:
        return tags.join(F.broadcast(side), keys.columns, "left_anti").select(*tags.columns)
    marked = tags.join(side.withColumn("_held", F.lit(True)), keys.columns, "left")  # as above, not an anti join
    return marked.where("_held IS NULL").select(*tags.columns)


def _judged(tags: DataFrame, asked: DataFrame) -> DataFrame:
    """Requests with ``_held``. Only tags that are asked for are looked at any further."""
    held = _held(tags, asked.select("alias", "tag"))
    return asked.join(held.withColumn("_held", F.lit(True)), ["alias", "tag"], "left")


def attach(tags: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Add (alias, tag) pairs; returns the new tags and each request with ``changed``."""
    judged = _judged(tags, requests.select("alias", "entry_type", "tag").dropDuplicates(["alias", "tag"]))
    added = judged.where("_held IS NULL").select(*tags.columns)
    outcome = judged.select("alias", "tag", F.col("_held").isNull().alias("changed"))
    return tags.unionByName(added), outcome


def detach(tags: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Remove (alias, tag) pairs; returns the new tags and each request with ``changed``."""
    asked = small_side(requests.select("alias", "tag").distinct())[0]  # evaluated once
    outcome = _judged(tags, asked).select("alias", "tag", F.col("_held").isNotNull().alias("changed"))
    return _without(tags, asked), outcome


def has_tag(tags: DataFrame, requests: DataFrame) -> DataFrame:
    """Each (alias, tag) request with whether it is set."""
    return _judged(tags, requests.select("alias", "tag")).select(
        "alias", "tag", F.col("_held").isNotNull().alias("has_tag")
    )


def tags_of(tags: DataFrame, aliases: DataFrame) -> DataFrame:
    """Tags of the given aliases, one row each (an entry may carry very many)."""
    return _held(tags, aliases.select("alias"))


def entries_of(tags: DataFrame, tag: str) -> DataFrame:
    """Entries of one tag."""
    return tags.where(F.col("tag") == tag).select("alias", "entry_type").distinct()


def tag_counts(tags: DataFrame) -> DataFrame:
    """Number of entries per tag."""
    return tags.dropDuplicates(["alias", "tag"]).groupBy("tag").agg(F.count("*").alias("entries"))


def by_affix(
    names: DataFrame,
    prefix: str | None = None,
    suffix: str | None = None,
    limit: int | None = None,
    alias: str = "alias",
) -> DataFrame:
    """Names with a prefix and/or suffix; with ``limit`` the first ones in name order."""
    rows = names
    if prefix is not None:
        rows = rows.where(F.col(alias).startswith(prefix))
    if suffix is not None:
        rows = rows.where(F.col(alias).endswith(suffix))
    return rows if limit is None else rows.orderBy(alias).limit(limit)


def count_affix(names: DataFrame, prefix=None, suffix=None, alias: str = "alias") -> DataFrame:
    """One row: how many names match (0 if none)."""
    return by_affix(names, prefix, suffix, alias=alias).agg(F.count("*").alias("matches"))
