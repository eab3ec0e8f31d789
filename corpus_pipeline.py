"""A corpus pipeline over ``documents``: one operator of ``tidemark.llm`` per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import line_dedup, near_dedup, packing, quality_model, quality_rules
from tidemark.llm.common import fresh_name, reachable, stored
from tidemark.llm.queries import WORD_BPE, quality_labels, vocabulary

# The stages are more than SQL expresses (a trained model, a tokenizer).
ORACLE_SQL = None
RULES_MIN_WORDS = 5


def _texts_changed(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the threshold go."""
    reachable(spark)
    model = spark.sparkContext.broadcast(quality_model.fit(docs, quality_labels(spark, sf_dir)))
    name = fresh_name(docs, "score")
    scored = docs.withColumn(name, quality_model.score(F.col("text"), model))
    return scored.where(F.col(name) >= quality_model.THRESHOLD).drop(name)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail the quality rules go, and documents that the rules reject.

    The classifier has read the documents before, so short ones are not rejected for their length.
    """
    reachable(spark)
    return _texts_changed(quality_rules.clean(docs, min_words=RULES_MIN_WORDS))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that several documents hold stay in one of them; every document stays."""
    reachable(spark)
    columns = docs.columns
    return _texts_changed(line_dedup.drop_repeated(docs).select(*columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    reachable(spark)
    return near_dedup.drop_near(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in the sequences."""
    reachable(spark)
    return packing.pack(docs, vocabulary(WORD_BPE))


STAGES = [
    ("quality classifier", classifier),
    ("quality rules", rules),
    ("line dedup", lines),
    ("near dedup", near_duplicates),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on what the one before kept."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
