"""The registered queries, the pipeline, and the entry point without the subpackage."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__
import corpus_pipeline
from tidemark.llm.queries import QUERIES, SQL

ROOT = Path(__file__).resolve().parents[2]
SMALL = "/root/testdata/sf0.001"
NAMES = [
    "op1_quality_rules", "op2_packing", "op3_exact_dedup", "op4_quality_model", "op5_byte_bpe", "op6_token_counts",
    "op7_sharding", "op8_line_dedup", "op9_near_dedup", "op10_lm_scoring", "op11_spelling",
    "op12_lexical_search", "op13_warc",
]


def test_registered():
    assert sorted(QUERIES) == sorted(NAMES)
    assert set(SQL) <= set(QUERIES) and set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "quality rules", "line dedup", "near dedup", "packing"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, name):
    import duckdb

    with duckdb.connect() as con:
        for table in ("documents", "pages", "benchmark"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
        cursor = con.execute(SQL[name])
        names, expected = [d[0] for d in cursor.description], cursor.fetchall()
    found = QUERIES[name](spark, SMALL)
    assert sorted(found.columns) == sorted(names)

    def rows(columns, values):
        order = [columns.index(c) for c in sorted(columns)]
        return sorted(repr([row[i] for i in order]) for row in values)

    assert rows(found.columns, found.collect()) == rows(names, expected)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = spark.createDataFrame(stage(spark, kept, SMALL).toPandas(), docs.schema)
        assert kept.columns == columns
    assert 0 < kept.count() < docs.count()
    good = {r.doc_id for r in spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 1").collect()}
    first = {r.doc_id for r in corpus_pipeline.classifier(spark, docs, SMALL).collect()}
    assert len(good & first) >= 0.97 * len(good & {r.doc_id for r in docs.collect()})
    out = corpus_pipeline.run(spark, SMALL)
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in kept.collect()}


@pytest.mark.parametrize("missing", ["corpus_pipeline", "tidemark.llm"])
def test_entry_without_the_subpackage(missing):
    code = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path, target=None):\n"
        f"        if name == {missing!r}: raise ModuleNotFoundError('gone', name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and not [q for q in e.queries() if q.startswith('op') or q == 'pipeline']\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
