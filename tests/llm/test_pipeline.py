"""Every stage of the pipeline on awkward tables, and the whole against brute force."""

import os

import cases
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from scoreloom.llm import packing

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def documents(spark, rows):
    df = spark.createDataFrame(rows, cases.SCHEMA)
    return df.selectExpr("*", "CASE WHEN doc_id <> 9 THEN 'en' END AS lang", "'s' AS source", "bigint(length(text)) AS n_chars")


@pytest.fixture
def folder(spark, tmp_path):
    spark.createDataFrame([(1, " ".join(cases.texts(40)[12][1].split(" ")[:30])), (2, "zz yy xx")], "item_id long, text string").write.parquet(os.path.join(tmp_path, "benchmark.parquet"))
    return str(tmp_path)


@pytest.mark.parametrize("rows", ["awkward", "empty"])
def test_stages(spark, folder, rows):
    docs = documents(spark, cases.DOCS if rows == "awkward" else [])
    for name, stage in cp.STAGES:
        before = docs.count()
        extra = stage(spark, docs.selectExpr("*", "'x' AS key", "1 AS n", "2 AS score"), folder)
        out = stage(spark, docs, folder)
        if name != "packing":
            assert out.columns == COLUMNS and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
            assert set(extra.columns) == {*COLUMNS, "key", "n", "score"}
            assert out.count() == extra.count() <= before
        docs = out
    if rows == "empty":
        assert docs.count() == 0


def test_language_stage(spark, folder):
    out = cp.known_language(spark, documents(spark, cases.DOCS), folder)
    assert {r.doc_id for r in out.where("text RLIKE '[a-z]'").collect()} >= {1, 2, 3, 6, 7, 8, 9, 11}
    assert out.where("doc_id IN (4, 5, 10, 14)").count() == 0 and out.where("lang IS NULL").count() == 0


def test_whole(spark, folder):
    rows = cases.texts(150)
    documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    got = cp.run(spark, folder)
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    comp = cases.jaccard_components(rows)
    kept = [(i, t) for i, t in rows if comp[i][1] == i]
    cut = cases.repeated_bytes(kept)
    kept = [(i, cut[i][4]) for i, _ in kept if cut[i][4]]
    judged = [(i, t, cases.contamination(t, bench)) for i, t in kept]
    kept = [(i, t) for i, t, (n, h, _) in judged if not (h and 20 * h >= n)]
    encode = packing.encoder(packing.vocabulary()[0], None)
    want = {i: len(encode(t)) + 1 for i, t in kept}
    assert {r.doc_id: r.n for r in got.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()} == want
    assert got.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
