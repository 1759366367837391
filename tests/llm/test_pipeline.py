"""The pipeline: stages in order, each on what the one before kept."""

from __future__ import annotations

import brute
import corpus_pipeline as P
import duckdb
import pytest

from lawloom.llm.queries import ORACLES, QUERIES


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["language", "line_dedup", "near_duplicates", "mix", "sentence_pieces"]
    for k, (name, stage) in enumerate(P.STAGES):
        before = docs
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if k < len(P.STAGES) - 1:
            assert docs.columns == list(P.COLUMNS)
        rows = {r["doc_id"]: r for r in before.select("doc_id", "text").collect()} if "text" in before.columns else {}
        if name == "line_dedup":
            want = brute.op8(sorted((i, r["text"]) for i, r in rows.items()))
            assert {r["doc_id"]: brute.sha(r["text"].encode()) for r in docs.collect()} == {i: w[2] for i, w in want.items()}
        if name == "near_duplicates":
            want = brute.op7(sorted((i, r["text"]) for i, r in rows.items()), 5, 80)
            assert {r["doc_id"] for r in docs.select("doc_id").collect()} == {i for i, w in want.items() if w[1] == i}
    assert docs.where("round_trip").count() == docs.count() > 0
    again = {r["doc_id"] for r in P.run(spark, sf_dir).select("doc_id").collect()}
    assert again == {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_empty_and_odd_documents(spark, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "1234 5678", "en", "a", 9), (4, "the same text of some words here", "en", "a", 32), (5, "the same text of some words here", None, None, 32)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in P.STAGES:
        docs = stage(spark, docs, "")
        assert "doc_id" in docs.columns, name
    assert {r["doc_id"] for r in docs.collect()} <= {4}
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in P.STAGES:
        assert stage(spark, none, "").count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, sf_dir, name):
    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    df = QUERIES[name](spark, sf_dir)
    r = c.execute(ORACLES[name])
    at = {d[0]: k for k, d in enumerate(r.description)}
    assert sorted(at) == sorted(df.columns)
    want = sorted(repr(tuple(x[at[k]] for k in sorted(at))) for x in r.fetchall())
    assert sorted(repr(tuple(x[k] for k in sorted(at))) for x in df.collect()) == want
