import duckdb
import pytest

import corpus_pipeline
from candleforge.llm import queries

SF = "/root/testdata/sf0.001"


def test_pipeline_keeps_clean_documents(spark, tmp_path):
    pytest.importorskip("public_tokenizers")
    text = lambda k: " ".join(f"word{k} thing{j} other{k}{j}" for j in range(12))
    copied = text(1) + " tail"
    docs = [(1, text(1), "en"), (2, copied, "en"), (3, text(3) + "\nthe shared line of both", "en"), (4, text(4) + "\nthe shared line of both", "en"), (5, "123 456", "en"), (6, text(6) + " " + text(99), "en"), (7, None, None)]
    rows = [(i, t, k, "s", len(t or "")) for i, t, k in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, text(99))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    at, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, at, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        at = spark.read.parquet(f"{tmp_path}/{k}")
        seen[name] = {r.doc_id: r for r in at.collect()}
        if k < 4:
            assert at.columns == corpus_pipeline.COLUMNS
    assert set(seen["language ID"]) == {1, 2, 3, 4, 6}
    assert seen["line dedup"][4].text == text(4) and seen["line dedup"][3].text.endswith("both")
    assert set(seen["n-gram Jaccard join"]) == {1, 3, 4, 6}
    assert seen["benchmark decontamination"][6].text == text(6) + " "
    assert set(seen["packing"]) == {1, 3, 4, 6}


def _run(spark, path, rows):
    pytest.importorskip("public_tokenizers")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, None), (None, "a passage of the benchmark that nobody has")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return corpus_pipeline.run(spark, str(path))


def test_pipeline_with_null_and_repeated_ids(spark, tmp_path):
    text = lambda k: " ".join(f"word{k} thing{j} other{k}{j}" for j in range(12))
    rows = [(1, text(1), "en", "s", 1), (2, text(1), "en", "s", 1), (2, text(2), "en", "s", 1), (3, text(3), "en", None, None), (3, text(3), "en", None, None), (None, text(1), "en", "s", 1), (None, None, None, None, None), (4, "", "en", "s", 0)]
    got = sorted((r.doc_id or 0, r.doc_tokens) for r in _run(spark, tmp_path, rows).collect())
    assert [i for i, _ in got] == [0, 1, 2, 3, 3]


def test_pipeline_of_an_empty_table(spark, tmp_path):
    assert _run(spark, tmp_path, []).count() == 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_equal_their_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    cols = sorted(queries.QUERIES[name](spark, SF).columns)
    got = queries.QUERIES[name](spark, SF).select(*cols).collect()
    want = c.execute(f"select {', '.join(cols)} from ({queries.SQL[name]})").fetchall()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_language_stage_at_its_threshold(spark, monkeypatch):
    rows = [(1, "a", "en", "s", 1, 0.4), (2, "b", "en", "s", 1, 0.3999), (3, "c", "und", "s", 1, 0.9), (4, "d", "fr", None, None, 1.0)]
    found = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string, source string, n_chars long, score double")
    monkeypatch.setattr(corpus_pipeline, "identify", lambda docs, keep: found)
    assert [(r.doc_id, r.lang) for r in corpus_pipeline.language_id(spark, found, "").collect()] == [(1, "en"), (4, "fr")]
