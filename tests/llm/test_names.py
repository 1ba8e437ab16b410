"""Columns of the input that bear a result's name."""

import pytest


@pytest.fixture(scope="module")
def tables(spark):
    names = "doc_id long, text string, lang string, score double, held_out string, predicted string, n_words string, stratum string, __m string, __good string, kept string"
    good = "These are plain sentences of some length, as people write them in letters and in books every day. " * 3
    rows = [(i, good if i % 2 else "@@ ## buy $$ " * (i % 5 + 1), "en", -1.0, *["x"] * 7) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    return spark.createDataFrame(rows, names), labels


def test_scores(tables):
    from tallyloom.llm.quality_model import learn, scored

    docs, labels = tables
    out = scored(docs, learn(docs, labels))
    assert len(set(out.columns)) == len(out.columns) and out.columns[-3:] == ["held_out", "score", "predicted"]
    assert all(0 <= r["score"] <= 1 and r["n_words"] == "x" for r in out.collect())
    named = scored(docs, learn(docs, labels), prefix="__q_")
    assert {r["score"] for r in named.collect()} == {-1.0}


def test_rules(tables):
    from tallyloom.llm.quality_rules import ruled

    out = ruled(*tables)
    assert len(set(out.columns)) == len(out.columns) and "stratum" in out.columns
    assert {type(r["kept"]) for r in out.collect()} == {bool}


def test_first_stage_keeps_columns(spark, tables, tmp_path):
    import corpus_pipeline

    docs, labels = tables
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    kept = corpus_pipeline.good_quality(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert {r["score"] for r in kept.collect()} == {-1.0}
