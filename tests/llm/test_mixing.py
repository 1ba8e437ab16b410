"""Mixes with sources that hold no words."""

import pytest


@pytest.mark.parametrize("words", [True, False])
def test_sources_without_words(spark, words):
    from tallyloom.llm.mixing import curriculum, training_order

    rows = [(1, " \t", "a"), (2, None, "a"), (3, "", None), *[(4 + k, "three words here", "b") for k in range(4) if words]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mix = {r["doc_id"]: r for r in curriculum(docs).collect()}
    assert len(mix) == len(rows)
    for i in (1, 2, 3):
        assert (mix[i]["__size"], mix[i]["__target"], mix[i]["__taken"], mix[i]["__copies"]) == (0, 0.0, 0, [])
    assert [mix[i]["__taken"] for i in range(4, 4 + 4 * words)] == [3] * 4 * words
    assert training_order(curriculum(docs)).count() == 4 * words
