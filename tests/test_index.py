import math

import pytest

from textfeat.operators import index
from textfeat.plans.staging import stage


def test_weights_from_a_written_index(spark, tmp_path):
    rows = [(d, w, tf) for d, w, tf in ((1, "a", 1.0), (1, "b", 0.5), (70_000, "a", 0.25), (-3, "c", 1.0))]
    tf = spark.createDataFrame(rows, "doc_id long, word string, tf double")
    path = str(tmp_path / "index")
    index.write_index(tf, path)
    found = {(r.doc_id, r.word): r.tfidf for r in index.index_tfidf(spark, path).collect()}
    df = {"a": 2, "b": 1, "c": 1}
    assert found == {(d, w): pytest.approx(tf * math.log(3 / df[w])) for d, w, tf in rows}
    assert {(r.word, r.block) for r in index.read_index(spark, path).collect()} == {("a", 0), ("a", 1), ("b", 0), ("c", -1)}
    # A share of 50 % is kept by "a" alone.
    assert {r.word for r in index.index_tfidf(spark, path, 50.0).collect()} == {"a"}


def test_lists_are_opened_after_the_join_and_sizes_read_no_postings(spark, tmp_path):
    tf = spark.createDataFrame([(1, "a", 1.0), (2, "b", 1.0)], "doc_id long, word string, tf double")
    path = str(tmp_path / "index")
    index.write_index(tf, path)
    plan = index.index_vocabulary(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "postings:array" not in plan
    plan = index.index_tfidf(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Join") and plan.count("Generate") == 1


def test_an_empty_index(spark, tmp_path):
    path = str(tmp_path / "index")
    index.write_index(spark.createDataFrame([], "doc_id long, word string, tf double"), path)
    assert index.index_tfidf(spark, path).count() == 0
    assert stage(index.index_vocabulary(spark, path), "v").count() == 0
