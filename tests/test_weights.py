import math
import random

import pytest
from pyspark.sql import functions as F

from textfeat.operators import hashing, index, weights
from textfeat.plans import runs
from textfeat.plans.staging import stage

ROWS = [(1, "a", 1.0), (1, "b", 0.5), (2, "a", 1.0), (3, "a", 0.25), (3, "c", 1.0), (4, "a", 1.0)]


@pytest.fixture
def tf(spark):
    return spark.createDataFrame(ROWS, "doc_id long, word string, tf double")


@pytest.fixture
def idf(tf):
    return weights.inverse_document_frequency(weights.document_frequency(tf), weights.corpus_size(tf))


def test_idf(idf):
    found = {r.word: (r.df, r.idf) for r in idf.collect()}
    assert found == {"a": (4, 0.0), "b": (1, math.log(4)), "c": (1, math.log(4))}


def test_prune_keeps_the_exact_boundary(spark):
    df = spark.createDataFrame([("in", 10), ("out", 9)], "word string, df long")
    n = spark.createDataFrame([(1000,)], "n_docs long")
    assert [r.word for r in weights.prune_vocabulary(df, n, 1.0).collect()] == ["in"]


@pytest.mark.parametrize("max_rows", [1000, 2, 1])
def test_split_vocabulary_gives_the_same_weights(tf, idf, max_rows):
    found = {(r.doc_id, r.word): r.tfidf for r in weights.tfidf(tf, idf.where("word <> 'b'"), max_rows).collect()}
    log4 = math.log(4)
    assert found == {(1, "a"): 0.0, (2, "a"): 0.0, (3, "a"): 0.0, (4, "a"): 0.0, (3, "c"): log4}


def test_frequent_words_stay_below_the_limit(spark):
    rng = random.Random(3)
    rows = [(f"w{i}", rng.choice([1, 1, 1, 5, 400])) for i in range(300)]
    vocabulary = spark.createDataFrame(rows, "word string, df long")
    tf = spark.createDataFrame([(i, f"w{i}", 1.0) for i in range(300)], "doc_id long, word string, tf double")
    joined = weights.join_vocabulary(tf, vocabulary, max_rows=60)
    assert {(r.word, r.df) for r in joined.collect()} == set(rows) and joined.count() == 300


@pytest.mark.parametrize("seed", range(3))
def test_states_of_any_split_merge_to_the_same(spark, seed):
    rng = random.Random(seed)
    docs = [(i, " ".join(rng.choices("abcdefgh", k=rng.randrange(6))), rng.randrange(4)) for i in range(50)]
    df = spark.createDataFrame(docs, "doc_id long, body string, batch long")
    once = {r.word: r.df for r in runs.frequency_state(df).collect()}
    batches = runs.frequency_state(df, keys=["batch"])
    assert {r.word: r.df for r in weights.merge_states(batches).collect()} == once
    parts = [batches.where(F.col("batch") == b) for b in range(4)]
    assert {r.word: r.df for r in weights.merge_states(*parts).collect()} == once


def test_resumed_corpus(spark):
    docs = spark.createDataFrame([(i, f"a w{i % 3}") for i in range(12)], "doc_id long, body string")
    first = runs.count_corpus(docs.where("doc_id < 5"))
    second = runs.count_corpus(docs.where("doc_id >= 5"), earlier=first.state)
    whole = runs.count_corpus(docs)
    assert sorted(second.vocabulary().collect()) == sorted(whole.vocabulary().collect())


def test_index_blocks_are_bounded(spark, tf):
    found = index.inverted_index(tf, block_size=2)
    assert found.select(F.max(F.size("postings"))).first()[0] <= 2
    blocks = {(r.word, r.block): [tuple(p) for p in r.postings] for r in found.collect()}
    assert blocks[("a", 0)] == [(1, 1.0)] and blocks[("a", 1)] == [(2, 1.0), (3, 0.25)]
    assert {(r.doc_id, r.word, r.tf) for r in index.explode_index(found).collect()} == set(ROWS)


@pytest.mark.parametrize("portable", [False, True])
def test_hashing_keeps_the_sum(tf, idf, portable):
    named = weights.tfidf(tf, idf)
    sums = {r.doc_id: r.total for r in named.groupBy("doc_id").agg(F.sum("tfidf").alias("total")).collect()}
    hashed = hashing.hashed_tfidf(tf, idf, [1, 3, 64], portable)
    for r in hashed.groupBy("doc_id", "num_bins").agg(F.sum("weight").alias("total")).collect():
        assert r.total == pytest.approx(sums[r.doc_id])
    assert hashed.where("bin < 0 OR bin >= num_bins").count() == 0
    single = {tuple(r) for r in hashing.hash_weights(named, 64, portable).collect()}
    assert single == {tuple(r) for r in hashed.where("num_bins = 64").collect()}


@pytest.mark.parametrize("max_rows", [1000, 1])
def test_shuffling_by_document_changes_no_weight(tf, idf, max_rows):
    plain = hashing.hashed_tfidf(tf, idf, [3, 8])
    together = hashing.hashed_tfidf(tf, idf, [3, 8], max_rows=max_rows, by_document=True)
    assert sorted(together.collect()) == sorted(plain.collect())


def test_vectors_take_one_shuffle_by_document(tf, idf):
    staged = stage(idf, "idf")
    hashed = hashing.hashed_tfidf(stage(tf, "tf"), staged, [3, 8], by_document=True)
    plan = hashing.assemble_vectors(hashed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_corpus_size_is_counted_without_words(spark):
    """The number of documents comes from rows of texts: only texts that share an id are counted by words."""
    def size(rows):
        return runs.count_corpus(spark.createDataFrame(rows, "doc_id long, body string")).size

    alone = size([(1, "a b a"), (2, "b"), (3, " "), (4, None), (None, "a")])
    assert [r.n_docs for r in alone.collect()] == [2]
    assert "Generate" not in alone._jdf.queryExecution().optimizedPlan().toString()
    assert [r.n_docs for r in size([(1, "a b"), (2, "b"), (2, "c c"), (5, "--"), (5, "")]).collect()] == [2]
