import random

import pytest

from textfeat.operators import terms, weights
from textfeat.plans import runs
from textfeat.plans.store import FrequencyStore
from textfeat.streaming import frequency

SCHEMA = "doc_id long, body string"


def state_of(rows):
    """Documents by word and their number, by brute force."""
    found, ids = {}, set()
    for doc_id, body in rows:
        for word in (body or "").split() if doc_id is not None else ():
            found.setdefault(word, set()).add(doc_id)
            ids.add(doc_id)
    return {w: len(d) for w, d in found.items()} | {None: len(ids)}


def held(store):
    return {r.word: r.df for r in store.state().collect()}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    texts = [(rng.choice([0, 0, 0, *range(40), None]), " ".join(rng.choices("abcdefghijklmnop", k=rng.randint(0, 6)))) for _ in range(200)]
    return [*texts, (1, None), (77, ""), (3, "a a a")]


def test_any_split_adds_up_to_one_pass(spark, rows, tmp_path):
    store = FrequencyStore(spark, str(tmp_path / "store"), buckets=3)
    assert held(store) == {}
    seen = []
    for batch, begin in enumerate((0, 50, 50, 120, 190)):  # one batch brings nothing
        part = rows[begin : (50, 50, 120, 190, 300)[batch]]
        seen += part
        store.add(terms.term_counts(spark.createDataFrame(part, SCHEMA)), batch)
        assert held(store) == state_of(seen)


def test_a_repeated_batch_replaces_itself(spark, rows, tmp_path):
    store = FrequencyStore(spark, str(tmp_path / "store"))
    for batch in (0, 1, 0, 2, 2, 1):
        store.add(terms.term_counts(spark.createDataFrame(rows[70 * batch : 70 * batch + 70], SCHEMA)), batch)
    assert held(store) == state_of(rows[:210])
    assert store.pairs().groupBy("p1", "p2").count().where("count > 1").isEmpty()


def test_only_buckets_of_returning_documents_are_read(spark, tmp_path):
    store = FrequencyStore(spark, str(tmp_path / "store"), buckets=8)
    store.add(terms.term_counts(spark.createDataFrame([(i, "a b") for i in range(50)], SCHEMA)), 0)
    assert store.pairs().select("bucket").distinct().count() > 4
    store.add(terms.term_counts(spark.createDataFrame([(7, "a c"), (60, "a")], SCHEMA)), 1)
    assert held(store) == {"a": 51, "b": 50, "c": 1, None: 51}
    plan = store.pairs().where("batch <> 1 AND bucket IN (3)")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_count_corpus_with_a_store(spark, tmp_path):
    first, second = [(1, "a b"), (2, "a")], [(2, "a c"), (3, "c")]
    store = FrequencyStore(spark, str(tmp_path / "store"))
    runs.count_corpus(spark.createDataFrame(first, SCHEMA), store=store, batch=0)
    corpus = runs.count_corpus(spark.createDataFrame(second, SCHEMA), store=store, batch=1)
    assert {r.word: r.df for r in corpus.state.collect()} == state_of(first + second)
    assert corpus.size.first().n_docs == 3
    assert {(r.word, r.df) for r in corpus.vocabulary().collect()} == {("a", 2), ("b", 1), ("c", 2)}


def test_stream_with_returning_documents(spark, rows, tmp_path):
    source, state, checkpoint = (str(tmp_path / d) for d in ("docs", "state", "checkpoint"))
    seen = []
    for begin in (0, 60, 130):
        part = rows[begin : begin + 60]
        seen += part
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        frequency.maintain_state(spark.readStream.schema(SCHEMA).parquet(source), state, checkpoint).awaitTermination()
        merged = weights.merge_states(frequency.read_state(spark, state))
        assert {r.word: r.df for r in merged.collect()} == state_of(seen)
