import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textfeat.functions import patterns, text
from textfeat.operators import terms
from textfeat.plans import runs, sizing

SPLIT = re.compile(patterns.WORD_SEPARATOR)


def brute(docs, stop_words=(), keep_empty=False):
    counts = Counter()
    for doc_id, body in docs:
        for word in SPLIT.split(body):
            word = word.lower()
            if word not in stop_words and (word or keep_empty):
                counts[doc_id, word] += 1
    return counts


def random_docs(n=60, n_ids=40, hot=0, seed=1):
    rng = random.Random(seed)
    words = ["the", "The", "a", "é-b", "it's", "--", "x1y", "ÉTÉ", "zz", "q", "...", "of"]
    docs = [(rng.randrange(n_ids), " ".join(rng.choices(words, k=rng.randrange(12)))) for _ in range(n)]
    return docs + [(7, " ".join(rng.choices(words, k=5))) for _ in range(hot)]


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, body string")


def as_counts(df):
    return {(r.doc_id, r.word): r.cnt for r in df.collect()}


@pytest.mark.parametrize("keep_empty", [False, True])
@pytest.mark.parametrize("stop_words", [(), ("the", "q"), ("the", "")])
def test_plans_agree_with_brute_force(spark, keep_empty, stop_words):
    unique = [(i, body) for i, (_, body) in enumerate(random_docs())]
    repeated = random_docs(hot=40)
    for docs, max_repeated in [(unique, 100), (repeated, 100), (repeated, 0)]:
        df = terms.term_counts(
            frame(spark, docs), stop_words=stop_words, keep_empty=keep_empty, with_max=True, max_repeated=max_repeated
        )
        expected = brute(docs, stop_words, keep_empty)
        assert df.columns == ["doc_id", "word", "cnt", "max_cnt"]
        rows = df.collect()
        assert {(r.doc_id, r.word): r.cnt for r in rows} == expected and len(rows) == len(expected)
        highest = {}
        for (doc_id, _), n in expected.items():
            highest[doc_id] = max(n, highest.get(doc_id, 0))
        assert {r.doc_id: r.max_cnt for r in rows} == highest


def test_stop_word_tables(spark, monkeypatch):
    docs = random_docs()
    stop = spark.createDataFrame([("the",), ("zz",)], "word string")
    expected = brute(docs, ("the", "zz"))
    assert as_counts(terms.term_counts(frame(spark, docs), stop_words=stop)) == expected
    monkeypatch.setattr(terms, "INLINE_STOP_WORDS", 1)
    assert as_counts(terms.term_counts(frame(spark, docs), stop_words=stop)) == expected


def test_unique_ids_need_no_shuffle(spark):
    docs = frame(spark, [(i, f"a b {i}") for i in range(20)])
    plan = terms.term_counts(docs, with_max=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


@pytest.mark.parametrize("docs", [[(1, "a b"), (2, "a")], [(1, "a b"), (1, "a"), (2, "c")]])
def test_texts_are_read_once(spark, tmp_path, monkeypatch, docs):
    """What comes back reads staged tables only, so the texts may be gone by then."""
    source = str(tmp_path / "docs")
    frame(spark, docs).write.parquet(source)
    long_list = spark.createDataFrame([("b",)], "word string")
    for stop_words, inline in (((), 10), (long_list, 0)):
        monkeypatch.setattr(terms, "INLINE_STOP_WORDS", inline)
        read = spark.read.parquet(source)
        for df in (
            terms.term_counts(read, stop_words=stop_words, with_max=True),
            terms.frequency_lists(read, stop_words=stop_words),
            terms.highest_counts(read, stop_words=stop_words),
            runs.frequency_state(read, stop_words=stop_words),
        ):
            assert df.inputFiles() and not set(df.inputFiles()) & set(read.inputFiles())


def test_only_texts_of_repeated_ids_are_merged(spark):
    docs = frame(spark, [(1, "b a b"), (1, "a c"), (2, "b b"), (None, "z")])
    lists = {r.doc_id: [tuple(t) for t in r.terms] for r in terms.frequency_lists(docs).collect()}
    assert lists == {1: [("a", 2), ("b", 2), ("c", 1)], 2: [("b", 2)]}
    assert dict(map(tuple, terms.highest_counts(docs).collect())) == {1: 2, 2: 2}
    alone, shared = terms.counted_texts(docs)
    assert [r.doc_id for r in alone.collect()] == [2] and {r.doc_id for r in shared.collect()} == {1}


def test_null_keys_are_a_batch(spark):
    rows = [(None, 1, "a"), (None, 1, "a b"), (5, 1, "a"), (5, 2, "b")]
    docs = spark.createDataFrame(rows, "batch long, doc_id long, body string")
    state = {(r.batch, r.word): r.df for r in runs.frequency_state(docs, keys=["batch"]).collect()}
    assert state == {(None, "a"): 1, (None, "b"): 1, (None, None): 1, (5, "a"): 1, (5, "b"): 1, (5, None): 2}


def test_long_stop_lists_leave_the_highest_count_of_other_words(spark, monkeypatch):
    monkeypatch.setattr(terms, "INLINE_STOP_WORDS", 0)
    docs = frame(spark, [(1, "a a a b"), (1, "b c"), (2, "a"), (3, "a c")])
    stop = spark.createDataFrame([("a",)], "word string")
    rows = terms.term_counts(docs, stop_words=stop, with_max=True).collect()
    assert sorted(map(tuple, rows)) == [(1, "b", 2, 2), (1, "c", 1, 2), (3, "c", 1, 1)]
    assert {r.word: r.df for r in runs.frequency_state(docs, stop_words=stop).collect()} == {"b": 1, "c": 2, None: 2}


def test_term_frequency(spark):
    docs = frame(spark, [(1, "a a b"), (1, "a c"), (2, "d")])
    tf = {(r.doc_id, r.word): r.tf for r in terms.term_frequency(terms.term_counts(docs)).collect()}
    assert tf == {(1, "a"): 1.0, (1, "b"): 1 / 3, (1, "c"): 1 / 3, (2, "d"): 1.0}


def test_long_lists_are_split(spark):
    docs = [(1, " ".join(f"w{chr(97 + i)}" for i in range(20))), (2, "b a a")]
    counts = terms.term_counts(frame(spark, docs))
    whole = terms.term_lists(counts, "cnt", "terms").collect()
    assert {r.part for r in whole} == {0}
    assert [tuple(t) for r in whole if r.doc_id == 2 for t in r.terms] == [("a", 2), ("b", 1)]
    split = terms.term_lists(counts, "cnt", "terms", parts=3).collect()
    assert len([r for r in split if r.doc_id == 1]) == 3 and {r.part for r in split} == {0, 1, 2}
    assert {(r.doc_id, t.word): t.cnt for r in split for t in r.terms} == brute(docs)


@pytest.mark.parametrize("inline", [0, 10_000])
@pytest.mark.parametrize("max_repeated", [0, 1_000_000])
def test_nulls_and_repeats_do_not_depend_on_the_plan(spark, monkeypatch, inline, max_repeated):
    monkeypatch.setattr(terms, "INLINE_STOP_WORDS", inline)
    docs = spark.createDataFrame([(1, "a b b"), (1, "b c"), (2, "a c"), (None, "a d"), (None, "d"), (3, None)], "doc_id long, body string")
    stop = spark.createDataFrame([("a",), (None,)], "word string")
    for words in (stop, ["a", None]):
        found = terms.term_counts(docs, stop_words=words, max_repeated=max_repeated)
        assert sorted(map(tuple, found.collect())) == [(1, "b", 3), (1, "c", 1), (2, "c", 1)]
    assert sorted(r.word for r in terms.remove_stop_words(terms.tokenize(docs), stop).collect()) == sorted("bbbccdd")


def test_sizing(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k long")
    assert sizing.within(df, 3) and not sizing.within(df, 2)
    assert sizing.has_hot_key(df, "k", 1) and not sizing.has_hot_key(df, "k", 2)
    assert [r.k for r in sizing.repeated_keys(df, "k").collect()] == [1]


@pytest.mark.parametrize("hot", [0, 30])
def test_frequency_state(spark, hot):
    docs = random_docs(hot=hot) if hot else [(i, body) for i, (_, body) in enumerate(random_docs())]
    counts = brute(docs)
    expected = Counter(word for _, word in counts)
    expected[None] = len({doc_id for doc_id, _ in counts})
    state = runs.frequency_state(frame(spark, docs))
    assert {r.word: r.df for r in state.collect()} == expected
    corpus = runs.count_corpus(frame(spark, docs))
    assert {r.word: r.df for r in corpus.state.collect()} == expected


def test_counts_read_once_are_not_staged_where_ids_do_not_repeat(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "b"), (3, ""), (None, "lost")], "doc_id long, body string")
    again = docs.unionByName(spark.createDataFrame([(2, "b c"), (2, "c")], docs.schema))
    for rows in (docs, again):
        staged, direct = (terms.term_counts(rows, with_max=True, once=once) for once in (False, True))
        assert sorted(direct.collect()) == sorted(staged.collect())
        assert sorted(terms.highest_counts(rows, once=True).collect()) == sorted(terms.highest_counts(rows).collect())
        assert sorted(terms.frequency_lists(rows, once=True).collect()) == sorted(terms.frequency_lists(rows).collect())
        state = runs.frequency_state(rows, once=True)
        assert sorted(map(str, state.collect())) == sorted(map(str, runs.frequency_state(rows).collect()))
    assert not terms.term_counts(docs, once=True).inputFiles() and terms.term_counts(again, once=True).inputFiles()


def test_words_of_whole_texts_lowered_at_once(spark):
    """ASCII texts are lowered before they are split, others after; the words are those of the plain way."""
    odd = ["", " ", "--", "A--B -- c---D-", "It's  A", "Kelvin Ång", "İstanbul Z", "STRAẞE ÉtÉ", "xİ--Y", "-a- '--' ƐB", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "doc_id long, body string")
    plain = F.transform(F.split("body", patterns.WORD_SEPARATOR_RANGES), F.lower)
    for row in df.select(plain.alias("plain"), text.tokens(F.col("body")).alias("found")).collect():
        assert row.plain == row.found


def test_empty_words_are_dropped_without_a_function_per_word(spark):
    df = spark.createDataFrame([(1, " a -- b a ")], "doc_id long, body string")
    (row,) = terms.count_in_place(df).collect()
    assert [tuple(t) for t in row.terms] == [("a", 2), ("b", 1)] and row.max_cnt == 2
    (row,) = terms.count_in_place(df, keep_empty=True).collect()
    assert [tuple(t) for t in row.terms] == [("", 4), ("a", 2), ("b", 1)]
