import hashlib
import random
from collections import Counter

import pytest

from textfeat.operators import folds, subjects

META = [
    (1, [("A", "T"), ("A", "U"), ("B", "T")]),
    (2, [("A", "T"), (None, "T")]),
    (3, [("C", "T")]),
    (4, [("B", "T")]),
    (5, []),
]


@pytest.fixture
def meta(spark):
    return spark.createDataFrame(META, "doc_id long, subjects array<struct<subject:string,taxonomy:string>>")


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "doc_id long")


def test_counts_and_ranks(spark, meta):
    counts = subjects.subject_counts(subjects.subject_pairs(meta))
    assert {tuple(r) for r in counts.collect()} == {("A", 3), ("B", 2), ("C", 1)}
    assert [tuple(r) for r in subjects.rank_range(counts, 2, 9).orderBy("rank").collect()] == [(2, "B", 2), (3, "C", 1)]
    assert {tuple(r) for r in subjects.pick_ranks(counts, [1, 3]).collect()} == {(1, "A", 3), (3, "C", 1)}
    tied = spark.createDataFrame([("z", 1), ("y", 1), ("x", 1)], "subject string, n long")
    assert [r.subject for r in subjects.rank_range(tied, 1, 2).orderBy("rank").collect()] == ["x", "y"]


def test_metadata_with_vectors(spark, meta):
    kept = subjects.with_vectors(meta, ids(spark, [1, 1, 3, 9]))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_one_vs_rest(spark, meta):
    pairs = subjects.subject_pairs(meta)
    chosen = spark.createDataFrame([(1, "A", 3), (2, "B", 2)], "rank long, subject string, n long")
    labels = subjects.one_vs_rest(ids(spark, [1, 2, 3, 5, 5, 6]), pairs, chosen)
    expected = {("A", 1, 1), ("B", 1, 1), ("A", 2, 1), ("B", 2, 0)}
    expected |= {(s, d, 0) for s in "AB" for d in (3, 5, 6)}
    rows = labels.collect()
    assert {tuple(r) for r in rows} == expected and len(rows) == len(expected)
    assert {tuple(r) for r in subjects.label_totals(labels).collect()} == {("A", 2, 3), ("B", 1, 4)}
    plan = labels._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def brute_folds(labels, k, seed):
    found = set()
    for key in {(s, label) for s, _, label in labels}:
        members = [d for s, d, label in labels if (s, label) == key]
        members.sort(key=lambda d: (hashlib.md5(f"{seed}:{d}".encode()).hexdigest(), d))
        size = len(members) // k
        found |= {(key[0], d, key[1], i // size) for i, d in enumerate(members) if size and i // size < k}
    return found


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("digits", [1, 4])
def test_folds_match_brute_force(spark, monkeypatch, seed, digits):
    monkeypatch.setattr(folds, "SLICE_DIGITS", digits)
    rng = random.Random(seed)
    k = rng.randrange(3, 6)
    labels = [(s, d, int(rng.random() < share)) for s, share in [("A", 0.5), ("B", 0.03)] for d in range(rng.randrange(150))]
    df = spark.createDataFrame(labels, "subject string, doc_id long, label long")
    drawn = folds.stratified_folds(df, k, seed)
    rows = [tuple(r) for r in drawn.collect()]
    assert set(rows) == brute_folds(labels, k, seed) and len(rows) == len(set(rows))
    sizes = Counter((s, label, fold) for s, _, label, fold in rows)
    totals = Counter((s, label) for s, _, label in labels)
    assert all(n == totals[s, label] // k for (s, label, _), n in sizes.items())


def test_remainder_and_small_class(spark):
    labels = [("A", d, int(d < 13)) for d in range(20)] + [("B", d, int(d < 2)) for d in range(20)]
    df = spark.createDataFrame(labels, "subject string, doc_id long, label long")
    balance = {tuple(r) for r in folds.label_balance(folds.stratified_folds(df, 3, 1)).collect()}
    expected = {("A", f, label, n) for f in range(3) for label, n in [(1, 4), (0, 2)]}
    assert balance == expected | {("B", f, 0, 6) for f in range(3)}


def test_roles(spark):
    drawn = spark.createDataFrame([("A", d, 0, d % 4) for d in range(8)], "subject string, doc_id long, label long, fold long")
    rows = folds.fold_roles(drawn, 4).collect()
    assert len(rows) == 24
    for r in rows:
        expected = "Test" if r.fold == 3 else "Validation" if r.fold == r.valid_fold else "Training"
        assert r.role == expected
    with pytest.raises(ValueError):
        folds.fold_roles(drawn, 2)


def test_fold_features(spark):
    drawn = spark.createDataFrame([("A", 1, 0, 0), ("A", 2, 1, 1)], "subject string, doc_id long, label long, fold long")
    vectors = spark.createDataFrame([(1, 0.5), (3, 0.5)], "doc_id long, weight double")
    assert [r.doc_id for r in folds.fold_features(drawn, vectors).collect()] == [1]
