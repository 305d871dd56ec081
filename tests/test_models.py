import math
import random

import pytest

from textfeat.operators import hashing, metrics, models
from textfeat.plans import runs
from textfeat.sources import datasets

BINS = 16


@pytest.fixture(scope="module")
def data(spark):
    """Two topics that differ in their words, with a few words in common."""
    rng = random.Random(5)
    docs, meta = [], []
    for doc_id in range(120):
        topic = "art" if doc_id % 3 == 0 else "sea"
        own = ["paint", "brush", "canvas"] if topic == "art" else ["ship", "wave", "sail"]
        words = rng.choices(own, k=6) + rng.choices(["one", "two", "six"], k=4)
        docs.append((doc_id, " ".join(words)))
        meta.append((doc_id, [(topic, "T")]))
    docs = spark.createDataFrame(docs, "doc_id long, body string")
    meta = spark.createDataFrame(meta, "doc_id long, subjects array<struct<subject:string,taxonomy:string>>")
    corpus = runs.count_corpus(docs)
    hashed = hashing.hashed_tfidf(corpus.tf, corpus.vocabulary(1.0), [BINS], portable=True)
    return runs.stage_vectors(hashed, BINS), meta, hashed


@pytest.fixture(scope="module")
def training(spark, data):
    vectors, meta, _ = data
    chosen, folds = runs.draw_folds(vectors, meta, [1, 2], 3, seed=1)
    assert [r.subject for r in chosen.orderBy("rank").collect()] == ["sea", "art"]
    return models.training_table(folds, vectors).cache()


def test_naive_bayes_closed_form(spark, data, training):
    rows = models.subject_rows(training, "art").collect()
    smoothing = 0.5
    model = models.fit(models.naive_bayes(smoothing), models.subject_rows(training, "art"))
    for r in models.naive_bayes_parameters(model, training).collect():
        members = [x for x in rows if x.label == r.label]
        sums = [sum(x.features[b] for x in members) for b in range(BINS)]
        pi = math.log((len(members) + smoothing) / (len(rows) + 2 * smoothing))
        theta = math.log((sums[r.bin] + smoothing) / (sum(sums) + BINS * smoothing))
        assert (r.pi, r.theta) == (pytest.approx(pi), pytest.approx(theta))


@pytest.mark.parametrize("number", range(10))
def test_models_beat_the_majority(training, number):
    setting = (models.default_grid() + models.regularised_grid())[number]
    rows = models.subject_rows(training, "art")
    model = models.fit(setting, rows.where("fold < 2"))
    if setting.method == "Tree":
        assert model.depth <= setting.estimator.getMaxDepth()
    found = metrics.metrics(metrics.confusion(models.predict(model, rows.where("fold = 2")))).first()
    assert found.truePos + found.falsePos + found.trueNeg + found.falseNeg == rows.where("fold = 2").count()
    # strong L1 shrinks every weight to zero, and without intercept all go to one class
    assert found.accuracy > 0.8 or setting.params == "(l1, 0.1)"


def test_grid_and_results_file(spark, data, tmp_path):
    vectors, meta, _ = data
    settings = [models.naive_bayes(0.5), models.decision_tree(3, 5)]
    results = runs.classify(vectors, meta, [1, 2], 3, seed=1, settings=settings)
    rows = results.collect()
    assert len(rows) == 2 * 2 * 2 * 3
    assert {(r.subject, r.method, r.fold, r["set"]) for r in rows} == {
        (s, m, f, t) for s in ("sea", "art") for m in ("NBay", "Tree") for f in (0, 1) for t in ("Training", "Validation", "Test")
    }
    for r in rows:
        assert min(r.precision, r.recall) <= r.f1score <= max(r.precision, r.recall)
        assert r.trainTime > 0 and r.classifyTime > 0
    datasets.write_csv(results, str(tmp_path / "results"))
    back = spark.read.csv(str(tmp_path / "results"), header=True)
    assert back.columns == results.columns and back.count() == len(rows)
    assert len(models.default_grid()) * 3 == 18


def test_too_few_folds(data):
    vectors, meta, _ = data
    with pytest.raises(ValueError):
        runs.classify(vectors, meta, [1], 2)


def test_metrics_without_positives(spark):
    rows = spark.createDataFrame([(0, 0)] * 3 + [(1, 0)], "label long, prediction long")
    found = metrics.metrics(metrics.confusion(rows)).first()
    assert (found.truePos, found.falsePos, found.trueNeg, found.falseNeg) == (0, 0, 3, 1)
    assert (found.accuracy, found.precision, found.recall, found.f1score) == (0.75, 0.0, 0.0, 0.0)
    empty = metrics.metrics(metrics.confusion(rows.where("label > 1"))).first()
    assert empty.accuracy is None and empty.f1score == 0.0


def test_finished_models_survive_a_failing_fit(training, tmp_path, monkeypatch):
    calls = []

    def group(table, runs, num_folds, parallel_fits):
        calls.extend((subject, fold) for subject, fold, _ in runs)
        done = [r for r in runs if r[0] != "b" or not fails]
        rows = [(s, m.method, m.params, v, name, 0.0, 0.0, 1, 2, 3, 4) for s, v, m in done for name in ("Training", "Validation", "Test")]
        return rows, [RuntimeError("lost")] * (len(runs) - len(done))

    monkeypatch.setattr(models, "_fitted_group", group)
    grid, path = [models.logistic_regression()], str(tmp_path / "results")
    fails = True
    with pytest.raises(RuntimeError, match="lost"):
        models.evaluate_grid(training, ["a", "b", "c"], 3, grid, path=path)
    assert len(calls) == 6
    fails = False
    rows = models.evaluate_grid(training, ["a", "b", "c"], 3, grid, path=path).collect()
    assert sorted(calls[6:]) == [("b", 0), ("b", 1)] and len(rows) == len({(r.subject, r.fold, r.set) for r in rows}) == 18


@pytest.mark.parametrize("number", range(5))
def test_optimality_tells_finished_fits(training, number):
    setting = [models.logistic_regression(), *models.regularised_grid()][number]
    rows = models.subject_rows(training, "art").where("fold < 2")
    found = models.optimality(setting, rows)
    assert [b for b, _, _ in found] == list(range(BINS))
    assert max(away for _, _, away in found) < 0.002
    early = models.Setting("LogR", "", setting.estimator.copy({setting.estimator.maxIter: 0}))
    # strong L1 has its optimum at zero, where the solver begins
    assert setting.params == "(l1, 0.1)" or max(away for _, _, away in models.optimality(early, rows)) > 0.02
