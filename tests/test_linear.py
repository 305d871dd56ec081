import math
import random
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.linalg import DenseVector, SparseVector, VectorUDT
from pyspark.sql import types as T

from textfeat.operators import linear, metrics, models

BINS = 8
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("features", VectorUDT()),
    T.StructField("assigned", T.MapType(T.StringType(), T.StructType([T.StructField("label", T.LongType()), T.StructField("fold", T.LongType())]))),
])


@pytest.fixture(scope="module")
def table(spark):
    """Documents of two subjects in four folds; sparse, dense and empty vectors."""
    rng = random.Random(3)
    rows = []
    for i in range(160):
        values = {b: round(rng.random() + (b == i % 3), 3) for b in rng.sample(range(BINS), rng.randint(0, 5))}
        vector = SparseVector(BINS, values) if i % 4 else DenseVector([values.get(b, 0.0) for b in range(BINS)])
        assigned = {s: (int(i % 3 == k), (i // 3) % 4) for k, s in enumerate(("art", "sea")) if i % 7 or k}
        rows.append((i, vector, assigned))
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


def by_model(table, subject, valid_fold, setting):
    """Confusion counts of one model fitted and scored on its own."""
    rows = models.subject_rows(table, subject)
    role = models.fold_ops.role(rows["fold"], models.F.lit(valid_fold), 4).alias("set")
    rows = rows.select("*", role)
    model = models.fit(setting, rows.where("`set` = 'Training'"))
    found = metrics.confusion(models.predict(model, rows, "set"), ["set"])
    return {tuple(r) for r in found.select("set", "truePos", "falsePos", "trueNeg", "falseNeg").collect()}


def test_grid_equals_models_fitted_one_by_one(table):
    settings = [models.naive_bayes(0.5), models.naive_bayes(0.1), models.decision_tree(2, 5), models.logistic_regression("l2", 0.1)]
    found = models.evaluate_grid(table, ["art", "sea"], 4, settings).collect()
    assert len(found) == 2 * 3 * 4 * 3
    for subject in ("art", "sea"):
        for fold in range(3):
            for setting in settings:
                rows = [r for r in found if (r.subject, r.fold, r.method, r.params) == (subject, fold, setting.method, setting.params)]
                assert {(r["set"], r.truePos, r.falsePos, r.trueNeg, r.falseNeg) for r in rows} == by_model(table, subject, fold, setting)
                assert all(r.trainTime > 0 and r.classifyTime > 0 for r in rows)


def test_jobs_do_not_grow_with_subjects_and_folds(spark, table):
    def jobs(subjects, settings, name):
        spark.sparkContext.setJobGroup(name, name)
        try:
            models.evaluate_grid(table, subjects, 4, settings).collect()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))

    few = jobs(["art"], [models.naive_bayes(0.5)], "few")
    many = jobs(["art", "sea"], [models.naive_bayes(s) for s in (0.5, 0.1, 2.0)], "many")
    assert few == many


def test_vectors_are_scanned_once_for_all_models(spark, table, tmp_path):
    path = str(tmp_path / "table")
    table.write.parquet(path)
    stored = spark.read.schema(SCHEMA).parquet(path)
    fitted = [(s, v, models.fit(models.decision_tree(2, 5), models.subject_rows(table, s))) for s in ("art", "sea") for v in range(3)]
    plan = models.chained_confusion(stored, fitted, 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Python" not in plan
    made = linear.naive_bayes(linear.training_sums(linear.class_sums(table), 4), [0.5, 0.1])
    made = spark.createDataFrame(made.collect(), linear.MODEL_SCHEMA)
    plan = linear.confusion(stored, made, 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert made.count() == 2 * 3 * 2


def test_sums_add_up_over_folds(table):
    rows = table.collect()
    for r in linear.class_sums(table).collect():
        members = [x.features.toArray() for x in rows if r.subject in x.assigned and tuple(x.assigned[r.subject]) == (r.label, r.fold)]
        assert r.n == len(members) and r.sums == pytest.approx(sum(members).tolist())


def test_products_in_slices_of_any_size(table, monkeypatch):
    made = linear.naive_bayes(linear.training_sums(linear.class_sums(table), 4), [0.5])
    whole = {tuple(r) for r in linear.confusion(table, made, 4).collect()}
    monkeypatch.setattr(linear, "SLICE_BYTES", 100)
    assert {tuple(r) for r in linear.confusion(table, made, 4).collect()} == whole


def test_one_class_takes_all(spark, table):
    one = spark.createDataFrame([(r.doc_id, r.features, {"art": (1, r.doc_id % 3)}) for r in table.collect()], SCHEMA)
    made = linear.naive_bayes(linear.training_sums(linear.class_sums(one), 3), [1.0])
    found = linear.confusion(one, made, 3).collect()
    assert len(found) == 6 and all(r.falseNeg == 0 and r.truePos > 0 for r in found)


def test_a_failing_fit_leaves_the_others_and_groups_are_kept(spark, table, tmp_path, monkeypatch):
    path, real = str(tmp_path / "kept"), models.fit
    settings = [models.naive_bayes(0.5), models.decision_tree(2, 5), models.logistic_regression()]
    monkeypatch.setattr(models, "GROUP_MODELS", 4)

    def broken(setting, training):
        if setting.method == "LogR":
            raise RuntimeError("no convergence")
        return real(setting, training)

    monkeypatch.setattr(models, "fit", broken)
    with pytest.raises(RuntimeError, match="no convergence"):
        models.evaluate_grid(table, ["art", "sea"], 4, settings, path=path)
    monkeypatch.setattr(models, "fit", lambda setting, training: real(setting, training) if setting.method == "LogR" else pytest.fail("fitted twice"))
    assert models.evaluate_grid(table, ["art", "sea"], 4, settings, path=path).count() == 2 * 3 * 3 * 3


def test_parameters_from_sums_are_those_of_fits(table):
    """Naive Bayes of all runs from sums taken once, and predictions of all runs in one pass."""
    subjects = ["art", "sea"]
    setting = models.naive_bayes(0.5)
    sums = linear.training_sums(linear.class_sums(table), 4)
    made = {(r.subject, r.fold, r.label, r.bin): (r.pi, r.theta) for r in linear.naive_bayes_parameters(sums, 0.5).collect()}
    fitted = models.fit_runs(table, subjects, 4, setting)
    assert [f[:2] for f in fitted] == [(s, v) for s in subjects for v in range(3)]
    chained = models.chained_predictions(table, fitted, 4, "doc_id").collect()
    n = 0
    for subject, fold, model in fitted:
        for r in models.naive_bayes_parameters(model, table).collect():
            assert made[subject, fold, r.label, r.bin] == (pytest.approx(r.pi), pytest.approx(r.theta))
            n += 1
        alone = models.predict(model, models.subject_rows(table, subject), "doc_id").collect()
        mine = [(r.doc_id, r.label, r.prediction) for r in chained if (r.subject, r.fold) == (subject, fold)]
        assert sorted(mine) == sorted(tuple(r) for r in alone)
    assert n == len(made)


def test_parameters_of_a_class_that_is_missing(spark):
    sums = spark.createDataFrame([("a", 0, 2, None, [1.0, 3.0], None)], "subject string, valid_fold long, n0 long, n1 long, sums0 array<double>, sums1 array<double>")
    rows = linear.naive_bayes_parameters(sums, 1.0).orderBy("bin").collect()
    assert [(r.label, r.bin, r.pi, r.theta) for r in rows] == [(0, 0, 0.0, pytest.approx(math.log(2 / 6))), (0, 1, 0.0, pytest.approx(math.log(4 / 6)))]


def test_scoring_holds_no_more_for_a_longer_batch():
    def peak(n: int) -> int:
        rng = np.random.default_rng(0)
        offsets = [pa.array(np.arange(n + 1, dtype=np.int32) * k) for k in (64, 1)]
        places = pa.StructArray.from_arrays([pa.array(rng.integers(0, 2, n)), pa.array(rng.integers(0, 3, n))], ["label", "fold"])
        entries = (pa.array(np.tile(np.arange(64, dtype=np.int32), n)), pa.array(rng.random(64 * n)))
        columns = [*(pa.ListArray.from_arrays(offsets[0], e) for e in entries), pa.ListArray.from_arrays(offsets[1], places)]
        batch = pa.RecordBatch.from_arrays(columns, ["indices", "values", "places"])
        models = [SimpleNamespace(subject="a", fold=i % 2, bias=-0.5, weights=rng.standard_normal(64)) for i in range(24)]
        tracemalloc.start()
        (found,) = linear._role_counts(models, 3, linear.SETS)(iter([batch]))
        held = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert sum(sum(found.column(c).to_pylist()) for c in linear.CELLS) == n * len(models)
        return held

    assert peak(10_000) < 1.2 * peak(2_000) < 20_000_000


def test_fits_of_a_training_set_read_it_alone(spark, table, monkeypatch):
    """Settings that learn from one set share it, staged without other rows; it is gone after them."""
    staged, released, read, real = [], [], [], models.fit
    real_stage, real_release = models.stage, models.release
    monkeypatch.setattr(models, "stage", lambda df, label: staged.append(real_stage(df, label)) or staged[-1])
    monkeypatch.setattr(models, "release", lambda df: released.append(df) or real_release(df))

    def counted(setting, training):
        stored = spark.read.parquet(*training.inputFiles()).count() if training.inputFiles() else None
        read.append((stored, training.count()))
        return real(setting, training)

    monkeypatch.setattr(models, "fit", counted)
    found = models.evaluate_grid(table, ["art", "sea"], 4, models.regularised_grid()).collect()
    assert len(found) == 2 * 3 * 4 * 3 and len(read) == 2 * 3 * 4
    assert all(stored == wanted for stored, wanted in read)
    assert len(staged) == len(released) == 2 * 3 and {id(s) for s in staged} == {id(r) for r in released}
    for setting in models.regularised_grid():
        rows = [r for r in found if (r.subject, r.fold, r.params) == ("art", 0, setting.params)]
        assert {(r["set"], r.truePos, r.falsePos, r.trueNeg, r.falseNeg) for r in rows} == by_model(table, "art", 0, setting)
