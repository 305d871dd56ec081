"""Many linear classifiers at once: Naive Bayes from sums, and scoring in one pass.

A binary model whose decision is ``bias + weights . features > 0`` is a row of a table. Naive Bayes is
of this kind, and so is logistic regression. The models of all subjects, folds and settings are scored
together: the table of vectors is read once, whatever their number.

Sums over the documents of a class add up over folds. They are taken once by subject, label and fold,
in one pass over the vectors; the training set of a run is all folds but two, so Naive Bayes for every
subject, validation fold and smoothing comes from these sums alone.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textfeat.operators import folds as fold_ops
from textfeat.plans.staging import local_table

MODEL_SCHEMA = "subject string, fold bigint, method string, params string, bias double, weights array<double>"
MODEL_KEYS = ["subject", "fold", "method", "params"]
SETS = ("Training", "Validation", "Test")
CELLS = ["truePos", "falsePos", "trueNeg", "falseNeg"]

# Bytes of products, and rows, held at a time: what a worker holds beside its batch does not grow with it.
SLICE_BYTES = 2 << 20
SLICE_ROWS = 1024


def drawn(table: DataFrame, *others: str) -> DataFrame:
    """``others, subject, label, fold`` of every document and subject of a training table."""
    rows = table.select(*others, F.explode("assigned").alias("subject", "place"))
    return rows.select(*others, "subject", F.col("place")["label"].alias("label"), F.col("place")["fold"].alias("fold"))


def class_sums(table: DataFrame) -> DataFrame:
    """``subject, label, fold, n, sums array<double>``: documents and sum of their features.

    One pass over the vectors; sums are combined per task, and one row a class and fold is shuffled.
    """
    total = Summarizer.metrics("sum").summary(F.col("features"))["sum"]
    found = drawn(table, "features").groupBy("subject", "label", "fold").agg(F.count(F.lit(1)).alias("n"), total.alias("sums"))
    return found.withColumn("sums", vector_to_array("sums"))


def training_sums(sums: DataFrame, num_folds: int) -> DataFrame:
    """``subject, valid_fold, n0, n1, sums0, sums1`` of every training set, from ``class_sums``.

    A class without documents in a training set has nulls.
    """
    runs = fold_ops.fold_roles(sums, num_folds).where("role = 'Training'")
    total = Summarizer.metrics("sum").summary(array_to_vector("sums"))["sum"]
    classes = runs.groupBy("subject", "valid_fold", "label").agg(F.sum("n").alias("n"), total.alias("sums"))
    classes = classes.withColumn("sums", vector_to_array("sums"))
    of = [(name, label) for name in ("n", "sums") for label in (0, 1)]
    return classes.groupBy("subject", "valid_fold").agg(*(F.max(F.when(F.col("label") == label, F.col(name))).alias(f"{name}{label}") for name, label in of))


def naive_bayes(training: DataFrame, smoothings: Sequence[float], method: str = "NBay") -> DataFrame:
    """Multinomial Naive Bayes of every row of ``training_sums`` and smoothing, as linear models.

    The weight of a bin is the difference of its log probabilities in the two classes, the bias that
    of the priors. With one class only, every document goes to it.
    """
    smoothing = F.array(*(F.struct(F.lit(float(s)).alias("s"), F.lit(str(s)).alias("params")) for s in smoothings))
    rows = training.select("*", F.inline(smoothing))

    def log_mass(sums: str) -> Column:
        """Logarithm of all of a class with its smoothing."""
        total = F.aggregate(sums, F.lit(0.0), lambda acc, x: acc + x)
        return F.log(total + F.size(sums) * F.col("s"))

    shift = log_mass("sums0") - log_mass("sums1")
    rows = rows.withColumn("shift", shift)
    weights = F.zip_with("sums1", "sums0", lambda a, b: F.log(a + F.col("s")) - F.log(b + F.col("s")) + F.col("shift"))
    prior = F.log(F.col("n1") + F.col("s")) - F.log(F.col("n0") + F.col("s"))
    bias = F.when(F.col("n1").isNull(), float("-inf")).when(F.col("n0").isNull(), float("inf")).otherwise(prior)
    return rows.select(
        "subject",
        F.col("valid_fold").alias("fold"),
        F.lit(method).alias("method"),
        "params",
        bias.alias("bias"),
        F.coalesce(weights, F.array().cast("array<double>")).alias("weights"),
    )


def naive_bayes_parameters(training: DataFrame, smoothing: float) -> DataFrame:
    """``subject, fold, label, bin, pi, theta`` of multinomial Naive Bayes of every row of
    ``training_sums``: log probability of the class, and of each bin in it. A class without documents in
    a training set has no rows."""
    s = float(smoothing)
    present = F.col("n0").isNotNull().cast("int") + F.col("n1").isNotNull().cast("int")
    every = F.coalesce("n0", F.lit(0)) + F.coalesce("n1", F.lit(0))
    rows = training.select(
        "subject",
        F.col("valid_fold").alias("fold"),
        (every + present * s).alias("mass"),
        F.inline(F.array(*(F.struct(F.lit(c).cast("bigint").alias("label"), F.col(f"n{c}").alias("n"), F.col(f"sums{c}").alias("sums")) for c in (0, 1)))),
    ).where("n IS NOT NULL")
    total = F.aggregate("sums", F.lit(0.0), lambda acc, x: acc + x) + F.size("sums") * s
    rows = rows.select("subject", "fold", "label", (F.log(F.col("n") + s) - F.log("mass")).alias("pi"), F.log(total).alias("total"), F.posexplode("sums").alias("bin", "sum"))
    theta = F.log(F.col("sum") + s) - F.col("total")
    return rows.select("subject", "fold", "label", F.col("bin").cast("bigint").alias("bin"), "pi", theta.alias("theta"))


def _role_counts(models: list, num_folds: int, sets: Sequence[str]):
    """Confusion cells of all models over the rows of a task, as ``model, set`` and four numbers."""
    width = max((len(m.weights) for m in models), default=0)
    matrix = np.zeros((width + 1, len(models)))  # the last row is for bins beyond the weights
    for k, m in enumerate(models):
        matrix[: len(m.weights), k] = m.weights
    bias = np.array([m.bias for m in models])
    subjects = sorted({m.subject for m in models})
    own, valid = np.array([subjects.index(m.subject) for m in models]), np.array([m.fold for m in models])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(len(models) * len(sets) * 4, np.int64)
        for batch in (b.slice(at, SLICE_ROWS) for b in batches for at in range(0, b.num_rows, SLICE_ROWS)):
            places = batch.column("places").flatten()
            label, fold = (places.field(i).to_numpy(zero_copy_only=False).astype(float).reshape(-1, len(subjects)) for i in range(2))
            margins = bias + _products(batch.column("indices"), batch.column("values"), matrix)
            label, fold = label[:, own], fold[:, own]
            role = np.where(fold == num_folds - 1, 2, np.where(fold == valid, 1, 0))
            slot = ((np.arange(len(models)) * len(sets) + role) * 2 + (label == 1)) * 2 + (margins > 0)
            cells += np.bincount(slot[~np.isnan(label)], minlength=len(cells))
        found = cells.reshape(-1, 4)
        used = np.flatnonzero(found.any(1))
        # Label and prediction: 00 01 10 11.
        columns = [used // len(sets), used % len(sets), *(found[used, i] for i in (3, 1, 0, 2))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["model", "role", *CELLS])

    return run


def _products(indices: pa.ListArray, values: pa.ListArray, matrix: np.ndarray) -> np.ndarray:
    """Product of sparse rows and a matrix, some entries at a time."""
    ends = np.concatenate([[0], np.cumsum(indices.value_lengths().to_numpy())])
    at = np.minimum(indices.flatten().to_numpy(), len(matrix) - 1)
    held = values.flatten().to_numpy()
    out = np.zeros((len(ends) - 1, matrix.shape[1]))
    step = max(1, SLICE_BYTES // (8 * matrix.shape[1]))
    begin = 0
    while begin < len(out):
        end = max(begin + 1, int(np.searchsorted(ends, ends[begin] + step, side="right")) - 1)
        some = slice(ends[begin], ends[end])
        filled = np.flatnonzero(np.diff(ends[begin : end + 1]))
        if len(filled):
            made = held[some, None] * matrix[at[some]]
            out[begin + filled] = np.add.reduceat(made, ends[begin:end][filled] - ends[begin], axis=0)
        begin = end
    return out


def confusion(table: DataFrame, models: DataFrame, num_folds: int) -> DataFrame:
    """``subject, fold, method, params, set`` with confusion counts of all linear ``models``.

    One pass over the training table. The weights of all models come to the driver and go to every task
    as one matrix, so they must be few enough: ``models.evaluate_grid`` scores them in groups of bounded
    size. A batch of rows is multiplied with it at once, and a task hands on a few numbers a model.
    """
    spark = table.sparkSession
    rows = models.select(*MODEL_KEYS, "bias", "weights").orderBy(*MODEL_KEYS).collect()
    subjects = sorted({r.subject for r in rows})
    stored = F.unwrap_udt("features")
    dense = F.when(F.size(stored["values"]) > 0, F.sequence(F.lit(0), F.size(stored["values"]) - 1)).otherwise(F.array().cast("array<int>"))
    places = [F.element_at("assigned", F.lit(s)) for s in subjects]
    place = [F.struct(p["label"].cast("bigint").alias("label"), p["fold"].cast("bigint").alias("fold")) for p in places]
    wanted = table.select(F.coalesce(stored["indices"], dense).alias("indices"), stored["values"].alias("values"), F.array(*place).alias("places"))
    if not rows:
        wanted = wanted.limit(0)
    partial = wanted.mapInArrow(_role_counts(rows, num_folds, SETS), f"model long, role long, {', '.join(c + ' long' for c in CELLS)}")
    counts = partial.groupBy("model", "role").agg(*(F.sum(c).alias(c) for c in CELLS))
    names = local_table(spark, [(i, *(r[k] for k in MODEL_KEYS)) for i, r in enumerate(rows)], "model long, subject string, fold bigint, method string, params string")
    set_name = F.get(F.array(*map(F.lit, SETS)), F.col("role").cast("int")).alias("set")
    return counts.join(F.broadcast(names), "model").select(*MODEL_KEYS, set_name, *CELLS)
