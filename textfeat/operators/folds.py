"""Stratified folds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# Leading hex digits of the digest that form a slice: 16^4 slices per class.
SLICE_DIGITS = 4


def stratified_folds(labels: DataFrame, num_folds: int, seed: int) -> DataFrame:
    """``subject, doc_id, label, fold``: per subject and class the same number of ids,
    floor(n / k), in each fold, drawn without replacement; the remainder is left out.

    The draw is the order of MD5(seed:id). A class can hold nearly all documents, so it is
    never sorted as a whole. A fold is an interval of that order, so it takes only the ids at
    which folds begin, found by ``_cuts``, to place every id within its own row: the rows of
    ``labels`` are not shuffled. They are read three times and should be staged.
    """
    if num_folds < 2:
        raise ValueError("a draw needs two or more folds")
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")))
    rows = labels.select("subject", "label", "doc_id", digest.alias("draw"))

    # At most one row per subject and class, with num_folds cuts at most.
    placed = rows.join(F.broadcast(_cuts(rows, num_folds)), ["subject", "label"])

    def is_passed(cut):
        return (cut["draw"] < F.col("draw")) | ((cut["draw"] == F.col("draw")) & (cut["doc_id"] <= F.col("doc_id")))

    fold = F.size(F.filter("cuts", is_passed)).cast("bigint").alias("fold")
    return placed.select("subject", "doc_id", "label", fold).where(F.col("fold") < num_folds)


def _cuts(rows: DataFrame, num_folds: int) -> DataFrame:
    """``subject, label, cuts array<struct<draw, doc_id>>``: where folds 1 to k begin.

    The leading digits of the digest cut a class into even slices. A running total over the
    sizes of the slices of a class, 16^4 at most, tells in which slices a fold begins, and
    only the rows of these few slices are numbered.
    """
    rows = rows.withColumn("slice", F.substring("draw", 1, SLICE_DIGITS))
    keys = ["subject", "label", "slice"]
    in_class = W.partitionBy("subject", "label")
    before = in_class.orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    slices = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).select(
        *keys,
        "n",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
        F.floor(F.sum("n").over(in_class) / num_folds).alias("per_fold"),
    )
    begins = F.transform(F.sequence(F.lit(1), F.lit(num_folds)), lambda f: f * F.col("per_fold"))
    here = F.filter(begins, lambda rank: (rank >= F.col("start")) & (rank < F.col("start") + F.col("n")))
    slices = slices.where("per_fold > 0").select(*keys, "start", here.alias("begins")).where(F.size("begins") > 0)

    # At most num_folds slices per subject and class.
    near = rows.join(F.broadcast(slices), keys)
    at = F.row_number().over(W.partitionBy(*keys).orderBy("draw", "doc_id")) - 1
    first = near.withColumn("rank", F.col("start") + at).where(F.array_contains("begins", F.col("rank")))
    return first.groupBy("subject", "label").agg(F.collect_list(F.struct("draw", "doc_id")).alias("cuts"))


def fold_roles(folds: DataFrame, num_folds: int) -> DataFrame:
    """Adds ``valid_fold`` and ``role``: the last fold is the test set of every run, fold
    ``valid_fold`` its validation set and the others its training set."""
    if num_folds < 3:
        raise ValueError("two folds leave nothing to train on; use three or more")
    runs = folds.withColumn("valid_fold", F.explode(F.sequence(F.lit(0), F.lit(num_folds - 2))))
    return runs.withColumn("valid_fold", F.col("valid_fold").cast("bigint")).withColumn(
        "role", role(F.col("fold"), F.col("valid_fold"), num_folds)
    )


def role(fold, valid_fold, num_folds: int):
    """``Test``, ``Validation`` or ``Training`` of a fold in one run."""
    return (
        F.when(fold == num_folds - 1, "Test").when(fold == valid_fold, "Validation").otherwise("Training")
    )


def fold_features(folds: DataFrame, vectors: DataFrame) -> DataFrame:
    """Folds with the columns of ``vectors``, joined by id."""
    return folds.join(vectors, "doc_id")


def label_balance(folds: DataFrame) -> DataFrame:
    """``subject, fold, label, n``."""
    return folds.groupBy("subject", "fold", "label").agg(F.count(F.lit(1)).alias("n"))
