"""Subject classifiers: training, prediction and the evaluation grid."""

from collections import Counter
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from threading import Lock
from time import perf_counter
from uuid import NAMESPACE_OID, uuid5

from pyspark import inheritable_thread_target
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, LogisticRegressionModel, NaiveBayes, NaiveBayesModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from textfeat.operators import folds as fold_ops
from textfeat.operators import linear, metrics
from textfeat.plans.staging import local_table, release, stage

# Models trained at the same time; each is a few Spark jobs.
PARALLEL_FITS = 4

# Models scored in one pass, and bytes of their weights, which are broadcast.
GROUP_MODELS = 64
GROUP_BYTES = 128 << 20

RESULT_KEYS = ["subject", "method", "params", "fold", "set"]
RESULT_SCHEMA = (
    "subject string, method string, params string, fold bigint, `set` string, "
    "trainTime double, classifyTime double, "
    "truePos bigint, falsePos bigint, trueNeg bigint, falseNeg bigint"
)


@dataclass(frozen=True)
class Setting:
    """One model setting: a name for the results and an estimator over ``label, features``."""

    method: str
    params: str
    estimator: object


def naive_bayes(smoothing: float = 1.0) -> Setting:
    return Setting("NBay", str(smoothing), NaiveBayes(modelType="multinomial", smoothing=smoothing))


def decision_tree(max_depth: int = 3, max_bins: int = 10) -> Setting:
    tree = DecisionTreeClassifier(maxDepth=max_depth, maxBins=max_bins, impurity="gini", seed=0)
    return Setting("Tree", f"({max_depth}, {max_bins})", tree)


def logistic_regression(reg_type: str | None = None, reg_param: float = 0.0) -> Setting:
    """``reg_type`` is None, ``"l1"`` or ``"l2"``."""
    lr = LogisticRegression(
        maxIter=100,
        regParam=0.0 if reg_type is None else reg_param,
        elasticNetParam=1.0 if reg_type == "l1" else 0.0,
        fitIntercept=False,
        standardization=False,
    )
    return Setting("LogR", f"({reg_type}, {reg_param})", lr)


def default_grid() -> list[Setting]:
    """The settings evaluated for every subject and fold."""
    return [
        naive_bayes(0.5),
        naive_bayes(0.1),
        decision_tree(3, 5),
        decision_tree(3, 10),
        decision_tree(4, 5),
        logistic_regression(None, 0.0),
    ]


def regularised_grid() -> list[Setting]:
    """The regularised logistic regressions."""
    return [logistic_regression(kind, reg) for kind in ("l1", "l2") for reg in (0.1, 0.001)]


def labelled_points(rows: DataFrame, *others: str) -> DataFrame:
    """``label double, features`` as estimators want them, after the columns named."""
    return rows.select(*others, F.col("label").cast("double").alias("label"), "features")


def fit(setting: Setting, training: DataFrame):
    """Train on ``label, features``. Runs the jobs of the estimator."""
    return setting.estimator.copy().fit(labelled_points(training))


def predict(model, rows: DataFrame, *others: str) -> DataFrame:
    """``others, label, prediction`` of every row, both 0 or 1."""
    scored = model.transform(labelled_points(rows, *others))
    return scored.select(
        *others, F.col("label").cast("bigint").alias("label"), F.col("prediction").cast("bigint").alias("prediction")
    )


def naive_bayes_parameters(model: NaiveBayesModel, template: DataFrame) -> DataFrame:
    """``label, bin, pi, theta`` of a trained model: two values per class and bin."""
    spark = template.sparkSession
    pi, theta = model.pi.toArray(), model.theta.toArray()
    rows = [
        (label, b, float(pi[label]), float(theta[label, b]))
        for label in range(theta.shape[0])
        for b in range(theta.shape[1])
    ]
    return spark.createDataFrame(rows, "label bigint, bin bigint, pi double, theta double")


def optimality(setting: Setting, training: DataFrame) -> list[tuple[int, float, float]]:
    """``bin, class sum, distance`` of each bin for a logistic regression fitted on ``training``.

    The class sum adds up the feature over documents of label 1. At the optimum the sum weighted
    with the fitted probabilities, plus the slope of the penalty, equals it; the distance is what is
    missing, as a share of the sum over all documents. Features are non-negative. A few sums for each
    bin reach the driver, combined per task.
    """
    lr, model = setting.estimator, fit(setting, training)
    fitted = model.transform(labelled_points(training))
    fitted = fitted.select("features", "label", vector_to_array("probability")[1].alias("p"))

    def total(weight: str | None) -> Column:
        summary = Summarizer.metrics("sum")
        return (summary.summary(F.col("features"), F.col(weight)) if weight else summary.summary(F.col("features")))["sum"]

    row = fitted.agg(total("p").alias("p"), total("label").alias("y"), total(None).alias("every"), F.count(F.lit(1)).alias("n")).first()
    penalty, l1 = row.n * lr.getRegParam(), lr.getElasticNetParam()
    found = []
    for b, (p, y, every, w) in enumerate(zip(row.p, row.y, row.every, model.coefficients.toArray())):
        slope = p - y
        if not l1:
            missing = abs(slope + penalty * w)
        elif w:
            missing = abs(slope + penalty * (1 if w > 0 else -1))
        else:
            missing = max(0.0, abs(slope) - penalty)
        found.append((b, float(y), float(missing / every) if every else 0.0))
    return found


def training_table(folds: DataFrame, vectors: DataFrame) -> DataFrame:
    """``doc_id, features, assigned map<subject, struct<label, fold>>``.

    Features appear once per document however many subjects are evaluated. Stage it before
    training: every fit reads it again.
    """
    entry = F.struct("subject", F.struct("label", "fold"))
    assigned = folds.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(entry)).alias("assigned"))
    return vectors.join(assigned, "doc_id")


def subject_rows(table: DataFrame, subject: str) -> DataFrame:
    """``doc_id, label, fold, features`` of the documents drawn for one subject."""
    drawn: Column = F.element_at("assigned", F.lit(subject))
    return table.where(drawn.isNotNull()).select("doc_id", drawn["label"].alias("label"), drawn["fold"].alias("fold"), "features")


def training_rows(table: DataFrame, subject: str, valid_fold: int, num_folds: int) -> DataFrame:
    """Rows of one subject that a run learns from."""
    role = fold_ops.role(F.col("fold"), F.lit(valid_fold), num_folds)
    return subject_rows(table, subject).where(role == "Training")


Fitted = tuple[str, int, object]


def fit_runs(table: DataFrame, subjects: Sequence[str], num_folds: int, setting: Setting, parallel_fits: int = PARALLEL_FITS) -> list[Fitted]:
    """Subject, validation fold and model of every run of one setting, fitted a few at a time."""
    wanted = [(subject, valid_fold) for subject, valid_fold, _ in _runs(subjects, num_folds, [setting])]

    def run(args: tuple[str, int]) -> Fitted:
        return *args, fit(setting, training_rows(table, *args, num_folds))

    with ThreadPoolExecutor(parallel_fits) as pool:
        return list(pool.map(inheritable_thread_target(table.sparkSession)(run), wanted))


def chained_predictions(table: DataFrame, fitted: Sequence[Fitted], num_folds: int, *others: str) -> DataFrame:
    """``others, model, subject, fold, set, label, prediction`` of fitted classifiers of any kind.

    ``model`` is the place in ``fitted``, ``fold`` the validation fold of its run. Each model adds its
    predictions to the row, so the vectors are read once for all; a document has a row for every model
    whose subject it was drawn for.
    """
    rows, found = table, []
    for i, (subject, valid_fold, model) in enumerate(fitted):
        alone = model.copy({model.predictionCol: f"p{i}", model.rawPredictionCol: "", model.probabilityCol: ""})
        rows = alone.transform(rows)
        place = F.element_at("assigned", F.lit(subject))
        of_model = [F.lit(i).alias("model"), F.lit(subject).alias("subject"), F.lit(valid_fold).cast("bigint").alias("fold")]
        set_name = fold_ops.role(place["fold"], F.lit(valid_fold), num_folds).alias("set")
        label = place["label"].cast("bigint").alias("label")
        found.append(F.struct(*of_model, set_name, label, F.col(f"p{i}").cast("bigint").alias("prediction")))
    return rows.select(*others, F.inline(F.array(*found))).where("label IS NOT NULL")


def chained_confusion(table: DataFrame, fitted: Sequence[Fitted], num_folds: int) -> DataFrame:
    """``model, set`` with confusion counts of ``chained_predictions``."""
    return metrics.confusion(chained_predictions(table, fitted, num_folds), ["model", "set"])


def _rows_of(counts: DataFrame, keys: Sequence[str]) -> dict[tuple, list[tuple]]:
    """Set and cells by key."""
    found: dict[tuple, list[tuple]] = {}
    for c in counts.collect():
        cells = (c["set"], c["truePos"], c["falsePos"], c["trueNeg"], c["falseNeg"])
        found.setdefault(tuple(c[k] for k in keys), []).append(cells)
    return found


Run = tuple[str, int, Setting]


def _naive_bayes_group(table: DataFrame, runs: Sequence[Run], num_folds: int) -> list[tuple]:
    """Result rows of Naive Bayes settings: one pass for the sums of all, one for the scores of all."""
    start = perf_counter()
    subjects, params = {r[0] for r in runs}, sorted({float(r[2].params) for r in runs}, reverse=True)
    sums = linear.training_sums(linear.class_sums(table).where(F.col("subject").isin(list(subjects))), num_folds)
    fitted = stage(linear.naive_bayes(sums, params), "naive-bayes")
    train_time = perf_counter() - start
    start = perf_counter()
    try:
        wanted = {(s, v, setting.method, setting.params) for s, v, setting in runs}
        found = _rows_of(linear.confusion(table, fitted, num_folds), linear.MODEL_KEYS)
    finally:
        release(fitted)
    classify_time = perf_counter() - start
    return [
        (subject, method, param, fold, cells[0], train_time, classify_time, *cells[1:])
        for (subject, fold, method, param), sets in found.items()
        if (subject, fold, method, param) in wanted
        for cells in sets
    ]


class _TrainingSets:
    """Training sets of runs. One that several runs learn from is staged for the first of them, as
    ``label, features``, and released after the last.

    A fit reads its rows twice. Staged, they are all that it reads, neither the rows of other sets nor
    the places of documents. Runs come set by set, so few sets are there at a time.
    """

    def __init__(self, table: DataFrame, runs: Sequence[Run], num_folds: int):
        self._table, self._num_folds = table, num_folds
        self._left = Counter((subject, valid_fold) for subject, valid_fold, _ in runs)
        self._locks = {key: Lock() for key in self._left}
        self._staged: dict[tuple[str, int], DataFrame] = {}

    @contextmanager
    def rows(self, *key) -> Iterator[DataFrame]:
        rows = training_rows(self._table, *key, self._num_folds)
        try:
            with self._locks[key]:
                if key not in self._staged and self._left[key] > 1:
                    self._staged[key] = stage(rows.select("label", "features"), "training-set")
                rows = self._staged.get(key, rows)
            yield rows
        finally:
            with self._locks[key]:
                self._left[key] -= 1
                if not self._left[key] and key in self._staged:
                    release(self._staged.pop(key))


def _fitted_group(table: DataFrame, runs: Sequence[Run], num_folds: int, parallel_fits: int) -> tuple[list[tuple], list[Exception]]:
    """Result rows of settings that are fitted one by one and scored together, and what failed."""
    spark = table.sparkSession
    sets = _TrainingSets(table, runs, num_folds)

    def run(args: Run):
        subject, valid_fold, setting = args
        try:
            with sets.rows(subject, valid_fold) as training:
                start = perf_counter()
                return fit(setting, training), perf_counter() - start
        except Exception as error:  # raised when the other models are through
            return error

    with ThreadPoolExecutor(parallel_fits) as pool:
        found = list(pool.map(inheritable_thread_target(spark)(run), runs))
    errors = [f for f in found if isinstance(f, Exception)]
    done = [(r, *f) for r, f in zip(runs, found) if not isinstance(f, Exception)]
    rows: list[tuple] = []
    lines = [d for d in done if isinstance(d[1], LogisticRegressionModel)]
    others = [d for d in done if not isinstance(d[1], LogisticRegressionModel)]
    if lines:
        table_rows = [(s, v, t.method, t.params, float(m.intercept), m.coefficients.toArray().tolist()) for (s, v, t), m, _ in lines]
        start = perf_counter()
        counts = _rows_of(linear.confusion(table, local_table(spark, table_rows, linear.MODEL_SCHEMA), num_folds), linear.MODEL_KEYS)
        took = perf_counter() - start
        rows += [(s, t.method, t.params, v, c[0], train, took, *c[1:]) for (s, v, t), _, train in lines for c in counts.get((s, v, t.method, t.params), [])]
    if others:
        start = perf_counter()
        counts = _rows_of(chained_confusion(table, [(s, v, m) for (s, v, _), m, _ in others], num_folds), ["model"])
        took = perf_counter() - start
        rows += [(s, t.method, t.params, v, c[0], train, took, *c[1:]) for i, ((s, v, t), _, train) in enumerate(others) for c in counts.get((i,), [])]
    return rows, errors


def _runs(subjects: Sequence[str], num_folds: int, settings: Sequence[Setting]) -> Iterator[Run]:
    for subject in subjects:
        for valid_fold in range(num_folds - 1):
            for setting in settings:
                yield subject, valid_fold, setting


def evaluate_grid(
    table: DataFrame,
    subjects: Sequence[str],
    num_folds: int,
    settings: Sequence[Setting],
    parallel_fits: int = PARALLEL_FITS,
    path: str | None = None,
) -> DataFrame:
    """Confusion counts and seconds of every subject, validation fold, setting and set.

    ``table`` is a staged ``training_table``. Naive Bayes comes from sums that are taken once for all
    subjects and folds; other models are fitted a few at a time. Models are scored in groups of up to
    ``GROUP_MODELS``, whose weights are broadcast: one pass over the vectors for all linear models of a
    group and one for all trees. So the models of a pass share one ``classifyTime``, and those of Naive
    Bayes one ``trainTime``. Only models and counts reach the driver.

    A fit that fails does not stop the others; its error is raised after them. With ``path`` the
    rows of every group are written below it as soon as they are there, and a rerun fits only what
    is missing. Use a new path for another table.
    """
    if num_folds < 3:
        raise ValueError("two folds leave nothing to train on; use three or more")
    spark = table.sparkSession
    finished = _finished(spark, path) if path else []
    done = {(r.subject, r.method, r.params, r.fold) for r in finished}
    missing = [
        (subject, valid_fold, setting)
        for subject, valid_fold, setting in _runs(subjects, num_folds, settings)
        if (subject, setting.method, setting.params, valid_fold) not in done
    ]

    size = table.select("features").first()
    group = max(1, min(GROUP_MODELS, GROUP_BYTES // (8 * size.features.size))) if size else GROUP_MODELS
    by_sums = [r for r in missing if isinstance(r[2].estimator, NaiveBayes)]
    one_by_one = [r for r in missing if not isinstance(r[2].estimator, NaiveBayes)]
    rows: list[tuple] = []
    errors: list[Exception] = []
    for begin in range(0, len(by_sums), group):
        made = _naive_bayes_group(table, by_sums[begin : begin + group], num_folds)
        _save(spark, made, path)
        rows += made
    for begin in range(0, len(one_by_one), group):
        made, failed = _fitted_group(table, one_by_one[begin : begin + group], num_folds, parallel_fits)
        _save(spark, made, path)
        rows += made
        errors += failed
    if errors:
        raise errors[0]
    return local_table(spark, [tuple(r) for r in finished] + rows, RESULT_SCHEMA)


def _save(spark: SparkSession, rows: list[tuple], path: str | None) -> None:
    """Write the rows of a group of models below ``path``."""
    if path and rows:
        name = uuid5(NAMESPACE_OID, repr(sorted({row[:4] for row in rows}))).hex
        local_table(spark, rows, RESULT_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")


def _finished(spark: SparkSession, path: str) -> list[Row]:
    """Rows of earlier runs: three for each model."""
    try:
        saved = spark.read.schema(RESULT_SCHEMA).option("recursiveFileLookup", True).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return saved.collect()


def results_table(counts: DataFrame) -> DataFrame:
    """Result rows with metrics, in the column order of the result file."""
    scored = metrics.metrics(counts)
    return scored.select(
        *RESULT_KEYS,
        "trainTime", "classifyTime", "accuracy", "precision", "recall", "f1score",
        "truePos", "falsePos", "trueNeg", "falseNeg",
    )
