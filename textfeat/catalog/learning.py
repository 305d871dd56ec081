"""Classifiers of the most frequent subjects and their evaluation."""

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml.feature import Binarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textfeat.catalog import features, subjects
from textfeat.operators import metrics as metric_ops
from textfeat.operators import linear, models, trees
from textfeat.plans import runs
from textfeat.plans.staging import release, stage, stage_path
from textfeat.sources import datasets

RANKS = (1, 2, 3)
NUM_FOLDS = 3
SMOOTHING = 0.5
SMOOTHINGS = (0.5, 0.1)
TREE_DEPTH = 3
TREE_CUTS = (0.0, 0.2)

# How far a fitted sum may be off, as a share of the sum over all training documents.
FIT_TOLERANCE = 0.002


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashed = features.hashed_weights(spark, sf_dir, by_document=True)
    return runs.stage_vectors(hashed, features.NUM_BINS)


def _training(spark: SparkSession, sf_dir: str, ranks=RANKS) -> tuple[DataFrame, list[str]]:
    """Staged training table and the chosen subjects."""
    vectors = _vectors(spark, sf_dir)
    chosen, folds = subjects.draw(spark, sf_dir, vectors, ranks, NUM_FOLDS)
    names = [row["subject"] for row in chosen.orderBy("rank").collect()]
    return stage(models.training_table(folds, vectors), "training"), names


def _predictions(table: DataFrame, names: list[str], setting: models.Setting) -> DataFrame:
    """Predictions of all runs of a setting, over all drawn documents of their subjects."""
    fitted = models.fit_runs(table, names, NUM_FOLDS, setting)
    found = models.chained_predictions(table, fitted, NUM_FOLDS, "doc_id")
    return found.select("subject", "fold", "doc_id", F.col("set").alias("role"), "label", "prediction")


def nb_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameters of the models of all subjects and validation folds, from sums taken once."""
    table, _ = _training(spark, sf_dir)
    sums = linear.training_sums(linear.class_sums(table), NUM_FOLDS)
    parameters = linear.naive_bayes_parameters(sums, SMOOTHING)
    return parameters.select("subject", "fold", "label", "bin", F.round("pi", 6).alias("pi"), F.round("theta", 6).alias("theta"))


def nb_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _predictions(*_training(spark, sf_dir), models.naive_bayes(SMOOTHING))


def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_ops.confusion(nb_predict(spark, sf_dir), ["subject", "fold", "role"])


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = metric_ops.metrics(confusion(spark, sf_dir))
    names = ("accuracy", "precision", "recall", "f1score")
    return scored.select("subject", "fold", "role", *[F.round(n, 6).alias(n) for n in names])


def dt_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _predictions(*_training(spark, sf_dir), models.decision_tree(3, 10))


def lr_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _predictions(*_training(spark, sf_dir), models.logistic_regression())


def dt_presence_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decision trees over the presence of bins: one threshold each, so SQL can grow them as well."""
    table, names = _training(spark, sf_dir)
    present = Binarizer(threshold=0.0, inputCol="weights", outputCol="features")
    binary = stage(present.transform(table.withColumnRenamed("features", "weights")).drop("weights"), "presence")
    release(table)
    return _predictions(binary, names, models.decision_tree(TREE_DEPTH, 10))


def dt_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trees of all subjects and validation folds, over weights in steps: what each split
    does to the training documents and what it gains, which SQL finds by growing the trees."""
    table, names = _training(spark, sf_dir)
    steps = stage(trees.levelled(table, TREE_CUTS), "steps")
    release(table)
    found = None
    for subject in names:
        for valid_fold in range(NUM_FOLDS - 1):
            rows = models.training_rows(steps, subject, valid_fold, NUM_FOLDS)
            model = models.fit(models.decision_tree(TREE_DEPTH, 10), rows)
            one = trees.tree_table(rows, trees.nodes(model))
            one = one.select(F.lit(subject).alias("subject"), F.lit(valid_fold).cast("bigint").alias("fold"), "*")
            found = one if found is None else found.unionByName(one)
    # A leaf sends nobody on and gains nothing.
    found = found.fillna(0, ["n_right", "pos_right", "gain"])
    rounded = {c: F.round(c, 6) for c in ("impurity", "gain")}
    return found.withColumns(rounded).select("subject", "fold", "node", "n", "n_pos", "n_right", "pos_right", "impurity", "gain", F.col("prediction").cast("bigint").alias("prediction"))


def lr_optimality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the logistic regressions of all subjects and validation folds are at their optimum,
    where they are fitted to the class sums.

    The derivative of the convex objective in a weight is the fitted sum of its feature, less the
    sum over the class, plus the penalty; at the optimum it is 0.
    """
    table, names = _training(spark, sf_dir)
    settings = [models.logistic_regression(), *models.regularised_grid()]

    def found(run: tuple[str, int]) -> list[tuple]:
        subject, valid_fold = run
        training = models.training_rows(table, subject, valid_fold, NUM_FOLDS)
        return [
            (subject, valid_fold, setting.params, bin_, round(total, 4), away <= FIT_TOLERANCE)
            for setting in settings
            for bin_, total, away in models.optimality(setting, training)
        ]

    runs_of_grid = [(subject, fold) for subject in names for fold in range(NUM_FOLDS - 1)]
    with ThreadPoolExecutor(models.PARALLEL_FITS) as pool:
        rows = [row for part in pool.map(inheritable_thread_target(spark)(found), runs_of_grid) for row in part]
    release(table)
    return spark.createDataFrame(
        rows, "subject string, fold bigint, params string, bin bigint, class_sum double, optimal boolean"
    )


def _grid(spark: SparkSession, sf_dir: str, settings, ranks=RANKS) -> DataFrame:
    """Counts of all models; the training table is released, as only counts are left."""
    table, names = _training(spark, sf_dir, ranks)
    counts = models.evaluate_grid(table, names, NUM_FOLDS, settings)
    release(table)
    return counts


def lr_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.results_table(_grid(spark, sf_dir, models.regularised_grid())).drop("trainTime", "classifyTime")


def _nb_results(spark: SparkSession, sf_dir: str, ranks) -> DataFrame:
    settings = [models.naive_bayes(smoothing) for smoothing in SMOOTHINGS]
    rows = models.results_table(_grid(spark, sf_dir, settings, ranks)).drop("trainTime", "classifyTime")
    names = ("accuracy", "precision", "recall", "f1score")
    return rows.withColumns({n: F.round(n, 6) for n in names})


def nb_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation of the Naive Bayes settings alone, which SQL can repeat."""
    return _nb_results(spark, sf_dir, RANKS)


def results_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results written as CSV and read back."""
    rows, path = _nb_results(spark, sf_dir, RANKS), stage_path(spark, "results")
    datasets.write_csv(rows, path)
    return spark.read.schema(rows.schema).option("header", True).csv(path)


def model_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grid(spark, sf_dir, models.default_grid()).drop("trainTime", "classifyTime")


def model_grid_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can tell of every row of the grid: class sizes of its set, and that a model is right
    more often than the larger class is large, on the set it was fitted on (false for others)."""
    tp, fp, tn, fn = (F.col(c) for c in ("truePos", "falsePos", "trueNeg", "falseNeg"))
    learned = tp + tn > F.greatest(tp + fn, fp + tn)
    return model_grid(spark, sf_dir).select(
        *models.RESULT_KEYS,
        (tp + fn).alias("n_pos"),
        (fp + tn).alias("n_neg"),
        ((F.col("set") == "Training") & learned).alias("learned"),
    )


def results_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.results_table(_grid(spark, sf_dir, models.default_grid()))


QUERIES = {
    "nb_model": nb_model,
    "nb_predict": nb_predict,
    "confusion": confusion,
    "metrics": metrics,
    "dt_predict": dt_predict,
    "lr_predict": lr_predict,
    "dt_presence_predict": dt_presence_predict,
    "dt_model": dt_model,
    "lr_optimality": lr_optimality,
    "lr_grid": lr_grid,
    "nb_grid": nb_grid,
    "results_csv": results_csv,
    "model_grid": model_grid,
    "model_grid_sets": model_grid_sets,
    "results_summary": results_summary,
}

_SMOOTHING_ROWS = ", ".join(f"({s}::DOUBLE)" for s in SMOOTHINGS)

def _roles_sql(ranks) -> str:
    return f"""{features.hashed_sql((features.NUM_BINS,))},
{subjects.folds_sql("hashed", ranks, NUM_FOLDS)},
{subjects.roles_sql(NUM_FOLDS)}"""


def _nb_sql(ranks) -> str:
    """Multinomial Naive Bayes in closed form, of every subject, validation fold and smoothing, over
    every class and bin."""
    return f"""{_roles_sql(ranks)},
smoothings(smoothing) AS (VALUES {_SMOOTHING_ROWS}),
class_sizes AS (
  SELECT subject, valid_fold, label, count(*) AS n FROM roles WHERE role = 'Training' GROUP BY ALL),
priors AS (
  SELECT subject, valid_fold, smoothing, label,
         ln(n + smoothing) - ln(sum(n) OVER w + count(*) OVER w * smoothing) AS pi
  FROM class_sizes, smoothings WINDOW w AS (PARTITION BY subject, valid_fold, smoothing)),
sums AS (
  SELECT subject, valid_fold, label, bin, sum(weight) AS total FROM roles JOIN hashed USING (doc_id)
  WHERE role = 'Training' GROUP BY ALL),
class_sums AS (SELECT subject, valid_fold, label, sum(total) AS total FROM sums GROUP BY ALL),
params AS (
  SELECT p.subject, p.valid_fold, p.smoothing, p.label, b.bin::BIGINT AS bin, p.pi,
         ln(coalesce(s.total, 0.0) + p.smoothing) - ln(c.total + {features.NUM_BINS} * p.smoothing) AS theta
  FROM priors p JOIN class_sums c ON c.subject = p.subject AND c.valid_fold = p.valid_fold AND c.label = p.label
  JOIN (SELECT unnest(range({features.NUM_BINS})) AS bin) b ON true
  LEFT JOIN sums s
    ON s.subject = p.subject AND s.valid_fold = p.valid_fold AND s.label = p.label AND s.bin = b.bin),
scored AS (
  SELECT r.subject, r.valid_fold, m.smoothing, r.doc_id, r.role, r.label, m.label AS class,
         any_value(m.pi) + sum(h.weight * m.theta) AS score
  FROM roles r JOIN hashed h ON h.doc_id = r.doc_id
  JOIN params m ON m.subject = r.subject AND m.valid_fold = r.valid_fold AND m.bin = h.bin GROUP BY ALL),
predicted AS (
  SELECT subject, valid_fold, smoothing, doc_id, role, label, arg_max(class, score) AS prediction
  FROM scored GROUP BY ALL),
cells AS (
  SELECT subject, valid_fold, smoothing, role,
         count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
         count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 1 AND prediction = 0) AS fn
  FROM predicted GROUP BY ALL),
rates AS (
  SELECT *, (tp + tn)::DOUBLE / (tp + fp + tn + fn) AS accuracy,
         coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0.0) AS p, coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0.0) AS r
  FROM cells)"""


def _gini(pos: str, n: str) -> str:
    return f"((1.0 - ({n} - {pos})::DOUBLE / {n} * (({n} - {pos})::DOUBLE / {n})) - {pos}::DOUBLE / {n} * ({pos}::DOUBLE / {n}))"


def _level_sql(k: int) -> str:
    """Documents at the nodes one level further down, in all runs. Each node is split on the bin whose
    presence lowers the Gini impurity most, the first of equals; one that none lowers stays."""
    gain = (
        f"{_gini('pos', 'n')} - (n - n1)::DOUBLE / n * {_gini('(pos - pos1)', '(n - n1)')}"
        f" - n1::DOUBLE / n * {_gini('pos1', 'n1')}"
    )
    return f""",
size{k} AS (
  SELECT subject, fold, node, count(*) AS n, sum(label) AS pos FROM at{k} WHERE role = 'Training' GROUP BY ALL),
hit{k} AS (
  SELECT subject, fold, node, bin, count(*) AS n1, sum(label) AS pos1
  FROM at{k} JOIN present USING (doc_id) WHERE role = 'Training' GROUP BY ALL),
gain{k} AS (
  SELECT subject, fold, node, bin, {gain} AS gain FROM hit{k} JOIN size{k} USING (subject, fold, node) WHERE n1 < n),
best{k} AS (
  SELECT subject, fold, node, bin FROM gain{k} WHERE gain > 0
  QUALIFY row_number() OVER (PARTITION BY subject, fold, node ORDER BY gain DESC, bin) = 1),
at{k + 1} AS (
  SELECT a.subject, a.fold, a.doc_id, a.role, a.label,
         CASE WHEN b.bin IS NULL THEN a.node WHEN p.bin IS NULL THEN 2 * a.node ELSE 2 * a.node + 1 END AS node
  FROM at{k} a LEFT JOIN best{k} b ON b.subject = a.subject AND b.fold = a.fold AND b.node = a.node
  LEFT JOIN present p ON p.doc_id = a.doc_id AND p.bin = b.bin)"""


_TREE_SQL = f"""{_roles_sql(RANKS)},
present AS (SELECT doc_id, bin FROM hashed WHERE weight > 0),
at0 AS (SELECT subject, valid_fold AS fold, doc_id, role, label, 1 AS node FROM roles)
{"".join(map(_level_sql, range(TREE_DEPTH)))},
leaves AS (
  SELECT subject, fold, node, CASE WHEN 2 * sum(label) > count(*) THEN 1 ELSE 0 END::BIGINT AS prediction
  FROM at{TREE_DEPTH} WHERE role = 'Training' GROUP BY ALL)
SELECT subject, fold, doc_id, role, label, prediction FROM at{TREE_DEPTH} JOIN leaves USING (subject, fold, node)"""

def _step_level_sql(k: int) -> str:
    """The same for all runs at once, over steps: a split parts the steps up to a cut from those above it."""
    gain = (
        f"{_gini('pos', 'n')} - (n - n1)::DOUBLE / n * {_gini('(pos - pos1)', '(n - n1)')}"
        f" - n1::DOUBLE / n * {_gini('pos1', 'n1')}"
    )
    return f""",
size{k} AS (SELECT subject, fold, node, count(*) AS n, sum(label) AS pos FROM at{k} GROUP BY ALL),
hit{k} AS (
  SELECT subject, fold, node, bin, cut, count(*) AS n1, sum(label) AS pos1
  FROM at{k} JOIN steps USING (doc_id), cuts WHERE step > cut GROUP BY ALL),
gain{k} AS (
  SELECT subject, fold, node, bin, cut, n1, pos1, {gain} AS gain
  FROM hit{k} JOIN size{k} USING (subject, fold, node) WHERE n1 < n),
best{k} AS (
  SELECT * FROM gain{k} WHERE gain > 0
  QUALIFY row_number() OVER (PARTITION BY subject, fold, node ORDER BY gain DESC, bin, cut) = 1),
at{k + 1} AS (
  SELECT a.subject, a.fold, a.doc_id, a.label,
         CASE WHEN coalesce(s.step, 0) > b.cut THEN 2 * a.node + 1 ELSE 2 * a.node END AS node
  FROM at{k} a JOIN best{k} b ON b.subject = a.subject AND b.fold = a.fold AND b.node = a.node
  LEFT JOIN steps s ON s.doc_id = a.doc_id AND s.bin = b.bin)"""


def _leaf_sql(k: int) -> str:
    """Leaves of a level, from the deepest up: nodes without a split, and those whose children are both
    leaves of one prediction, as such a split decides nothing."""
    own = "CASE WHEN 2 * pos > n THEN 1 ELSE 0 END"
    if k == TREE_DEPTH:
        return f""",
size{k} AS (SELECT subject, fold, node, count(*) AS n, sum(label) AS pos FROM at{k} GROUP BY ALL),
leaf{k} AS (SELECT subject, fold, node, {own} AS p FROM size{k})"""
    return f""",
same{k} AS (
  SELECT subject, fold, node // 2 AS node FROM leaf{k + 1} GROUP BY ALL HAVING count(*) = 2 AND min(p) = max(p)),
leaf{k} AS (
  SELECT subject, fold, node, {own} AS p FROM size{k}
  WHERE (subject, fold, node) IN (SELECT (subject, fold, node) FROM same{k})
     OR (subject, fold, node) NOT IN (SELECT (subject, fold, node) FROM best{k}))"""


def _nodes_sql(k: int) -> str:
    """Nodes of a level below split ones of the level above, with their splits."""
    above = f" WHERE (subject, fold, node // 2) IN (SELECT (subject, fold, node) FROM split{k - 1})" if k else ""
    if k == TREE_DEPTH:
        return f""",
nodes{k} AS (SELECT *, 0 AS n1, 0 AS pos1, 0.0 AS gain FROM size{k}{above})"""
    return f""",
kept{k} AS (SELECT * FROM size{k}{above}),
split{k} AS (
  SELECT * FROM best{k}
  WHERE (subject, fold, node) IN (SELECT (subject, fold, node) FROM kept{k})
    AND (subject, fold, node) NOT IN (SELECT (subject, fold, node) FROM leaf{k})),
nodes{k} AS (
  SELECT k.*, coalesce(n1, 0) AS n1, coalesce(pos1, 0) AS pos1, coalesce(gain, 0.0) AS gain
  FROM kept{k} k LEFT JOIN split{k} USING (subject, fold, node))"""


_STEP_TREE_SQL = f"""{_roles_sql(RANKS)},
steps AS (SELECT doc_id, bin, {" + ".join(f"(weight > {c})::INT" for c in TREE_CUTS)} AS step FROM hashed),
cuts(cut) AS (VALUES {", ".join(f"({i})" for i in range(len(TREE_CUTS)))}),
at0 AS (SELECT subject, valid_fold AS fold, doc_id, label, 1 AS node FROM roles WHERE role = 'Training')
{"".join(map(_step_level_sql, range(TREE_DEPTH)))}{"".join(map(_leaf_sql, range(TREE_DEPTH, -1, -1)))}
{"".join(map(_nodes_sql, range(TREE_DEPTH + 1)))},
nodes AS ({" UNION ALL ".join(f"SELECT subject, fold, node, n, pos, n1, pos1, gain FROM nodes{k}" for k in range(TREE_DEPTH + 1))})
SELECT subject, fold, node::BIGINT AS node, n, pos::BIGINT AS n_pos, n1::BIGINT AS n_right, pos1::BIGINT AS pos_right,
       round({_gini("pos", "n")}, 6) AS impurity, round(gain, 6) AS gain,
       CASE WHEN 2 * pos > n THEN 1 ELSE 0 END::BIGINT AS prediction
FROM nodes"""

_NB_SQL = _nb_sql(RANKS)


# Names of the settings, as models need a session to be made.
_GRID_ROWS = "('NBay', '0.5'), ('NBay', '0.1'), ('Tree', '(3, 5)'), ('Tree', '(3, 10)'), ('Tree', '(4, 5)'), ('LogR', '(None, 0.0)')"
_REGRESSION_ROWS = "('(None, 0.0)'), ('(l1, 0.1)'), ('(l1, 0.001)'), ('(l2, 0.1)'), ('(l2, 0.001)')"

_RUN_SQL = f"smoothing = {SMOOTHING}"
_KEYS_SQL = "subject, valid_fold AS fold"
_RATES_SQL = """round(accuracy, 6) AS accuracy, round(p, 6) AS "precision", round(r, 6) AS recall,
       round(coalesce(2 * p * r / nullif(p + r, 0), 0.0), 6) AS f1score"""
_CELLS_SQL = 'tp AS "truePos", fp AS "falsePos", tn AS "trueNeg", fn AS "falseNeg"'
_RESULTS_SQL = f"""SELECT subject, 'NBay' AS method, CASE WHEN smoothing = 0.5 THEN '0.5' ELSE '0.1' END AS params,
       valid_fold AS fold, role AS "set", {_RATES_SQL}, {_CELLS_SQL}
FROM rates"""

ORACLES = {
    "nb_model": f"""WITH {_NB_SQL}
SELECT {_KEYS_SQL}, label, bin, round(pi, 6) AS pi, round(theta, 6) AS theta FROM params WHERE {_RUN_SQL}""",
    "nb_predict": f"WITH {_NB_SQL} SELECT {_KEYS_SQL}, doc_id, role, label, prediction FROM predicted WHERE {_RUN_SQL}",
    "confusion": f"WITH {_NB_SQL} SELECT {_KEYS_SQL}, role, {_CELLS_SQL} FROM cells WHERE {_RUN_SQL}",
    "metrics": f"WITH {_NB_SQL} SELECT {_KEYS_SQL}, role, {_RATES_SQL} FROM rates WHERE {_RUN_SQL}",
    "nb_grid": f"WITH {_NB_SQL} {_RESULTS_SQL}",
    "results_csv": f"WITH {_NB_SQL} {_RESULTS_SQL}",
    "dt_presence_predict": f"WITH {_TREE_SQL}",
    "dt_model": f"WITH {_STEP_TREE_SQL}",
    "lr_optimality": f"""WITH {_roles_sql(RANKS)},
settings(params) AS (VALUES {_REGRESSION_ROWS}),
fits AS (SELECT DISTINCT subject, valid_fold FROM roles),
sums AS (
  SELECT subject, valid_fold, bin, sum(weight) FILTER (label = 1) AS total FROM roles JOIN hashed USING (doc_id)
  WHERE role = 'Training' GROUP BY ALL)
SELECT f.subject, f.valid_fold AS fold, params, b.bin::BIGINT AS bin, round(coalesce(total, 0.0), 4) AS class_sum, true AS optimal
FROM fits f, settings, (SELECT unnest(range({features.NUM_BINS})) AS bin) b
LEFT JOIN sums s ON s.subject = f.subject AND s.valid_fold = f.valid_fold AND s.bin = b.bin""",
    "model_grid_sets": f"""WITH {_roles_sql(RANKS)},
settings(method, params) AS (VALUES {_GRID_ROWS})
SELECT subject, method, params, valid_fold AS fold, role AS "set",
       count(*) FILTER (label = 1) AS n_pos, count(*) FILTER (label = 0) AS n_neg,
       role = 'Training' AS learned
FROM roles, settings GROUP BY ALL""",
}
