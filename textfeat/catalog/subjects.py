"""Subjects, labels and folds."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textfeat.catalog import features, inputs
from textfeat.operators import folds as fold_ops
from textfeat.operators import subjects
from textfeat.plans import runs, sizing
from textfeat.plans.staging import stage, stage_path
from textfeat.sources import datasets
from textfeat.sources import metadata as rdf

RANKS = (1, 3, 6)
RANK_RANGE = (2, 8)
NUM_FOLDS = 4
SEED = 42


def _shown(parsed: DataFrame) -> DataFrame:
    items = F.transform("subjects", lambda s: F.concat_ws("|", s["subject"], s["taxonomy"]))
    return parsed.select("doc_id", F.array_join(F.sort_array(items), " ").alias("subjects"))


def subjects_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(rdf.last_by_path(rdf.parse_rdf(sizing.spread(inputs.rdf_files(spark, sf_dir)))))


def catalogue_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from files of many records each."""
    return _shown(rdf.read_catalogue(spark, inputs.rdf_catalogue(spark, sf_dir)))


def subjects_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subjects.flatten_subjects(inputs.metadata(spark, sf_dir))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a known quality; they stand in for those that have a vector."""
    return inputs.table(spark, sf_dir, "labels").select("doc_id")


def subject_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = subjects.with_vectors(inputs.metadata(spark, sf_dir), _labelled(spark, sf_dir))
    return subjects.subject_pairs(kept)


def subject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subjects.subject_counts(subjects.subject_pairs(inputs.metadata(spark, sf_dir)))


def subject_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subjects.pick_ranks(subject_counts(spark, sf_dir), RANKS)


def subject_rank_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subjects.rank_range(subject_counts(spark, sf_dir), *RANK_RANGE)


def one_vs_rest_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = inputs.table(spark, sf_dir, "documents").select("doc_id")
    pairs = subjects.subject_pairs(inputs.metadata(spark, sf_dir))
    return subjects.one_vs_rest(ids, pairs, subject_ranks(spark, sf_dir))


def label_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subjects.label_totals(one_vs_rest_labels(spark, sf_dir))


def stratified_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = stage(one_vs_rest_labels(spark, sf_dir), "labels")
    return fold_ops.stratified_folds(labels, NUM_FOLDS, SEED)


def fold_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold_ops.fold_roles(stratified_folds(spark, sf_dir), NUM_FOLDS)


def label_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold_ops.label_balance(stratified_folds(spark, sf_dir))


def _with_features(folds: DataFrame, hashed: DataFrame) -> DataFrame:
    """Folds joined with vectors; the vectors are shown by their entries and their sum."""
    per_doc = hashed.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_entries"), F.round(F.sum("weight"), 6).alias("sum_weight")
    )
    return fold_ops.fold_features(folds, per_doc).select(
        "subject", "doc_id", "label", "fold", "n_entries", "sum_weight"
    )


def fold_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_features(stratified_folds(spark, sf_dir), features.hashed_weights(spark, sf_dir))


def bucketed_fold_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from folds and weights that were written in buckets of documents: neither the
    grouping nor the join shuffles."""
    stored = {"folds": stratified_folds(spark, sf_dir), "weights": features.hashed_weights(spark, sf_dir)}
    paths = {name: stage_path(spark, name) for name in stored}
    for name, rows in stored.items():
        datasets.write_bucketed(rows, paths[name])
    return _with_features(*(datasets.read_bucketed(spark, path) for path in paths.values()))


def draw(spark: SparkSession, sf_dir: str, vectors: DataFrame, ranks, num_folds: int):
    """Chosen subjects and folds of the documents that have a vector."""
    return runs.draw_folds(vectors, inputs.metadata(spark, sf_dir), ranks, num_folds, SEED)


QUERIES = {
    "subjects_parse": subjects_parse,
    "catalogue_parse": catalogue_parse,
    "subjects_flat": subjects_flat,
    "subject_semi_join": subject_semi_join,
    "subject_counts": subject_counts,
    "subject_ranks": subject_ranks,
    "subject_rank_range": subject_rank_range,
    "one_vs_rest_labels": one_vs_rest_labels,
    "label_totals": label_totals,
    "stratified_folds": stratified_folds,
    "fold_roles": fold_roles,
    "label_balance": label_balance,
    "fold_features": fold_features,
    "bucketed_fold_features": bucketed_fold_features,
}

RANKED_SQL = f"""{inputs.PAIRS_SQL},
pairs AS (SELECT subject, doc_id FROM flat),
ranked AS (
  SELECT row_number() OVER (ORDER BY count(*) DESC, subject) AS rank, subject, count(*) AS n
  FROM pairs GROUP BY subject)"""


def labels_sql(ids: str, ranks) -> str:
    """Labels of the ids in table ``ids`` for the subjects of the given ranks."""
    return f"""{RANKED_SQL},
labels AS (
  SELECT r.subject, i.doc_id,
         CASE WHEN p.doc_id IS NULL THEN 0 ELSE 1 END::BIGINT AS label
  FROM (SELECT DISTINCT doc_id FROM {ids}) i
  JOIN ranked r ON r.rank IN ({", ".join(map(str, ranks))})
  LEFT JOIN (SELECT DISTINCT subject, doc_id FROM pairs) p ON p.subject = r.subject AND p.doc_id = i.doc_id)"""


def folds_sql(ids: str, ranks, num_folds: int) -> str:
    return f"""{labels_sql(ids, ranks)},
drawn AS (
  SELECT *, row_number() OVER (PARTITION BY subject, label ORDER BY md5('{SEED}:' || doc_id), doc_id) - 1 AS place,
         count(*) OVER (PARTITION BY subject, label) // {num_folds} AS per_fold
  FROM labels),
folds AS (
  SELECT subject, doc_id, label, (place // per_fold)::BIGINT AS fold
  FROM drawn WHERE per_fold > 0 AND place // per_fold < {num_folds})"""


def roles_sql(num_folds: int) -> str:
    return f"""
roles AS (
  SELECT f.*, v.valid_fold,
         CASE WHEN fold = {num_folds - 1} THEN 'Test' WHEN fold = valid_fold THEN 'Validation'
              ELSE 'Training' END AS role
  FROM folds f, (SELECT unnest(range({num_folds - 1})) AS valid_fold) v)"""


_LABELS = labels_sql("documents", RANKS)
_FOLDS = folds_sql("documents", RANKS, NUM_FOLDS)

ORACLES = {
    "subjects_parse": f"""WITH {inputs.PAIRS_SQL}
SELECT doc_id, string_agg(subject || '|' || taxonomy, ' ' ORDER BY subject || '|' || taxonomy) AS subjects
FROM flat GROUP BY doc_id""",
    "subjects_flat": f"WITH {inputs.PAIRS_SQL} SELECT doc_id, subject, taxonomy FROM flat",
    "subject_semi_join": f"""WITH {inputs.PAIRS_SQL}
SELECT subject, doc_id FROM flat WHERE doc_id IN (SELECT doc_id FROM labels)""",
    "subject_counts": f"WITH {RANKED_SQL} SELECT subject, n FROM ranked",
    "subject_ranks": f"WITH {RANKED_SQL} SELECT rank, subject, n FROM ranked WHERE rank IN {RANKS}",
    "subject_rank_range": f"""WITH {RANKED_SQL}
SELECT rank, subject, n FROM ranked WHERE rank BETWEEN {RANK_RANGE[0]} AND {RANK_RANGE[1]}""",
    "one_vs_rest_labels": f"WITH {_LABELS} SELECT subject, doc_id, label FROM labels",
    "label_totals": f"""WITH {_LABELS}
SELECT subject, count(*) FILTER (label = 1) AS n_pos, count(*) FILTER (label = 0) AS n_neg
FROM labels GROUP BY subject""",
    "stratified_folds": f"WITH {_FOLDS} SELECT subject, doc_id, label, fold FROM folds",
    "fold_roles": f"""WITH {_FOLDS},{roles_sql(NUM_FOLDS)}
SELECT subject, doc_id, label, fold, valid_fold, role FROM roles""",
    "label_balance": f"""WITH {_FOLDS}
SELECT subject, fold, label, count(*) AS n FROM folds GROUP BY ALL""",
    "fold_features": f"""WITH {features.hashed_sql((features.NUM_BINS,))},
{_FOLDS},
vectors AS (SELECT doc_id, count(*) AS n_entries, round(sum(weight), 6) AS sum_weight FROM hashed GROUP BY doc_id)
SELECT subject, doc_id, label, fold, n_entries, sum_weight FROM folds JOIN vectors USING (doc_id)""",
}
ORACLES["catalogue_parse"] = ORACLES["subjects_parse"]
ORACLES["bucketed_fold_features"] = ORACLES["fold_features"]
