"""Subjects of documents and their ranks."""

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def flatten_subjects(metadata: DataFrame) -> DataFrame:
    """``doc_id, subject, taxonomy``, one row per listed subject."""
    return metadata.select("doc_id", F.inline("subjects"))


def subject_pairs(metadata: DataFrame) -> DataFrame:
    """``subject, doc_id``; a subject listed under two taxonomies gives two rows."""
    return flatten_subjects(metadata).where("subject IS NOT NULL").select("subject", "doc_id")


def with_vectors(metadata: DataFrame, vectors: DataFrame) -> DataFrame:
    """Metadata of the documents that have a vector."""
    return metadata.join(vectors.select("doc_id"), "doc_id", "left_semi")


def subject_counts(pairs: DataFrame) -> DataFrame:
    """``subject, n``, repeated pairs counted."""
    return pairs.groupBy("subject").agg(F.count(F.lit(1)).alias("n"))


def rank_range(counts: DataFrame, first: int, last: int) -> DataFrame:
    """``rank, subject, n`` of the subjects ranked ``first`` to ``last``, 1 being the most
    frequent; ties go by name. Only the ``last`` highest rows are brought together."""
    top = counts.orderBy(F.desc("n"), "subject").limit(last)
    rank = F.row_number().over(W.orderBy(F.desc("n"), "subject")).cast("bigint").alias("rank")
    return top.select(rank, "subject", "n").where(F.col("rank").between(first, last))


def pick_ranks(counts: DataFrame, ranks: Collection[int]) -> DataFrame:
    """``rank, subject, n`` of the given ranks."""
    return rank_range(counts, min(ranks), max(ranks)).where(F.col("rank").isin(list(ranks)))


def one_vs_rest(ids: DataFrame, pairs: DataFrame, chosen: DataFrame) -> DataFrame:
    """``subject, doc_id, label`` for every id and chosen subject; label 1 where listed.

    ``chosen`` is a short list such as ``pick_ranks`` returns. It enters as one array, so each
    id is repeated in place, and documents and subjects are matched by a single join on the id.
    """
    listed = chosen.agg(F.sort_array(F.collect_set("subject"))).scalar()
    ids = ids.select("doc_id").distinct()
    hits = pairs.where(F.array_contains(listed, F.col("subject")))
    hits = hits.groupBy("doc_id").agg(F.collect_set("subject").alias("hits"))
    rows = ids.join(hits, "doc_id", "left").select("doc_id", "hits", F.explode(listed).alias("subject"))
    label = F.coalesce(F.array_contains("hits", F.col("subject")), F.lit(False)).cast("bigint")
    return rows.select("subject", "doc_id", label.alias("label"))


def label_totals(labels: DataFrame) -> DataFrame:
    """``subject, n_pos, n_neg``."""
    return labels.groupBy("subject").agg(
        F.count_if(F.col("label") == 1).alias("n_pos"),
        F.count_if(F.col("label") == 0).alias("n_neg"),
    )
