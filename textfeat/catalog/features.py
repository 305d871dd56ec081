"""Hashed features."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textfeat.catalog import corpus
from textfeat.operators import hashing
from textfeat.plans.staging import stage

NUM_BINS = 256
LENGTHS = (64, 256, 1024)


def hashed_weights(
    spark: SparkSession, sf_dir: str, lengths=(NUM_BINS,), by_document: bool = False
) -> DataFrame:
    counted = corpus.count_corpus(spark, sf_dir)
    vocabulary = stage(counted.vocabulary(corpus.MIN_DOC_PCT), "vocabulary")
    return hashing.hashed_tfidf(counted.tf, vocabulary, lengths, portable=True, by_document=by_document)


def _rounded(hashed: DataFrame) -> DataFrame:
    return hashed.select(
        "doc_id", F.col("num_bins").cast("bigint").alias("num_bins"), "bin", F.round("weight", 6).alias("weight")
    )


def hashed_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(hashed_weights(spark, sf_dir))


def hashed_tfidf_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(hashed_weights(spark, sf_dir, LENGTHS))


QUERIES = {"hashed_tfidf": hashed_tfidf, "hashed_tfidf_multi": hashed_tfidf_multi}


def hashed_sql(lengths) -> str:
    values = ", ".join(f"({n})" for n in lengths)
    return f"""{corpus.WEIGHTS_SQL},
lengths(num_bins) AS (VALUES {values}),
hashed AS (
  SELECT doc_id, num_bins::BIGINT AS num_bins,
         ('0x' || substr(md5(word), 1, 8))::BIGINT % num_bins AS bin, sum(tfidf) AS weight
  FROM weights, lengths GROUP BY ALL)"""


_SELECT = "SELECT doc_id, num_bins, bin, round(weight, 6) AS weight FROM hashed"

ORACLES = {
    "hashed_tfidf": f"WITH {hashed_sql((NUM_BINS,))} {_SELECT}",
    "hashed_tfidf_multi": f"WITH {hashed_sql(LENGTHS)} {_SELECT}",
}
