"""Inverted index."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textfeat.operators import weights
from textfeat.plans.staging import stage
from textfeat.sources import datasets

# Ids per posting block.
BLOCK_SIZE = 65_536


def inverted_index(tf: DataFrame, block_size: int = BLOCK_SIZE) -> DataFrame:
    """``word, block, postings array<struct<doc_id, tf>>``, sorted by id.

    A block covers ``block_size`` consecutive ids, so its list is bounded by construction
    and the postings of a word found everywhere are built by many tasks. The list of a word
    is its blocks in order.
    """
    block = F.floor(F.col("doc_id") / F.lit(block_size)).alias("block")
    postings = F.array_sort(F.collect_list(F.struct("doc_id", "tf"))).alias("postings")
    return tf.groupBy("word", block).agg(postings)


def explode_index(index: DataFrame) -> DataFrame:
    """``word, doc_id, tf`` back from an index."""
    return index.select("word", F.inline("postings"))


def write_index(tf: DataFrame, path: str, block_size: int = BLOCK_SIZE) -> None:
    """Write an index with what weights need: the length of each block and the number of documents.

    Below ``path`` are ``postings`` (``word, block, n_postings, postings``) and ``size`` (``n_docs``).
    """
    blocks = inverted_index(tf, block_size)
    blocks = blocks.select("word", "block", F.size("postings").cast("bigint").alias("n_postings"), "postings")
    datasets.write_dataset(blocks, f"{path}/postings")
    datasets.write_dataset(weights.corpus_size(tf), f"{path}/size")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return datasets.read_dataset(spark, f"{path}/postings")


def index_vocabulary(spark: SparkSession, path: str, min_doc_pct: float = 0.0) -> DataFrame:
    """``word, df, idf`` of the terms in at least ``min_doc_pct`` percent of documents. Document
    frequencies are sums of the lengths of blocks, so no posting is read."""
    df = read_index(spark, path).groupBy("word").agg(F.sum("n_postings").alias("df"))
    n_docs = datasets.read_dataset(spark, f"{path}/size")
    if min_doc_pct > 0:
        df = weights.prune_vocabulary(df, n_docs, min_doc_pct)
    return weights.inverse_document_frequency(df, n_docs)


def weighted_index(spark: SparkSession, path: str, vocabulary: DataFrame) -> DataFrame:
    """``word, block, weights array<struct<doc_id, tfidf>>`` of the words of a staged ``vocabulary``.

    The join is by block of postings, not by posting, and other words are gone before a list is opened.
    """
    blocks = weights.join_vocabulary(read_index(spark, path), vocabulary)
    idf = F.col("idf")
    weighted = F.transform("postings", lambda p: F.struct(p["doc_id"].alias("doc_id"), (p["tf"] * idf).alias("tfidf")))
    return blocks.select("word", "block", weighted.alias("weights"))


def index_tfidf(spark: SparkSession, path: str, min_doc_pct: float = 0.0) -> DataFrame:
    """``doc_id, word, tfidf`` from a written index."""
    vocabulary = stage(index_vocabulary(spark, path, min_doc_pct), "vocabulary")
    return weighted_index(spark, path, vocabulary).select("word", F.inline("weights")).select("doc_id", "word", "tfidf")
