"""Feature hashing."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textfeat.functions import scores
from textfeat.operators import weights
from textfeat.plans import sizing


def bin_vocabulary(idf: DataFrame, lengths: Sequence[int], portable: bool = False) -> DataFrame:
    """``word, df, idf, bins array<struct<num_bins, bin>>``: each word is hashed once per length,
    not once per document it is in."""
    word = F.col("word")
    bins = [
        F.struct(
            F.lit(int(n)).cast("int").alias("num_bins"),
            scores.hash_bin(word, n, portable).alias("bin"),
        )
        for n in lengths
    ]
    return idf.select("word", "df", "idf", F.array(*bins).alias("bins"))


def hashed_tfidf(
    tf: DataFrame,
    idf: DataFrame,
    lengths: Sequence[int],
    portable: bool = False,
    max_rows: int = sizing.BROADCAST_ROWS,
    by_document: bool = False,
) -> DataFrame:
    """``doc_id, num_bins, bin, weight``: TF-IDF weights that share a bin add up.

    All lengths come out of one pass over ``tf``. ``by_document`` is for results that go on to
    ``assemble_vectors``: rows are shuffled once by document, before they are multiplied by the
    lengths, which serves both steps. A document then brings at most the rows of ``idf`` to one
    task, so it is only done where these are at most ``max_rows``.
    """
    joined = weights.join_vocabulary(tf, bin_vocabulary(idf, lengths, portable), max_rows)
    rows = joined.select("doc_id", "bins", (F.col("tf") * F.col("idf")).alias("weight"))
    by_document = by_document and sizing.within(idf, max_rows)
    if by_document and len(lengths) > 1:
        rows = rows.repartition("doc_id")
    rows = rows.select("doc_id", "weight", F.inline("bins"))
    if by_document and len(lengths) == 1:
        rows = rows.repartition("doc_id")
    return rows.groupBy("doc_id", "num_bins", "bin").agg(F.sum("weight").alias("weight"))


def hash_weights(tfidf: DataFrame, num_bins: int, portable: bool = False) -> DataFrame:
    """``doc_id, num_bins, bin, weight`` from named weights at one length."""
    bins = scores.hash_bin(F.col("word"), num_bins, portable).alias("bin")
    grouped = tfidf.groupBy("doc_id", F.lit(int(num_bins)).cast("int").alias("num_bins"), bins)
    return grouped.agg(F.sum("tfidf").alias("weight"))


def assemble_vectors(hashed: DataFrame) -> DataFrame:
    """``doc_id, num_bins, features``: sparse vectors in their storage form.

    A list holds at most ``num_bins`` entries. ``sources.datasets`` writes the result and
    reads it back as ML vectors.
    """
    entries = F.sort_array(F.collect_list(F.struct(F.col("bin").cast("int").alias("bin"), "weight")))
    lists = hashed.groupBy("doc_id", "num_bins").agg(entries.alias("entries"))
    features = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.col("num_bins").alias("size"),
        F.col("entries.bin").alias("indices"),
        F.col("entries.weight").alias("values"),
    )
    return lists.select("doc_id", "num_bins", features.alias("features"))
