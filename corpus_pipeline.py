"""From raw documents to packed training sequences, stage by stage.

Each stage takes what the one before kept, as a table read back from Parquet, and returns documents
with all their columns; the last returns the pieces of the packed sequences.

Nulls, empty and very long texts, repeated rows and null or repeated ids are documents like any other: a
null or empty text has no words, so quality judges its shape, line_dedup leaves it, near_dedup keeps one
of all such texts, the mix takes none of it and it gives no piece. Of equal rows one stays after
near_dedup; ties go to the smaller id, nulls last, then to the hash of the text. Columns of other names
pass through every stage but the last. Empty tables give empty results at every stage.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textfeat.llm import lines, mixing, packing, quality, queries, simhash
from textfeat.llm.shared import keep, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labels, thinks to be of the best grade."""
    model = quality.train(docs, queries.ratings(table(spark, sf_dir, "labels")), queries.GRADES)
    rows = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    scored = quality.score(rows, model)
    return scored.where(F.element_at("tails", -1) >= queries.MIN_GOOD).select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later occurrences of three-line windows; ``n_chars`` follows the text."""
    found = lines.dedup(docs)
    if "n_chars" not in docs.columns:
        return found
    kind = docs.schema["n_chars"].dataType
    return found.withColumn("n_chars", F.char_length("text").cast(kind))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of SimHash near copies: three-word shingles, three bits at most."""
    return simhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of all sources by weight, a row each time a document is taken."""
    return mixing.sequence(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their token ids, sequence and place in it."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, capacity=queries.PACK_CAPACITY)


STAGES = [
    ("quality", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

# Learned weights, hashes of Spark and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
