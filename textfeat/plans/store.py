"""Document frequency over batches whose documents may come back.

A document counts once and a word once for each document it is in, however the texts of a document are
spread over batches. So the store knows every document and every (document, word) pair, by keys of 128
bits, and a batch adds only what is new: its state holds the documents and pairs no other batch brought.
The states of all batches then add up to what one pass over all texts gives.

Below the path lie the states as a dataset by ``batch``; beside them, hidden from readers of the states,
``_documents`` by batch and ``_pairs`` by batch and bucket. A bucket holds the pairs of the documents that
hash to it, so a batch reads the buckets of its returning documents only, and none where all are new.

A batch that is written again, with the same texts, replaces itself.
"""

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textfeat.operators import weights
from textfeat.plans import sizing
from textfeat.plans.staging import release, stage
from textfeat.sources import datasets

BUCKETS = 64

STATE_SCHEMA = "word string, df bigint, batch bigint"
DOCUMENT_SCHEMA = "d1 bigint, d2 bigint, bucket int, batch bigint"
PAIR_SCHEMA = "d1 bigint, d2 bigint, p1 bigint, p2 bigint, batch bigint, bucket int"


def _key(*columns: str | Column) -> tuple[Column, Column]:
    """Two independent hashes: 128 bits, so that keys of different values meet by chance never."""
    return F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns, F.lit("key"))


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A dataset, empty before it was first written."""
    try:
        return datasets.read_dataset(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


@dataclass(frozen=True)
class FrequencyStore:
    """Store below ``path``. ``buckets`` must be the same for all batches."""

    spark: SparkSession
    path: str
    buckets: int = BUCKETS

    def states(self) -> DataFrame:
        """``word, df, batch``: what each batch brought."""
        return _read(self.spark, self.path, STATE_SCHEMA)

    def state(self) -> DataFrame:
        """``word, df`` of all batches; the null word counts the documents."""
        return weights.merge_states(self.states())

    def documents(self) -> DataFrame:
        return _read(self.spark, f"{self.path}/_documents", DOCUMENT_SCHEMA)

    def pairs(self) -> DataFrame:
        return _read(self.spark, f"{self.path}/_pairs", PAIR_SCHEMA)

    def add(self, counts: DataFrame, batch: int) -> None:
        """Take up ``doc_id, word, ...`` with unique pairs as batch number ``batch``.

        The pairs are staged with their keys. Those of documents that no other batch brought are all new;
        only those of returning documents are looked for among the earlier pairs of these documents,
        which is a join by the pair's key, so a document with very many words spreads over all tasks.
        """
        (d1, d2), (p1, p2) = _key("doc_id"), _key("doc_id", "word")
        bucket = F.pmod(F.xxhash64(F.lit("bucket"), "doc_id"), F.lit(self.buckets)).cast("int").alias("bucket")
        keyed = counts.where("doc_id IS NOT NULL").select("word", d1.alias("d1"), d2.alias("d2"), p1.alias("p1"), p2.alias("p2"), bucket)
        rows = stage(keyed, "keyed")
        mine = stage(rows.select("d1", "d2", "bucket").distinct(), "batch-documents")
        known = self.documents().where(F.col("batch") != batch).select("d1", "d2")
        returning = stage(mine.join(known, ["d1", "d2"], "left_semi"), "returning")
        fresh, fresh_documents = rows, mine
        if not returning.isEmpty():
            ids = sizing.broadcast_if_small(returning.select("d1", "d2"))
            touched = [r.bucket for r in returning.select("bucket").distinct().collect()]
            earlier = self.pairs().where((F.col("batch") != batch) & F.col("bucket").isin(touched))
            earlier = earlier.join(ids, ["d1", "d2"], "left_semi").select("p1", "p2")
            again = rows.join(ids, ["d1", "d2"], "left_semi").join(earlier, ["p1", "p2"], "left_anti")
            fresh = rows.join(ids, ["d1", "d2"], "left_anti").unionByName(again)
            fresh_documents = mine.join(ids, ["d1", "d2"], "left_anti")
        # Staged, for the batch may be written again over what it is compared with.
        fresh, fresh_documents = stage(fresh, "fresh"), stage(fresh_documents, "fresh-documents")
        number = F.lit(batch).cast("bigint").alias("batch")
        sizes = fresh_documents.agg(F.lit(None).cast("string").alias("word"), F.count(F.lit(1)).alias("df"))
        state = weights.document_frequency(fresh).unionByName(sizes)
        by_bucket = fresh.select("d1", "d2", "p1", "p2", number, "bucket").repartition("bucket", F.pmod("p1", F.lit(8)))
        datasets.write_dataset(by_bucket, f"{self.path}/_pairs", ["batch", "bucket"])
        datasets.write_dataset(fresh_documents.select("d1", "d2", "bucket", number), f"{self.path}/_documents", ["batch"])
        datasets.write_dataset(state.select("word", "df", number), self.path, ["batch"])
        for table in (rows, mine, returning, fresh, fresh_documents):
            release(table)
