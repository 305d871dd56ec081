"""Document frequency, IDF and TF-IDF."""

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textfeat.functions import scores
from textfeat.plans import sizing


def document_frequency(counts: DataFrame) -> DataFrame:
    """``word, df`` from ``doc_id, word, ...`` with unique pairs."""
    return counts.groupBy("word").agg(F.count(F.lit(1)).alias("df"))


def corpus_size(counts: DataFrame) -> DataFrame:
    """``n_docs``: one row, the number of documents with at least one counted word."""
    return counts.agg(F.countDistinct("doc_id").alias("n_docs"))


def inverse_document_frequency(df: DataFrame, n_docs: DataFrame) -> DataFrame:
    """``word, df, idf``; ``n_docs`` is a one-row table, used as a scalar subquery."""
    idf = scores.inverse_frequency(F.col("df"), n_docs.select("n_docs").scalar())
    return df.select("word", "df", idf.alias("idf"))


def prune_vocabulary(df: DataFrame, n_docs: DataFrame, min_doc_pct: float) -> DataFrame:
    """Terms found in at least ``min_doc_pct`` percent of the documents, compared on counts.

    What is left is bounded whatever the corpus: with w different words in a mean document
    at most 100 * w / ``min_doc_pct`` terms reach the limit.
    """
    n = n_docs.select("n_docs").scalar()
    return df.where(scores.keeps_share(F.col("df"), n, min_doc_pct))


def join_vocabulary(tf: DataFrame, vocabulary: DataFrame, max_rows: int = sizing.BROADCAST_ROWS) -> DataFrame:
    """Rows of ``tf`` with the columns of their ``word`` in ``vocabulary``; others drop.

    ``vocabulary`` needs ``df`` and should be staged, as it is measured. A small one is
    broadcast and ``tf`` is not shuffled at all. Another is split at a document frequency that
    leaves fewer than ``max_rows`` frequent words: those are broadcast, which covers most rows
    of ``tf`` and the hot words, and only rows with rare words are shuffled.
    """
    if sizing.is_small(vocabulary, max_rows):
        return tf.join(F.broadcast(vocabulary), "word")
    total = vocabulary.agg(F.sum("df")).first()[0]
    # df adds up to total, so fewer than total / frequent_df words lie above frequent_df.
    frequent_df = ceil(total / max_rows)
    is_frequent = (F.col("df") > frequent_df) & (F.octet_length("word") <= sizing.BYTES_PER_ROW)
    frequent, rare = vocabulary.where(is_frequent), vocabulary.where(~is_frequent)
    with_frequent = tf.join(F.broadcast(frequent), "word")
    without_frequent = tf.join(F.broadcast(frequent.select("word")), "word", "left_anti")
    return with_frequent.unionByName(without_frequent.join(rare, "word"))


def tfidf(tf: DataFrame, idf: DataFrame, max_rows: int = sizing.BROADCAST_ROWS) -> DataFrame:
    """``doc_id, word, tfidf``; words missing from ``idf`` drop out."""
    joined = join_vocabulary(tf, idf.select("word", "df", "idf"), max_rows)
    return joined.select("doc_id", "word", (F.col("tf") * F.col("idf")).alias("tfidf"))


# Document-frequency state: a row per word, and one row whose word is null and whose df counts
# the documents. Batches, where told apart by a column, each have such rows; all add up under
# the same rule.


def frequency_state(counts: DataFrame, *keys: str) -> DataFrame:
    """``keys, word, df``: the state of ``counts``, of each batch where ``keys`` tell batches
    apart. Stage ``counts`` before: they are read twice."""
    sizes = counts.groupBy(*keys).agg(F.countDistinct("doc_id").alias("n_docs"))
    return sized_state(counts, sizes, *keys)


def sized_state(counts: DataFrame, sizes: DataFrame, *keys: str) -> DataFrame:
    """The same state where the ``keys, n_docs`` of ``counts`` are known."""
    words = counts.groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("df"))
    return words.unionByName(sizes.select(*keys, F.lit(None).cast("string").alias("word"), F.col("n_docs").alias("df")))


def frequency_state_in_place(rows: DataFrame, *keys: str) -> DataFrame:
    """The same state from ``terms.count_in_place``, in one pass: a text hands on its words
    and a null word that counts the text itself."""
    text = F.array(F.lit(None).cast("string"))
    words = rows.select(*keys, F.explode_outer(F.concat("terms.word", text)).alias("word"))
    return words.groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("df"))


def merge_states(*states: DataFrame) -> DataFrame:
    """Sum of batches; one table holding several batches will do as well.

    Right where no document is in two batches. Where documents come back, take the states of a
    ``plans.store.FrequencyStore``, which hold only what is new."""
    merged = states[0].select("word", "df")
    for state in states[1:]:
        merged = merged.unionByName(state.select("word", "df"))
    return merged.groupBy("word").agg(F.sum("df").alias("df"))


def state_size(state: DataFrame) -> DataFrame:
    """``n_docs`` of a merged state, one row."""
    return state.where("word IS NULL").select(F.col("df").alias("n_docs"))


def state_frequency(state: DataFrame) -> DataFrame:
    """``word, df`` of a merged state."""
    return state.where("word IS NOT NULL")


def state_idf(state: DataFrame, min_doc_pct: float = 0.0, n_docs: DataFrame | None = None) -> DataFrame:
    """``word, df, idf`` of the terms in at least ``min_doc_pct`` percent of the documents of
    a state; a merged one should be staged, as it is read twice. Where ``n_docs``, one row, is known,
    it is not looked for among the words."""
    df, n_docs = state_frequency(state), state_size(state) if n_docs is None else n_docs
    if min_doc_pct > 0:
        df = prune_vocabulary(df, n_docs, min_doc_pct)
    return inverse_document_frequency(df, n_docs)
