"""Counts, document frequency, IDF, TF and TF-IDF."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textfeat.catalog import inputs
from textfeat.catalog.cleaning import FOOTER_SQL, HEADER_SQL, ID_SQL, STOP_SQL, TOKENS_SQL
from textfeat.functions import scores
from textfeat.operators import clean, index, terms, weights
from textfeat.plans import runs
from textfeat.plans.staging import release, stage, stage_path
from textfeat.plans.store import FrequencyStore
from textfeat.sources import library
from textfeat.streaming import frequency

MIN_DOC_PCT = 1.0
BATCHES = 4
BLOCK_SIZE = 256


def _six(column: str) -> F.Column:
    return F.round(column, 6).alias(column)


def count_corpus(spark: SparkSession, sf_dir: str) -> runs.Corpus:
    return runs.count_corpus(inputs.documents(spark, sf_dir))


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.term_counts(inputs.documents(spark, sf_dir), once=True)


def doc_term_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = terms.frequency_lists(inputs.documents(spark, sf_dir), once=True)
    items = F.transform("terms", lambda t: F.concat_ws(":", t["word"], t["cnt"].cast("string")))
    return lists.select(
        "doc_id", "part", F.size("terms").cast("bigint").alias("n_terms"), F.array_join(items, " ").alias("terms")
    )


def max_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.highest_counts(inputs.documents(spark, sf_dir), once=True)


def document_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weights.document_frequency(word_count(spark, sf_dir))


def corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = count_corpus(spark, sf_dir)
    n_docs = corpus.size.scalar()
    sizes = weights.state_frequency(corpus.state).agg(
        F.count(F.lit(1)).alias("vocab_size"),
        F.count_if(scores.keeps_share(F.col("df"), n_docs, MIN_DOC_PCT)).alias("pruned_vocab_size"),
    )
    kept = corpus.vocabulary(MIN_DOC_PCT)
    with_vector = weights.corpus_size(weights.join_vocabulary(corpus.tf, stage(kept, "vocabulary")))
    return sizes.select(
        n_docs.alias("n_docs"), "vocab_size", "pruned_vocab_size", with_vector.scalar().alias("n_vectors")
    )


def _state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(runs.frequency_state(inputs.documents(spark, sf_dir), once=True), "state")


def idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weights.state_idf(_state(spark, sf_dir)).select("word", "df", _six("idf"))


def vocab_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = weights.state_idf(_state(spark, sf_dir), MIN_DOC_PCT)
    return kept.select("word", "df", _six("idf"))


def term_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = terms.term_counts(inputs.documents(spark, sf_dir), with_max=True, once=True)
    return terms.term_frequency(counts).select("doc_id", "word", _six("tf"))


def _weights(corpus: runs.Corpus, min_doc_pct: float = 0.0) -> DataFrame:
    return weights.tfidf(corpus.tf, stage(corpus.vocabulary(min_doc_pct), "vocabulary"))


def tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weights(count_corpus(spark, sf_dir)).select("doc_id", "word", _six("tfidf"))


def tfidf_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = count_corpus(spark, sf_dir)
    vectors = terms.term_lists(_weights(corpus, MIN_DOC_PCT), "tfidf", "vector")
    total = F.aggregate("vector", F.lit(0.0), lambda acc, t: acc + t["tfidf"])
    return vectors.select(
        "doc_id",
        "part",
        F.size("vector").cast("bigint").alias("n_terms"),
        F.round(total, 6).alias("sum_tfidf"),
        F.array_join("vector.word", " ").alias("words"),
    )


def inverted_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = terms.term_counts(inputs.documents(spark, sf_dir), with_max=True, once=True)
    blocks = index.inverted_index(terms.term_frequency(counts), BLOCK_SIZE)
    total = F.aggregate("postings", F.lit(0.0), lambda acc, p: acc + p["tf"])
    ids = F.transform("postings.doc_id", lambda d: d.cast("string"))
    return blocks.select(
        "word",
        "block",
        F.size("postings").cast("bigint").alias("n_postings"),
        F.round(total, 6).alias("sum_tf"),
        F.array_join(ids, " ").alias("doc_ids"),
    )


def _written_index(spark: SparkSession, sf_dir: str) -> str:
    path = stage_path(spark, "index")
    counts = terms.term_counts(inputs.documents(spark, sf_dir), with_max=True, once=True)
    index.write_index(terms.term_frequency(counts), path, BLOCK_SIZE)
    release(counts)
    return path


def index_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights from the written index alone."""
    return index.index_tfidf(spark, _written_index(spark, sf_dir)).select("doc_id", "word", _six("tfidf"))


def index_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted blocks of the words that many documents have."""
    path = _written_index(spark, sf_dir)
    vocabulary = stage(index.index_vocabulary(spark, path, MIN_DOC_PCT), "vocabulary")
    blocks = index.weighted_index(spark, path, vocabulary)
    total = F.aggregate("weights", F.lit(0.0), lambda acc, w: acc + w["tfidf"])
    return blocks.select("word", "block", F.size("weights").cast("bigint").alias("n_postings"), F.round(total, 6).alias("sum_tfidf"))


def _batch_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequency states of the batches of documents, written and read back."""
    batch = (F.col("doc_id") % BATCHES).alias("batch")
    docs = inputs.documents(spark, sf_dir).select("doc_id", "body", batch)
    path = stage_path(spark, "states")
    frequency.write_states(runs.frequency_state(docs, keys=["batch"]), path)
    return frequency.read_state(spark, path)


def df_batch_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = _batch_states(spark, sf_dir)
    return weights.state_frequency(weights.merge_states(states))


def df_resume_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = _batch_states(spark, sf_dir)
    saved = weights.merge_states(states.where(F.col("batch") < BATCHES - 1))
    saved = stage(saved, "saved")
    merged = stage(weights.merge_states(saved, states.where(F.col("batch") == BATCHES - 1)), "merged")
    return weights.state_idf(merged).select("word", "df", _six("idf"))


def _shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as texts that share the id of their conversation."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return turns.select(F.col("conv_id").alias("doc_id"), F.col("text").alias("body"))


def shared_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.term_counts(_shared(spark, sf_dir))


def shared_term_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = terms.frequency_lists(_shared(spark, sf_dir))
    items = F.transform("terms", lambda t: F.concat_ws(":", t["word"], t["cnt"].cast("string")))
    return lists.select(
        "doc_id", "part", F.size("terms").cast("bigint").alias("n_terms"), F.array_join(items, " ").alias("terms")
    )


def shared_document_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = stage(runs.frequency_state(_shared(spark, sf_dir)), "state")
    return weights.state_frequency(state)


def shared_max_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.highest_counts(_shared(spark, sf_dir))


def shared_batch_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations whose turns come in ``BATCHES`` batches, so that every id comes back; the second
    batch comes twice."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    store = FrequencyStore(spark, stage_path(spark, "store"))
    for batch in (*range(BATCHES), 1):
        part = turns.where(F.col("turn") % BATCHES == batch)
        counts = terms.term_counts(part.select(F.col("conv_id").alias("doc_id"), F.col("text").alias("body")))
        store.add(counts, batch)
        release(counts)
    return weights.state_frequency(store.state())


def library_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From books to counts: ids, bodies between the markers, words without those of a stop-word file."""
    path = stage_path(spark, "stop-words")
    lines = [(",".join(inputs.STOP_WORDS[:3]),), (",".join(inputs.STOP_WORDS[3:]),)]
    spark.createDataFrame(lines, "value string").write.text(path)
    books = clean.identify(inputs.books(spark, sf_dir))
    return terms.term_counts(books, stop_words=library.read_stop_words(spark, path))


QUERIES = {
    "word_count": word_count,
    "doc_term_list": doc_term_list,
    "max_tf": max_tf,
    "document_frequency": document_frequency,
    "corpus_stats": corpus_stats,
    "idf": idf,
    "vocab_prune": vocab_prune,
    "term_frequency": term_frequency,
    "tfidf": tfidf,
    "tfidf_vector": tfidf_vector,
    "inverted_index": inverted_index,
    "index_tfidf": index_tfidf,
    "index_weights": index_weights,
    "df_batch_merge": df_batch_merge,
    "df_resume_merge": df_resume_merge,
    "shared_word_count": shared_word_count,
    "shared_term_list": shared_term_list,
    "shared_document_frequency": shared_document_frequency,
    "shared_max_tf": shared_max_tf,
    "shared_batch_merge": shared_batch_merge,
    "library_counts": library_counts,
}

COUNTS_SQL = f"""{TOKENS_SQL},
counts AS (SELECT doc_id, word, count(*) AS cnt FROM tokens GROUP BY doc_id, word)"""

IDF_SQL = f"""{COUNTS_SQL},
size AS (SELECT count(DISTINCT doc_id) AS n_docs FROM counts),
freq AS (SELECT word, count(*) AS df FROM counts GROUP BY word),
idf AS (SELECT word, df, ln(n_docs::DOUBLE / df) AS idf FROM freq, size)"""

PRUNED_SQL = f"""{IDF_SQL},
kept AS (SELECT word, df, idf FROM idf, size WHERE df * 100.0 >= {MIN_DOC_PCT} * n_docs)"""

TF_SQL = """
peak AS (SELECT doc_id, max(cnt) AS max_cnt FROM counts GROUP BY doc_id),
tf AS (SELECT doc_id, word, cnt::DOUBLE / max_cnt AS tf FROM counts JOIN peak USING (doc_id))"""

WEIGHTS_SQL = f"""{PRUNED_SQL},{TF_SQL},
weights AS (SELECT doc_id, word, tf * idf AS tfidf FROM tf JOIN kept USING (word))"""

_SHARED_SQL = f"documents AS (SELECT conv_id AS doc_id, text FROM conversations), {COUNTS_SQL}"

_SHARED_DF_SQL = f"WITH {_SHARED_SQL} SELECT word, count(*) AS df FROM counts GROUP BY word"
_DF_SQL = f"WITH {COUNTS_SQL} SELECT word, count(*) AS df FROM counts GROUP BY word"
_TFIDF_SQL = f"""WITH {IDF_SQL},{TF_SQL}
SELECT doc_id, word, round(tf * idf, 6) AS tfidf FROM tf JOIN idf USING (word)"""
_IDF_SQL = f"WITH {IDF_SQL} SELECT word, df, round(idf, 6) AS idf FROM idf"

ORACLES = {
    "word_count": f"WITH {COUNTS_SQL} SELECT doc_id, word, cnt FROM counts",
    "doc_term_list": f"""WITH {COUNTS_SQL}
SELECT doc_id, 0::BIGINT AS part, count(*) AS n_terms,
       string_agg(word || ':' || cnt, ' ' ORDER BY word) AS terms
FROM counts GROUP BY doc_id""",
    "max_tf": f"WITH {COUNTS_SQL} SELECT doc_id, max(cnt) AS max_cnt FROM counts GROUP BY doc_id",
    "document_frequency": _DF_SQL,
    "corpus_stats": f"""WITH {WEIGHTS_SQL}
SELECT (SELECT n_docs FROM size) AS n_docs, (SELECT count(*) FROM freq) AS vocab_size,
       (SELECT count(*) FROM kept) AS pruned_vocab_size,
       (SELECT count(DISTINCT doc_id) FROM weights) AS n_vectors""",
    "idf": _IDF_SQL,
    "vocab_prune": f"WITH {PRUNED_SQL} SELECT word, df, round(idf, 6) AS idf FROM kept",
    "term_frequency": f"WITH {COUNTS_SQL},{TF_SQL} SELECT doc_id, word, round(tf, 6) AS tf FROM tf",
    "tfidf": _TFIDF_SQL,
    "tfidf_vector": f"""WITH {WEIGHTS_SQL}
SELECT doc_id, 0::BIGINT AS part, count(*) AS n_terms, round(sum(tfidf), 6) AS sum_tfidf,
       string_agg(word, ' ' ORDER BY word) AS words
FROM weights GROUP BY doc_id""",
    "inverted_index": f"""WITH {COUNTS_SQL},{TF_SQL}
SELECT word, doc_id // {BLOCK_SIZE} AS block, count(*) AS n_postings, round(sum(tf), 6) AS sum_tf,
       string_agg(doc_id::VARCHAR, ' ' ORDER BY doc_id) AS doc_ids
FROM tf GROUP BY ALL""",
    "index_tfidf": _TFIDF_SQL,
    "index_weights": f"""WITH {WEIGHTS_SQL}
SELECT word, doc_id // {BLOCK_SIZE} AS block, count(*) AS n_postings, round(sum(tfidf), 6) AS sum_tfidf
FROM weights GROUP BY ALL""",
    "df_batch_merge": _DF_SQL,
    "df_resume_merge": _IDF_SQL,
    "shared_word_count": f"WITH {_SHARED_SQL} SELECT doc_id, word, cnt FROM counts",
    "shared_term_list": f"""WITH {_SHARED_SQL}
SELECT doc_id, 0::BIGINT AS part, count(*) AS n_terms,
       string_agg(word || ':' || cnt, ' ' ORDER BY word) AS terms
FROM counts GROUP BY doc_id""",
    "shared_document_frequency": _SHARED_DF_SQL,
    "shared_batch_merge": _SHARED_DF_SQL,
    "shared_max_tf": f"WITH {_SHARED_SQL} SELECT doc_id, max(cnt) AS max_cnt FROM counts GROUP BY doc_id",
    "library_counts": f"""WITH {inputs.BOOKS_SQL},
bodies AS (
  SELECT try_cast(regexp_extract(text, '{ID_SQL}', 2) AS BIGINT) AS doc_id,
         string_split_regex(string_split_regex(text, '{HEADER_SQL}')[-1], '{FOOTER_SQL}')[1] AS text
  FROM books),
{COUNTS_SQL.replace("FROM documents", "FROM bodies WHERE doc_id IS NOT NULL")}
SELECT doc_id, word, cnt FROM counts WHERE word NOT IN ({STOP_SQL})""",
}
