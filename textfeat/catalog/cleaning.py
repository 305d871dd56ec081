"""Files, markers and tokens."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textfeat.catalog import inputs
from textfeat.functions import names, patterns, text
from textfeat.operators import clean, terms
from textfeat.plans import sizing

STOP_SQL = ", ".join(f"'{w}'" for w in inputs.STOP_WORDS)

# SQL reads the same patterns.
HEADER_SQL, FOOTER_SQL, ID_SQL = patterns.HEADER_END, patterns.FOOTER_START, patterns.DOCUMENT_ID

TOKENS_SQL = r"""
tokens AS (
  SELECT doc_id, lower(w) AS word
  FROM (SELECT doc_id, unnest(string_split_regex(text, '[^A-Za-zÀ-ƿ''\-]+|-{2,}')) AS w FROM documents)
  WHERE w <> '')"""


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts whose lines end in one of three ways, the last one too, as read from files."""
    d = F.col("doc_id")
    end = F.when(d % 3 == 0, "\r\n").when(d % 3 == 1, "\r").otherwise("\n")
    raw = F.concat(F.replace("text", F.lit("\n"), end), end)
    return inputs.table(spark, sf_dir, "documents").select("doc_id", text.normalise_newlines(raw).alias("text"))


def doc_size_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.eligible_files(inputs.files(spark, sf_dir), inputs.MAX_MIB).select("doc_id", "name", "n_bytes")


def strip_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = inputs.files(spark, sf_dir)
    return files.select("doc_id", "name", names.strip_suffix(F.col("name")).alias("stripped"))


def encoding_pref(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = inputs.files(spark, sf_dir)
    return files.select("doc_id", "name", names.encoding_preference(F.col("name")).alias("pref"))


def doc_variant_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.dedupe_variants(inputs.files(spark, sf_dir))


def doc_id_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    books = sizing.spread(inputs.books(spark, sf_dir))
    return books.select("doc_id", text.document_id(F.col("text")).alias("ebook_id"))


def strip_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sizing.spread(inputs.books(spark, sf_dir)).select("doc_id", text.strip_header(F.col("text")).alias("body"))


def strip_boilerplate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.identify(sizing.spread(inputs.books(spark, sf_dir)), keep_unidentified=True)


def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.tokenize(sizing.spread(inputs.documents(spark, sf_dir)))


def stopword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    stop_words = spark.createDataFrame([(w,) for w in inputs.STOP_WORDS], "word string")
    return terms.remove_stop_words(tokenize(spark, sf_dir), stop_words).select("doc_id", "word")


QUERIES = {
    "text_lines": text_lines,
    "doc_size_filter": doc_size_filter,
    "strip_suffix": strip_suffix,
    "encoding_pref": encoding_pref,
    "doc_variant_dedupe": doc_variant_dedupe,
    "doc_id_extract": doc_id_extract,
    "strip_header": strip_header,
    "strip_boilerplate": strip_boilerplate,
    "tokenize": tokenize,
    "stopword_filter": stopword_filter,
}

_PREF_SQL = r"""CASE WHEN regexp_matches(name, '^\d+-0\.txt') THEN 0
       WHEN regexp_matches(name, '^\d+-8.txt') THEN 2 ELSE 1 END::BIGINT"""
_STRIPPED_SQL = r"regexp_replace(name, '(\d+)(-\d+)(/|\.txt)', '\1\3', 'g')"

ORACLES = {
    "text_lines": "SELECT doc_id, text FROM documents",
    "doc_size_filter": f"""WITH {inputs.FILES_SQL}
SELECT doc_id, name, n_bytes FROM files
WHERE name LIKE '%.txt' AND n_bytes <= {inputs.MAX_MIB} * 1048576""",
    "strip_suffix": f"WITH {inputs.FILES_SQL} SELECT doc_id, name, {_STRIPPED_SQL} AS stripped FROM files",
    "encoding_pref": f"WITH {inputs.FILES_SQL} SELECT doc_id, name, {_PREF_SQL} AS pref FROM files",
    "doc_variant_dedupe": f"""WITH {inputs.FILES_SQL},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY stripped ORDER BY pref, path) AS rn
  FROM (SELECT *, {_STRIPPED_SQL} AS stripped, {_PREF_SQL} AS pref FROM files))
SELECT stripped, pref, path, name, n_bytes FROM ranked WHERE rn = 1""",
    "doc_id_extract": f"""WITH {inputs.BOOKS_SQL}
SELECT doc_id, coalesce(try_cast(regexp_extract(text, '{ID_SQL}', 2) AS BIGINT), -1) AS ebook_id FROM books""",
    "strip_header": f"""WITH {inputs.BOOKS_SQL}
SELECT doc_id, string_split_regex(text, '{HEADER_SQL}')[-1] AS body FROM books""",
    "strip_boilerplate": f"""WITH {inputs.BOOKS_SQL}
SELECT coalesce(try_cast(regexp_extract(text, '{ID_SQL}', 2) AS BIGINT), -1) AS doc_id,
       string_split_regex(string_split_regex(text, '{HEADER_SQL}')[-1], '{FOOTER_SQL}')[1] AS body
FROM books""",
    "tokenize": f"WITH {TOKENS_SQL} SELECT doc_id, word FROM tokens",
    "stopword_filter": f"WITH {TOKENS_SQL} SELECT doc_id, word FROM tokens WHERE word NOT IN ({STOP_SQL})",
}
