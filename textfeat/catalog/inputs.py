"""Inputs of the queries, derived from the given tables over all of their rows, in Spark and
in SQL.

The tables hold plain texts, so what a library of books adds to a text (markers, file
variants, subjects) is put around it.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textfeat.plans.staging import stage_path

# URIs of the two taxonomies.
LCSH = "http://purl.org/dc/terms/LCSH"
LCC = "http://purl.org/dc/terms/LCC"
STOP_WORDS = ("the", "of", "and", "la", "le", "der", "die", "el")
MAX_MIB = 0.002


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, body``."""
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("body"))


# -- books: a text between markers ---------------------------------------------------------

# Marker lines of the collection.
_START = "\n*** START OF THIS PROJECT GUTENBERG EBOOK X ***\n"


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, text``: header with an id for six in seven, sometimes two start markers,
    text, one of two footers."""
    d = F.col("doc_id")
    raw = F.concat(
        F.lit("Title\n"),
        F.when(d % 7 == 0, "").otherwise(F.concat(F.lit("[EBook #"), (d + 10000).cast("string"), F.lit("]"))),
        F.lit(_START),
        F.when(d % 5 == 0, f"note{_START}").otherwise(""),
        F.col("text"),
        F.when(d % 2 == 0, "\n*** END OF THIS PROJECT GUTENBERG EBOOK X ***").otherwise("\n*** START: FULL LICENSE ***"),
        F.lit("\nlicence"),
    )
    return table(spark, sf_dir, "documents").select("doc_id", raw.alias("text"))


BOOKS_SQL = r"""
books AS (
  SELECT doc_id,
         E'Title\n'
         || CASE WHEN doc_id % 7 = 0 THEN '' ELSE '[EBook #' || (doc_id + 10000)::VARCHAR || ']' END
         || E'\n*** START OF THIS PROJECT GUTENBERG EBOOK X ***\n'
         || CASE WHEN doc_id % 5 = 0
                 THEN E'note\n*** START OF THIS PROJECT GUTENBERG EBOOK X ***\n' ELSE '' END
         || text
         || CASE WHEN doc_id % 2 = 0 THEN E'\n*** END OF THIS PROJECT GUTENBERG EBOOK X ***'
                 ELSE E'\n*** START: FULL LICENSE ***' END
         || E'\nlicence' AS text
  FROM documents)"""

# -- files: three encoding variants per book, some of another type -------------------------


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, path, name, n_bytes``."""
    d = F.col("doc_id")
    suffix = (
        F.when(d % 11 == 0, ".zip").when(d % 3 == 0, "-0.txt").when(d % 3 == 1, "-8.txt").otherwise(".txt")
    )
    name = F.concat((F.floor(d / 3) + 10000).cast("string"), suffix)
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", "source", name.alias("name"), F.octet_length("text").cast("bigint").alias("n_bytes")
    )
    return rows.select("doc_id", F.concat_ws("/", "source", "name").alias("path"), "name", "n_bytes")


FILES_SQL = """
files AS (
  SELECT doc_id, source || '/' || name AS path, name, n_bytes FROM (
    SELECT doc_id, source, strlen(text)::BIGINT AS n_bytes,
           (doc_id // 3 + 10000)::VARCHAR
           || CASE WHEN doc_id % 11 = 0 THEN '.zip' WHEN doc_id % 3 = 0 THEN '-0.txt'
                   WHEN doc_id % 3 = 1 THEN '-8.txt' ELSE '.txt' END AS name
    FROM documents))"""

# -- subjects: language and source of a text, one of them at times under two taxonomies ----


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, subjects``."""

    def entry(subject, taxonomy):
        return F.struct(F.col(subject).alias("subject"), F.lit(taxonomy).alias("taxonomy"))

    both = [entry("lang", LCSH), entry("source", LCC)]
    subjects = F.when(F.col("doc_id") % 4 == 0, F.array(*both, entry("lang", LCC))).otherwise(F.array(*both))
    return table(spark, sf_dir, "documents").select("doc_id", subjects.alias("subjects"))


# Fixed value: namespaces that the prefixes of the records stand for.
_NAMESPACES = (
    'xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:dcterms="http://purl.org/dc/terms/" '
    'xmlns:dcam="http://purl.org/dc/dcam/" xmlns:pgterms="urn:pgterms"'
)


def rdf_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, record``: the metadata of each document as an element of RDF/XML."""
    node = (
        '<dcterms:subject><rdf:Description rdf:nodeID="N"><dcam:memberOf rdf:resource="%s"/>'
        "<rdf:value>%s</rdf:value></rdf:Description></dcterms:subject>"
    )
    nodes = F.transform("subjects", lambda s: F.format_string(node, s["taxonomy"], s["subject"]))
    record = F.format_string(
        '<pgterms:ebook rdf:about="ebooks/%d">%s</pgterms:ebook>', "doc_id", F.array_join(nodes, "")
    )
    return metadata(spark, sf_dir).select("doc_id", record.alias("record"))


def rdf_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path, text``: the metadata of each document as the RDF/XML file it would come in."""
    xml = F.format_string(f'<?xml version="1.0"?>\n<rdf:RDF {_NAMESPACES}>%s</rdf:RDF>', "record")
    path = F.format_string("pg%d.rdf", "doc_id")
    return rdf_records(spark, sf_dir).select(path.alias("path"), xml.alias("text"))


def rdf_catalogue(spark: SparkSession, sf_dir: str) -> str:
    """Folder of catalogue files that hold the records of all documents one after the other."""
    path = stage_path(spark, "catalogue")
    rdf_records(spark, sf_dir).select("record").write.text(path)
    return path


PAIRS_SQL = f"""
flat AS (
  SELECT doc_id, lang AS subject, '{LCSH}' AS taxonomy FROM documents
  UNION ALL SELECT doc_id, source, '{LCC}' FROM documents
  UNION ALL SELECT doc_id, lang, '{LCC}' FROM documents WHERE doc_id % 4 = 0)"""
