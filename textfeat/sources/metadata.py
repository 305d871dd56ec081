"""RDF/XML metadata: subjects of each document."""

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textfeat.functions.patterns import RDF_SCHEMA


def _empty_if_null(items: Column) -> Column:
    return F.coalesce(items, F.array())


def _description(node: Column) -> Column:
    return F.struct(
        F.get(node["value"], 0).alias("subject"),
        F.get(node["memberOf"], 0)["_resource"].alias("taxonomy"),
    )


def _book_subjects(book: Column) -> Column:
    return F.flatten(
        F.transform(
            _empty_if_null(book["subject"]),
            lambda s: F.transform(_empty_if_null(s["Description"]), _description),
        )
    )


def parse_rdf(files: DataFrame, column: str = "text") -> DataFrame:
    """Adds ``doc_id, subjects array<struct<subject, taxonomy>>`` and drops the XML.

    Names are matched without their prefixes, whatever a file binds them to. A part that is
    missing becomes null; XML that cannot be parsed gives a null id and no
    subjects. The id comes from the first book of the file.
    """
    others = [c for c in files.columns if c != column]
    books = files.select(*others, F.from_xml(column, RDF_SCHEMA, {"ignoreNamespace": "true"})["ebook"].alias("books"))
    about = F.get("books", 0)["_about"]
    return books.select(
        *others,
        F.substring(about, len("ebooks/") + 1, 2**31 - 1).try_cast("bigint").alias("doc_id"),
        F.flatten(F.transform(_empty_if_null(F.col("books")), _book_subjects)).alias("subjects"),
    )


def last_by_path(parsed: DataFrame) -> DataFrame:
    """One row per id: the file with the last path wins. Rows without id are dropped."""
    return (
        parsed.where("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max_by("subjects", "path").alias("subjects"))
    )


def read_metadata(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """``doc_id, subjects`` from a tree of RDF/XML files; hidden files are skipped.

    A file without an id, which malformed XML has not either, is an error naming the file;
    unless ``strict`` it is left out.
    """
    files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    files = files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    parsed = parse_rdf(files)
    if strict:
        no_id = F.raise_error(F.concat(F.lit("no document id in "), "path")).cast("bigint")
        parsed = parsed.withColumn("doc_id", F.coalesce("doc_id", no_id))
    return last_by_path(parsed)


def read_records(spark: SparkSession, path: str, record: str = "pgterms:ebook") -> DataFrame:
    """``path, at, record, doc_id, subjects`` for every element ``record`` of catalogue files.

    A catalogue is one large file of many books. It is cut at the end tags of the element, which
    stand in for line ends, so a file is read by as many tasks as it has splits, and no task holds
    more than one book. ``at`` is the place in the file: equal paths compare by it. An element that
    is closed in its start tag is a book without subjects. XML that cannot be parsed gives a null
    id and spoils no other book; entities that the file declares itself are not known here, and
    an element name inside a comment counts as an element.
    """
    name = re.escape(record)
    lines = spark.read.option("recursiveFileLookup", True).option("lineSep", f"</{record}>").text(path)
    place = F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("nth"))
    lines = lines.select(F.col("_metadata.file_path").alias("path"), place.alias("place"), "value")
    pieces = lines.select("path", "place", F.posexplode(F.split("value", rf"(?=<{name}[\s/>])")).alias("piece", "text"))
    pieces = pieces.where(F.col("text").rlike(rf"^<{name}[\s/>]"))
    closed = F.regexp_substr("text", F.lit(rf"""^<{name}(?:[^>"'/]|/(?!>)|"[^"]*"|'[^']*')*+/>"""))
    whole = F.coalesce(closed, F.concat("text", F.lit(f"</{record}>")))
    at = F.struct("place.start", "place.nth", "piece").alias("at")
    books = pieces.select("path", at, whole.alias("record"))
    xml = F.concat(F.lit("<RDF>"), "record", F.lit("</RDF>"))
    return parse_rdf(books.withColumn("text", xml))


def read_catalogue(spark: SparkSession, path: str, record: str = "pgterms:ebook", strict: bool = True) -> DataFrame:
    """``doc_id, subjects`` from catalogue files, see ``read_records``.

    The last record of an id wins, by path and place. A record without an id, which malformed XML
    has not either, is an error that shows its beginning; unless ``strict`` it is left out, and
    ``bad_records`` lists it.
    """
    books = read_records(spark, path, record)
    if strict:
        shown = F.concat(F.lit("no document id in "), "path", F.lit(": "), F.substring("record", 1, 200))
        books = books.withColumn("doc_id", F.coalesce("doc_id", F.raise_error(shown).cast("bigint")))
    books = books.select("doc_id", "subjects", F.struct("path", "at").alias("path"))
    return last_by_path(books)


def bad_records(spark: SparkSession, path: str, record: str = "pgterms:ebook") -> DataFrame:
    """``path, at, record`` of the records that have no id or cannot be parsed."""
    return read_records(spark, path, record).where("doc_id IS NULL").select("path", "at", "record")
