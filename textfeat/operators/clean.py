"""From files to identified bodies."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textfeat.functions import names, text


def dedupe_variants(files: DataFrame) -> DataFrame:
    """Best encoding variant per base name over ``path, name, n_bytes``; ties go by path.

    A minimum per group, so variants are combined before the shuffle and a name shared by
    very many files does not land in one task.
    """
    best = F.min(F.struct(names.encoding_preference(F.col("name")).alias("pref"), "path", "name", "n_bytes"))
    grouped = files.groupBy(names.strip_suffix(F.col("name")).alias("stripped")).agg(best.alias("best"))
    return grouped.select("stripped", "best.*")


def eligible_files(files: DataFrame, max_mib: float) -> DataFrame:
    return files.where(names.is_eligible(F.col("name"), F.col("n_bytes"), max_mib))


def identify(files: DataFrame, keep_unidentified: bool = False) -> DataFrame:
    """``doc_id, body`` from ``text``: id found in the text, header and footer cut off.

    Texts without an id would all share -1 and be counted as one document; they are dropped
    unless asked for.
    """
    # Handed on through a generator, so that a filter on the id stays above it and is not pushed below
    # with the patterns once more in it.
    book = F.struct(text.document_id(F.col("text")).alias("doc_id"), text.strip_boilerplate(F.col("text")).alias("body"))
    books = files.select(F.inline(F.array(book)))
    return books if keep_unidentified else books.where(F.col("doc_id") != text.UNIDENTIFIED)
