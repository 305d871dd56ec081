"""Text library: a tree of e-book files with encoding variants, and stop-word lists."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textfeat.functions import names, text
from textfeat.operators import clean
from textfeat.plans import membership, sizing

BY_VARIANT = "by variant"


def child_folders(root: str, children: Sequence[str]) -> list[str]:
    return [f"{root.rstrip('/')}/{child}" for child in children]


def list_files(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """``path, name, n_bytes`` of every file below the folders. Contents are not read.

    Names that start with ``.`` or ``_`` are hidden from Spark and so not listed.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(folders))
    return files.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_size").alias("n_bytes"),
    )


def _decoded(content: Column, name: Column) -> Column:
    """Latin-1 variants, and what is no UTF-8, as Latin-1; the rest as UTF-8."""
    raw = content.cast("string")
    latin = (names.encoding_preference(name) == 2) | ~F.is_valid_utf8(raw)
    return F.when(latin, F.decode(content, "ISO-8859-1")).otherwise(raw)


def _raw_texts(spark: SparkSession, folders: Sequence[str], max_mib: float, charset: str | None) -> DataFrame:
    """``path, text`` of every eligible file as it is; empty files give no row.

    Name and size are metadata filters, so other files are pruned before they are opened.
    """
    name = F.col("_metadata.file_name")
    eligible = names.is_eligible(name, F.col("_metadata.file_size"), max_mib)
    path = F.col("_metadata.file_path").alias("path")
    reader = spark.read.option("recursiveFileLookup", True)
    if charset is None:
        files = reader.text(list(folders), wholetext=True)
        raw: Column = F.col("value")
    else:
        files = reader.format("binaryFile").load(list(folders)).where("length > 0")
        raw = _decoded(F.col("content"), name) if charset == BY_VARIANT else F.decode("content", charset)
    return files.where(eligible).select(path, raw.alias("text"))


def read_texts(
    spark: SparkSession, folders: Sequence[str], max_mib: float, charset: str | None = None
) -> DataFrame:
    """``path, text`` of every eligible file, line ends normalised; empty files give no row.

    Texts are taken as UTF-8 unless ``charset`` names another encoding. ``BY_VARIANT`` decodes each file
    by its name and content: Latin-1 variants and files that are no UTF-8 as Latin-1.
    """
    texts = _raw_texts(spark, folders, max_mib, charset)
    return texts.withColumn("text", text.normalise_newlines(F.col("text")))


def read_library(
    spark: SparkSession,
    root: str,
    children: Sequence[str],
    max_mib: float,
    charset: str | None = None,
    max_rows: int = sizing.BROADCAST_ROWS,
) -> DataFrame:
    """``path, text`` of the preferred variant of each book, where it is small enough.

    Variants are chosen before sizes are looked at: a book whose preferred variant is too
    large is left out. Texts are not shuffled by path, however many there are: see
    ``plans.membership``. ``max_rows`` is the number of paths that may be broadcast as they are.
    """
    folders = child_folders(root, children)
    files = list_files(spark, folders)
    # Line ends are the business of the chosen texts only. Only eligible files are read, so only they have to be told apart.
    chosen = clean.eligible_files(clean.dedupe_variants(files), max_mib).select("path", F.lit(True).alias("wanted"))
    every = clean.eligible_files(files, max_mib).select("path").join(chosen, "path", "left")
    every = every.select(F.col("path").alias("key"), F.coalesce("wanted", F.lit(False)).alias("wanted"))
    texts = membership.keep_members(_raw_texts(spark, folders, max_mib, charset), "path", every, max_rows)
    return texts.withColumn("text", text.normalise_newlines(F.col("text")))


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """``word``: the comma-separated entries of every line, neither trimmed nor lower-cased."""
    return spark.read.text(path).select(F.explode(F.split("value", ",")).alias("word"))
