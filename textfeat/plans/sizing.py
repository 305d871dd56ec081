"""Size checks made before a plan is chosen."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows that may be broadcast, and bytes of text they may hold on average: 256 MB at most.
BROADCAST_ROWS = 1_000_000
BYTES_PER_ROW = 256

# Bytes of input files up to which they are spread over all cores before heavy work.
SPREAD_BYTES = 256 << 20


def within(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows. Runs a job that stops counting there."""
    return df.limit(max_rows + 1).count() <= max_rows


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` may be broadcast: rows and bytes of its strings are counted, no further
    than ``max_rows``."""
    texts = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    size = sum((F.sum(F.octet_length(c)) for c in texts), F.lit(0))
    n_rows, n_bytes = df.limit(max_rows + 1).agg(F.count(F.lit(1)), size).first()
    return n_rows <= max_rows and (n_bytes or 0) <= max_rows * BYTES_PER_ROW


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint behind a check of the size; a larger ``df`` comes back without it."""
    return F.broadcast(df) if is_small(df, max_rows) else df


def _key_sizes(df: DataFrame, *key: str) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))


def has_hot_key(df: DataFrame, key: str, max_rows: int) -> bool:
    """Whether one key value has more than ``max_rows`` rows. Reads the key column only."""
    return not _key_sizes(df, key).where(F.col("n") > max_rows).isEmpty()


def repeated_keys(df: DataFrame, *key: str) -> DataFrame:
    """Key values with more than one row. Reads the key columns only."""
    return _key_sizes(df, *key).where("n > 1").select(*key)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where its files are too few and too small to fill them.

    A file is split between row groups only, and a small one has a single row group. Goes by
    the files and their bytes, of which nothing is read; above ``SPREAD_BYTES`` the input comes
    back as it is, without a shuffle, whatever the size of the cluster.
    """
    spark, files = df.sparkSession, df.inputFiles()
    cores = spark.sparkContext.defaultParallelism
    if not files or len(files) >= cores:
        return df
    n_bytes = spark.read.format("binaryFile").load(files).agg(F.sum("length")).first()[0] or 0
    return df.repartition(cores) if n_bytes <= SPREAD_BYTES else df
