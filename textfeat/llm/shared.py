"""Small helpers of the operators."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textfeat.plans.staging import stage_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, label: str, path: str | None = None, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder, tightly packed, and return the table read back."""
    path = path or stage_path(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows_of(batch: pa.RecordBatch, *columns: str) -> Iterator[tuple]:
    """Python values of the named columns, row by row."""
    return zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns))


def in_slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds about ``max_bytes`` in each, one row at least."""
    for batch in batches:
        sizes = [len(v) if v else 0 for v in batch.column(batch.schema.get_field_index(column)).to_pylist()]
        begin = held = 0
        for i, size in enumerate(sizes):
            if i > begin and held + size > max_bytes:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += size
        if begin < len(sizes):
            yield batch.slice(begin)


def words(text: F.Column | str) -> F.Column:
    """Runs of characters other than ASCII white space, in order; null has none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


