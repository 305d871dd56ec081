"""Datasets handed from one stage to the next, and result files."""

import hashlib
import json
from collections.abc import Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

VECTOR_SCHEMA = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("features", VectorUDT()),
        StructField("num_bins", IntegerType()),
        StructField("batch", IntegerType()),
    ]
)

_LAYOUT = "key string, buckets int, schema string"


def write_dataset(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a Parquet dataset. Under partition columns only the partitions present in
    ``df`` are replaced, so a batch can be redone without touching the others."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def read_dataset(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_bucketed(df: DataFrame, path: str, key: str = "doc_id", buckets: int | None = None) -> None:
    """Overwrite a Parquet dataset dealt to buckets by ``key`` and sorted by it in each.

    Datasets with the same key and number of buckets, ``spark.sql.shuffle.partitions`` by default,
    are joined and grouped by it without a shuffle, as often as they are read. All rows of a key
    are one bucket. A file of the layout is written last, so a broken write cannot be read.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_dataset(spark.createDataFrame([], _LAYOUT), f"{path}/layout")
    name = _table_name(f"{path}/written")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    # One task per bucket: other partitions would each write a file for every bucket.
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", f"{path}/rows")
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    write_dataset(spark.createDataFrame([(key, buckets, df.schema.json())], _LAYOUT), f"{path}/layout")


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A dataset of ``write_bucketed``, whose buckets Catalyst knows of."""
    layout = read_dataset(spark, f"{path}/layout", _LAYOUT).first()
    if layout is None:
        raise ValueError(f"no whole dataset at {path}")
    schema, name = StructType.fromJson(json.loads(layout.schema)), _table_name(path)
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    key, rows = _quoted(layout.key), f"{path}/rows".replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {layout.buckets} BUCKETS LOCATION '{rows}'"
    )
    return spark.table(name)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _table_name(path: str) -> str:
    return f"textfeat_{hashlib.md5(path.encode()).hexdigest()}"


def write_vectors(vectors: DataFrame, path: str, batch: int = 0) -> None:
    """Write ``doc_id, num_bins, features`` as one batch of a vector dataset."""
    rows = vectors.select("doc_id", "features", "num_bins", F.lit(int(batch)).alias("batch"))
    write_dataset(rows, path, ["num_bins", "batch"])


def read_vectors(spark: SparkSession, path: str, num_bins: int) -> DataFrame:
    """``doc_id, features`` of every batch at one vector length; other lengths are pruned.

    The stored struct is the storage form of an ML vector, so reading it under the vector
    type gives estimator input without any Python code per row.
    """
    vectors = read_dataset(spark, path, VECTOR_SCHEMA).where(F.col("num_bins") == num_bins)
    return vectors.select("doc_id", "features")


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrite a CSV result with a header line."""
    df.write.mode("overwrite").option("header", True).csv(path)
