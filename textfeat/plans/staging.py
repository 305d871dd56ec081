"""Intermediate tables in the shared folder of the cluster.

A result that several later steps read is written once and read back: the lineage ends
there, a lost executor costs only its own tasks, and Catalyst learns the real size, from
which it chooses join strategies.
"""

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


# Paths handed out, for each owner that is open, the innermost last. Threads of a run share them.
_owners: list[list[str]] = []


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="textfeat-")


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_folder()


def stage_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark)}/textfeat/{label}-{uuid.uuid4().hex}"
    if _owners:
        _owners[-1].append(path)
    return path


@contextmanager
def owned(spark: SparkSession) -> Iterator[None]:
    """Deletes what is staged inside when it is left, also after an error.

    Results that read staged tables have to be read inside; written, collected or counted::

        with staging.owned(spark):
            runs.count_corpus(docs).tf.write.parquet(path)
    """
    mine: list[str] = []
    _owners.append(mine)
    try:
        yield
    finally:
        _owners.remove(mine)
        for path in mine:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: str | StructType) -> DataFrame:
    """A few rows of the driver as a table, by way of Arrow: no Python worker is started for them, where
    pickled rows start one on every core, which then stays."""
    names = (schema if isinstance(schema, StructType) else StructType.fromDDL(schema)).names
    columns = [pa.array([row[i] for row in rows]) for i in range(len(names))]
    return spark.createDataFrame(pa.table(columns, names), schema)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet and return the table read back. Runs one job."""
    spark = df.sparkSession
    path = stage_path(spark, label)
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._staged_path = path  # so that release need not list the files
    return staged


def release(staged: DataFrame) -> None:
    """Delete the files of staged tables that are no longer needed: of the one that ``stage`` gave, or of
    all that a result reads."""
    spark = staged.sparkSession
    if path := getattr(staged, "_staged_path", None):
        _delete(spark, path)
        return
    root = f"{shared_folder(spark)}/textfeat/"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for folder in {file.rsplit("/", 1)[0] for file in staged.inputFiles()}:
        path = hadoop.Path(folder)
        if path.toUri().getPath().startswith(hadoop.Path(root).toUri().getPath()):
            _delete(spark, folder)
