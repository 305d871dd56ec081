"""Spark session for local work."""

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, memory: str = "12g") -> SparkSession:
    """Session on ``local[cpus]``. On a cluster take the session it gives; the only settings
    the library relies on are adaptive execution, on by default, and ``spark.checkpoint.dir``.
    """
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("textfeat")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
