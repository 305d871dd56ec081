import pytest
from pyspark.sql import functions as F

from textfeat.plans import membership


@pytest.mark.parametrize("n,max_rows,most_bits", [(40_000, 100, 1 << 15), (40_000, 10, 1 << 20), (40_000, 100_000, 1 << 15), (50, 0, 1 << 15), (0, 5, 1 << 15)])
def test_any_level_is_exact(spark, monkeypatch, n, max_rows, most_bits):
    monkeypatch.setattr(membership, "MOST_BITS", most_bits)
    wanted = F.pmod(F.xxhash64("id"), F.lit(3)) == 0
    every = spark.range(n).select(F.concat(F.lit("/p/"), "id").alias("key"), wanted.alias("wanted"))
    rows = spark.range(n).select(F.concat(F.lit("/p/"), "id").alias("path"), "id", F.lit("x").alias("bits"), wanted.alias("right"))
    rows = rows.unionByName(rows.where("id % 2 = 0"))  # keys may come back
    found = membership.keep_members(rows, "path", every, max_rows)
    assert found.columns == rows.columns
    assert found.where("NOT right").isEmpty() and found.count() == rows.where("right").count()


@pytest.mark.parametrize("share", [0, 1])
def test_none_or_all_wanted(spark, share):
    every = spark.range(500).select(F.col("id").alias("key"), F.lit(bool(share)).alias("wanted"))
    assert membership.keep_members(spark.range(500), "id", every, 3).count() == 500 * share
