import os

import pytest

from __spark_entry__ import queries
from textfeat.plans import staging


def test_stage_cuts_the_lineage_and_can_be_released(spark):
    staged = staging.stage(spark.range(10).selectExpr("id", "cast(id AS string) AS word"), "numbers")
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan and "FileScan parquet" in plan
    folder = os.path.dirname(staged.inputFiles()[0].removeprefix("file://"))
    assert folder.startswith(staging.shared_folder(spark)) and staged.count() == 10
    staging.release(staged)
    assert not os.path.exists(folder)


def folders(spark):
    return set(os.listdir(os.path.join(staging.shared_folder(spark), "textfeat")))


def test_an_owner_deletes_what_was_staged(spark):
    kept = staging.stage(spark.range(3), "kept")
    before = folders(spark)
    with staging.owned(spark):
        staged = staging.stage(spark.range(5), "gone")
        with staging.owned(spark):
            assert staging.stage(spark.range(2), "inner").count() == 2
        assert staged.count() == 5 and len(folders(spark)) == len(before) + 1
    with pytest.raises(KeyError):
        with staging.owned(spark):
            staging.stage(spark.range(5), "gone")
            raise KeyError
    assert folders(spark) == before and kept.count() == 3
    staging.release(kept)


@pytest.mark.parametrize("name", ["word_count", "tfidf", "index_tfidf", "shared_batch_merge", "nb_grid"])
def test_no_query_leaves_tables_behind(spark, name):
    staging.stage(spark.range(1), "other")
    before = folders(spark)
    with staging.owned(spark):
        assert queries()[name](spark, "/root/testdata/sf0.001").count() > 0
    assert folders(spark) == before


def test_release_leaves_other_tables_alone(spark, tmp_path):
    path = str(tmp_path / "own")
    spark.range(3).write.parquet(path)
    staging.release(spark.read.parquet(path))
    assert spark.read.parquet(path).count() == 3


class Session:
    """A session whose configuration names no folder."""

    def __init__(self, master):
        self.sparkContext = type("Context", (), {"master": master})()
        self.conf = type("Conf", (), {"get": lambda self, key, default: default})()


def test_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError):
        staging.shared_folder(Session("yarn"))


def test_local_mode_makes_one_folder():
    folder = staging.shared_folder(Session("local[2]"))
    assert os.path.isdir(folder) and staging.shared_folder(Session("local[2]")) == folder


def test_local_tables_start_no_python_worker(spark):
    schema = "name string, n bigint, x double, list array<double>"
    rows = [("a", 1, float("-inf"), [0.5]), (None, None, None, []), ("é", 1 << 40, 2.0, None)]
    table = staging.local_table(spark, rows, schema)
    assert table.schema == spark.createDataFrame(rows, schema).schema
    assert [tuple(r) for r in table.collect()] == rows
    for made in (staging.local_table(spark, [], schema), staging.local_table(spark, rows[1:2], schema)):
        assert made.schema == table.schema
    assert staging.local_table(spark, [], schema).isEmpty()
    # A table from pickled rows is an RDD that Python workers write.
    assert "PythonRDD" not in table._jdf.rdd().toDebugString() and "Scan ExistingRDD" not in table._jdf.queryExecution().toString()
