"""Reading sources, and the life span of intermediate results."""

import os

import pytest
from pyspark.sql import functions as F

from larder.operators.checks import Check, CheckFailed, not_null
from larder.sources import tables
from larder.sources.testshape import TestShape


def test_sources_from_files_and_catalog(spark, tmp_path):
    frame = spark.createDataFrame([("S1", 1)], "VENDOR string, n int")
    frame.write.parquet(str(tmp_path / tables.RAW_TABLES["documents"]))
    read = tables.read_source(spark, "documents", str(tmp_path), {"VENDOR": "PLATFORMSUPPLIER"})
    assert read.columns == ["PLATFORMSUPPLIER", "n"] and read.count() == 1
    frame.createOrReplaceTempView(tables.RAW_TABLES["suppliers"])
    assert tables.read_source(spark, "suppliers").collect() == frame.collect()


def test_staged_results_end_with_their_block(spark):
    folder = tables.shared_folder(spark)
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    with tables.staging(spark):
        assert tables.staged(spark.range(3).toDF("x"), "three").count() == 3
        assert len(set(os.listdir(folder)) - before) == 1
    assert set(os.listdir(folder)) == before


def test_a_write_that_fails_half_way_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "numbers")
    tables.write_table(spark.range(5).toDF("x"), path)
    broken = spark.range(0, 1000, 1, 4).toDF("x").withColumn("x", F.expr("if(x = 900, raise_error('no'), x)").cast("long"))
    with pytest.raises(Exception, match="no"):
        tables.write_table(broken, path)
    assert sorted(r.x for r in tables.read_table(spark, path).collect()) == list(range(5))


def test_the_version_before_stays_readable(spark, tmp_path):
    path = str(tmp_path / "numbers")
    planned = [tables.write_table(spark.range(n).toDF("x"), path) for n in (1, 2, 3)]
    assert planned[2].count() == tables.read_table(spark, path).count() == 3
    assert planned[1].count() == 2
    assert len([name for name in os.listdir(path) if name.startswith(tables.VERSION)]) == 2
    # A table may be replaced by rows computed from itself.
    tables.write_table(tables.read_table(spark, path).selectExpr("x + 10 AS x"), path)
    assert sorted(r.x for r in tables.read_table(spark, path).collect()) == [10, 11, 12]
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, str(tmp_path / "none"))


def test_checks_are_counted_while_writing(spark, tmp_path):
    path = str(tmp_path / "names")
    rows = spark.createDataFrame([("a", 1), (None, 2), (None, 3)], "name string, n int")
    tables.write_table(rows, path, [not_null("name", severity="warn"), Check("small", "n > 3")])
    with pytest.raises(CheckFailed, match="not_null_name: 2 rows"):
        tables.write_table(rows.withColumn("n", F.col("n") * 10), path, [not_null("name", tolerated=1)])
    assert {r.n for r in tables.read_table(spark, path).collect()} == {1, 2, 3}
    assert len([name for name in os.listdir(path) if name.startswith(tables.VERSION)]) == 1
    found = []
    tables.staged(rows, "checked", [not_null("name", tolerated=2), not_null("n")], found)
    assert [(r.check_name, r.failing_rows, r.status) for r in found] == [("not_null_name", 2, "pass"), ("not_null_n", 0, "pass")]


def test_a_machines_own_folder_is_refused_on_a_cluster(spark, monkeypatch):
    class Cluster:
        """The session, as if it ran on a cluster and named no shared folder."""

        conf = type("Conf", (), {"get": staticmethod(lambda name, default=None: None if name == tables.CHECKPOINT_DIR
                                                     else "file:/opt/own")})
        sparkContext = type("Context", (), {"master": "spark://host:7077", "getCheckpointDir": staticmethod(lambda: None)})
        _jvm, _jsc = spark._jvm, spark._jsc

    with pytest.raises(RuntimeError, match="folder that all machines share"):
        tables.shared_folder(Cluster)


def test_everything_but_the_result_is_deleted(spark):
    folder = tables.shared_folder(spark)
    before = set(os.listdir(folder))

    def build():
        return tables.staged(tables.staged(spark.range(4).toDF("x"), "one").filter("x > 0"), "two").filter("x > 1")

    result = tables.staged_alone(build, "result")
    assert len(set(os.listdir(folder)) - before) == 1 and result.count() == 2


def test_the_buyer_log_of_one_file_comes_in_many_parts(spark, tmp_path):
    spark.range(800).selectExpr(
        "id AS c_custkey", "concat('Customer ', id) AS c_name", "CAST(id % 25 AS INT) AS c_nationkey", "0D AS c_acctbal",
        "'BUILDING' AS c_mktsegment").coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    parts = TestShape(spark, str(tmp_path)).buyers().groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(r["count"] for r in parts) < sum(r["count"] for r in parts) / 4


def test_few_demo_ids_move_no_order(spark):
    """The list is sent to the orders also where Spark's own limit is lower; a long one is left to Spark."""
    import datetime as dt

    from larder.functions.versions import not_in, sent_if_small
    from larder.plans.marts import Marts

    ids = spark.createDataFrame([("a",), (None,), ("b",)], "id string")
    rows = spark.createDataFrame([("a",), ("c",)], "key string")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(not_in(rows, "key", sent_if_small(ids)))
        assert "SortMergeJoin" in plan(not_in(rows, "key", sent_if_small(ids, 100)))
        assert "SortMergeJoin" not in plan(not_in(rows, "key", sent_if_small(ids.limit(0), 0)))
        accounts = spark.createDataFrame([("a", True), ("c", False)], "_ID string, ISDEMOACCOUNT boolean")
        stored = Marts(lambda name: accounts, dt.date(2001, 1, 1)).stored("demo_ids")
        assert "BroadcastHashJoin" in plan(not_in(rows, "key", stored))
        assert [r.key for r in not_in(rows, "key", stored).collect()] == ["c"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not_in(rows, "key", sent_if_small(ids)).collect() == []
    assert [r.key for r in not_in(rows, "key", sent_if_small(ids.na.drop())).collect()] == ["c"]
