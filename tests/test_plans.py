"""The physical plans are the intended ones."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from lakeops.operators import dml, sizing, skew
from lakeops.operators.layout import rewrite_folder
from lakeops.plans import ALL_QUERIES
from lakeops.plans.table_changes import merge_source
from lakeops.sinks.files import write_partitioned, write_small_files
from lakeops.sources import views
from lakeops.sources.files import file_inventory
from lakeops.tables.versioned import VersionedTable


@contextmanager
def settings(spark, **values):
    old = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_prunes_pushes_and_does_not_sort(spark, sf_dir, path):
    small = write_small_files(views.flights(spark, sf_dir), f"{path}/small", ["origin"], 4)
    out = rewrite_folder(spark, f"{path}/small", f"{path}/out", small.schema, ["origin"], ["dow"])
    query = out.where("dow = 1").groupBy("month", "origin").agg(F.count("*").alias("n"))
    text = plan(query.orderBy(F.col("n").desc(), "month", "origin").limit(20))
    assert "EqualTo(dow,1)" in text and "TakeOrderedAndProject" in text
    assert "ReadSchema: struct<month:bigint,dow:bigint>" in text
    assert text.count("Exchange") == 1 and "partial_count" in text
    one = plan(out.where("origin = 3"))
    assert "PartitionFilters: [isnotnull(origin" in one


@pytest.mark.parametrize("name", ["max_scale", "histogram_10", "corr_matrix", "local_trend", "drift_rmse"])
def test_statistics_join_nothing(spark, sf_dir, name):
    assert "Join" not in plan(ALL_QUERIES[name](spark, sf_dir))


def test_small_upsert_leaves_the_target_where_it_is(spark, sf_dir):
    target = views.table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("addr_state"), F.col("o_custkey").alias("cnt"))
    text = plan(dml.merge_upsert(target, merge_source(spark), ["addr_state"]))
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") == 3


@pytest.mark.parametrize("key", ["0", "NULL"])
def test_hot_target_key_is_not_shuffled(spark, sf_dir, monkeypatch, key):
    """One key holds most of the target and the source is too large to broadcast."""
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(skew, "HOT_ROWS", 500)
    target = views.table(spark, sf_dir, "lineitem").selectExpr(
        f"CASE WHEN l_linenumber > 2 THEN {key} ELSE l_orderkey END AS k", "l_returnflag AS v"
    )
    assert [r.k for r in skew.hot_keys(target, ["k"]).collect()] == [None if key == "NULL" else 0]
    source = target.select("k").distinct().withColumn("v", F.lit("new"))
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        merged = dml.merge_upsert(target, source, ["k"])
        text = plan(merged)
        assert text.count("SortMergeJoin") == 2 and text.count("BroadcastHashJoin") >= 2
        nulls = target.where("k IS NULL").count()
        assert merged.where("v <> 'new'").count() == nulls
        assert merged.count() == target.count() + min(nulls, 1)


def test_wide_rows_for_hot_keys_are_salted(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 10)
    monkeypatch.setattr(skew, "HOT_ROWS", 500)
    target = views.table(spark, sf_dir, "lineitem").selectExpr("if(l_linenumber > 2, 0, l_orderkey) AS k", "'x' AS v")
    source = target.select("k").distinct().withColumn("v", F.lit("new"))
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        merged = dml.merge_upsert(target, source, ["k"])
        assert "_salt" in plan(merged)
        assert merged.where("v = 'new'").count() == target.count()
        assert merged.count() == target.count()


def test_hot_keys_from_a_sample(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 500)
    monkeypatch.setattr(skew, "SAMPLE_ROWS", 2000)
    rows = views.table(spark, sf_dir, "lineitem").selectExpr("if(l_linenumber > 4, 0, l_orderkey) AS k")
    assert [r.k for r in skew.hot_keys(rows, ["k"]).collect()] == [0]


def test_versions_read_only_their_folders(spark, path):
    table = VersionedTable.create(spark, path, spark.range(100).toDF("id"))
    table.append(spark.range(100, 200).toDF("id"))
    table.delete(F.col("id") < 10)
    table.append(spark.range(200, 300).toDF("id"))
    assert all("_version=0/" in f for f in table.as_of(0).inputFiles())
    assert "Join" not in plan(table.as_of(1))
    text = plan(table.read())
    # Only version 0 lost rows, so only it meets the removals, map-side.
    assert text.count("BroadcastHashJoin") == 1 and "Exchange hashpartitioning" not in text
    table.overwrite(spark.range(5).toDF("id"))
    assert "Join" not in plan(table.read())
    assert all("_version=4/" in f for f in table.read().inputFiles())


def test_filters_reach_versioned_scans(spark, sf_dir, path):
    table = VersionedTable.create(spark, path, views.price(spark, sf_dir))
    table.delete(F.col("qty") == 1)
    text = plan(table.read().where("disc > 0.05").select("tax"))
    assert "GreaterThan(disc,0.05)" in text
    assert "price" not in text.split("ReadSchema: struct<")[1].split(">")[0]


def test_partitioned_write_makes_one_file_per_value(spark, sf_dir, path):
    write_partitioned(views.flights(spark, sf_dir).repartition(8), path, ["origin"])
    per_value = file_inventory(spark, path).groupBy("origin").count()
    assert per_value.agg(F.max("count")).first()[0] == 1


def test_inventory_opens_no_file(spark, sf_dir, path):
    views.flights(spark, sf_dir).write.parquet(path)
    text = plan(file_inventory(spark, path))
    assert "content" not in text.split("ReadSchema")[1]
