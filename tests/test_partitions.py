"""Versioned tables with partition folders, and curves over mixed types inside them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeops.operators import dml, layout
from lakeops.sources.files import literal_rows
from lakeops.streaming.aggregates import refreshed, running_sum, same_rows
from lakeops.tables.versioned import VersionedTable


def table_of(spark, path, rows=400):
    df = spark.range(rows).select(
        F.when(F.col("id") % 5 == 4, None).otherwise(F.concat(F.lit("p "), F.col("id") % 5)).alias("part"),
        F.concat(F.lit("name"), F.pmod(F.xxhash64("id"), F.lit(50))).alias("name"),
        (F.pmod(F.xxhash64(F.col("id") + 7), F.lit(1000)) / 10).alias("price"),
        "id",
    )
    return VersionedTable.create(spark, path, df, partition_by=["part"]), df


def scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "FileScan" in line]


def same(left, right):
    return same_rows(left.select(sorted(left.columns)), right.select(sorted(left.columns)))


def test_filter_names_folders_through_removals(spark, path):
    table, df = table_of(spark, path)
    table.delete(F.col("id") % 10 == 3)
    table.append(df.where("id < 50").withColumn("id", F.col("id") + 1000))
    found = table.as_of().where("part = 'p 3'")
    for scan in scans(found):
        if "rows/" in scan or "part" in scan:
            assert "PartitionFilters" in scan and "(part" in scan.split("PartitionFilters")[1].split("]")[0]
    assert any("(part" in s.split("PartitionFilters")[1] for s in scans(found))
    rest = df.where("id % 10 <> 3").unionByName(df.where("id < 50").withColumn("id", F.col("id") + 1000))
    assert same(table.read(), rest)
    assert same(found, rest.where("part = 'p 3'"))
    assert same(table.as_of().where("part IS NULL"), rest.where("part IS NULL"))


def test_rows_move_between_folders(spark, path):
    table, df = table_of(spark, path)
    table.update(F.col("id") < 10, {"part": "p 0"})
    table.update(F.col("id") == 0, {"part": F.lit(None)})
    moved = df.withColumn("part", F.when(F.col("id") == 0, None).when(F.col("id") < 10, "p 0").otherwise(F.col("part")))
    assert same(table.read(), moved)
    assert same(table.as_of(0), df)
    folders = table.files().select("part").distinct().collect()
    assert {r.part for r in folders} == {None, "p 0", "p 1", "p 2", "p 3"}
    detail = table.detail().first()
    assert (detail.partition_columns, detail.num_partitions, detail.num_rows) == ("part", 5, 400)


def test_maintenance_keeps_folders(spark, path):
    table, df = table_of(spark, path)
    table.delete(F.col("id") % 3 == 0)
    rest = df.where("id % 3 <> 0")
    table.vacuum(0, force=True)
    assert same(table.read(), rest)
    table.optimize(cluster_by=["name", "price"], target_bytes=1000)
    table.vacuum(0, force=True)
    assert same(table.read(), rest)
    table.restore(table.current_version())
    table.overwrite(df.where("id < 5"))
    assert same(table.read().where("part = 'p 1'"), df.where("id = 1"))
    with pytest.raises(ValueError):
        table.optimize(cluster_by=["part"])


def test_stream_over_folders(spark, path):
    table, df = table_of(spark, path)
    stream = running_sum(table.stream(), "part", "id", "ids")
    result = refreshed(spark, stream, "t", guards=[table.guard()])
    assert same(result.catch_up(), df.groupBy("part").agg(F.sum("id").alias("ids")))
    table.append(df.where("part = 'p 1'"))
    assert same(result.catch_up(), table.read().groupBy("part").agg(F.sum("id").alias("ids")))


def test_refused_partitions(spark, path):
    rows = literal_rows(spark, [("", 1), ("x", 2)], "part string, n long")
    with pytest.raises(Exception, match="empty string"):
        VersionedTable.create(spark, path, rows, partition_by=["part"])
    for by in (["nothing"], ["part", "part"], ["part", "n"]):
        with pytest.raises(dml.SchemaMismatch):
            VersionedTable.create(spark, f"{path}-{len(by)}", rows, partition_by=by)


def test_values_come_back_as_written(spark, path):
    rows = [
        (dt.date(2024, 2, 29), "a/b=c %", 1),
        (dt.date(1999, 12, 31), "é ü", 2),
        (None, None, 3),
        (dt.date(2024, 2, 29), "01", 4),
    ]
    df = literal_rows(spark, rows, "day date, name string, n long")
    table = VersionedTable.create(spark, path, df, partition_by=["day", "name"])
    assert sorted(map(tuple, table.read().collect()), key=lambda r: r[2]) == rows
    assert table.read().schema.simpleString() == df.schema.simpleString()


def test_ranks_follow_order_of_any_type(spark):
    rows = [(i, f"k{i % 90:03d}", float(i % 77), dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), i % 2 == 0) for i in range(500)]
    rows += [(500, None, float("nan"), None, None)]
    df = literal_rows(spark, rows, "id long, s string, x double, t timestamp, b boolean")
    out, names = layout.ranked(df, ["s", "x", "t", "b"], 5)
    got = out.collect()
    for name, column in zip(names, ["s", "x", "t", "b"], strict=True):
        known = sorted((r[column], r[name]) for r in got if r[column] is not None and r[column] == r[column])
        ranks = [rank for _, rank in known]
        assert ranks == sorted(ranks) and max(ranks) < 32
        assert len(set(ranks)) == (2 if column == "b" else len(set(ranks))) and (column == "b" or len(set(ranks)) > 20)
    assert {r[names[0]] for r in got if r.s is None} == {0}
    assert {r[names[1]] for r in got if r.x != r.x} == {31}


def test_curve_bits():
    assert layout.curve_bits(2, 1) == layout.LEAST_BITS
    assert layout.curve_bits(2, 1 << 14) == 11
    assert layout.curve_bits(12, 16) * 12 <= layout.CURVE_BITS
    with pytest.raises(ValueError):
        layout.curve_bits(70, 1)
    with pytest.raises(ValueError):
        layout.curve_bits(20, 1 << 70)
    with pytest.raises(ValueError):
        layout.interleaved(["a"] * 10, 7)
