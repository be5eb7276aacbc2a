"""Versions 0 to 10 in order; after each step every earlier version is still readable."""

import pytest
from pyspark.sql import functions as F

from lakeops.operators import dml
from lakeops.plans.table_changes import evolved_batch, merge_source, state_is
from lakeops.sources import views
from lakeops.tables.versioned import CommitConflict, VersionedTable, VersionNotAvailable


def sums(df):
    return {r[0]: r[1] for r in df.groupBy("addr_state").agg(F.sum("cnt")).collect()}


def test_scenario(spark, sf_dir, path):
    start = views.loan_by_state(spark, sf_dir)
    table = VersionedTable.create(spark, path, start)
    expected = [sums(start)]

    def check():
        assert table.current_version() == len(expected) - 1
        for version, wanted in enumerate(expected):
            assert sums(table.as_of(version)) == wanted, version

    for _ in range(6):
        table.insert([("S7", 4500)])
        expected.append({**expected[-1], "S7": expected[-1].get("S7", 0) + 4500})
    check()
    table.delete(state_is("S7"))
    expected.append({k: v for k, v in expected[-1].items() if k != "S7"})
    table.update(state_is("S12"), {"cnt": 27000})
    expected.append({**expected[-1], "S12": 27000})
    table.merge(merge_source(spark), ["addr_state"])
    expected.append({**expected[-1], "S7": 1000000, "S3": 25, "S20": None, "ZZ": 9})
    check()

    batch = evolved_batch(table.read())
    with pytest.raises(dml.SchemaMismatch):
        table.append(batch)
    assert table.current_version() == 9
    table.append(batch, merge_schema=True)
    halved = {k: None if v is None else v + int(v * 0.5) for k, v in expected[-1].items()}
    expected.append(halved)
    check()
    assert table.as_of(9).columns == ["addr_state", "cnt"]
    assert table.as_of(10).columns == ["addr_state", "cnt", "amount"]
    assert [r.operation for r in table.history().orderBy("version").collect()] == (
        ["CREATE"] + ["INSERT"] * 6 + ["DELETE", "UPDATE", "MERGE", "APPEND"]
    )


def test_another_reader_sees_new_versions(spark, path):
    table = VersionedTable.create(spark, path, spark.range(5).toDF("id"))
    reader = VersionedTable(spark, path)
    assert reader.read().count() == 5
    table.append(spark.range(3).toDF("id"))
    assert reader.read().count() == 8
    assert reader.current_version() == 1


def test_no_version_is_written_twice(spark, path):
    VersionedTable.create(spark, path, spark.range(1).toDF("id"))
    with pytest.raises(CommitConflict):
        VersionedTable.create(spark, path, spark.range(2).toDF("id"))


def test_a_write_without_its_history_row_is_invisible(spark, path):
    table = VersionedTable.create(spark, path, spark.range(5).toDF("id"))
    leftover = spark.range(9).selectExpr("id", "id AS _row_id", "cast(null AS bigint) AS _old_version",
                                         "cast(null AS bigint) AS _old_row_id")
    leftover.write.parquet(f"{path}/rows/_version=1/_gen=0")
    assert VersionedTable(spark, path).read().count() == 5
    table.append(spark.range(2).toDF("id"))
    assert table.read().count() == 7


def test_missing_table_and_version(spark, path):
    with pytest.raises(VersionNotAvailable):
        VersionedTable(spark, path).read()
    table = VersionedTable.create(spark, path, spark.range(1).toDF("id"))
    with pytest.raises(VersionNotAvailable):
        table.as_of(1)


def test_restore_and_diff_across_it(spark, path):
    table = VersionedTable.create(spark, path, spark.range(10).toDF("id"))
    table.delete(F.col("id") < 4)
    table.restore(0)
    table.append(spark.range(100, 102).toDF("id"))
    assert table.read().count() == 12
    assert table.detail().first().num_rows == 12
    changes = {(r.change, r.id) for r in table.diff(1, 3).collect()}
    assert changes == {("added", i) for i in [0, 1, 2, 3, 100, 101]}
    back = {(r.change, r.id) for r in table.diff(3, 1).collect()}
    assert back == {("removed", i) for i in [0, 1, 2, 3, 100, 101]}


def test_change_of_every_row_leaves_the_old_ones_unread(spark, path):
    table = VersionedTable.create(spark, path, spark.range(10).toDF("id"))
    table.update(F.lit(True), {"id": F.col("id") + 1})
    assert [c.version for c in table._snapshot().line] == [1]
    assert {r.id for r in table.read().collect()} == set(range(1, 11))
    table.delete(F.lit(True))
    assert table.read().isEmpty()
    table.append(spark.range(2).toDF("id"))
    assert table.read().count() == 2
    assert table.as_of(0).count() == 10


def test_vacuum(spark, path):
    table = VersionedTable.create(spark, path, spark.range(100).toDF("id"))
    table.append(spark.range(100, 200).toDF("id"))
    table.delete(F.col("id") % 10 == 0)
    table.update(F.col("id") == 5, {"id": 5000})
    before = {r.id for r in table.read().collect()}
    assert table.vacuum(0, force=True) == 3
    assert {r.id for r in table.read().collect()} == before
    assert table._snapshot().removals == []
    for version in (0, 1, 2):
        with pytest.raises(VersionNotAvailable):
            table.as_of(version)
    table.delete(F.col("id") == 7)
    assert VersionedTable(spark, path).read().count() == len(before) - 1
    assert table.vacuum(0, force=True) == 4
    assert table.read().count() == len(before) - 1


def test_vacuum_keeps_what_young_versions_need(spark, path):
    table = VersionedTable.create(spark, path, spark.range(10).toDF("id"))
    table.delete(F.col("id") == 3)
    assert table.vacuum() == 0
    assert table.as_of(0).count() == 10


def test_vacuum_after_restore_keeps_restored_rows(spark, path):
    table = VersionedTable.create(spark, path, spark.range(10).toDF("id"))
    table.delete(F.col("id") < 5)
    table.restore(0)
    assert table.vacuum(0, force=True) == 2
    assert table.read().count() == 10


def test_short_retention_needs_force(spark, path):
    table = VersionedTable.create(spark, path, spark.range(1).toDF("id"))
    with pytest.raises(ValueError, match="force=True"):
        table.vacuum(0)


def test_optimize_makes_few_files(spark, path):
    table = VersionedTable.create(spark, path, spark.range(0, 1000, 1, 16).toDF("id"))
    table.delete(F.col("id") < 10)
    table.optimize(cluster_by=["id"])
    assert table.files().count() == 1
    assert table.read().count() == 990
    assert table.files(0).count() == 16
