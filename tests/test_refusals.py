"""What must fail, fails."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakeops.operators import dml
from lakeops.plans.table_changes import merge_source
from lakeops.sources import views
from lakeops.sources.files import literal_rows, scan_csv_positional
from lakeops.tables.versioned import VersionedTable


@pytest.mark.parametrize(
    "statement", ["DELETE FROM plain_loans WHERE addr_state = 'S7'", "UPDATE plain_loans SET cnt = 1"]
)
def test_plain_parquet_takes_no_row_changes(spark, sf_dir, path, statement):
    views.loan_by_state(spark, sf_dir).write.parquet(path)
    spark.sql("DROP TABLE IF EXISTS plain_loans")
    spark.sql(f"CREATE TABLE plain_loans USING parquet LOCATION '{path}'")
    with pytest.raises(PySparkException):
        spark.sql(statement).collect()


def test_two_sources_for_one_target_row(spark, path):
    target = literal_rows(spark, [("a", 1), ("b", 2)], views.LOAN_SCHEMA)
    source = literal_rows(spark, [("a", 5), ("a", 6)], views.LOAN_SCHEMA)
    for upsert in (dml.merge_upsert, dml.upsert_three_way):
        with pytest.raises(PySparkException, match="several source rows"):
            upsert(target, source, ["addr_state"]).collect()
    table = VersionedTable.create(spark, path, target)
    with pytest.raises(PySparkException, match="several source rows"):
        table.merge(source, ["addr_state"])
    assert table.read().count() == 2 and table.current_version() == 0


def test_repeated_source_rows_without_match_are_all_inserted(spark):
    target = literal_rows(spark, [("a", 1)], views.LOAN_SCHEMA)
    source = literal_rows(spark, [("z", 5), ("z", 6), (None, 7)], views.LOAN_SCHEMA)
    for upsert in (dml.merge_upsert, dml.upsert_three_way):
        rows = {tuple(r) for r in upsert(target, source, ["addr_state"]).collect()}
        assert rows == {("a", 1), ("z", 5), ("z", 6), (None, 7)}


def test_append_refuses_what_does_not_fit(spark, sf_dir):
    loans = views.loan_by_state(spark, sf_dir)
    with pytest.raises(dml.SchemaMismatch):
        dml.append_rows(loans, loans.withColumn("amount", F.lit(1.0)))
    with pytest.raises(dml.SchemaMismatch):
        dml.append_rows(loans, loans.withColumn("cnt", F.lit("x")), merge_schema=True)


def test_merge_needs_every_column(spark, sf_dir):
    with pytest.raises(dml.SchemaMismatch):
        dml.merge_upsert(views.loan_by_state(spark, sf_dir), merge_source(spark).drop("cnt"), ["addr_state"])


def test_reserved_column_names(spark, path):
    with pytest.raises(dml.SchemaMismatch):
        VersionedTable.create(spark, path, spark.range(1).toDF("_row_id"))


def test_csv_text_where_a_number_belongs_is_null(spark, path):
    literal_rows(spark, [("Year,Month",), ("2008,NA",), ("2009,4",)], "line string").write.text(path)
    rows = scan_csv_positional(spark, path, ["Year", "Month"], {"Year": "int", "Month": "int"}).collect()
    assert {tuple(r) for r in rows} == {(None, None), (2008, None), (2009, 4)}


def test_csv_columns_are_text_by_default(spark, path):
    literal_rows(spark, [("07,x",)], "line string").write.text(path)
    assert tuple(scan_csv_positional(spark, path, ["a", "b"]).first()) == ("07", "x")
