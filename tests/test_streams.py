"""Streams agree with batch and pick up only what is new."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from lakeops.sources import views
from lakeops.streaming.aggregates import guarded, refreshed, running_sum, same_rows
from lakeops.tables.versioned import VersionedTable


def batch_sum(df):
    return df.groupBy("addr_state").agg(F.sum("cnt").alias("loans"))


def test_stream_follows_appends(spark, sf_dir, path):
    table = VersionedTable.create(spark, path, views.loan_by_state(spark, sf_dir))
    result = refreshed(spark, running_sum(table.stream(max_files=2), "addr_state", "cnt", "loans"), "t")
    assert same_rows(result.catch_up(), batch_sum(table.read()))
    for _ in range(3):
        table.insert([("S7", 4500)])
    assert same_rows(result.catch_up(), batch_sum(table.read()))
    assert same_rows(result.catch_up(), batch_sum(table.read()))


def test_running_stream_sees_a_concurrent_writer(spark, sf_dir, path):
    table = VersionedTable.create(spark, path, views.loan_by_state(spark, sf_dir))
    result = refreshed(spark, running_sum(table.stream(), "addr_state", "cnt", "loans"), "t")
    query = result.start(processingTime="1 second")
    try:
        query.processAllAvailable()
        table.insert([("S7", 4500)])
        query.processAllAvailable()
        assert same_rows(result.latest(), batch_sum(table.read()))
    finally:
        query.stop()


def sums(spark, table, on_change="error"):
    result = running_sum(table.stream(on_change), "addr_state", "cnt", "loans")
    return refreshed(spark, result, "t", guards=[table.guard(on_change)])


def test_rewritten_rows(spark, sf_dir, path):
    table = VersionedTable.create(spark, path, views.loan_by_state(spark, sf_dir))
    failing, skipping = sums(spark, table), sums(spark, table, "skip")
    first = batch_sum(table.read())
    table.update(F.col("addr_state") == "S3", {"cnt": 1})
    table.optimize()
    with pytest.raises(StreamingQueryException):
        failing.catch_up()
    assert same_rows(skipping.catch_up(), first)
    assert same_rows(sums(spark, table).catch_up(), batch_sum(table.read()))


def rows_table(spark, path, count=100):
    return VersionedTable.create(spark, path, spark.range(count).select((F.col("id") % 7).cast("string").alias("addr_state"), F.col("id").alias("cnt")))


def test_start_after_removals_and_vacuum(spark, path):
    table = rows_table(spark, path)
    table.delete(F.col("cnt") < 5)
    assert same_rows(sums(spark, table).catch_up(), batch_sum(table.read()))
    table.vacuum(0, force=True)
    assert same_rows(sums(spark, table).catch_up(), batch_sum(table.read()))
    table.insert([("x", 4500)])
    assert same_rows(sums(spark, table).catch_up(), batch_sum(table.read()))
    table.optimize()
    table.vacuum(0, force=True)
    last = sums(spark, table)
    assert same_rows(last.catch_up(), batch_sum(table.read()))
    table.insert([("y", 1)])
    assert same_rows(last.catch_up(), batch_sum(table.read()))


def test_overwrite_and_restore(spark, path):
    table = rows_table(spark, path)
    before = sums(spark, table)
    before.catch_up()
    table.overwrite(spark.createDataFrame([("a", 0), ("b", 1)], "addr_state string, cnt long"))
    with pytest.raises(StreamingQueryException):
        before.catch_up()
    after, emitting = sums(spark, table), sums(spark, table, "emit")
    assert same_rows(after.catch_up(), batch_sum(table.read()))
    table.restore(0)
    with pytest.raises(StreamingQueryException):
        after.catch_up()
    assert emitting.catch_up().count() == 2
    assert same_rows(sums(spark, table).catch_up(), batch_sum(table.read()))
    assert table.read().count() == 100


def test_vacuum_of_unseen_rows_fails(spark, path):
    table = rows_table(spark, path)
    stream = sums(spark, table)
    table.delete(F.col("cnt") < 5)
    table.vacuum(0, force=True)
    with pytest.raises(StreamingQueryException):
        stream.catch_up()


def test_failed_write_is_not_streamed(spark, path, monkeypatch):
    table = rows_table(spark, path)
    stream = sums(spark, table)
    with monkeypatch.context() as broken:
        broken.setattr(VersionedTable, "_move", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.insert([("x", 1)])
    assert same_rows(stream.catch_up(), batch_sum(table.read()))
    table.insert([("x", 1)])
    assert same_rows(stream.catch_up(), batch_sum(table.read()))


def test_filter_of_the_caller_hides_no_overwrite(spark, path):
    table = rows_table(spark, path)
    filtered = table.stream().where("addr_state = '3'")
    result = running_sum(filtered, "addr_state", "cnt", "loans")
    guarded = refreshed(spark, result, "t", guards=[table.guard()])
    guarded.catch_up()
    table.overwrite(spark.createDataFrame([("a", 0)], "addr_state string, cnt long"))
    with pytest.raises(StreamingQueryException, match="OVERWRITE"):
        guarded.catch_up()


def test_writer_of_the_caller(spark, path):
    """A batch writer of one's own, guarded: it passes on appends and stops at a restore."""
    table = rows_table(spark, path)
    seen = []

    def run():
        query = (
            table.stream(from_version=0)
            .where("cnt >= 90")
            .writeStream.foreachBatch(guarded(lambda batch, _: seen.append(batch.count()), table.guard(from_version=0)))
            .option("checkpointLocation", f"{path}-checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    run()
    table.insert([("x", 95)])
    run()
    assert seen == [10, 1]
    table.restore(0)
    with pytest.raises(StreamingQueryException, match="RESTORE"):
        run()
