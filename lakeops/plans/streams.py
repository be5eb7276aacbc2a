"""Streaming aggregates over tables that are being appended to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops import scratch
from lakeops.plans import texts
from lakeops.plans.texts import with_
from lakeops.sources import views
from lakeops.sources.files import stream_parquet
from lakeops.streaming.aggregates import refreshed, running_rmse, running_sum
from lakeops.tables.versioned import VersionedTable

# State stores for results of a few dozen groups; tasks pre-aggregate whatever comes.
FEW_GROUPS = 4


def stream_sum_by_key(spark: SparkSession, d: str) -> DataFrame:
    """Running sum by state over a versioned table that received six inserts."""
    loans = views.loan(spark, d).select("addr_state", F.col("loan_id").alias("cnt"))
    table = VersionedTable.create(spark, scratch.fresh(spark, "stream-loans"), loans)
    for _ in range(6):
        table.insert([("S7", 4500)])
    sums = running_sum(table.stream(max_files=4), "addr_state", "cnt", "loans")
    return refreshed(spark, sums, "stream-sum", FEW_GROUPS, [table.guard()]).catch_up()


def stream_incremental(spark: SparkSession, d: str) -> DataFrame:
    """Appends between two runs that share a checkpoint: only new files are read."""
    events = views.table(spark, d, "events").select("event_type", (F.col("value") * 100).cast("bigint").alias("cents"))
    table = VersionedTable.create(spark, scratch.fresh(spark, "stream-events"), events)
    sums = running_sum(table.stream(), "event_type", "cents", "cents")
    result = refreshed(spark, sums, "stream-incremental", FEW_GROUPS, [table.guard()])
    result.catch_up()
    table.append(events.where("event_type = 'click'"))
    table.delete(F.col("event_type") == "view")
    return result.catch_up()


def _part_sums(spark: SparkSession, table: VersionedTable, label: str) -> DataFrame:
    sums = running_sum(table.stream(), "p_brand", "p_size", "sizes")
    return refreshed(spark, sums, label, FEW_GROUPS, [table.guard()]).catch_up()


def _parts(spark: SparkSession, d: str) -> DataFrame:
    return views.table(spark, d, "part").select("p_brand", F.col("p_size").cast("bigint").alias("p_size"))


def stream_after_overwrite(spark: SparkSession, d: str) -> DataFrame:
    """A stream over a table that was overwritten, then appended to."""
    table = VersionedTable.create(spark, scratch.fresh(spark, "stream-overwritten"), _parts(spark, d))
    table.overwrite(_parts(spark, d).where("p_size <= 20"))
    table.append(_parts(spark, d).where("p_size > 45"))
    return _part_sums(spark, table, "stream-after-overwrite")


def stream_after_vacuum(spark: SparkSession, d: str) -> DataFrame:
    """A stream over a table whose folders a vacuum rewrote, with a later append and removal."""
    table = VersionedTable.create(spark, scratch.fresh(spark, "stream-vacuumed"), _parts(spark, d))
    table.delete(F.col("p_size") < 10)
    table.vacuum(0, force=True)
    table.append(_parts(spark, d).where("p_size > 45"))
    table.delete(F.col("p_size") == 30)
    return _part_sums(spark, table, "stream-after-vacuum")


def stream_after_optimize(spark: SparkSession, d: str) -> DataFrame:
    """A stream over a table that was updated, optimized and vacuumed."""
    table = VersionedTable.create(spark, scratch.fresh(spark, "stream-optimized"), _parts(spark, d))
    table.update(F.col("p_size") < 10, {"p_size": F.col("p_size") + 100})
    table.optimize()
    table.vacuum(0, force=True)
    return _part_sums(spark, table, "stream-after-optimize")


def stream_rmse_by_batch(spark: SparkSession, d: str) -> DataFrame:
    """Error per scoring batch over a folder of predictions."""
    path = scratch.fresh(spark, "stream-pred")
    pred = views.pred(spark, d)
    pred.write.parquet(path)
    rmse = running_rmse(stream_parquet(spark, path, pred.schema, max_files=8), "batch", "price", "prediction")
    out = refreshed(spark, rmse, "stream-rmse", FEW_GROUPS).catch_up()
    return out.select("batch", F.round("rmse", 4).alias("rmse"))


QUERIES = {
    "stream_after_overwrite": stream_after_overwrite,
    "stream_after_vacuum": stream_after_vacuum,
    "stream_after_optimize": stream_after_optimize,
    "stream_sum_by_key": stream_sum_by_key,
    "stream_incremental": stream_incremental,
    "stream_rmse_by_batch": stream_rmse_by_batch,
}

ORACLES = {
    "stream_after_overwrite": "SELECT p_brand, CAST(sum(p_size) AS BIGINT) AS sizes FROM part "
    "WHERE p_size <= 20 OR p_size > 45 GROUP BY p_brand",
    "stream_after_vacuum": "SELECT p_brand, CAST(sum(CASE WHEN p_size > 45 THEN 2 ELSE 1 END * p_size) AS BIGINT) AS sizes "
    "FROM part WHERE p_size >= 10 AND p_size <> 30 GROUP BY p_brand",
    "stream_after_optimize": "SELECT p_brand, CAST(sum(CASE WHEN p_size < 10 THEN p_size + 100 ELSE p_size END) AS BIGINT) "
    "AS sizes FROM part GROUP BY p_brand",
    "stream_sum_by_key": with_(
        texts.LOAN,
        select="SELECT addr_state, CAST(sum(loan_id) AS BIGINT) AS loans FROM (SELECT addr_state, loan_id FROM loan "
        "UNION ALL SELECT 'S7', 4500 FROM range(6)) AS t GROUP BY addr_state",
    ),
    "stream_incremental": "SELECT event_type, CAST(sum(CASE WHEN event_type = 'click' THEN 2 ELSE 1 END "
    "* CAST(trunc(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY event_type",
    "stream_rmse_by_batch": with_(
        texts.PRED,
        select="SELECT batch, round(sqrt(avg((price-prediction)*(price-prediction))), 4) AS rmse FROM pred GROUP BY batch",
    ),
}
