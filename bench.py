"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores. Results
go to the no-op sink, so every row is computed and none is collected. ``top20_small_files``,
``top20_compacted`` and ``top20_clustered`` are the layout comparison: the same query over a
partitioned versioned table written in many appends, after compaction, and after
clustering, best of three each. A query that raises is reported and leaves the others'
figures; the exit code is then 1.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from lakeops import scratch
from lakeops.plans import ALL_QUERIES
from lakeops.plans.table_changes import scenario
from lakeops.session import local_session
from lakeops.sources import views
from lakeops.tables.versioned import VersionedTable

HEADLINE = [
    "topk_grouped_count",
    "group_count",
    "group_sum",
    "rmse_by_batch",
    "regression_metrics",
    "corr_matrix",
    "histogram_10",
    "max_scale",
    "unpivot_features",
    "local_trend",
    "update_where_range",
    "merge_upsert",
    "upsert_three_way",
    "merge_large",
    "merge_repeated_key",
    "large_changes",
    "append_batches",
    "as_of_v9",
    "version_diff",
    "vacuum_retained",
    "compact",
    "ctas_partitioned_versioned",
    "optimize_partitioned",
    "stream_sum_by_key",
    "stream_incremental",
    "drift_rmse",
    "score_udf_sql",
    "pca_project",
    "elastic_net_fit",
    "train_eval",
    "tune_random",
    "shapley_values",
]
APPENDS = 16


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def layouts(spark, sf_dir: str, times: dict[str, float]) -> None:
    """The top-20 query over one partitioned table in three layouts."""
    flights = views.flights(spark, sf_dir)
    part = F.pmod(F.xxhash64(*flights.columns, F.monotonically_increasing_id()), F.lit(APPENDS + 1))
    path = scratch.fresh(spark, "bench-parts")
    flights.withColumn("part", part).write.partitionBy("part").parquet(path)
    parts = spark.read.parquet(path)
    rows = parts.where("part = 0").drop("part")
    table = VersionedTable.create(spark, scratch.fresh(spark, "bench-flights"), rows, partition_by=["origin"])
    for number in range(1, APPENDS + 1):
        table.append(parts.where(F.col("part") == number).drop("part"))

    def top20() -> None:
        rows = table.read().where("dow = 1")
        counts = rows.groupBy("month", "origin").agg(F.count("*").alias("total_flights"))
        counts.orderBy(F.col("total_flights").desc(), "month", "origin").limit(20).collect()

    times["top20_small_files"] = min(timed(top20) for _ in range(3))
    times["compact_job"] = timed(table.optimize)
    times["top20_compacted"] = min(timed(top20) for _ in range(3))
    times["cluster_job"] = timed(lambda: table.optimize(cluster_by=["dow", "month"]))
    times["top20_clustered"] = min(timed(top20) for _ in range(3))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session("bench", cores=cpus, **{"spark.ui.showConsoleProgress": "false"})
    times: dict[str, float] = {}

    failed: dict[str, str] = {}

    def measure(name: str, action) -> None:
        try:
            times[name] = timed(action)
        except Exception as error:  # one query's failure must not hide the others' figures
            failed[name] = str(error).splitlines()[0][:200]

    drain(ALL_QUERIES["topk_grouped_count"](spark, sf_dir))
    measure("scenario_build", lambda: scenario(spark, sf_dir))
    for name in HEADLINE:
        measure(name, lambda name=name: drain(ALL_QUERIES[name](spark, sf_dir)))
    try:
        layouts(spark, sf_dir, times)
    except Exception as error:
        failed["layout"] = str(error).splitlines()[0][:200]

    queries = {name: round(seconds, 3) for name, seconds in times.items()}
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "layout_speedup": {
                    name: round(times["top20_small_files"] / times[name], 2)
                    for name in ("top20_compacted", "top20_clustered")
                    if name in times
                },
                "failed": failed,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    if failed:
        sys.exit(1)


if __name__ == "__main__":
    main()
