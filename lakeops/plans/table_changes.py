"""Row-level changes, versions, history and maintenance over the given tables."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops import scratch
from lakeops.operators import dml, layout
from lakeops.plans import texts
from lakeops.plans.texts import with_
from lakeops.sinks.files import write_small_files
from lakeops.sources import views
from lakeops.sources.files import literal_rows
from lakeops.tables.versioned import VersionedTable

_built: dict[tuple[str, str], VersionedTable] = {}


def state_is(code: str) -> Column:
    return F.col("addr_state") == code


def merge_source(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, views.MERGE_ROWS, views.LOAN_SCHEMA)


def evolved_batch(current: DataFrame) -> DataFrame:
    return current.select(
        "addr_state",
        (F.col("cnt") * 0.5).cast("bigint").alias("cnt"),
        (F.col("cnt") * 5000.0).cast("double").alias("amount"),
    )


def run_scenario(spark: SparkSession, d: str) -> VersionedTable:
    """Versions 0 to 10: create, six inserts, delete, update, upsert, evolved append."""
    table = VersionedTable.create(spark, scratch.fresh(spark, "loans"), views.loan_by_state(spark, d))
    for _ in range(6):
        table.insert([("S7", 4500)])
    table.delete(state_is("S7"))
    table.update(state_is("S12"), {"cnt": 27000})
    table.merge(merge_source(spark), ["addr_state"])
    table.append(evolved_batch(table.read()), merge_schema=True)
    return table


def scenario(spark: SparkSession, d: str) -> VersionedTable:
    """The scenario's table, built once per application and data folder."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _built:
        _built[key] = run_scenario(spark, d)
    return _built[key]


# -- row-level changes as functions ----------------------------------------------


def insert_values(spark: SparkSession, d: str) -> DataFrame:
    return dml.insert_rows(views.loan_by_state(spark, d), [("S7", 4500)] * 6)


def delete_where(spark: SparkSession, d: str) -> DataFrame:
    """A null status makes the predicate unknown, which keeps the row."""
    return dml.delete_where(views.loan(spark, d), F.col("loan_status") == "BUILDING")


def update_where(spark: SparkSession, d: str) -> DataFrame:
    return dml.update_where(views.loan_by_state(spark, d), state_is("S12"), {"cnt": 27000})


def update_where_range(spark: SparkSession, d: str) -> DataFrame:
    """Nulls are not in the range; every other value of the column becomes zero."""
    rows = views.price(spark, d).withColumn("disc", F.when(F.col("l_linenumber") != 2, F.col("disc")))
    updated = dml.update_where(rows, F.col("disc") >= 0.0, {"disc": 0.0})
    return updated.select(*views.PRICE_KEYS, "disc", F.round("tax", 6).alias("tax"))


def merge_upsert(spark: SparkSession, d: str) -> DataFrame:
    return dml.merge_upsert(views.loan_by_state(spark, d), merge_source(spark), ["addr_state"])


def upsert_three_way(spark: SparkSession, d: str) -> DataFrame:
    return dml.upsert_three_way(views.loan_by_state(spark, d), merge_source(spark), ["addr_state"])


def customer_changes(spark: SparkSession, d: str) -> DataFrame:
    """A large upsert source: every third customer with a new balance, and as many new ones."""
    customer = views.table(spark, d, "customer")
    changed = customer.where(F.col("c_custkey") % 3 == 0).select(
        "c_custkey", (F.col("c_custkey") * 2).alias("balance"), F.lit(None).cast("string").alias("segment")
    )
    new = customer.where(F.col("c_custkey") % 3 == 1).select(
        (-F.col("c_custkey")).alias("c_custkey"),
        F.lit(0).cast("long").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    return changed.unionByName(new)


def customer_balances(spark: SparkSession, d: str) -> DataFrame:
    return views.table(spark, d, "customer").select(
        "c_custkey", F.col("c_custkey").alias("balance"), F.col("c_mktsegment").alias("segment")
    )


def merge_large(spark: SparkSession, d: str) -> DataFrame:
    """Upsert whose source grows with the table."""
    return dml.merge_upsert(customer_balances(spark, d), customer_changes(spark, d), ["c_custkey"])


def merge_repeated_key(spark: SparkSession, d: str) -> DataFrame:
    """Upsert into rows that share keys: each order status changes all its orders."""
    target = views.table(spark, d, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("note")
    )
    source = target.groupBy("status").agg(
        F.max("o_orderkey").alias("o_orderkey"), F.concat(F.lit("seen "), F.count("*").cast("string")).alias("note")
    )
    return dml.merge_upsert(target, source, ["status"]).groupBy("status", "o_orderkey", "note").agg(
        F.count("*").alias("rows")
    )


def append_merge_schema(spark: SparkSession, d: str) -> DataFrame:
    loans = views.loan_by_state(spark, d)
    return dml.append_rows(loans, evolved_batch(loans), merge_schema=True)


def topk_sum(spark: SparkSession, d: str) -> DataFrame:
    """Top ten by a sum over a column half the rows lack; all-null groups go last."""
    return (
        append_merge_schema(spark, d)
        .groupBy("addr_state")
        .agg(F.sum("amount").alias("amount"))
        .orderBy(F.col("amount").desc_nulls_last(), "addr_state")
        .limit(10)
    )


# -- versioned tables -----------------------------------------------------------


def read_current(spark: SparkSession, d: str) -> DataFrame:
    return scenario(spark, d).read()


def ctas_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """A Parquet folder converted to a versioned table and read back."""
    source = views.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return VersionedTable.create(spark, scratch.fresh(spark, "orders"), source).as_of(0)


def append_batches(spark: SparkSession, d: str) -> DataFrame:
    """Predictions appended batch by batch; each append is a version of its own."""
    pred = views.pred(spark, d)
    table = VersionedTable.create(spark, scratch.fresh(spark, "pred"), pred.where("batch = 0"))
    for batch in range(1, 5):
        table.append(pred.where(F.col("batch") == batch))
    per_version = [
        table.as_of(v).agg(
            F.lit(v).cast("long").alias("version"), F.count("*").alias("rows"), F.max("batch").alias("last_batch")
        )
        for v in (0, 2, 4)
    ]
    return per_version[0].unionByName(per_version[1]).unionByName(per_version[2])


def overwrite_batch(spark: SparkSession, d: str) -> DataFrame:
    """New content replaces old; the old version stays readable."""
    pred = views.pred(spark, d)
    table = VersionedTable.create(spark, scratch.fresh(spark, "pred"), pred.where("batch < 2"))
    table.overwrite(pred.where("batch = 4"))

    def content(version: int) -> DataFrame:
        rows = table.as_of(version).groupBy("batch").agg(F.count("*").alias("rows"))
        return rows.withColumn("version", F.lit(version).cast("long"))

    return content(0).unionByName(content(1))


def large_changes(spark: SparkSession, d: str) -> DataFrame:
    """Delete, update and upsert on a versioned table that grows with the data."""
    table = VersionedTable.create(spark, scratch.fresh(spark, "customers"), customer_balances(spark, d))
    table.delete(F.col("c_custkey") % 5 == 0)
    table.update(F.col("segment") == "BUILDING", {"balance": F.col("balance") + 1})
    table.merge(customer_changes(spark, d), ["c_custkey"])
    return table.read()


def table_history(spark: SparkSession, d: str) -> DataFrame:
    return scenario(spark, d).history().select("version", "operation", "rows_added", "rows_removed")


def current_version(spark: SparkSession, d: str) -> DataFrame:
    return scenario(spark, d).history().agg(F.max("version").alias("current_version"))


def as_of_v0(spark: SparkSession, d: str) -> DataFrame:
    return scenario(spark, d).as_of(0)


def as_of_v9(spark: SparkSession, d: str) -> DataFrame:
    return scenario(spark, d).as_of(9)


def as_of_timestamp(spark: SparkSession, d: str) -> DataFrame:
    """The table at the moment version 7 was committed."""
    table = scenario(spark, d)
    moment = table.history().where("version = 7").select(F.unix_micros("ts")).first()[0]
    return table.as_of(timestamp=datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=moment))


def version_diff(spark: SparkSession, d: str) -> DataFrame:
    return scenario(spark, d).diff(6, 9)


def restore_version(spark: SparkSession, d: str) -> DataFrame:
    """Roll a table back past a delete and an update, then append to it again."""
    table = VersionedTable.create(spark, scratch.fresh(spark, "customers"), customer_balances(spark, d))
    table.delete(F.col("c_custkey") % 2 == 0)
    table.update(F.lit(True), {"balance": 0})
    table.restore(0)
    table.append(customer_changes(spark, d).where("c_custkey < 0"))
    return table.read()


def table_detail(spark: SparkSession, d: str) -> DataFrame:
    """Size facts of the current version; bytes and files vary with the machine."""
    return scenario(spark, d).detail().select(
        "format",
        "version",
        "num_rows",
        "pending_removals",
        (F.col("num_files") > 0).alias("has_files"),
        (F.col("size_bytes") > 0).alias("has_bytes"),
    )


def grouped_sums(spark: SparkSession, d: str) -> DataFrame:
    """The aggregate the scenario is watched with, after each kind of change."""
    table = scenario(spark, d)
    out = None
    for version in (0, 6, 7, 8, 9, 10):
        sums = table.as_of(version).groupBy("addr_state").agg(F.sum("cnt").alias("loans"))
        sums = sums.withColumn("version", F.lit(version).cast("long"))
        out = sums if out is None else out.unionByName(sums)
    return out


# -- layout ---------------------------------------------------------------------


def small_file_flights(spark: SparkSession, d: str) -> tuple[str, DataFrame]:
    path = scratch.fresh(spark, "flights-small")
    return path, write_small_files(views.flights(spark, d), path, ["origin"], 8)


def compact(spark: SparkSession, d: str) -> DataFrame:
    path, small = small_file_flights(spark, d)
    out = layout.rewrite_folder(spark, path, scratch.fresh(spark, "flights-compact"), small.schema, ["origin"])
    return out.groupBy("origin", "month", "dow").agg(F.count("*").alias("flights"))


def cluster_by(spark: SparkSession, d: str) -> DataFrame:
    """Compacted and ordered by day; the top-20 query over the result."""
    path, small = small_file_flights(spark, d)
    out = layout.rewrite_folder(
        spark, path, scratch.fresh(spark, "flights-clustered"), small.schema, ["origin"], ["dow"]
    )
    busiest = out.where("dow = 1").groupBy("month", "origin").agg(F.count("*").alias("total_flights"))
    return busiest.orderBy(F.col("total_flights").desc(), "month", "origin").limit(20)


def cluster_by_two(spark: SparkSession, d: str) -> DataFrame:
    """Clustered on two columns at once, read back with a filter on either."""
    path, small = small_file_flights(spark, d)
    out = layout.rewrite_folder(
        spark, path, scratch.fresh(spark, "flights-z"), small.schema, [], ["dow", "month"], target_bytes=16 * 1024
    )
    return out.where("dow = 1 OR month = 6").groupBy("dow", "month").agg(F.count("*").alias("flights"))


def optimize_versioned(spark: SparkSession, d: str) -> DataFrame:
    """Optimize adds a version with the same rows."""
    table = VersionedTable.create(spark, scratch.fresh(spark, "customers"), customer_balances(spark, d))
    table.delete(F.col("c_custkey") % 5 == 0)
    table.append(customer_changes(spark, d).where("c_custkey < 0"))
    table.optimize(cluster_by=["c_custkey"])
    return table.read()


def orders_by_status(spark: SparkSession, d: str, label: str) -> VersionedTable:
    """Orders with a folder for each status."""
    rows = views.table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice"
    )
    return VersionedTable.create(spark, scratch.fresh(spark, label), rows, partition_by=["o_orderstatus"])


def ctas_partitioned_versioned(spark: SparkSession, d: str) -> DataFrame:
    """A partitioned table after a removal, an update that moves rows to other folders and an
    upsert; each status read by its own filter, which names one folder."""
    table = orders_by_status(spark, d, "orders-by-status")
    table.delete(F.col("o_custkey") % 5 == 0)
    table.update((F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 2 == 0), {"o_orderstatus": "F"})
    changes = table.read().where("o_orderkey % 3 = 0").withColumn("o_orderpriority", F.lit("0-NONE"))
    new = changes.where("o_orderkey <> 0").withColumn("o_orderkey", -F.col("o_orderkey"))
    table.merge(changes.unionByName(new), on=["o_orderkey"])
    parts = None
    for status in ("F", "O", "P"):
        part = table.as_of().where(F.col("o_orderstatus") == status)
        part = part.groupBy("o_orderstatus", "o_orderpriority").agg(
            F.count("*").alias("rows"), F.sum("o_orderkey").alias("keys")
        )
        parts = part if parts is None else parts.unionByName(part)
    detail = table.detail().first()
    return parts.select(
        "*",
        F.lit(detail.partition_columns).alias("partition_columns"),
        F.lit(detail.num_partitions).alias("num_partitions"),
    )


def optimize_partitioned(spark: SparkSession, d: str) -> DataFrame:
    """Files laid along a curve over a text and a number inside each folder: the rows a
    filter on either has to read, before and after, and the rows it finds."""
    table = orders_by_status(spark, d, "orders-laid")
    cheap, urgent = F.col("o_totalprice") < 20_000, F.col("o_orderpriority") == "1-URGENT"
    columns = ["o_orderpriority", "o_totalprice"]

    def read(name: str) -> DataFrame:
        files = table.file_ranges(columns)
        return files.groupBy("o_orderstatus").agg(
            F.sum("rows").alias("rows"),
            F.sum(F.when(F.col("min_o_totalprice") < 20_000, F.col("rows")).otherwise(0)).alias(f"{name}_cheap"),
            F.sum(
                F.when(F.lit("1-URGENT").between(F.col("min_o_orderpriority"), F.col("max_o_orderpriority")), F.col("rows"))
                .otherwise(0)
            ).alias(f"{name}_urgent"),
        )

    before = literal_rows(spark, [tuple(r) for r in read("before").collect()], read("before").schema)  # one row a status
    size = table.detail().first().size_bytes
    table.optimize(cluster_by=columns, target_bytes=max(1, size // 64))
    found = table.read().groupBy("o_orderstatus").agg(
        F.count_if(cheap).alias("cheap"), F.count_if(urgent).alias("urgent")
    )
    both = before.join(read("after").drop("rows"), "o_orderstatus").join(found, "o_orderstatus")
    return both.agg(
        F.sum("rows").alias("rows"),
        F.sum("cheap").alias("cheap"),
        F.sum("urgent").alias("urgent"),
        F.sum("before_cheap").alias("read_for_cheap_before"),
        F.sum("before_urgent").alias("read_for_urgent_before"),
        (F.sum("after_cheap") < F.sum("rows") / 2).alias("cheap_reads_under_half"),
        (F.sum("after_urgent") < F.sum("rows") * 0.6).alias("urgent_reads_under_six_tenths"),
    )


def vacuum_retained(spark: SparkSession, d: str) -> DataFrame:
    """Vacuum to the current version; what it holds is unchanged."""
    table = VersionedTable.create(spark, scratch.fresh(spark, "customers"), customer_balances(spark, d))
    table.delete(F.col("c_custkey") % 5 == 0)
    table.update(F.col("segment") == "BUILDING", {"balance": F.col("balance") + 1})
    table.vacuum(retain_hours=0, force=True)
    table.append(customer_changes(spark, d).where("c_custkey < 0"))
    return table.read()


QUERIES = {
    "insert_values": insert_values,
    "delete_where": delete_where,
    "update_where": update_where,
    "update_where_range": update_where_range,
    "merge_upsert": merge_upsert,
    "upsert_three_way": upsert_three_way,
    "merge_large": merge_large,
    "merge_repeated_key": merge_repeated_key,
    "append_merge_schema": append_merge_schema,
    "topk_sum": topk_sum,
    "read_current": read_current,
    "ctas_roundtrip": ctas_roundtrip,
    "append_batches": append_batches,
    "overwrite_batch": overwrite_batch,
    "large_changes": large_changes,
    "table_history": table_history,
    "current_version": current_version,
    "as_of_v0": as_of_v0,
    "as_of_v9": as_of_v9,
    "as_of_timestamp": as_of_timestamp,
    "version_diff": version_diff,
    "restore_version": restore_version,
    "table_detail": table_detail,
    "grouped_sums": grouped_sums,
    "compact": compact,
    "cluster_by": cluster_by,
    "cluster_by_two": cluster_by_two,
    "optimize_versioned": optimize_versioned,
    "ctas_partitioned_versioned": ctas_partitioned_versioned,
    "optimize_partitioned": optimize_partitioned,
    "vacuum_retained": vacuum_retained,
}

_BALANCES = "balances AS (SELECT c_custkey, c_custkey AS balance, c_mktsegment AS segment FROM customer)"
_CHANGES = (
    "changes AS (SELECT c_custkey, c_custkey*2 AS balance, CAST(NULL AS VARCHAR) AS segment FROM customer "
    "WHERE c_custkey % 3 = 0 UNION ALL SELECT -c_custkey, CAST(0 AS BIGINT), c_mktsegment FROM customer "
    "WHERE c_custkey % 3 = 1)"
)
_NEW = "SELECT * FROM changes WHERE c_custkey < 0"


def _merged(target: str) -> str:
    return (
        f"SELECT t.c_custkey, CASE WHEN s.c_custkey IS NULL THEN t.balance ELSE s.balance END AS balance, "
        f"CASE WHEN s.c_custkey IS NULL THEN t.segment ELSE s.segment END AS segment "
        f"FROM {target} t LEFT JOIN changes s ON t.c_custkey = s.c_custkey "
        f"UNION ALL SELECT * FROM changes s WHERE NOT EXISTS "
        f"(SELECT 1 FROM {target} t WHERE t.c_custkey = s.c_custkey)"
    )


_MERGE_SMALL = with_(
    texts.LOAN_BY_STATE,
    texts.MERGE_SRC,
    select="SELECT d.addr_state, CASE WHEN m.addr_state IS NULL THEN d.cnt ELSE m.cnt END AS cnt "
    "FROM loan_by_state d LEFT JOIN merge_src m ON d.addr_state = m.addr_state UNION ALL "
    "SELECT addr_state, cnt FROM merge_src m WHERE NOT EXISTS "
    "(SELECT 1 FROM loan_by_state d WHERE d.addr_state = m.addr_state)",
)

_APPENDED = (
    "appended AS (SELECT addr_state, cnt, CAST(NULL AS DOUBLE) AS amount FROM loan_by_state UNION ALL "
    "SELECT addr_state, CAST(trunc(CAST(cnt AS DOUBLE) * 0.5) AS BIGINT), CAST(cnt AS DOUBLE) * 5000 FROM loan_by_state)"
)

ORACLES = {
    "insert_values": with_(
        texts.LOAN_BY_STATE,
        select="SELECT addr_state, cnt FROM loan_by_state UNION ALL SELECT 'S7', CAST(4500 AS BIGINT) FROM range(6)",
    ),
    "delete_where": with_(
        texts.LOAN, select="SELECT * FROM loan WHERE loan_status IS NULL OR loan_status <> 'BUILDING'"
    ),
    "update_where": with_(
        texts.LOAN_BY_STATE,
        select="SELECT addr_state, CASE WHEN addr_state = 'S12' THEN CAST(27000 AS BIGINT) ELSE cnt END AS cnt "
        "FROM loan_by_state",
    ),
    "update_where_range": with_(
        texts.PRICE,
        select="SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
        "CASE WHEN l_linenumber <> 2 THEN CASE WHEN disc >= 0 THEN CAST(0 AS DOUBLE) ELSE disc END END AS disc, "
        "round(tax, 6) AS tax FROM price",
    ),
    "merge_upsert": _MERGE_SMALL,
    "upsert_three_way": _MERGE_SMALL,
    "merge_large": with_(_BALANCES, _CHANGES, select=_merged("balances")),
    "merge_repeated_key": "SELECT o_orderstatus AS status, top AS o_orderkey, "
    "concat('seen ', CAST(n AS VARCHAR)) AS note, n AS rows FROM (SELECT o_orderstatus, max(o_orderkey) AS top, "
    "count(*) AS n FROM orders GROUP BY 1) AS g",
    "append_merge_schema": with_(texts.LOAN_BY_STATE, _APPENDED, select="SELECT * FROM appended"),
    "topk_sum": with_(
        texts.LOAN_BY_STATE,
        _APPENDED,
        select="SELECT addr_state, sum(amount) AS amount FROM appended GROUP BY addr_state "
        "ORDER BY amount DESC NULLS LAST, addr_state LIMIT 10",
    ),
    "read_current": with_(texts.SCENARIO, select="SELECT * FROM v10"),
    "ctas_roundtrip": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
    "append_batches": with_(
        texts.PRED,
        select="SELECT CAST(v AS BIGINT) AS version, count(*) AS rows, max(batch) AS last_batch FROM pred "
        "JOIN (VALUES (0), (2), (4)) AS t(v) ON batch <= v GROUP BY 1",
    ),
    "overwrite_batch": with_(
        texts.PRED,
        select="SELECT batch, count(*) AS rows, CAST(CASE WHEN batch = 4 THEN 1 ELSE 0 END AS BIGINT) AS version "
        "FROM pred WHERE batch IN (0, 1, 4) GROUP BY batch",
    ),
    "large_changes": with_(
        _BALANCES,
        _CHANGES,
        "edited AS (SELECT c_custkey, CASE WHEN segment = 'BUILDING' THEN balance + 1 ELSE balance END AS balance, "
        "segment FROM balances WHERE c_custkey % 5 <> 0)",
        select=_merged("edited"),
    ),
    "table_history": with_(
        texts.SCENARIO,
        "gone AS (SELECT count(*) AS n FROM v6 WHERE addr_state = 'S7')",
        "hit AS (SELECT count(*) AS n FROM v8 JOIN merge_src USING (addr_state))",
        select="SELECT CAST(0 AS BIGINT) AS version, 'CREATE' AS operation, count(*) AS rows_added, "
        "CAST(0 AS BIGINT) AS rows_removed FROM v0 "
        "UNION ALL SELECT i, 'INSERT', CAST(1 AS BIGINT), CAST(0 AS BIGINT) FROM range(1, 7) AS r(i) "
        "UNION ALL SELECT 7, 'DELETE', 0, n FROM gone "
        "UNION ALL SELECT 8, 'UPDATE', count(*), count(*) FROM v7 WHERE addr_state = 'S12' "
        "UNION ALL SELECT 9, 'MERGE', (SELECT count(*) FROM merge_src), n FROM hit "
        "UNION ALL SELECT 10, 'APPEND', count(*), 0 FROM v9",
    ),
    "current_version": "SELECT CAST(10 AS BIGINT) AS current_version",
    "as_of_v0": with_(texts.SCENARIO, select="SELECT * FROM v0"),
    "as_of_v9": with_(texts.SCENARIO, select="SELECT * FROM v9"),
    "as_of_timestamp": with_(texts.SCENARIO, select="SELECT * FROM v7"),
    "version_diff": with_(
        texts.SCENARIO,
        "changed AS (SELECT 'S7' AS addr_state UNION ALL SELECT 'S12' UNION ALL SELECT addr_state FROM merge_src "
        "WHERE addr_state <> 'S7')",
        select="SELECT 'added' AS change, v9.* FROM v9 WHERE addr_state IN (SELECT addr_state FROM changed) "
        "UNION ALL SELECT 'removed', v6.* FROM v6 WHERE addr_state IN (SELECT addr_state FROM changed)",
    ),
    "table_detail": with_(
        texts.SCENARIO,
        select="SELECT 'parquet' AS format, CAST(10 AS BIGINT) AS version, (SELECT count(*) FROM v10) AS num_rows, "
        "(SELECT count(*) FROM v6 WHERE addr_state = 'S7') + (SELECT count(*) FROM v7 WHERE addr_state = 'S12') "
        "+ (SELECT count(*) FROM v8 JOIN merge_src USING (addr_state)) AS pending_removals, "
        "true AS has_files, true AS has_bytes",
    ),
    "restore_version": with_(_BALANCES, _CHANGES, select=f"SELECT * FROM balances UNION ALL {_NEW}"),
    "grouped_sums": with_(
        texts.SCENARIO,
        select=" UNION ALL ".join(
            f"SELECT addr_state, CAST(sum(cnt) AS BIGINT) AS loans, CAST({v} AS BIGINT) AS version "
            f"FROM v{v} GROUP BY addr_state"
            for v in (0, 6, 7, 8, 9, 10)
        ),
    ),
    "compact": with_(
        texts.FLIGHTS, select="SELECT origin, month, dow, count(*) AS flights FROM flights GROUP BY origin, month, dow"
    ),
    "cluster_by": with_(
        texts.FLIGHTS,
        select="SELECT month, origin, count(*) AS total_flights FROM flights WHERE dow = 1 "
        "GROUP BY month, origin ORDER BY total_flights DESC, month, origin LIMIT 20",
    ),
    "cluster_by_two": with_(
        texts.FLIGHTS,
        select="SELECT dow, month, count(*) AS flights FROM flights WHERE dow = 1 OR month = 6 GROUP BY dow, month",
    ),
    "optimize_versioned": with_(
        _BALANCES, _CHANGES, select=f"SELECT * FROM balances WHERE c_custkey % 5 <> 0 UNION ALL {_NEW}"
    ),
    "ctas_partitioned_versioned": with_(
        "kept AS (SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN 'F' "
        "ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_custkey % 5 <> 0)",
        "merged AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '0-NONE' ELSE o_orderpriority END "
        "AS o_orderpriority, o_orderstatus FROM kept UNION ALL "
        "SELECT -o_orderkey, '0-NONE', o_orderstatus FROM kept WHERE o_orderkey % 3 = 0 AND o_orderkey <> 0)",
        select="SELECT o_orderstatus, o_orderpriority, count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS keys, "
        "'o_orderstatus' AS partition_columns, (SELECT count(DISTINCT o_orderstatus) FROM orders) AS num_partitions "
        "FROM merged GROUP BY o_orderstatus, o_orderpriority",
    ),
    "optimize_partitioned": "SELECT count(*) AS rows, count(*) FILTER (o_totalprice < 20000) AS cheap, "
    "count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent, count(*) AS read_for_cheap_before, "
    "count(*) AS read_for_urgent_before, true AS cheap_reads_under_half, true AS urgent_reads_under_six_tenths FROM orders",
    "vacuum_retained": with_(
        _BALANCES,
        _CHANGES,
        select="SELECT c_custkey, CASE WHEN segment = 'BUILDING' THEN balance + 1 ELSE balance END AS balance, segment "
        f"FROM balances WHERE c_custkey % 5 <> 0 UNION ALL {_NEW}",
    ),
}
