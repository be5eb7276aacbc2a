"""Properties on small generated tables."""

from collections import Counter
from itertools import combinations
from math import factorial

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeops import scratch
from lakeops.functions.scalar import key_bucket
from lakeops.ml import attribution, regression
from lakeops.ml.scoring import predictor
from lakeops.operators import dml, layout, sampling, sizing, skew, stats
from lakeops.sources import views
from lakeops.sources.files import file_inventory, literal_rows
from lakeops.sinks.files import write_small_files
from lakeops.tables.versioned import VersionedTable

few = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
keys = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d", "e"]))
rows = st.lists(st.tuples(keys, st.one_of(st.none(), st.integers(0, 9))), max_size=12)
unique = st.dictionaries(st.sampled_from(["a", "c", "e", "x", "y"]), st.one_of(st.none(), st.integers(10, 19)), max_size=5)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def upserted(target, source):
    out = Counter((k, source[k]) if k in source else (k, v) for k, v in target)
    have = {k for k, _ in target}
    out.update((k, v) for k, v in source.items() if k not in have)
    return out


@few
@given(target=rows, source=unique)
@pytest.mark.parametrize("small, hot", [(True, False), (False, False), (False, True)])
def test_both_upserts(spark, monkeypatch, small, hot, target, source):
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 10**6 if small else -1)
    monkeypatch.setattr(skew, "HOT_ROWS", 1 if hot else 10**6)
    t = literal_rows(spark, target, views.LOAN_SCHEMA)
    s = literal_rows(spark, list(source.items()), views.LOAN_SCHEMA)
    wanted = upserted(target, source)
    assert bag(dml.merge_upsert(t, s, ["addr_state"])) == wanted
    assert bag(dml.upsert_three_way(t, s, ["addr_state"])) == wanted


steps = st.lists(
    st.one_of(
        st.tuples(st.just("insert"), rows.filter(len)),
        st.tuples(st.just("delete"), st.sampled_from("abcde")),
        st.tuples(st.just("update"), st.sampled_from("abcde")),
        st.tuples(st.just("merge"), unique),
        st.tuples(st.just("overwrite"), rows),
        st.tuples(st.just("restore"), st.integers(0, 9)),
        st.tuples(st.just("optimize"), st.none()),
    ),
    min_size=3,
    max_size=5,
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(start=rows, changes=steps)
@pytest.mark.parametrize("few_removed", [True, False])
def test_versions_equal_replay(spark, monkeypatch, few_removed, start, changes):
    import lakeops.tables.versioned as versioned

    monkeypatch.setattr(versioned, "BROADCAST_ROWS", 10**6 if few_removed else -1)
    table = VersionedTable.create(
        spark, scratch.fresh(spark, "replay"), literal_rows(spark, start, views.LOAN_SCHEMA)
    )
    states = [Counter(start)]
    for kind, value in changes:
        now = states[-1]
        if kind == "insert":
            table.insert(value)
            states.append(now + Counter(value))
        elif kind == "delete":
            table.delete(F.col("addr_state") == value)
            states.append(Counter({r: n for r, n in now.items() if r[0] != value}))
        elif kind == "update":
            table.update(F.col("addr_state") == value, {"cnt": 99})
            new = Counter()
            for (k, v), n in now.items():
                new[(k, 99 if k == value else v)] += n
            states.append(new)
        elif kind == "merge":
            table.merge(literal_rows(spark, list(value.items()), views.LOAN_SCHEMA), ["addr_state"])
            states.append(upserted(list(now.elements()), value))
        elif kind == "overwrite":
            table.overwrite(literal_rows(spark, value, views.LOAN_SCHEMA))
            states.append(Counter(value))
        elif kind == "restore":
            back = value % len(states)
            table.restore(back)
            states.append(states[back])
        else:
            table.optimize()
            states.append(now)
    for version, wanted in enumerate(states):
        assert bag(table.as_of(version)) == wanted, (version, changes)
    changed = bag(table.diff(0, len(states) - 1))
    added = Counter({r[1:]: n for r, n in changed.items() if r[0] == "added"})
    removed = Counter({r[1:]: n for r, n in changed.items() if r[0] == "removed"})
    assert states[0] - removed + added == states[-1]
    table.vacuum(0, force=True)
    assert bag(table.read()) == states[-1]


def test_split_parts_are_disjoint_and_complete(spark, sf_dir):
    data = views.price(spark, sf_dir)
    before = data.repartition(5)
    parts = sampling.hash_split(before, views.PRICE_KEYS, sampling.PRICE_KEY_FACTORS, (1, 2, 7))
    again = sampling.hash_split(data.repartition(3), views.PRICE_KEYS, sampling.PRICE_KEY_FACTORS, (1, 2, 7))
    keyed = [bag(p.select(views.PRICE_KEYS)) for p in parts]
    assert sum(keyed, Counter()) == bag(data.select(views.PRICE_KEYS))
    assert not any(set(a) & set(b) for a, b in combinations(keyed, 2))
    assert keyed == [bag(p.select(views.PRICE_KEYS)) for p in again]


def test_sample_does_not_depend_on_partitioning(spark, sf_dir):
    data = views.price(spark, sf_dir)
    one = sampling.sample_n(data.repartition(7), 10, views.PRICE_KEYS, 3)
    two = sampling.sample_n(data.coalesce(1), 10, views.PRICE_KEYS, 3)
    assert bag(one.select(views.PRICE_KEYS)) == bag(two.select(views.PRICE_KEYS))


@pytest.mark.parametrize("cluster", [[], ["dow"], ["dow", "month"]])
def test_rewrite_keeps_rows_and_cuts_hot_values(spark, sf_dir, path, cluster):
    flights = views.flights(spark, sf_dir)
    # Three quarters of all rows share one origin and one day.
    hot = flights.withColumn("origin", F.when(F.col("month") <= 9, 1).otherwise(F.col("origin"))).withColumn(
        "dow", F.when(F.col("month") <= 9, 1).otherwise(F.col("dow")).cast("long")
    )
    small = write_small_files(hot, f"{path}/small", ["origin"], 20)
    size = layout.folder_bytes(spark, f"{path}/small")
    out = layout.rewrite_folder(
        spark, f"{path}/small", f"{path}/out", small.schema, ["origin"], cluster, target_bytes=size // 8
    )
    assert bag(small) == bag(out)
    before, after = (file_inventory(spark, f"{path}/{p}").count() for p in ("small", "out"))
    assert after < before
    per_file = out.groupBy(F.col("_metadata.file_path")).count().agg(F.max("count")).first()[0]
    assert per_file < 0.4 * hot.count()


def test_clustering_narrows_row_ranges(spark, sf_dir, path):
    small = write_small_files(views.flights(spark, sf_dir), f"{path}/small", ["origin"], 4)
    size = layout.folder_bytes(spark, f"{path}/small")

    def spread(df, column):
        ranges = df.groupBy(F.col("_metadata.file_path")).agg((F.max(column) - F.min(column)).alias("w"))
        return ranges.agg(F.avg("w")).first()[0]

    one = layout.rewrite_folder(spark, f"{path}/small", f"{path}/one", small.schema, [], ["dow"], size // 8)
    two = layout.rewrite_folder(spark, f"{path}/small", f"{path}/two", small.schema, [], ["dow", "month"], size // 8)
    assert spread(one, "dow") <= 2
    assert spread(two, "dow") < 0.8 * spread(small, "dow")
    assert spread(two, "month") < 0.8 * spread(small, "month")


def exact_shares(f, row, points, shares, count):
    def value(members):
        return sum(
            w * f(*[row[i] if i in members else p[i] for i in range(count)]) for p, w in zip(points, shares)
        )

    out = []
    for i in range(count):
        total = 0.0
        others = [j for j in range(count) if j != i]
        for mask in range(1 << len(others)):
            members = {others[b] for b in range(len(others)) if mask >> b & 1}
            weight = factorial(len(members)) * factorial(count - len(members) - 1) / factorial(count)
            total += weight * (value(members | {i}) - value(members))
        out.append(total)
    return out


@pytest.mark.parametrize("method", ["exact", "sampled"])
def test_shapley_against_brute_force(spark, method):
    names = ["p", "q", "r"]
    data = literal_rows(spark, [(1, 1.0, 2.0, 3.0), (2, -1.0, 0.5, 2.0)], "id long, p double, q double, r double")
    points = literal_rows(
        spark, [(1, 0.0, 0.0, 1.0), (3, 2.0, 1.0, 0.0)], "weight long, p double, q double, r double"
    )
    model = predictor(F.col("p") * F.col("q") + F.col("r") * F.col("r") - 2 * F.col("p") * F.col("r"))
    got = attribution.shapley_values(data, ["id"], names, points, model, samples=400, method=method).collect()
    for row in data.collect():
        wanted = exact_shares(
            lambda p, q, r: p * q + r * r - 2 * p * r, row[1:], [(0, 0, 1), (2, 1, 0)], [0.25, 0.75], 3
        )
        mine = {g.feature: g.phi for g in got if g.id == row.id}
        assert sum(mine.values()) == pytest.approx(sum(wanted), abs=1e-9)
        assert [mine[n] for n in names] == pytest.approx(wanted, abs=1e-9 if method == "exact" else 0.4)


def test_components_are_orthonormal_and_centred(spark, sf_dir):
    data = views.price(spark, sf_dir)
    fitted = regression.fit_components(data, views.PRICE_FEATURES, 3)
    axes = fitted.stages[-1].pc.toArray()
    assert np.allclose(axes.T @ axes, np.eye(3), atol=1e-9)
    shares = fitted.stages[-1].explainedVariance.toArray()
    assert list(shares) == sorted(shares, reverse=True)
    from pyspark.ml.functions import vector_to_array

    points = np.array([r[0] for r in fitted.transform(data).select(vector_to_array("features")).collect()])
    assert np.allclose(points.mean(axis=0), 0, atol=1e-9)


def test_histogram_against_numpy(spark, sf_dir):
    data = views.price(spark, sf_dir)
    values = np.array([r[0] for r in data.select("price").collect()])
    wanted, edges = np.histogram(values, 10)
    got = stats.histogram(data, ["price"]).orderBy("bin").collect()
    assert [g.n for g in got] == list(wanted)
    assert [g.bin_lo for g in got] == pytest.approx(list(edges[:-1]))
    flat = stats.histogram(data.select(F.lit(3.0).alias("v")), ["v"]).orderBy("bin").collect()
    assert [g.n for g in flat] == list(np.histogram(np.full(len(values), 3.0), 10)[0])


def test_update_keeps_nulls_and_changes_nan(spark):
    rows = literal_rows(spark, [(1, None), (2, float("nan")), (3, -1.0), (4, 2.0)], "id long, x double")
    out = {r.id: r.x for r in dml.update_where(rows, F.col("x") >= 0.0, {"x": 0.0}).collect()}
    assert out == {1: None, 2: 0.0, 3: -1.0, 4: 0.0}


def test_measured_size(spark):
    df = literal_rows(spark, [("abc", 1), (None, 2)], "a string, b long")
    assert sizing.measure(df) == (2, 2 * (sizing.ROW_OVERHEAD + 8) + 3)
    assert sizing.fits_broadcast(df)


def test_key_bucket_is_never_negative(spark):
    df = literal_rows(spark, [(-7,), (7,)], "k long").select(key_bucket(["k"], [31], 4).alias("b"))
    assert all(0 <= r.b < 4 for r in df.collect())


def _line_with_outliers(spark):
    """Two groups of y = 2 x + 1, one of them the null group, with every 17th row far off."""
    return spark.range(4000).selectExpr(
        "CASE WHEN id % 2 = 0 THEN 'a' END AS g",
        "id / 4000.0D AS x",
        "2 * (id / 4000.0D) + 1 + 0.01D * sin(id) + CASE WHEN id % 17 = 0 THEN 100 * (id / 4000.0D) ELSE 0 END AS y",
    )


def test_robust_steps_unbend_the_trend(spark):
    df = _line_with_outliers(spark)
    bent = stats.local_trend(df, "x", "y", "g").collect()
    assert max(abs(r.trend - (2 * r.x + 1)) for r in bent) > 3
    straight = stats.local_trend(df, "x", "y", "g", robust_steps=3).collect()
    assert len(straight) == len(bent) == 42
    assert max(abs(r.trend - (2 * r.x + 1)) for r in straight) < 0.02


def test_robust_steps_shuffled_groups_give_the_same(spark, monkeypatch):
    df = _line_with_outliers(spark)
    wanted = {(r.g, round(r.x, 9)): r.trend for r in stats.local_trend(df, "x", "y", "g", robust_steps=1).collect()}
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", -1)
    found = stats.local_trend(df.repartition(7), "x", "y", "g", robust_steps=1).collect()
    assert len(found) == len(wanted)
    assert all(abs(r.trend - wanted[r.g, round(r.x, 9)]) < 1e-9 for r in found)


def test_robust_steps_of_odd_rows(spark):
    kind = "g string, x double, y double"
    assert stats.local_trend(spark.createDataFrame([], kind), "x", "y", "g", robust_steps=2).count() == 0
    # An exact line, a group of one row, zeros only, and rows without x or y.
    rows = [("line", i / 50, i / 50) for i in range(51)] + [("one", 0.5, 3.0)]
    rows += [("zero", i / 10, 0.0) for i in range(11)] + [("line", None, 9.0), ("line", 0.1, None)]
    found = stats.local_trend(spark.createDataFrame(rows, kind), "x", "y", "g", robust_steps=2).collect()
    for r in found:
        assert abs(r.trend - {"line": r.x, "one": 3.0, "zero": 0.0}[r.g]) < 1e-6
    assert len([r for r in found if r.g == "zero"]) == 21


def test_no_task_sorts_more_than_its_memory(spark, path, monkeypatch):
    """Rows that are small in files are still cut into tasks by what they take in memory."""
    df = spark.range(4000).selectExpr("id % 2 AS origin", "CAST(1 AS BIGINT) AS dow")
    df.write.parquet(f"{path}/small")
    monkeypatch.setattr(layout, "SORT_BYTES", 80 * 500)
    for by, cluster in ((["origin"], []), (["origin"], ["dow"]), ([], ["dow"])):
        out = layout.rewrite_folder(spark, f"{path}/small", f"{path}/{len(by)}{len(cluster)}", df.schema, by, cluster)
        counts = [r[1] for r in out.groupBy(F.input_file_name()).count().collect()]
        assert sum(counts) == 4000 and len(counts) >= 8 and max(counts) <= 1000


def test_writes_by_value_do_not_sort(spark, path):
    """Few values keep a file each open, and the session's setting comes back."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before, found = spark.conf.get(name, "0"), []
    from lakeops.sinks import files

    with files.open_files(spark):
        found.append(spark.conf.get(name))
    df = spark.range(100).selectExpr("id", "id % 3 AS k")
    assert files.write_partitioned(df, path, ["k"]).groupBy("k").count().count() == 3
    assert spark.conf.get(name, "0") == before and int(found[0]) >= 3


def test_a_row_looks_up_its_line_once(spark):
    rows = spark.createDataFrame([("a", 0.1, 1.0), ("a", 0.9, 2.0), ("b", 0.5, 3.0)], "g string, _x double, _y double")
    lines = spark.createDataFrame([("a", [1.0, None, 3.0]), ("b", [None, None, None])], "g string, _line array<double>")
    out = stats._beside(rows, lines, "g", 3)
    assert {(r.g, r._x): r._residual for r in out.collect()} == {("a", 0.1): 0.0, ("a", 0.9): -1.0, ("b", 0.5): None}
    weighed = out.withColumn("_far", F.abs("_residual")).select(F.col("_far") * F.col("_far") + F.col("_far"))
    plan = weighed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("_line#") - plan.count("LogicalRDD") and sum("_line" in part for part in plan.split("Project")[1:-1]) <= 4
