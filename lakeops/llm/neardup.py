"""Near-duplicate vectors by cross-polytope hashing with multiprobe buckets.

A hash turns a vector by three rounds of random signs and a fast Hadamard transform and
takes the nearest of the 2 d signed axes. A table joins ``hashes`` of them to one bucket
key; a vector lives in its own bucket and visits the ``probes`` next best ones, which
change the coordinate with the smallest loss. Vectors that meet are verified by cosine in
double precision. The number of tables follows from the wanted chance of a miss, measured
on pairs that are exactly as alike as the threshold.

Equal vectors are one class from the start. A bucket with more than ``BLOCK`` vectors is
cut into chunks, and every pair of chunks is a task unit of its own, so no bucket meets in
one task. A unit counts its links and gives one row per linked vector: its links, and the
smallest vector of its part of the unit. A pair is counted where it meets first, which the
keys of the tables before tell: a row of a table carries those and no later ones. Vectors
of floats travel as floats.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import small_side, staged
from lakeops.llm.graph import components

BLOCK = 1024
PAIRS_AT_ONCE = 100_000
MISS = 1e-6
PROBES = 2
BUCKET_ROWS = 64
MOST_WIDTHS = 64


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows; sums and differences only, so a row's
    result does not depend on the rows beside it."""
    n, d = x.shape
    half = 1
    while half < d:
        pairs = x.reshape(n, d // (2 * half), 2, half)
        x = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2).reshape(n, d)
        half *= 2
    return x


@dataclass
class Hasher:
    signs: np.ndarray  # tables, hashes, 3, width
    probes: int

    @staticmethod
    def new(width: int, tables: int, hashes: int, probes: int, seed: int) -> Hasher:
        rng = np.random.default_rng(seed)
        return Hasher(rng.choice([-1.0, 1.0], size=(tables, hashes, 3, width)), probes)

    def keys(self, x: np.ndarray) -> np.ndarray:
        """Bucket keys, (rows, tables, 1 + probes): the own bucket first."""
        tables, hashes, _, width = self.signs.shape
        padded = np.zeros((len(x), width))
        padded[:, : x.shape[1]] = x
        out = np.empty((len(x), tables, 1 + self.probes), dtype=np.int64)
        for t in range(tables):
            axes, losses = [], []
            for k in range(hashes):
                turned = padded
                for r in range(3):
                    turned = hadamard(turned * self.signs[t, k, r])
                both = np.concatenate([turned, -turned], axis=1)
                best = np.argpartition(-both, 2, axis=1)[:, :3]
                value = np.take_along_axis(both, best, axis=1)
                order = np.lexsort((best, -value), axis=1)
                axes.append(np.take_along_axis(best, order, axis=1))
                value = np.take_along_axis(value, order, axis=1)
                losses.append(value[:, :1] - value[:, 1:])
            weight = (2 * width) ** np.arange(hashes, dtype=np.int64)
            own = sum(a[:, 0] * w for a, w in zip(axes, weight, strict=True))
            out[:, t, 0] = own
            loss = np.concatenate(losses, axis=1)
            moved = np.concatenate(
                [own[:, None] + (a[:, 1:] - a[:, :1]) * w for a, w in zip(axes, weight, strict=True)], axis=1
            )
            order = np.argsort(loss, axis=1, kind="stable")[:, : self.probes]
            out[:, t, 1:] = np.take_along_axis(moved, order, axis=1)
        return out


def design(rows: int, width: int, threshold: float, probes: int = PROBES, miss: float = MISS, seed: int = 5) -> Hasher:
    """Hashes per table from the number of rows, tables from the chance to meet in one.

    Pairs at the threshold are hashed by the very functions to measure that chance; more
    alike pairs meet more often. The wanted miss holds at every size.
    """
    hashes = 1
    while BUCKET_ROWS * (2 * width) ** hashes < rows and hashes < 8:
        hashes += 1
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((2000, width))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.standard_normal((2000, width))
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    y = threshold * x + np.sqrt(1 - threshold**2) * y
    trial = Hasher.new(width, 4, hashes, min(probes, 2 * hashes), seed)
    a, b = trial.keys(x), trial.keys(y)
    meet = (a[:, :, :1] == b).any(axis=2) | (b[:, :, :1] == a).any(axis=2)
    chance = min(max(meet.mean(), 0.01), 0.999)
    tables = max(2, int(np.ceil(np.log(miss) / np.log1p(-chance))))
    return Hasher.new(width, tables, hashes, min(probes, 2 * hashes), seed + 1)


def _unit_links(
    unit: tuple[int, int, int, int], rows: pd.DataFrame, threshold: float, visits: int
) -> pd.DataFrame | None:
    """Links of one unit (table, bucket, two chunks) that are met first here."""
    table, bucket, low, high = unit
    x = np.stack(rows["x"].to_numpy()).astype(np.float64)
    norm = np.sqrt((x * x).sum(axis=1))
    own, chunk = rows["own"].to_numpy(), rows["chunk"].to_numpy()
    left = np.flatnonzero(chunk == low)
    right = left if low == high else np.flatnonzero(chunk == high)
    if not len(left) or not len(right):
        return None
    alike = (x[left] @ x[right].T) >= threshold * np.outer(norm[left], norm[right])
    alike &= own[left][:, None] | own[right][None, :]
    if low == high:
        alike = np.triu(alike, 1)
    i, j = np.nonzero(alike)
    if not i.size:
        return None
    i, j = left[i], right[j]
    keys = np.stack(rows["keys"].to_numpy()).reshape(-1, table + 1, visits)
    first = np.empty(i.size, dtype=bool)
    for at in range(0, i.size, PAIRS_AT_ONCE):
        a, b = keys[i[at : at + PAIRS_AT_ONCE]], keys[j[at : at + PAIRS_AT_ONCE]]
        in_a = (a[:, :, :1] == b).any(axis=2)
        in_b = (b[:, :, :1] == a).any(axis=2)
        t = (in_a | in_b).argmax(axis=1)
        n = np.arange(len(a))
        top = np.iinfo(np.int64).max
        where = np.minimum(np.where(in_a[n, t], a[n, t, 0], top), np.where(in_b[n, t], b[n, t, 0], top))
        first[at : at + PAIRS_AT_ONCE] = (t == table) & (where == bucket)
    i, j = i[first], j[first]
    if not i.size:
        return None
    copies = rows["copies"].to_numpy()
    links = np.bincount(i, weights=copies[j], minlength=len(rows)) + np.bincount(j, weights=copies[i], minlength=len(rows))
    cid = rows["cid"].to_numpy()
    root = cid.copy()
    while True:
        before = root.copy()
        np.minimum.at(root, i, before[j])
        np.minimum.at(root, j, root[i])
        if (root == before).all():
            break
    linked = np.flatnonzero(links)
    return pd.DataFrame({"cid": cid[linked], "links": links[linked].astype(np.int64), "root": root[linked]})


def links(
    df: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 5
) -> DataFrame:
    """vec_id, n_links, component_id, kept and copies of every row.

    Rows whose vector is null, empty, zero, or holds null or non-finite numbers link with
    nothing, equal ones included. Vectors of different lengths do not link; each length is
    searched by itself, and more than ``MOST_WIDTHS`` lengths are refused with an error. A
    component is named by its smallest id; null ids count as rows but name nothing, and ``kept`` is false
    for them. Rows with equal ids count each. Other columns are not read.
    """
    # Floats are exact as doubles, which tasks make of them.
    number = "float" if df.schema[vector_col].dataType.simpleString() == "array<float>" else "double"
    x = F.col(vector_col).cast(f"array<{number}>")
    given = df.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.col("x").isNotNull() & (F.size("x") > 0) & finite & F.exists("x", lambda v: v != 0)
    usable = F.coalesce(usable, F.lit(False))
    lone = given.where(~F.coalesce(usable, F.lit(False))).select(
        "vec_id",
        F.lit(0).cast("long").alias("n_links"),
        F.col("vec_id").alias("component_id"),
        F.col("vec_id").isNotNull().alias("kept"),
        F.lit(1).cast("long").alias("copies"),
    )
    rows = given.where(usable)
    widths = [r["w"] for r in rows.select(F.size("x").alias("w")).distinct().limit(MOST_WIDTHS + 1).collect()]
    if len(widths) > MOST_WIDTHS:
        raise ValueError(f"vectors of more than {MOST_WIDTHS} lengths")
    found = lone
    for width in sorted(widths):
        found = found.unionByName(_of_width(rows.where(F.size("x") == width), width, threshold, seed, number))
    return found


def _of_width(rows: DataFrame, width: int, threshold: float, seed: int, number: str) -> DataFrame:
    """The same for rows (vec_id, x) whose vectors are usable and have one length, x of a
    type of number."""
    classes = rows.groupBy("x").agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("copies"))
    classes = staged(classes.withColumn("cid", F.monotonically_increasing_id()), "vectors")
    total = classes.count()
    hasher = design(total, 1 << max(1, (width - 1).bit_length()), threshold, seed=seed)
    shape = (hasher.signs.shape[0], 1 + hasher.probes)

    def place(whole: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for at in range(0, len(batch), 2048):
                    part = batch.iloc[at : at + 2048]
                    keys = hasher.keys(np.stack(part["x"].to_numpy()))
                    n = len(part)
                    out = {
                        "t": np.tile(np.repeat(np.arange(shape[0]), shape[1]), n).astype(np.int32),
                        "bucket": keys.reshape(-1),
                        "own": np.tile(np.arange(shape[1]) == 0, n * shape[0]),
                    }
                    if whole:
                        index = np.repeat(np.arange(n), shape[0] * shape[1])
                        out["cid"] = part["cid"].to_numpy()[index]
                        out["copies"] = part["copies"].to_numpy()[index]
                        out["x"] = part["x"].to_numpy()[index]
                        out["keys"] = [row[: t + 1].reshape(-1) for row in keys for t in range(shape[0]) for _ in range(shape[1])]
                    yield pd.DataFrame(out)

        return run

    key_type = "t int, bucket long, own boolean"
    sizes = classes.select("x").mapInPandas(place(False), key_type).groupBy("t", "bucket")
    sizes = sizes.agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("lived"))
    sizes = staged(sizes.where("n > 1 AND lived").select("t", "bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("c")), "buckets")
    placed = classes.select("cid", "copies", "x").mapInPandas(
        place(True), key_type + f", cid long, copies long, x array<{number}>, keys array<long>"
    )
    placed = placed.join(small_side(sizes), ["t", "bucket"])
    chunk = F.pmod(F.xxhash64("cid"), F.col("c")).cast("int")
    placed = placed.withColumn("chunk", chunk).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("c") - 1))
    )
    unit = ["t", "bucket", "low", "high"]
    units = placed.withColumn("low", F.least("chunk", "other")).withColumn("high", F.greatest("chunk", "other"))
    units = units.drop("other", "c").repartition(*unit).sortWithinPartitions(*unit)

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None

        def process(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
            names = frame[unit].to_numpy()
            cuts = np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1
            for part in np.split(np.arange(len(frame)), cuts):
                if len(part) > 1:
                    found = _unit_links(tuple(names[part[0]]), frame.iloc[part[0] : part[-1] + 1], threshold, shape[1])
                    if found is not None:
                        yield found

        for batch in batches:
            frame = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if not len(frame):
                continue
            names = frame[unit].to_numpy()
            last = int(np.flatnonzero((names != names[-1]).any(axis=1)).max(initial=-1)) + 1
            if last:
                yield from process(frame.iloc[:last])
            held = frame.iloc[last:]
        if held is not None and len(held):
            yield from process(held)

    found = staged(units.mapInPandas(verify, "cid long, links long, root long"), "vector-links")
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    parts = components(found, "cid", "root")
    told = classes.join(counts, "cid", "left").join(parts.withColumnRenamed("node", "cid"), "cid", "left")
    told = staged(
        told.select(
            "x",
            "copies",
            "low",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "cid").alias("component"),
        ),
        "vector-classes",
    )
    names = staged(told.groupBy("component").agg(F.min("low").alias("component_id")), "vector-names")
    named = staged(told.join(names, "component"), "vector-named")
    return rows.join(named, "x").select(
        "vec_id",
        "n_links",
        "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"),
        "copies",
    )
