"""Clustering of integer vectors around centroids, each assignment by a bisector tournament.

For two centroids the points nearer to one lie on one side of their bisector, whose normal
``2 * (c_j - c_i)`` and threshold ``|c_j|^2 - |c_i|^2`` are integers. They are made once a
round for every pair. A vector then meets the centroids in order: one sign test against the
present winner eliminates one of the two, and zero favours the smaller number, so k - 1
tests leave the nearest centroid and only its distance is computed. All numbers are
integers, so the result does not depend on how the rows are partitioned.

Tasks send k partial sums each; the driver holds k centroids, never rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import staged

# Components of at most this size give distances that a long holds for up to 64 of them.
LARGEST = 1 << 27


class Bisectors:
    """Normals and thresholds of all centroid pairs, and the tournament on them."""

    def __init__(self, centroids: list[list[int]]):
        self.centres = np.array(centroids, dtype=np.int64)
        squares = (self.centres**2).sum(axis=1)
        self.normals = 2 * (self.centres[None, :, :] - self.centres[:, None, :])
        self.thresholds = squares[None, :] - squares[:, None]

    def nearest(self, points: np.ndarray) -> np.ndarray:
        """Number of the nearest centroid of every row; ties go to the smaller number."""
        winner = np.zeros(len(points), dtype=np.int64)
        for rival in range(1, len(self.centres)):
            side = np.einsum("ij,ij->i", points, self.normals[winner, rival]) - self.thresholds[winner, rival]
            winner[side > 0] = rival
        return winner

    def distance(self, points: np.ndarray, winner: np.ndarray) -> np.ndarray:
        return ((points - self.centres[winner]) ** 2).sum(axis=1)


def integers(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def usable(vector: Column, width: int) -> Column:
    """Exactly ``width`` components, none null or non-finite."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )
    return F.coalesce((F.size(vector) == width) & finite, F.lit(False))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _sums(points: DataFrame, bisectors: Bisectors, width: int) -> dict[int, tuple[int, list[int]]]:
    """Row count and exact component sums of every centroid's rows."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(bisectors.centres)
        counts = np.zeros(k, dtype=np.int64)
        totals = np.zeros((k, width), dtype=np.int64)
        for batch in batches:
            rows = _matrix(batch.column("point"), width)
            winner = bisectors.nearest(rows)
            counts += np.bincount(winner, minlength=k)
            order = np.argsort(winner, kind="stable")
            held, first = np.unique(winner[order], return_index=True)
            if len(held):
                totals[held] += np.add.reduceat(rows[order], first, axis=0)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pandas(
            pd.DataFrame(
                {
                    "cluster": np.repeat(held, width).astype(np.int32),
                    "place": np.tile(np.arange(width, dtype=np.int32), len(held)),
                    "n": np.repeat(counts[held], width),
                    "total": totals[held].ravel(),
                }
            ),
            preserve_index=False,
        )

    parts = points.select("point").mapInArrow(add, "cluster int, place int, n long, total long")
    sums = parts.groupBy("cluster", "place").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    )
    found: dict[int, tuple[int, list[int]]] = {}
    # k x width rows at most, whatever the input.
    for row in sums.orderBy("cluster", "place").collect():
        found.setdefault(row["cluster"], (row["n"], []))[1].append(int(row["total"]))
    return found


def cluster(
    df: DataFrame,
    k: int = 16,
    width: int = 64,
    rounds: int = 3,
    scale: int = 64,
    seed: int = 1,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row per usable vector: its cluster, squared distance, inertias and final centroid.

    A component x counts as the integer floor(scale * x). The first centroids are the ``k``
    usable vectors with the smallest sha256 of ``seed:id``; equal ids are ordered by their
    components and null ids come last. Each of ``rounds`` rounds assigns all vectors and
    moves every centroid that has some to floor(sum / count) of their components; then they
    are assigned once more.

    Vectors that are null, of another width or hold null or non-finite components are left
    out. Fewer usable vectors than ``k`` give fewer centroids, none give no rows. Repeated
    rows stay repeated. Other columns are not read. A component whose integer is beyond
    ``LARGEST`` raises: its distances would not fit a long.
    """
    vector = F.col(vector_col)
    kept = df.where(usable(vector, width)).select(F.col(id_col).alias("vec_id"), vector.alias("point"))
    largest = F.array_max(F.transform("point", lambda x: F.abs(F.lit(float(scale)) * x.cast("double"))))
    fits = F.when(largest < LARGEST, F.col("point")).otherwise(
        F.raise_error(F.lit(f"a component times {scale} is beyond {LARGEST}"))
    )
    points = staged(kept.select("vec_id", integers(fits, scale).alias("point")), "cluster-points")

    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = points.orderBy(key.asc_nulls_last(), "point").limit(k).collect()
    schema = points.schema["vec_id"].dataType.simpleString()
    out = f"vec_id {schema}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not first:
        return df.sparkSession.createDataFrame([], out)
    centres = [[int(x) for x in row["point"]] for row in first]
    for _ in range(rounds):
        for number, (n, totals) in _sums(points, Bisectors(centres), width).items():
            centres[number] = [total // n for total in totals]

    last = Bisectors(centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column("point"), width)
            winner = last.nearest(rows)
            columns = [batch.column("vec_id"), pa.array(winner.astype(np.int32)), pa.array(last.distance(rows, winner))]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    assigned = staged(points.mapInArrow(assign, f"vec_id {schema}, cluster int, distance long"), "cluster-rows")
    inertia = {r["cluster"]: r["total"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    digests = [hashlib.sha256(",".join(map(str, centre)).encode()).hexdigest() for centre in centres]

    def by_cluster(values: list) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("cluster") + 1)

    return assigned.select(
        "vec_id",
        "cluster",
        "distance",
        by_cluster([int(inertia.get(i, 0)) for i in range(len(centres))]).cast("long").alias("cluster_inertia"),
        F.lit(int(sum(inertia.values()))).cast("long").alias("inertia"),
        by_cluster(digests).alias("centroid_sha256"),
    )
