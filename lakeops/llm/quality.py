"""Quality classifier: regularised quadratic discriminant over document statistics.

Every text becomes a vector of transformed statistics, in one pass that the fit and the
scores share. The class moments are sums over all labelled rows, made on the executors;
only two means and two d x d covariances reach the driver. Each covariance is shrunk to the
pooled one and that to a multiple of the identity; its Cholesky factor is kept, and a
document's score is the logistic function of the difference of log densities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm import words as W
from lakeops.llm.common import held_out, map_slices, rows_where, staged

STATISTICS = [
    "length",
    "upper",
    "symbols",
    "exclamations",
    "bars",
    "digits",
    "repeats",
    "variety",
    "word_length",
    "stops",
    "top_word",
    "run_variety",
    "lines",
    "decorated",
]
# What a short text is filled up with.
BYTES, WORDS = 100.0, 20.0
POOLED_SHARE = 0.2
IDENTITY_SHARE = 0.05

_STOPS = W._ascii_mask(".,;:?")
_SYMBOLS = W._ascii_mask("#$%&*+/<=>@\\^_`{}~")
_PLAIN_END = np.array([i >= 128 or chr(i).isalnum() or chr(i) in ".,;:?'\")" for i in range(256)])


def statistics(texts: list[str | None]) -> np.ndarray:
    """One row of ``STATISTICS`` per text. Shares enter as logarithms. They are drawn to
    what is usual in prose by ``BYTES`` bytes or ``WORDS`` words, so that short and empty
    texts look ordinary unless they show something else."""
    w = W.split(texts)
    n = w.docs
    cells = w.text_starts[:-1]
    bytes_ = (np.diff(w.text_starts) - 1).astype(float)

    def count(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask[w.data].astype(np.int64), cells).astype(float) if n else np.zeros(0)

    upper = count(np.array([65 <= i <= 90 for i in range(256)]))
    lower = count(np.array([97 <= i <= 122 for i in range(256)]))
    many = np.bincount(w.doc, minlength=n).astype(float)
    letters = np.bincount(w.doc, weights=w.end - w.start, minlength=n)
    same = np.zeros(w.doc.size)
    same[1:] = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    last = w.data[np.maximum(w.end - 1, 0)]
    d_doc, _, times = W.distinct(w.doc, w.hash)
    top = np.zeros(n)
    np.maximum.at(top, d_doc, times)
    s_doc, s_hash = W.shingles(w, 3)
    runs = np.bincount(s_doc, minlength=n).astype(float)
    run_kinds = np.bincount(W.distinct(s_doc, s_hash)[0], minlength=n).astype(float)

    def share(part: np.ndarray, whole: np.ndarray, usual: float, weight: float) -> np.ndarray:
        return np.log((part + weight * usual) / (whole + weight))

    columns = [
        np.log1p(many),
        np.log((upper + 0.03 * BYTES) / (lower + 0.97 * BYTES)),
        share(count(_SYMBOLS), bytes_, 0.002, BYTES),
        share(count(W._ascii_mask("!")), bytes_, 0.002, BYTES),
        share(count(W._ascii_mask("|")), bytes_, 0.002, BYTES),
        share(count(np.array([48 <= i <= 57 for i in range(256)])), bytes_, 0.005, BYTES),
        share(np.bincount(w.doc, weights=same, minlength=n), many, 0.01, WORDS / 4),
        share(np.bincount(d_doc, minlength=n).astype(float), many, 0.9, WORDS),
        np.log((letters + 5 * WORDS) / (many + WORDS)),
        share(np.bincount(w.doc, weights=_STOPS[last], minlength=n), many, 0.15, WORDS),
        share(top, many, 0.08, WORDS),
        share(run_kinds, runs, 0.98, WORDS),
        share(count(W._ascii_mask("\n")) - 1, many, 0.02, WORDS),
        share(np.bincount(w.doc, weights=~_PLAIN_END[last], minlength=n), many, 0.01, WORDS),
    ]
    return np.stack(columns, axis=1) if n else np.zeros((0, len(STATISTICS)))


def describe(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, held_out, x: the statistics of every row."""

    def measure(part: pd.DataFrame) -> pd.DataFrame:
        x = statistics(list(part.pop("text")))
        return part.assign(x=list(x))

    key = F.col(id_col).cast("long")
    rows = df.select(
        F.coalesce(key, F.lit(0)).alias("doc_id"),
        key.isNull().alias("no_id"),
        F.col(text_col).cast("string").alias("text"),
    )
    out = map_slices(rows, measure, "doc_id long, no_id boolean, x array<double>")
    out = out.select(F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "x")
    return staged(out.withColumn("held_out", held_out("doc_id")), "quality-statistics")


@dataclass
class Discriminant:
    """Class means and inverse Cholesky factors of the shrunk covariances, over scaled inputs."""

    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    offset: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.centre) / self.scale
        distance = [((z - m) @ f.T) ** 2 for m, f in zip(self.means, self.factors, strict=True)]
        logit = self.offset + 0.5 * (distance[0].sum(axis=1) - distance[1].sum(axis=1))
        return 1.0 / (1.0 + np.exp(-np.clip(logit, -500, 500)))


def fit(described: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id") -> Discriminant | None:
    """Fit on all labelled rows that are not held out; None unless both classes occur."""
    d = len(STATISTICS)
    marks = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
    known = described.where("NOT held_out").join(marks.where("y IN (0, 1)"), "doc_id").select("y", "x")

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, (d + 1) * (d + 1)))
        for batch in batches:
            y = batch["y"].to_numpy()
            x = np.stack(batch["x"].to_numpy()) if len(batch) else np.zeros((0, d))
            x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
            for k in (0, 1):
                total[k] += (x[y == k].T @ x[y == k]).ravel()
        yield pd.DataFrame(
            {"y": np.repeat([0, 1], total.shape[1]), "i": np.tile(np.arange(total.shape[1]), 2), "v": total.ravel()}
        )

    sums = known.mapInPandas(moments, "y int, i int, v double").groupBy("y", "i").agg(F.sum("v").alias("v"))
    total = np.zeros((2, (d + 1) * (d + 1)))
    for row in sums.collect():  # 2 (d + 1)**2 rows
        total[row["y"], row["i"]] = row["v"]
    total = total.reshape(2, d + 1, d + 1)
    n = total[:, 0, 0]
    if n.min() < 1:
        return None
    means = total[:, 0, 1:] / n[:, None]
    spread = [total[k, 1:, 1:] / n[k] - np.outer(means[k], means[k]) for k in (0, 1)]
    pooled = (n[0] * spread[0] + n[1] * spread[1]) / n.sum()
    centre = (n @ means) / n.sum()
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
    means, unit = (means - centre) / scale, np.outer(scale, scale)
    factors, dets = [], []
    for k in (0, 1):
        shrunk = (1 - POOLED_SHARE) * spread[k] / unit + POOLED_SHARE * pooled / unit
        shrunk = (1 - IDENTITY_SHARE) * shrunk + IDENTITY_SHARE * np.trace(shrunk) / d * np.eye(d)
        lower = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.inv(lower))
        dets.append(2 * np.log(np.diag(lower)).sum())
    offset = np.log(n[1] / n[0]) - 0.5 * (dets[1] - dets[0])
    return Discriminant(centre, scale, means, np.stack(factors), float(offset))


def classify(
    df: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    threshold: float = 0.3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, held_out, score (likelihood of label 1) and predicted (score >= threshold) of
    every row.

    Null and empty texts are scored by their statistics like others. Without labels of both
    classes every score is 0.5. A null id is never held out and never labelled. Rows with
    equal ids each count. Other columns are not read.
    """
    described = describe(df, id_col, text_col)
    model = fit(described, labels, label_col, id_col)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch.pop("x")
            values = model.scores(np.stack(x.to_numpy())) if model and len(batch) else np.full(len(batch), 0.5)
            yield batch.assign(score=values, predicted=(values >= threshold).astype(np.int32))

    key = F.coalesce("doc_id", F.lit(0)).alias("doc_id")
    rows = described.select(key, F.col("doc_id").isNull().alias("no_id"), "held_out", "x")
    out = rows.mapInPandas(score, "doc_id long, no_id boolean, held_out boolean, score double, predicted int")
    return out.withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id"))).drop("no_id")


def only_good(
    df: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    threshold: float = 0.3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``df``, all columns, whose score reaches the threshold; all of them
    without labels of both classes."""
    model = fit(describe(df, id_col, text_col), labels, label_col, id_col)
    if model is None:
        return df
    return rows_where(df, lambda texts: model.scores(statistics(texts)) >= threshold, text_col)
