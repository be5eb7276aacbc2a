"""Language identification by a byte convolutional network.

The network sees windows of ``WINDOW`` bytes: bytes are embedded, filters of several widths
slide over them, each filter's maximum over the window is kept, and a softmax layer gives
the languages. It is trained in numpy on windows of a bounded, documented sample of labelled
rows (``ROWS_PER_LANGUAGE`` per language, chosen by hash of the id). A text is cut into
windows from its first byte to its last; its prediction is the mean of their log
probabilities, weighed by the letters they hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import held_out, map_slices, slices

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
ROWS_PER_LANGUAGE = 400
WINDOWS_PER_ROW = 4
MOST_LANGUAGES = 1000
EPOCHS = 10
BATCH = 64
CHUNK = 256
UNDETERMINED = "und"

_LETTER = np.array([i >= 128 or chr(i).isalpha() for i in range(256)])


def windows(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, window as bytes) covering every whole text; ASCII capitals made small.
    The last window of a text is filled up with spaces."""
    coded = [t.encode("utf-8", "replace") if isinstance(t, str) else b"" for t in texts]
    counts = [-(-len(c) // WINDOW) for c in coded]
    data = b"".join(c.ljust(n * WINDOW) for c, n in zip(coded, counts, strict=True))
    cells = np.frombuffer(data, dtype=np.uint8).reshape(-1, WINDOW)
    cells = cells + np.uint8(32) * ((cells >= 65) & (cells <= 90)).astype(np.uint8)
    return np.repeat(np.arange(len(texts)), counts), cells


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]  # width * EMBEDDING x FILTERS
    biases: list[np.ndarray]
    dense: np.ndarray
    constant: np.ndarray

    @staticmethod
    def new(languages: list[str], seed: int) -> Network:
        rng = np.random.default_rng(seed)

        def start(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) * np.sqrt(2.0 / shape[0])).astype(np.float32)

        return Network(
            languages,
            rng.standard_normal((256, EMBEDDING)).astype(np.float32) * 0.5,
            [start(w * EMBEDDING, FILTERS) for w in WIDTHS],
            [np.zeros(FILTERS, dtype=np.float32) for _ in WIDTHS],
            start(len(WIDTHS) * FILTERS, len(languages)) * 0.3,
            np.zeros(len(languages), dtype=np.float32),
        )

    def parts(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.biases, self.dense, self.constant]

    def _patches(self, cells: np.ndarray, width: int) -> np.ndarray:
        seen = self.embedding[cells]
        at = WINDOW - width + 1
        strided = np.lib.stride_tricks.as_strided(
            seen, (len(cells), at, width * EMBEDDING), (seen.strides[0], seen.strides[1], seen.strides[2])
        )
        return strided.reshape(len(cells) * at, width * EMBEDDING)

    def pooled(self, cells: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Maxima of all filters, and where they are."""
        tops, places = [], []
        for width, weights, bias in zip(WIDTHS, self.filters, self.biases, strict=True):
            out = (self._patches(cells, width) @ weights).reshape(len(cells), -1, FILTERS)
            place = out.argmax(axis=1)
            tops.append(np.take_along_axis(out, place[:, None], axis=1)[:, 0] + bias)
            places.append(place)
        return np.maximum(np.concatenate(tops, axis=1), 0), places

    def log_probabilities(self, cells: np.ndarray) -> np.ndarray:
        out = np.empty((len(cells), len(self.languages)), dtype=np.float32)
        for i in range(0, len(cells), CHUNK):
            top = [
                (self._patches(cells[i : i + CHUNK], width) @ weights).reshape(-1, WINDOW - width + 1, FILTERS).max(axis=1) + bias
                for width, weights, bias in zip(WIDTHS, self.filters, self.biases, strict=True)
            ]
            out[i : i + CHUNK] = np.maximum(np.concatenate(top, axis=1), 0) @ self.dense + self.constant
        out -= out.max(axis=1, keepdims=True)
        return out - np.log(np.exp(out).sum(axis=1, keepdims=True))

    def gradients(self, cells: np.ndarray, wanted: np.ndarray) -> list[np.ndarray]:
        top, places = self.pooled(cells)
        logits = top @ self.dense + self.constant
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(cells)), wanted] -= 1
        p /= len(cells)
        back = (p @ self.dense.T) * (top > 0)
        table = np.zeros_like(self.embedding)
        filters, biases = [], []
        rows = np.arange(len(cells))[:, None]
        for k, (width, weights, place) in enumerate(zip(WIDTHS, self.filters, places, strict=True)):
            here = back[:, k * FILTERS : (k + 1) * FILTERS]
            seen = np.stack([cells[rows, place + j] for j in range(width)], axis=2)
            patch = self.embedding[seen].reshape(len(cells), FILTERS, width * EMBEDDING)
            filters.append(np.einsum("nf,nfd->df", here, patch))
            biases.append(here.sum(axis=0))
            spread = (here[:, :, None] * weights.T[None]).reshape(-1, width, EMBEDDING)
            np.add.at(table, seen.reshape(-1, width), spread)
        return [table, *filters, *biases, top.T @ p, p.sum(axis=0)]


def train(cells: np.ndarray, wanted: np.ndarray, languages: list[str], seed: int = 7, epochs: int = EPOCHS) -> Network:
    """Adam on windows in a seeded order."""
    network = Network.new(languages, seed)
    rng = np.random.default_rng(seed + 1)
    first = [np.zeros_like(p) for p in network.parts()]
    second = [np.zeros_like(p) for p in network.parts()]
    step, total = 0, epochs * -(-len(cells) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(cells))
        for i in range(0, len(cells), BATCH):
            chosen = order[i : i + BATCH]
            step += 1
            rate = 0.01 * (1 - step / (total + 1))
            for part, slope, m, v in zip(
                network.parts(), network.gradients(cells[chosen], wanted[chosen]), first, second, strict=True
            ):
                m += 0.1 * (slope - m)
                v += 0.001 * (slope * slope - v)
                part -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return network


def sample(
    df: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int, most_languages: int = MOST_LANGUAGES
) -> pd.DataFrame:
    """lang, cell of about ``per_language`` rows for each language.

    Each language keeps the rows whose hash falls below its share, so one pass finds them.
    Of every chosen text up to ``WINDOWS_PER_ROW`` evenly spread windows reach the driver.
    """
    key = F.col(id_col).cast("long")
    usable = df.where(key.isNotNull() & ~held_out(key) & F.col(lang_col).isNotNull() & (F.length(text_col) > 0))
    counts = usable.groupBy(F.col(lang_col).alias("lang")).count()
    shares = [(r["lang"], min(1.0, per_language / r["count"])) for r in counts.limit(most_languages + 1).collect()]
    if len(shares) > most_languages:
        raise ValueError(f"more than {most_languages} languages; pass most_languages to learn them all")
    if not shares:
        return pd.DataFrame({"lang": [], "cell": []})
    # A row for each language.
    table = F.broadcast(df.sparkSession.createDataFrame(shares, "_lang string, _share double"))
    number = F.pmod(F.xxhash64(key, F.lit(11)), F.lit(1 << 20)) / float(1 << 20)
    rows = usable.select(F.col(lang_col).alias("_of"), F.col(text_col).cast("string").alias("text"), number.alias("_u"))
    rows = rows.join(table, (F.col("_of") == F.col("_lang")) & (F.col("_u") < F.col("_share")))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in slices(batch, "text"):
                of, cells = windows(list(part["text"]))
                counts = np.bincount(of, minlength=len(part))
                starts = np.cumsum(counts) - counts
                pick = [s + np.unique(np.linspace(0, c - 1, WINDOWS_PER_ROW).astype(int)) for s, c in zip(starts, counts) if c]
                pick = np.concatenate(pick) if pick else np.zeros(0, dtype=int)
                yield pd.DataFrame({"lang": part["lang"].to_numpy()[of[pick]], "cell": [c.tobytes() for c in cells[pick]]})

    picked = rows.select(F.col("_lang").alias("lang"), "text").mapInPandas(cut, "lang string, cell binary")
    return picked.toPandas().sort_values(["lang", "cell"], kind="stable")


def fit(
    df: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int, most_languages: int = MOST_LANGUAGES
) -> Network | None:
    """None without labelled rows. One language alone needs no training."""
    rows = sample(df, id_col, text_col, lang_col, per_language, most_languages)
    if not len(rows):
        return None
    languages = sorted(rows["lang"].unique())
    cells = np.stack([np.frombuffer(bytes(c), dtype=np.uint8) for c in rows["cell"]])
    wanted = np.searchsorted(languages, rows["lang"].to_numpy())
    epochs = max(EPOCHS, min(100, 60_000 // len(cells)))
    return train(cells, wanted, languages, epochs=epochs)


def predict(
    df: DataFrame,
    per_language: int = ROWS_PER_LANGUAGE,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    most_languages: int = MOST_LANGUAGES,
) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row.

    Every language of the rows learned from can be predicted; the network has an output for
    each, so more than ``most_languages`` of them are refused with an error.

    ``lang_pred`` is ``und`` with score 0 for a null text, one without letters, and for all
    rows if there is nothing to learn from. A row without language is predicted like the
    others; a null id is neither held out nor learned from. Other columns are not read.
    """
    network = fit(df, id_col, text_col, lang_col, per_language, most_languages)

    def score(part: pd.DataFrame) -> pd.DataFrame:
        texts = list(part.pop("text"))
        of, cells = windows(texts)
        found = np.array([isinstance(t, str) and any(map(str.isalpha, t)) for t in texts], dtype=bool)
        if network is None:
            found[:] = False
        names, scores = np.full(len(part), UNDETERMINED, dtype=object), np.zeros(len(part))
        if found.any():
            logs = network.log_probabilities(cells).astype(float)
            weight = _LETTER[cells].sum(axis=1) + 1e-3
            total = np.bincount(of, weights=weight, minlength=len(part))
            mean = np.stack(
                [np.bincount(of, weights=weight * logs[:, k], minlength=len(part)) for k in range(logs.shape[1])], axis=1
            ) / np.maximum(total, 1e-9)[:, None]
            p = np.exp(mean - mean.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            names[found] = np.array(network.languages, dtype=object)[p.argmax(axis=1)][found]
            scores[found] = p.max(axis=1)[found]
        return part.assign(lang_pred=names, score=scores)

    key = F.col(id_col).cast("long")
    given = df.select(
        F.coalesce(key, F.lit(0)).alias("doc_id"),
        key.isNull().alias("no_id"),
        held_out(key).alias("held_out"),
        F.col(text_col).cast("string").alias("text"),
    )
    out = map_slices(given, score, "doc_id long, no_id boolean, held_out boolean, lang_pred string, score double")
    return out.withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id"))).drop("no_id")
