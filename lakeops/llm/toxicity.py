"""Toxicity by weak supervision.

1. A bounded sample of labelled rows (``SAMPLE_ROWS``, the smallest by hash of the id) is
   read for words that toxic rows hold far more often than others: the mined lexicon. Copies
   and near copies (equal in one of two min-hashes of word shingles) count as one row there.
2. Voters look at every sampled text: word lists (a fixed one and the mined one dealt over
   several), patterns (lexicon words near words of address, several lexicon words, their
   density) and the row's own mark. A voter says toxic, clean or nothing.
3. A generative model with a hidden class explains the votes: expectation-maximisation
   estimates how often each voter says what in either class, and the correlation of voters
   inside the classes, by which a voter's weight is divided, so that echoes count once.
4. A linear classifier is trained on the posterior labels, over the words of the lexicons
   and their counts, and scores every whole text in one pass over the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm import words as W
from lakeops.llm.common import held_out, map_slices, rows_where, slices, staged

SAMPLE_ROWS = 20_000
LEXICON_WORDS = 400
MINED_LISTS = 12
MIN_DOCUMENTS = 4
MIN_LOG_ODDS = 2.0
MIN_EVIDENCE = 24.0  # twice the log likelihood ratio: one in a million by chance
PARTITION_WORDS = 200_000

# Common English insults, the word list a person would start with.
INSULTS = [
    "bastard", "clown", "coward", "creep", "disgusting", "dumb", "filth", "fool", "freak", "garbage",
    "hate", "idiot", "imbecile", "jerk", "kill", "liar", "loser", "lunatic", "maggot", "moron",
    "parasite", "pathetic", "pig", "psycho", "rat", "retard", "scum", "shame", "slob", "stupid",
    "trash", "ugly", "useless", "vermin", "vile", "worthless",
]
ADDRESS = ["you", "your", "youre", "u", "they", "them", "these", "those", "he", "she", "such"]


def hashes(words: list[str]) -> np.ndarray:
    """The hashes that ``words.split`` gives to these words."""
    w = W.split(words, W.NOT_WORD)
    return w.hash if w.hash.size == len(words) else np.array([W.split([x], W.NOT_WORD).hash[0] for x in words])


def lower_split(texts: list[str | None]) -> W.Words:
    return W.split([t.lower() if isinstance(t, str) else None for t in texts], W.NOT_WORD)


def sample(df: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str, rows: int) -> DataFrame:
    """text, y of at most ``rows`` labelled documents that are not held out."""
    marks = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("y"))
    chosen = marks.where(F.col("y").isin(0, 1) & F.col("_id").isNotNull() & ~held_out("_id"))
    chosen = chosen.groupBy("_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("_id"), "_id").limit(rows)
    # The side that is broadcast has ``rows`` rows at most.
    found = df.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("text")).join(
        F.broadcast(chosen), "_id"
    )
    # Of several texts under one id always the same one counts.
    return found.groupBy("_id", "y").agg(_least_text().alias("t")).select("_id", "y", "t.text")


def _least_text(*more: str) -> Column:
    return F.min(F.struct(F.xxhash64("text").alias("h"), "text", *more))


def without_copies(sampled: DataFrame) -> DataFrame:
    """text, y of rows that share neither of two min-hashes with another row of their label."""

    def sign(part: pd.DataFrame) -> pd.DataFrame:
        doc, value = W.shingles(W.split(list(part["text"])))
        lows = []
        for value in (value, W.mix(value)):
            low = np.full(len(part), np.uint64(W.MASK))
            np.minimum.at(low, doc, value)
            lows.append(low.view(np.int64))
        return part[["text", "y"]].assign(one=lows[0], two=lows[1])

    signed = map_slices(sampled.select("text", "y"), sign, "text string, y int, one long, two long")
    firsts = signed.groupBy("one", "y").agg(_least_text("two").alias("t")).select("y", "t.text", "t.two")
    return firsts.groupBy("two", "y").agg(_least_text().alias("t")).select("t.text", "y")


def mine(sampled: DataFrame) -> list[str]:
    """The words of toxic texts with the strongest evidence, by log likelihood ratio."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table: dict[int, list] = {}

        def flush() -> pd.DataFrame:
            frame = pd.DataFrame(list(table.values()), columns=["word", "pos", "neg"])
            table.clear()
            return frame

        for batch in batches:
            for part in slices(batch, "text"):
                w = lower_split(list(part["text"]))
                toxic = part["y"].to_numpy() == 1
                key = W.mix(w.hash ^ W.mix(w.doc.astype(np.uint64)))
                _, at = np.unique(key, return_index=True)
                value, first, group = np.unique(w.hash[at], return_index=True, return_inverse=True)
                pos = np.bincount(group, weights=toxic[w.doc[at]]).astype(int)
                total = np.bincount(group).astype(int)
                for h, i, p, n in zip(value.tolist(), at[first], pos.tolist(), total.tolist(), strict=True):
                    entry = table.get(h)
                    if entry is None:
                        word = w.data[w.start[i] : w.end[i]].tobytes().decode("utf-8", "replace")
                        table[h] = [word, p, n - p]
                    else:
                        entry[1] += p
                        entry[2] += n - p
                if len(table) > PARTITION_WORDS:
                    yield flush()
        yield flush()

    sizes = sampled.agg(F.sum("y"), F.count(F.lit(1))).first()
    pos_rows, rows = int(sizes[0] or 0), int(sizes[1])
    if not pos_rows or pos_rows == rows:
        return []
    counts = sampled.select("text", "y").mapInPandas(count, "word string, pos long, neg long")
    counts = counts.groupBy("word").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    odds = F.log((pos + 0.5) / (pos_rows - pos + 0.5)) - F.log((neg + 0.5) / (rows - pos_rows - neg + 0.5))

    def surprise(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    share = pos_rows / rows
    held, missing = pos + neg, rows - pos - neg
    evidence = 2 * (
        surprise(pos, held * share)
        + surprise(neg, held * (1 - share))
        + surprise(pos_rows - pos, missing * share)
        + surprise(rows - pos_rows - neg, missing * (1 - share))
    )
    found = counts.where(pos >= MIN_DOCUMENTS).withColumn("evidence", evidence)
    found = found.where((F.col("evidence") >= MIN_EVIDENCE) & (odds >= MIN_LOG_ODDS))
    top = found.orderBy(F.col("evidence").desc(), "word").limit(LEXICON_WORDS)
    return [r["word"] for r in top.collect()]  # the lexicon: at most LEXICON_WORDS


@dataclass
class Lexicon:
    """Known words: the fixed ones, then the mined ones."""

    terms: np.ndarray  # sorted hashes
    column: np.ndarray  # feature of each
    fixed: int
    size: int
    address: np.ndarray

    @staticmethod
    def of(mined: list[str]) -> Lexicon:
        names = INSULTS + [m for m in mined if m not in set(INSULTS)]
        value = hashes(names)
        order = np.argsort(value)
        return Lexicon(value[order], order, len(INSULTS), len(names), np.sort(hashes(ADDRESS)))

    def find(self, value: np.ndarray) -> np.ndarray:
        """The feature of each word, -1 for others."""
        at = np.minimum(np.searchsorted(self.terms, value), self.terms.size - 1)
        return np.where(self.terms[at] == value, self.column[at], -1)

    def measure(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(doc, word) of lexicon words present, and per text: log1p of hits, kinds, hits
        after a word of address, and the density of hits."""
        w = lower_split(texts)
        word = self.find(w.hash)
        hit = word >= 0
        doc = w.doc[hit]
        present = np.unique(doc.astype(np.int64) * self.size + word[hit])
        doc_of, word_of = present // self.size, present % self.size
        hits = np.bincount(doc, minlength=w.docs)
        kinds = np.bincount(doc_of, minlength=w.docs)
        total = np.bincount(w.doc, minlength=w.docs)
        addressed = np.zeros(w.doc.size, dtype=bool)
        near = np.isin(w.hash, self.address)
        for step in (1, 2, 3):
            addressed[step:] |= near[:-step] & (w.doc[step:] == w.doc[:-step])
        spoken = np.bincount(w.doc[hit & addressed], minlength=w.docs)
        extra = np.stack(
            [np.log1p(hits), np.log1p(kinds), np.log1p(spoken), np.log1p(1000 * hits / (total + 20))], axis=1
        )
        return np.stack([doc_of, word_of], axis=1), extra, total


EXTRA = 4


def votes(lexicon: Lexicon, present: np.ndarray, extra: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """One row per text, one column per voter: 1 toxic, -1 clean, 0 nothing."""
    n = len(marks)
    mined_list = np.where(present[:, 1] < lexicon.fixed, -1, present[:, 1] % MINED_LISTS)
    columns = [np.where(marks == 1, 1, -1)]
    fixed = np.bincount(present[mined_list < 0, 0], minlength=n)
    columns.append((fixed > 0).astype(int))
    for k in range(MINED_LISTS):
        columns.append((np.bincount(present[mined_list == k, 0], minlength=n) > 0).astype(int))
    kinds, hits = np.expm1(extra[:, 1]), np.expm1(extra[:, 0])
    columns.append(np.where(hits == 0, -1, 0))
    columns.append(np.where(kinds >= 2, 1, np.where(kinds == 0, -1, 0)))
    columns.append((extra[:, 2] > 0).astype(int))
    columns.append((np.expm1(extra[:, 3]) >= 5).astype(int))
    return np.stack(columns, axis=1)


def label_model(v: np.ndarray, rounds: int = 30) -> np.ndarray:
    """The posterior of the toxic class for every row of votes, by expectation-maximisation.

    Starts from the marks (column 0). Voters are weighed down by how far their votes go
    together inside the classes: 1 / (1 + sum of squared correlations with the others); the
    mark, which echoes nothing, keeps its weight.
    """
    n, m = v.shape
    said = np.stack([v == -1, v == 0, v == 1], axis=2).astype(float)
    q = np.where(v[:, 0] == 1, 0.99, 0.01)
    for _ in range(rounds):
        prior = (q.sum() + 1) / (n + 2)
        rate = [
            (np.einsum("n,nmk->mk", p, said) + 0.5) / (p.sum() + 1.5) for p in (1 - q, q)
        ]
        expected = [r[:, 2] - r[:, 0] for r in rate]
        rest = v - (1 - q)[:, None] * expected[0] - q[:, None] * expected[1]
        cover = rest.T @ rest / n + 1e-6 * np.eye(m)
        spread = np.sqrt(np.diag(cover))
        together = (cover / np.outer(spread, spread)) ** 2
        weight = 1.0 / np.maximum(1.0, together.sum(axis=1))
        weight[0] = 1.0
        gain = np.log(rate[1] / rate[0])
        logit = np.log(prior / (1 - prior)) + np.einsum("nmk,mk->n", said, gain * weight[:, None])
        new = 1.0 / (1.0 + np.exp(-np.clip(logit, -30, 30)))
        if np.abs(new - q).max() < 1e-4:
            return new
        q = new
    return q


def logistic(x: np.ndarray, q: np.ndarray, penalty: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights of a linear classifier (the last is the constant) for soft labels, by Newton steps."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    ridge = penalty * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (p - q) + ridge @ beta
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(bend, slope)
        beta -= step
        if np.abs(step).max() < 1e-6:
            break
    return beta


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray

    def scores(self, texts: list[str | None]) -> np.ndarray:
        present, extra, _ = self.lexicon.measure(texts)
        words, rest = self.weights[: self.lexicon.size], self.weights[self.lexicon.size :]
        logit = extra @ rest[:EXTRA] + rest[EXTRA]
        logit += np.bincount(present[:, 0], weights=words[present[:, 1]], minlength=len(texts))
        return 1.0 / (1.0 + np.exp(-np.clip(logit, -500, 500)))


def fit(
    df: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str, rows: int = SAMPLE_ROWS
) -> Model | None:
    """None without sampled labels of both classes."""
    sampled = sample(df, labels, label_col, id_col, text_col, rows)
    mined = mine(staged(without_copies(sampled), "toxicity-sample"))
    lexicon = Lexicon.of(mined)

    def measure(part: pd.DataFrame) -> pd.DataFrame:
        present, extra, _ = lexicon.measure(list(part["text"]))
        cuts = np.searchsorted(present[:, 0], np.arange(1, len(part)))
        found = [x.tolist() for x in np.split(present[:, 1], cuts)]
        return pd.DataFrame({"_id": part["_id"].to_numpy(), "y": part["y"].to_numpy(), "w": found, "e": list(extra)})

    table = map_slices(sampled, measure, "_id long, y int, w array<int>, e array<double>")
    kept = table.toPandas().sort_values("_id")  # SAMPLE_ROWS rows at most
    y = kept["y"].to_numpy()
    if len(np.unique(y)) < 2:
        return None
    extra = np.stack(kept["e"].to_numpy())
    counts = kept["w"].map(len).to_numpy()
    flat = np.concatenate([np.asarray(w, dtype=np.int64) for w in kept["w"]] + [np.zeros(0, dtype=np.int64)])
    present = np.stack([np.repeat(np.arange(len(kept)), counts), flat], axis=1)
    q = label_model(votes(lexicon, present, extra, y))
    x = np.zeros((len(kept), lexicon.size + EXTRA), dtype=np.float32)
    x[present[:, 0], present[:, 1]] = 1
    x[:, lexicon.size :] = extra
    return Model(lexicon, logistic(x, q))


def classify(
    df: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    threshold: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
    rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """doc_id, held_out, score (likelihood of label 1) and predicted (score >= threshold) of
    every row.

    Null and empty texts have no lexicon words and score like other texts without. Without
    labels of both classes every score is 0. A null id is never held out and never
    labelled; rows with equal ids each count, an id with several labels is toxic if one of
    them is. Other columns are not read.
    """
    model = fit(df, labels, label_col, id_col, text_col, rows)

    def score(part: pd.DataFrame) -> pd.DataFrame:
        texts = list(part.pop("text"))
        values = model.scores(texts) if model else np.zeros(len(texts))
        return part.assign(score=values, predicted=(values >= threshold).astype(np.int32))

    key = F.col(id_col).cast("long")
    given = df.select(
        F.coalesce(key, F.lit(0)).alias("doc_id"),
        key.isNull().alias("no_id"),
        held_out(key).alias("held_out"),
        F.col(text_col).cast("string").alias("text"),
    )
    out = map_slices(given, score, "doc_id long, no_id boolean, held_out boolean, score double, predicted int")
    return out.withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id"))).drop("no_id")


def without_toxic(
    df: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    threshold: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``df``, all columns, whose score is below the threshold; all of them
    without labels of both classes."""
    model = fit(df, labels, label_col, id_col, text_col)
    return rows_where(df, lambda texts: model.scores(texts) < threshold, text_col) if model else df
