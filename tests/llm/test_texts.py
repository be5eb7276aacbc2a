"""Fingerprints, licenses, classifiers and languages."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import cases
from lakeops.llm import langid, licenses, merkle, quality, toxicity
from lakeops.llm.queries import QUERIES


def test_fingerprints_against_plain_version(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy(F.col("doc_id").desc()).collect()
    rows = {r.doc_id: r for r in QUERIES["op4_merkle_fingerprints"](spark, sf_dir).collect()}
    assert len(rows) == len(docs)
    for i, doc in enumerate(docs):
        text, following = doc.text or "", docs[(i + 1) % len(docs)].text or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        row = rows[doc.doc_id]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (row.fingerprint == row.edited_fingerprint) == (text == edited)
        assert row.near_edited == pytest.approx(plain_likeness(text, edited), abs=1e-12)
        assert row.near_next == pytest.approx(plain_likeness(text, following), abs=1e-12)
    long = [r for r in rows.values() if r.n_chars > 1000 and r.near_next < 1]
    assert sum(0.3 < r.near_edited < 0.8 for r in long) > 0.9 * len(long)
    assert sum(r.near_next < 0.1 for r in long) > 0.9 * len(long)


def tree_of(text):
    """The tree in plain Python."""
    import re

    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    sections, held = [], []
    lines = text.split("\n")
    for i, line in enumerate(lines):
        held.append((md5(line), [md5(p)[:8] for p in re.findall(merkle.PIECE, line)]))
        if held[-1][0][-1] in "048c" or i == len(lines) - 1:
            sections.append((md5("".join(d for d, _ in held)), held))
            held = []
    return hashlib.sha256("".join(d for d, _ in sections).encode()).hexdigest(), sections


def plain_likeness(left, right):
    """1 for equal roots, else twice the common pieces over the sum of both."""
    (left_root, a), (right_root, b) = tree_of(left), tree_of(right)
    if left_root == right_root:
        return 1.0
    a, b = ({p for _, held in t for _, pieces in held for p in pieces} for t in (a, b))
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


def test_trees_and_edits(spark):
    lines = [f"Line {i} says a thing. And {i * i} more!" for i in range(40)]
    changed = lines[:7] + ["something else"] + lines[8:20] + lines[21:]
    df = spark.createDataFrame([("\n".join(lines), "\n".join(changed)), ("", None), ("a", "a\n")], "a string, b string")
    df = merkle.with_tree(merkle.with_tree(df, "a", "x"), "b", "y")
    rows = df.select("a", "b", "x", "y", merkle.edits(F.col("x"), F.col("y")).alias("e")).collect()
    for row in rows:
        for text, tree in ((row.a, row.x), (row.b or "", row.y)):
            root, sections = tree_of(text)
            assert tree.root == root
            assert [(s.digest, [(p.digest, list(p.pieces)) for p in s.paragraphs]) for s in tree.sections] == sections
    assert [e.digest for e in rows[0].e] == [hashlib.md5(b"something else").hexdigest()]
    assert rows[1].x == rows[1].y and rows[1].e == []
    assert rows[2].x.root != rows[2].y.root


def test_next_text_of_odd_rows(spark):
    df = cases.frame(spark)
    rows = merkle.with_next(df, "doc_id", "text", "following").select("doc_id", "text", "following").collect()
    assert len(rows) == len(cases.ROWS)
    followed = {(r.doc_id, r.text): r.following for r in rows}
    assert followed[13, "token " * 4000] == "x" * 5000
    assert followed[2, cases.PROSE] == cases.PROSE
    assert followed[8, cases.LONG] == "one"
    assert merkle.with_next(cases.frame(spark, []), "doc_id", "text", "f").count() == 0
    single = merkle.with_next(cases.frame(spark, cases.ROWS[:1]), "doc_id", "text", "f").first()
    assert single.f == cases.PROSE


def test_licenses_are_found_where_they_are(spark):
    mit = licenses.TEMPLATES["mit"]
    gpl = licenses.TEMPLATES["gpl_3"]
    texts = [
        (1, f"one two three {mit} four"),
        (2, gpl.upper() + " " + mit),
        (3, gpl.replace("work", "program")),
        (4, "the mit has a license for released software"),
        (5, None),
        (6, ""),
        (7, "word"),
        (None, mit),
        (8, ("some words " * 5000) + mit),
    ]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("t", F.lit("clash")).withColumn("h", F.lit(1))
    found = {(r.doc_id, r.license): (round(r.containment, 3), r.first_word) for r in licenses.scan(df).collect()}
    assert found == {
        (1, "mit"): (1.0, 3),
        (2, "gpl_3"): (1.0, 0),
        (2, "mit"): (1.0, 12),
        (3, "gpl_3"): (0.818, 0),
        (None, "mit"): (1.0, 0),
        (8, "mit"): (1.0, 10_000),
    }
    assert licenses.scan(df.limit(0)).count() == 0


def accuracy(spark, sf_dir, name, label):
    rows = QUERIES[name](spark, sf_dir)
    if label == "lang":
        marked = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
        right = F.col("lang_pred") == F.col("lang")
    else:
        marked = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", label)
        right = F.col("predicted") == F.col(label)
    both = rows.join(marked, "doc_id").where("held_out").agg(F.avg(right.cast("double")), F.count("*")).first()
    assert both[1] > 10
    return both[0]


@pytest.mark.parametrize(
    ("name", "label", "least"),
    [("op2_quality_discriminant", "quality", 0.9), ("op10_weak_toxicity", "toxic", 0.9), ("op3_byte_language", "lang", 0.95)],
)
def test_held_out_accuracy(spark, name, label, least):
    assert accuracy(spark, "/root/testdata/sf0.01", name, label) >= least


@pytest.mark.parametrize("operator", [quality.classify, toxicity.classify])
def test_classifiers_with_odd_rows(spark, operator):
    df = cases.frame(spark)
    unlearned = operator(df, cases.labels(spark)).collect()
    assert len(unlearned) == len(cases.ROWS)
    marks = [(d, int(d not in (12, 13)), int(d in (2, 3))) for d in (1, 2, 3, 7, 8, 9, 12, 13)]
    marks += [(None, 1, 1), (4, None, None), (999, 0, 0)]
    rows = operator(df, cases.labels(spark, marks)).collect()
    assert len(rows) == len(cases.ROWS)
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    assert not any(r.held_out for r in rows if r.doc_id is None)
    assert operator(cases.frame(spark, []), cases.labels(spark, marks)).count() == 0


def test_filters_keep_all_columns(spark):
    df = cases.frame(spark)
    marks = cases.labels(spark, [(d, int(d != 12), int(d == 7)) for d in (1, 2, 3, 7, 8, 9, 12)])
    for kept in (toxicity.without_toxic(df, marks), quality.only_good(df, marks)):
        assert kept.columns == df.columns
        assert kept.count() <= len(cases.ROWS)
    assert toxicity.without_toxic(df, cases.labels(spark)).count() == len(cases.ROWS)


def test_languages_of_odd_rows(spark):
    rows = langid.predict(cases.frame(spark)).collect()
    assert len(rows) == len(cases.ROWS)
    blank = [r for r in rows if r.doc_id in (4, 5, 6)]
    assert {(r.lang_pred, r.score) for r in blank} == {("und", 0.0)}
    assert langid.predict(cases.frame(spark, [])).count() == 0
    unlabelled = cases.frame(spark, [(1, "some words", None, "a", 1)])
    assert langid.predict(unlabelled).first().lang_pred == "und"


def test_gradients_of_the_network():
    rng = np.random.default_rng(0)
    cells = rng.integers(97, 120, size=(5, langid.WINDOW)).astype(np.uint8)
    wanted = np.array([0, 1, 2, 1, 0])
    network = langid.Network.new(["a", "b", "c"], 3)
    for name in ("embedding", "dense", "constant"):
        setattr(network, name, getattr(network, name).astype(float))
    network.filters = [f.astype(float) for f in network.filters]
    network.biases = [b.astype(float) for b in network.biases]

    def loss():
        top, _ = network.pooled(cells)
        logits = top @ network.dense + network.constant
        logits = logits - logits.max(axis=1, keepdims=True)
        logs = logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))
        return -logs[np.arange(5), wanted].mean()

    for part, slope in zip(network.parts(), network.gradients(cells, wanted), strict=True):
        flat, at = part.reshape(-1), int(np.abs(slope).argmax())
        kept = flat[at]
        flat[at] = kept + 1e-6
        up = loss()
        flat[at] = kept - 1e-6
        down = loss()
        flat[at] = kept
        assert abs((up - down) / 2e-6 - slope.reshape(-1)[at]) < 1e-4
