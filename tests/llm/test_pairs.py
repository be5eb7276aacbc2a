"""Pair operators and the pipeline against plain versions of them."""

import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import cases
import corpus_pipeline
from lakeops.llm import jaccard, neardup
from lakeops.llm.queries import QUERIES


def smallest(ids, links):
    """The smallest id reachable from each."""
    name = {i: i for i in ids}

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        name[b] = a
    return {i: root(i) for i in ids}


def shingles(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_jaccard(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    holders = defaultdict(list)
    for i, s in sets.items():
        for token in s:
            holders[token].append(i)
    shared = defaultdict(int)
    for held in holders.values():
        for n, a in enumerate(held):
            for b in held[n + 1 :]:
                shared[a, b] += 1
    links = [(a, b) for (a, b), n in shared.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)]
    return {i: len(s) for i, s in sets.items()}, smallest(sets, links)


def test_jaccard_against_plain_version(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    sizes, names = plain_jaccard({d.doc_id: d.text for d in docs})
    found = QUERIES["op6_token_group_join"](spark, sf_dir).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == sorted((i, sizes[i], names[i]) for i in sizes)


@pytest.mark.parametrize("cell", [200])
def test_jaccard_does_not_depend_on_cells(spark, monkeypatch, cell):
    """Chains of texts, each like the next, over a passage that all hold."""
    monkeypatch.setattr(jaccard, "CELL_TOKENS", cell)
    monkeypatch.setattr(jaccard, "PORTION_TOKENS", min(cell, jaccard.PORTION_TOKENS))
    passage = " ".join(f"p{i}" for i in range(30))
    texts = {
        100 * c + k: f"{passage} " + " ".join(f"c{c}w{i}" for i in range(2 * k, 2 * k + 40))
        for c in range(8)
        for k in range(12)
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    sizes, names = plain_jaccard(texts)
    found = jaccard.join(df).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == sorted((i, sizes[i], names[i]) for i in sizes)
    assert len(set(names.values())) < len(texts)


def test_jaccard_of_odd_rows(spark):
    rows = jaccard.join(cases.frame(spark)).collect()
    assert len(rows) == len(cases.ROWS)
    named = {(r.doc_id, r.n_shingles): r.component_id for r in rows}
    assert named[1, len(shingles(cases.PROSE))] == named[2, len(shingles(cases.PROSE))] == 1
    assert named[4, 0] == 4 and named[5, 0] == 5 and named[6, 0] == 6
    assert named[None, 0] is None
    assert named[7, 1] == 7 and named[12, 1] == 12
    assert jaccard.join(cases.frame(spark, [])).count() == 0
    kept = jaccard.without_copies(cases.frame(spark)).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted([1, 4, 5, 6, 7, 8, 9, 9, 12, 13] + [3] * (named[3, len(shingles(cases.ROWS[2][1]))] == 3))
    assert kept[0].asDict().keys() == cases.frame(spark).first().asDict().keys()
    assert jaccard.without_copies(cases.frame(spark, [])).count() == 0


def plain_cosine(vectors):
    ids = list(vectors)
    x = np.array([vectors[i] for i in ids], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    links = [(ids[a], ids[b]) for a, b in np.argwhere(near)]
    return dict(zip(ids, near.sum(axis=1), strict=True)), smallest(ids, links)


def test_vectors_against_plain_version(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    counts, names = plain_cosine({r.vec_id: r.embedding for r in rows})
    found = QUERIES["op1_cross_polytope"](spark, sf_dir).collect()
    assert sorted(tuple(r) for r in found) == sorted((i, counts[i], names[i], names[i] == i) for i in counts)


@pytest.mark.parametrize("hashes, kind", [(2, "float"), (3, "double")])
def test_vectors_with_several_hashes_a_table(spark, monkeypatch, hashes, kind):
    """Chains of vectors a little more alike than the threshold, under longer keys, in small blocks."""
    monkeypatch.setattr(neardup, "BUCKET_ROWS", 200 / 128 ** (hashes - 0.5))
    monkeypatch.setattr(neardup, "BLOCK", 8)
    assert neardup.design(200, 64, 0.95).signs.shape[1] == hashes
    rng = np.random.default_rng(hashes)
    vectors = {}
    for c in range(40):
        x = rng.standard_normal(64)
        for k in range(5):
            vectors[100 * c + k] = [float(v) for v in x.astype(np.float32)]
            y = rng.standard_normal(64)
            y -= (x @ y) / (x @ x) * x
            x = 0.951 * x / np.linalg.norm(x) + np.sqrt(1 - 0.951**2) * y / np.linalg.norm(y)
    counts, names = plain_cosine(vectors)
    assert sum(counts.values()) == 2 * 40 * 4
    df = spark.createDataFrame(list(vectors.items()), f"vec_id long, embedding array<{kind}>")
    found = neardup.links(df).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == sorted((i, counts[i], names[i]) for i in counts)


def test_odd_vectors(spark):
    rows = [
        (1, [1.0, 0.0, 0.5], 1),
        (2, [1.0, 0.0, 0.5], 2),
        (3, [2.0, 0.0, 1.0], 3),
        (4, [0.0, 0.0, 0.0], 4),
        (5, None, 5),
        (6, [1.0, None, 0.5], 6),
        (7, [1.0, float("nan"), 0.5], 7),
        (8, [float("inf"), 0.0, 0.5], 8),
        (9, [-1.0, 0.0, -0.5], None),
        (None, [5.0, 1.0, 0.0], 3),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, kept int")
    found = {r.vec_id: (r.n_links, r.component_id) for r in neardup.links(df).collect()}
    assert found.pop(None)[0] == 0
    assert found == {1: (2, 1), 2: (2, 1), 3: (2, 1)} | {i: (0, i) for i in (4, 5, 6, 7, 8, 9)}
    assert neardup.links(df.limit(0)).count() == 0


def test_pipeline_stages(spark, sf_dir):
    """Each stage on all its predecessor kept: the same rows as the plain decision gives."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, docs
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality", "near_copies", "mixing", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in kept.collect()}
        kept = corpus_pipeline.staged(stage(spark, kept, sf_dir), f"test-{name}")
        assert kept.columns == columns
        after = {r.doc_id for r in kept.select("doc_id").collect()}
        assert after and after <= set(before)
        if name == "near_copies":
            assert after == {i for i, c in plain_jaccard(before)[1].items() if c == i}
            assert kept.count() == len(after)
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir)
    totals = packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()
    assert totals[0] <= corpus_pipeline.SEQUENCE
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == after
    assert corpus_pipeline.run(spark, sf_dir).count() == packed.count()
