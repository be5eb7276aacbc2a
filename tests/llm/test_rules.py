"""No caps, no clashing names; plain versions of the sharding ring and the fingerprints' neighbours."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeops.llm import jaccard, langid, merkle, mixing, neardup, packing, toxicity


def test_words_of_any_length_count(spark):
    """Two insults that agree in their first 80 bytes are told apart."""
    stem = "w" * 80
    rows = [(i, f"some plain words about {i} and the like " + (f"{stem}bad" if i % 2 else f"{stem}fine"), "x") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    sampled = toxicity.sample(docs, labels, "toxic", "doc_id", "text", 1000)
    mined = toxicity.mine(sampled)
    assert f"{stem}bad" in mined and f"{stem}fine" not in mined


def test_same_text_counts_for_a_repeated_id(spark):
    rows = [(1, "b"), (1, "a"), (1, "c"), (2, "z")]
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    found = []
    for n in (1, 4):
        docs = spark.createDataFrame(rows[::-1] if n == 4 else rows, "doc_id long, text string").repartition(n)
        found.append(sorted(map(tuple, toxicity.sample(docs, labels, "toxic", "doc_id", "text", 10).collect())))
    assert found[0] == found[1] and len(found[0]) == 2


def test_all_languages_are_learned(spark):
    rows = [(1000 * k + i, f"{chr(0x4E00 + 7 * k) * 9}", f"l{k:03d}") for k in range(201) for i in (1, 2, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert langid.sample(docs, "doc_id", "text", "lang", 5)["lang"].nunique() == 201
    with pytest.raises(ValueError, match="most_languages"):
        langid.predict(docs, most_languages=200)


def test_each_vector_length_is_searched(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 1.0, 0.0]), (4, [1.0, 1.0, 0.0]), (5, [0.0, 1.0, 1.0]), (6, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r.vec_id: (r.n_links, r.component_id) for r in neardup.links(df).collect()}
    assert found == {1: (1, 1), 2: (1, 1), 3: (1, 3), 4: (1, 3), 5: (0, 5), 6: (0, 6)}


@pytest.mark.parametrize("rows, width, hashes", [(2_000, 64, 1), (300_000, 16, 3)])
def test_pairs_at_the_threshold_meet(rows, width, hashes):
    """Pairs exactly as alike as the threshold share a bucket, with one hash and with more."""
    hasher = neardup.design(rows, width, 0.95)
    assert hasher.signs.shape[1] >= hashes
    rng = np.random.default_rng(77)
    x = rng.standard_normal((3000, width))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.standard_normal((3000, width))
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    a, b = hasher.keys(x), hasher.keys(y)
    meet = ((a[:, :, :1] == b).any(axis=2) | (b[:, :, :1] == a).any(axis=2)).any(axis=1)
    assert meet.mean() >= 0.999


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_packing_with_any_tokenizer(spark, name):
    path = public_tokenizers.path(name)
    tokenizer = Tokenizer.from_file(path)
    texts = ["Two words, and  more.\nNew line!", "  leading", "ÀÉ œuvre, ça va... oui. Non", "a" * 300, "", None, "x,y. z,. 'tis it's"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in packing.pack(df, path, 16).collect()}
    wanted = {}
    for i, text in enumerate(texts):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, at in enumerate(range(0, len(ids), 16)):
            run = ids[at : at + 16]
            wanted[i, piece] = (at, len(run), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in run)))
    assert found == wanted


def test_equal_pieces_fill_the_tightest_bin():
    runs = packing.best_fit({7: 2, 3: 2, 2: 3}, 13)
    assert len({first + k for _, start, end, first, _ in runs for k in range(end - start)}) == 2


def test_alike_members_give_a_spanning_forest():
    """Two hundred mutually alike members, all guests as well: fewer links than members."""
    base = np.arange(1000, dtype=np.uint64)
    rows = [np.concatenate([base, np.array([10_000 + i], dtype=np.uint64)]) for i in range(200)]
    cls = np.arange(200)
    side = (cls, cls.copy(), np.repeat(cls, 1001), np.concatenate(rows))
    found: list = []
    parts = np.arange(200)
    jaccard._open(side, side, parts, found)
    assert len(found) == 199 and len(set(parts.tolist())) == 1
    names = {i: i for i in range(200)}
    for a, b in found:
        a, b = names[a], names[b]
        names = {i: (min(a, b) if v in (a, b) else v) for i, v in names.items()}
    assert set(names.values()) == {0}


CLASHING = "_id long, _one long, row string, value string, id long, one long, _points double, _source string, _times int, _range int, _guest string, _place string"


def clashing(spark):
    extra = (71, 72, "r", "v", 73, 74, 0.5, "s", 9, 8, "g", "p")
    rows = [(i, f"text number {i % 4} with some more words in it", "a" if i % 3 else "b", *extra) for i in range(12)]
    return spark.createDataFrame(rows, f"doc_id long, text string, source string, {CLASHING}"), extra


def test_columns_of_any_name_survive(spark):
    df, extra = clashing(spark)
    names = [part.split()[0] for part in CLASHING.split(", ")]
    kept = jaccard.without_copies(df).collect()
    assert sorted(r.doc_id for r in kept) == [0, 1, 2, 3]
    mixed = mixing.mix(df, power=1.0).collect()
    following = merkle.with_next(df, "doc_id", "text", "next_text").collect()
    for rows in (kept, mixed, following):
        assert rows and all(tuple(r[n] for n in names) == extra for r in rows)
    texts = {r.doc_id: r.text for r in df.collect()}
    assert {r.doc_id: r.next_text for r in following} == {i: texts[i - 1 if i else 11] for i in texts}


def test_next_rows_at_many_partitions(spark):
    """The plan does not grow with the number of ranges, and the result does not change."""
    df = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    sizes = []
    try:
        for partitions in ("4", "300"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            out = merkle.with_next(df, "doc_id", "text", "next_text")
            sizes.append(out._jdf.queryExecution().analyzed().toString().count("cast("))
            assert {r.doc_id: r.next_text for r in out.collect()} == {i: f"t{(i - 1) % 300}" for i in range(300)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sizes[0] == sizes[1] or sizes[1] < 2 * sizes[0]
