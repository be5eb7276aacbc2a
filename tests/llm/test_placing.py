"""Sharding, packing and mixing."""

import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import cases
from lakeops.llm import mixing, packing, sharding

WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_shards_are_even_and_gapless(spark, sf_dir, shards):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sharding.shard(docs, shards).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert len(rows) == len(texts)
    by_shard = defaultdict(list)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(data) + 16, zlib.crc32(data))
        by_shard[r.shard].append(r.slot)
    counts = [len(by_shard[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())


def test_shards_move_little(spark):
    """One shard more takes 1 / 41 of the rows; overflow moves about as many again."""
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("text").alias("text"))
    one, two = ({r.doc_id: r.shard for r in sharding.shard(docs, n).collect()} for n in (40, 41))
    assert sum(one[d] != two[d] for d in one) < 0.1 * len(one)


def plain_walk(counts, places, shards):
    """Row by row: first every row to the next place's shard while that has room, then the
    rows left over, each on from its own place until a shard has room."""
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    found, left = Counter(), []
    for slot in sorted(counts):
        home = next((i for i, (place, _) in enumerate(places) if place >= slot), 0)
        for _ in range(counts[slot]):
            if room[places[home][1]]:
                room[places[home][1]] -= 1
                found[slot, places[home][1]] += 1
            else:
                left.append((slot, home))
    for slot, at in left:
        while not room[places[at][1]]:
            at = (at + 1) % len(places)
        room[places[at][1]] -= 1
        found[slot, places[at][1]] += 1
    return found


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(0, sharding.SLOTS - 1), st.integers(1, 30), max_size=40), st.integers(1, 7))
def test_walk_equals_the_plain_ring(counts, shards):
    places = sharding.ring(shards, 6)
    found = Counter()
    for slot, start, end, shard, _ in sharding.walk(counts, places, shards):
        found[slot, shard] += end - start
    assert found == plain_walk(counts, places, shards)


def test_shards_of_odd_rows(spark):
    rows = sharding.shard(cases.frame(spark), 4).collect()
    assert len(rows) == len(cases.ROWS)
    assert {r.size for r in rows if r.text_crc32 == 0} == {16}
    assert sorted(Counter(r.shard for r in rows).values()) == [3, 4, 4, 4]
    assert sharding.shard(cases.frame(spark, []), 4).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, sharding.SLOTS - 1), st.integers(1, 50), max_size=40), st.integers(1, 9))
def test_walk_places_every_row_once(counts, shards):
    pieces = sharding.walk(counts, sharding.ring(shards, 8), shards)
    spans = defaultdict(list)
    places = defaultdict(list)
    for slot, start, end, shard, base in pieces:
        spans[slot] += range(start, end)
        places[shard] += range(base, base + end - start)
    assert {s: sorted(v) for s, v in spans.items()} == {s: list(range(n)) for s, n in counts.items()}
    assert all(sorted(v) == list(range(len(v))) for v in places.values())
    sizes = [len(places[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1


def plain_best_fit(sizes, length):
    bins = []
    for size in sorted(sizes, reverse=True):
        fitting = [b for b in range(len(bins)) if bins[b] >= size]
        if fitting:
            bins[min(fitting, key=lambda b: bins[b])] -= size
        else:
            bins.append(length - size)
    return len(bins), sorted(bins)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 40).flatmap(lambda n: st.tuples(st.just(n), st.lists(st.integers(1, n), max_size=60))))
def test_runs_equal_plain_best_fit(case):
    length, sizes = case
    runs = packing.best_fit(Counter(sizes), length)
    used = defaultdict(list)
    for size, start, end, first, offset in runs:
        for k in range(end - start):
            used[first + k].append((offset, size))
    for parts in used.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    left = sorted(length - sum(s for _, s in parts) for parts in used.values())
    assert (len(used), left) == plain_best_fit(sizes, length)
    assert Counter(s for parts in used.values() for _, s in parts) == Counter(sizes)


def check_packing(rows, texts, length):
    tokenizer = Tokenizer.from_file(WORDS)
    expected = Counter()
    for doc_id, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, at in enumerate(range(0, len(ids), length)):
            run = ids[at : at + length]
            crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in run))
            expected[doc_id, piece, at, len(run), crc] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    assert len(held) == plain_best_fit([r.length for r in rows], length)[0]


@pytest.mark.parametrize("length", [64, 2048])
def test_packing(spark, sf_dir, length):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = packing.pack(docs, WORDS, length).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()], length)


def test_packing_of_odd_rows(spark):
    rows = packing.pack(cases.frame(spark), WORDS, 100).collect()
    check_packing(rows, [r[:2] for r in cases.ROWS], 100)
    assert packing.pack(cases.frame(spark, []), WORDS, 100).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("aé~ .,!?'s0_\n\tİß²Ж東<|endoftext|>"), max_size=40), min_size=1, max_size=4))
def test_encoder_equals_tokenizer(texts):
    tokenizer = Tokenizer.from_file(WORDS)
    coded = packing.encoder(WORDS).encode(texts)
    for text, ids in zip(texts, coded, strict=True):
        wanted = tokenizer.encode(text, add_special_tokens=False).ids
        assert ids == b"".join(i.to_bytes(4, "little") for i in wanted)


def test_mix_follows_weights(spark):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 10 == 0, "small").when(F.col("id") % 10 == 1, F.lit(None)).otherwise("large").alias("source"),
    )
    mixed = mixing.mix(docs, weights={"small": 1, None: 1, "large": 2}, total=40_000)
    counts = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(counts["small"] - 10_000) < 500 and abs(counts[None] - 10_000) < 500
    assert abs(counts["large"] - 20_000) < 700
    spread = mixed.where("source = 'small'").groupBy("doc_id").count().groupBy("count").count()
    times = {r[0]: r[1] for r in spread.collect()}
    assert 2000 * 0.17 < times[5] < 2000 * 0.2  # Poisson(5) at 5 is 0.1755
    again = mixing.mix(docs.repartition(7), weights={"small": 1, None: 1, "large": 2}, total=40_000)
    assert [tuple(r) for r in again.collect()] == [tuple(r) for r in mixed.collect()]


def test_mix_leaves_out_sources_without_weight(spark):
    docs = cases.frame(spark)
    assert {r.source for r in mixing.mix(docs, weights={"c": 1}).collect()} <= {"c"}
    rows = mixing.mix(docs, power=1.0)
    assert rows.columns == [c for c in docs.columns if c != "copy"] + ["copy", "shuffle_key"]
    assert rows.count() > 0
    assert mixing.mix(cases.frame(spark, [])).count() == 0
