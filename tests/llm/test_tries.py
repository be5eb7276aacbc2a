"""The trie of conversations and centroid clustering against plain versions."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from lakeops.llm import centroids, trie
from lakeops.llm.queries import QUERIES


def plain_trie(rows):
    """Every prefix of every rebuilt conversation, grouped as tuples."""
    said = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            said[conv].append(((turn is not None, turn or 0, digest), (role, text)))
    turns = {c: [t for _, t in sorted(said[c])] for c in said}
    whole = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(turns.get(c - int(math.fmod(c, 100)), [])[:h] + turns[c][h:])
    members, kids = defaultdict(list), defaultdict(list)
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    for path in members:
        if path:
            kids[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[k] for k in kids[path]) or 1
        own = (len(members[path]) - 1) * len(path[-1][1]) if path else 0
        saved[path] = own + sum(saved[k] for k in kids[path])
    out = Counter()
    for path, held in members.items():
        ends = ",".join(str(c) for c in sorted(held) if len(whole[c]) == len(path))
        above = min(members[path[:-1]]) if path else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out[min(held), len(path), above, len(held), len(kids[path]), leaves[path], saved[path], digest] += 1
    return out


COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def built(df, **options):
    return Counter(tuple(r[c] for c in COLUMNS) for r in trie.build(df, **options).collect())


def test_trie_of_the_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    found = QUERIES["op12_burst_trie"](spark, sf_dir).collect()
    assert Counter(tuple(r[c] for c in COLUMNS) for r in found) == plain_trie(map(tuple, rows))


def odd_conversations():
    """Few kinds of turns, so that prefixes are shared; repeated rows, nulls, copies, ids below
    zero, bases that are absent or short, a conversation much longer than the others."""
    rng = random.Random(5)
    rows = []
    for c in range(260):
        for t in range(rng.choice([1, 1, 2, 5, 9, 14])):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["u", "a", None]), rng.choice(["x", "y é", None])))
        if c > 5 and c % 3 == 0:
            other = rng.randrange(c)
            rows += [(c, t, r, x) for conv, t, r, x in rows if conv == other]
    rows += [(1000 + c, t, "u", f"t{t}") for c in (1, 2, 3) for t in range(60 + c % 2)]
    rows += [(None, 1, "u", "x")] * 2 + [(-105, 0, "u", "x"), (-100, 0, "u", "yy"), (-100, 1, "u", "zz")]
    return [(*r, "extra") for r in rows]


@pytest.mark.parametrize("chunk, container", [(1024, 100_000), (1024, 8), (3, 100_000), (4, 10)])
def test_trie_does_not_depend_on_its_sizes(spark, monkeypatch, chunk, container):
    monkeypatch.setattr(trie, "CHUNK", chunk)
    rows = odd_conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth string")
    assert built(df.repartition(5), container_turns=container) == plain_trie(r[:4] for r in rows)


def test_small_tries(spark):
    schema = "conv_id long, turn long, role string, text string"
    for rows in ([], [(None, 0, "u", "x")], [(7, None, None, None)], [(3, 0, "u", "x")] * 3):
        df = spark.createDataFrame(rows, schema)
        assert built(df) == plain_trie(rows)


def plain_clusters(vectors, k, rounds, scale):
    points = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in vectors]

    def start(point):
        i, v = point
        return (i is None, hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "", v)

    centres = [list(v) for _, v in sorted(points, key=start)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        held = defaultdict(list)
        for _, v in points:
            held[nearest(v)[1]].append(v)
        for j, own in held.items():
            centres[j] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    found = [(i, *nearest(v)[::-1]) for i, v in points]
    sums = Counter()
    for _, j, d in found:
        sums[j] += d
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return Counter((i, j, d, sums[j], sum(sums.values()), digests[j]) for i, j, d in found)


def test_clusters_of_the_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    found = QUERIES["op13_bisector_tournament"](spark, sf_dir).collect()
    assert Counter(map(tuple, found)) == plain_clusters([(r.vec_id, r.embedding) for r in rows], 16, 3, 64)


def test_odd_vectors(spark):
    """Ties between centroids, repeated rows and ids, null ids, vectors to be left out."""
    rng = random.Random(2)
    rows = [(i % 40, [float(rng.randint(-3, 3)) / 2 for _ in range(4)]) for i in range(90)]
    rows += [(None, [0.5, -0.25, 0.0, 1.0])] * 2 + [(200, [1.0, 1.0, 1.0, 1.0])] * 3
    bad = [(300, None), (301, []), (302, [1.0] * 3), (303, [1.0, None, 0.0, 0.0]), (304, [math.nan, 0.0, 0.0, 0.0])]
    bad += [(305, [math.inf, 0.0, 0.0, 0.0]), (306, [0.0, 0.0, 0.0, -math.inf])]
    given = [(i, v, "point") for i, v in rows + bad]
    df = spark.createDataFrame(given, "vec_id long, embedding array<double>, point string")
    for k, partitions in ((5, 1), (5, 7), (16, 3), (500, 2)):
        found = centroids.cluster(df.repartition(partitions), k=k, width=4, rounds=2, scale=2).collect()
        assert Counter(map(tuple, found)) == plain_clusters(rows, k, 2, 2)
    assert centroids.cluster(df.limit(0)).count() == 0
    assert centroids.cluster(df.where("vec_id >= 300"), width=4).count() == 0
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster(spark.createDataFrame([(1, [1e9])], "vec_id long, embedding array<double>"), width=1)


def test_tournament_equals_least_distance():
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(30):
        centres = rng.integers(-3, 4, size=(rng.integers(1, 9), 3))
        points = rng.integers(-4, 5, size=(200, 3))
        bisectors = centroids.Bisectors(centres.tolist())
        distances = ((points[:, None, :] - centres[None]) ** 2).sum(axis=2)
        winner = bisectors.nearest(points)
        assert (winner == distances.argmin(axis=1)).all()
        assert (bisectors.distance(points, winner) == distances.min(axis=1)).all()
