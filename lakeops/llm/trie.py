"""A prefix trie of conversations, built as burst tries.

A conversation is a string of turn ids (a digest of role and text). Equal conversations
are one member with a count. The first turn deals members into shards, whose suffixes lie in
containers under a trie head. A container with too many turns bursts: its longest common
prefix becomes a chain of nodes and its members go to containers by their next turn id. No
container needs more than one task's memory in the end, and each is sorted and swept into
nodes: neighbours share a prefix, what is beyond it are new nodes.

Strings are cut into chunks of ``CHUNK`` turns, so no cell grows with a conversation. A
later chunk hangs under the node at which its predecessor ends; layers of chunks are built
from the last to the first. Where one member alone goes on, the rest of it is a chain whose
numbers are running sums: only chunks that different conversations share need a layer.
Prefixes are told apart by 128 bits of hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeops.llm.common import small_side, staged

CHUNK = 1024
CONTAINER_TURNS = 100_000
GIVEN = 5  # Most turns taken from another conversation.
ID = 16  # Bytes of a turn id.
NODES_AT_ONCE = 50_000
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE = (
    "depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string"
)
COLUMNS = [part.split()[0] for part in NODE.split(", ")]
MEMBER = ["cid", "up", "off", "up_conv", "ids", "lens", "n", "conv", "sha", "b_children", "b_leaves", "b_saved"]


def _turns(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """conv_id, place in the whole order, part of it, turn id and code points; no texts."""
    said, by = F.coalesce(F.col(text).cast("string"), F.lit("")), F.coalesce(F.col(role).cast("string"), F.lit(""))
    rows = df.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.md5(F.concat(F.length(by).cast("string"), F.lit(":"), by, said)).alias("tid"),
        F.length(said).alias("chars"),
    )
    keys = ["conv_id", "turn", "tid"]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = ordered.select(
        "conv_id", "tid", "chars", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")
    )
    return staged(placed, "trie-turns")


def rebuilt(df: DataFrame, conv: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, tid, chars) of the rebuilt conversations, and the ids of turnless ones.

    A conversation may spread over parts of the order; its turns are numbered within each
    part, from the count of those before.
    """
    turns = _turns(df, conv, turn, role, text)
    parts = turns.groupBy("conv_id", "part").agg(F.min("at").alias("lo"), F.count(F.lit(1)).alias("c"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("skipped", F.coalesce(F.sum("c").over(before), F.lit(0)))
    base = F.col("conv_id") - F.col("conv_id") % 100
    parts = staged(
        parts.withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")).withColumn(
            "base", base
        ),
        "trie-parts",
    )
    bases = parts.where((F.col("conv_id") == F.col("base")) & (F.col("skipped") < GIVEN))
    place = (F.col("at") - F.col("lo") + F.col("skipped") + 1).cast("long")
    heads = (
        turns.where("conv_id % 100 = 0")
        .join(bases.select("conv_id", "part", "lo", "skipped"), ["conv_id", "part"])
        .withColumn("place", place)
        .where(F.col("place") <= GIVEN)
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "tid", "chars"))).alias("given"))
    )
    parts = staged(
        parts.join(heads, "base", "left").withColumn("given", F.slice(F.coalesce("given", F.array()), 1, F.col("h"))),
        "trie-convs",
    )
    given = (
        parts.where(F.col("skipped") == 0)
        .select("conv_id", F.explode("given").alias("g"))
        .select("conv_id", F.col("g.place").alias("depth"), "g.tid", "g.chars")
    )
    info = parts.select("conv_id", "part", "lo", "skipped", "h", F.size("given").alias("taken"))
    own = (
        turns.join(info, ["conv_id", "part"])
        .withColumn("place", place)
        .where(F.col("place") > F.col("h"))
        .select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("depth"), "tid", "chars")
    )
    left = F.greatest(F.sum("c") - F.first("h"), F.lit(0)) + F.first(F.size("given"))
    turnless = parts.groupBy("conv_id").agg(left.alias("left")).where("left = 0").select("conv_id")
    return given.unionByName(own), turnless


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (a, b, n, conv_id): one row for each run of equal (a, b, n)."""
    names = ["a", "b", "n", "rep", "m", "sha"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    key, rep, count, digest = None, 0, 0, None

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        rows = []
        for a, b, n, conv in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "n", "conv_id")), strict=True):
            if (a, b, n) != key:
                if key is not None:
                    rows.append((*key, rep, count, digest.hexdigest()))
                key, rep, count, digest = (a, b, n), conv, 0, hashlib.sha256()
            digest.update(f",{conv}".encode() if count else f"{conv}".encode())
            count += 1
        yield made(rows)
    if key is not None:
        yield made([(*key, rep, count, digest.hexdigest())])


def members(df: DataFrame, conv: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Chunks of the distinct conversations, and the distinct conversations with counts.

    Ids of equal conversations go through their digest in ascending order, a batch at a time.
    """
    rows, turnless = rebuilt(df, conv, turn, role, text)
    k = F.floor((F.col("depth") - 1) / CHUNK).cast("int")
    chunks = rows.groupBy("conv_id", k.alias("k")).agg(
        F.sort_array(F.collect_list(F.struct("depth", "tid", "chars"))).alias("turns")
    )
    ids = F.unhex(F.array_join(F.transform("turns", lambda t: t["tid"]), ""))
    chunks = chunks.select("conv_id", "k", ids.alias("ids"), F.transform("turns", lambda t: t["chars"]).alias("lens"))
    chunks = staged(
        chunks.withColumns({"a": F.xxhash64(F.lit(1), "k", "ids"), "b": F.xxhash64(F.lit(2), "ids", "k")}), "trie-chunks"
    )
    whole = chunks.groupBy("conv_id").agg(
        F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.sum(F.size("lens")).alias("n")
    )
    zero = F.lit(0).cast("long")
    whole = whole.unionByName(turnless.select("conv_id", zero.alias("a"), zero.alias("b"), zero.alias("n")))
    keys = ["a", "b", "n"]
    runs = whole.repartition(*keys).sortWithinPartitions(*keys, "conv_id").select("a", "b", "n", "conv_id")
    classes = staged(
        runs.mapInArrow(_digests, "a long, b long, n long, rep long, m long, sha string"), "trie-classes"
    )
    so_far = Window.partitionBy("conv_id").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    found = (
        chunks.join(classes.select(F.col("rep").alias("conv_id"), "n", "m", "sha"), "conv_id")
        .withColumns({"pa": F.bit_xor("a").over(so_far), "pb": F.bit_xor("b").over(so_far)})
        .withColumn("last", (F.col("k") + 1) * CHUNK >= F.col("n"))
        .select(
            F.col("conv_id").alias("rep"),
            "k",
            "ids",
            "lens",
            "m",
            "last",
            F.when(F.col("last"), F.col("sha")).alias("sha"),
            _head(F.col("pa").bitwiseXOR(F.col("a")), F.col("pb").bitwiseXOR(F.col("b")), F.col("k")).alias("head"),
            _head(F.col("pa"), F.col("pb"), F.col("k") + 1).alias("next"),
        )
    )
    return staged(found, "trie-members"), classes


def _head(a: Column, b: Column, k: Column) -> Column:
    """Name of the node at which a chunk hangs."""
    return F.concat_ws(":", k.cast("string"), F.hex(a), F.hex(b))


def _block(first: Column) -> Column:
    return F.substring("ids", (first - 1) * ID + 1, F.lit(ID))


def _common(lo: str, hi: str) -> Column:
    """Number of turn ids two strings begin with in common."""
    shorter = F.least(F.length(lo), F.length(hi)) / ID

    def block(name: str, i: Column) -> Column:
        return F.substring(F.col(name), (i - 1) * ID + 1, F.lit(ID))

    same = F.transform(F.sequence(F.lit(1), shorter.cast("int")), lambda i: block(lo, i) == block(hi, i))
    at = F.array_position(same, F.lit(False))
    return F.when(at == 0, shorter).otherwise(at - 1).cast("int")


def _sweep(base: int):
    """Nodes of containers whose members arrive in order of (cid, ids)."""

    def nodes(container: list[tuple], out: list[tuple]) -> None:
        cid, up, off, up_conv = container[0][:4]
        parent, chars, depth, sha, n, conv, children, leaves, saved = ([] for _ in range(9))
        path: list[int] = []
        previous = b""
        for _, _, _, _, ids, lens, count, smallest, ends, b_children, b_leaves, b_saved in container:
            size = len(ids) // ID
            shared = off - 1
            if path:
                most = min(size, len(previous) // ID)
                while shared < most and ids[shared * ID : shared * ID + ID] == previous[shared * ID : shared * ID + ID]:
                    shared += 1
                del path[shared - off + 1 :]
            for level in range(shared, size):
                parent.append(path[-1] if path else -1)
                path.append(len(parent) - 1)
                chars.append(lens[level])
                depth.append(base + level + 1)
            new = len(parent) - len(n)
            n += [0] * new
            sha += [None] * new
            conv += [smallest] * new
            children += [0] * new
            leaves += [0] * new
            saved += [0] * new
            end, previous = path[-1], ids
            n[end] += count
            conv[end] = min(conv[end], smallest)
            sha[end] = ends
            children[end] += b_children
            leaves[end] += b_leaves
            saved[end] += b_saved
        for i in range(len(parent) - 1, -1, -1):
            if not children[i]:
                leaves[i] = 1
            saved[i] += (n[i] - 1) * chars[i]
            over = parent[i]
            if over >= 0:
                n[over] += n[i]
                conv[over] = min(conv[over], conv[i])
                children[over] += 1
                leaves[over] += leaves[i]
                saved[over] += saved[i]
        for i, over in enumerate(parent):
            above = conv[over] if over >= 0 else up_conv
            top = up if over < 0 else None
            out.append((depth[i], conv[i], above, n[i], children[i], leaves[i], saved[i], sha[i] or NO_ENDS, top))

    kinds = [pa.int64()] * 7 + [pa.string()] * 2

    def made(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [*COLUMNS, "up"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(name).to_pylist() for name in MEMBER), strict=True):
                if held and row[0] != held[0][0]:
                    nodes(held, out)
                    held = []
                    if len(out) >= NODES_AT_ONCE:
                        yield made(out)
                        out = []
                held.append(row)
        if held:
            nodes(held, out)
        if out:
            yield made(out)

    return run


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _totals(tops: DataFrame) -> DataFrame:
    return tops.groupBy("up").agg(
        F.count(F.lit(1)).alias("t_children"), F.sum("n_leaves").alias("t_leaves"), F.sum("saved_tokens").alias("t_saved")
    )


def _burst(rows: DataFrame, limit: int) -> tuple[DataFrame, list[DataFrame]]:
    """Members in containers of at most ``limit`` turns (or one member), and the heads by round."""
    small, heads = [], []
    while True:
        sizes = rows.groupBy("cid").agg(F.sum(F.length("ids") / ID).alias("size"), F.count(F.lit(1)).alias("held"))
        large = staged(sizes.where((F.col("size") > limit) & (F.col("held") > 1)).select("cid"), "trie-large")
        if large.isEmpty():
            small.append(rows)
            return _union(small), heads
        # As many rows as the turns of the table divided by ``limit`` at most.
        marked = staged(rows.join(small_side(large.withColumn("large", F.lit(True))), "cid", "left"), "trie-marked")
        small.append(marked.where("large IS NULL").drop("large"))
        burst = marked.where("large").drop("large")
        ends = burst.groupBy("cid").agg(
            F.min("ids").alias("lo"),
            F.max("ids").alias("hi"),
            F.min_by("lens", "ids").alias("lens"),
            F.sum("n").alias("n"),
            F.min("conv").alias("conv"),
            *[F.min(c).alias(c) for c in ("up", "off", "up_conv")],
        )
        head = staged(ends.withColumn("common", _common("lo", "hi")).drop("lo", "hi"), "trie-heads")
        moved = burst.join(small_side(head.select("cid", "common", F.col("conv").alias("head_conv"))), "cid")
        at_head = F.length("ids") == F.col("common") * ID
        own = moved.where(at_head).select("cid", "sha", "b_children", "b_leaves", "b_saved")
        heads.append(staged(head.join(own, "cid", "left"), "trie-heads"))
        rows = staged(
            moved.where(~at_head).select(
                F.md5(F.concat(F.col("cid").cast("binary"), _block(F.col("common") + 1))).alias("cid"),
                F.col("cid").alias("up"),
                (F.col("common") + 1).alias("off"),
                F.col("head_conv").alias("up_conv"),
                *MEMBER[4:],
            ),
            "trie-burst",
        )


def _chains(heads: DataFrame, totals: DataFrame, base: int) -> DataFrame:
    """Nodes of the common prefixes of burst containers."""
    rows = heads.join(totals.withColumnRenamed("up", "cid"), "cid", "left")
    zero = F.lit(0).cast("long")

    def below(name: str) -> Column:
        return F.coalesce(f"t_{name}", zero) + F.coalesce(f"b_{name}", zero)

    last = F.col("rel") == F.col("common")
    rows = rows.select("*", F.explode(F.sequence("off", "common")).alias("rel"))
    own = F.aggregate(
        F.slice("lens", F.col("rel"), F.col("common") - F.col("rel") + 1), zero, lambda total, x: total + x.cast("long")
    )
    first = F.col("rel") == F.col("off")
    return rows.select(
        (F.col("rel") + base).cast("long").alias("depth"),
        F.col("conv").alias("conv_id"),
        F.when(first, F.col("up_conv")).otherwise(F.col("conv")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(last, below("children")).otherwise(1).cast("long").alias("n_children"),
        below("leaves").alias("n_leaves"),
        (below("saved") + (F.col("n") - 1) * own).alias("saved_tokens"),
        F.when(last, F.coalesce("sha", F.lit(NO_ENDS))).otherwise(F.lit(NO_ENDS)).alias("ends_sha256"),
        F.when(first, F.col("up")).alias("up"),
    )


def _layer(rows: DataFrame, k: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Nodes of one layer of chunks, and the totals of the nodes they hang at.

    ``rows`` are distinct under their head: head, ids, lens, n, conv, sha, up_conv and what
    lies below the end (b_children, b_leaves, b_saved).
    """
    first = F.md5(F.concat(F.col("head").cast("binary"), _block(F.lit(1))))
    dealt = rows.select(first.alias("cid"), F.col("head").alias("up"), F.lit(1).alias("off"), "up_conv", *MEMBER[4:])
    small, heads = _burst(dealt, limit)
    swept = (
        small.repartition("cid")
        .sortWithinPartitions("cid", "ids")
        .select(*MEMBER)
        .mapInArrow(_sweep(k * CHUNK), f"{NODE}, up string")
    )
    nodes = [staged(swept, "trie-nodes")]
    totals = _totals(nodes[0].where("up IS NOT NULL"))
    for head in reversed(heads):
        chain = staged(_chains(head, totals, k * CHUNK), "trie-nodes")
        nodes.append(chain)
        totals = _totals(_union(nodes).where("up IS NOT NULL"))
    return _union(nodes).select(*COLUMNS), staged(totals, "trie-totals")


def _alone(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes of chunks that one member alone goes through, and the totals where they begin."""
    later = Window.partitionBy("rep").orderBy(F.col("k").desc()).rowsBetween(Window.unboundedPreceding, -1)
    total = F.aggregate("lens", F.lit(0).cast("long"), lambda s, x: s + x.cast("long"))
    rows = rows.withColumn("chars", total).withColumn("after", F.coalesce(F.sum("chars").over(later), F.lit(0)))
    from_here = Window.partitionBy("rep", "k").orderBy(F.col("pos").desc()).rowsBetween(Window.unboundedPreceding, 0)
    each = rows.select("*", F.posexplode("lens").alias("pos", "len"))
    each = each.withColumn("suffix", F.sum("len").over(from_here) + F.col("after"))
    at_end = F.col("last") & (F.col("pos") + 1 == F.size("lens"))
    start = F.col("pos") == 0
    found = each.select(
        (F.col("k") * F.lit(CHUNK).cast("long") + F.col("pos") + 1).alias("depth"),
        F.col("rep").alias("conv_id"),
        F.when(start & F.col("begins"), F.col("up_conv")).otherwise(F.col("rep")).alias("parent_conv_id"),
        F.col("m").alias("n_convs"),
        F.when(at_end, 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("m") - 1) * F.col("suffix")).alias("saved_tokens"),
        F.when(at_end, F.col("sha")).otherwise(F.lit(NO_ENDS)).alias("ends_sha256"),
        F.when(start & F.col("begins"), F.col("head")).alias("up"),
    )
    nodes = staged(found, "trie-nodes")
    return nodes.select(*COLUMNS), staged(_totals(nodes.where("up IS NOT NULL")), "trie-totals")


def build(
    df: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    container_turns: int = CONTAINER_TURNS,
) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations.

    Turns are ordered by number, null first; turns of one number by a digest of role and
    text. A null role or text is empty; rows without conversation id belong to none and are
    left out. Repeated rows are turns of their own. No conversations give no nodes, not even
    a root. ``depth`` with ``conv_id`` (the smallest member) names a node. Ids of equal
    conversations meet in one task, which keeps none of them. Other columns are not read.
    """
    rows, classes = members(df, conv_col, turn_col, role_col, text_col)
    known = rows.agg(F.max("k")).first()[0]
    overall = classes.agg(F.min("rep"), F.sum("m")).first()
    if overall[0] is None:
        return df.sparkSession.createDataFrame([], ", ".join(sorted(NODE.split(", "))))
    smallest, convs = overall
    nodes: list[DataFrame] = []
    below = None
    zero = F.lit(0).cast("long")

    if known:
        # Chunks beyond the first: what one conversation alone goes through, and the rest.
        alone = rows.where("k > 0").groupBy("head").agg(F.count(F.lit(1)).alias("classes"))
        ends = rows.groupBy(F.col("next").alias("head")).agg(F.min("rep").alias("up_conv"))
        beyond = staged(rows.where("k > 0").join(alone, "head").join(ends, "head"), "trie-beyond")
        before = Window.partitionBy("rep").orderBy("k")
        single = beyond.where("classes = 1").withColumn("begins", F.row_number().over(before) == 1)
        found, below = _alone(single)
        nodes.append(found)
        shared = beyond.where("classes > 1")
        deepest = shared.agg(F.max("k")).first()[0] or 0
    else:
        deepest, shared = 0, None
    for k in range(deepest, -1, -1):
        if k:
            layer = shared.where(F.col("k") == k)
        else:
            layer = rows.where("k = 0").withColumn("up_conv", F.lit(smallest))
        layer = layer.withColumns({"n": F.col("m"), "conv": F.col("rep")})
        if known:
            # Members that differ only in later chunks are one here.
            layer = layer.groupBy("head", "next").agg(
                F.first("ids").alias("ids"),
                F.first("lens").alias("lens"),
                F.sum("n").alias("n"),
                F.min("conv").alias("conv"),
                F.max("sha").alias("sha"),
                F.min("up_conv").alias("up_conv"),
            )
        layer = layer.select("head", "next", "ids", "lens", "n", "conv", "sha", "up_conv")
        if below is None:
            layer = layer.withColumns({"b_children": zero, "b_leaves": zero, "b_saved": zero})
        else:
            lower = below.toDF("next", "b_children", "b_leaves", "b_saved")
            layer = layer.join(lower, "next", "left").fillna(0, ["b_children", "b_leaves", "b_saved"])
        found, totals = _layer(staged(layer, "trie-layer"), k, container_turns)
        nodes.append(found)
        # Layers above meet the chains that begin at their ends too.
        below = totals if below is None else totals.unionByName(below)

    # One row: the totals of the shards, which hang at the root.
    tops = below.where(F.col("up").startswith("0:")).first() or (None, 0, 1, 0)
    bare = classes.where("n = 0").first()
    root = df.sparkSession.createDataFrame(
        [(0, smallest, None, convs, tops[1], tops[2], tops[3], bare["sha"] if bare else NO_ENDS)], NODE
    )
    return _union([*nodes, root]).select("conv_id", *[c for c in COLUMNS if c != "conv_id"])
