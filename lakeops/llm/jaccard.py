"""Jaccard join of documents on word shingles through a token-group matrix.

Documents with equal shingle sets are one class from the start. Similar classes are put
into groups; the matrix tells which groups hold a token, and a class only meets groups
that may hold a partner:

1. One pass makes a sketch of every text: set size, set digest, a few min-hashes.
2. Classes that share a pair of min-hashes are compared with one of them, the leader.
   Those links and their components are a first, cheap part of the result.
3. Groups: the members of a component, and classes without link that share such a pair.
4. The matrix. A set that links with another shares ``k`` of its ``size - 80 % of size +
   k`` rarest tokens, whatever fixed order "rarest" is; so only those are written, as
   (token, group), and a class visits a group that holds as many of its tokens. ``k`` is
   one and a part in ``MORE`` of the size, of the smaller set's in a pair. The order puts
   the most frequent tokens last, known from a bounded list; the list changes the work,
   never the result. Joined by token, the matrix tells which classes of the smaller group
   have to be looked at against the larger one.
5. A visited group is opened in cells of up to about ``CELL_TOKENS`` tokens. A cell stores
   the union of its members' tokens; a visitor with less than 80 % of its tokens in the
   union is passed over, the others are compared exactly. Visitors are dealt over tasks in
   portions as large as the cell, so that few texts are copied. Classes without link are
   compared inside their group in the same way.

Only links between different components are needed, so a cell gives a spanning forest
of what it finds linked: fewer links than it has classes. Shingles are 64-bit hashes; two sets of one digest that differ are
noticed by a second one and end the run with an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeops.llm import words as W
from lakeops.llm.common import map_slices, packed, slices, small_side, staged
from lakeops.llm.graph import components

SHINGLE = 5
PERCENT = 80
MINS = 6
# Tokens of a cell at most, and of a portion of its visitors at least (about).
CELL_TOKENS = 1 << 19
PORTION_TOKENS = 1 << 15
FREQUENT = 1 << 16
MORE = 32
NO_ID = -(1 << 63)


def sets_of(texts: list[str | None], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(text number, token) of the distinct shingles, sorted by both."""
    doc, value, _ = W.distinct(*W.shingles(W.split(texts), size))
    return doc, value


def digests(doc: np.ndarray, value: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers for every set, from sums over its tokens."""
    out = []
    for salt in (1, 2):
        total = np.zeros(texts, dtype=np.uint64)
        np.add.at(total, doc, W.mix(value + np.uint64(salt * W.POWER & W.MASK)))
        out.append(W.mix(total).view(np.int64))
    return out[0], out[1]


def sketches(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, n, one, two, mins of every row; ``often``: tokens that several sets of a slice hold."""

    def sketch(part: pd.DataFrame) -> pd.DataFrame:
        rows = len(part)
        doc, value = sets_of(list(part["text"]))
        n = np.bincount(doc, minlength=rows)
        one, two = digests(doc, value, rows)
        mins = np.zeros((rows, MINS), dtype=np.int64)
        starts = np.cumsum(n) - n
        if doc.size:
            for k in range(MINS):
                turned = W.mix(value ^ np.uint64((k + 3) * W.POWER & W.MASK))
                mins[n > 0, k] = np.minimum.reduceat(turned, starts[n > 0]).view(np.int64)
        fresh = np.zeros(rows, dtype=bool)
        fresh[np.unique(one, return_index=True)[1]] = True
        token, times = np.unique(value[fresh[doc]], return_counts=True)
        often: list = [[] for _ in range(rows)]
        often[0] = token[times > 1].view(np.int64).tolist()
        counts: list = [[] for _ in range(rows)]
        counts[0] = times[times > 1].tolist()
        columns = {"id": part["id"].to_numpy(), "n": n, "one": one, "two": two}
        return pd.DataFrame(columns | {"mins": list(mins), "often": often, "times": counts})

    rows = df.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_col).cast("string").alias("text")
    )
    schema = "id long, n long, one long, two long, mins array<long>, often array<long>, times array<long>"
    return staged(map_slices(rows, sketch, schema), "jaccard-sketches")


def _frequent(sketched: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """At most ``FREQUENT`` tokens, sorted, with the order of magnitude of their frequency."""
    pairs = sketched.where(F.size("often") > 0).select(F.explode(F.arrays_zip("often", "times")).alias("p"))
    counts = pairs.groupBy(F.col("p.often").alias("t")).agg(F.sum("p.times").alias("c"))
    rows = counts.orderBy(F.col("c").desc(), "t").limit(FREQUENT).collect()
    tokens = np.array([r["t"] for r in rows], dtype=np.int64).view(np.uint64)
    weight = np.array([int(r["c"]).bit_length() for r in rows], dtype=np.int64)
    order = np.argsort(tokens)
    return tokens[order], weight[order]


def _prefixes(df: DataFrame, id_col: str, text_col: str, tokens: np.ndarray, weight: np.ndarray) -> DataFrame:
    """(token, cls): the rarest tokens of every set, of which any partner shares some."""

    def emit(part: pd.DataFrame) -> pd.DataFrame:
        rows = len(part)
        doc, value = sets_of(list(part["text"]))
        one, _ = digests(doc, value, rows)
        n = np.bincount(doc, minlength=rows)
        rank = np.zeros(value.size, dtype=np.int64)
        if tokens.size and value.size:
            at = np.minimum(np.searchsorted(tokens, value), tokens.size - 1)
            rank = np.where(tokens[at] == value, weight[at], 0)
        order = np.lexsort((value, rank, doc))
        place = np.arange(doc.size) - np.repeat(np.cumsum(n) - n, n)
        kept = place < (n - -(-PERCENT * n // 100) + 1 + n // MORE)[doc]
        return pd.DataFrame({"token": value[order][kept].view(np.int64), "cls": one[doc[kept]]})

    return map_slices(df.select(F.col(text_col).cast("string").alias("text")), emit, "token long, cls long")


def _open(members: tuple, guests: tuple, parts: np.ndarray, found: list[tuple[int, int]]) -> None:
    """Add links (guest, member) of one cell to ``found``, none between what is linked already.

    Both: (cls, component, text number, tokens), a component being a place in ``parts``,
    whose equal values say what is linked; links are entered there. A cell so gives a
    spanning forest. Guests are passed over by the union bound.
    """
    m_cls, m_comp, m_doc, m_value = members
    g_cls, g_comp, g_doc, g_value = guests
    order = np.argsort(m_value, kind="stable")
    m_value, m_doc = m_value[order], m_doc[order]
    union, first = np.unique(m_value, return_index=True)
    ends = np.append(first[1:], m_value.size)
    m_size = np.bincount(m_doc, minlength=len(m_cls))
    starts = np.searchsorted(g_doc, np.arange(len(g_cls) + 1))
    for g in range(len(g_cls)):
        mine = g_value[starts[g] : starts[g + 1]]
        if not mine.size:
            continue
        at = np.minimum(np.searchsorted(union, mine), union.size - 1)
        at = at[union[at] == mine]
        if 100 * at.size < PERCENT * mine.size:
            continue
        spans = ends[at] - first[at]
        index = np.repeat(first[at] - np.cumsum(spans) + spans, spans) + np.arange(spans.sum())
        shared = np.bincount(m_doc[index], minlength=len(m_cls))
        linked = np.flatnonzero(100 * shared >= PERCENT * (mine.size + m_size - shared))
        own = parts[g_comp[g]]
        others, one_of = np.unique(parts[m_comp[linked]], return_index=True)
        for other, k in zip(others.tolist(), linked[one_of].tolist(), strict=True):
            if other != own:
                found.append((int(g_cls[g]), int(m_cls[k])))
        parts[np.isin(parts, others)] = own


def _verify(df: DataFrame, id_col: str, text_col: str, members: DataFrame, guests: DataFrame) -> DataFrame:
    """Links a, b between guests and members (target, cls, comp, id, n) of one target.

    A portion of guests has as many tokens as its cell, within the two bounds: a target of
    at most ``CELL_TOKENS`` is then copied no more often than its guests pay for.
    """
    members, guests = staged(members, "cell-members"), staged(guests, "cell-guests")
    parts = [rows.groupBy("target").agg(F.sum("n").alias(name)) for rows, name in ((members, "mt"), (guests, "gt"))]
    portion = F.least(F.greatest("mt", F.lit(PORTION_TOKENS)), F.lit(CELL_TOKENS))
    cells = parts[0].join(parts[1], "target").select(
        "target", F.ceil(F.col("mt") / CELL_TOKENS).cast("int").alias("mc"), F.ceil(F.col("gt") / portion).cast("int").alias("gc")
    )
    cells = staged(cells, "cell-counts")
    involved = members.join(cells, "target", "left_semi").select("id", "cls").union(guests.select("id", "cls")).distinct()
    involved = staged(involved, "cell-classes")
    texts = df.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_col).cast("string").alias("text")
    )
    fetched = staged(texts.join(small_side(involved), "id").select("cls", "text"), "cell-texts")

    def dealt(rows: DataFrame, guest: bool) -> DataFrame:
        own, other = ("gc", "mc") if guest else ("mc", "gc")
        rows = rows.join(cells, "target").withColumn("own", F.pmod(F.xxhash64("cls"), F.col(own)).cast("int"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        m, g = ("other", "own") if guest else ("own", "other")
        return rows.select(
            "target", F.col(m).alias("m"), F.col(g).alias("g"), F.lit(guest).alias("guest"), "cls", "comp"
        )

    unit = ["target", "m", "g"]
    rows = dealt(members, False).union(dealt(guests, True)).join(fetched, "cls")
    rows = rows.select(*unit, "guest", "cls", "comp", "text").repartition(*unit).sortWithinPartitions(*unit)

    def side(frame: pd.DataFrame) -> tuple:
        frame = frame.drop_duplicates(["cls", "text"])
        kinds, comps, docs, values, before = [], [], [], [], 0
        for part in slices(frame, "text"):
            doc, value = sets_of(list(part["text"]))
            # Rows of one id may have several texts: only that of the class counts.
            right = digests(doc, value, len(part))[0] == part["cls"].to_numpy()
            number = np.cumsum(right) - 1 + before
            docs.append(number[doc[right[doc]]])
            values.append(value[right[doc]])
            kinds.append(part["cls"].to_numpy()[right])
            comps.append(part["comp"].to_numpy()[right])
            before += int(right.sum())
        return tuple(np.concatenate(x) for x in (kinds, comps, docs, values))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def process(frames: list[pd.DataFrame]) -> pd.DataFrame:
            frame = pd.concat(frames, ignore_index=True)
            guest = frame["guest"].to_numpy()
            found: list[tuple[int, int]] = []
            if guest.any() and not guest.all():
                kinds, frame["comp"] = np.unique(frame["comp"].to_numpy(), return_inverse=True)
                parts = np.arange(kinds.size)
                members = side(frame[~guest])
                if len(members[0]) and members[3].size:
                    for part in slices(frame[guest], "text"):
                        _open(members, side(part), parts, found)
            return pd.DataFrame(found, columns=["a", "b"])

        for batch in batches:
            names = batch[unit].to_numpy()
            cuts = np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1
            for index in np.split(np.arange(len(batch)), cuts):
                if not len(index):
                    continue
                part = batch.iloc[index[0] : index[-1] + 1]
                if held and (held[-1][unit].iloc[0].to_numpy() != part[unit].iloc[0].to_numpy()).any():
                    yield process(held)
                    held = []
                held.append(part)
        if held:
            yield process(held)

    return staged(rows.mapInPandas(compare, "a long, b long"), "cell-links")


def _bands(classes: DataFrame) -> DataFrame:
    """cls, id, n, band, key: pairs of neighbouring min-hashes."""
    keys = [
        F.struct(F.lit(k).alias("band"), F.xxhash64(F.lit(k), F.element_at("mins", k + 1), F.element_at("mins", k + 2)).alias("key"))
        for k in range(0, MINS, 2)
    ]
    banded = classes.withColumn("b", F.explode(F.array(*keys)))
    return banded.select("cls", "id", "n", F.col("b.band").alias("band"), F.col("b.key").alias("key"))


def join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links) of every row.

    A null text or one without words has no shingles and is a component of its own, as is
    its id's other rows. Null ids count as rows but name nothing; a component without
    another id has a null name. Rows with equal ids count each. Other columns are not read.
    """
    sketched, told = _classes(df, id_col, text_col)
    named = F.when(F.col("id") != NO_ID, F.col("id"))
    names = staged(told.groupBy("component").agg(F.min(named).alias("component_id")), "jaccard-names")
    named_classes = staged(told.join(names, "component").select(F.col("cls").alias("one"), "component_id"), "jaccard-named")
    worded = sketched.where("n > 0").join(named_classes, "one").select("id", "n", "component_id")
    empty = sketched.where("n = 0").select("id", "n", named.alias("component_id"))
    return worded.union(empty).select(named.alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")


def without_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, all columns: that of the smallest id (null last), and of
    its rows those of the smallest digest. Rows that repeat an id and a shingle set are one
    document, and one of them stays. Texts without words all stay."""
    sketched, told = _classes(df, id_col, text_col)
    first = F.min(F.struct((F.col("id") == NO_ID).alias("none"), "id", "cls")).alias("f")
    best = told.groupBy("component").agg(first).select(F.col("f.id").alias("id"), F.col("f.cls").alias("one"))
    empty = sketched.where("n = 0").select("id", "one").distinct()
    kept = staged(best.union(empty), "jaccard-kept")

    def digest(texts: list[str | None]) -> np.ndarray:
        return digests(*sets_of(texts), len(texts))[0]

    rows = packed(df, digest, text_col).withColumnRenamed("value", "one")
    rows = rows.withColumn("id", F.coalesce(F.col("row").getField(id_col).cast("long"), F.lit(NO_ID)))
    found = rows.join(small_side(kept), ["id", "one"], "left_semi")
    again = sketched.groupBy("id", "one").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    if not again.join(kept, ["id", "one"], "left_semi").isEmpty():
        found = found.dropDuplicates(["id", "one"])
    return found.select("row.*")


def _classes(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The sketches of all rows; and cls, id, component of every class that has words."""
    sketched = sketches(df, id_col, text_col)
    grouped = sketched.where("n > 0").groupBy(F.col("one").alias("cls"))
    real = F.when(F.col("id") != NO_ID, F.col("id"))
    classes = grouped.agg(
        F.coalesce(F.min(real), F.lit(NO_ID)).alias("id"),
        F.first("n").alias("n"),
        F.first("mins").alias("mins"),
        (F.min("two") != F.max("two")).alias("clash"),
    )
    classes = staged(classes, "jaccard-classes")
    if not classes.where("clash").isEmpty():
        raise RuntimeError("two shingle sets have one digest")

    # 2. Leaders.
    banded = _bands(classes)
    leaders = staged(
        banded.groupBy("band", "key").agg(F.min(F.struct("cls", "id", "n")).alias("l"), F.count(F.lit(1)).alias("c")).where("c > 1"),
        "jaccard-leaders",
    )
    led = banded.join(leaders, ["band", "key"]).where(
        (F.col("cls") != F.col("l.cls"))
        & (100 * F.least("n", "l.n") >= PERCENT * F.greatest("n", "l.n"))
    )
    led = staged(led.select(
        "cls", "id", "n", F.col("l.cls").alias("target"), F.col("l.id").alias("target_id"), F.col("l.n").alias("target_n")
    ).distinct(), "jaccard-led")
    first_links = _verify(
        df,
        id_col,
        text_col,
        led.select("target", F.col("target").alias("cls"), F.col("target").alias("comp"), F.col("target_id").alias("id"), F.col("target_n").alias("n")).distinct(),
        led.select("target", "cls", F.col("cls").alias("comp"), "id", "n"),
    )
    first_parts = components(first_links)

    # 3. Groups.
    known = classes.join(first_parts.withColumnRenamed("node", "cls"), "cls", "left")
    known = staged(known, "jaccard-known")
    linked = known.where("component IS NOT NULL").select("cls", "id", "n", F.col("component").alias("comp"), F.col("component").alias("group"), F.lit(False).alias("loose"))
    alone = _bands(known.where("component IS NULL"))
    crowds = staged(alone.groupBy("band", "key").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "jaccard-crowds")
    placed = alone.join(crowds, ["band", "key"]).groupBy("cls").agg(F.max(F.struct("c", "band", "key")).alias("p"))
    loose = known.where("component IS NULL").join(placed, "cls", "left").select(
        "cls",
        "id",
        "n",
        F.col("cls").alias("comp"),
        F.when(F.col("p").isNotNull(), F.xxhash64("p.band", "p.key")).otherwise(F.col("cls")).alias("group"),
        F.col("p").isNotNull().alias("loose"),
    )
    groups = staged(linked.union(loose), "jaccard-groups")
    sizes = staged(groups.groupBy("group").agg(F.count(F.lit(1)).alias("size"), F.max("loose").alias("loose")), "jaccard-sizes")

    # 4. The matrix, as far as several classes hold a token.
    prefixes = _prefixes(df, id_col, text_col, *_frequent(sketched))
    per_token = Window.partitionBy("token")
    shared = prefixes.withColumn("low", F.min("cls").over(per_token)).withColumn("high", F.max("cls").over(per_token))
    shared = staged(shared.where("low < high").select("token", "cls").distinct(), "jaccard-shared")
    shared = shared.join(groups, "cls").join(sizes.drop("loose"), "group").select("token", "cls", "id", "n", "comp", "group", "size")
    shared = staged(shared, "jaccard-tokens")
    matrix = shared.groupBy("token", "group", "size").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    both = matrix.groupBy("token").agg(F.count(F.lit(1)).alias("groups")).where("groups > 1")
    matrix = staged(matrix.join(both, "token", "left_semi"), "jaccard-matrix")
    other = matrix.select("token", F.col("group").alias("target"), F.col("size").alias("other"), "least", "most")
    visits = shared.join(other, "token").where(
        (F.col("group") != F.col("target"))
        & ((F.col("size") < F.col("other")) | ((F.col("size") == F.col("other")) & (F.col("group") < F.col("target"))))
        & (100 * F.col("most") >= PERCENT * F.col("n"))
        & (100 * F.col("n") >= PERCENT * F.col("least"))
    )
    # A partner has at least 80 % of the size, and as many tokens of its own were written.
    needed = 1 + F.floor(F.ceil(PERCENT * F.col("n") / 100) / MORE)
    visits = visits.groupBy("target", "cls", "comp", "id", "n").agg(F.count(F.lit(1)).alias("hits")).where(F.col("hits") >= needed)
    visits = visits.drop("hits")
    inside = groups.where("loose").join(sizes.where("size > 1 AND loose").select("group"), "group")
    guests = visits.union(inside.select(F.col("group").alias("target"), "cls", "comp", "id", "n")).distinct()

    # 5. Cells.
    members = groups.select(F.col("group").alias("target"), "cls", "comp", "id", "n")
    guests = staged(guests, "jaccard-guests")
    members = members.join(guests.select("target").distinct(), "target", "left_semi")
    links = first_links.union(_verify(df, id_col, text_col, members, guests))
    parts = components(links).withColumnRenamed("node", "cls")
    told = classes.select("cls", "id").join(parts, "cls", "left")
    return sketched, staged(told.withColumn("component", F.coalesce("component", "cls")), "jaccard-told")
