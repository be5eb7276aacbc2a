"""Merkle trees over the paragraphs and sections of texts.

Paragraphs are the text's lines. A section ends at a paragraph whose digest says so (one
in four on average), so that a paragraph put in or taken out moves no other boundary but
its own. Under a paragraph hang its pieces: sentences, cut every 32 characters.

* piece: first 8 hex digits of its MD5
* paragraph: MD5 of its text
* section: MD5 of its paragraphs' digests
* root: SHA-256 of the sections' digests

Equal roots mean equal texts. Otherwise the sections, paragraphs and pieces that only one
tree holds locate the edits. Everything is a column expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PIECE = "[^.!?]{1,32}[.!?]*|[.!?]+"
SHORT = 8
SECTION_ENDS = "[048c]"  # last hex digit of a paragraph's digest


def _short_md5(text: Column) -> Column:
    return F.substring(F.md5(text.cast("binary")), 1, SHORT)


def with_tree(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """Adds ``out``: struct(root, sections: array of struct(digest, paragraphs: array of
    struct(digest, pieces: array of string))). A null text is an empty one, which has one
    empty paragraph without pieces. A column of the name ``out`` is replaced."""
    lines, ends, sections = f"{out}__lines", f"{out}__ends", f"{out}__sections"
    df = df.withColumn(
        lines,
        F.transform(
            F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1),
            lambda p: F.struct(
                F.md5(p.cast("binary")).alias("digest"),
                F.transform(F.regexp_extract_all(p, F.lit(PIECE), F.lit(0)), _short_md5).alias("pieces"),
            ),
        ),
    )
    count = F.size(lines)
    ending = F.filter(
        F.sequence(F.lit(1), count), lambda i: F.element_at(lines, i)["digest"].rlike(SECTION_ENDS + "$") | (i == count)
    )
    df = df.withColumn(ends, ending)
    df = df.withColumn(
        sections,
        F.transform(
            ends,
            lambda end, i: _section(F.slice(lines, _start(ends, i), end - _start(ends, i) + 1)),
        ),
    )
    root = F.sha2(F.array_join(F.col(sections)["digest"], ""), 256)
    tree = F.struct(root.alias("root"), F.col(sections).alias("sections"))
    return df.withColumn(out, tree).drop(lines, ends, sections)


def _start(ends: str, i: Column) -> Column:
    return F.when(i == 0, F.lit(1)).otherwise(F.element_at(ends, F.greatest(i, F.lit(1))) + 1)


def _section(paragraphs: Column) -> Column:
    digests = F.array_join(F.transform(paragraphs, lambda p: p["digest"]), "")
    return F.struct(F.md5(digests.cast("binary")).alias("digest"), paragraphs.alias("paragraphs"))


def as_text(tree: Column) -> Column:
    """The whole tree as a string: root, then sections as ``digest(paragraph,paragraph)``,
    a paragraph being its digest and its pieces; inner digests by their first 8 digits."""
    return F.concat(
        tree["root"],
        F.lit(":"),
        F.array_join(
            F.transform(
                tree["sections"],
                lambda s: F.concat(
                    F.substring(s["digest"], 1, SHORT),
                    F.lit("("),
                    F.array_join(
                        F.transform(
                            s["paragraphs"],
                            lambda p: F.concat(F.substring(p["digest"], 1, SHORT), F.array_join(p["pieces"], "")),
                        ),
                        ",",
                    ),
                    F.lit(")"),
                ),
            ),
            "",
        ),
    )


def pieces(tree: Column) -> Column:
    """The distinct pieces of a tree."""
    return F.array_distinct(
        F.flatten(F.flatten(F.transform(tree["sections"], lambda s: F.transform(s["paragraphs"], lambda p: p["pieces"]))))
    )


def likeness(left_root: Column, left_pieces: Column, right_root: Column, right_pieces: Column) -> Column:
    """1 for equal roots, else twice the common pieces over the sum of both; 0 without pieces."""
    both = F.size(left_pieces) + F.size(right_pieces)
    shared = F.size(F.array_intersect(left_pieces, right_pieces))
    return F.when(left_root == right_root, 1.0).when(both > 0, 2.0 * shared / both).otherwise(0.0)


def edits(old: Column, new: Column) -> Column:
    """Where ``new`` differs: array of struct(section, paragraph, digest), counted from 0.

    Only sections that ``old`` does not hold are opened, and of those the paragraphs it
    does not hold are given. Equal roots give an empty array.
    """
    old_sections = F.transform(old["sections"], lambda s: s["digest"])
    old_paragraphs = F.flatten(
        F.transform(old["sections"], lambda s: F.transform(s["paragraphs"], lambda p: p["digest"]))
    )
    numbered = F.transform(new["sections"], lambda s, i: F.struct(i.alias("section"), s.alias("node")))
    opened = F.filter(numbered, lambda s: ~F.array_contains(old_sections, s["node"]["digest"]))
    return F.flatten(
        F.transform(
            opened,
            lambda s: F.filter(
                F.transform(
                    s["node"]["paragraphs"],
                    lambda p, j: F.struct(
                        s["section"].alias("section"), j.alias("paragraph"), p["digest"].alias("digest")
                    ),
                ),
                lambda p: ~F.array_contains(old_paragraphs, p["digest"]),
            ),
        )
    )


def with_next(df: DataFrame, id_col: str, text_col: str, out: str) -> DataFrame:
    """Adds the text of the next row by descending id (after the last: the first).

    Ids are cut into ranges of even size by approximate percentiles, and each range is one
    window. The first row of a range goes along to the range before as well, so that no
    row needs a window over all of them. Rows of one id go by the hash of their text, null
    ids last. One shuffle of the text.
    """
    spark = df.sparkSession
    # The input's row is one struct: its columns may have any names.
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    key, text = F.col("row").getField(id_col).cast("long"), F.col("row").getField(text_col)
    depth = max(1, (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    shares = [i / 2**depth for i in range(2**depth - 1, 0, -1)]
    found = df.agg(F.percentile_approx(F.col(id_col).cast("long"), shares, 10 * 2**depth)).first()[0]
    table = _numbers(found or [0] * len(shares))
    # Number of bounds above the id, by halving; nulls have a range of their own.
    steps = F.array(*[F.lit(1 << s) for s in range(depth - 1, -1, -1)])
    above = F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.element_at(table, at + step) > key, at + step).otherwise(at)
    )
    ranged = rows.withColumn("range", F.when(key.isNull(), F.lit(2**depth)).otherwise(above).cast("int"))
    firsts = ranged.groupBy("range").agg(F.max(key).alias("first")).orderBy("range").collect()  # one row per range
    first_of: list[int | None] = [None] * (2**depth + 1)
    before_of = [0] * (2**depth + 1)
    for i, row in enumerate(firsts):
        first_of[row["range"]] = row["first"]
        before_of[row["range"]] = firsts[i - 1]["range"]
    first = F.element_at(_numbers(first_of), F.col("range") + 1)
    before = F.element_at(_numbers(before_of), F.col("range") + 1).cast("int")
    guest = F.struct(before.alias("range"), F.lit(True).alias("guest"))
    own = F.struct("range", F.lit(False).alias("guest"))
    places = F.when(first.eqNullSafe(key), F.array(own, guest)).otherwise(F.array(own))
    dealt = ranged.select("row", F.explode(places).alias("at")).select("row", "at.range", "at.guest")
    order = Window.partitionBy("range").orderBy("guest", key.desc_nulls_last(), F.xxhash64(text), text)
    led = dealt.repartition("range").withColumn("next", F.lead(text).over(order)).where("NOT guest")
    kept = [F.col("row").getField(c).alias(c) for c in df.columns if c != out]
    return led.select(*kept, F.col("next").alias(out))


def _numbers(values: list) -> Column:
    """An array of longs or nulls that is one literal in the plan, however long."""
    text = ",".join("" if v is None else str(v) for v in values)
    return F.transform(F.split(F.lit(text), ","), lambda x: F.nullif(x, F.lit("")).cast("long"))


def edited(text: Column, following: Column) -> Column:
    """The last half of the code points replaced by the first as many of another text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))
