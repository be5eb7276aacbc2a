"""Rows every operator has to cope with."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, rank int, copy string"

LONG = " ".join(f"word{i % 997} tail{i % 13}." for i in range(30_000))
PROSE = (
    "The river ran past the old mill and the children counted boats until evening. "
    "Nobody in the village remembered when the wheel had last turned, or who had built it."
)

ROWS = [
    (1, PROSE, "en", "a", len(PROSE)),
    (2, PROSE, "en", "a", len(PROSE)),
    (3, PROSE.replace("evening", "morning"), "en", "b", len(PROSE)),
    (4, "", "en", "b", 0),
    (5, None, None, None, None),
    (6, "   \n\t ", "de", "a", 6),
    (7, "one", "fr", None, 3),
    (8, LONG, "en", "a", len(LONG)),
    (9, "Ärger über Öl, ß und 東京 – 😀 naïve.\n\nZweiter Absatz!", "de", "c", 50),
    (9, "Ärger über Öl, ß und 東京 – 😀 naïve.\n\nZweiter Absatz!", "de", "c", 50),
    (9, "another text under the same id, with a few more words in it", "en", "c", 50),
    (None, "a row without id but with some words, and a stop.", "en", "a", 10),
    (None, None, None, None, None),
    (12, "x" * 5000, "en", "a", 5000),
    (13, "token " * 4000, "en", "a", 24000),
]


def frame(spark, rows=None):
    """The rows with more columns, some of them named like the operators' own."""
    rows = ROWS if rows is None else rows
    return spark.createDataFrame([(*r, "s", 7, "c") for r in rows], SCHEMA)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
