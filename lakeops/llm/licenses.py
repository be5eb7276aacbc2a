"""License notices found by min-hash bands over overlapping windows of words.

A template of m words is looked for in windows of m + s - 1 words that start every
s = m // 4 words, so each of its occurrences lies wholly inside a window and makes up at
least four fifths of it. A window and a template are retrieved together when they agree in
one of ``BANDS`` min-hashes over two-word shingles: an occurrence is missed with a chance
below 0.2 ** 8, and one that keeps four fifths of the shingles below 0.4 ** 8. Retrieved
windows are verified by exact containment: the share of the template's shingles they hold.

A min-hash can only agree where the window holds the template's smallest shingle, so
windows are made around those shingles and nowhere else; that skips no retrieval. All of
it is column expressions over one scan; the templates are a short fixed list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BANDS = 8
CONTAINMENT = 0.8
WORD_GAP = "[^\\p{L}\\p{N}]+"

# Notices as their licenses word them.
TEMPLATES = {
    "mit": "Released under the MIT License.",
    "mit_grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
    "and associated documentation files",
    "apache_2": "Licensed under the Apache License, Version 2.0.",
    "apache_2_terms": "Unless required by applicable law or agreed to in writing, software distributed under the "
    "License is distributed on an AS IS BASIS",
    "gpl_3": "This work is licensed under the GNU General Public License, version 3.",
    "gpl_terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
    "published by the Free Software Foundation",
    "bsd_terms": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met",
    "cc_by_nc_4": "Licensed under CC BY-NC 4.0.",
    "cc_by_sa_4": "Licensed under CC BY-SA 4.0.",
    "rights_reserved": "All rights reserved.",
}


def word_list(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), WORD_GAP), lambda w: w != "")


def shingles(words: Column) -> Column:
    """Hashes of all pairs of neighbouring words, in order."""
    pairs = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(
        F.slice(words, F.lit(1), pairs), F.slice(words, F.lit(2), pairs), lambda a, b: F.xxhash64(a, b)
    )


def min_hashes(hashes: Column) -> Column:
    def smallest(band: int) -> Column:
        return F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(band))))

    return F.array(*[smallest(band) for band in range(BANDS)])


def _literals(df: DataFrame, templates: dict[str, str]) -> Column:
    """The templates as a constant array of structs: name, window, stride, held, signature, keys."""
    rows = df.sparkSession.createDataFrame(list(templates.items()), "name string, text string")
    rows = rows.withColumn("words", word_list(F.col("text"))).withColumn("all", shingles(F.col("words")))
    rows = rows.withColumn("held", F.array_distinct("all")).withColumn("signature", min_hashes(F.col("held")))
    keys = F.filter("held", lambda h: F.arrays_overlap(min_hashes(F.array(h)), F.col("signature")))
    structs = []
    for row in rows.withColumn("keys", keys).collect():  # the fixed list of templates
        size = len(row["words"])
        if size < 2:
            raise ValueError(f"template {row['name']} needs two words at least")
        stride = max(1, size // 4)

        def longs(values):
            return F.array(*[F.lit(v).cast("long") for v in values])

        structs.append(
            F.struct(
                F.lit(row["name"]).alias("name"),
                F.lit(size + stride - 2).alias("width"),  # shingles of a window
                F.lit(stride).alias("stride"),
                longs(row["held"]).alias("held"),
                longs(row["signature"]).alias("signature"),
                longs(row["keys"]).alias("keys"),
            )
        )
    return F.array(*structs)


def scan(
    df: DataFrame,
    templates: dict[str, str] | None = None,
    containment: float = CONTAINMENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, license, containment, first_word and windows: a row for every template found
    in a row's text. ``first_word`` counts words from 0 at the first of the best windows;
    ``windows`` is the number of windows that qualify.

    Null and empty texts, and those of one word, give no rows; rows with equal ids each
    give theirs; null ids are kept. Other columns are not read.
    """
    known = _literals(df, TEMPLATES if templates is None else templates)
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), word_list(F.col(text_col)).alias("words"))
    rows = rows.select("doc_id", shingles(F.col("words")).alias("h"))
    met = F.filter(known, lambda t: F.arrays_overlap(F.col("h"), t["keys"]))
    rows = rows.withColumn("t", F.explode(met))
    # Starts of the windows that hold one of the template's smallest shingles.
    stride, width, h = F.col("t.stride"), F.col("t.width"), F.col("h")
    places = F.filter(
        F.transform(h, lambda x, i: F.when(F.array_contains(F.col("t.keys"), x), i).otherwise(-1)), lambda i: i >= 0
    )
    starts = F.array_distinct(
        F.flatten(
            F.transform(
                places,
                lambda p: F.transform(
                    F.sequence(
                        F.greatest(F.ceil((p - width + 1) / stride), F.lit(0)).cast("int"),
                        F.floor(p / stride).cast("int"),
                    ),
                    lambda k: k * stride,
                ),
            )
        )
    )
    rows = rows.withColumn("starts", starts)
    windows = F.transform(
        "starts", lambda s: F.struct(s.alias("start"), F.slice(h, s + 1, width).alias("held"))
    )
    retrieved = F.filter(
        windows,
        lambda w: F.exists(
            F.zip_with(min_hashes(w["held"]), F.col("t.signature"), lambda a, b: a == b), lambda equal: equal
        ),
    )
    measured = F.transform(
        retrieved,
        lambda w: F.struct(
            (F.size(F.array_intersect(F.col("t.held"), w["held"])) / F.size("t.held")).alias("containment"),
            (-w["start"]).alias("back"),
        ),
    )
    rows = rows.withColumn("found", F.filter(measured, lambda w: w["containment"] >= containment))
    best = F.array_max("found")
    return rows.where(F.size("found") > 0).select(
        "doc_id",
        F.col("t.name").alias("license"),
        best["containment"].alias("containment"),
        (-best["back"]).cast("int").alias("first_word"),
        F.size("found").alias("windows"),
    )
