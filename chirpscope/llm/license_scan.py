"""License scans: MinHash bands over overlapping text windows, in DataFrame functions only.

Texts and templates are cut into lower-cased words and ``SHINGLE``-word shingles.  A template of L
words is looked for in windows of L + stride - 1 words that begin at every multiple of the stride
(a quarter of L), so each occurrence lies whole in one window.  Windows with too few shingles of
any template cannot reach the wanted containment and are left out (an exact test).  The others
get MinHash values in bands of ``ROWS``; a window that equals a template in a band retrieves it,
and the share of the template's shingles that the window holds (exact) decides.

The number of bands is set so that a window at the very threshold misses its template with a
probability of at most ``MISS``; a window with the whole template practically never does.

Templates are a parameter (a list of id and text, part of the code's configuration, not data).

Cases: null, empty and short texts match nothing; templates of fewer words than a shingle raise an
error; rows with equal ids are scanned one by one; other columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chirpscope.llm import common as U

SHINGLE = 3
CONTAINED = 0.8
ROWS = 2
MISS = 1e-4

# Opening words of public license notices.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the "
            "GNU General Public License as published by the Free Software Foundation"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
            "fee is hereby granted"),
    ("mit", "Released under the MIT License."),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                  "and associated documentation files"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def template_words(text: str) -> list[str]:
    return re.findall(WORD, text.translate(str.maketrans(_UPPER, _LOWER)))


def stride_of(length: int) -> int:
    return max(1, length // 4)


def width_of(length: int) -> int:
    return length + stride_of(length) - 1


def needed(length: int) -> int:
    """Shingle positions that a window must share with templates of this length."""
    return max(1, math.ceil(CONTAINED * _fewest(length) - 1e-9))


def _fewest(length: int) -> int:
    return length - SHINGLE + 1


def bands_for(lengths: Sequence[int]) -> int:
    """Bands that keep the miss at the threshold below MISS for every length."""
    most = 1
    for n in lengths:
        inter, whole, window = needed(n), _fewest(n), width_of(n) - SHINGLE + 1
        same = min(1.0, inter / (window + whole - inter))
        most = max(most, 1 if same >= 1 else math.ceil(math.log(MISS) / math.log(1 - same ** ROWS)))
    return most


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(f"({WORD})"))


def shingle_at(words: Column, i: Column) -> Column:
    return F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)])


def shingles_of(words: Column) -> Column:
    last = F.size(words) - SHINGLE
    return F.when(last >= 0, F.array_distinct(F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: shingle_at(words, i)))).otherwise(
        F.array().cast("array<bigint>"))


def band_keys(shingles: Column, bands: int) -> Column:
    low = lambda k: F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, F.lit(k))))
    return F.array(*[F.xxhash64(F.lit(b), *[low(b * ROWS + r) for r in range(ROWS)]) for b in range(bands)])


def _templates(spark, templates) -> DataFrame:
    rows = []
    for name, text in templates:
        words = template_words(text)
        if len(words) < SHINGLE:
            raise ValueError(f"template {name} has fewer than {SHINGLE} words")
        rows.append(F.struct(F.lit(name).alias("template"), F.lit(len(words)).alias("length"), F.array(*map(F.lit, words)).alias("words")))
    return spark.range(1).select(F.explode(F.array(*[r.cast("struct<template:string,length:int,words:array<string>>") for r in rows])).alias("t")).select("t.*")


def matches(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, id_col: str = "doc_id",
            text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """All rows (row, doc_id), and matches (row, template, containment, start: first word of the
    best window)."""
    spark = docs.sparkSession
    known = _templates(spark, templates).withColumn("shingles", shingles_of(F.col("words")))
    listed = known.select("template", "length", "shingles").collect()
    every = sorted({s for r in listed for s in r["shingles"]})
    least: dict[int, int] = {}
    for r in listed:
        need = max(1, math.ceil(CONTAINED * len(r["shingles"]) - 1e-9))
        least[r["length"]] = min(need, least.get(r["length"], need))
    bands = bands_for(sorted(least))

    words = F.col("words")
    last = F.size(words) - SHINGLE
    hits = F.when(last >= 0, F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: shingle_at(words, i).isin(every)))
    found = (docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), words_of(F.col(text_col)).alias("words"))
             .withColumn("hits", hits))
    some = F.coalesce(F.size("hits"), F.lit(0)) > 0
    found = U.stored(found.select("row", "doc_id", F.when(some, F.col("words")).alias("words"), F.when(some, F.col("hits")).alias("hits")), "license-hits")

    def windows(length: int) -> Column:
        stride, width = stride_of(length), width_of(length)
        reach = width - SHINGLE
        first = lambda i: F.greatest(F.lit(0), F.ceil((i - reach) / stride).cast("int"))
        starts = F.array_distinct(F.flatten(F.transform("hits", lambda i: F.sequence(first(i), F.floor(i / stride).cast("int")))))
        full = F.filter(starts, lambda m: F.size(F.filter("hits", lambda i: (i >= m * stride) & (i <= m * stride + reach))) >= least[length])
        return F.transform(full, lambda m: F.struct(
            F.lit(length).alias("length"), (m * stride).alias("start"), F.slice("words", m * stride + 1, width).alias("words")))

    cut = (found.filter("hits is not null").select("row", F.explode(F.concat(*[windows(n) for n in sorted(least)])).alias("w"))
           .select("row", "w.length", "w.start", shingles_of(F.col("w.words")).alias("shingles")))
    cut = U.stored(cut, "license-windows")
    key = lambda df: df.withColumn("band", F.explode(band_keys(F.col("shingles"), bands)))
    wanted = key(known.select("template", "length", F.col("shingles"))).select("template", "length", "band", F.col("shingles").alias("whole"))
    pairs = key(cut).join(F.broadcast(wanted), ["length", "band"])
    share = F.size(F.array_intersect("whole", "shingles")) / F.size("whole")
    good = pairs.withColumn("containment", share).filter(F.col("containment") >= CONTAINED)
    best = F.max(F.struct(F.col("containment"), (-F.col("start")).alias("s"))).alias("b")
    return found.select("row", "doc_id"), good.groupBy("row", "template").agg(best).select(
        "row", "template", F.col("b.containment").alias("containment"), (-F.col("b.s")).alias("start"))


def license_table(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_licenses, licenses (template ids, sorted, comma-joined) and best (largest
    containment, 0 if none) of every row."""
    rows, found = matches(docs, **options)
    each = found.groupBy("row").agg(F.array_sort(F.collect_list("template")).alias("t"), F.max("containment").alias("best"))
    return rows.join(each, "row", "left").select(
        "doc_id", F.coalesce(F.size("t"), F.lit(0)).cast("long").alias("n_licenses"),
        F.coalesce(F.array_join("t", ","), F.lit("")).alias("licenses"), F.round(F.coalesce("best", F.lit(0.0)), 6).alias("best"))


def oracle_sql(templates: Sequence[tuple[str, str]] = TEMPLATES) -> str:
    """The same result from all windows, without MinHash."""
    quoted = ", ".join("('{}', {}, [{}])".format(n, len(w), ", ".join(f"'{x}'" for x in w)) for n, w in
                       ((n, template_words(t)) for n, t in templates))
    k = SHINGLE
    gram = " || ' ' || ".join(f"w[i + {j}]" for j in range(k))
    return f"""
WITH t(template, len, w) AS (VALUES {quoted}),
ts AS (SELECT DISTINCT template, len, greatest(1, len // 4) AS stride, {gram} AS g FROM (SELECT *, unnest(range(1, len - {k - 2})) AS i FROM t)),
tn AS (SELECT template, count(*) AS n FROM ts GROUP BY template),
d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{WORD}') AS w FROM documents),
p AS (SELECT r, i - 1 AS pos, {gram} AS g FROM (SELECT r, w, unnest(range(1, len(w) - {k - 2})) AS i FROM d WHERE len(w) >= {k})),
h AS (SELECT p.r, p.pos, ts.* FROM p JOIN ts ON p.g = ts.g),
m AS (SELECT r, template, g, unnest(range(CAST(greatest(0, ceil((pos - (len + stride - 1 - {k})) / stride)) AS BIGINT), pos // stride + 1)) AS m FROM h),
c AS (SELECT m.r, m.template, m.m, count(DISTINCT g) / any_value(tn.n) AS c FROM m JOIN tn ON m.template = tn.template GROUP BY m.r, m.template, m.m),
b AS (SELECT r, template, max(c) AS c FROM c WHERE c >= {CONTAINED} GROUP BY r, template),
f AS (SELECT r, count(*) AS n, string_agg(template, ',' ORDER BY template) AS t, max(c) AS best FROM b GROUP BY r)
SELECT d.doc_id, CAST(coalesce(f.n, 0) AS BIGINT) AS n_licenses, coalesce(f.t, '') AS licenses, round(coalesce(f.best, 0.0), 6) AS best
FROM d LEFT JOIN f ON d.r = f.r"""
