"""License notices in documents by MinHash bands over overlapping windows, in DataFrame operations only.

A template is looked for in windows of a size that fits it and that overlap so far that every passage of
its length lies in one whole. Windows and templates are sets of word shingles; they meet in a join on
MinHash bands and are then compared exactly: the share of the template's shingles in the window.
With ``BANDS`` bands of one row a pair of Jaccard similarity j meets with probability
``1 - (1 - j) ** BANDS``; the least j of a pair that has to be found is 1/4 (``least_similarity``), which
makes 0.9999. Windows without any of a template's anchor words cannot hold enough of its shingles
(see ``anchor_words``), and are never made.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runweave.llm.common import content_key

SHINGLE = 5
CONTAINMENT = 0.8
BANDS = 32
WORD = r"([\p{L}\p{N}]+)"
#: Templates are a short list by definition, which is the bound of the broadcast; more are refused.
MOST_TEMPLATES = 10_000

# --- fixed values: license notices, by SPDX name ------------------------------------
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the "
                   "License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
# -------------------------------------------------------------------------------------


def template_table(spark: SparkSession, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """``(license, notice)`` as a table."""
    return spark.createDataFrame(templates, "license string, notice string")


def words(text: Column) -> Column:
    """Runs of letters and digits of any script, in lower case; a null text has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), 1)


def shingles(of: Column, size: Column) -> Column:
    """Distinct five-word shingles of a list of words; a shorter list is one shingle, none has none."""
    last = F.greatest(size - SHINGLE, F.lit(0))
    made = F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(of, i + 1, SHINGLE), " "))
    return F.when(size > 0, F.array_distinct(made)).otherwise(F.array().cast("array<string>"))


def bands(of: Column) -> Column:
    """``BANDS`` MinHash values of a set of hashed shingles, each with its number mixed in."""
    return F.array(
        *[F.xxhash64(F.lit(b), F.array_min(F.transform(of, lambda h: F.xxhash64(h, F.lit(b))))) for b in range(BANDS)]
    )


def window_of(size: int) -> tuple[int, int]:
    """Window length and stride for templates of ``size`` words: room for a fifth more words, and the stride."""
    stride = max(1, size // 4)
    return math.ceil(size / CONTAINMENT) + stride, stride


def least_similarity(size: int) -> float:
    """Least Jaccard similarity of a template of ``size`` words and a window that holds enough of it."""
    own = max(1, size - SHINGLE + 1)
    held = max(1, window_of(size)[0] - SHINGLE + 1)
    common = math.ceil(CONTAINMENT * own)
    return common / (own + held - common)


def anchor_words(notice: list[str]) -> set[str]:
    """Words of a template of which any matching passage has one.

    A match may lack a fifth of the shingles at most, so words that more than a fifth of them have
    will do. The longest words are taken, for they are the rarest.
    """
    made = [notice[i : i + SHINGLE] for i in range(max(1, len(notice) - SHINGLE + 1))]
    out: set[str] = set()
    for word in sorted(set(notice), key=lambda w: (-len(w), w)):
        out.add(word)
        covered = sum(not out.isdisjoint(s) for s in made)
        if covered > len(made) - math.ceil(CONTAINMENT * len(made)):
            break
    return out


def scan(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """``(doc_id, key, license, containment, first_word)``: licenses whose notice a row of ``docs`` has.

    ``containment`` is the largest share of a notice's shingles in one window, ``CONTAINMENT`` at least, and
    ``first_word`` the number (from 0) of the first such window's first word. Rows with equal id and text
    give one row a license; null texts, and templates without words, match nothing; either table may be empty.
    """
    known = templates.select("license", words(F.col("notice")).alias("w")).where(F.size("w") > 0).distinct()
    listed = known.limit(MOST_TEMPLATES + 1).collect()
    if len(listed) > MOST_TEMPLATES:
        raise ValueError(f"more than {MOST_TEMPLATES} templates")
    sizes: dict[int, set[str]] = {}
    for _, notice in listed:
        sizes.setdefault(len(notice), set()).update(anchor_words(notice))
    schema = "doc_id bigint, key binary, license string, containment double, first_word int"
    if not sizes:
        return docs.sparkSession.createDataFrame([], schema)
    every = sorted(set().union(*sizes.values()))
    rare = r"(?iu)(?<![\p{L}\p{N}])(?:" + "|".join(map(re.escape, every)) + r")(?![\p{L}\p{N}])"
    rows = docs.where(F.col("text").rlike(rare)).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), content_key().alias("key"), words(F.col("text")).alias("doc")
    )

    def starts(doc: Column, size: int) -> Column:
        """Windows of one size that have an anchor of the templates of that size."""
        width, stride = window_of(size)
        anchors = F.array(*map(F.lit, sorted(sizes[size])))
        at = F.filter(F.sequence(F.lit(0), F.size(doc) - 1), lambda i: F.array_contains(anchors, F.get(doc, i)))
        cover = F.transform(
            at,
            lambda p: F.sequence(
                F.greatest(F.lit(0), F.ceil((p - width + 1) / stride).cast("int")), F.floor(p / stride).cast("int")
            ),
        )
        return F.transform(
            F.array_distinct(F.flatten(cover)),
            lambda k: F.struct(F.lit(size).alias("size"), F.lit(width).alias("width"), (k * stride).alias("start")),
        )

    # Each explode also keeps the optimizer from working out the words anew for every window.
    windows = rows.where(F.size("doc") > 0).select(
        "doc_id", "key", "doc", F.explode(F.concat(*[starts(F.col("doc"), n) for n in sorted(sizes)])).alias("x")
    )
    windows = windows.select(
        "doc_id", "key", "x.size", "x.start", F.slice("doc", F.col("x.start") + 1, F.col("x.width")).alias("win")
    )
    windows = windows.withColumn("set", shingles(F.col("win"), F.size("win")))
    windows = windows.withColumn("hashes", F.transform("set", lambda s: F.xxhash64(s)))
    windows = windows.select("doc_id", "key", "size", "start", "set", F.explode(bands(F.col("hashes"))).alias("band"))
    notices = known.select("license", F.size("w").alias("size"), shingles(F.col("w"), F.size("w")).alias("notice"))
    notices = notices.withColumn("hashes", F.transform("notice", lambda s: F.xxhash64(s)))
    notices = notices.select("license", "size", "notice", F.explode(bands(F.col("hashes"))).alias("band"))
    share = F.size(F.array_intersect("notice", "set")) / F.size("notice")
    met = windows.join(F.broadcast(notices), ["size", "band"]).withColumn("containment", share)
    return (
        met.where(F.col("containment") >= CONTAINMENT)
        .groupBy("doc_id", "key", "license")
        .agg(F.max("containment").alias("containment"), F.min("start").alias("first_word"))
    )
