"""License scan by diagonal voting, in DataFrame functions.

Every word k-gram of every text meets the k-grams of the license templates in a join on their
hashes, with the words compared behind it. A hit at word ``w`` of a text and word ``t`` of a
template votes for the diagonal ``w - t``: an unchanged passage puts all its votes on one. Votes
are added up per diagonal, neighbouring diagonals, which words left out or put in make, are merged,
and a span counts if enough of its template and of its own words is covered.

Named phrases are templates of two or three words that have to be there whole. Texts are taken
apart once, in chunks of words; what is shuffled are hits, which are few.

Defined results
    null texts count as empty; they have no words and no spans.
    repeated rows are scanned each for itself, ids may be null or repeat.
    words are counted from 0, ends are exclusive; A-Z count as a-z, other characters as they are.
    an empty table gives empty results. Other columns are left out, whatever their names.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lorekiln.sources.shared import Workspace

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a chunk; bounds the arrays that are made from a text's words.
CHUNK = 1024
#: Word k-grams of license texts; phrases are their own.
K = 4
#: Diagonals that are at most so far apart are one.
NEIGHBOURS = 5
#: Of a span's own words, at least so many belong to hits.
DENSE = 0.5
#: Templates of up to so many grams are broadcast (some 10 MB); more of them are shuffled.
BROADCAST_GRAMS = 100_000


@dataclass(frozen=True)
class Template:
    """A license text: its label, the share of its words that a span has to cover, and whether it
    is a named phrase."""

    label: str
    text: str
    least: float = 0.6
    named: bool = False

    @property
    def words(self) -> list[str]:
        return re.findall(WORD, self.text.translate(str.maketrans(UPPER, LOWER)))

    @property
    def k(self) -> int:
        return min(K, len(self.words))


#: Fixed phrases.
PHRASES = (
    Template("mit", "MIT License", 1.0, True),
    Template("apache", "Apache License", 1.0, True),
    Template("gpl", "General Public License", 1.0, True),
)
#: Notices and grants as their licenses word them.
TEXTS = (
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    Template("mit-grant", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files, to deal in the Software without restriction, including without limitation the rights to use,
        copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"""),
    Template("mit-grant", """The above copyright notice and this permission notice shall be included in all copies or substantial
        portions of the Software"""),
    Template("as-is", """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT"""),
    Template("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies"""),
    Template("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met"""),
    Template("bsd", """Redistributions of source code must retain the above copyright notice, this list of conditions and the
        following disclaimer"""),
    Template("apache-notice", """Unless required by applicable law or agreed to in writing, software distributed under the License is
        distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"""),
    Template("gpl-notice", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version"""),
    Template("gpl-notice", """This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
        the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"""),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
)
TEMPLATES = PHRASES + TEXTS


def _grams(spark: SparkSession, templates: tuple[Template, ...]) -> tuple[DataFrame, int]:
    rows = []
    for number, t in enumerate(templates):
        words = t.words
        rows += [(number, at, " ".join(words[at : at + t.k])) for at in range(len(words) - t.k + 1)]
    kind = "array<struct<template: int, t: int, template_gram: string>>"
    listed = F.from_json(F.lit(json.dumps([dict(zip(("template", "t", "template_gram"), row, strict=True)) for row in rows])), kind)
    grams = spark.range(1).select(F.inline(listed))
    return grams.withColumn("hash", F.xxhash64("template_gram")), len(rows)


def _parts(words: Column, size: int) -> Column:
    """A head with the number of words, then chunks with the first words of the next one."""
    begins = F.sequence(F.lit(0), F.size(words), F.lit(CHUNK))
    chunk = lambda at: F.struct(F.lit(None).cast("bigint").alias("n_words"), at.alias("begin"), F.slice(words, at + 1, F.lit(CHUNK + size - 1)).alias("words"))
    head = F.struct(F.size(words).cast("bigint").alias("n_words"), F.lit(-1).alias("begin"), F.array().cast("array<string>").alias("words"))
    return F.concat(F.array(head), F.transform(begins, chunk))


def _windows(words: Column, size: int) -> Column:
    """The words from each place on, ``size`` of them or what is left."""
    runs = F.transform(words, lambda w, k: F.concat_ws(" ", w, *[F.get(words, k + j) for j in range(1, size)]))
    return F.slice(runs, F.lit(1), F.lit(CHUNK))


def _hits(docs: DataFrame, templates: tuple[Template, ...], id_col: str, text_col: str) -> DataFrame:
    """(row, id, n_words, w, template, t): a head per document, with the id and number of words,
    and the hits; ``row`` tells rows with equal ids apart."""
    grams, count = _grams(docs.sparkSession, templates)
    sizes = sorted({t.k for t in templates})
    lowered = F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER)
    split = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0)).alias("words"))
    parts = split.select("id", "row", F.explode(_parts(F.col("words"), sizes[-1])).alias("part"))
    places = parts.select("id", "row", "part.n_words", "part.begin", F.posexplode_outer(_windows(F.col("part.words"), sizes[-1])).alias("place", "window"))
    is_head = F.col("n_words").isNotNull()
    own = F.array(*[F.substring_index("window", " ", size) if size < sizes[-1] else F.col("window") for size in sizes])
    own = F.when(is_head, F.array(F.lit(None).cast("string"))).otherwise(own)
    asked = places.select(F.when(is_head, F.col("id")).alias("id"), "row", "n_words", (F.col("begin") + F.col("place")).alias("w"), F.explode(own).alias("gram"))
    asked = asked.filter(is_head | F.col("gram").isNotNull()).withColumn("hash", F.when(~is_head, F.xxhash64("gram")))
    table = F.broadcast(grams) if count <= BROADCAST_GRAMS else grams
    met = asked.join(table, "hash", "left").filter(is_head | (F.col("gram") == F.col("template_gram")))
    return met.select("row", "id", "n_words", "w", "template", "t")


@dataclass(frozen=True)
class Found:
    """documents: row, id, n_words. spans: row, label, named, start, end (words), score: the
    share of the template's words that the span covers."""

    documents: DataFrame
    spans: DataFrame


def find_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> Found:
    """Spans of all templates in all texts."""
    work = Workspace(docs.sparkSession, "licenses")
    hits = work.keep(_hits(docs, templates, id_col, text_col), "hits")
    size, length = _of(templates, lambda t: t.k), _of(templates, lambda t: len(t.words))
    votes = hits.filter("template is not null").groupBy("row", "template", (F.col("w") - F.col("t")).alias("diagonal"))
    votes = votes.agg(F.min("w").alias("first"), F.max("w").alias("last"), F.collect_set("t").alias("places"))
    # Whole phrases are their diagonal; the others are merged with their neighbours.
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    named = _of(templates, lambda t: t.named)
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > F.when(named, 0).otherwise(NEIGHBOURS), F.lit(True))
    groups = votes.withColumn("fresh", apart.cast("int")).withColumn("group", F.sum("fresh").over(along))
    covered = F.array_distinct(F.flatten(F.transform(F.flatten(F.collect_list("places")), lambda t: F.sequence(t, t + size - 1))))
    ranges = F.array_distinct(F.flatten(F.collect_list("spread")))
    groups = groups.withColumn("spread", F.flatten(F.transform("places", lambda t: F.sequence(F.col("diagonal") + t, F.col("diagonal") + t + size - 1))))
    spans = groups.groupBy("row", "template", "group").agg(
        F.min("first").alias("start"), F.max(F.col("last") + size).alias("end"), F.size(covered).alias("covered"), F.size(ranges).alias("own")
    )
    score = F.col("covered") / length
    sound = (score >= _of(templates, lambda t: t.least)) & (F.col("own") >= DENSE * (F.col("end") - F.col("start")))
    spans = spans.filter(sound).select("row", _of(templates, lambda t: t.label).alias("label"), named.alias("named"), "start", "end", score.alias("score"))
    return Found(hits.filter("n_words is not null").select("row", "id", "n_words"), spans)


def _of(templates: tuple[Template, ...], what) -> Column:
    """A property of the row's template."""
    return F.get(F.array(*[F.lit(what(t)) for t in templates]), F.col("template"))
