"""Licence scan: fixed phrases, and an exact containment join of text blocks with templates.

The base finds every place where a phrase's words stand consecutively. The method adds labels
by set similarity: a text's words are cut into overlapping windows (blocks), and a template is
found where a block holds at least ``THRESHOLD`` of the template's distinct words. Words are
ordered by their frequency over all blocks, rarest first. A block that meets the threshold
must share a word with the template's prefix (its rarest words up to the number that may be
missing), must have enough template words in all (length filter), and the words that can still
match after the first shared one must reach the threshold (positional filter). The filters
drop no qualifying pair; survivors are verified on the full sets.

A template of any length may be given: one of more than ``PIECE`` words is cut into even runs of
at most so many, and each run is a template of its own with the same label. Windows hold twice as
many words and move by ``PIECE``, so every run of a text as long as a piece lies within one window.

Null texts are empty; a text without words has no label and score 0; repeated rows are
returned one by one; an empty table gives an empty result; a template without words finds
nothing; very long texts are only more windows of the same row. Templates are a parameter: their
pieces and one rank for each of their words, which the caller's driver holds already, are the
only side that is broadcast. No group is formed by block content, so a line that stands in a
third of all documents is a third of the rows and nothing more.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import ascii_lower, staged, text_or_empty

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases and their labels.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
# Notices by which licences are announced, and whole licence paragraphs.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it"),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
        SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION
        OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
        DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "bsd",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: Redistributions of source code must retain the above copyright notice, this
        list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above
        copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution.""",
    ),
    (
        "apache",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
        required by applicable law or agreed to in writing, software distributed under the License is distributed on an
        "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License.""",
    ),
    (
        "gpl",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    ),
]
THRESHOLD = 0.8
PIECE = 24
BLOCK, STEP = 2 * PIECE, PIECE


def template_pieces(templates: list[tuple[str, str]], most: int = PIECE) -> list[tuple[str, list[str]]]:
    """(label, distinct words) of each template, long ones in even runs of at most ``most`` words."""
    found = []
    for label, text in templates:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        runs = math.ceil(len(words) / most)
        cuts = [len(words) * i // runs for i in range(runs + 1)] if runs else []
        found += [(label, sorted(set(words[a:b]))) for a, b in zip(cuts, cuts[1:])]
    return found


def words_needed(words: list[str]) -> int:
    """How many of a piece's distinct words a block must hold."""
    return math.ceil(THRESHOLD * len(words) - 1e-9)


def normalised(text: Column) -> Column:
    """Words parted by single spaces, with one space before and after."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(ascii_lower(text_or_empty(text)), NOT_WORD, " ")), F.lit(" "))


def _places(words: Column, flat: Column) -> Column:
    """(place, label) of every phrase; the words are looked at only where the phrase occurs."""
    kind = "array<struct<place:int,label:string>>"

    def spots(phrase: str, label: str) -> Column:
        parts = phrase.split(" ")

        def here(i: Column) -> Column:
            same = F.lit(True)
            for k, part in enumerate(parts):
                same = same & (F.get(words, i + k) == part)
            return F.coalesce(same, F.lit(False))

        starts = F.filter(F.sequence(F.lit(0), F.greatest(F.size(words) - len(parts), F.lit(0))), here)
        found = F.transform(starts, lambda i: F.struct(i.alias("place"), F.lit(label).alias("label")))
        return F.when(flat.contains(f" {phrase} "), found).otherwise(F.array().cast(kind))

    return F.concat(*[spots(phrase, label) for phrase, label in PHRASES])


def _blocks(words: Column, known: Column, least: int) -> Column:
    """The template words of each window, for windows with at least ``least`` of them; texts
    with fewer ``known`` words have no window to look at."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - (BLOCK - STEP), F.lit(1)), F.lit(STEP))
    windows = F.transform(starts, lambda s: F.array_intersect(F.slice(words, s, F.lit(BLOCK)), known))
    return F.when(F.size(known) >= least, F.filter(windows, lambda w: F.size(w) >= least)).otherwise(
        F.array().cast("array<array<string>>")
    )


def prepared(docs: DataFrame, text: str, key: str, templates: list[tuple[str, str]]) -> DataFrame:
    """One row per document: words counted, phrase places, blocks with template words."""
    pieces = [words for _, words in template_pieces(templates)]
    vocabulary = F.lit(sorted({w for words in pieces for w in words})).cast("array<string>")
    least = min(map(words_needed, pieces), default=1)
    flat = F.col("flat")
    return (
        docs.select(F.col(key).alias("doc_id"), normalised(F.col(text)).alias("flat"))
        .withColumn("words", F.when(F.trim(flat) == "", F.array().cast("array<string>")).otherwise(F.split(F.trim(flat), " ")))
        .withColumn("known", F.array_intersect("words", vocabulary))
        .select(
            F.monotonically_increasing_id().alias("row_id"),
            "doc_id",
            F.size("words").cast("long").alias("n_words"),
            _places(F.col("words"), flat).alias("places"),
            _blocks(F.col("words"), F.col("known"), least).alias("blocks"),
        )
    )


def contained(blocks: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(row_id, block) -> row_id, label, containment of each block and template that qualify."""
    cells = [
        F.struct(F.lit(label).alias("label"), F.lit(words).alias("words"), F.lit(words_needed(words)).alias("needed"))
        for label, words in template_pieces(templates)
    ]
    kind = "array<struct<label:string,words:array<string>,needed:int>>"
    sets = blocks.sparkSession.range(1).select(F.inline(F.array(*cells).cast(kind)))
    frequency = blocks.select(F.explode("block").alias("word")).groupBy("word").count()
    vocabulary = sets.select(F.explode("words").alias("word")).distinct()
    ordered = vocabulary.join(frequency, "word", "left").select(
        F.struct(F.coalesce("count", F.lit(0)).alias("n"), "word").alias("token")
    )
    # One row: the templates' words, rarest first.
    order = F.broadcast(ordered.agg(F.transform(F.sort_array(F.collect_list("token")), lambda t: t["word"]).alias("order")))
    ranks = sets.join(order, how="cross").select(
        "label", "needed", F.size("words").alias("m"), F.array_intersect("order", "words").alias("sorted")
    )
    prefix = ranks.select(
        "label", "needed", "m", "sorted",
        F.posexplode(F.slice("sorted", F.lit(1), F.col("m") - F.col("needed") + 1)).alias("i", "word"),
    )
    ranked = blocks.join(order, how="cross").select("row_id", F.array_intersect("order", "block").alias("block"))
    pairs = ranked.select("row_id", "block", F.posexplode("block").alias("j", "word")).join(F.broadcast(prefix), "word")
    # At the first shared word of a pair nothing rarer is shared, so what can still match is bounded.
    left = F.least(F.col("m") - F.col("i"), F.size("block") - F.col("j"))
    earlier = F.size(F.array_intersect(F.slice("sorted", F.lit(1), F.col("i")), "block"))
    survivors = pairs.filter(left >= F.col("needed")).filter(earlier == 0)
    overlap = F.size(F.array_intersect("block", "sorted"))
    return survivors.filter(overlap >= F.col("needed")).select("row_id", "label", (overlap / F.col("m")).alias("containment"))


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id", templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row per document: n_words, n_base, first_word, last_word, base_labels, labels, score."""
    rows = staged(prepared(docs, text, key, templates))
    blocks = rows.select("row_id", F.explode("blocks").alias("block"))
    added = contained(blocks, templates).groupBy("row_id").agg(
        F.collect_set("label").alias("added"), F.max("containment").alias("containment")
    )
    found = F.size("places") > 0
    spots = F.transform("places", lambda p: p["place"].cast("long"))
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    none = F.array().cast("array<string>")
    return rows.drop("blocks").join(added, "row_id", "left").select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.when(found, F.array_min(spots)).alias("first_word"),
        F.when(found, F.array_max(spots)).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.coalesce("added", none))), ",").alias("labels"),
        F.when(found, F.lit(1.0)).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )
