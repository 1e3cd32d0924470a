"""License scan: phrases, and an exact set-similarity join with license templates.

DataFrame functions only.  Words are runs of ASCII letters and digits and of
characters beyond ASCII, after lower-casing A-Z.

*Base.*  Places where a phrase's words stand consecutively.

*Method.*  A template is a set of words.  Text blocks of a template of w words are
the windows of 2w words that begin at every multiple of w, so each passage of up to
w words lies whole in a block.  A block meets a template of s distinct words if
it holds at least o = ceil(0.8 s) of them.

1. The words of all templates are ordered by the number of documents that hold
   them, rarest first (ties by the word): counted over all documents.
2. *Prefix filter*: whoever holds o of a template's s words holds one of its s - o + 1
   first ones.  A document's template words, in that order, are probed against the
   table of these prefixes (an equi-join on the word).
3. *Length filter*: a document with fewer than o template words is out.
   *Positional filter*: a shared word at place i of the template and j of the document
   leaves at most 1 + min(s - i - 1, d - j - 1) shared words; fewer than o is out.
4. *Verification*: the shared words are counted; a pair is kept where the probing
   word is the first shared one, so each pair once.  For pairs that hold, the
   same count is taken in each block.

A document holds every word of its blocks, so filtering whole documents first
loses no block; the result equals that of comparing all blocks with all templates.
Templates are a small table (``MAX_TEMPLATE_WORDS`` words in all, checked), hence the
broadcast of their prefixes.

Defined results: a null or empty text has no words, no places, empty labels and score
0; rows that repeat an id and text get equal results; an empty table gives an empty
result.  Only the id and text columns are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_key, text_of

NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.8
MAX_TEMPLATE_WORDS = 20_000

#: Fixed values of the contract: phrase -> label.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: The notices that the licenses ask authors to include, with their labels.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
            "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
            "notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                 "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless "
                 "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
                 "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
            "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
            "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
            "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
            "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
            "distribution."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
              "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
                  "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
                  "purpose, commercial or non-commercial, and by any means."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased.  ``lower`` also changes other letters, which no phrase or
    template holds, but turns two of them (the dotted capital I and the Kelvin sign) into a-z."""
    odd = F.contains(text, F.lit("İ")) | F.contains(text, F.lit("K"))
    return F.when(odd, F.translate(text, _UPPER, _LOWER)).otherwise(F.lower(text))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text), NON_WORD), "")


def plain_words(text: str) -> list[str]:
    return re.findall(WORD, text.translate(str.maketrans(_UPPER, _LOWER)))


def _spaced(words: Sequence[str]) -> str:
    return " " + "  ".join(words) + " "


def _words_in(spaced: Column) -> Column:
    """Words of a string in which each stands between two blanks of its own."""
    return ((F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit("")))) / 2).cast("long")


def phrase_places(words: Column, phrases: Mapping[str, str]) -> tuple[Column, Column, Column, list[Column]]:
    """(places, first place, last place, a label or null per phrase) of ``phrases`` in an array of words."""
    found = []
    for phrase, label in phrases.items():
        parts = plain_words(phrase)
        if any(parts[:k] == parts[-k:] for k in range(1, len(parts))):
            raise ValueError(f"a phrase may not overlap itself: {phrase}")
        spaced = F.concat(F.lit(" "), F.array_join(words, "  "), F.lit(" "))
        look = _spaced(parts)
        gate = F.array_contains(words, parts[-1]) & F.array_contains(words, parts[0])
        here = F.when(gate, spaced)
        inside = F.contains(here, F.lit(look))
        found.append((
            F.when(inside, (F.length(here) - F.length(F.replace(here, F.lit(look), F.lit("")))) / len(look)).cast("long"),
            F.when(inside, _words_in(F.substring_index(here, look, 1))),
            F.when(inside, F.size(words) - len(parts) - _words_in(F.substring_index(here, look, -1))).cast("long"),
            F.when(inside, F.lit(label)),
        ))
    counts, first, last, labels = zip(*found, strict=True)
    total = F.lit(0).cast("long")
    for c in counts:
        total = total + F.coalesce(c, F.lit(0))
    return total, F.least(*first), F.greatest(*last), list(labels)


def template_table(templates: Sequence[tuple[str, str]], order: Mapping[str, int], threshold: float = THRESHOLD) -> list[dict]:
    """Per template: label, tokens in ``order`` (place of each word; rarest first),
    size, least shared words, prefix length and words of its blocks."""
    out = []
    for label, text in templates:
        words = plain_words(text)
        tokens = sorted(set(words), key=order.__getitem__)
        least = math.ceil(round(threshold * len(tokens), 9))
        out.append({"label": label, "tokens": tokens, "size": len(tokens), "least": least,
                    "prefix": len(tokens) - least + 1, "words": len(words)})
    return out


def token_order(docs: DataFrame, templates: Sequence[tuple[str, str]], text_col: str = "text") -> dict[str, int]:
    """Place of every template word when ordered by the number of documents holding
    it, over all documents; one row per template word reaches the driver."""
    vocabulary = sorted({w for _, t in templates for w in plain_words(t)})
    if len(vocabulary) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates hold more than {MAX_TEMPLATE_WORDS} different words")
    held = F.array_intersect(F.array(*map(F.lit, vocabulary)), words_of(text_of(text_col)))
    counts = {r.w: r.n for r in docs.select(F.explode(held).alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}
    return {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}


def matching_blocks(docs: DataFrame, order: Mapping[str, int], templates: Sequence[tuple[str, str]] = TEMPLATES, id_col: str = "doc_id",
                    text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(rk1, rk2, label, template, start, shared, size): every block that meets a
    template.  ``template`` numbers ``templates``; ``start`` is the block's first word."""
    spark = docs.sparkSession
    made = template_table(templates, order, threshold)
    prefixes = [(w, i, t["label"], k, t["size"], t["least"], t["words"], t["tokens"])
                for k, t in enumerate(made) for i, w in enumerate(t["tokens"][:t["prefix"]])]
    index = spark.createDataFrame(prefixes, "probe string, i int, label string, template int, size int, least int, words int, tokens array<string>")
    ordered = F.array(*map(F.lit, sorted(order, key=order.__getitem__)))
    d = docs.select(*row_key(id_col, text_col), words_of(text_of(text_col)).alias("w"))
    d = d.withColumn("held", F.array_intersect(ordered, F.col("w")))
    # Only prefix words probe; a document without any, or with too few template words, ends here.
    first_words = F.array(*map(F.lit, sorted({p[0] for p in prefixes})))
    d = d.filter(F.size("held") >= min(t["least"] for t in made)).withColumn("probes", F.array_intersect("held", first_words))
    d = d.filter(F.size("probes") > 0).select("*", F.explode("probes").alias("probe"))
    pair = d.join(F.broadcast(index), "probe")
    j = F.array_position("held", F.col("probe")) - 1
    most = 1 + F.least(F.col("size") - F.col("i") - 1, F.size("held") - j - 1)
    pair = pair.filter((F.size("held") >= F.col("least")) & (most >= F.col("least")))
    shared = F.array_intersect("tokens", "held")
    pair = pair.filter((F.size(shared) >= F.col("least")) & (F.get(shared, F.lit(0)) == F.col("probe")))
    starts = F.expr("sequence(0, size(w) - 1, words)")
    block = pair.select("rk1", "rk2", "label", "template", "size", "least", "words", "tokens", "w", F.explode(starts).alias("start"))
    window = F.slice("w", F.col("start") + 1, 2 * F.col("words"))
    block = block.withColumn("shared", F.size(F.array_intersect("tokens", window)))
    return block.filter(F.col("shared") >= F.col("least")).select("rk1", "rk2", "label", "template", F.col("start").cast("long").alias("start"),
                                                                  "shared", "size")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: Mapping[str, str] = PHRASES,
                  templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_base, first_word, last_word,
    base_labels, labels (with those of templates), score (1 with a phrase, else
    the largest share of a template in a block, 0 if none meets the threshold)
    and n_blocks (blocks that meet a template, counted per template)."""
    order = token_order(docs, templates, text_col)
    blocks = matching_blocks(docs, order, templates, id_col, text_col, threshold)
    per_row = blocks.dropDuplicates(["rk1", "rk2", "template", "start"]).groupBy("rk1", "rk2").agg(
        F.collect_set("label").alias("more"), F.max(F.col("shared") / F.col("size")).alias("share"), F.count("*").alias("n_blocks"))
    d = docs.select(F.col(id_col).alias("_id"), *row_key(id_col, text_col), words_of(text_of(text_col)).alias("w"))
    n_base, first, last, labels = phrase_places(F.col("w"), phrases)
    base = d.select("_id", "rk1", "rk2", F.size("w").cast("long").alias("n_words"), n_base.alias("n_base"), first.alias("first_word"),
                    last.alias("last_word"), F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))).alias("base"))
    out = base.join(per_row, ["rk1", "rk2"], "left")
    every = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    return out.select(
        F.col("_id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
        F.coalesce("n_blocks", F.lit(0)).cast("long").alias("n_blocks"))


def oracle_sql(templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """All blocks against all templates, and all places against all phrases."""
    made = template_table(templates, {w: 0 for _, t in templates for w in plain_words(t)}, threshold)
    lists = ", ".join(f"({k}, '{t['label']}', {sorted(t['tokens'])!r}, {t['least']}, {t['words']})" for k, t in enumerate(made))
    looks = ", ".join(f"('{label}', {plain_words(p)!r})" for p, label in PHRASES.items())
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{WORD}') AS w FROM documents),
p(label, ws) AS (VALUES {looks}),
place AS (SELECT r, label, i FROM (SELECT r, label, ws, w, unnest(range(0, len(w))) AS i FROM t, p) WHERE w[i + 1:i + len(ws)] = ws),
base AS (SELECT r, count(*) AS n, min(i) AS a, max(i) AS b, list(DISTINCT label) AS labels FROM place GROUP BY r),
m(k, label, tokens, least, words) AS (VALUES {lists}),
block AS (SELECT r, k, label, least, tokens, w[s + 1:s + 2 * words] AS b
          FROM (SELECT r, k, label, least, tokens, words, w, unnest(range(0, len(w), words)) AS s FROM t, m)),
hit AS (SELECT r, label, len(list_intersect(tokens, b)) / len(tokens) AS share FROM block WHERE len(list_intersect(tokens, b)) >= least),
more AS (SELECT r, list(DISTINCT label) AS labels, max(share) AS share, count(*) AS n FROM hit GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(base.n, 0) AS n_base, base.a AS first_word, base.b AS last_word,
       coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(coalesce(base.labels, []) || coalesce(more.labels, []))), ','), '') AS labels,
       CASE WHEN base.n > 0 THEN 1.0 ELSE coalesce(more.share, 0) END::DOUBLE AS score, coalesce(more.n, 0) AS n_blocks
FROM t LEFT JOIN base ON t.r = base.r LEFT JOIN more ON t.r = more.r"""
