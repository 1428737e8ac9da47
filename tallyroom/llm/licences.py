"""Find licence statements in documents by their word pairs.

Each line of a document, and its whole text, is normalised (A-Z lowered, all
but a-z and 0-9 to one blank) and cut into the set of its word pairs. A
template with m pairs and a unit with n can only reach Dice 2i/(n+m) >= t if
t*m/(2-t) <= n <= (2-t)*m/t, so units meet templates by an equality join on n:
the templates, a fixed list, are listed once per admissible n. Before that,
units are dropped that lack telling words of every template: without them so
many pairs are missing that t cannot be reached. Only built-in
functions run; nothing of a document is shuffled but the hits and its id.

With ``parts``, any run of words of a document is a unit too, across lines,
and whole licence texts are looked for as well as notices. A run reaches its
best Dice with a template from the first to the last pair of stretches of
template pairs (a template pair at the edge never lowers it, another never
raises it), so only such runs are scored: those that hold at least
t*m/(2-t) template pairs in at most (2-t)/t times the template's length. The
For templates of ``LONG`` pairs and more, where that is too many, runs start at
stretches of at least four pairs and have ``LONG_SIZES``: a text just above t
may be missed there. The places of template pairs are found by an equality join on the pair; texts that
go in are those with telling words or, for long texts, enough of their words.

Nulls and empty texts have no units and give a row without licence. Equal
scores go to the licence whose name sorts first. Rows that repeat a doc_id
repeat its result. Only the named columns are read, so extra ones do no harm.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from importlib import resources

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroom.llm.frames import fold_ascii
from tallyroom.sources.durable import durable, small_frame

# Notices as the licences word them.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0 Universal, no rights reserved."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)

#: Further notices that only the scan of parts looks for.
PART_NOTICES: tuple[tuple[str, str], ...] = (
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
)


def whole_texts() -> tuple[tuple[str, str], ...]:
    """The licence texts kept beside this module."""
    files = sorted((resources.files("tallyroom.llm") / "licence_texts").iterdir(), key=lambda f: f.name)
    return tuple((f.name.removesuffix(".txt"), f.read_text("utf-8")) for f in files if f.name.endswith(".txt"))


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(fold_ascii(text), "[^a-z0-9]+", " "))


def all_pairs(plain: Column) -> Column:
    """Pairs of neighbouring words of a normalised text, in order."""
    words = F.split(plain, " ")
    # pair i is (word i, word i + 1): zip the words with themselves, one further
    return F.zip_with(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
        F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b),
    )


def word_pairs(plain: Column) -> Column:
    """Distinct pairs of neighbouring words of a normalised text."""
    return F.array_distinct(all_pairs(plain))


def plain_words(text: str) -> list[str]:
    """The words of a template, as ``normalised`` parts them."""
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return re.sub("[^a-z0-9]+", " ", lowered).strip(" ").split(" ")


def size_range(m: int, threshold: float) -> range:
    """Pair counts a unit may have to reach ``threshold`` with m pairs."""
    low, high = threshold * m / (2 - threshold), (2 - threshold) * m / threshold
    return range(max(1, math.ceil(low - 1e-9)), math.floor(high + 1e-9) + 1)


STEM = 6  # letters of a telling word that are looked for


def telling_words(notices: list[list[str]], threshold: float) -> list[list[list[str]]]:
    """Per notice (its words), groups of words: a unit that reaches ``threshold`` with it holds a word of each group.

    With m pairs, at least i = t * (n + m) / 2 >= t * m / (2 - t) are shared. A
    group's words stand in more than m - i pairs, so a unit without any of them
    lacks too many. Words are cut to ``STEM`` letters (what holds a word holds
    its stem). Groups are filled in turn: stems of earlier notices' first groups
    come first, then those with digits, then the longest.
    """
    taken: set[str] = set()
    out: dict[int, list[list[str]]] = {}
    for i in sorted(range(len(notices)), key=lambda i: len(notices[i])):
        words = [w[:STEM] for w in notices[i]]
        spots = list(dict.fromkeys(zip(notices[i], notices[i][1:])))
        spare = len(spots) - math.ceil(threshold * len(spots) / (2 - threshold) - 1e-9)
        groups: list[list[str]] = []
        group: list[str] = []
        covered: set[tuple[str, str]] = set()
        for stem in sorted(set(words), key=lambda w: (w not in taken, w.isalpha(), -len(w), w)):
            group.append(stem)
            covered |= {p for p in spots if stem in (p[0][:STEM], p[1][:STEM])}
            if len(covered) > spare:
                groups.append(group)
                group, covered = [], set()
        if groups:
            taken.update(groups[0])
        out[i] = groups
    return [out[i] for i in range(len(notices))]


def may_name(column: str, telling: list[list[list[str]]]) -> Column:
    """Whether a text holds a word of each of some notice's first telling groups; it is lowered once for all words."""

    def any_of(stems: list[str]) -> str:
        return "(" + " OR ".join(f"contains(x, '{w}')" for w in stems) + ")"

    firsts = list(dict.fromkeys(w for groups in telling for w in groups[0]))
    if not firsts:
        return F.lit(False)
    one = " OR ".join(dict.fromkeys("(" + " AND ".join(any_of(g) for g in groups[:4]) + ")" for groups in telling))
    return F.expr(f"exists(array(lower({column})), x -> {any_of(firsts)} AND ({one}))")


LONG = 300  # pairs from which a text is told by how many of its words are there
LONG_SIZES = (0.67, 0.8, 0.9, 1.0, 1.1, 1.25, 1.5)  # of such a text, of the runs compared with it


def least_words(words: list[str], threshold: float) -> int:
    """Distinct words of a template that a text reaching ``threshold`` with it must hold.

    Words left out take their pairs along, each pair at most twice counted: the
    most words are left out if they are those with the fewest pairs.
    """
    spots = set(zip(words, words[1:]))
    spare = 2 * (len(spots) - math.ceil(threshold * len(spots) / (2 - threshold) - 1e-9))
    pairs_of: dict[str, set] = defaultdict(set)
    for p in spots:
        for w in p:
            pairs_of[w].add(p)
    left = 0
    for n in sorted(len(p) for p in pairs_of.values()):
        if n > spare:
            break
        spare, left = spare - n, left + 1
    return len(pairs_of) - left


def may_hold(column: str, templates: list[list[str]], threshold: float) -> Column:
    """Whether a text has enough different words of some long template; it is cut once for all of them."""
    if not templates:
        return F.lit(False)
    least = [least_words(words, threshold) for words in templates]
    pairs = [math.ceil(threshold * len(set(zip(w, w[1:]))) / (2 - threshold) - 1e-9) for w in templates]
    listed = lambda words: F.split(F.lit(" ".join(sorted(words))), " ")

    def enough(own: Column) -> Column:
        found = F.lit(False)
        for words, n in zip(templates, least):
            found = found | (F.size(F.array_intersect(own, listed(set(words)))) >= n)
        return found

    known = F.array_intersect(F.split(normalised(F.col(column)), " "), listed({w for words in templates for w in words}))
    # a pair takes two letters and two blanks at least, less one
    return (F.length(column) >= 2 * min(pairs) + 1) & F.exists(F.array(known), lambda own: (F.size(own) >= min(least)) & enough(own))


def part_hits(texts: DataFrame, templates: list[tuple[str, str]], threshold: float) -> DataFrame:
    """``(_id, licence, dice)`` of the runs of words in ``(_id, _text)`` that reach ``threshold`` with a template."""
    spark = texts.sparkSession
    words = [(name, plain_words(notice)) for name, notice in templates]
    words = [(name, w) for name, w in words if len(w) > 1]
    pairs = [list(dict.fromkeys(" ".join(p) for p in zip(w, w[1:]))) for _, w in words]
    least = [math.ceil(threshold * len(p) / (2 - threshold) - 1e-9) for p in pairs]
    widest = [math.floor((2 - threshold) * (len(w) - 1) / threshold + 1e-9) for _, w in words]
    telling = telling_words([w for (_, w), p in zip(words, pairs) if len(p) < LONG], threshold)
    long = [w for (_, w), p in zip(words, pairs) if len(p) >= LONG]
    places = small_frame(spark, [(p, t) for t, own in enumerate(pairs) for p in own], "pair string, t int")
    limits = small_frame(
        spark,
        [(t, least[t], widest[t], len(w) - 1, len(pairs[t]) >= LONG) for t, (_, w) in enumerate(words)],
        "t int, least int, widest int, width int, long boolean",
    )
    known = small_frame(spark, [(t, name, own, len(own)) for t, ((name, _), own) in enumerate(zip(words, pairs))], "t int, licence string, of array<string>, m int")

    chosen = durable(
        texts.where(F.col("_text").isNotNull() & (may_name("_text", telling) | may_hold("_text", long, threshold)))
        .select("_id", F.xxhash64("_text").alias("_hash"), normalised(F.col("_text")).alias("_plain")),
        "licence-texts",
    )
    spots = (
        chosen.select("_id", "_hash", F.posexplode(all_pairs(F.col("_plain"))).alias("pos", "pair"))
        .join(F.broadcast(places), "pair")
        .groupBy("_id", "_hash", "t")
        .agg(F.sort_array(F.collect_set("pos")).alias("at"))
        .join(F.broadcast(limits), "t")
        .where(F.size("at") >= F.col("least"))
    )
    # i and j count places from 1; a stretch starts where the place before is not the one next to it
    starts = """filter(sequence(1, size(at) - least + 1), i ->
        (i = 1 OR get(at, i - 2) < get(at, i - 1) - 1) AND get(at, i + least - 2) - get(at, i - 1) < widest
        AND (NOT long OR get(at, i + 2) - get(at, i - 1) = 3))"""
    ends = """filter(sequence(i + least - 1, size(at)), j ->
        (j = size(at) OR get(at, j) > get(at, j - 1) + 1)
        AND (get(at, j - 1) - get(at, i - 1) < widest OR get(at, j - 1) - get(at, i - 1) = j - i))"""
    # long templates: the pairs that a run of each size holds
    sizes = f"""filter(array_distinct(transform(array({", ".join(f"{f}D" for f in LONG_SIZES)}), f ->
        size(filter(at, x -> x < get(at, i - 1) + ceil(f * width))))), j -> j >= i + least - 1)"""
    runs = (
        spots.withColumn("i", F.explode(F.expr(starts)))
        .withColumn("j", F.explode(F.expr(f"if(long, {sizes}, {ends})")))
        .groupBy("_id", "_hash")
        .agg(F.collect_set(F.struct("t", F.expr("get(at, i - 1)").alias("lo"), F.expr("get(at, j - 1)").alias("hi"))).alias("runs"))
        .select(F.col("_id").alias("_of"), F.col("_hash").alias("_hash_of"), "runs")
    )
    part = F.slice("pairs", F.col("run.lo") + 1, F.col("run.hi") - F.col("run.lo") + 1)
    return (
        chosen.join(runs, F.col("_id").eqNullSafe(F.col("_of")) & (F.col("_hash") == F.col("_hash_of")))
        .select("_id", "runs", F.explode(F.array(all_pairs(F.col("_plain")))).alias("pairs"))
        .select("_id", "pairs", F.explode("runs").alias("run"))
        .join(F.broadcast(known), F.col("run.t") == F.col("t"))
        .select("_id", "licence", (F.lit(2.0) * F.size(F.array_intersect(part, F.col("of"))) / (F.size(F.array_distinct(part)) + F.col("m"))).alias("dice"))
        .where(F.col("dice") >= threshold)
    )


def licence_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.8,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    parts: bool = False,
) -> DataFrame:
    """One row per document: its best licence, that Dice score, and how many licences it names.

    Without ``parts``, units are lines and the whole text; with it, also runs of
    words in them, and whole licence texts count as templates.
    """
    spark = docs.sparkSession
    known = small_frame(spark, [(i, n, t) for i, (n, t) in enumerate(templates)], "t bigint, licence string, notice string")
    plain = known.withColumn("plain", normalised(F.col("notice")))
    sized = plain.select("t", "licence", "plain", word_pairs(F.col("plain")).alias("of")).withColumn("m", F.size("of"))
    listed = sized.select("t", "m", "plain").collect()  # the fixed list
    sizes = [(r.t, n) for r in listed for n in size_range(r.m, threshold)]
    sized = sized.drop("plain").join(small_frame(spark, sizes, "t bigint, n int"), "t")
    widest = max([n for _, n in sizes], default=0)
    # a notice of fewer than two words has no pairs and is never found
    telling = telling_words([r.plain.split(" ") for r in listed if r.m], threshold)

    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    lines = F.split("_text", "\n")
    units = (
        texts.where(F.col("_text").isNotNull() & may_name("_text", telling))
        .select("_id", F.explode(F.when(F.size(lines) > 1, F.concat(lines, F.array("_text"))).otherwise(lines)).alias("unit"))
        .where(may_name("unit", telling))
        # as a generated column the pairs are made once, not again in each condition on them
        .select("_id", F.explode(F.array(word_pairs(normalised(F.col("unit"))))).alias("pairs"))
        .withColumn("n", F.size("pairs"))
        .where(F.col("n").between(1, widest))
    )
    shared = F.size(F.array_intersect("pairs", "of"))
    hits = (
        units.join(F.broadcast(sized), "n")  # a few thousand rows, from the fixed list
        .withColumn("dice", F.lit(2.0) * shared / (F.col("n") + F.col("m")))
        .where(F.col("dice") >= threshold)
        .select("_id", "licence", "dice")
    )
    if parts:
        hits = hits.unionByName(part_hits(texts, [*templates, *PART_NOTICES, *whole_texts()], threshold))
    hits = hits.groupBy("_id", "licence").agg(F.max("dice").alias("dice"))
    best = Window.partitionBy("_id").orderBy(F.col("dice").desc(), "licence")
    per_doc = (
        hits.select("_id", "licence", "dice", F.row_number().over(best).alias("at"), F.count(F.lit(1)).over(Window.partitionBy("_id")).alias("n_licences"))
        .where(F.col("at") == 1)
        .select(F.col("_id").alias("_hit"), "licence", "dice", "n_licences")
    )
    return texts.select("_id").join(per_doc, F.col("_id").eqNullSafe(F.col("_hit")), "left").select(
        F.col("_id").alias(id_col), "licence", F.coalesce("dice", F.lit(0.0)).alias("dice"), F.coalesce("n_licences", F.lit(0)).cast("bigint").alias("n_licences")
    )


def _sql_pairs(plain: str) -> str:
    words = f"string_split({plain}, ' ')"
    return f"list_distinct(list_transform(list_zip({words}[:-2], {words}[2:]), lambda p: p[1] || ' ' || p[2]))"


def _sql_plain(text: str) -> str:
    return f"trim(regexp_replace(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g'))"


def licence_sql(threshold: float = 0.8) -> str:
    rows = ", ".join("('" + n + "', '" + t.replace("'", "''") + "')" for n, t in TEMPLATES)
    return f"""
WITH templates AS (SELECT licence, {_sql_pairs(_sql_plain('notice'))} AS b FROM (VALUES {rows}) v(licence, notice)),
units AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS u FROM documents WHERE text IS NOT NULL
  UNION ALL SELECT doc_id, text FROM documents WHERE text IS NOT NULL),
pairs AS (SELECT doc_id, {_sql_pairs(_sql_plain('u'))} AS a FROM units),
scored AS (
  SELECT doc_id, licence, max(2.0::DOUBLE * len(list_intersect(a, b)) / (len(a) + len(b))) AS dice
  FROM pairs JOIN templates ON len(a) * (2 - {threshold}) >= {threshold} * len(b) - 1e-6 AND len(a) * {threshold} <= (2 - {threshold}) * len(b) + 1e-6
  WHERE len(a) > 0 GROUP BY ALL HAVING dice >= {threshold}),
best AS (
  SELECT doc_id, licence, dice, count(*) OVER (PARTITION BY doc_id) AS n_licences FROM scored
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, licence) = 1)
SELECT d.doc_id, licence, coalesce(dice, 0.0::DOUBLE) AS dice, coalesce(n_licences, 0)::BIGINT AS n_licences
FROM documents d LEFT JOIN best USING (doc_id)"""
