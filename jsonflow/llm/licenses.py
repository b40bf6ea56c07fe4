"""License scans by diagonal voting, in built-in functions only.

Every text's rolling word k-grams are joined by hash with the places of the same k-grams in the
templates, and compared word by word. A hit at word ``pos`` of a text and ``at`` of a template lies
on the diagonal ``pos - at``: an unchanged copy of a template has all its hits on one, an edited one on a few neighbouring
ones. Hits are counted by diagonal, neighbouring diagonals are merged to spans, and a span is verified against the
stretch of template that it covers by edit distance. Its score is the share of the template covered times
the likeness of the two; a document has a template's label from ``least`` on. Of spans that start at
the same word the best alone counts, so notices that differ in their last words are told apart.

One pass over the texts writes a row per document and one per hit; texts are not shuffled. Only a hit
that starts a run of hits carries the words that follow it, as many as the template has left, so a notice
travels about once. Templates are joined in blocks of at most ``TEMPLATE_GRAMS`` k-grams, which bounds what is
broadcast however many templates there are; rows are narrow from there on, keyed by document and template.

Nulls and edge cases: a null text is empty; texts with fewer words than a phrase have no places. Rows
are judged one by one, so rows that repeat an id or a text get equal results, and a null id comes back as null.
Labels with equal scores all stand. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jsonflow.llm.common import stored, texts_of

# Words are what is neither ASCII sign nor blank; A-Z count as a-z.
WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
K = 3
# A span counts from this score on; diagonals a template's SLACKth apart belong together.
LEAST, SLACK = 0.8, 8
TEMPLATE_GRAMS = 20_000

# Phrases that label a document by themselves.
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]
# The wording of common notices.
TEMPLATES = [
    ("reserved", "All rights reserved."),
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd", "Licensed under the BSD License."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0."),
]


def _lowered(text: Column) -> Column:
    """A-Z alone in lower case; where there is only ASCII that is what ``lower`` does."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))


def _gram(words: Column, at: Column, k: int = K) -> Column:
    return F.concat_ws(" ", *[F.get(words, at + j) for j in range(k)])


def template_grams(spark: SparkSession, templates=TEMPLATES, k: int = K) -> DataFrame:
    """``hash, gram, template, at, before, size``: every k-gram of every template with its place."""
    rows = [(i, label, text) for i, (label, text) in enumerate(templates)]
    made = spark.createDataFrame(rows, "template int, label string, text string")
    made = made.select("template", _words(_lowered(F.col("text"))).alias("words")).where(F.size("words") >= k)
    made = made.select("template", "words", F.size("words").alias("size"), F.explode(F.sequence(F.lit(0), F.size("words") - k)).alias("at"))
    gram = _gram(F.col("words"), F.col("at"), k)
    before = F.when(F.col("at") > 0, F.get("words", F.col("at") - 1))
    # The hash is that of the text in lower case throughout, which equal grams share; the gram decides.
    return made.select(F.xxhash64(F.lower(gram)).alias("hash"), gram.alias("gram"), "template", "at", before.alias("before"), "size")


def _base_places(words: Column, low: Column) -> Column:
    """Place and label of every base phrase. Texts without its words are not looked through."""
    may = reduce(Column.__or__, [reduce(Column.__and__, [F.contains(low, F.lit(w)) for w in phrase.split()]) for phrase, _ in BASE])

    def label(at: Column) -> Column:
        out = F.lit(None).cast("string")
        for phrase, name in BASE:
            there = [_lowered(F.get(words, at + j)) == w for j, w in enumerate(phrase.split())]
            out = F.when(reduce(Column.__and__, there), F.lit(name)).otherwise(out)
        return out

    marked = F.transform(words, lambda _, i: F.struct(i.alias("at"), label(i).alias("label")))
    none = F.array().cast("array<struct<at: int, label: string>>")
    return F.when(may, F.filter(marked, lambda x: x["label"].isNotNull())).otherwise(none)


def _hits(texts: DataFrame, grams: DataFrame, k: int) -> DataFrame:
    """A row for every text (``pos`` -1, with its facts) and one for every place of a template k-gram in it."""
    staged = texts.select(
        F.monotonically_increasing_id().alias("row_id"),
        "doc_id",
        _words(F.coalesce("text", F.lit(""))).alias("_words"),
        F.lower(F.coalesce("text", F.lit(""))).alias("_low"),
    )
    words = F.col("_words")
    staged = staged.select("row_id", "doc_id", "_words", F.size(words).alias("n_words"), _base_places(words, F.col("_low")).alias("base"))
    pos = F.col("pos")
    each = staged.select("row_id", "doc_id", "n_words", "base", "_words", F.explode(F.sequence(F.lit(-1), F.greatest(F.col("n_words") - k, F.lit(-1)))).alias("pos"))
    gram = F.when(pos >= 0, _gram(words, pos, k))
    joined = each.join(grams, (F.xxhash64(F.lower(gram)) == F.col("hash")) & (_lowered(gram) == F.col("gram")), "left")
    joined = joined.where((pos < 0) | F.col("template").isNotNull())
    starts = (F.col("at") == 0) | (pos == 0) | (_lowered(F.get(words, pos - 1)) != F.col("before"))
    follow = F.slice(words, pos + 1, F.col("size") - F.col("at") + _slack(F.col("size")))
    fact = pos < 0
    return joined.select(
        "row_id",
        "pos",
        F.when(fact, F.col("doc_id")).alias("doc_id"),
        F.when(fact, F.col("n_words").cast("long")).alias("n_words"),
        F.when(fact, F.col("base")).alias("base"),
        "template",
        "at",
        F.when((pos >= 0) & starts, _lowered(F.array_join(follow, " "))).alias("follow"),
    )


def _slack(size: Column) -> Column:
    return F.greatest(F.lit(1), (size / SLACK).cast("int"))


def spans(hits: DataFrame, sizes: DataFrame, k: int = K) -> DataFrame:
    """``row_id, template, votes, start, n, score``: merged diagonals with the verified score of their span.

    ``sizes`` holds ``template, label, words, size``. A span that covers too little is not compared.
    """
    voted = hits.where("pos >= 0").withColumn("diagonal", F.col("pos") - F.col("at"))
    first = F.min(F.when(F.col("follow").isNotNull(), F.struct("pos", "follow"))).alias("first")
    ends = [F.max("pos").alias("pos"), F.min("at").alias("low"), F.max("at").alias("high")]
    voted = voted.groupBy("row_id", "template", "diagonal").agg(F.count("*").alias("votes"), first, *ends)
    voted = voted.join(sizes, "template")
    line = Window.partitionBy("row_id", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(line)
    voted = voted.withColumn("fresh", F.when(gap <= _slack(F.col("size")), 0).otherwise(1))
    voted = voted.withColumn("band", F.sum("fresh").over(line))
    merged = voted.groupBy("row_id", "template", "band").agg(
        F.sum("votes").alias("votes"), F.min("first").alias("first"), F.max("pos").alias("pos"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    merged = merged.join(sizes, "template")
    length = F.col("pos") + k - F.col("first.pos")
    covered = F.col("high") + k - F.col("low")
    found = F.array_join(F.slice(F.split("first.follow", " "), F.lit(1), length), " ")
    wanted = F.array_join(F.slice("words", F.col("low") + 1, covered), " ")
    merged = merged.select(
        "row_id", "template", "label", "votes", F.col("first.pos").alias("start"), length.alias("n"),
        (covered / F.col("size")).alias("share"), found.alias("found"), wanted.alias("wanted"),
    )
    likeness = 1 - F.levenshtein("found", "wanted") / F.greatest(F.char_length("found"), F.char_length("wanted"))
    score = F.when(F.col("share") >= LEAST, F.col("share") * likeness).otherwise(0.0)
    return merged.select("row_id", "template", "label", "votes", "start", "n", F.round(score, 6).alias("score"))


def scan(docs: DataFrame, templates=TEMPLATES, k: int = K, least: float = LEAST) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``, one row per document."""
    spark = docs.sparkSession
    sizes = spark.createDataFrame([(i, label, text) for i, (label, text) in enumerate(templates)], "template int, label string, text string")
    sizes = sizes.select("template", "label", _words(_lowered(F.col("text"))).alias("words")).withColumn("size", F.size("words"))
    made = None
    for block in _blocks(templates, k):
        # At most TEMPLATE_GRAMS rows by construction.
        grams = F.broadcast(template_grams(spark, templates, k).where(F.col("template").isin(block)))
        hits = _hits(texts_of(docs), grams, k)
        # The facts of documents come with the first block.
        made = stored(hits) if made is None else made.union(stored(hits.where("pos >= 0")))
    found = spans(made, sizes, k).where(F.col("score") >= least)
    best = F.max("score").over(Window.partitionBy("row_id", "start"))
    found = found.withColumn("best", best).where("score = best")
    found = found.groupBy("row_id").agg(F.collect_set("label").alias("found"), F.max("score").alias("score"))
    facts = made.where("pos < 0").select("row_id", "doc_id", "n_words", "base").join(found, "row_id", "left")
    base_labels = F.transform("base", lambda x: x["label"])
    none = F.array().cast("array<string>")
    place = F.transform("base", lambda x: x["at"].cast("long"))
    return facts.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(place).alias("first_word"),
        F.array_max(place).alias("last_word"),
        F.array_join(F.sort_array(F.array_distinct(base_labels)), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(base_labels, F.coalesce("found", none))), ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def _blocks(templates, k: int) -> list[list[int]]:
    """Numbers of templates in blocks of at most ``TEMPLATE_GRAMS`` k-grams; a template is not cut."""
    blocks: list[list[int]] = [[]]
    size = 0
    for i, (_, text) in enumerate(templates):
        more = max(0, len(text.split()) * 2 - k + 1)
        if blocks[-1] and size + more > TEMPLATE_GRAMS:
            blocks.append([])
            size = 0
        blocks[-1].append(i)
        size += more
    return blocks


def sql_check(templates=TEMPLATES, k: int = K, least: float = LEAST) -> str:
    """The same in DuckDB SQL."""
    words = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
    values = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate((a, b.replace("'", "''")) for a, b in templates))
    gram = " || ' ' || ".join(f"words[spot + {j + 1}]" for j in range(k))
    phrases = ", ".join(f"('{p}', '{name}', {len(p.split())})" for p, name in BASE)
    return f"""
    WITH templates AS (
      SELECT template, label, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{words}') AS words
      FROM (VALUES {values}) v(template, label, text)),
    grams AS (SELECT template, spot, {gram} AS gram FROM (SELECT *, unnest(range(len(words) - {k} + 1)) AS spot FROM templates)),
    texts AS MATERIALIZED (
      SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{words}') AS words
      FROM documents),
    placed AS MATERIALIZED (SELECT row_id, words, unnest(range(len(words))) AS spot FROM texts),
    base AS (
      SELECT row_id, count(*) AS n_base, min(spot) AS first_word, max(spot) AS last_word, list(DISTINCT name) AS names
      FROM placed, (VALUES {phrases}) p(phrase, name, size) WHERE array_to_string(words[spot + 1:spot + size], ' ') = phrase GROUP BY row_id),
    hits AS (
      SELECT row_id, template, p.spot AS pos, g.spot, p.spot - g.spot AS diagonal
      FROM (SELECT row_id, spot, {gram} AS gram FROM placed) p JOIN grams g ON p.gram = g.gram),
    voted AS (
      SELECT h.row_id, h.template, diagonal, min(pos) AS low_pos, max(pos) AS pos, min(spot) AS low, max(spot) AS high,
             greatest(1, any_value(len(words)) // {SLACK}) AS slack
      FROM hits h JOIN templates t ON h.template = t.template GROUP BY ALL),
    fresh AS (
      SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY row_id, template ORDER BY diagonal) <= slack THEN 0 ELSE 1 END AS fresh
      FROM voted),
    banded AS (SELECT *, sum(fresh) OVER (PARTITION BY row_id, template ORDER BY diagonal) AS band FROM fresh),
    merged AS (
      SELECT row_id, template, min(low_pos) AS start, max(pos) + {k} AS stop, min(low) AS low, max(high) + {k} AS high, any_value(slack) AS slack,
             arg_min(low, (low_pos, diagonal)) AS from_at
      FROM banded GROUP BY row_id, template, band),
    compared AS (
      SELECT m.row_id, label, start, (high - low) / len(t.words) AS share,
             array_to_string(x.words[start + 1:least(stop, start + len(t.words) - from_at + slack)], ' ') AS found,
             array_to_string(t.words[low + 1:high], ' ') AS wanted
      FROM merged m JOIN templates t ON m.template = t.template JOIN texts x ON m.row_id = x.row_id),
    scored AS (
      SELECT row_id, label, start, round(share * (1 - levenshtein(found, wanted) / greatest(length(found), length(wanted))), 6) AS score
      FROM compared WHERE share >= {least}),
    ranked AS (SELECT * FROM scored QUALIFY score = max(score) OVER (PARTITION BY row_id, start)),
    found AS (SELECT row_id, list(DISTINCT label) AS labels, max(score) AS score FROM ranked WHERE score >= {least} GROUP BY row_id)
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, first_word, last_word,
           coalesce(array_to_string(list_sort(names), ','), '') AS base_labels,
           coalesce(array_to_string(list_sort(list_distinct(list_concat(names, labels))), ','), '') AS labels, coalesce(score, 0.0) AS score
    FROM texts x LEFT JOIN base b ON x.row_id = b.row_id LEFT JOIN found f ON x.row_id = f.row_id
    """
