"""License scans by an exact set-similarity join of text blocks with license templates.

1. Words: runs of ASCII letters, digits and all signs beyond ASCII, A-Z lower-cased. Those that occur in a
   template or a base phrase are kept with their place, the rest only counted. A block is ``BLOCK`` words in a
   row; one starts every ``STRIDE`` words, so any ``STRIDE`` + 1 words in a row lie whole in some block.
2. Order: the templates' words by how often the corpus has them, rarest first. A block holds a template if
   it has at least the share ``LEAST`` of the template's distinct words, ``need`` of its ``size`` words.
3. Prefix filter: such a block has one of the template's first size - need + 1 words in that order, so only
   blocks around these words are formed and joined, on the word, with the templates' prefixes.
   Length filter: the block has at least ``need`` template words. Positional filter: with a common word at place
   i of the template and j of the block, the overlap is at most min(i, j) + 1 + min(rest, rest).
4. What is left is verified by its whole overlap. The filters never drop a block that holds a template.

Bounds: templates are a parameter, so their words, prefixes and their ranks are bounded by it whatever
the corpus; the broadcast and the collected counts are of that size. A block has at most ``BLOCK`` words.

Defined results: NULL and empty texts have no words, no labels and score 0; rows are told apart by doc_id and
text, so rows of one id keep their own results and repeated rows have equal ones; NULL ids are ids; an empty
table gives an empty answer; other columns are not read. The score is the largest share of a template found
in a block if that is at least ``LEAST``, else 0.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged, table

BLOCK = 64
STRIDE = 32
#: Share of a template's distinct words that a block must have.
LEAST = 0.9
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Phrases that are labels wherever their words follow each other.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Sentences by which public licenses are granted, and their labels.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at apache.org/licenses"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc0", "the author has waived all copyright and related or neighboring rights to this work to the extent possible under law"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0"),
    ("cc-by-nd", "licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
)


def words_of(text: str) -> list[str]:
    return [w.translate(str.maketrans(UPPER, LOWER)) for w in re.findall(WORD, text)]


def needed(size: int, least: float) -> int:
    return math.ceil(size * least - 1e-9)


def lowered(word: Column) -> Column:
    return F.translate(word, UPPER, LOWER)


def found_words(text: Column, vocabulary: list[str]) -> Column:
    """(pos, word) of a text's words that are in the vocabulary, by place."""
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))
    placed = F.transform(words, lambda w, i: F.struct(i.alias("pos"), w.alias("word")))
    # lower() is quick but folds signs beyond ASCII too: it only chooses what lowered() then decides
    known = F.filter(placed, lambda h: F.lower(h["word"]).isin(*vocabulary) & lowered(h["word"]).isin(*vocabulary))
    return F.transform(known, lambda h: F.struct(h["pos"].alias("pos"), lowered(h["word"]).alias("word")))


def phrase_places(hits: Column, phrases=PHRASES) -> Column:
    """(pos, label) of the places where a phrase's words follow each other. Its words are all in the
    vocabulary, so they are neighbours in ``hits``."""

    def label(hit: Column, i: Column) -> Column:
        out = F.lit(None).cast("string")
        for phrase, name in phrases:
            words = phrase.split()
            here = hit["word"] == words[0]
            for k, word in enumerate(words[1:], 1):
                following = F.get(hits, i + k)
                here = here & (following["word"] == word) & (following["pos"] == hit["pos"] + k)
            out = F.when(here, F.lit(name)).otherwise(out)
        return F.struct(hit["pos"].alias("pos"), out.alias("label"))

    return F.filter(F.transform(hits, label), lambda p: p["label"].isNotNull())


def rank_words(found: DataFrame, vocabulary: list[str]) -> list[str]:
    """The vocabulary, rarest in the corpus first: one count per word comes to the driver."""
    counts = found.select(F.explode("hits.word").alias("word")).groupBy("word").count().collect()
    seen = {r["word"]: r["count"] for r in counts}
    return sorted(vocabulary, key=lambda w: (seen.get(w, 0), w))


def holding(found: DataFrame, templates, vocabulary: list[str], least: float) -> DataFrame:
    """(doc_id, mark, label, share) of every block that holds a template; several rows for a block that shares
    several words with the template's prefix."""
    spark = found.sparkSession
    ranked = rank_words(found, vocabulary)
    rank = {w: i for i, w in enumerate(ranked)}
    rows, starts = [], set()
    for label, text in templates:
        own = sorted({rank[w] for w in words_of(text)})
        need = needed(len(own), least)
        for i, place in enumerate(own[: len(own) - need + 1]):
            starts.add(ranked[place])
            rows.append((place, i, label, own, need))
    index = spark.createDataFrame(rows, "rank int, i int, label string, own array<int>, need int")
    least_need = min(r[4] for r in rows)

    # blocks around words of a prefix
    rare = F.filter("hits", lambda h: h["word"].isin(*sorted(starts)))
    last = F.transform(rare, lambda h: F.floor(h["pos"] / STRIDE).cast("int"))
    blocks = F.array_distinct(F.concat(last, F.filter(F.transform(last, lambda b: b - (BLOCK // STRIDE - 1)), lambda b: b >= 0)))
    formed = found.filter(F.size("hits") >= least_need).select("doc_id", "mark", "hits", F.explode(blocks).alias("block"))
    low = F.col("block") * STRIDE
    order = F.array(*[F.lit(w) for w in ranked])
    inside = F.filter("hits", lambda h: (h["pos"] >= low) & (h["pos"] < low + BLOCK))
    places = F.transform(inside, lambda h: (F.array_position(order, h["word"]) - 1).cast("int"))
    formed = formed.select("doc_id", "mark", F.array_sort(F.array_distinct(places)).alias("words"))
    formed = formed.filter(F.size("words") >= least_need)
    asked = formed.select("doc_id", "mark", "words", F.posexplode("words").alias("j", "rank"))

    near = asked.join(F.broadcast(index), "rank")  # bounded by the templates
    near = near.filter(F.size("words") >= F.col("need"))
    most = F.least("i", "j") + 1 + F.least(F.size("own") - F.col("i"), F.size("words") - F.col("j")) - 1
    near = near.filter(most >= F.col("need"))
    common = F.size(F.array_intersect("own", "words"))
    near = near.select("doc_id", "mark", "label", "need", F.size("own").alias("size"), common.alias("common"))
    return near.filter("common >= need").select("doc_id", "mark", "label", (F.col("common") / F.col("size")).alias("share"))


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, least: float = LEAST) -> DataFrame:
    """doc_id, n_words, base (array of (pos, label)), found labels (array) and score of every row."""
    vocabulary = sorted({w for _, t in templates for w in words_of(t)} | {w for p, _ in phrases for w in p.split()})
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        F.xxhash64(text).alias("mark"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"),
        found_words(F.col("text"), vocabulary).alias("hits"),
    )
    found = staged(rows, "license-words")
    held = holding(found, templates, vocabulary, least)
    held = held.groupBy("doc_id", "mark").agg(F.collect_set("label").alias("labels"), F.max("share").alias("score"))
    held = held.withColumnRenamed("doc_id", "held_id").withColumnRenamed("mark", "held_mark")
    out = found.select("doc_id", "mark", "n_words", phrase_places(F.col("hits"), phrases).alias("base"))
    out = out.join(held, F.col("doc_id").eqNullSafe(F.col("held_id")) & (F.col("mark") == F.col("held_mark")), "left")
    return out.select(
        "doc_id", "n_words", "base", F.coalesce("labels", F.array().cast("array<string>")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score")
    )


def op11_setjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def listed(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.pos").cast("long").alias("first_word"),
        F.array_max("base.pos").cast("long").alias("last_word"),
        listed(F.col("base.label")).alias("base_labels"),
        listed(F.concat("base.label", "labels")).alias("labels"),
        "score",
    )


def _sql() -> str:
    quoted = [(label, words_of(text)) for label, text in TEMPLATES]
    rows = ", ".join(
        f"({i}, '{label}', [{', '.join(repr(w) for w in sorted(set(words)))}], {needed(len(set(words)), LEAST)})"
        for i, (label, words) in enumerate(quoted)
    )
    base = " UNION ALL ".join(
        f"SELECT r, i AS pos, '{name}' AS label FROM placed WHERE "
        + " AND ".join(f"w[i + {k + 1}] = '{word}'" for k, word in enumerate(phrase.split()))
        for phrase, name in PHRASES
    )
    return f"""
WITH template(t, label, own, need) AS (VALUES {rows}),
d AS (SELECT row_number() OVER () AS r, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
placed AS (SELECT r, w, unnest(range(len(w))) AS i FROM d),
base AS ({base}),
based AS (SELECT r, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels, list(DISTINCT label) AS ls FROM base GROUP BY r),
block AS (SELECT r, w[b * {STRIDE} + 1 : b * {STRIDE} + {BLOCK}] AS words
  FROM (SELECT r, w, unnest(range((len(w) + {STRIDE - 1}) // {STRIDE})) AS b FROM d)),
held AS (SELECT r, label, len(list_intersect(own, words)) / len(own) AS share
  FROM block, template WHERE len(list_intersect(own, words)) >= need),
kept AS (SELECT r, list(DISTINCT label) AS ls, max(share) AS score FROM held GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(based.ls, []), coalesce(kept.ls, [])))), ',') AS labels,
  coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN based USING (r) LEFT JOIN kept USING (r)
"""


OP11_SQL = _sql()
