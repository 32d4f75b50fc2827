"""License scans: phrase places, and an exact set-similarity join of text blocks with license templates.

A template stands in a text if some block of it holds at least ``CONTAINED`` of the template's distinct
words. Blocks are runs of twice the template's words. With ``every_start`` one starts at every word;
without, one starts every template length, which finds every run of the template's length but misses
some longer ones. Template words are ordered by their document frequency over the whole corpus, rarest first. A text can only match if it has one of the first
|T| - need + 1 of them (prefix filter), so frequent words open nothing; a block must be long enough
(length filter) and the words from its first template word on must suffice (positional filter). Of
starts at every word, a run of three template lengths holds those of one template length; only runs that
pass the same filters are walked, at their template words.

Only DataFrame and SQL functions run on the rows.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyvein.session import Scratch

#: Fixed by the contract: phrases and their labels, and what a word is (after A-Z became a-z).
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: What stands between words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Opening statements of well-known licenses.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit-notice", "Released under the MIT License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
)
CONTAINED = 0.85
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> Column:
    return F.expr(f"array_remove(split({text}, r'{BETWEEN}'), '')")


def _lower(text: Column) -> Column:
    """A-Z as a-z. Other letters may change too, as they are in no phrase or template; the two that would
    become ASCII letters are kept from it."""
    return F.lower(F.replace(F.replace(text, F.lit("\u212a"), F.lit("\u0138")), F.lit("\u0130"), F.lit("\u0131")))


def _own_words(text: str) -> list[str]:
    return re.findall(r"[0-9a-z]+", text.lower())


def _places(words: str, phrase: str) -> Column:
    """Starts of a phrase in an array of words; only arrays that hold all its words are walked."""
    own = phrase.split()
    here = " AND ".join(f"{words}[i + {j}] = '{w}'" for j, w in enumerate(own))
    there = " AND ".join([f"size({words}) >= {len(own)}", *(f"array_contains({words}, '{w}')" for w in dict.fromkeys(own))])
    return F.expr(f"CASE WHEN {there} THEN filter(sequence(0, size({words}) - {len(own)}), i -> {here}) ELSE cast(array() as array<int>) END")


def license_report(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, templates=TEMPLATES, contained: float = CONTAINED,
    every_start: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: n_words, the places of phrases, and the labels of phrases and templates.

    Columns: id_col, n_words, n_base, first_word, last_word, base_labels, labels, score. ``score`` is 1
    where a phrase stands, else the largest share of a template found in a block if it reaches
    ``contained``, else 0. Null and empty texts have no words and no labels. Repeated rows give equal
    rows, null ids included. ``every_start`` looks at the blocks from every word on, so that words put
    before a statement change nothing. Other columns are not looked at. Templates are a list in the program, not
    a table: what is broadcast is as long as they are.
    """
    scratch = Scratch(docs.sparkSession, "licenses")
    # |T| counts distinct words; the width of a block follows the words as written.
    plain = [(label, len(_own_words(text)), sorted(set(_own_words(text)))) for label, text in templates]
    tokens = sorted({w for _, _, own in plain for w in own})
    listed = F.array(*map(F.lit, tokens)) if tokens else F.expr("cast(array() as array<string>)")
    text = _lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    texts = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("text_hash", F.xxhash64("text"))
    found = texts.withColumn("words", _words("text")).select(
        "id", "text_hash", F.size("words").cast("long").alias("n_words"),
        F.array(*(F.struct(F.lit(label).alias("label"), _places("words", p).alias("starts")) for p, label in phrases)).alias("phrases"),
        F.array_intersect("words", listed).alias("present"),
    )
    found = scratch.write(found, "found")
    seen = dict(found.select(F.explode("present").alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect())  # a row per template word
    index = []
    for label, width, own in plain:
        need = max(1, math.ceil(contained * len(own)))
        ordered = sorted(own, key=lambda w: (seen.get(w, 0), w))
        index += [(ordered[i], label, width, need, ordered) for i in range(len(own) - need + 1)]
    spark = docs.sparkSession
    prefixes = spark.createDataFrame(index, "w string, label string, width int, need int, tokens array<string>")
    # Texts that hold enough of a template's words anywhere; the first words of its order lead to it.
    leads = found.select("id", "text_hash", "present", F.explode("present").alias("w")).join(F.broadcast(prefixes), "w")
    leads = leads.where(F.size(F.array_intersect("present", "tokens")) >= F.col("need"))
    leads = scratch.write(leads.select("id", "text_hash", "label", "width", "need", "tokens").distinct(), "leads")
    rare = sorted({w for w, *_ in index})
    some = F.lit(False)
    for w in rare:
        some = some | F.col("text").contains(w)
    blocks = (
        texts.where(some).alias("t").join(leads.alias("l"), F.col("t.id").eqNullSafe(F.col("l.id")) & (F.col("t.text_hash") == F.col("l.text_hash")))
        .select("l.id", "l.text_hash", "label", "width", "need", "tokens", _words("text").alias("words"))
        .withColumn("block", F.explode(F.expr(f"transform(sequence(0, size(words) - 1, width), i -> slice(words, i + 1, {3 if every_start else 2} * width))")))
    )
    first = F.expr("filter(sequence(0, size(tokens) - 1), i -> array_contains(block, tokens[i]))")
    blocks = blocks.where(F.size("block") >= F.col("need")).withColumn("at", F.get(first, F.lit(0)))
    blocks = blocks.where(F.size("tokens") - F.col("at") >= F.col("need")).withColumn("common", F.size(F.array_intersect("block", "tokens")))
    if every_start:
        # A block that starts at another word holds no more than the one from its first template word on.
        here = "filter(sequence(0, least(width, size(block)) - 1), i -> array_contains(tokens, block[i]))"
        most = F.expr(f"array_max(transform({here}, i -> size(array_intersect(slice(block, i + 1, 2 * width), tokens))))")
        blocks = blocks.where("common >= need").withColumn("common", most)
    hits = blocks.where("common >= need").groupBy("id", "text_hash").agg(
        F.collect_set("label").alias("more"), F.max(F.col("common") / F.size("tokens")).alias("share")
    )
    starts = F.flatten(F.transform("phrases", lambda p: p["starts"]))
    base = F.array_sort(F.array_distinct(F.transform(F.filter("phrases", lambda p: F.size(p["starts"]) > 0), lambda p: p["label"])))
    joined = found.alias("f").join(scratch.write(hits, "hits").alias("h"), F.col("f.id").eqNullSafe(F.col("h.id")) & (F.col("f.text_hash") == F.col("h.text_hash")), "left")
    more = F.coalesce(F.col("more"), F.expr("cast(array() as array<string>)"))
    return joined.select(
        F.col("f.id").alias(id_col), "n_words", F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(F.array_sort(F.array_union(base, more)), ",").alias("labels"),
        F.when(F.size(starts) > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def _sql() -> str:
    """The same rows in DuckDB, every template against every block of every text."""
    def places(phrase: str) -> str:
        here = " AND ".join(f"words[i + {j + 1}] = '{w}'" for j, w in enumerate(phrase.split()))
        return f"list_filter(range(0, len(words) - {len(phrase.split()) - 1}), lambda i: {here})"

    listed = ", ".join(f"({places(p)})" for p, _ in PHRASES)
    base = ", ".join(f"CASE WHEN len({places(p)}) > 0 THEN '{label}' END" for p, label in PHRASES)
    values = []
    for label, text in TEMPLATES:
        own = sorted(set(_own_words(text)))
        need = max(1, math.ceil(CONTAINED * len(own)))
        values.append(f"('{label}', {len(_own_words(text))}, {need}, {own})")
    return f"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{WORD}') AS words FROM documents
), p AS (
  SELECT doc_id, words, flatten([{listed}]) AS starts, list_filter([{base}], lambda x: x IS NOT NULL) AS base FROM w
), t(label, width, need, tokens) AS (VALUES {', '.join(values)}),
b AS (
  SELECT doc_id, label, need, tokens, unnest(list_transform(range(0, len(words), width), lambda i: words[i + 1 : i + 2 * width])) AS block
  FROM p, t WHERE len(list_intersect(words, tokens)) >= need
), h AS (
  SELECT doc_id, list(DISTINCT label) AS more, max(len(list_intersect(block, tokens)) / len(tokens)) AS share
  FROM b WHERE len(list_intersect(block, tokens)) >= need GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(starts) AS BIGINT) AS n_base,
  CAST(list_min(starts) AS BIGINT) AS first_word, CAST(list_max(starts) AS BIGINT) AS last_word,
  array_to_string(list_sort(list_distinct(base)), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(base, coalesce(more, [])))), ',') AS labels,
  CASE WHEN len(starts) > 0 THEN CAST(1 AS DOUBLE) ELSE coalesce(share, CAST(0 AS DOUBLE)) END AS score
FROM p LEFT JOIN h USING (doc_id)"""


LICENSE_SQL = _sql()
