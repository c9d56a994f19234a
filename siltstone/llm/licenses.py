"""License scans by diagonal voting, with DataFrame operations only.

Text and templates are lower-cased runs of ASCII letters, digits and other characters. Every rolling run
of ``GRAM`` words is hashed and joined to the template places with that hash (the templates are fixed, so
their side has a fixed size and is broadcast). A hit votes for the diagonal word - template word. Votes
are counted per document, template and diagonal; neighbouring diagonals (at most ``DRIFT`` words apart,
from inserted or lost words) are merged, and a span stands if its words equal the template's at a share
of at least ``LEAST`` of its runs within ``STRETCH`` times its length. Hits carry their words, so a hash
alone decides nothing.

Base phrases are templates as well; a place counts if one diagonal has every run of it.

Defined cases: null and empty texts have no words and no labels. Rows are told apart by id and text;
repeated rows get the same result each, rows without id too. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GRAM, DRIFT, LEAST, STRETCH = 3, 2, 0.6, 1.5

# Phrases of the base scan, with their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
# Well-known wording of license notices, with labels.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
]

#: Characters between words; capital letters are folded first.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text):
    folded = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.split(F.trim(F.regexp_replace(folded, BREAKS, " ")), " ")


def _template_places(spark: SparkSession) -> DataFrame:
    """template, label, base, runs, place, gram (words), key: one row per run of every template."""
    rows, number = [], 0
    for base, pairs in ((True, [(v, k) for k, v in PHRASES.items()]), (False, TEMPLATES)):
        for label, phrase in pairs:
            words = phrase.split()
            n = len(words) - GRAM + 1
            rows += [(number, label, base, n, p, words[p:p + GRAM]) for p in range(n)]
            number += 1
    places = spark.createDataFrame(rows, "template int, label string, base boolean, runs int, place int, gram array<string>")
    return places.withColumn("key", F.xxhash64(*(F.col("gram")[j] for j in range(GRAM))))


def license_scan(documents: DataFrame) -> DataFrame:
    """Per row of ``documents`` (doc_id, text): doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    spark = documents.sparkSession
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("digest"), _words(F.col("text")).alias("words"))
    rows = source.select("doc_id", "digest", F.when(F.element_at("words", 1) == "", 0).otherwise(F.size("words")).cast("long").alias("n_words"))
    gram = ", ".join(f"words[i + {j}]" for j in range(GRAM))
    keys = F.expr(f"CASE WHEN size(words) >= {GRAM} THEN transform(sequence(0, size(words) - {GRAM}), i -> xxhash64({gram})) ELSE array() END")
    hits = source.filter(F.size("words") >= GRAM).select("doc_id", "digest", "words", F.posexplode(keys).alias("at", "key"))
    hits = hits.join(F.broadcast(_template_places(spark)), "key").filter(F.expr(f"slice(words, at + 1, {GRAM}) = gram"))
    place = ["doc_id", "digest", "template", "label", "base", "runs"]
    votes = hits.groupBy(*place, (F.col("at") - F.col("place")).alias("diagonal")).agg(
        F.min("at").alias("low"), F.max("at").alias("high"), F.collect_set("place").alias("places"))

    # Neighbouring diagonals that are close in the text make one span; a base phrase needs one whole diagonal.
    order = Window.partitionBy("doc_id", "digest", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > DRIFT, F.lit(True))
    merged = votes.withColumn("new", F.when(F.col("base"), True).otherwise(apart).cast("int")).withColumn("span", F.sum("new").over(order))
    spans = merged.groupBy(*place, "span").agg(
        F.min("low").alias("first"), F.max("high").alias("last"), F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("hit"))
    spans = spans.withColumn("share", F.col("hit") / F.col("runs"))
    verified = F.when(F.col("base"), F.col("hit") == F.col("runs")).otherwise(
        (F.col("share") >= LEAST) & (F.col("last") - F.col("first") + GRAM <= STRETCH * (F.col("runs") + GRAM - 1)))
    spans = spans.filter(verified)
    base_first = F.when(F.col("base"), F.col("first"))
    found = spans.groupBy("doc_id", "digest").agg(
        F.count(base_first).alias("n_base"), F.min(base_first).cast("long").alias("first_word"), F.max(base_first).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"), F.max("share").alias("score"))
    found = found.withColumnsRenamed({"doc_id": "id", "digest": "own"})
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("own")), "left")
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))


def _oracle() -> str:
    rows, number = [], 0
    for base, pairs in ((True, [(v, k) for k, v in PHRASES.items()]), (False, TEMPLATES)):
        for label, phrase in pairs:
            words = phrase.split()
            n = len(words) - GRAM + 1
            rows += [f"({number}, '{label}', {base}, {n}, {p}, '{' '.join(words[p:p + GRAM])}')" for p in range(n)]
            number += 1
    folded = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
    return rf"""
WITH places(template, label, base, runs, place, gram) AS (VALUES {", ".join(rows)}),
docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({folded}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
grams AS (SELECT r, unnest(range(greatest(len(w) - {GRAM - 1}, 0))) AS pos, w FROM docs),
hits AS (SELECT r, pos, p.* FROM (SELECT r, pos, {" || ' ' || ".join(f"w[pos + {j + 1}]" for j in range(GRAM))} AS gram FROM grams) JOIN places p USING (gram)),
votes AS (SELECT r, template, label, base, runs, pos - place AS diagonal, min(pos) AS low, max(pos) AS high, list(DISTINCT place) AS places FROM hits GROUP BY ALL),
apart AS (SELECT *, CASE WHEN base THEN 1 WHEN diagonal - lag(diagonal) OVER o <= {DRIFT} THEN 0 ELSE 1 END AS new FROM votes WINDOW o AS (PARTITION BY r, template ORDER BY diagonal)),
merged AS (SELECT *, sum(new) OVER (PARTITION BY r, template ORDER BY diagonal) AS span FROM apart),
spans AS (SELECT r, template, label, base, runs, span, min(low) AS first, max(high) AS last, len(list_distinct(flatten(list(places)))) AS hit FROM merged GROUP BY ALL),
kept AS (SELECT *, hit / runs AS share FROM spans WHERE CASE WHEN base THEN hit = runs ELSE hit / runs >= {LEAST} AND last - first + {GRAM} <= {STRETCH} * (runs + {GRAM - 1}) END),
found AS (SELECT r, count(first) FILTER (base) AS n_base, min(first) FILTER (base) AS first_word, max(first) FILTER (base) AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM kept GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM docs LEFT JOIN found USING (r)"""


ORACLE = _oracle()
