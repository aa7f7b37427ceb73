"""Operator 3: licence scans by diagonal voting.

Hashes of all rolling word K-grams of the documents are joined with those of the templates. A match votes
for the diagonal (word place in the text less word place in the template) on which it lies. Words put in or left out move a copy to a neighbouring
diagonal, so the diagonals of a longer template are merged in strips as wide as half of the template, in two rows of strips of which one is moved by half a strip: diagonals
that are a quarter of the template apart, or less, always lie in one strip together. A strip is verified by the share of the template's DIFFERENT grams that
it holds: a phrase that is repeated counts once. A strip spans one and a half templates at most, so what it holds stands close together and nearly in order. Templates of up to SHORT words must be held
whole, on one diagonal. Only built-in functions run.

The fixed templates, and further ones up to BROADCAST_GRAMS grams in all, are broadcast; more are joined by a shuffle.

Defined results: a null text is the empty text: no words, no labels (empty strings), null first_word and
last_word, score 0. Every row is scanned by itself, whatever its doc_id. Further columns are not read. Further templates without a text, or of fewer than K words, match nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm.common import spread, table

K, SHORT, COVERED, BROADCAST_GRAMS = 3, 8, 0.6, 200_000
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: The base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Well-known licence names and notices, and their labels.
NOTICES = [
    ("gpl-3", "GNU General Public License, version 3"),
    ("gpl-2", "GNU General Public License, version 2"),
    ("lgpl-3", "GNU Lesser General Public License, version 3"),
    ("agpl-3", "GNU Affero General Public License, version 3"),
    ("mpl-2", "Mozilla Public License, version 2.0"),
    ("cc-by-sa", "CC BY-SA 4.0"),
    ("cc-by-nc-nd", "CC BY-NC-ND"),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial"),
    ("cc0", "CC0 1.0 Universal"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache-2", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied'),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]


def words_of(text: Column) -> Column:
    """Words with A-Z in lower case. lower() also changes letters beyond ASCII, which leaves the words' number and places as they are and makes none equal to a word of ASCII; but for the Kelvin sign, which is put aside first."""
    return F.array_remove(F.split(F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("Å"))), SEPARATORS), "")


def grams(words: str) -> Column:
    """Hashes of the rolling K-grams of an array column of words."""
    from_ = lambda c, skip, n: F.slice(c, 1 + skip, F.greatest(n, F.lit(0)))
    hashes, size = F.transform(words, lambda w: F.xxhash64(w)), F.size(words)
    out = hashes
    for k in range(1, K):
        out = F.zip_with(from_(out, 0, size - k), from_(hashes, k, size - k), lambda a, b: F.xxhash64(a, b))
    return F.when(size >= K, out).otherwise(F.array().cast("array<bigint>"))


def templates(spark: SparkSession, more: DataFrame | None = None) -> DataFrame:
    """A row for each gram of each template: t, label, base, n (different grams), words, tpos, gram; and one of t = -1 that every document has. more(label, text) are further templates."""
    listed = [(label, phrase, True) for phrase, label in BASE.items()] + [(label, text, False) for label, text in NOTICES]
    rows = F.array(*(F.struct(F.lit(t).cast("long").alias("t"), F.lit(x[0]).alias("label"), F.lit(x[1]).alias("text"), F.lit(x[2]).alias("base")) for t, x in enumerate(listed)))
    df = spark.range(1).select(F.inline(rows))
    if more is not None:
        df = df.unionByName(more.select((F.monotonically_increasing_id() + len(listed)).alias("t"), "label", "text", F.lit(False).alias("base")))
    df = df.withColumn("w", words_of(F.col("text"))).withColumn("g", grams("w"))
    df = df.select("t", "label", "base", F.when(F.size("w") <= SHORT, F.size("g")).otherwise(F.size(F.array_distinct("g"))).alias("n"), F.size("w").alias("words"), F.posexplode("g").alias("tpos", "gram"))
    return df.unionByName(spark.range(1).select(F.lit(-1).cast("long").alias("t"), F.lit(None).cast("string").alias("label"), F.lit(False).alias("base"), F.lit(1).alias("n"), F.lit(0).alias("words"), F.lit(-1).alias("tpos"), F.lit(0).cast("long").alias("gram")))


def votes(docs: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """row, doc_id, n_words, t, label, base, n, words, row_of and strip (of diagonals), held (different grams, of short templates places) and lo (word place of the first match). Every row of docs has one of t = -1."""
    df = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words_of(F.col("text")).alias("w"))
    df = df.select("row", "doc_id", F.size("w").cast("long").alias("n_words"), F.concat(F.array(F.lit(0).cast("long")), grams("w")).alias("g"))
    df = df.select("row", "doc_id", "n_words", F.posexplode("g").alias("at", "gram"))
    known = templates(docs.sparkSession, more)
    df = df.join(F.broadcast(known) if more is None or known.count() <= BROADCAST_GRAMS else known, "gram").where("t >= 0 or at = 0")
    diagonal, half = F.col("at") - 1 - F.col("tpos"), F.greatest(F.floor(F.col("words") / 4), F.lit(1))
    strip = lambda k, x: F.struct(F.lit(k).alias("row_of"), x.cast("long").alias("strip"))
    strips = F.when(F.col("words") <= SHORT, F.array(strip(0, diagonal))).otherwise(F.array(strip(0, F.floor(diagonal / (2 * half))), strip(1, F.floor((diagonal + half) / (2 * half)))))
    keys = ["row", "doc_id", "n_words", "t", "label", "base", "n", "words"]
    item = F.when(F.col("words") <= SHORT, F.col("tpos").cast("long")).otherwise(F.col("gram"))
    df = df.select(*keys, item.alias("item"), (F.col("at") - 1).alias("place"), F.inline(strips))
    return df.groupBy(*keys, "row_of", "strip").agg(F.size(F.collect_set("item")).alias("held"), F.min("place").alias("lo"))


def scan(docs: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """A row for each row of docs(doc_id, text), with the base places and the labels of all verified strips. more(label, text) are further templates."""
    df = votes(docs, more).withColumn("covered", F.when(F.col("t") < 0, 0.0).otherwise(F.col("held") / F.col("n")))
    verified = (F.col("t") >= 0) & (F.col("covered") >= F.when(F.col("words") > SHORT, F.lit(COVERED)).otherwise(F.lit(1.0)))
    base = F.col("base") & verified
    joined = lambda c: F.array_join(F.sort_array(F.collect_set(F.when(c, F.col("label")))), ",")
    return df.groupBy("row", "doc_id", "n_words").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("lo"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("lo"))).cast("long").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(verified).alias("labels"),
        F.max("covered").alias("score"),
    ).drop("row")


def op3_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_VALUES = ", ".join(f"({t}, {_quoted(label)}, {_quoted(text)}, {base})" for t, (label, text, base) in enumerate([(b, a, "true") for a, b in BASE.items()] + [(b, a, "false") for b, a in NOTICES]))
_WORDS = r"list_filter(regexp_split_to_array(lower(replace({}, 'K', 'Å')), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
#: DuckDB SQL for the query: grams are compared as text.
OP3_SQL = f"""
WITH listed(t, label, text, base) AS (VALUES {_VALUES}),
tw AS (SELECT *, {_WORDS.format("text")} AS w FROM listed),
tk AS (SELECT t, label, base, len(w) AS words, i AS tpos, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT *, unnest(range(1, len(w) - 1)) AS i FROM tw)),
tg AS (SELECT *, count(DISTINCT (a, b, c)) OVER (PARTITION BY t) AS n FROM tk),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
g AS (SELECT r, i AS pos, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT *, unnest(range(1, len(w) - 1)) AS i FROM d)),
h AS (SELECT r, t, label, base, words, n, pos, pos - tpos AS diagonal, greatest(words // 4, 1) AS half, (a, b, c) AS gram FROM g JOIN tg USING (a, b, c)),
v AS (SELECT r, t, label, base, words, n, pos, gram, 0 AS row_of, CASE WHEN words <= {SHORT} THEN diagonal ELSE floor(diagonal / (2 * half)) END AS strip FROM h
    UNION ALL SELECT r, t, label, base, words, n, pos, gram, 1, floor((diagonal + half) / (2 * half)) FROM h WHERE words > {SHORT}),
x AS (SELECT r, label, base, words, count(DISTINCT gram) / n AS covered, min(pos) - 1 AS lo FROM v GROUP BY r, t, label, base, words, n, row_of, strip),
y AS (SELECT r, count(*) FILTER (base AND covered >= 1) AS n_base, min(lo) FILTER (base AND covered >= 1) AS first_word, max(lo) FILTER (base AND covered >= 1) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base AND covered >= 1) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (covered >= CASE WHEN words > {SHORT} THEN {COVERED} ELSE 1 END) AS labels, max(covered) AS score FROM x GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN y USING (r)
"""
