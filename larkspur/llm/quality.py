"""Operator 7: quality rules by distribution divergence.

A document's histogram over character classes and its histogram over the common words of its
language are compared with that language's reference histograms by Jensen-Shannon distance. The
references are means over a bounded sample of rows labelled good. Only built-in functions run.

Defined results: a null text is the empty text; a document whose lang is null or has no reference,
or that is shorter than a guard, gets no verdict from that histogram and is kept unless the base
rules fail it. Rows are judged one by one, so repeated rows, ties and further columns change
nothing; a column of the input that is called like one made here is not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm.common import spread, table

#: Frequent words of four languages.
COMMON_WORDS = {
    "en": "the of and to in a is that it for was on are as with this be by from or an at",
    "fr": "le de la et les des en un du une que est pour qui dans par sur pas au elle ou aux",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch an",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como",
}
#: Character classes that are counted by splitting; further ones are white space, bytes beyond the first of each UTF-8 character, and the rest. Digits are in none: numbers say nothing of a text's language.
CLASSES = {"upper": "[A-Z]", "stop": "[.,]", "mark": "[#*$%&|<>!]"}
DIGITS = "[0-9]"
SPACE = "[\\x20\\x09-\\x0D]+"
#: At most so many rows labelled good are used for the references.
FIT_ROWS = 2000
MIN_CHARS, MIN_WORDS = 100, 40
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.18, 0.45


def _shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.transform(counts, lambda x: x / F.greatest(total, F.lit(1.0)))


def _count(pattern: str) -> Column:
    return F.size(F.split("_text", pattern)) - 1


def histograms(docs: DataFrame) -> DataFrame:
    """docs(text, lang, ...) plus char_hist and word_hist (arrays of shares; word_hist is null without a word list) and words."""
    hits, n_hits = F.lit(None).cast("array<string>"), F.lit(None).cast("array<int>")
    for lang, words in COMMON_WORDS.items():
        found = F.regexp_extract_all(F.lower("_text"), F.lit(f"(?<![^\\x20\\x09-\\x0D])(?:{'|'.join(words.split())})(?=[.,;:!?\\x20\\x09-\\x0D]|\\z)"), F.lit(0))
        hits = F.when(F.col("lang") == lang, found).otherwise(hits)
        n_hits = F.when(F.col("lang") == lang, F.array(*(F.size("_hits") - F.size(F.array_remove("_hits", w)) for w in words.split()))).otherwise(n_hits)
    df = docs.withColumn("_text", F.coalesce("text", F.lit("")))
    df = df.withColumns({"words": F.array_remove(F.split("_text", SPACE), ""), "_hits": hits})
    length, solid = F.char_length("_text"), F.char_length(F.array_join("words", ""))
    df = df.withColumns({n: x.cast("double") for n, x in {"_space": length - solid, "_wide": F.octet_length("_text") - length, "_rest": solid - _count(DIGITS), **{f"_{n}": _count(p) for n, p in CLASSES.items()}}.items()})
    named = [f"_{n}" for n in CLASSES]
    df = df.withColumn("_rest", F.greatest(F.col("_rest") - sum(map(F.col, named), F.lit(0.0)), F.lit(0.0)))
    df = df.withColumns({"_counts": F.array("_rest", "_space", "_wide", *named), "_word_counts": F.transform(F.concat(n_hits, F.array(F.size("words") - F.size("_hits"))), lambda x: x.cast("double"))})
    return df.withColumns({"char_hist": _shares(F.col("_counts")), "word_hist": _shares(F.col("_word_counts"))}).drop("_hits", "_counts", "_word_counts", "_rest", "_space", "_wide", *named)


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance in bits (0 to 1) of two arrays of shares."""

    def term(a: Column, b: Column) -> Column:
        part = lambda x: F.when(x > 0, x * F.log2(2 * x / (a + b))).otherwise(F.lit(0.0))
        return (part(a) + part(b)) / 2

    return F.sqrt(F.greatest(F.aggregate(F.zip_with(p, q, term), F.lit(0.0), lambda s, x: s + x), F.lit(0.0)))


def fit_references(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(lang, char_ref, word_ref), a row for each language of COMMON_WORDS that has labelled rows: the means of the histograms of the fit_rows good rows of smallest doc_id."""
    good = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct().orderBy("doc_id").limit(fit_rows)
    used = docs.select("doc_id", "text", "lang").join(F.broadcast(good), "doc_id", "left_semi").where(F.col("lang").isin(*COMMON_WORDS))
    rows = histograms(used.repartition(docs.sparkSession.sparkContext.defaultParallelism))  # the few rows lie close together
    rows = rows.where((F.char_length("_text") >= MIN_CHARS) & (F.size("words") >= MIN_WORDS))
    sizes = {"char": len(CLASSES) + 3, "word": 1 + max(len(w.split()) for w in COMMON_WORDS.values())}
    means = {k: F.filter(F.array(*(F.avg(F.get(f"{k}_hist", F.lit(i))) for i in range(n))), lambda x: x.isNotNull()).alias(f"{k}_ref") for k, n in sizes.items()}
    return rows.groupBy("lang").agg(*means.values())


def with_signals(docs: DataFrame, references: DataFrame) -> DataFrame:
    """docs plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, char_distance, word_distance and kept."""
    held = ["words", "char_hist", "word_hist", "_text", "_lang", "char_ref", "word_ref", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "char_distance", "word_distance", "kept"]
    df = histograms(docs.drop(*held))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    df = df.withColumns({"n_words": F.size("words").cast("long"), "_lines": lines, "_h": F.transform("words", lambda w: F.xxhash64(w))})
    for step in (1, 2, 4):  # afterwards _h[i] stands for words i to i + 7
        m = F.size("_h") - step
        df = df.withColumn("_h", F.when(m > 0, F.zip_with(F.slice("_h", 1, F.greatest(m, F.lit(0))), F.slice("_h", 1 + step, F.greatest(m, F.lit(0))), lambda a, b: F.xxhash64(a, b))).otherwise(F.array().cast("array<bigint>")))
    again = F.size(F.array_distinct("_h")) < F.size("_h")
    df = df.withColumn("_s", F.when(again, F.sort_array(F.transform("_h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    m = F.size("_s") - 1
    twins = F.flatten(F.zip_with(F.slice("_s", 1, m), F.slice("_s", 2, m), lambda a, b: F.when(a.h == b.h, F.array(a.i, b.i)).otherwise(F.array().cast("array<int>"))))
    df = df.withColumn("_at", F.when(F.col("_s").isNotNull(), F.sort_array(F.array_distinct(twins))))
    covered = F.aggregate("_at", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")), lambda a, i: F.struct((a.n + i + 8 - F.greatest(a.end, i)).cast("long").alias("n"), (i + 8).alias("end")), lambda a: a.n)
    df = df.withColumns({
        "word_chars": F.char_length(F.array_join("words", "")).cast("long"),
        "n_symbols": (F.size(F.split("_text", "[#*$%&|<>]")) - 1).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0).cast("long")),
    })
    df = df.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
    df = df.join(F.broadcast(references.withColumnRenamed("lang", "_lang")), F.col("lang") == F.col("_lang"), "left")
    df = df.withColumns({
        "char_distance": F.when(F.char_length("_text") >= MIN_CHARS, js_distance(F.col("char_hist"), F.col("char_ref"))),
        "word_distance": F.when(F.col("n_words") >= MIN_WORDS, js_distance(F.col("word_hist"), F.col("word_ref"))),
    })
    far = (F.coalesce("char_distance", F.lit(0.0)) > MAX_CHAR_DISTANCE) | (F.coalesce("word_distance", F.lit(0.0)) > MAX_WORD_DISTANCE)
    return df.withColumn("kept", ~F.col("base_failed") & ~far).drop("words", "char_hist", "word_hist", "_text", "_lines", "_h", "_s", "_at", "_lang", "char_ref", "word_ref")


def passing(docs: DataFrame, references: DataFrame) -> DataFrame:
    """The rows of docs that are kept. A generator takes the verdict: as a filter it would be pushed below the projections, each of whose expressions it would hold several times."""
    judged = with_signals(docs, references)
    return judged.select(*docs.columns, F.explode(F.when(F.col("kept"), F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>"))).alias("_kept")).select(*docs.columns)


def op7_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = with_signals(spread(docs.select("doc_id", "text", "lang")), fit_references(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_LISTS = ", ".join(f"('{lang}', {words.split()!r})" for lang, words in COMMON_WORDS.items())
_JS = "sqrt(greatest(list_sum(list_transform(range(1, len({p}) + 1), lambda i: (CASE WHEN {p}[i] > 0 THEN {p}[i] * log2(2 * {p}[i] / ({p}[i] + {q}[i])) ELSE 0 END + CASE WHEN {q}[i] > 0 THEN {q}[i] * log2(2 * {q}[i] / ({p}[i] + {q}[i])) ELSE 0 END) / 2)), 0))"
#: DuckDB SQL for the query: the same rules, with repeated windows found by grouping.
OP7_SQL = rf"""
WITH common(lang, list) AS (VALUES {_LISTS}),
d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
c AS (SELECT w.*, len(words) AS n, length(array_to_string(words, '')) AS solid, length(text) AS chars, list,
    list_transform(words, lambda x: regexp_extract(lower(x), '^[^.,;:!?]*')) AS plain,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS upper, length(regexp_replace(text, '[^.,]', '', 'g')) AS stop, length(regexp_replace(text, '[^#*$%&|<>!]', '', 'g')) AS mark, length(regexp_replace(text, '[^0-9]', '', 'g')) AS digits
  FROM w LEFT JOIN common ON w.lang = common.lang),
k AS (SELECT *, [greatest(solid - digits - upper - stop - mark, 0), chars - solid, octet_length(encode(text)) - chars, upper, stop, mark] AS cc,
    list_transform(list, lambda x: len(list_filter(plain, lambda y: y = x))) AS hits FROM c),
h AS (SELECT *, list_transform(cc, lambda x: x / greatest(list_sum(cc), 1)) AS ch, list_transform(list_append(hits, n - list_sum(hits)), lambda x: x / greatest(n, 1)) AS wh FROM k),
good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL ORDER BY doc_id LIMIT {FIT_ROWS}),
g AS (SELECT * FROM h WHERE doc_id IN (SELECT doc_id FROM good) AND list IS NOT NULL AND chars >= {MIN_CHARS} AND n >= {MIN_WORDS}),
cr AS (SELECT lang, list(m ORDER BY i) AS ref FROM (SELECT lang, i, avg(v) AS m FROM (SELECT lang, unnest(ch) AS v, generate_subscripts(ch, 1) AS i FROM g) GROUP BY lang, i) GROUP BY lang),
wr AS (SELECT lang, list(m ORDER BY i) AS ref FROM (SELECT lang, i, avg(v) AS m FROM (SELECT lang, unnest(wh) AS v, generate_subscripts(wh, 1) AS i FROM g) GROUP BY lang, i) GROUP BY lang),
win AS (SELECT r, i, array_to_string(words[i:i + 7], ' ') AS s FROM (SELECT r, words, unnest(range(1, n - 6)) AS i FROM w JOIN (SELECT r AS r2, len(words) AS n FROM w) ON r = r2)),
rep AS (SELECT r, count(DISTINCT p) AS covered FROM (SELECT win.r, unnest(range(i, i + 8)) AS p FROM win JOIN (SELECT r, s FROM win GROUP BY r, s HAVING count(*) > 1) AS t ON win.r = t.r AND win.s = t.s) GROUP BY r),
f AS (SELECT h.*, coalesce(covered, 0) AS covered, {_JS.format(p="ch", q="cr.ref")} AS cd, {_JS.format(p="wh", q="wr.ref")} AS wd FROM h LEFT JOIN rep ON h.r = rep.r LEFT JOIN cr ON h.lang = cr.lang LEFT JOIN wr ON h.lang = wr.lang),
b AS (SELECT *, n < 20 OR 100 * covered > 30 * n AS base_failed FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(solid AS BIGINT) AS word_chars, CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(covered AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND NOT (CASE WHEN chars >= {MIN_CHARS} THEN coalesce(cd, 0) ELSE 0 END > {MAX_CHAR_DISTANCE} OR CASE WHEN n >= {MIN_WORDS} THEN coalesce(wd, 0) ELSE 0 END > {MAX_WORD_DISTANCE}) AS kept
FROM b
"""
