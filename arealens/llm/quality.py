"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Fixed rules reject what is hardly text. Beyond them, each measure of a document is compared with the
documents of its own language and source: a sketch of the measure gives its quartiles, and a value
farther outside them than ``reach`` times their distance, and than the measure's slack, is rejected.

A sketch is a table of counts per bucket. Values are whole thousandths; a bucket keeps their first
six binary digits, so a quantile is at most one part in 32 too low. Two sketches merge by adding the
counts of equal buckets, in any order: a group of any size is counted where it lies and only its few
buckets are shuffled.

Everything is an expression of built-in functions; rows never leave the JVM.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch, pick

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\f\r"

# Measure -> numerator, denominator, and how far outside the quartiles a value may always be (thousandths).
MEASURES = {
    "word_length": ("word_chars", "n_words", 3000),
    "symbols": ("n_symbols", "n_words", 150),
    "dup_lines": ("n_dup_lines", "n_lines", 350),
    "repeats": ("n_repeat_words", "n_words", 250),
}


def _without(text: str, characters: str) -> str:
    for c in characters:
        text = f"replace({text}, '{c}', '')"
    return text


def features(docs: DataFrame) -> DataFrame:
    """``docs`` (with a column ``text``) and n_words, n_lines, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    A null text counts as empty. Three-word windows are compared by 64-bit hashes within one text.
    """
    text = docs.withColumn("_text", F.coalesce(docs["text"], F.lit("")))
    blank = "_text"
    for c in WHITE[1:]:
        blank = f"replace({blank}, '{c}', ' ')"
    split = text.select(
        "*",
        F.expr(f"array_remove(split({blank}, ' ', -1), '')").alias("_words"),
        F.expr(f"filter(split(_text, '\n', -1), l -> trim(both '{WHITE}' from l) <> '')").alias("_lines"),
        F.expr(f"length({_without('_text', WHITE)})").alias("_chars"),
        F.expr(f"length(_text) - length({_without('_text', SYMBOLS)})").alias("_symbols"),
    )
    windows = split.select(
        "*",
        F.expr(
            "transform(slice(_words, 1, greatest(size(_words) - 2, 0)),"
            " (w, i) -> xxhash64(w, get(_words, i + 1), get(_words, i + 2)))"
        ).alias("_windows"),
    )
    # Most texts repeat no window; only the others are sorted.
    ordered = windows.select(
        "*",
        F.expr(
            "case when size(array_distinct(_windows)) < size(_windows)"
            " then sort_array(transform(_windows, (h, i) -> struct(h as h, i as i))) end"
        ).alias("_ordered"),
    )
    starts = ordered.select(
        "*",
        F.expr(
            "sort_array(transform(filter(_ordered, (x, j) -> x.h <=> get(_ordered, j - 1).h or x.h <=> get(_ordered, j + 1).h),"
            " x -> x.i))"
        ).alias("_starts"),
    )
    # A window covers three words, or as many as there are to the next repeated window.
    covered = "transform(_starts, (s, k) -> least(3, coalesce(get(_starts, k + 1) - s, 3)))"
    own = [c for c in docs.columns]
    return starts.select(
        *own,
        F.expr("cast(size(_words) as long)").alias("n_words"),
        F.expr("cast(size(_lines) as long)").alias("n_lines"),
        F.expr("cast(_chars as long)").alias("word_chars"),
        F.expr("cast(_symbols as long)").alias("n_symbols"),
        F.expr("cast(size(_lines) - size(array_distinct(_lines)) as long)").alias("n_dup_lines"),
        F.expr(f"coalesce(aggregate({covered}, 0L, (a, x) -> a + x), 0L)").alias("n_repeat_words"),
    )


def base_failed():
    return F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): the quantile sketch of every group and measure."""
    values = F.expr(
        "explode(map("
        + ", ".join(f"'{name}', 1000 * {top} div greatest({bottom}, 1)" for name, (top, bottom, _) in MEASURES.items())
        + ")) as (measure, value)"
    )
    rows = measured.select("lang", "source", values)
    shift = "greatest(length(bin(value)) - 6, 0)"
    bucket = F.expr(f"shiftleft(shiftright(value, {shift}), {shift})")
    return rows.groupBy("lang", "source", "measure", bucket.alias("bucket")).agg(F.count("*").alias("n"))


def merged(*several: DataFrame) -> DataFrame:
    """One sketch of several, for instance of new rows and of all earlier ones."""
    whole = several[0]
    for more in several[1:]:
        whole = whole.unionByName(more)
    return whole.groupBy("lang", "source", "measure", "bucket").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, reach: int = 6) -> DataFrame:
    """(lang, source, low_<measure>, high_<measure> ...) from sketches."""
    group = "partition by lang, source, measure"
    ranked = sketch.select(
        "*",
        F.expr(f"sum(n) over ({group} order by bucket)").alias("_below"),
        F.expr(f"sum(n) over ({group})").alias("_all"),
    )
    # The quartile: the first bucket that has a quarter, or three, of all values at or below it.
    quartiles = ranked.groupBy("lang", "source", "measure").agg(
        F.expr("min(case when 4 * _below >= _all then bucket end)").alias("q1"),
        F.expr("min(case when 4 * _below >= 3 * _all then bucket end)").alias("q3"),
    )
    out = []
    for name, (_, _, slack) in MEASURES.items():
        far = f"greatest({reach} * (q3 - q1), {slack})"
        out.append(F.expr(f"max(case when measure = '{name}' then q1 - {far} end)").alias(f"low_{name}"))
        out.append(F.expr(f"max(case when measure = '{name}' then q3 + {far} end)").alias(f"high_{name}"))
    return quartiles.groupBy("lang", "source").agg(*out)


def judged(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """``measured`` rows with base_failed and kept; a null lang or source is a group of its own."""
    inside = " and ".join(
        f"1000 * {top} div greatest({bottom}, 1) between low_{name} and high_{name}"
        for name, (top, bottom, _) in MEASURES.items()
    )
    limits = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    joined = measured.join(limits, same, "left").withColumn("base_failed", base_failed())
    return joined.withColumn("kept", F.expr(f"not base_failed and ({inside})")).drop(*limits.columns)


def quality_query(docs: DataFrame, reach: int = 6) -> DataFrame:
    """doc_id, the measures, base_failed and kept of every row of (doc_id, text, lang, source)."""
    scratch = Scratch(docs.sparkSession, "quality")
    docs = pick(docs, "doc_id", "text", "lang", "source")
    measured = scratch.keep(features(docs).drop("text"), "features")
    # Only documents that pass the fixed rules say what is usual.
    limits = fences(sketches(measured.filter(~base_failed())), reach)
    return judged(measured, limits).drop("lang", "source", "n_lines")


ORACLE = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
g AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
      FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
s AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM g) WHERE c > 1),
c AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM s) GROUP BY r),
f AS (SELECT d.r, doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ls) AS BIGINT) AS n_lines,
             CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
      FROM d JOIN w USING (r) LEFT JOIN c USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
v AS (SELECT r, lang, source, base_failed, unnest(['word_length', 'symbols', 'dup_lines', 'repeats']) AS measure,
             unnest([1000 * word_chars // greatest(n_words, 1), 1000 * n_symbols // greatest(n_words, 1),
                     1000 * n_dup_lines // greatest(n_lines, 1), 1000 * n_repeat_words // greatest(n_words, 1)]) AS value
      FROM b),
k AS (SELECT lang, source, measure, bucket, count(*) AS n
      FROM (SELECT *, (value >> greatest(length(bin(value)) - 6, 0)) << greatest(length(bin(value)) - 6, 0) AS bucket
            FROM v WHERE NOT base_failed) GROUP BY ALL),
q AS (SELECT lang, source, measure, min(bucket) FILTER (4 * below >= total) AS q1,
             min(bucket) FILTER (4 * below >= 3 * total) AS q3
      FROM (SELECT *, sum(n) OVER (PARTITION BY lang, source, measure ORDER BY bucket) AS below,
                   sum(n) OVER (PARTITION BY lang, source, measure) AS total FROM k) GROUP BY ALL),
z AS (SELECT r, bool_and(value BETWEEN q1 - greatest(6 * (q3 - q1), slack) AND q3 + greatest(6 * (q3 - q1), slack)) AS ok
      FROM v JOIN (VALUES ('word_length', 3000), ('symbols', 150), ('dup_lines', 350), ('repeats', 250)) AS l(measure, slack)
      USING (measure) LEFT JOIN q ON q.measure = v.measure AND q.lang IS NOT DISTINCT FROM v.lang
                                AND q.source IS NOT DISTINCT FROM v.source GROUP BY r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND ok AS kept
FROM b JOIN z USING (r)
"""
