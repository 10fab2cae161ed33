"""Secrets by fixed patterns and by Markov models of characters.

The patterns give the base spans: values assigned to names like ``password``, access keys, and long
runs of hexadecimal digits. They also label samples: their values are random strings, ordinary words
and identifiers of the corpus are not. From both, the transitions of one character to the next are
counted. A token that mixes letters and digits is a secret when its transitions are more likely, by
the log-likelihood ratio per transition, among random strings than among ordinary identifiers.

Everything is an expression of built-in functions, joins and aggregations. A match's place in its
text is the sum of the lengths of all matches and gaps before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch, pick

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# A run below the least length can't be part of a longer one, so the lengths are part of the pattern.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
_TOKEN = "A-Za-z0-9+/_="
CANDIDATE = rf"(?<![{_TOKEN}-])(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])[{_TOKEN}-]{{16,}}"
ORDINARY = r"(?<![A-Za-z0-9_-])[A-Za-z][A-Za-z_-]{7,}(?![A-Za-z0-9_-])"
# In the order of the digest.
KINDS = ("assign", "access", "hex", "random")
ALPHABET = 65  # letters, digits and three signs, for smoothing


def _matches(docs: DataFrame, sample: int) -> DataFrame:
    """Rows with a match or of the sample: matches, values and lengths of the gaps before matches, by kind."""
    total = docs.count()
    text = F.coalesce("text", F.lit(""))
    drawn = F.pmod(F.xxhash64(text), F.lit(1 << 30)) < int(min(1.0, sample / max(total, 1)) * (1 << 30))
    found = docs.select(
        "doc_id",
        F.xxhash64(text).alias("text_id"),
        text.alias("text"),
        F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(0)).alias("assign"),
        F.when(F.contains(text, F.lit("AKIA")), F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0))).alias("access"),
        F.regexp_extract_all(text, F.lit(HEX), F.lit(0)).alias("hex"),
        F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("random"),
        F.when(drawn, F.regexp_extract_all(text, F.lit(ORDINARY), F.lit(0))).alias("ordinary"),
    )
    some = " or ".join(f"coalesce(size({kind}), 0) > 0" for kind in (*KINDS, "ordinary"))

    def gaps(kind: str, pattern: str) -> Column:
        pieces = F.transform(F.split("text", pattern, -1), F.length)
        return F.when(F.size(kind) > 0, F.slice(pieces, F.lit(1), F.size(kind))).alias(f"{kind}_gaps")

    value = F.when(F.size("assign") > 0, F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)))
    patterns = dict(zip(KINDS, (ASSIGN, ACCESS, HEX, CANDIDATE)))
    rows = found.filter(some).select(
        "doc_id", "text_id", *KINDS, "ordinary", value.alias("value"), *[gaps(k, p) for k, p in patterns.items()]
    )
    return rows.dropDuplicates(["doc_id", "text_id"])


def _spans(matches: DataFrame, kind: str) -> DataFrame:
    """(doc_id, text_id, kind, start, end, value) of one kind, in code points."""
    zipped = F.arrays_zip(
        F.col(f"{kind}_gaps").alias("gap"),
        F.col(kind).alias("match"),
        F.col("value" if kind == "assign" else kind).alias("value"),
    )
    rows = matches.select("doc_id", "text_id", F.posexplode(zipped).alias("pos", "m")).select("doc_id", "text_id", "pos", "m.*")
    end = F.expr("sum(gap + length(match)) over (partition by doc_id, text_id order by pos)")
    return rows.select(
        "doc_id", "text_id", F.lit(kind).alias("kind"), (end - F.length("match")).alias("start"), end.alias("end"), "value"
    )


def _transitions(tokens: DataFrame, *keys: str) -> DataFrame:
    """(keys, a, b): the characters of ``token`` two by two, as codes."""
    places = F.explode(F.sequence(F.lit(1), F.length("token") - 1)).alias("i")
    pairs = tokens.filter(F.length("token") > 1).select(*keys, "token", places)
    return pairs.select(*keys, F.expr("ascii(substr(token, i, 1)) as a"), F.expr("ascii(substr(token, i + 1, 1)) as b"))


def train(random: DataFrame, ordinary: DataFrame) -> DataFrame:
    """(a, b, ratio): log-likelihood ratio of every transition seen, in thousandths, from two tables of ``token``.

    Counts are smoothed by a fifth for each character of the alphabet. There are at most 128 * 128 rows.
    """
    labelled = random.select("token", F.lit(1).alias("y")).union(ordinary.select("token", F.lit(0).alias("y")))
    counts = _transitions(labelled, "y").groupBy("a", "b").agg(F.sum("y").alias("r"), F.sum(1 - F.col("y")).alias("o"))
    counts = counts.filter("a < 128 and b < 128")
    likely = "ln(({0} + 0.2D) / (sum({0}) over (partition by a) + {1} * 0.2D))"
    ratio = f"{likely.format('r', ALPHABET)} - {likely.format('o', ALPHABET)}"
    return counts.select("a", "b", F.expr(f"cast(round(1000 * ({ratio})) as long)").alias("ratio"))


def find_secrets(docs: DataFrame, sample: int = 5_000, margin: int = 700) -> DataFrame:
    """(doc_id, text_id, kind, start, end) of every span of (doc_id, text); text_id is a hash of the text.

    ``sample`` is about how many documents give ordinary identifiers; those with equal texts go
    together. A candidate counts as random when its ratio is above ``margin`` thousandths per
    transition on average, and does not touch a base span. A null text is empty. Rows with the same
    doc_id and text have their spans once.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    matches = scratch.keep(_matches(pick(docs, "doc_id", "text"), sample), "matches")
    base = _spans(matches, "assign").filter(F.length("value") >= 8)
    base = base.union(_spans(matches, "access")).union(_spans(matches, "hex"))
    base = scratch.keep(base, "base")
    ordinary = matches.select(F.explode("ordinary").alias("token"))
    model = scratch.keep(train(base.select(F.col("value").alias("token")), ordinary), "model")

    keys = ("doc_id", "text_id", "start", "end")
    candidates = scratch.keep(_spans(matches, "random"), "candidates")
    pairs = _transitions(candidates.withColumnRenamed("value", "token"), *keys)
    # A transition that neither side has seen says nothing.
    scored = pairs.join(model, ["a", "b"], "left").groupBy(*keys).agg(
        F.sum(F.coalesce("ratio", F.lit(0))).alias("ratio"), F.count("*").alias("n")
    )
    random = scored.filter(f"ratio > {margin} * n").select("doc_id", "text_id", F.lit("random").alias("kind"), "start", "end")
    known = base.select(F.col("doc_id").alias("_d"), F.col("text_id").alias("_t"), F.col("start").alias("_s"), F.col("end").alias("_e"))
    touches = (
        F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_id") == F.col("_t"))
        & (F.col("start") < F.col("_e")) & (F.col("_s") < F.col("end"))
    )
    return base.drop("value").union(random.join(known, touches, "left_anti"))


def secrets_query(docs: DataFrame) -> DataFrame:
    """doc_id, counts, digest and spans of every row of (doc_id, text)."""
    docs = pick(docs, "doc_id", "text")
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    spans = find_secrets(docs).select(
        "doc_id", "text_id", F.struct("start", order.alias("k"), "end", "kind").alias("s")
    )
    # One document's spans: as many as its text can hold.
    listed = spans.groupBy("doc_id", "text_id").agg(F.array_sort(F.collect_list("s")).alias("s"))

    def joined(spans: Column) -> Column:
        words = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.coalesce(F.array_join(words, ","), F.lit(""))

    listed = listed.withColumnsRenamed({"doc_id": "_id", "text_id": "_text"})
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_id"))
    found = rows.join(listed, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_id") == F.col("_text")), "left")
    counts = [
        F.expr(f"cast(coalesce(size(filter(s, x -> x.kind = '{kind}')), 0) as long)").alias(f"n_{kind}") for kind in KINDS
    ]
    base = F.filter("s", lambda s: s["kind"] != "random")
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("s")).alias("spans"))
