"""License scans by diagonal voting.

Every run of k words of every document is hashed and joined to the places of equal runs in license
templates. A hit votes for its diagonal, the document's word number less the template's: a passage
that follows the template puts all its votes on one diagonal, and each word put in or left out moves
it by one. Votes are summed by diagonal, neighbouring diagonals are merged, and the whole extent that
the template would have on them is verified word by word. Short templates also vote by shorter runs.

Words are runs of digits, letters and non-ASCII characters, with A-Z in lower case.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch, pick

_WORDS = bytes(b if b > 127 or chr(b).isdigit() or chr(b).islower() else b + 32 if 65 <= b <= 90 else 32 for b in range(256))

# Base phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Notices of public licenses, and the label that a match gives.
TEMPLATES = (
    (
        "mit-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the Software), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,"
        " and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The"
        " above copyright notice and this permission notice shall be included in all copies or substantial portions of"
        " the Software.",
    ),
    (
        "apache-notice",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless"
        " required by applicable law or agreed to in writing, software distributed under the License is distributed on"
        " an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for"
        " the specific language governing permissions and limitations under the License.",
    ),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "gpl-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version.",
    ),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    (
        "bsd-text",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met: Redistributions of source code must retain the above copyright notice, this"
        " list of conditions and the following disclaimer.",
    ),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("mit-release", "Released under the MIT License"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)

# Words without which a short notice names another license or version.
NAMES = {
    "apache-2.0": "apache 2",
    "cc-by-nc-4.0": "nc 4",
    "cc-by-sa-4.0": "sa 4",
    "cc-by-4.0": "4",
    "mit-release": "mit",
}


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


def gram_hashes(words: list[bytes], k: int) -> np.ndarray:
    """A 64-bit hash of every run of k words."""
    if len(words) < k:
        return np.zeros(0, np.int64)
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    run = np.full(len(one) - k + 1, k, np.uint64)
    for i in range(k):
        run = (run ^ (run >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + one[i : i + len(run)]
    return run.view(np.int64)


@dataclass
class Template:
    label: str
    words: list[bytes]
    names: frozenset[bytes] = field(default_factory=frozenset)


def templates(pairs=TEMPLATES, names=NAMES) -> list[Template]:
    return [Template(label, words_of(text), frozenset(words_of(names.get(label)))) for label, text in pairs]


def seeds(words: list[bytes], k: int, accept: float) -> list[tuple[int, int, int]]:
    """(length, hash, place) of runs by which a template is looked for.

    These are all runs of k words. Where as many changed words as ``accept`` leaves could break each of
    them, also the template's pieces, one more than that: each change or insertion breaks one at most.
    """
    found = {(k, int(g), place) for place, g in enumerate(gram_hashes(words, k))}
    count = len(words) - math.ceil(accept * len(words) - 1e-9) + 1
    if k * count > len(words):
        cuts = [len(words) * i // count for i in range(count + 1)]
        for low, high in zip(cuts, cuts[1:]):
            if low < high < low + k:
                found.add((high - low, int(gram_hashes(words[low:high], high - low)[0]), low))
    return sorted(found)


def in_order(template: list[bytes], span: list[bytes]) -> tuple[int, int]:
    """How many words of the template the span has in order at most, and after how many words it has them."""
    masks: dict[bytes, int] = defaultdict(int)
    for i, word in enumerate(template):
        masks[word] |= 1 << i
    full = rest = (1 << len(template)) - 1
    best, end = 0, 0
    for at, word in enumerate(span, 1):
        if word in masks:
            same = rest & masks[word]
            rest = ((rest + same) | (rest - same)) & full
            if len(template) - rest.bit_count() > best:
                best, end = len(template) - rest.bit_count(), at
    return best, end


def base_places(words: list[bytes], phrases=PHRASES) -> list[tuple[int, str]]:
    """(word number, label) of every place where a phrase's words stand consecutively."""
    text = b" " + b" ".join(words) + b" "
    found = []
    for phrase, label in phrases:
        wanted = b" " + phrase.encode() + b" "
        at, before, counted = text.find(wanted), 0, 0
        while at >= 0:
            # Only the text since the last place is counted.
            counted += text.count(b" ", before, at)
            before = at
            found.append((counted, label))
            at = text.find(wanted, at + 1)
    return found


def _hits(grams: dict[int, np.ndarray]):
    """Places of a text's runs of each length that are among ``grams``, which are sorted."""

    @F.pandas_udf("array<struct<at: long, gram: long>>")
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def row(words: list[bytes]) -> list[dict]:
            found = []
            for k, known in grams.items():
                own = gram_hashes(words, k)
                at = np.flatnonzero(known[np.searchsorted(known[:-1], own)] == own)
                found += [{"at": int(i), "gram": int(own[i])} for i in at]
            return found

        for texts in batches:
            yield pd.Series([row(words_of(t)) for t in texts])

    return hits


def _base(phrases):
    @F.pandas_udf("n_words long, n_base long, first_word long, last_word long, base_labels string")
    def base(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        def row(text: str | None) -> tuple:
            words = words_of(text)
            places = base_places(words, phrases)
            at = [p for p, _ in places]
            return (
                len(words),
                len(places),
                min(at, default=None),
                max(at, default=None),
                ",".join(sorted({label for _, label in places})),
            )

        for texts in batches:
            found = pd.DataFrame([row(t) for t in texts], columns=["n_words", "n_base", "first_word", "last_word", "base_labels"])
            yield found.astype({"first_word": "Int64", "last_word": "Int64"})

    return base


def _verify(known: list[Template]):
    @F.pandas_udf("score double, start long, end long")
    def verify(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for texts, numbers, low, high in batches:
            found = []
            last, words = None, []
            for text, number, a, b in zip(texts, numbers, low, high):
                if text is not last:
                    last, words = text, words_of(text)
                a, own = max(0, a), known[number].words
                same, end = in_order(own, words[a:b])
                # Backwards from there, where the nearest such words begin.
                start = end - in_order(own[::-1], words[a : a + end][::-1])[1]
                named = known[number].names <= set(words[a + start : a + end])
                found.append((same / len(own) if named else 0.0, a + start, a + end))
            yield pd.DataFrame(found, columns=["score", "start", "end"]).astype({"score": float, "start": int, "end": int})

    return verify


def find_notices(
    docs: DataFrame, known: list[Template] | None = None, k: int = 4, gap: int = 3, accept: float = 0.8
) -> DataFrame:
    """(doc_id, text_id, label, start, end, score) of every span of words that follows a template.

    ``score`` is the share of the template's words that the span has in order, at least ``accept``. The
    span must have the template's names. It is looked for where the template would be on the diagonals
    of its hits, and ``gap`` words to both sides; one hit is enough. Diagonals no more than ``gap``
    apart are one span. Templates below k words are an error. Rows with
    the same doc_id and text have their spans once; text_id is a hash of the text.
    """
    known = templates() if known is None else known
    if any(len(t.words) < k for t in known):
        raise ValueError(f"a template has fewer than {k} words")
    docs = pick(docs, "doc_id", "text").filter("text is not null")
    places = [(g, number, place, n) for number, t in enumerate(known) for n, g, place in seeds(t.words, k, accept)]
    grams = {n: np.unique(np.array([g for g, *_, m in places if m == n], np.int64)) for n in sorted({p[-1] for p in places})}
    # As large as the templates, which are a parameter and not data.
    index = F.broadcast(docs.sparkSession.createDataFrame([p[:3] for p in places], "gram long, template int, place int"))
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_id"), F.explode(_hits(grams)(F.col("text"))).alias("_hit"))
    votes = (
        keyed.select("doc_id", "text_id", "_hit.at", "_hit.gram")
        .join(index, "gram")
        .select("doc_id", "text_id", "template", (F.col("at") - F.col("place")).alias("diagonal"))
        .distinct()
    )
    # Neighbouring diagonals: a step of more than the gap begins a new span.
    group = "partition by doc_id, text_id, template order by diagonal"
    stepped = votes.select("*", F.expr(f"cast(diagonal - lag(diagonal) over ({group}) > {gap} as int)").alias("step"))
    numbered = stepped.select("*", F.expr(f"coalesce(sum(step) over ({group}), 0)").alias("span"))
    size = F.array(*[F.lit(len(t.words)) for t in known])[F.col("template")]
    spans = numbered.groupBy("doc_id", "text_id", "template", "span").agg(
        (F.min("diagonal") - gap).alias("low"), (F.max("diagonal") + F.first(size) + gap).alias("high")
    )
    # Few as a rule, and stored, so that Spark knows their size before it joins the texts.
    spans = Scratch(docs.sparkSession, "licenses").keep(spans, "spans")
    spans = spans.withColumnsRenamed({"doc_id": "_id", "text_id": "_text"})
    here = docs.select("doc_id", F.xxhash64("text").alias("text_id"), "text")
    joined = here.join(spans, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_id") == F.col("_text")))
    checked = _verify(known)(F.col("text"), F.col("template"), F.col("low"), F.col("high"))
    scored = joined.select("doc_id", "text_id", "template", checked.alias("_v"))
    label = F.array(*[F.lit(t.label) for t in known])[F.col("template")].alias("label")
    found = scored.select("doc_id", "text_id", label, "_v.start", "_v.end", "_v.score").filter(F.col("score") >= accept)
    return found.dropDuplicates(["doc_id", "text_id", "label", "start"])


def license_query(docs: DataFrame) -> DataFrame:
    """doc_id, base phrases, all labels and the best score of every row of (doc_id, text).

    A base phrase counts as a full match. Without base phrase and span the score is 0.
    """
    docs = pick(docs, "doc_id", "text")
    spans = find_notices(docs).groupBy("doc_id", "text_id").agg(
        F.collect_set("label").alias("_labels"), F.max("score").alias("_score"), F.count("*").alias("n_spans")
    )
    spans = spans.withColumnsRenamed({"doc_id": "_id", "text_id": "_text"})
    base = docs.select("doc_id", F.xxhash64("text").alias("text_id"), _base(PHRASES)(F.col("text")).alias("_b"))
    base = base.select("doc_id", "text_id", "_b.*")
    found = base.join(spans, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_id") == F.col("_text")), "left")
    own = F.when(F.col("n_base") > 0, F.split("base_labels", ",")).otherwise(F.array().cast("array<string>"))
    labels = F.array_sort(F.array_union(own, F.coalesce("_labels", F.array().cast("array<string>"))))
    return found.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        "base_labels",
        F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("_score", F.lit(0.0))).alias("score"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
    )
