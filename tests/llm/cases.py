"""Tables with what tends to break operators: nulls, empty and very long texts, repeats, clashing columns."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Names that operators use inside, as extra columns of their input.
CLASHING = ("n", "node", "set_id", "score", "lang_pred", "text_id", "spans", "base", "component", "start", "label", "kept")

LONG = " ".join(f"word{i % 977} other{i % 31}" for i in range(20_000))
TEXTS = [
    None,
    "",
    " \t\n ",
    LONG,
    "the cat sat on the mat and looked at the dog that slept near the door",
    "the cat sat on the mat and looked at the dog that slept near the door",
    "THE cat sat\ton the mat  and looked at the dog that slept near the door",
    "one two",
    "one two",
    "!!! ??? 123",
    "é è 漢字 😀 ▁ <s> \\ [INST]",
]


def documents(spark: SparkSession):
    """Each text under an id of its own, some rows twice, some ids null or shared."""
    rows = [(i, t, "en" if i % 2 else None, "s" if i % 3 else None) for i, t in enumerate(TEXTS)]
    rows += [(4, TEXTS[4], None, "s"), (4, TEXTS[4], None, "s"), (None, TEXTS[4], "en", None), (None, None, None, None)]
    rows += [(None, "some text without a number of its own", "en", "s"), (7, "another text under a number that is taken", "en", "s")]
    names = ["doc_id", "text", "lang", "source", "n_chars", *CLASHING]
    data = [(*r, len(r[1]) if r[1] else None, *[f"x{k}" for k in range(len(CLASHING))]) for r in rows]
    kinds = ["long", "string", "string", "string", "long", *["string"] * len(CLASHING)]
    return spark.createDataFrame(data, ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds)))


def empty(spark: SparkSession):
    return documents(spark).limit(0)
