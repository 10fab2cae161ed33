"""Language identification by prediction by partial matching over bytes.

Every language has a variable-order context tree: how often each byte followed each context of up to
``order`` bytes. A byte that was seen after a context costs ``-log2(count / (total + distinct))``
bits there; one that was not costs the escape ``-log2(distinct / (total + distinct))`` and is coded
in the next shorter context, at last as one of 256 equally likely bytes. Statistics are frozen, so
the code length of a text is exact and depends on nothing but the text. The language with the
shortest code wins; the score is its share of ``2 ** -length`` among all languages.

The trees of all languages share one trie with a cost vector per node, and all positions of a batch
descend it together, one level at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import pick

UNDETERMINED = "und"
BLOCK = 1 << 18  # bytes that descend the trie together


@dataclass
class ContextTrees:
    """``symbol`` maps bytes to dense numbers: 0 ends a text, 1 is a byte never seen.

    ``child[k][node * width + symbol]`` is the node of the string one byte longer, 0 if unseen.
    ``cost[k][node]`` has the bits of the string's last byte after the bytes before it, and
    ``escape[k][node]`` those of an escape from the string as a context, for each language.
    """

    languages: list[str]
    order: int
    symbol: np.ndarray
    width: int
    child: list[np.ndarray]
    cost: list[np.ndarray]
    escape: list[np.ndarray]


def _grams(data: np.ndarray, n: int) -> np.ndarray:
    """Strings of n bytes as numbers; the length is part of the number."""
    key = np.full(max(len(data) - n + 1, 0), n, np.int64)
    for i in range(n):
        key = (key << 8) | data[i : i + len(key)]
    return key


def _bytes(text: str) -> bytes:
    # A-Z in lower case, so that capitals cost as much as small letters.
    return text.encode("utf-8", "surrogatepass").lower()


def count_grams(order: int):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for language, texts in batch.groupby("lang")["text"]:
                keys: dict[int, list[np.ndarray]] = {n: [] for n in range(1, order + 2)}
                for text in texts:
                    data = np.frombuffer(_bytes(text), np.uint8).astype(np.int64)
                    for n in keys:
                        keys[n].append(_grams(data, n))
                for found in keys.values():
                    gram, count = np.unique(np.concatenate(found), return_counts=True)
                    yield pd.DataFrame({"lang": language, "gram": gram, "n": count})

    return count


def training_sample(docs: DataFrame, per_language: int) -> DataFrame:
    """At most ``per_language`` whole texts of each language, chosen by a hash of their id and text."""
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    # One number per language, as many as the trees that the driver is to hold anyway.
    counts = labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()
    share = F.when(F.lit(False), 0.0)
    for row in counts:
        share = share.when(F.col("lang") == row["lang"], 1.2 * per_language / row["n"])
    draw = F.pmod(F.xxhash64("doc_id", F.crc32("text")), F.lit(1 << 30)) / float(1 << 30)
    thinned = labelled.withColumn("_draw", draw).filter(F.col("_draw") < share)
    ranked = thinned.selectExpr("lang", "text", "row_number() over (partition by lang order by _draw, text) as _rank")
    return ranked.filter(F.col("_rank") <= per_language).select("lang", "text")


def fit(docs: DataFrame, order: int = 4, per_language: int = 400) -> ContextTrees | None:
    """Context trees from (doc_id, text, lang); None without a labelled text.

    The trees come from a sample of ``per_language`` texts per language at most, so they are bounded
    however large the corpus is; they are the only thing that reaches the driver.
    """
    sample = training_sample(pick(docs, "doc_id", "text", "lang"), per_language)
    grams = sample.mapInPandas(count_grams(order), "lang string, gram long, n long")
    return trees(grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow().to_pandas(), order)


def trees(grams: pd.DataFrame, order: int) -> ContextTrees | None:
    """Context trees from the counts (lang, gram, n) of strings of 1 to order + 1 bytes."""
    languages = sorted(grams["lang"].unique())
    if not languages:
        return None
    table = grams.pivot_table(index="gram", columns="lang", values="n", fill_value=0)[languages]
    keys, counts = table.index.to_numpy(), table.to_numpy(np.float64)
    length = np.zeros(len(keys), np.int64)
    for n in range(1, order + 2):
        length[(keys >> (8 * n)) == n] = n
    many = len(languages)

    def escapes(total: np.ndarray, distinct: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(total > 0, -np.log2(distinct / (total + distinct)), 0.0)

    level = {n: (keys[length == n], counts[length == n]) for n in range(1, order + 2)}
    seen = (level[1][0] & 0xFF).astype(int)
    symbol = np.ones(256, np.uint8)
    symbol[seen] = np.arange(2, len(seen) + 2)
    width = len(seen) + 2

    # The root: every byte after no context at all.
    total, distinct = level[1][1].sum(0), (level[1][1] > 0).sum(0)
    root = escapes(total, distinct)
    with np.errstate(divide="ignore"):
        known = np.where(level[1][1] > 0, -np.log2(level[1][1] / (total + distinct)), root + 8.0)
    child, cost, escape = [np.zeros(0, np.int32)], [np.vstack([np.zeros(many), root + 8.0, known])], []
    nodes = {int(k): i + 2 for i, k in enumerate(level[1][0])}  # node of each string of the level above
    for n in range(2, order + 2):
        own, count = level[n]
        body = own & ((1 << (8 * n)) - 1)
        before = (body >> 8) | ((n - 1) << (8 * (n - 1)))
        after = (body & ((1 << (8 * (n - 1))) - 1)) | ((n - 1) << (8 * (n - 1)))
        parent = np.array([nodes[int(k)] for k in before], np.int64)
        shorter = np.array([nodes[int(k)] for k in after], np.int64)
        size = len(cost[-1])
        total, distinct = np.zeros((size, many)), np.zeros((size, many))
        np.add.at(total, parent, count)
        np.add.at(distinct, parent, count > 0)
        out = escapes(total, distinct)
        with np.errstate(divide="ignore", invalid="ignore"):
            known = np.where(count > 0, -np.log2(count / (total + distinct)[parent]), out[parent] + cost[-1][shorter])
        table = np.zeros(size * width, np.int32)
        table[parent * width + symbol[body & 0xFF]] = np.arange(1, len(own) + 1)
        child.append(table)
        escape.append(out.astype(np.float32))
        nodes = {int(k): i + 1 for i, k in enumerate(own)}
        cost.append(np.vstack([np.zeros(many), known]))
    return ContextTrees(languages, order, symbol, width, child, [c.astype(np.float32) for c in cost], escape)


def code_lengths(model: ContextTrees, texts: list[bytes]) -> np.ndarray:
    """Bits of each text in each language."""
    bits = np.zeros((len(texts), len(model.languages)))
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes + model.order)  # each text is followed by end marks
    whole = np.zeros(int(ends[-1]) if len(texts) else 0, np.uint8)
    for text, end, size in zip(texts, ends, sizes):
        raw = np.frombuffer(text, np.uint8)
        whole[end - model.order - size : end - model.order] = model.symbol[raw]
    for start in range(0, len(whole), BLOCK):
        low = max(0, start - model.order)
        part = whole[low : start + BLOCK]
        nodes = [part.astype(np.int64)]
        for k in range(1, model.order + 1):
            node = np.zeros(len(part), np.int64)
            node[1:] = model.child[k][nodes[-1][:-1] * model.width + part[1:]]
            nodes.append(node)
        cost = model.cost[-1][nodes[-1]]
        left = np.flatnonzero(nodes[-1] == 0)
        for k in range(model.order - 1, -1, -1):
            # Not found after k + 1 bytes: escape from that context, if it is one, and go on in a shorter one.
            before = np.where(left > 0, nodes[k][left - 1], 0)
            cost[left] += model.escape[k][before] + model.cost[k][nodes[k][left]]
            left = left[nodes[k][left] == 0] if k else left[:0]
        cost[part == 0] = 0
        cost = cost[start - low :]
        owner = np.searchsorted(ends, np.arange(start, start + len(cost)), side="right")
        first = owner[0]
        for j in range(bits.shape[1]):
            found = np.bincount(owner - first, cost[:, j])
            bits[first : first + len(found), j] += found[: len(bits) - first]
    return bits


def identify(docs: DataFrame, model: ContextTrees | None) -> DataFrame:
    """(doc_id, lang_pred, score) and ``docs``' other columns, one row per row.

    A text that is null, empty or has no letter is ``und`` with score 0; so is every text where there
    is no model. Ties go to the first language in alphabetical order. Columns named ``lang_pred`` or
    ``score`` are replaced. Texts of any length run through in blocks of bounded size.
    """

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            language = np.full(len(batch), UNDETERMINED, object)
            score = np.zeros(len(batch))
            texts = batch.tolist()
            known = [i for i, t in enumerate(texts) if t and model and any(map(str.isalpha, t))]
            for low in range(0, len(known), 64):
                some = known[low : low + 64]
                bits = code_lengths(model, [_bytes(texts[i]) for i in some])
                share = np.exp2(np.maximum(bits.min(1)[:, None] - bits, -1000)).sum(1)
                language[some] = np.array(model.languages, object)[bits.argmin(1)]
                score[some] = 1 / share
            yield pd.DataFrame({"lang_pred": language, "score": score})

    kept = [docs[c] for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.select(*kept, predict(docs["text"]).alias("_language_found")).select("*", "_language_found.*").drop("_language_found")


def held_out():
    """Whether a row is kept from training: crc32 of the id, as text, leaves 1 modulo 3. A null id is not."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def language_query(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; trained on the rows that are not held out."""
    docs = pick(docs, "doc_id", "text", "lang")
    model = fit(docs.filter(~held_out()))
    return identify(docs.drop("lang"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
