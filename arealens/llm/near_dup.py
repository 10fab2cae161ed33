"""Near-duplicates by MinHash with one permutation, optimal densification, banded buckets and stars.

A document is the set of its distinct shingles, as 64-bit hashes. Copies, that is equal sets, become
one node. One permutation: the hash range is cut into ``bands * rows`` bins and the least hash of
each bin is kept; an empty bin copies from a full bin that a fixed random order of its own picks
(optimal densification), so slots of two sets agree with the probability of their similarity. Nodes
that agree in all slots of a band share a bucket. A bucket emits a star: one edge from its centre
to each other member, so edges are as many as members. The centre is the member whose buckets have
the most members, which in a group of copies is the original. Every edge is confirmed on the full
sets.

A star misses a link between two members that are both unlike its centre. That is only possible in
buckets whose members still lie in several components once the stars are confirmed. The nodes of
those buckets are compared exactly: the shingles of each are put in one global order, rare ones
first; two sets with similarity ``t`` of sizes ``n`` share a shingle among their first
``n - ceil(t * n) + 1``, so only nodes of different components that share such a shingle are
confirmed. Passages that many documents contain come last in that order and pair nobody.

With 40 bands of 4 rows, a pair at similarity 0.75 shares no bucket with probability 3e-7.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch, pick

COUNTERS = 1 << 20


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of runs of ``words`` words; a shorter text is one run, an empty one none.

    Words are what white space (space, tab to carriage return) leaves, with A-Z in lower case.
    """
    # Of bytes, lower() and split() touch ASCII only.
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    size = min(words, len(one))
    run = np.full(len(one) - size + 1, size, np.uint64)
    for i in range(size):
        run = _mix(run + one[i : i + len(run)])
    return np.unique(run)


class Signature:
    """Bucket keys of a sorted shingle set."""

    def __init__(self, bands: int, rows: int):
        self.bands, self.rows = bands, rows
        bins = bands * rows
        self.lower = np.array([-(-(j << 64) // bins) for j in range(bins)], np.uint64)
        # For each bin, the order in which it looks for a full one.
        self.search = np.random.default_rng(1).permuted(np.tile(np.arange(bins), (bins, 1)), axis=1)
        self.band = np.arange(1, bands + 1, dtype=np.uint64)

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        first = np.searchsorted(shingles, self.lower)
        full = np.diff(np.append(first, len(shingles))) > 0
        slot = shingles[np.minimum(first, len(shingles) - 1)]
        if not full.all():
            order = self.search[~full]
            slot[~full] = slot[order[np.arange(len(order)), full[order].argmax(1)]]
        key = self.band
        for column in slot.reshape(self.bands, self.rows).T:
            key = _mix(key + column)
        return key.view(np.int64)


def _describe(words: int, bands: int, rows: int):
    signature = Signature(bands, rows)

    @F.pandas_udf("n long, set_id binary, buckets array<long>")
    def describe(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            sets = [shingle_set(t, words) for t in texts]
            yield pd.DataFrame(
                {
                    "n": [len(s) for s in sets],
                    "set_id": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
                    "buckets": [signature.keys(s) if len(s) else s.view(np.int64) for s in sets],
                }
            )

    return describe


def _full_sets(texts: DataFrame, words: int) -> DataFrame:
    """(node, n, shingles) of the rows (node, n, set_id, text) whose text has that set."""

    def full(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingle_set(t, words) for t in batch["text"]]
            same = [xxhash.xxh3_128_digest(s.tobytes()) == bytes(i) for s, i in zip(sets, batch["set_id"])]
            own = batch[["node", "n"]].assign(shingles=[s.view(np.int64) for s in sets])
            yield own[np.array(same, bool)]

    return texts.select("node", "n", "set_id", "text").mapInPandas(full, "node long, n long, shingles array<long>")


def _similar(overlap: Column, n: Column, m: Column, percent: int) -> Column:
    return 100 * overlap >= percent * (n + m - overlap)


def _lengths_fit(n: Column, m: Column, percent: int) -> Column:
    return _similar(F.least(n, m), n, m, percent)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("_b"))
    overlap = F.size(F.array_intersect("_a", "_b"))
    both = pairs.join(left, "a").join(right, "b")
    return both.filter(_similar(overlap, F.size("_a"), F.size("_b"), percent)).select("a", "b")


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component): the least node reachable over the edges (a, b), for nodes with an edge.

    Labels spread to neighbours and jump to the label of their label; each round halves what is left
    of a path, and is written, so that no plan grows with the rounds.
    """
    both = scratch.keep(edges.union(edges.select("b", "a")).toDF("a", "b"), f"{name}-both")
    labels = scratch.keep(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("component")),
        f"{name}-0",
    )
    step = 0
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("_near"))
        spread = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.least("component", "_near").alias("component"), F.col("component").alias("_was")
        )
        spread = scratch.keep(spread, f"{name}-{step + 1}")
        to = spread.select(F.col("node").alias("_at"), F.col("component").alias("_to"))
        jumped = spread.join(to, F.col("component") == F.col("_at")).select(
            "node", F.least("component", "_to").alias("component"), "_was"
        )
        jumped = scratch.keep(jumped, f"{name}-{step + 2}")
        scratch.drop(f"{name}-{step}", f"{name}-{step + 1}")
        labels, step = jumped.select("node", "component"), step + 2
        if jumped.filter(F.col("component") != F.col("_was")).isEmpty():
            scratch.drop(f"{name}-both")
            return labels


def _first_shingles(counts: np.ndarray, percent: int):
    @F.pandas_udf("array<long>")
    def first(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for sets in batches:
            found = []
            for shingles in sets:
                shingles = np.asarray(shingles, np.int64)
                size = len(shingles) - -(-percent * len(shingles) // 100) + 1
                rank = np.lexsort((shingles, counts[shingles & (COUNTERS - 1)]))
                found.append(shingles[rank[:size]])  # in that order: places count below
            yield pd.Series(found)

    return first


def _rest(open_sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs of different components among (node, n, component, shingles) that share an early shingle.

    The order needs no exact frequencies, only the same ones everywhere: a fixed number of counters
    is gathered, whatever the number of documents.
    """
    counted = (
        open_sets.select(F.explode("shingles").alias("_s"))
        .groupBy(F.col("_s").bitwiseAND(F.lit(COUNTERS - 1)).alias("slot"))
        .agg(F.count("*").alias("n"))
        .toArrow()
    )
    counts = np.zeros(COUNTERS, np.int64)
    counts[counted["slot"].to_numpy()] = counted["n"].to_numpy()
    first = F.posexplode(_first_shingles(counts, percent)(F.col("shingles"))).alias("place", "shingle")
    early = scratch.keep(open_sets.select("node", "n", "component", first), "early")
    # Pairs within a component are known: only members outside the most frequent one look for partners.
    sizes = early.groupBy("shingle", "component").agg(F.count("*").alias("size"))
    mixed = sizes.groupBy("shingle").agg(F.max_by("component", "size").alias("most"), F.count("*").alias("kinds"))
    mixed = scratch.keep(mixed.filter("kinds > 1").drop("kinds"), "mixed")
    shared = scratch.keep(early.join(mixed, "shingle"), "shared")
    fewer = scratch.keep(shared.filter("component <> most"), "fewer")
    a, b = fewer.alias("a"), shared.alias("b")
    # If this is the first shingle that both have, no more can follow than either has left.
    least = F.least(F.col("a.n") - F.col("a.place"), F.col("b.n") - F.col("b.place"))
    pairs = a.join(b, F.col("a.shingle") == F.col("b.shingle")).filter(
        (F.col("a.component") != F.col("b.component"))
        & ((100 + percent) * least >= percent * (F.col("a.n") + F.col("b.n")))
    )
    one, other = F.col("a.node"), F.col("b.node")
    pairs = pairs.select(F.least(one, other).alias("a"), F.greatest(one, other).alias("b")).distinct()
    pairs = scratch.keep(pairs, "rest")
    scratch.drop("early", "mixed", "shared", "fewer")
    return pairs


def _grouped(docs: DataFrame, words: int, percent: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, text_id, n, component, component_id) of every row; text_id is a hash of the text."""
    scratch = Scratch(docs.sparkSession, "near-dup")
    docs = pick(docs, "doc_id", "text")
    described = docs.select("doc_id", _text_id("text"), _describe(words, bands, rows)(F.col("text")).alias("_d"))
    described = scratch.keep(described.select("doc_id", "text_id", "_d.*"), "described")

    # One node per distinct set, with the first of its rows; the sort-based aggregate drops copies before the shuffle.
    row = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_id")
    one = described.filter("n > 0").groupBy("set_id").agg(
        F.first("n").alias("n"), F.first("buckets").alias("buckets"), F.min(row).alias("row")
    )
    one = one.select("set_id", "n", "buckets", "row.doc_id", "row.text_id")
    nodes = scratch.keep(one.select(F.monotonically_increasing_id().alias("node"), "*"), "nodes")
    placed = nodes.select(F.explode("buckets").alias("bucket"), "node", "n")
    sizes = placed.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    members = scratch.keep(placed.join(scratch.keep(sizes, "sizes"), "bucket"), "members")
    # The original of a group of copies agrees with most of them, so it is in the largest buckets.
    crowd = scratch.keep(members.groupBy("node").agg(F.sum("size").alias("crowd")), "crowd")
    ranked = scratch.keep(members.join(crowd, "node"), "ranked")
    centres = ranked.groupBy("bucket").agg(F.max(F.struct("crowd", "node", "n")).alias("centre"))
    centres = scratch.keep(centres.select("bucket", F.col("centre.node").alias("centre"), F.col("centre.n").alias("centre_n")), "centres")
    stars = members.join(centres, "bucket").filter(
        (F.col("node") != F.col("centre")) & _lengths_fit(F.col("n"), F.col("centre_n"), percent)
    )
    stars = stars.select(F.least("centre", "node").alias("a"), F.greatest("centre", "node").alias("b")).distinct()
    stars = scratch.keep(stars, "stars")
    scratch.drop("sizes", "crowd", "ranked", "centres")

    # Full sets of the nodes that share a bucket with another, each from its first row, by id and text:
    # an id alone may be that of many rows.
    wanted = nodes.select("node", "n", "set_id", F.col("doc_id").alias("_id"), F.col("text_id").alias("_text"))
    wanted = wanted.join(members.select("node").distinct(), "node")
    here = docs.withColumn("text_id", _text_id("text"))
    texts = here.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_id") == F.col("_text")))
    sets = scratch.keep(_full_sets(texts, words).dropDuplicates(["node"]), "sets")

    links = scratch.keep(_confirmed(stars, sets, percent), "links")
    labels = components(links, scratch, "labels")
    located = members.join(labels, "node", "left").select(
        "bucket", "node", F.coalesce("component", "node").alias("component")
    )
    located = scratch.keep(located, "located")
    mixed = located.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    mixed = scratch.keep(mixed.filter("lo < hi").select("bucket"), "mixed-buckets")
    still_open = scratch.keep(located.join(mixed, "bucket").select("node", "component").distinct(), "open")
    if not still_open.isEmpty():
        open_sets = scratch.keep(sets.join(still_open, "node"), "open-sets")
        pairs = _rest(open_sets, percent, scratch)
        more = scratch.keep(_confirmed(pairs, open_sets, percent), "more")
        labels = components(links.union(more), scratch, "labels-all")
        scratch.drop("open-sets")
    scratch.drop("sets", "members", "located")

    # Every distinct set with the least doc_id of its component.
    joined = nodes.select("set_id", "doc_id", "node").join(labels, "node", "left")
    joined = scratch.keep(joined.select("set_id", "doc_id", F.coalesce("component", "node").alias("component")), "joined")
    least = joined.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = scratch.keep(joined.join(scratch.keep(least, "least"), "component").drop("doc_id"), "named")
    return described.select("doc_id", "text_id", "n", "set_id").join(named, "set_id", "left")


def _text_id(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_id")


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 75, bands: int = 40, rows: int = 4
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of (doc_id, text).

    Documents with ``100 * intersection >= percent * union`` of their shingle sets are linked;
    ``component_id`` is the least doc_id that links reach, and ``kept`` marks its row. A null or empty
    text, or one of white space only, has no shingles and is linked with nothing. Rows that repeat a
    doc_id are documents of their own that share its number. A row with a null doc_id takes part; its
    component is named by the others' ids, or null if none has one, and it is kept in that case.
    """
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return _grouped(docs, words, percent, bands, rows).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
    )


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 75, bands: int = 40, rows: int = 4) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates: that with the least doc_id, null ids last.

    Among rows with that id one stays, whatever their texts. Texts without words all stay.
    """
    groups = _grouped(docs, words, percent, bands, rows).filter("n > 0")
    first = groups.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_id")).alias("first")
    )
    first = first.select(F.col("first.doc_id").alias("_first_id"), F.col("first.text_id").alias("_first_text"))
    here = docs.withColumn("_text_id", F.xxhash64(F.coalesce(docs["text"], F.lit(""))))
    words_in = F.trim(F.translate("text", "\t\n\x0b\f\r", "     ")) != ""
    same = F.col("doc_id").eqNullSafe(F.col("_first_id")) & (F.col("_text_id") == F.col("_first_text"))
    kept = here.filter(words_in).join(first, same, "left_semi").dropDuplicates(["doc_id", "_text_id"])
    return kept.unionByName(here.filter(~F.coalesce(words_in, F.lit(False)))).drop("_text_id")
