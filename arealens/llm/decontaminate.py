"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may differ from its copy in a document by an error budget of k edits.
Cut into k + 1 pieces, at least one piece survives k edits unchanged, so an automaton of all pieces
finds every copy by an exact hit. Hits of an item on near diagonals make one window, and Myers'
bit-parallel distance decides whether the item occurs in the window within its budget.

Both sides are compared as words in lower case, joined by one blank: a word is a run of letters,
digits and non-ASCII characters.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from .scratch import pick

# ASCII characters outside words become blanks.
_WORDS = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str | None) -> str:
    """Words in lower case, joined by one blank; each byte of the UTF-8 form is one character."""
    raw = (text or "").lower().encode("utf-8", "surrogatepass")
    return b" ".join(raw.translate(_WORDS).split()).decode("latin-1")


@dataclass
class Item:
    item_id: object
    text: str
    budget: int
    pieces: list[int]  # where pieces start
    masks: dict[str, int]  # of each character, the positions where the item has it


def make_item(item_id, text: str | None, rate: float, piece: int | None = None) -> Item | None:
    """The item with a budget of ``rate`` of its characters; with ``piece``, less where pieces would be shorter."""
    own = words_of(text)
    if not own:
        return None
    budget = int(rate * len(own))
    if piece:
        budget = max(0, min(budget, len(own) // piece - 1))
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(own):
        masks[c] |= 1 << i
    cuts = [len(own) * i // (budget + 1) for i in range(budget + 1)]
    return Item(item_id, own, budget, cuts, dict(masks))


def best_match(item: Item, text: str) -> tuple[int, int]:
    """Least edit distance of the item to any part of the text, and where the first such part ends."""
    size = len(item.text)
    full, high = (1 << size) - 1, 1 << (size - 1)
    plus, minus, score = full, 0, size
    best, end = size, 0
    get = item.masks.get
    for at, c in enumerate(text, 1):
        same = get(c, 0)
        across = (((same & plus) + plus) ^ plus) | same
        up = minus | (full & ~(across | plus))
        down = plus & across
        if up & high:
            score += 1
        elif down & high:
            score -= 1
        up, down = (up << 1) & full, (down << 1) & full
        vertical = same | minus
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
        if score < best:
            best, end = score, at
    return best, end


class Matcher:
    """All items of one block, ready to look for in texts."""

    def __init__(self, items: list[Item], whole: int):
        self.items = items
        self.whole: dict[str, list[Item]] = defaultdict(list)  # short ones: only as the whole text
        self.automaton = ahocorasick.Automaton()
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for number, item in enumerate(items):
            if len(item.text) < whole:
                self.whole[item.text].append(item)
                continue
            for start, end in zip(item.pieces, [*item.pieces[1:], len(item.text)]):
                places[item.text[start:end]].append((number, start))
        for piece, found in places.items():
            self.automaton.add_word(piece, (len(piece), found))
        if places:
            self.automaton.make_automaton()
        self.any = bool(places)

    def find(self, text: str | None) -> list[tuple]:
        """(item_id, distance, number of the first word) of every item within its budget, best place each."""
        own = words_of(text)
        found = [(item.item_id, 0, 0) for item in self.whole.get(own, ())]
        if not self.any:
            return found
        diagonals: dict[int, set[int]] = defaultdict(set)
        for last, (size, places) in self.automaton.iter(own):
            for number, start in places:
                diagonals[number].add(last + 1 - size - start)
        for number, offsets in diagonals.items():
            item = self.items[number]
            best = None
            for low, high in _windows(sorted(offsets), item.budget):
                begin = max(0, low - item.budget)
                window = own[begin : high + len(item.text) + item.budget]
                exact = window.find(item.text)
                distance, end = (0, exact + len(item.text)) if exact >= 0 else best_match(item, window)
                if distance <= item.budget and (best is None or distance < best[0]):
                    best = (distance, max(0, begin + end - len(item.text)))
            if best:
                found.append((item.item_id, best[0], own.count(" ", 0, best[1])))
        return found


def _windows(offsets: list[int], budget: int) -> Iterator[tuple[int, int]]:
    """Runs of offsets that edits within the budget can join."""
    low = high = offsets[0]
    for offset in offsets[1:]:
        if offset - high > 2 * budget:
            yield low, high
            low = offset
        high = offset
    yield low, high


def _blocks(benchmark: DataFrame, rate: float, piece: int | None, whole: int, block_chars: int) -> Iterator[Matcher]:
    """The benchmark in blocks of about ``block_chars`` characters, so that one fits a task however many there are."""
    items = pick(benchmark, "item_id", "text").filter("text is not null").distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = -(-total // block_chars)
    for block in range(count):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block).collect()
        yield Matcher([m for r in rows if (m := make_item(r["item_id"], r["text"], rate, piece))], whole)


def _matches(matcher_items: list[Item], whole: int, item_type) -> object:
    entry = StructType(
        [StructField("item_id", item_type), StructField("distance", IntegerType()), StructField("first_word", LongType())]
    )

    @F.pandas_udf(ArrayType(entry))
    def matches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(matcher_items, whole)
        for texts in batches:
            yield pd.Series(
                [
                    [{"item_id": i, "distance": d, "first_word": w} for i, d, w in matcher.find(text)]
                    for text in texts
                ]
            )

    return matches


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    rate: float = 0.08,
    piece: int | None = None,
    whole: int = 24,
    block_chars: int = 4_000_000,
) -> DataFrame:
    """(doc_id, item_id, distance, first_word): the test items that each document contains.

    An item of m characters may differ by ``rate * m`` edits, rounded down. With ``piece`` it may differ
    by ``m / piece - 1`` at most, so that pieces keep ``piece`` characters. Items below ``whole`` characters only match a document that is
    nothing else. Null or empty texts and items match nothing; of repeated items with one id each
    different text counts. The row has the best place of the item in the document, the first of
    equals; repeated documents have rows each.
    """
    docs = pick(docs, "doc_id", "text")
    kind = benchmark.schema["item_id"].dataType
    schema = StructType(
        [docs.schema["doc_id"], *[StructField("item_id", kind), StructField("distance", IntegerType()), StructField("first_word", LongType())]]
    )
    found = docs.sparkSession.createDataFrame([], schema)
    for number, matcher in enumerate(_blocks(benchmark, rate, piece, whole, block_chars)):
        hits = docs.select("doc_id", F.explode(_matches(matcher.items, whole, kind)(F.col("text"))).alias("_m"))
        hits = hits.select("doc_id", "_m.*")
        found = hits if number == 0 else found.union(hits)
    return found


def decontaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    rate: float = 0.08,
    piece: int | None = None,
    whole: int = 24,
    block_chars: int = 4_000_000,
) -> DataFrame:
    """The rows of ``docs`` that contain no test item, with all their columns."""
    kind = benchmark.schema["item_id"].dataType
    for matcher in _blocks(benchmark, rate, piece, whole, block_chars):
        docs = docs.filter(F.size(_matches(matcher.items, whole, kind)(docs["text"])) == 0)
    return docs
