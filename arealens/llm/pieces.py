"""SentencePiece encoding and decoding by suffix-array matching.

The texts of a batch are cut into units, a run of blanks with the characters after it; no piece of
the vocabulary reaches over the start of a unit. The distinct new units are laid end to end and
their suffixes sorted, as deep as the longest piece. Binary search finds the range of suffixes that
begin with each piece, that is all its occurrences: edges over the text. Sorted by position, the
edges are relaxed. In a vocabulary of byte-pair merges the score of a piece is its place in the
order of merges, so the best path is the one that joins, again and again, the two neighbours whose
edge has the best score, the first of equals: a shortest path over the scores would give other
pieces than the vocabulary's own. What no piece covers becomes its UTF-8 bytes.

Decoding joins the pieces and gives back the text exactly. To that end a literal U+2581, the
character that stands for a blank inside pieces, is encoded as bytes.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "▁"
END, LITERAL_BLANK = 0x110000, 0x110001  # beyond Unicode: between units; a literal U+2581
CHUNK = 200_000  # characters that share one suffix array
REMEMBERED = 200_000  # units that a task remembers
LONG = 64  # units above this many characters are relaxed one by one


@dataclass
class Vocabulary:
    """``pieces`` are those that match text; ``ids`` and ``scores`` go with them. ``spelled`` has all ids' bytes."""

    pieces: list[str]
    ids: np.ndarray
    scores: np.ndarray
    byte_ids: np.ndarray
    spelled: list[bytes]
    special: frozenset[int]  # ids that decode to nothing
    longest: int


def load_vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a SentencePiece model file with byte pieces, read on the driver."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    count = model.get_piece_size()
    names = [model.id_to_piece(i) for i in range(count)]
    special = frozenset(i for i in range(count) if model.is_control(i) or model.is_unknown(i))
    byte_ids = np.full(256, -1, np.int32)
    for i in range(count):
        if model.is_byte(i):
            byte_ids[int(names[i][3:5], 16)] = i
    text = [i for i in range(count) if i not in special and not model.is_byte(i) and not model.is_unused(i)]
    if any(BLANK in names[i].lstrip(BLANK) for i in text):
        raise ValueError("a piece reaches over a blank")
    if (byte_ids < 0).any():
        raise ValueError("the model has no piece for some byte")
    spelled = [n.replace(BLANK, " ").encode() for n in names]
    for value, i in enumerate(byte_ids):
        spelled[i] = bytes([value])
    return Vocabulary(
        [names[i] for i in text],
        np.array(text, np.int32),
        np.array([model.get_score(i) for i in text], np.float64),
        byte_ids,
        spelled,
        special,
        max(len(names[i]) for i in text),
    )


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        # Pieces as rows of code points, and the order of their scores as small numbers, best first.
        self.rows = np.zeros((len(vocabulary.pieces), vocabulary.longest), np.uint32)
        self.sizes = np.array([len(p) for p in vocabulary.pieces], np.int64)
        for row, piece in zip(self.rows, vocabulary.pieces):
            row[: len(piece)] = _code_points(piece)
        self.scores = np.append(vocabulary.scores, -np.inf)  # for -1, no piece
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.start = np.zeros(1, np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of the pieces of each text."""
        if len(self.place) > REMEMBERED:
            self._forget()
        cut = [self._units(t) for t in texts]
        new = list(dict.fromkeys(u for units in cut for u in units if u not in self.place))
        if new:
            self._learn(new)
        size = np.diff(self.start)
        out = []
        for units in cut:
            own = np.fromiter(map(self.place.__getitem__, units), np.int64, len(units))
            sizes = size[own]
            ends = np.cumsum(sizes)
            at = np.repeat(self.start[own] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
            out.append(self.flat[at])
        return out

    @staticmethod
    def _units(text: str) -> list[str]:
        """Units without their last blank; a blank goes before the text."""
        if not text:
            return []
        words = text.split(" ")
        if "" not in words:
            return words
        units, blanks = [], 0
        for word in words:
            if word:
                units.append(" " * blanks + word)
                blanks = 0
            else:
                blanks += 1
        return [*units, " " * (blanks - 1)] if blanks else units

    def _learn(self, units: list[str]) -> None:
        flat, sizes = [self.flat], [np.diff(self.start)]
        low = 0
        while low < len(units):
            high, total = low, 0
            while high < len(units) and (high == low or total + len(units[high]) < CHUNK):
                total += len(units[high]) + 2
                high += 1
            ids, size = self._segment(units[low:high])
            flat.append(ids)
            sizes.append(size)
            low = high
        self.place.update(zip(units, range(len(self.place), len(self.place) + len(units))))
        self.flat = np.concatenate(flat)
        self.start = np.append(0, np.cumsum(np.concatenate(sizes)))

    def _segment(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of the units one after the other, and how many each has."""
        text = _code_points("".join(f" {u}\n" for u in units)).copy()
        length = np.array([len(u) + 2 for u in units], np.int64)
        ends = np.cumsum(length) - 1
        text[text == ord(BLANK)] = LITERAL_BLANK
        text[text == ord(" ")] = ord(BLANK)
        text[ends] = END
        edges = self._edges(text)
        start = np.flatnonzero(text != END)
        unit = np.repeat(np.arange(len(units)), length - 1)
        end = start + 1
        long = (length - 1 > LONG)[unit]
        parts = [self._relax(start[~long], end[~long], unit[~long], edges)]
        for one in np.flatnonzero(length - 1 > LONG):
            at = int(ends[one] - length[one] + 1)
            own = self._relax_long(at, int(ends[one]), edges)
            parts.append((own[0], own[1], np.full(len(own[0]), one)))
        start, end, unit = (np.concatenate(p) for p in zip(*parts))
        order = np.argsort(start, kind="stable")
        start, end, unit = start[order], end[order], unit[order]
        piece = edges[start, end - start]
        ids = np.where(piece >= 0, self.vocabulary.ids[piece], -1)
        lost = np.flatnonzero(piece < 0)
        if len(lost):
            spelled = [
                self.vocabulary.byte_ids[list((BLANK if c == LITERAL_BLANK else chr(c)).encode("utf-8", "surrogatepass"))]
                for c in text[start[lost]]
            ]
            repeat = np.ones(len(ids), np.int64)
            repeat[lost] = [len(s) for s in spelled]
            unit, ids = np.repeat(unit, repeat), np.repeat(ids, repeat)
            ids[ids < 0] = np.concatenate(spelled)
        return ids.astype(np.int32), np.bincount(unit, minlength=len(units))

    def _edges(self, text: np.ndarray) -> np.ndarray:
        """At [position, length] the number of the piece that occurs there, else -1."""
        depth = self.vocabulary.longest
        letters, dense = np.unique(text, return_inverse=True)
        kind = np.dtype(">u1" if len(letters) < 255 else ">u2" if len(letters) < 65_535 else ">u4")
        padded = np.append(dense + 1, np.zeros(depth, np.int64)).astype(kind)
        window = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, depth)[: len(text)])
        suffix = window.view(f"S{depth * kind.itemsize}").ravel()
        order = np.argsort(suffix, kind="stable")
        suffix = suffix[order]
        # Pieces with a letter that the text lacks occur nowhere.
        at = np.searchsorted(letters, self.rows)
        known = (at < len(letters)) & (letters[np.minimum(at, len(letters) - 1)] == self.rows)
        inside = np.arange(depth) < self.sizes[:, None]
        piece = np.flatnonzero((known | ~inside).all(1))
        key = np.where(inside[piece], at[piece] + 1, 0).astype(kind)
        top = np.where(inside[piece], at[piece] + 1, np.iinfo(kind).max).astype(kind)
        as_text = lambda a: np.ascontiguousarray(a).view(f"S{depth * kind.itemsize}").ravel()
        first, last = np.searchsorted(suffix, as_text(key)), np.searchsorted(suffix, as_text(top), "right")
        count = last - first
        ends = np.cumsum(count)
        found = order[np.repeat(first - ends + count, count) + np.arange(ends[-1] if len(ends) else 0)]
        piece = np.repeat(piece, count)
        edges = np.full((len(text), depth + 1), -1, np.int32)
        edges[found, self.sizes[piece]] = piece
        return edges

    def _relax(self, start, end, unit, edges) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Joins the best pair of every unit, round by round, until no unit has one."""
        depth = edges.shape[1] - 1
        done = []
        while len(start):
            size = end[1:] - start[:-1]
            near = (unit[1:] == unit[:-1]) & (size <= depth)
            score = np.full(len(start), -np.inf)
            score[:-1][near] = self.scores[edges[start[:-1][near], size[near]]]
            first = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
            best = np.maximum.reduceat(score, first)
            width = np.diff(np.append(first, len(start)))
            going = best > -np.inf
            hit = np.flatnonzero((score == np.repeat(best, width)) & np.repeat(going, width))
            hit = hit[np.append(True, unit[hit][1:] != unit[hit][:-1])] if len(hit) else hit
            end[hit] = end[hit + 1]
            keep = np.repeat(going, width)
            done.append((start[~keep], end[~keep], unit[~keep]))
            keep[hit + 1] = False
            start, end, unit = start[keep], end[keep], unit[keep]
        if not done:
            return start, end, unit
        return tuple(np.concatenate(p) for p in zip(*done))

    def _relax_long(self, low: int, high: int, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for one unit of any length, with a queue of pairs."""
        depth = edges.shape[1] - 1
        size = high - low
        own = edges[low:high]
        end = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        alive = bytearray(b"\1") * size
        queue: list[tuple[float, int, int]] = []

        def offer(left: int) -> None:
            right = end[left]
            if right < size and end[right] - left <= depth and (piece := own[left, end[right] - left]) >= 0:
                heapq.heappush(queue, (-self.scores[piece], left, end[right]))

        for left in range(size):
            offer(left)
        while queue:
            _, left, stop = heapq.heappop(queue)
            # Stale unless both symbols are still as they were.
            if not alive[left] or end[left] >= stop or end[end[left]] != stop:
                continue
            alive[end[left]] = 0
            end[left] = stop
            if stop < size:
                before[stop] = left
            offer(left)
            if before[left] >= 0:
                offer(before[left])
        start = np.flatnonzero(np.frombuffer(alive, np.uint8))
        return start + low, np.array(end)[start] + low


def decode_ids(vocabulary: Vocabulary, ids: np.ndarray) -> str:
    """The text of piece ids, without the blank that goes before every text; special ids are nothing."""
    spelled = b"".join([vocabulary.spelled[i] for i in ids if i not in vocabulary.special])
    return spelled.decode("utf-8", "replace").removeprefix(" ")


def _encode(vocabulary: Vocabulary):
    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(vocabulary)
        for texts in batches:
            known = texts.notna()
            found = pd.Series([None] * len(texts), dtype=object)
            found[known.to_numpy()] = pd.Series(encoder.encode(texts[known].tolist()), dtype=object).to_numpy()
            yield found

    return encode


def _decode(vocabulary: Vocabulary):
    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            yield pd.Series([None if ids is None else decode_ids(vocabulary, ids) for ids in rows], dtype=object)

    return decode


def encoded(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``docs`` with ``token_ids``; null for a null text, no ids for an empty one."""
    return docs.withColumn("token_ids", _encode(vocabulary)(docs["text"]))


def decoded(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``docs`` with ``decoded_text``, the text of ``token_ids``; null for null ids."""
    return docs.withColumn("decoded_text", _decode(vocabulary)(docs["token_ids"]))


def _both(vocabulary: Vocabulary):
    @F.pandas_udf("token_ids array<int>, round_trip boolean")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(vocabulary)
        for texts in batches:
            known = [t for t in texts if t is not None]
            ids = iter(encoder.encode(known))
            rows = [None if t is None else next(ids) for t in texts]
            same = [i is None or decode_ids(vocabulary, i) == t for i, t in zip(rows, texts)]
            yield pd.DataFrame({"token_ids": pd.Series(rows, dtype=object), "round_trip": same})

    return both


def pieces_query(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, token_ids, n_tokens and whether decoding gave the text back, for every row of (doc_id, text).

    A null text has null ids and counts as given back. Ids are decoded where they were made: they do
    not travel to a second worker.
    """
    found = docs.select(docs["doc_id"], _both(vocabulary)(docs["text"]).alias("_b")).select("doc_id", "_b.*")
    return found.select(
        "doc_id",
        F.coalesce(F.size("token_ids"), F.lit(0)).cast("long").alias("n_tokens"),
        "token_ids",
        "round_trip",
    )
