"""Personal data by fixed patterns and a skip-chain conditional random field.

The patterns give the base spans: e-mail and IP addresses, card and telephone numbers. The random
field labels the tokens that could be personal data, those with a digit or an at sign. Each token has
a unary potential from its shape. Neighbouring tokens, and tokens however far apart that repeat or
resemble each other, share pairwise potentials; loopy message passing, until messages settle, then makes
labels consistent over the document. So a number that stands in a telephone number at one place is found where it
stands alone. Base spans are observed labels; tokens outside them whose most likely label is a kind
become further spans.

Potentials are log ratios of counts over a bounded sample of documents, labelled by the patterns.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import pick

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
AGREEMENT = 6.0

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Where a run of digits does not lead to a match, no later start in the run does.
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"[^ \t-\r]*[0-9@][^ \t-\r]*")
_EDGES = "\"'`.,;:!?()[]{}<>*#$%&|"

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str | None) -> list[Span]:
    """(kind, start, end) in code points, by kind and start. Matches that fail their check are dropped."""
    if not text:
        return []
    found = [("email", start, end) for start, end in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(part := p.lstrip("0")) <= 3 and int(part or 0) <= 255 for p in m.groups()):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_DIGIT.findall(m.group())) <= 15:
            found.append(("phone", m.start(), m.end()))
    return found


def listed(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in ordered)


# --- the random field --------------------------------------------------------------------------------


def _shape(token: str) -> str:
    """Runs of digits by length, other runs by class; long tokens share their beginning.

    What has a card's length and not its check digit is a shape of its own.
    """
    out = re.sub(r"[0-9]+", lambda m: f"9{min(len(m.group()), 20)}", token[:48])
    digits = token.replace("-", "")
    fails = 13 <= len(digits) <= 19 and digits.isascii() and digits.isdigit() and not _luhn(digits)
    return re.sub(r"[^\W\d_]+", "a", out)[:24] + "!" * fails


def _core(token: str) -> tuple[int, int]:
    """Bounds of a token without punctuation at its edges."""
    start = len(token) - len(token.lstrip(_EDGES))
    return start, max(start, len(token.rstrip(_EDGES)))


class Graph:
    """Candidate tokens of one document and the edges that tie them."""

    def __init__(self, text: str, base: list[Span]):
        self.tokens: list[tuple[int, int]] = []
        self.labels: list[int] = []  # observed kind, 0 if none
        self.shapes: list[str] = []
        self.near: list[tuple[int, int]] = []
        self.far: list[tuple[int, int]] = []
        self.repeats: list[tuple[int, int]] = []  # each with the one before, for the potentials
        if not base and not ("@" in text or _DIGIT.search(text)):
            return
        spans = sorted((start, end, LABELS.index(kind)) for kind, start, end in base)
        having: dict[str, list[int]] = defaultdict(list)
        at = 0
        for m in _TOKEN.finditer(text):
            low, high = _core(m.group())
            start, end = m.start() + low, m.start() + high
            if start == end:
                continue
            while at < len(spans) and spans[at][1] <= start:
                at += 1
            label = spans[at][2] if at < len(spans) and spans[at][0] < end else 0
            me, token = len(self.tokens), text[start:end]
            self.tokens.append((start, end))
            self.labels.append(label)
            self.shapes.append(_shape(token))
            if me and start - self.tokens[me - 1][1] <= 3:
                self.near.append((me - 1, me))
            # Repeats: the same text, or the same digits.
            keys = {token.lower()}
            digits = "".join(_DIGIT.findall(token))
            if len(digits) >= 4:
                keys.add(digits)
            for key in sorted(keys):
                having[key].append(me)
        for same in having.values():
            self.repeats += zip(same, same[1:])
            # An observed kind reaches every repeat at once, the last before it or else the first after it.
            # Without one each is tied to the repeat before. So edges stay linear.
            known = next((i for i in same if self.labels[i]), None)
            if known is None:
                self.far += zip(same, same[1:])
                continue
            for me in same:
                if self.labels[me]:
                    known = me
                else:
                    self.far.append((known, me))


class Field:
    """Potentials of the random field, as log ratios."""

    def __init__(self, shape: dict[str, np.ndarray], prior: np.ndarray, near: np.ndarray, far: np.ndarray):
        self.shape, self.prior, self.near, self.far = shape, prior, near, far

    def decode(self, graphs: list[Graph], settled: float = 1e-3) -> list[np.ndarray]:
        """Most likely label of every token of every graph; all graphs pass messages together.

        A graph is done when no message of it moves by more than ``settled``. Steps become smaller, so
        that messages which swing come to rest. The bound of the rounds is for those that never do: a
        graph has more than a message needs from its one end to the other.
        """
        sizes = [len(g.tokens) for g in graphs]
        first = np.concatenate([[0], np.cumsum(sizes)]).astype(int)
        unary = np.array([self.shape.get(s, self.prior) for g in graphs for s in g.shapes]).reshape(-1, len(LABELS))
        seen = np.array([label for g in graphs for label in g.labels], int)
        # An observed kind is certain.
        unary[seen > 0] = -np.inf
        unary[np.flatnonzero(seen), seen[seen > 0]] = 0.0
        belief = unary.copy()
        near = np.concatenate([np.array(g.near, int).reshape(-1, 2) + low for g, low in zip(graphs, first)])
        far = np.concatenate([np.array(g.far, int).reshape(-1, 2) + low for g, low in zip(graphs, first)])
        ends = np.concatenate([near, far])
        table = np.concatenate([np.repeat(self.near[None], len(near), 0), np.repeat(self.far[None], len(far), 0)])
        source = np.concatenate([ends[:, 0], ends[:, 1]])
        target = np.concatenate([ends[:, 1], ends[:, 0]])
        table = np.concatenate([table, table.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(ends)) + len(ends), np.arange(len(ends))])
        owner = np.repeat(np.arange(len(graphs)), sizes)[target]
        message = np.zeros((len(source), len(LABELS)))
        rounds = 0
        while len(source):
            out = table + (belief[source] - message[back])[:, :, None]
            peak = out.max(1, keepdims=True)
            new = np.log(np.exp(out - peak).sum(1)) + peak[:, 0]
            new -= new.max(1, keepdims=True)
            # Observed tokens send messages and take none.
            new[seen[target] > 0] = 0.0
            moved = np.zeros(len(graphs))
            np.maximum.at(moved, owner, np.abs(new - message).max(1))
            step = 0.5 if rounds < 50 else 25.0 / rounds
            message = (1 - step) * message + step * new
            belief[target] = unary[target]
            np.add.at(belief, target, message)
            rounds += 1
            # Messages of a graph that is done stay as they are, whatever the others still do.
            going = ((moved > settled) & (rounds < np.add(sizes, 100)))[owner]
            if not going.all():
                place = np.cumsum(going) - 1
                back = place[back[going]]
                source, target, table, owner, message = (x[going] for x in (source, target, table, owner, message))
        best = belief.argmax(1)
        return [best[low:high] for low, high in zip(first, first[1:])]


def all_spans(text: str, base: list[Span], graph: Graph, labels: np.ndarray) -> list[Span]:
    """Base spans and those of further labelled tokens, joined where only blanks or hyphens part them."""
    spans = list(base)
    for (start, end), label, seen in zip(graph.tokens, labels, graph.labels):
        if not label or seen:
            continue
        last = spans[-1] if len(spans) > len(base) else None
        if last and last[0] == LABELS[label] and not text[last[2] : start].strip(" -"):
            spans[-1] = (last[0], last[1], end)
        else:
            spans.append((LABELS[label], start, end))
    return spans


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found: Counter = Counter()
        for text in batch["text"]:
            graph = Graph(text, base_spans(text))
            for shape, label in zip(graph.shapes, graph.labels):
                found["shape", shape, label, 0] += 1
            for edges, pairs in (("near", graph.near), ("far", graph.repeats)):
                for a, b in pairs:
                    found[edges, "", graph.labels[a], graph.labels[b]] += 1
        rows = [(*key, n) for key, n in found.items()]
        yield pd.DataFrame(rows, columns=["what", "shape", "a", "b", "n"])


def fit(docs: DataFrame, sample: int = 20_000) -> Field:
    """Potentials from about ``sample`` texts, chosen by a hash of the text; fewer if the table is smaller.

    The patterns label the sample. Repeats agree with the fixed weight ``AGREEMENT``: they are rare in
    a sample, and an observed kind is to reach them.
    """
    texts = pick(docs, "text").filter("text is not null")
    total = texts.count()
    share = min(1.0, sample / max(total, 1))
    drawn = texts.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < share * (1 << 30))
    counts = drawn.mapInPandas(_counted, "what string, shape string, a int, b int, n long")
    rows = counts.groupBy("what", "shape", "a", "b").agg(F.sum("n").alias("n")).toArrow().to_pylist()
    size = len(LABELS)
    shapes: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(size))
    pair = {"near": np.full((size, size), 0.5), "far": np.full((size, size), 0.5)}
    for row in rows:
        if row["what"] == "shape":
            shapes[row["shape"]][row["a"]] += row["n"]
        else:
            pair[row["what"]][row["a"], row["b"]] += row["n"]
    prior = sum(shapes.values(), np.zeros(size)) + 1.0
    prior = np.log(prior / prior.sum())
    unary = {s: np.log((n + 2 * np.exp(prior)) / (n.sum() + 2)) for s, n in shapes.items()}

    def ratio(n: np.ndarray) -> np.ndarray:
        n = n + n.T
        own = n.sum(1)
        return np.log(n * n.sum() / np.outer(own, own))

    near, far = ratio(pair["near"]), ratio(pair["far"])
    # Repeats have one label, whichever it is, unless their own shapes speak strongly against it.
    far = np.minimum(far, 0.0)
    np.fill_diagonal(far, AGREEMENT)
    # A shape that the sample lacks is most likely none.
    unknown = 0.1 * np.exp(prior)
    unknown[0] += 0.9
    return Field(unary, np.log(unknown), near, far)


SPANS = "array<struct<kind: string, start: long, end: long>>"


def _found(model: Field):
    @F.pandas_udf(f"base {SPANS}, spans {SPANS}")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        def rows(spans: list[Span]) -> list[dict]:
            return [{"kind": k, "start": s, "end": e} for k, s, e in spans]

        for texts in batches:
            texts = [t or "" for t in texts]
            base = [base_spans(t) for t in texts]
            spans = list(base)
            graphs = [(i, g) for i, t in enumerate(texts) if (g := Graph(t, base[i])).tokens]
            if graphs:
                for (i, graph), labels in zip(graphs, model.decode([g for _, g in graphs])):
                    spans[i] = all_spans(texts[i], base[i], graph, labels)
            yield pd.DataFrame({"base": [rows(b) for b in base], "spans": [rows(s) for s in spans]})

    return found


def find_pii(docs: DataFrame, model: Field) -> DataFrame:
    """``docs`` with the arrays ``base`` and ``spans`` of (kind, start, end), in code points.

    A null or empty text has none. Columns of these names are replaced.
    """
    kept = [docs[c] for c in docs.columns if c not in ("base", "spans")]
    return docs.select(*kept, _found(model)(docs["text"]).alias("_pii_found")).select("*", "_pii_found.*").drop("_pii_found")


def masked(docs: DataFrame, model: Field) -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in brackets; null stays null."""

    @F.pandas_udf("string")
    def mask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            texts = list(texts)
            base = [base_spans(t) for t in texts]
            graphs = [Graph(t or "", b) for t, b in zip(texts, base)]
            out = []
            for text, own, graph, labels in zip(texts, base, graphs, model.decode(graphs)):
                spans = all_spans(text or "", own, graph, labels)
                parts, at = [], 0
                for start, end, kind in _disjoint(spans):
                    parts += [text[at:start], f"[{kind.upper()}]"]
                    at = end
                out.append("".join([*parts, text[at:]]) if parts else text)
            yield pd.Series(out, dtype=object)

    return docs.withColumn("text", mask(docs["text"]))


def _disjoint(spans: list[Span]) -> list[tuple[int, int, str]]:
    """Overlapping spans joined, under the kind of the first."""
    out: list[tuple[int, int, str]] = []
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2], KINDS.index(s[0]))):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]), out[-1][2])
        else:
            out.append((start, end, kind))
    return out


def pii_query(docs: DataFrame) -> DataFrame:
    """doc_id, counts, digest and spans of every row of (doc_id, text)."""
    docs = pick(docs, "doc_id", "text")
    found = find_pii(docs, fit(docs)).drop("text")

    def joined(spans: str):
        ordered = F.expr(
            f"array_sort(transform({spans}, s -> struct(array_position(array('email','ip','card','phone'), s.kind) as k,"
            " s.start as start, s.end as end, s.kind as kind)))"
        )
        return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{kind}')) as long)").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
