"""Repair of conversation structure by a generalised LR search over the role grammar.

A repaired conversation has role initials ``(s?(ua)+)?``: an optional system turn, then user and
assistant turns in pairs, or nothing at all. The grammar's LR automaton has four stack tops: nothing
read (``0``, accepting), after the system turn (``s``), after a user turn (``u``), after an assistant
turn (``a``, accepting). Each row of the conversation is read once; from every stack top alive, the
parser forks on the actions

* keep (``k``, cost 0): shift the row's own role initial, where the grammar allows it;
* rerole (``r``, cost 3): shift it as user or assistant, whichever the top expects;
* delete (``d``, cost 4): drop the row; the only action for blank and duplicate rows;
* insert (``i``, cost 3): shift an empty user or assistant turn without reading a row (between any
  two rows, before the first and after the last);

and a truncated row that is not deleted costs 3 more. Forks that reach the same stack top are merged
on the least (cost, audit), where the audit is the string of action initials; two audits are both
kept only while one is a prefix of the other, since only then can later actions change their order.
The graph-structured stack therefore never holds more than a few tops, and a conversation is read in
time linear in its rows (times the audit's length for the copies of strings).

A role's initial is its first character; an empty role has none, so its row cannot be kept.

Faults are found first, each row counting its first: blank (no character outside space and tab to
carriage return), duplicate (role and text equal to an earlier row's), truncated (the last such
character is not ``.``, ``!`` or ``?``).
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import pick

# Costs of the actions and of a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
ROLE_NAME = {"u": "user", "a": "assistant"}
ACCEPTING = ("0", "a")

_VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
_END = re.compile(r"[.!?]")


def _shift(top: str, initial: str) -> str | None:
    """The stack top after shifting a role initial, or None where the grammar has no such move."""
    if initial == "s":
        return "s" if top == "0" else None
    if initial == "u":
        return "u" if top in ("0", "s", "a") else None
    if initial == "a":
        return "a" if top == "u" else None
    return None


def _expected(top: str) -> str:
    return "a" if top == "u" else "u"


def faults(roles: list[str], texts: list[str]) -> list[str | None]:
    """Each row's first fault: 'blank', 'duplicate', 'truncated' or None."""
    seen, out = set(), []
    for role, text in zip(roles, texts):
        visible = _VISIBLE.findall(text)
        if not visible:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        elif not _END.fullmatch(visible[-1]):
            out.append("truncated")
        else:
            out.append(None)
        seen.add((role, text))
    return out


def _merge(tops: dict, top: str, cost: int, audit: str) -> None:
    """Add a fork to a stack top; keep the least (cost, audit), and audits in prefix relation."""
    alive = tops.setdefault(top, [])
    if alive and alive[0][0] < cost:
        return
    if alive and alive[0][0] > cost:
        alive.clear()
    if any(a == audit for _, a in alive):
        return
    keep = [(cost, audit)]
    for c, a in alive:
        related = a.startswith(audit) or audit.startswith(a)
        if related:
            keep.append((c, a))
        elif a < audit:
            return
    tops[top] = keep


def _inserts(tops: dict) -> dict:
    """Close the tops under insertions (two in a row at most can pay: a third returns to a top)."""
    for _ in range(2):
        before = {t: list(v) for t, v in tops.items()}
        for top, forks in before.items():
            for cost, audit in forks:
                _merge(tops, _shift(top, _expected(top)), cost + INSERT, audit + "i")
    return tops


def repair(roles: list[str], texts: list[str]) -> tuple[int, str, list[tuple[str, str]]]:
    """(cost, audit, repaired rows) of the cheapest repair; ties go to the ASCII-least audit."""
    found = faults(roles, texts)
    tops = _inserts({"0": [(0, "")]})
    for role, fault in zip(roles, found):
        extra = TRUNCATED if fault == "truncated" else 0
        nxt: dict = {}
        for top, forks in tops.items():
            for cost, audit in forks:
                _merge(nxt, top, cost + DELETE, audit + "d")
                if fault in ("blank", "duplicate"):
                    continue
                kept = _shift(top, role[:1])
                if kept is not None:
                    _merge(nxt, kept, cost + KEEP + extra, audit + "k")
                _merge(nxt, _shift(top, _expected(top)), cost + REROLE + extra, audit + "r")
        tops = _inserts(nxt)
    best = min((fork for top in ACCEPTING for fork in tops.get(top, [])), key=lambda f: (f[0], f[1]))
    return best[0], best[1], _replay(best[1], roles, texts)


def _replay(audit: str, roles: list[str], texts: list[str]) -> list[tuple[str, str]]:
    top, row, out = "0", 0, []
    for action in audit:
        if action == "i":
            top = _shift(top, _expected(top))
            out.append((ROLE_NAME[top], ""))
            continue
        role, text = roles[row], texts[row]
        row += 1
        if action == "k":
            top = _shift(top, role[:1])
            out.append((role, text))
        elif action == "r":
            top = _shift(top, _expected(top))
            out.append((ROLE_NAME[top], text))
    return out


def illegal_pairs(roles: list[str]) -> int:
    """Adjacent rows whose role initials are not su, ua or au."""
    pairs = zip((r[:1] for r in roles), (r[:1] for r in roles[1:]))
    return sum(1 for a, b in pairs if a + b not in ("su", "ua", "au"))


SCHEMA = (
    "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)


def _one(conv_id, rows: pd.DataFrame) -> tuple:
    rows = rows.sort_values(["_null_turn", "turn", "role", "text"], ascending=[False, True, True, True], kind="stable")
    roles, texts = rows["role"].tolist(), rows["text"].tolist()
    found = faults(roles, texts)
    cost, audit, repaired = repair(roles, texts)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode("utf-8")).hexdigest()
    counts = (found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal_pairs(roles))
    return (conv_id, *counts, cost, audit, digest)


def _repair_groups(rows: pd.DataFrame) -> pd.DataFrame:
    """Every conversation of a task, one after another."""
    groups = rows.groupby(["_null_conv", "conv_id"], sort=False)
    out = [_one(None if null else c, g) for (null, c), g in groups]
    names = ["conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    ids = pd.array([r[0] for r in out], dtype="Int64")
    return pd.DataFrame(out, columns=names).assign(conv_id=ids)


def damage(conversations: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) after damage by ``crc32('conv_id:turn') % 20``.

    Nulls are one space first (also in the key). 0 drops the row, 1 empties its text, 2 removes its
    ``.``, ``!`` and ``?``, 3 repeats it (same turn), 4 makes its role user; other values leave it.
    """
    space = F.lit(" ")
    rows = pick(conversations, "conv_id", "turn", "role", "text").select(
        "conv_id",
        "turn",
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        F.pmod(
            F.crc32(
                F.concat(
                    F.coalesce(F.col("conv_id").cast("string"), space),
                    F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), space),
                ).cast("binary")
            ),
            F.lit(20),
        ).alias("_damage"),
    )
    d = F.col("_damage")
    return rows.filter(d != 0).select(
        "conv_id",
        "turn",
        F.when(d == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(d == 1, F.lit("")).when(d == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(d == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    )


def repair_conversations(conversations: DataFrame, rows_per_task: int = 20000) -> DataFrame:
    """op13's result for every conv_id of ``conversations`` (null included, as its own conversation).

    Rows of a conversation are taken by turn, null turns first, ties by role and text. ``gaps`` is
    ``max - min + 1 - distinct`` over non-null turns after damage (0 if none); a conversation whose
    rows were all dropped has zeros, an empty audit and the digest of the empty string. Repeated rows
    are rows of their own (the later is a duplicate). Other columns are ignored; an empty table gives
    an empty result. A task repairs whole conversations of about ``rows_per_task`` rows in turn.
    """
    damaged = damage(conversations)
    # Tasks of a bounded number of rows, each with whole conversations; the count is a cheap scan.
    tasks = max(1, -(-2 * conversations.count() // rows_per_task))
    task = F.pmod(F.xxhash64("conv_id"), F.lit(tasks))
    # Nulls travel as flags: pandas would make a whole-number column with nulls float, exact to 2^53 only.
    repaired = (
        damaged.select(
            task.alias("_task"),
            F.col("conv_id").isNull().alias("_null_conv"),
            F.coalesce("conv_id", F.lit(0)).alias("conv_id"),
            F.col("turn").isNull().alias("_null_turn"),
            F.coalesce("turn", F.lit(0)).alias("turn"),
            "role",
            "text",
        )
        .repartition(tasks, "_task")
        .groupBy("_task")
        .applyInPandas(lambda rows: _repair_groups(rows.drop(columns="_task")), SCHEMA)
    )
    # In decimals: the span of turns plus 1 can pass the largest long where the gaps do not.
    last, first = F.max("turn").cast("decimal(20,0)"), F.min("turn").cast("decimal(20,0)")
    gaps = damaged.groupBy("conv_id").agg(
        F.coalesce(last - first + 1 - F.countDistinct("turn"), F.lit(0)).alias("gaps")
    )
    every = pick(conversations, "conv_id").distinct()
    gaps = gaps.withColumnRenamed("conv_id", "_g")
    repaired = repaired.withColumnRenamed("conv_id", "_r")
    out = every.join(gaps, F.col("conv_id").eqNullSafe(F.col("_g")), "left")
    out = out.join(repaired, F.col("conv_id").eqNullSafe(F.col("_r")), "left")
    zero = F.lit(0).cast("long")
    return out.select(
        "conv_id",
        F.coalesce(F.col("gaps").cast("long"), zero).alias("gaps"),
        *[F.coalesce(c, zero).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def repair_query(conversations: DataFrame) -> DataFrame:
    """op13: every conversation of the table, damaged and repaired.

    The query's audit has the initials of its edits' names, Keep, Rerole, Delete and Insert, in
    capitals; their ASCII order is that of the operator's action letters, so ties fall the same way.
    """
    return repair_conversations(conversations).withColumn("audit", F.upper("audit"))
