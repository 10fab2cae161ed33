"""op13: the repair search against all edit sequences, the query against a plain version."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from arealens.llm import repair

GRAMMAR = re.compile(r"(s?(ua)+)?")
ROLES = ["system", "user", "assistant", " ", "usr", ""]
TEXTS = ["Hi.", "hi", " ", "", "ok!", "why?"]


def brute(roles, texts):
    """Every choice of action per row and of up to two inserted turns per gap; least (cost, audit)."""
    found = repair.faults(roles, texts)
    gaps = [()] + [(x,) for x in "ua"] + [(x, y) for x in "ua" for y in "ua"]
    per_row = []
    for role, text, fault in zip(roles, texts, found):
        options = [("d", None, None)]
        if fault not in ("blank", "duplicate"):
            options += [("k", role, text), ("r", "user", text), ("r", "assistant", text)]
        per_row.append(options)
    best = None
    for rows in itertools.product(*per_row):
        for inserted in itertools.product(gaps, repeat=len(roles) + 1):
            audit, out, cost = "", [], 0
            for k in range(len(roles) + 1):
                for x in inserted[k]:
                    audit += "i"
                    out.append(("user" if x == "u" else "assistant", ""))
                    cost += 3
                if k == len(roles):
                    break
                action, role, text = rows[k]
                audit += action
                cost += {"d": 4, "k": 0, "r": 3}[action]
                if action != "d":
                    out.append((role, text))
                    cost += 3 if found[k] == "truncated" else 0
            if not GRAMMAR.fullmatch("".join(r[:1] or "?" for r, _ in out)):
                continue
            if best is None or (cost, audit) < best[:2]:
                best = (cost, audit, out)
    return best


@pytest.mark.parametrize("seed", range(120))
def test_search_equals_all_sequences(seed):
    rng = random.Random(seed)
    n = rng.randint(0, 3)
    roles = [rng.choice(ROLES) for _ in range(n)]
    texts = [rng.choice(TEXTS) for _ in range(n)]
    cost, audit, out = repair.repair(roles, texts)
    assert (cost, audit, out) == brute(roles, texts)


def test_long_conversation_is_linear_enough():
    roles = ["user", "assistant"] * 5000
    texts = [f"turn {k}." for k in range(10000)]
    cost, audit, out = repair.repair(roles, texts)
    assert cost == 0 and audit == "k" * 10000


def plain(rows):
    """The contract in plain Python over (conv_id, turn, role, text) rows."""
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, [])
        r, x = (" " if r is None else r), (" " if x is None else x)
        key = f"{' ' if c is None else c}:{' ' if t is None else t}"
        d = zlib.crc32(key.encode()) % 20
        if d == 0:
            continue
        if d == 1:
            x = ""
        if d == 2:
            x = re.sub(r"[.!?]", "", x)
        if d == 4:
            r = "user"
        convs[c] += [(t, r, x)] * (2 if d == 3 else 1)
    out = []
    for c, got in convs.items():
        got.sort(key=lambda g: (g[0] is not None, g[0] or 0, g[1], g[2]))
        turns = [g[0] for g in got if g[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        roles, texts = [g[1] for g in got], [g[2] for g in got]
        f = repair.faults(roles, texts)
        cost, audit, fixed = repair.repair(roles, texts) if got else (0, "", [])
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        out.append((c, gaps, f.count("blank"), f.count("duplicate"), f.count("truncated"),
                    repair.illegal_pairs(roles), cost, audit, digest))
    return sorted(out, key=repr)


def run(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return sorted((tuple(r) for r in repair.repair_conversations(df).collect()), key=repr)


def test_query_equals_plain_version(spark):
    rng = random.Random(5)
    rows = []
    for c in range(150):
        for t in range(rng.randint(1, 7)):
            rows.append((c, t if rng.random() > 0.05 else None, rng.choice(ROLES + [None]), rng.choice(TEXTS + [None])))
    rows += [(None, 0, "user", "hello."), (None, 1, "assistant", "hi."), (500, 3, "user", "a."), (500, 3, "user", "a.")]
    assert run(spark, rows) == plain(rows)


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, []) == []
    df = spark.createDataFrame(
        [(1, 0, "user", "Hello.", "x", 1)], "conv_id long, turn long, role string, text string, audit string, _copy int"
    )
    assert sorted(tuple(r) for r in repair.repair_conversations(df).collect()) == plain([(1, 0, "user", "Hello.")])


def query(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return {r["conv_id"]: r for r in repair.repair_query(df).collect()}


def test_query_audit_has_the_initials_of_the_edit_names(spark):
    # Damage (crc32 % 20) leaves the rows of conversation 4 as they are.
    rows = [(4, 0, "user", "Hello."), (4, 1, "user", "Why?"), (4, 2, "user", " "), (4, 3, "assistant", "So.")]
    assert all(zlib.crc32(f"{c}:{t}".encode()) % 20 > 4 for c, t, _, _ in rows)
    got = query(spark, rows)[4]
    # The blank row is deleted (4); an inserted assistant turn (3) is cheaper than a second deletion.
    assert (got["cost"], got["audit"]) == (7, "KIKDK")
    fixed = "user:Hello.\nassistant:\nuser:Why?\nassistant:So."
    assert got["repaired_sha256"] == hashlib.sha256(fixed.encode()).hexdigest()


def test_large_numbers_beside_nulls_stay_exact(spark):
    big = 2**53
    rows = [(None, 0, "user", "a."), (None, None, "user", "b.")]
    for c in range(big, big + 40):
        rows += [(c, t, r, f"{t}.") for t, r in ((big + 1, "assistant"), (big, "user"), (None, "system"))]
    assert run(spark, rows) == plain(rows)


def test_gaps_up_to_the_largest_turn(spark):
    rows = [(c, t, "user", "a.") for c in range(20) for t in (0, 2**63 - 1)]
    assert run(spark, rows) == plain(rows)
