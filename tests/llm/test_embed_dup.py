"""op11: cross-polytope near-duplicate embeddings against all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest

from arealens.llm import embed_dup


def brute(rows, threshold=0.98):
    """All pairs of valid rows within a label and dimension; components by union-find."""
    def valid(vec, label):
        return (
            label is not None and vec is not None and len(vec) > 0
            and all(c is not None and math.isfinite(c) for c in vec) and any(c != 0 for c in vec)
        )

    ok = [k for k, (_, vec, label) in enumerate(rows) if valid(vec, label)]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = [0] * len(rows)
    for a_at, a in enumerate(ok):
        for b in ok[a_at + 1 :]:
            (_, u, lu), (_, v, lv) = rows[a], rows[b]
            if lu != lv or len(u) != len(v):
                continue
            x, y = np.asarray(u, np.float64), np.asarray(v, np.float64)
            if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    least = {}
    for k, (vec_id, _, _) in enumerate(rows):
        if vec_id is not None:
            root = find(k)
            least[root] = min(least.get(root, vec_id), vec_id)
    out = []
    for k, (vec_id, _, _) in enumerate(rows):
        component = least.get(find(k))
        out.append((vec_id, links[k], component, component == vec_id))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0))


def cluster_rows(seed=3, groups=12, per=30, dim=64):
    rng = np.random.default_rng(seed)
    rows, vid = [], 0
    for g in range(groups):
        centre = rng.normal(size=dim)
        spread = rng.choice([0.02, 0.08, 0.2])
        for _ in range(per):
            v = centre + spread * rng.normal(size=dim) * np.linalg.norm(centre) / np.sqrt(dim)
            rows.append((vid, [float(np.float32(c)) for c in v], int(g % 3)))
            vid += 1
    return rows


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = embed_dup.embedding_duplicates(df, **kw).collect()
    return sorted(
        [(r.vec_id, r.n_links, r.component_id, r.kept) for r in got],
        key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0),
    )


@pytest.mark.parametrize("block", [512, 7])
def test_clusters_equal_brute_force(spark, block):
    rows = cluster_rows()
    assert run(spark, rows, block=block) == brute(rows)


def test_awkward_rows(spark):
    base = cluster_rows(groups=2, per=5, dim=8)
    v = base[0][1]
    rows = base + [
        (100, None, 0),                    # null vector
        (101, [0.0] * 8, 0),               # zero vector
        (102, [float("nan")] + v[1:], 0),  # non-finite component
        (103, [None] + v[1:], 0),          # null component
        (104, v, None),                    # null label
        (105, [], 0),                      # empty vector
        (106, v[:4], 0),                   # other dimension: compared with nothing of dimension 8
        (None, v, 0),                      # null id: takes part
        (0, v, 0),                         # repeated row
        (107, v, 0),                       # exact copy
        (108, [c * 3 for c in v], 0),      # same direction
    ]
    got = run(spark, rows)
    assert got == brute(rows)
    by_id = {r[0]: r for r in got if r[0] in (100, 101, 102, 103, 104, 105)}
    assert all(r[1] == 0 and r[2] == r[0] and r[3] for r in by_id.values())


def test_hot_group_of_copies_and_near_copies(spark):
    rng = np.random.default_rng(9)
    centre = rng.normal(size=16)
    rows = [(k, [float(c) for c in centre], 1) for k in range(60)]
    rows += [(100 + k, [float(c) for c in centre + 0.01 * rng.normal(size=16)], 1) for k in range(60)]
    assert run(spark, rows, block=16) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_extra_clashing_columns(spark):
    rows = cluster_rows(groups=2, per=4, dim=8)
    df = spark.createDataFrame(
        [(r[0], r[1], r[2], "x", 1) for r in rows],
        "vec_id long, embedding array<float>, label int, node string, _row int",
    )
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embed_dup.embedding_duplicates(df).collect())
    assert got == brute(rows)
