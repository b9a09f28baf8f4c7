"""Linked vectors against all pairs."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest

from casefile.llm import vector_links
from casefile.llm.queries import SQL


def plain(rows, least=0.9):
    """(vec_id, n_links, component_id, kept) in the order of the rows."""
    good = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    units = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if g else None for (_, v), g in zip(rows, good, strict=True)]
    n, group, links = len(rows), list(range(len(rows))), [0] * len(rows)
    for a in range(n):
        for b in range(a):
            if good[a] and good[b] and len(units[a]) == len(units[b]) and units[a] @ units[b] >= least:
                links[a] += 1
                links[b] += 1
                if group[a] != group[b]:
                    old = group[a]
                    group = [group[b] if g == old else g for g in group]
    out = []
    for i, (vec_id, _) in enumerate(rows):
        label = min((rows[j][0] for j in range(n) if group[j] == group[i] and rows[j][0] is not None), default=None)
        out.append((vec_id, links[i], label, vec_id == label))
    return out


def planted(width=16, seed=4, spread=0.5):
    """Lonely vectors, groups of near copies from two to sixty, a chain whose ends are far apart, exact copies."""
    rng, rows = np.random.default_rng(seed), []
    for size in [1] * 80 + [2] * 12 + [7] * 4 + [60]:
        centre = rng.normal(size=width)
        rows += [centre + spread * rng.normal(size=width) / math.sqrt(width) * (size > 1) for _ in range(size)]
    angle = np.linspace(0, 1.9, 8)
    rows += [np.concatenate([[math.cos(t), math.sin(t)], np.zeros(width - 2)]) for t in angle]
    rows += [rows[3], rows[3], rows[90]]
    order = rng.permutation(len(rows))
    return [(int(1000 + i), [float(np.float32(x)) for x in rows[j]]) for i, j in enumerate(order)]


SCHEMA = "vec_id long, embedding array<{}>, label int, key string, n long, cell int"


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 1, "x", 5, 2) for i, v in rows], SCHEMA.format(kind))


@pytest.mark.parametrize(("width", "kind", "cell"), [(16, "float", 4), (16, "double", 64), (5, "double", 8), (2, "float", 8)])
def test_links_equal_all_pairs(spark, width, kind, cell):
    rows = planted(width)
    got = vector_links.linked_vectors(frame(spark, rows, kind), cell=cell, recall=1.0)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect())) == sorted(plain(rows))


def test_small_blocks(spark, monkeypatch):
    """Cells cut into many blocks, with guests in blocks of their own, give the same sums."""
    monkeypatch.setattr(vector_links, "BLOCK", 7)
    rows = planted(12, seed=9, spread=0.7)
    got = vector_links.linked_vectors(frame(spark, rows), cell=20, recall=1.0)
    assert sorted(map(tuple, got.collect())) == sorted(plain(rows))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [1.0, -0.0]), (None, [2.0, 0.0]), (None, None)]
    rows += [(9, [1.0, 0.0, 0.0]), (10, [1.0, 0.0, 0.1]), (11, [3.0]), (12, [5.0]), (13, [-5.0]), (14, [1e200, 1e200]), (15, [1e-200, 1e-200]), (None, [0.0, -1.0])]
    got = vector_links.linked_vectors(frame(spark, rows, "double"))
    key = lambda r: tuple((x is None, x or 0) for x in r)
    want = [(i, n, c, k) for i, n, c, k in plain([(i, [x / 1e200 for x in v] if i == 14 else [x * 1e200 for x in v] if i == 15 else v) for i, v in rows])]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert vector_links.linked_vectors(frame(spark, []), 0.9).count() == 0
    assert vector_links.linked_vectors(frame(spark, rows[:5], "double")).filter("kept and n_links = 0").count() == 5


def test_search_order_and_number_of_cells(spark):
    rng = np.random.default_rng(2)
    index = vector_links.MultiIndex((rng.normal(size=(9, 3)), rng.normal(size=(9, 4))), 7)
    near = index.distances(rng.normal(size=(20, 7)))
    for row, (a, b) in enumerate(zip(*near, strict=True)):
        order = np.argsort((a[:, None] + b[None, :]).ravel(), kind="stable")
        for cells in (1, 3, 10, 81):
            seen = index.visited(near, cells)[row]
            assert seen.tolist() == order[:cells].tolist()
            assert index.rank(tuple(d[[row]] for d in near), seen[-1:]).tolist() == [cells - 1]
    found = spark.createDataFrame([(0, 0, 9), (0, 4, 1), (1, 0, 1), (2, 7, 2)], "query long, rank long, n long")
    assert [vector_links.cells_needed(found, r) for r in (0.5, 0.64, 0.9, 1.0)] == [1, 5, 8, 8]
    assert vector_links.cells_needed(found.limit(0), 1.0) == 1


def test_recall_with_chosen_cells(spark):
    """With the production target the index finds at least 0.9 of all links, and none that is not one."""
    rng, rows = np.random.default_rng(1), []
    for size in [1] * 1500 + [3] * 250:
        centre = rng.normal(size=24)
        rows += [centre + 0.3 * rng.normal(size=24) * (size > 1) for _ in range(size)]
    rows = [(i, r.tolist()) for i, r in enumerate(rows)]
    units = np.array([r for _, r in rows])
    units /= np.linalg.norm(units, axis=1)[:, None]
    want = (units @ units.T >= 0.9).sum(axis=1) - 1
    got = vector_links.linked_vectors(frame(spark, rows, "double"), cell=8, query_rows=400).toPandas().set_index("vec_id")["n_links"].sort_index().to_numpy()
    assert (got <= want).all() and got.sum() >= 0.9 * want.sum() > 0


def test_sql_says_the_same(spark):
    rows = planted(8, seed=6)
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", [list(r) for r in rows])
    want = sorted((i, n, c, k) for i, n, c, k in con.execute(f"SELECT vec_id, n_links, component_id, kept FROM ({SQL['op11_vector_links']})").fetchall())
    assert sorted(map(tuple, vector_links.linked_vectors(frame(spark, rows), recall=1.0).collect())) == want
