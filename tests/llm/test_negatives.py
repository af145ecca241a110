"""Hard negatives against all pairs, and the certificates of the search."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import negatives
from tidemark.llm.negatives import Book, cells, half_bounds, hard_negatives

SHAPE = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100, low=30, high=90, positives=5, count=10):
    good = sorted({(v, l, tuple(int(np.floor(256 * float(np.float32(x)))) for x in e)) for v, e, l in rows
                   if v is not None and l is not None and e is not None and all(x is not None and np.isfinite(np.float32(x)) for x in e)})
    out = []
    for v, l, q in (g for g in good if g[0] % every == 0):
        score = lambda o, q=q: sum(a * b for a, b in zip(q, o[2]))
        reach = [o for o in good if o[0] != v and len(o[2]) == len(q)]
        for p in sorted((o for o in reach if o[1] == l), key=lambda o: (-score(o), o[0]))[:positives]:
            fits = [o for o in good if o[1] != l and len(o[2]) == len(q) and low * score(p) <= 100 * score(o) <= high * score(p)]
            for n, o in enumerate(sorted(fits, key=lambda o: (-score(o), o[0]))[:count], 1):
                out.append((v, p[0], n, o[0], score(p), score(o)))
    return sorted(out)


def mined(spark, rows, every=100, **more):
    got = hard_negatives(spark.createDataFrame(rows, SHAPE), F.col("vec") % every == 0, **more)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def near(rng, n, dims=16, centres=6):
    c = rng.standard_normal((centres, dims))
    x = c[rng.integers(0, centres, n)] + 0.3 * rng.standard_normal((n, dims))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def test_against_all_pairs_in_many_rounds(spark, monkeypatch):
    """Small cells, few cells a round, small blocks, parts and chunks: all steps of the search are met."""
    for name, value in {"CELL_ROWS": 8, "FIRST_CELLS": 3, "MOST_CELLS": 20, "CHUNK": 4, "HELD": 7, "PART_BLOCKS": 1}.items():
        monkeypatch.setattr(negatives, name, value)
    rng = np.random.default_rng(3)
    rows = [(i, e.tolist(), int(i % 4)) for i, e in enumerate(near(rng, 700))]
    want = brute(rows, every=20)
    assert mined(spark, rows, every=20) == want and len(want) > 500


def test_ties_copies_and_a_hot_vector(spark):
    """A third of all rows hold one vector, in two labels: scores tie, and the smaller ids come first."""
    rng = np.random.default_rng(4)
    hot = near(rng, 1)[0].tolist()
    rows = [(i, hot if i % 3 == 0 else e.tolist(), int(i % 2 + (i % 5 == 0))) for i, e in enumerate(near(rng, 400))]
    assert mined(spark, rows, every=30) == brute(rows, every=30)


def test_awkward_rows(spark):
    rng = np.random.default_rng(5)
    x = [e.tolist() for e in near(rng, 60, dims=6)]
    rows = [(i, e, i % 3) for i, e in enumerate(x)]
    rows += [(0, x[0], 0), (0, x[1], 0), (10, x[2], 2),  # a repeated row, and ids with other vectors and labels
             (None, x[0], 1), (100, None, 1), (110, [None, 1.0], 1), (120, [float("nan")] * 6, 1), (130, [float("inf")] * 6, 0), (140, x[5], None),
             (150, [], 0), (151, [], 0), (152, [], 1), (200, [0.5, -0.5, 1.0], 0), (201, [0.5, 0.0, 1.0], 0), (202, [0.25, 0.0, 0.5], 1),
             (160, [0.0] * 6, 0), (170, [-y for y in x[3]], 0), (180, [5e5] * 5, 0), (181, [5e5] * 5, 0), (182, [4e5] * 5, 1)]
    assert mined(spark, rows, every=10) == brute(rows, every=10)
    assert mined(spark, [(100, [1e30, -1e30], 0), (1, [1e30, 0.0], 0), (2, [4e5, 0.0], 1)]) != []  # held, no overflow
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 1)]) == []
    assert mined(spark, [(100, [1.0], 1), (1, [1.0], 1)]) == []


def test_other_columns_and_text_labels(spark):
    rows = spark.createDataFrame([(100, [1.0, 0.0], "a"), (1, [0.9, 0.1], "a"), (2, [0.5, 0.5], "b")], "vec_id long, embedding array<double>, label string")
    clash = rows.selectExpr("*", "1 as q", "2 as dims", "3 as aid", "4 as slot")
    assert [tuple(r)[:4] for r in hard_negatives(clash, F.col("vec") % 100 == 0).collect()] == [(100, 1, 1, 2)]


def test_integers_too_wide_for_doubles():
    a, b = np.full((1, 64), negatives.LIMIT), np.full((1, 64), negatives.LIMIT - 1)
    assert negatives._product(a, b)[0, 0] == 64 * negatives.LIMIT * (negatives.LIMIT - 1)


@pytest.mark.parametrize("shape", [(1, 1), (4, 7), (9, 9), (0, 3)])
def test_cells_come_by_falling_bound_each_once(shape):
    rng = np.random.default_rng(6)
    a, b = (rng.integers(-4, 4, n).astype(float) for n in shape)
    a[:1] = -np.inf if len(a) > 2 else a[:1]
    got = list(cells((a, b)))
    assert [x[2] for x in got] == sorted((x[2] for x in got), reverse=True)
    assert sorted(x[:2] for x in got) == [(i, j) for i in range(len(a)) for j in range(len(b)) if np.isfinite(a[i])]


def test_bounds_hold_for_every_row():
    rng = np.random.default_rng(7)
    x = rng.integers(-200, 200, (500, 9)).astype(float)
    halves = negatives._halves(x)
    codes = tuple(negatives._codes(h, 8) for h in halves)
    at = [negatives._nearest(h, c) for h, c in zip(halves, codes)]
    radii = tuple(np.array([np.linalg.norm(h[a == k] - c[k], axis=1).max(initial=-1) for k in range(len(c))]) for h, c, a in zip(halves, codes, at))
    for q in rng.integers(-200, 200, (40, 9)).astype(float):
        first, second = half_bounds(q, Book(codes, radii))
        assert (first[at[0]] + second[at[1]] >= x @ q).all()
