import math

import numpy as np
import pytest
from conftest import spread
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cuvee.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every, s=hn.Settings()):
    usable = [
        (i, [math.floor(s.scale * float(np.float32(x))) for x in v], y)
        for i, v, y in rows
        if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    last = float("inf")
    found = []
    for a, (i, v, y) in enumerate(usable):
        if i is None or i % every:
            continue
        scored = [
            (-sum(p * q for p, q in zip(v, w)), last if j is None else j, j, z)
            for b, (j, w, z) in enumerate(usable)
            if b != a and len(w) == len(v)
        ]
        scored.sort(key=lambda t: t[:2])
        for ps, _, p, z in [t for t in scored if t[3] == y][: s.positives]:
            near = [t for t in scored if t[3] != y and s.low * -ps <= 100 * -t[0] <= s.high * -ps]
            found += [(i, p, r, t[2], -ps, -t[0]) for r, t in enumerate(near[: s.negatives], 1)]
    return sorted(found, key=repr)


def result(spark, rows, every, **options):
    df = rows if hasattr(rows, "columns") else spark.createDataFrame(rows, SCHEMA)
    return sorted((tuple(r) for r in hn.mine(df, F.pmod("vec_id", F.lit(every)) == 0, hn.Settings(**options)).collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(4, 12))
    found = [(i, (centers[(i * 7) % 4] + rng.normal(size=12) * 0.6).round(3).tolist(), int(rng.integers(0, 3))) for i in range(240)]
    found += [(5, found[5][1], found[5][2]), (10, found[11][1], found[11][2])]
    found += [(300 + i, found[20][1], i % 2) for i in range(30)]  # copies of an anchor: ties
    found += [(20, found[21][1], 1), (20, found[20][1], found[20][2]), (None, found[30][1], 0), (None, found[30][1], 1), (None, found[40][1], 2)]
    found += [(400, None, 1), (420, [], 1), (421, [], 2), (440, [1.0, None], 1), (460, [1.0, float("nan")], 1), (480, [float("inf")], 1)]
    return found + [(500, [1.0, 2.0], None), (520, [1.0, 2.0], 7), (521, [1.0, 2.5], 7), (522, [0.5, 0.5], 8), (540, [3.0], 9)]


@pytest.mark.parametrize("sizes", [{}, {"anchor_block": 3, "candidate_block": 40, "chunk": 16}, {"positives": 2, "negatives": 3, "chunk": 7}])
def test_equals_brute_force(spark, rows, sizes):
    expected = brute(rows, 10, hn.Settings(**sizes))
    assert len(expected) > 100
    assert result(spark, rows, 10, **sizes) == expected


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_does_not_depend_on_the_order_of_rows(spark, rows, parts):
    df = spread(spark.createDataFrame(rows, SCHEMA).withColumn("row", F.lit(3)).withColumn("block", F.lit("x")), parts)
    assert result(spark, df, 20) == brute(rows, 20)


def test_tables_without_rows_anchors_or_positives(spark):
    assert result(spark, [], 10) == []
    assert result(spark, [(1, [1.0], 0), (2, [1.0], 1)], 10) == []
    assert result(spark, [(10, [1.0], 0), (2, [0.5], 1)], 10) == []
    # A positive below zero has no window; one of zero takes negatives of zero.
    assert result(spark, [(10, [1.0], 0), (1, [-1.0], 0), (2, [-0.5], 1)], 10) == []
    assert result(spark, [(10, [1.0], 0), (1, [0.0], 0), (2, [0.0], 1)], 10) == [(10, 1, 1, 2, 0, 0)]


def test_scores_beyond_the_exact_range_of_doubles(spark):
    rows = [(10, [3e7, 1.0], 0), (1, [3e6, 3.0], 0), (2, [1.5e6, 1.0], 1), (3, [-1e300, 1.0], 1), (4, [1e300, 1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    half = 256 * 256 * (45 * 10**12 + 1)
    assert result(spark, df, 10) == [(10, 1, 1, 2, 256 * 256 * (9 * 10**13 + 3), half), (10, 4, 1, 2, 2**63 - 1, half)]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 12), st.integers(1, 30), st.integers(1, 20), st.integers(0, 10**6))
def test_bounds_along_the_tree_lose_no_pair(dim, anchors, n, seed):
    rng = np.random.default_rng(seed)
    a, x = rng.integers(-50, 50, (anchors, dim)).astype(float), rng.integers(-50, 50, (n, dim)).astype(float)
    low = rng.integers(-3000, 3000, anchors).astype(float)
    high = low + rng.integers(0, 2000, anchors)
    allowed = rng.random((anchors, n)) < 0.7
    tree = hn.spanning_tree(a)
    assert sorted(np.concatenate(tree.levels).tolist()) == list(range(anchors))
    (rows, cols, scores), _ = hn.bounded_scores(tree, a, x, low, high, allowed)
    exact = a @ x.T
    expected = {(i, j, int(exact[i, j])) for i, j in zip(*np.nonzero(allowed & (exact >= low[:, None]) & (exact <= high[:, None])))}
    assert {(int(i), int(j), int(s)) for i, j, s in zip(rows, cols, scores)} == expected


def test_bounds_leave_out_most_pairs_of_near_anchors():
    rng = np.random.default_rng(2)
    center = rng.normal(size=32) * 100
    a = center + rng.normal(size=(64, 32))
    x = rng.normal(size=(500, 32)) * 30
    scores = a @ x.T
    low = np.sort(scores, axis=1)[:, -10]
    _, scored = hn.bounded_scores(hn.spanning_tree(a), a, x, low, np.full(64, np.inf), np.ones((64, 500), bool))
    assert scored < 0.2 * scores.size
