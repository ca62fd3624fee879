import math

import numpy as np
import pytest
from conftest import spread
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cuvee.llm import topk

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k, every=20):
    usable = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable.append((i, [math.floor(64 * float(np.float32(x))) for x in v]))
    found = []
    for a, (q, v) in enumerate(usable):
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(v, w)), i) for b, (i, w) in enumerate(usable) if a != b and len(w) == len(v))
            found += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(found)


def result(spark, rows, every=20, **options):
    df = rows if hasattr(rows, "columns") else spark.createDataFrame(rows, SCHEMA)
    found = topk.search(df, F.pmod("vec_id", F.lit(every)) == 0, topk.Settings(**options))
    return sorted(tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect())


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(5, 16))
    found = [(i, (centers[i % 5] + rng.normal(size=16) * 0.2).round(3).tolist()) for i in range(300)]
    found += [(1000 + i, found[3][1]) for i in range(80)]
    found += [(2000, None), (2001, []), (2020, []), (2002, [1.0, None]), (2003, [1.0, float("nan")]), (2004, [float("inf"), 1.0])]
    return found + [(2005, [1.0, -2.0]), (2040, [0.5, 0.25]), (None, [1.0, 1.0])]


@pytest.mark.parametrize("block", [(2048, 8192), (7, 50)])
def test_equals_brute_force(spark, rows, block):
    found = result(spark, rows, k=20, query_block=block[0], candidate_block=block[1], chunk=5)
    assert found == brute(rows, 20)


def test_fewer_than_k_and_repeated_rows(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], SCHEMA + ", dim int, cb string")
    one = [(0, 1, 0, 64 * 64 * 5), (0, 2, 1, 64 * 64 * 5), (0, 3, 2, 64 * 64 * 5)]
    assert result(spark, df) == brute(rows, 20) == sorted(one * 2)


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_rows_that_share_an_id_are_all_candidates(spark, rows, parts):
    more = rows + [(3, [5.0] * 16), (20, [4.0] * 16), (7, rows[8][1]), (40, rows[41][1]), (40, rows[40][1])]
    df = spread(spark.createDataFrame(more, SCHEMA), parts)
    assert result(spark, df, k=9, query_block=7, candidate_block=50) == brute(more, 9)


def test_empty_table(spark):
    assert result(spark, []) == []


def test_doubles_beyond_the_exact_range(spark):
    assert result(spark, spark.createDataFrame([(0, [2e7, 1.0]), (1, [2e7, 3.0])], "vec_id long, embedding array<double>")) == [
        (0, 1, 1, (128 * 10**7) ** 2 + 64 * 192)
    ]
    rows = [(0, [1e9, 1.0]), (1, [1e9, 3.0]), (2, [-1e300, 1.0]), (3, [1e300, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r[2]: r[3] for r in result(spark, df)}
    assert found[1] == 2**63 - 1
    assert found[3] == 2**63 - 1 and found[2] == 1 - 2**63


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 20), st.integers(0, 10**6))
def test_bound_is_never_below_the_product(dim, segments, seed):
    rng = np.random.default_rng(seed)
    q, x = rng.integers(-200, 200, (2, 6, dim)).astype(float)
    bound = topk.statistics(q, segments) @ topk.statistics(x, segments).T
    assert (bound + 1e-6 * np.abs(bound) + 1e-6 >= q @ x.T).all()


def test_coarse_bounds_leave_out_most(spark):
    """Vectors around few centers: the statistics drop whole clusters before the products."""
    rng = np.random.default_rng(1)
    level = np.repeat(rng.normal(size=(4, 8)) * 40, 8, axis=1)
    x = np.floor(level[np.arange(400) % 4] + rng.normal(size=(400, 64)))
    bound = topk.statistics(x[:20], 8) @ topk.statistics(x, 8).T
    floor = np.sort(x[:20] @ x.T, axis=1)[:, -20]
    assert (bound >= floor[:, None]).mean() < 0.5
