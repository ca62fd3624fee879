import random

import numpy as np
import pytest
from conftest import spread
from hypothesis import given, settings
from hypothesis import strategies as st

from cuvee.llm import suffix_dedup as sd

SCHEMA = "doc_id long, text string"


def brute(rows, length=50):
    first = {}
    for i, text in rows:
        b = (text or "").encode()
        for p in range(len(b) - length + 1 if i is not None else 0):
            w = b[p : p + length]
            first[w] = min(i, first.get(w, i))
    out = []
    for i, text in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - length + 1 if i is not None else 0):
            if first[b[p : p + length]] < i:
                gone[p : p + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone]).astype(int)))
        spans = tuple((int(a), int(z - a)) for a, z in zip(edges[::2], edges[1::2]))
        out.append((i, len(b), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return sorted(out, key=repr)


def result(spark, rows, **options):
    df = rows if hasattr(rows, "columns") else spark.createDataFrame(rows, SCHEMA)
    found = sd.remove_repeats(df, sd.Settings(**options)).collect()
    return sorted(((r.doc_id, r.n_bytes, tuple(tuple(s) for s in r.spans), bytes(r.kept)) for r in found), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)

    def prose(n):
        return "".join(rng.choice(["vin ", "très ", "rouge", "tannic ", "oak", "\n", "é", "smooth and ", "日本 ", "x"]) for _ in range(n))

    passage, line = prose(40), "All rights reserved by the makers of this wine, whoever they may be. "
    found = [(i, prose(rng.randrange(60))) for i in range(40)]
    found += [(100 + i, prose(12) + passage[rng.randrange(20) : 60 + rng.randrange(90)] + prose(9)) for i in range(15)]
    found += [(200 + i, prose(5) + line + prose(5)) for i in range(25)]
    copy = prose(50)
    found += [(300 + i, copy) for i in range(6)] + [(310 + i, copy[:i] + "#" + copy[i + 1 :]) for i in range(0, 120, 17)]
    found += [(5, found[3][1]), (5, found[4][1]), (305, copy), (7, found[7][1]), (None, copy), (None, passage), (6, None), (8, ""), (9, "a" * 49)]
    found += [(400, "a" * 700), (401, "b" + "a" * 600 + "c"), (402, "ab" * 200), (399, "ab" * 30), (403, line * 9), (404, line + "z" + line)]
    found += [(500, "\x00" * 80 + "end"), (501, "x" + "\x00" * 70), (-3, passage + "!"), (600, prose(4000) + copy), (601, copy + prose(3000))]
    return found


@pytest.mark.parametrize(
    "options",
    [{}, {"shard_bytes": 300, "hot": 3, "row_windows": 7}, {"array_bytes": 400, "shard_bytes": 1 << 22}, {"length": 24, "hot": 1, "shard_bytes": 5000}],
)
def test_equals_brute_force(spark, rows, options):
    expected = brute(rows, options.get("length", 50))
    assert sum(len(r[2]) > 0 for r in expected) > 40
    assert result(spark, rows, **options) == expected


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_does_not_depend_on_the_order_of_rows(spark, rows, parts):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("doc_id", "text", "text AS t", "'x' AS id", "1 AS h", "2 AS spans", "'y' AS kept")
    assert result(spark, spread(df, parts), hot=8) == brute(rows)


def test_small_batches(spark, rows):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "5")
    try:
        assert result(spark, rows, hot=8) == brute(rows)
    finally:
        spark.conf.set(name, before)


def test_tables_without_rows_or_repeats(spark):
    assert result(spark, []) == []
    assert result(spark, [(1, None), (2, "short")]) == brute([(1, None), (2, "short")])


def test_a_text_longer_than_a_piece(spark, monkeypatch):
    monkeypatch.setattr(sd, "_PIECE", 64)  # of this process; the workers keep theirs
    data = np.frombuffer(random.Random(1).randbytes(5000).hex().encode(), np.uint8)
    ends = np.array([0, 3000, 3010, 10_000])
    small = sd.window_runs(data, ends, 50)
    monkeypatch.setattr(sd, "_PIECE", 1 << 18)
    large = sd.window_runs(data, ends, 50)

    def windows(runs):
        return [(p, v) for f, n, v in zip(*runs) for p in range(f, f + n)]

    assert windows(small) == windows(large)
    assert [p for p, _ in windows(large)] == [*range(2951), *range(3010, 9951)]
    text = random.Random(2).randbytes(300_000).hex()
    rows = [(1, text), (2, "x" + text[200_000:400_000] + "y"), (0, text[599_900:])]
    found = result(spark, rows)
    assert [r[2] for r in found] == [(), ((599_900, 100),), ((1, 200_000),)]


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 300), st.integers(1, 4), st.sampled_from([5, 24, 50]), st.booleans(), st.integers(0, 10**6))
def test_suffix_arrays_and_common_prefixes(n, letters, depth, tiled, seed):
    rng = np.random.default_rng(seed)
    data = rng.integers(97, 97 + letters, n).astype(np.uint8)
    data = np.tile(data[: n // 6 + 1], 8)[:n] if tiled else data
    text, order = data.tobytes(), sd.suffix_array(data, depth)
    assert sorted(order.tolist()) == list(range(n))
    heads = [text[i : i + depth] for i in order]
    assert heads == sorted(heads)
    starts = np.unique(np.append(0, rng.integers(0, n, 3)))
    shared = sd.common_prefixes(data, order, starts, 512)
    for a, b, m in zip(order, order[1:], shared[1:]):
        x, y = text[a:], text[b:]
        equal = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        assert m == equal or equal == min(len(x), len(y)) <= m


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=24, max_size=60), min_size=1, max_size=25, unique=True), st.sampled_from([80, 200, 10_000]), st.integers(0, 99))
def test_least_id_of_every_window(strings, array_bytes, seed):
    ids = np.random.default_rng(seed).integers(0, 50, len(strings))
    encoded = [s.encode() for s in strings]
    least = {}
    for s, i in zip(encoded, ids):
        for p in range(len(s) - 23):
            least[s[p : p + 24]] = min(int(i), least.get(s[p : p + 24], 99))
    found = sd.repeated_windows(encoded, ids, sd.Settings(length=24, array_bytes=array_bytes))
    assert found.tolist() == [least[s[p : p + 24]] for s in encoded for p in range(len(s) - 23)]
