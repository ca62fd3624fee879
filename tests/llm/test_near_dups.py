import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import spread
from hypothesis import given, settings
from hypothesis import strategies as st

from cuvee.llm import near_dups as nd
from cuvee.llm.wordhash import words_by_text

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
SCHEMA = "doc_id long, text string"


def word_list(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, size):
    w = word_list(text)
    size = min(size, len(w))
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if w else frozenset()


def brute(rows, size=2, percent=80):
    sets = {d: shingles(t, size) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            s, t = sets[a], sets[b]
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {(d, len(sets[d]), find(d), find(d) == d) for d in sets}


def family(rng, base, copies, edits, first):
    rows = []
    for k in range(copies):
        w = list(base)
        for _ in range(rng.integers(0, edits + 1)):
            w[rng.integers(len(w))] = f"new{rng.integers(10**6)}"
        rows.append((first + k, " ".join(w)))
    return rows


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    found = []
    for f in range(4):
        base = [f"w{rng.integers(400)}" for _ in range(60)]
        found += family(rng, base, 40, 8, 1000 * f)
    found += [(9000 + k, "the very same text as all the others") for k in range(30)]
    found += [(9100, None), (9101, ""), (9102, "  \n "), (9103, "one"), (9104, "ONE"), (9105, "two words"), (9106, "Two\twords")]
    found += [(9200 + k, " ".join(f"u{k}x{i}" for i in range(20))) for k in range(20)]
    return found


def result(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    found = nd.near_duplicates(df, nd.Settings(shingle_words=2, **options))
    return {tuple(r) for r in found.select("doc_id", "n_shingles", "component_id", "kept").collect()}


def test_equals_brute_force(spark, rows):
    assert result(spark, rows) == brute(rows)


def test_blocks_of_a_few_rows_give_the_same(spark, rows):
    """Buckets that are worked through in many small blocks lose no link."""
    assert result(spark, rows, block=7) == brute(rows)


def test_partitions_do_not_matter(spark, rows):
    df = spread(spark.createDataFrame(rows, SCHEMA), 13)
    assert {tuple(r) for r in nd.near_duplicates(df, nd.Settings(shingle_words=2)).collect()} == brute(rows)


def test_residual_links_join_what_the_star_leaves(spark):
    """The center of the bucket is like nobody, the others are like each other."""
    base = [f"w{i}" for i in range(100)]
    rows = [(1, " ".join(base[:70] + [f"x{i}" for i in range(30)]))]
    rows += [(k, " ".join([*base[:97], f"y{k}", *base[98:]])) for k in range(2, 30)]
    assert result(spark, rows) == brute(rows)


def test_five_words_by_default(spark):
    text = " ".join(f"w{i}" for i in range(200))
    rows = [(1, text), (2, text + " more"), (3, " ".join(f"w{i}" if i % 9 else "z" for i in range(200)))]
    found = nd.near_duplicates(spark.createDataFrame(rows, SCHEMA)).orderBy("doc_id").collect()
    assert [(r.component_id, r.kept) for r in found] == [(1, True), (1, False), (3, True)]


def test_repeated_ids_null_ids_and_other_columns(spark):
    rows = [(1, "a b c d", 5, "x"), (1, "a b c d", 6, "y"), (2, "a b c d", 7, "z"), (None, "a b c d", 8, "n"), (None, None, 9, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, id int, bands string")
    found = nd.near_duplicates(df, nd.Settings(shingle_words=2)).collect()
    assert sorted(map(tuple, found)) == [(1, 3, 1, True), (2, 3, 1, False)]


def test_empty_table(spark):
    assert result(spark, []) == set()


def test_long_texts(spark):
    long = " ".join(f"word{i % 5000}" for i in range(300_000))
    rows = [(1, long), (2, long + " end"), (3, "x" * 3_000_000), (4, "X" * 3_000_000)]
    found = {r[0]: r for r in result(spark, rows)}
    assert found[1][1] == 5000 and found[2][2:] == (1, False) and found[4][2:] == (3, False)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbB é\t\n\x0b\x1c ß", max_size=40)), max_size=8))
def test_word_hashes_tell_words_apart(texts):
    seen = {}
    for row, hashes in words_by_text(pa.array(texts, pa.string())):
        words = word_list(texts[row])
        assert len(words) == len(hashes)
        for w, h in zip(words, hashes.tolist()):
            assert seen.setdefault(h, w) == w
    assert len(set(seen.values())) == len(seen)


def test_min_max_estimates_similarity():
    rng = np.random.default_rng(1)
    both, one, two = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (800, 100, 100))
    chosen = nd._factors(nd.Settings(permutations=400))
    a = nd.min_max(np.unique(np.concatenate([both, one])), chosen)
    b = nd.min_max(np.unique(np.concatenate([both, two])), chosen)
    assert abs((a == b).mean() - 0.8) < 0.07
    assert Counter(a == b)[True] > 0
