import random
import re
import zlib
from collections import Counter

import pytest
from conftest import spread
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cuvee.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute(rows, s):
    counts = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if s.damage and h % s.damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= s.min_length and c >= s.min_count}
    form, out = {}, []
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best and n[best] >= s.times * n[w]:
            form[w] = best
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out, key=repr)


def result(spark, rows, s):
    df = rows if hasattr(rows, "columns") else spark.createDataFrame(rows, "doc_id long, text string")
    found = spelling.variants(df, s).select("word", "form", "root", "n", "n_near", "form_n")
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    base = ["vineyard", "tasting", "chateau", "Château", "barrels", "garçon×s", "aaaaaaaa", "aaaaaaa", "mineral", "Minerals", "ÿéÀéîö"]
    found = [(None, None), (3, ""), (3, "short words of no use"), (None, "vineyard Vineyard VINEYARD tasting"), (7, "chateau " * 300)]
    found += [(800, "terroirs " * 200), (801, "terroir " * 30), (802, "Terrair " * 5)]
    for i in range(300):
        words = []
        for _ in range(30):
            w = rng.choice(base[: 1 + rng.randrange(len(base))])
            if rng.random() < 0.25:
                p = rng.randrange(len(w))
                w = rng.choice([w[:p] + w[p + 1 :], w[:p] + rng.choice("abxé") + w[p + rng.randrange(2) :]])
            words.append(w)
        found.append((i // 2, rng.choice([" ", "-", "1"]).join(words)))
    return found + found[-40:]


@pytest.mark.parametrize("options", [{"damage": 199}, {"damage": 3, "group": 4}, {"min_length": 2, "min_count": 2, "group": 1}])
def test_equals_brute_force(spark, rows, options):
    s = spelling.Settings(**options)
    expected = brute(rows, s)
    assert any(f for _, f, *_ in expected) and any(r != f for _, f, r, *_ in expected if f)
    assert result(spark, rows, s) == expected


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_does_not_depend_on_the_order_of_rows(spark, rows, parts):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "text AS word", "1 AS n", "'x' AS id")
    s = spelling.Settings(damage=199)
    assert result(spark, spread(df, parts), s) == brute(rows, s)


def test_empty_tables_and_no_words(spark):
    assert result(spark, [], spelling.Settings()) == []
    assert result(spark, [(1, "one two"), (2, None)], spelling.Settings()) == []


def test_hot_groups_are_cut_on(spark):
    """Many words that share three quarters: pairs are met in groups of one free letter, and none is lost."""
    rng = random.Random(1)
    words = sorted({"commonbeginning" + "".join(rng.choice("abc") for _ in range(5)) for _ in range(200)})
    table = spark.createDataFrame([(w,) for w in words], "word string")
    expected = {(a, b) for a in words for b in words if a < b and one_edit(a, b)}
    for group in (1, 20, 10_000):
        found = [tuple(r) for r in spelling.near_pairs(table, spelling.Settings(group=group)).collect()]
        assert len(found) == len(set(found))
        assert {tuple(sorted(p)) for p in found} == expected


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.text("abé", min_size=1, max_size=7), min_size=2, max_size=40), st.sampled_from([1, 8, 1000]))
def test_every_pair_one_edit_apart_is_found(spark, words, group):
    table = spark.createDataFrame([(w,) for w in words], "word string")
    found = {tuple(sorted(r)) for r in spelling.near_pairs(table, spelling.Settings(group=group)).collect()}
    assert found == {(a, b) for a in words for b in words if a < b and one_edit(a, b)}


def test_chains_of_forms_lead_to_their_end(spark):
    links = [(f"w{i:02d}", f"w{i + 1:02d}") for i in range(20)] + [("x", "y")]
    found = spelling.roots(spark.createDataFrame(links, "word string, form string"))
    assert {tuple(r) for r in found.collect()} == {(f"w{i:02d}", "w20") for i in range(20)} | {("x", "y")}


def test_a_very_long_word(spark):
    rows = [(i, "b" * 30_000) for i in range(5)] + [(9, "b" * 29_999 + " ") for _ in range(30)]
    assert result(spark, rows, spelling.Settings()) == brute(rows, spelling.Settings())
