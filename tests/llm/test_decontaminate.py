import random
import re

import pytest
from conftest import spread

from cuvee.llm import decontaminate as dc

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[a : a + n]), set()).add(str(i))
    found = {}
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for a in range(len(w) - n + 1):
                own = windows.get(tuple(w[a : a + n]))
                if own:
                    hit |= set(range(a, a + n))
                    ids |= own
        found[d] = (len(w), len(hit), len(ids), sorted(ids), bool(hit))
    return found


def result(spark, docs, items):
    d = docs if hasattr(docs, "columns") else spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    return {r[0]: (r.n_words, r.n_hit, r.n_items, list(r["items"]), r.contaminated) for r in dc.decontaminate(d, i).collect()}


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(2)
    word = lambda: rng.choice("abcdefgh") * rng.randrange(1, 4)
    items = [(k, " ".join(word() for _ in range(rng.randrange(12, 40)))) for k in range(20)]
    items += [(100, "Only, these FOUR words!"), (101, "zebra"), (102, "same same same same same same same same same same same same")]
    items += [(103, None), (104, "... !"), (105, items[0][1]), (106, "nine words are one less than what one needs")]
    docs = []
    for d in range(60):
        text = [word() for _ in range(rng.randrange(0, 80))]
        if d % 3 == 0:
            w = words(items[rng.randrange(20)][1])
            a, n = rng.randrange(len(w)), rng.randrange(5, 30)
            k = rng.randrange(len(text) + 1)
            text[k:k] = [x.upper() + rng.choice(["", ",", " -"]) for x in w[a : a + n]]
        docs.append((d, " ".join(text)))
    docs += [(100, "x only these four words only THESE four-words y"), (101, "a zebra, b"), (102, "same " * 50), (103, None), (104, "")]
    docs += [(105, items[3][1]), (106, "nine words are one less than what one needs"), (107, "É é zebraÉ"), (108, "nine words are one less than what one")]
    return docs, items


def test_equals_brute_force(spark, tables):
    assert result(spark, *tables) == brute(*tables)


def test_partitions_do_not_matter(spark, tables):
    docs, items = tables
    assert result(spark, spread(spark.createDataFrame(docs, "doc_id long, text string"), 11), items) == brute(docs, items)


def test_joins_by_shuffle_give_the_same(spark, tables, monkeypatch):
    from cuvee.llm import common

    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert result(spark, *tables) == brute(*tables)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_benchmark_no_documents(spark, tables):
    docs, items = tables
    for none in ([], [(None, docs[0][1]), (1, "?!")]):
        found = result(spark, docs, none)
        assert len(found) == len(docs) and all(v[1:] == (0, 0, [], False) for v in found.values())
    assert result(spark, [], items) == {}


def test_repeated_ids_null_ids_and_other_columns(spark):
    text = " ".join(f"w{i}" for i in range(12))
    rows = [(1, text, 3, "a"), (1, text, 4, "b"), (2, "w0 w1", 5, "c"), (None, text, 6, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int, w string")
    found = result(spark, df, [(7, text), (7, text)])
    assert found == {1: (12, 12, 1, ["7"], True), 2: (2, 0, 0, [], False), None: (12, 0, 0, [], False)}


def test_long_text(spark):
    item = " ".join(f"k{i}" for i in range(15))
    text = " ".join(f"v{i % 977}" for i in range(200_000)) + " " + item
    assert result(spark, [(1, text)], [(1, item)]) == {1: (200_015, 15, 1, ["1"], True)}


def test_winnowing_guarantee():
    """Any two windows with the same words have the same fingerprint: it depends on the window's words only."""
    for length in range(1, 11):
        k = (length + 1) // 2
        assert 1 <= k <= length and length - k + 1 >= 1
