import random

import pytest

from cuvee.llm import toxicity as tox
from cuvee.llm.lexicon import LexiconAutomaton, Term


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    rng = random.Random(4)
    terms = ["idiot", "moron", "moronic", "scum", "worthless", "pathetic", "clown"]
    automaton = LexiconAutomaton([Term(t, 1.0 + i / 10) for i, t in enumerate(terms)])
    words = {"".join(rng.choice("idotmrncs") for _ in range(rng.randrange(1, 8))) for _ in range(800)}
    for t in terms:
        for _ in range(150):
            w = list(t)
            for _ in range(rng.randrange(0, 4)):
                k = rng.randrange(len(w) + 1)
                w[k : k + rng.randrange(2)] = rng.choice(["", "x", "e", "xy"])
            words.add("".join(w))
    for w in words:
        near = sorted((distance(w, t), -(1.0 + i / 10), i) for i, t in enumerate(terms) if distance(w, t) <= Term(t, 1).edits)
        found = automaton.match(w)
        assert found == ((near[0][2], near[0][0]) if near else None), w


def test_stems_match_beginnings_without_edits():
    automaton = LexiconAutomaton([Term("achlich", 2.0, True), Term("ach", 1.0)])
    assert automaton.match("achlichkeit") == (0, 0)
    assert automaton.match("ach") == (1, 0)
    assert automaton.match("axhlichkeit") is None and automaton.match("achli") is None


def test_memory_is_bounded(monkeypatch):
    automaton = LexiconAutomaton([Term("idiot", 1.0)])
    monkeypatch.setattr(LexiconAutomaton, "MEMORY", 50)
    rng = random.Random(1)
    for _ in range(2000):
        automaton.match("".join(rng.choice("idot") for _ in range(6)))
    assert len(automaton._words) <= 52


def share(text):
    low = text.lower()
    spans = [m.span() for m in tox._WORD.finditer(low)]
    i = next(k for k, (a, b) in enumerate(spans) if low[a:b] == "idiot")
    return tox.quoted_share(low, spans, i, 6)


def test_quotation_is_told_from_abuse():
    assert share("you are an idiot and a fool") == 0
    assert share('she said "idiot" and left') > 0.9
    assert share("the word “idiot” comes from Greek") > 0.9
    assert share('he called him "a real idiot" then') > share('an "idiot" here') > share("you idiot")


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(8)
    plain = [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for d in range(400):
        w = [rng.choice(plain) for _ in range(60)]
        bad = d % 5 == 0
        for _ in range(4 if bad else 0):
            w[rng.randrange(60)] = rng.choice(["idiot", "moron", "worthless", "vilekeit" + rng.choice("abcdefgh")])
        rows.append((d, " ".join(w)))
        labels.append((d, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


@pytest.fixture(scope="module")
def model(tables):
    docs, labels = tables
    return tox.train(docs, labels.where("doc_id % 4 > 0"))


def test_held_out_accuracy(tables, model):
    docs, labels = tables
    found = tox.score(docs, model).join(labels, "doc_id").where("doc_id % 4 = 0").collect()
    assert len(found) == 100
    assert sum((r.score >= 0.5) == (r.toxic == 1) for r in found) >= 98
    assert {"idiot", "moron", "worthless"} <= {t.text for t in model.terms}


def test_misspelled_terms_and_quotations(model):
    filler = " ".join(f"w{i}" for i in range(30))
    assert model.features(f"{filler} idiiot moron")[4] > 0
    abusive = model.score(f"you idiot moron worthless idiot {filler}")
    quoted = model.score(f'she said "idiot" and wrote "moron" and quoted "worthless" {filler}')
    assert abusive > 0.5 > quoted


def test_same_scores_twice(tables, model):
    docs, labels = tables
    again = tox.train(docs.repartition(7), labels.repartition(3).where("doc_id % 4 > 0"))
    assert again.terms == model.terms and again.weights == pytest.approx(model.weights, rel=1e-9)


def test_nulls_empty_texts_and_other_columns(spark, model):
    rows = [(1, None, 0.1, None), (2, "", 0.2, [1]), (None, "you idiot " * 9, 0.3, [2]), (2, "", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double, x array<int>")
    found = tox.score(df, model).collect()
    assert len(found) == 4 and found[0].__fields__ == ["doc_id", "text", "x", "score"]
    by_text = {r.text: r.score for r in found}
    assert by_text[None] == by_text[""] < 0.5 < by_text["you idiot " * 9]
    assert all(0 <= r.score <= 1 for r in found)
    assert tox.score(df.limit(0), model).count() == 0


def test_training_without_labels_or_rows(spark, tables):
    docs, labels = tables
    for some in (labels.limit(0), labels.where("toxic = 0"), labels.withColumn("toxic", labels.toxic.cast("int") * 0)):
        assert tox.train(docs, some).score("you idiot") == 0.0
    assert tox.train(docs.limit(0), labels).score("") == 0.0


def test_long_text(model):
    assert 0 <= model.score("idiot word " * 100_000) <= 1


def test_misspellings_of_stems_of_words_beneath_them_and_of_weak_terms(spark):
    rng = random.Random(12)
    rows, labels = [], []
    for d in range(500):
        w = [f"w{rng.randrange(200)}" for _ in range(50)]
        bad = d % 5 == 0
        for _ in range(5 if bad else 0):
            w[rng.randrange(50)] = rng.choice(["idiot", "idiots", "worthless", *["vilekeit" + c for c in "abcdefgh"]])
        if bad or d % 10 == 1:  # weaker, since some clean documents have it
            w[rng.randrange(50)] = "meanish"
        rows.append((d, " ".join(w)))
        labels.append((d, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = tox.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert any(t.stem for t in model.terms)
    lifts = {t.text: t.weight for t in model.terms}
    assert lifts["meanish"] < 0.6 * max(lifts.values())
    for word in ("idiiot", "idoots", "wortless", "meanissh", "vilexeitzz"):
        found = model.automaton.match(word)
        assert found is not None and found[1] > 0, word


def test_stems_with_edits():
    automaton = LexiconAutomaton([Term("achlich", 2.0, True, fuzzy_stem=True), Term("achlichen", 1.0)])
    assert automaton.match("axhlichkeit") == (0, 1) and automaton.match("achlichkeit") == (0, 0)
    assert automaton.match("axhlxchkeit") is None
