import random

import numpy as np
import pyarrow as pa
import pytest

from cuvee.llm import pseudo_likelihood as pl
from cuvee.llm.wordhash import words_by_text

SMALL = pl.Settings(vocabulary=60, buckets=20, single=30, known=6, other=4, mask_every=4, rounds=4, batch=64)


def sentences(rng, n):
    """Words whose neighbours tell them: a b c d ... in order, from a random start."""
    names = [f"w{i}" for i in range(12)]
    return [" ".join(names[(s + k) % 12] for k in range(rng.randrange(10, 30))) for s in (rng.randrange(12) for _ in range(n))]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    return spark.createDataFrame(list(enumerate(sentences(rng, 600))), "doc_id long, text string").repartition(2)


@pytest.fixture(scope="module")
def model(docs):
    return pl.train(docs, SMALL)


def slow_score(model, text):
    """The definition, token by token."""
    s, w = model.settings, {k: v.astype(np.float64) for k, v in model.weights.items()}
    (_, hashes), = words_by_text(pa.array([text], pa.string()))
    row, kind, share = model.encode(hashes)
    total = 0.0
    for i in range(len(row)):
        seen = [row[j] if 0 <= j < len(row) else len(w["embed"]) - 1 for j in range(i - s.window, i + s.window + 1) if j != i]
        hidden = np.tanh(np.concatenate([w["embed"][j] for j in seen]) @ w["hide"] + w["hide_at"])
        raw = hidden @ w["out"] + w["out_at"]
        total += raw[kind[i]] - np.log(np.exp(raw).sum()) + share[i]
    return total


def test_scores_follow_the_definition(spark, model):
    texts = ["w1 w2 w3 w4", "w5", "W9 w9 never seen words", "w1 " * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pl.score(df, model).collect():
        assert r.log_probability == pytest.approx(slow_score(model, texts[r.key]), rel=1e-4)
        assert r.n_tokens == len(texts[r.key].split())


def test_classes_and_shares_make_a_distribution(model):
    shares = np.zeros(model.settings.classes)
    np.add.at(shares, model.class_of, np.exp(model.share))
    used = np.unique(model.class_of)
    assert shares[used] == pytest.approx(np.ones(len(used)))


def test_held_out_order_matters(spark, model):
    rng = random.Random(99)
    real = sentences(rng, 60)
    mixed = [" ".join(rng.sample(t.split(), len(t.split()))) for t in real]
    df = spark.createDataFrame([(0, t) for t in real] + [(1, t) for t in mixed], "doc_id long, text string")
    mean = {k: np.mean([r.mean_log_probability for r in pl.score(df, model).collect() if r.key == k]) for k in (0, 1)}
    # Uniform over twelve words is -2.48.
    assert mean[0] > -1.2 and mean[0] > mean[1] + 1.0


def test_both_sides_are_used(model):
    """A word is likelier when what follows fits too, with the same words before it."""
    (_, a), (_, b) = words_by_text(pa.array(["w1 w2 w3 w4 w5 w6", "w1 w2 w3 w4 w9 w2"], pa.string()))
    first, second = pl.log_probabilities(model, [a]), pl.log_probabilities(model, [b])
    assert first[3] > second[3]


def test_counts_cover_every_word(spark, docs):
    counts = pl.word_counts(docs.repartition(5), pl.Settings(held=100)).toPandas()
    assert counts.n.sum() == sum(len(r.text.split()) for r in docs.collect()) and len(counts) == 12


def test_batching_does_not_matter(spark, model):
    rng = random.Random(5)
    held = [h for _, h in words_by_text(pa.array([*sentences(rng, 30), "", None, "w1"], pa.string()))]
    together = pl.log_probabilities(model, held)
    apart = np.concatenate([pl.log_probabilities(model, [h]) for h in held])
    assert together == pytest.approx(apart, rel=1e-4)


def test_nulls_empty_long_and_other_columns(spark, model):
    rows = [(1, None, 1.0), (1, "", 2.0), (None, "w1 w2", 3.0), (2, "w1 " * 300_000, 4.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, log_probability double")
    found = pl.score(df, model).collect()
    assert sorted(((r.key, r.n_tokens, r.mean_log_probability is None) for r in found), key=str) == sorted(
        [(1, 0, True), (1, 0, True), (None, 2, False), (2, 300_000, False)], key=str
    )
    assert pl.score(df.limit(0), model).count() == 0


def test_training_on_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, " ")], "doc_id long, text string")
    for some in (df, df.limit(0)):
        model = pl.train(some, SMALL)
        scored = pl.score(spark.createDataFrame([(1, "a b")], df.schema), model).first()
        assert scored.n_tokens == 2 and np.isfinite(scored.log_probability)


def test_counts_of_words_outside_the_vocabulary_matter(spark):
    """18 occurrences score higher than one, by the logarithm of the count."""
    rows = [(i, "common word often") for i in range(60)] + [(100 + i, "rare") for i in range(18)] + [(200, "once"), (201, "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    few = pl.Settings(vocabulary=3, buckets=20, single=2, known=1, other=1, rounds=1, depth=3)
    model = pl.train(docs, few)
    total = {}
    for text in ("rare", "once", "never"):
        (_, hashes), = words_by_text(pa.array([text], pa.string()))
        asked = spark.createDataFrame([(1, text), (1, f"{text} {text}"), (None, text)], docs.schema)
        scored = sorted((r.n_tokens, r.log_probability) for r in pl.score(asked, model).collect())
        assert [n for n, _ in scored] == [1, 1, 2] and scored[0][1] == pytest.approx(scored[1][1])
        total[text] = scored[0][1] - pl.log_probabilities(model, [hashes])[0]
    assert total["rare"] == pytest.approx(np.log(18)) and total["once"] == total["never"] == 0
    assert model.other_share == pytest.approx([-np.log(18 + 2 + 2**3)])


TREES = pl.Settings(vocabulary=9, buckets=20, single=2, known=1, other=1, depth=5, mask_every=4, rounds=4, batch=64)


def test_context_decides_the_word_inside_a_class(spark):
    """Words of one class, equally frequent, in and outside the vocabulary: each is likelier where its neighbours stand."""
    rng = random.Random(6)
    pairs = [(f"a{i}", f"b{i}", f"c{i}") for i in range(6)]
    texts = [" ".join(rng.choice(pairs)) for _ in range(1200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(1)
    model = pl.train(docs, TREES)
    gains = []
    for i, (a, b, c) in enumerate(pairs):
        other = pairs[(i + 1) % 6][1]
        held = [h for _, h in words_by_text(pa.array([f"{a} {b} {c}", f"{a} {other} {c}"], pa.string()))]
        found = pl.log_probabilities(model, held)
        kinds = model.encode(np.concatenate(held))[1]
        if kinds[1] == kinds[4]:
            gains.append(found[1] - found[4])
    assert gains and np.mean(gains) > 0.5


def test_words_of_the_trees_make_a_distribution(spark):
    """Over all counted words and the unseen share of each group the probabilities add up to one, whatever the context."""
    rng = random.Random(2)
    texts = [" ".join(f"v{int(rng.expovariate(0.1))}" for _ in range(20)) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = pl.train(docs, TREES)
    names = sorted({w for t in texts for w in t.split()})
    n = {w: sum(t.split().count(w) for t in texts) for w in names}
    held = [h for _, h in words_by_text(pa.array([f"v1 {w} v2" for w in names], pa.string()))]
    hashes = np.array([h[1] for h in held])
    _, known = model.find(hashes)
    found = np.exp(pl.log_probabilities(model, held)[1::3]) * np.where(known, 1, [n[w] for w in names])
    row, _, _ = model.encode(hashes)
    groups = set(zip(*(x.tolist() for x in model.group(hashes[~known])), strict=True))
    once = {g: p for g, p in zip(zip(*(x.tolist() for x in model.group(hashes[~known])), strict=True),
                                 np.exp(pl.log_probabilities(model, held)[1::3])[~known], strict=True)}
    missing = 0.0
    for g in range(1 << TREES.depth):  # groups without a counted word
        if (0, g) not in groups:
            ghost = np.uint64(g) << np.uint64(48)
            missing += np.exp(pl.log_probabilities(model, [np.array([held[0][0], ghost, held[0][2]], dtype=np.uint64)])[1])
    assert found.sum() + sum(once.values()) + missing == pytest.approx(1, rel=1e-3)


def test_rounds_together_hide_every_token_once():
    for rounds in (1, 2, 3, 4, 16):
        s = pl.Settings(rounds=rounds)
        assert sorted(m for number in range(rounds) for m in pl.masks(s, number)) == list(range(s.mask_every))
    assert [list(pl.masks(pl.Settings(mask_every=2, rounds=3), k)) for k in range(3)] == [[0], [1], [0]]


def test_every_token_trains(spark):
    """A text of two words trains the classes of both; one mask in eight would have hidden neither or one of them."""
    df = spark.createDataFrame([(1, "a b")] * 4, "doc_id long, text string").coalesce(1)
    model = pl.train(df, pl.Settings(vocabulary=4, buckets=5, single=2, known=1, other=1))
    assert (model.weights["out_at"][:2] > 0).all()


def test_sums_of_rows_beyond_16_bits():
    rng = np.random.default_rng(1)
    at, rows = rng.choice([0, 1, 65_536, 65_537, 199_999], 300), rng.normal(size=(300, 6)).astype(np.float32)
    at[7] = 131_072  # once only
    values, sums = pl._sums(at, rows, 200_000)
    assert values.tolist() == sorted(set(at.tolist()))
    assert sums == pytest.approx(np.array([rows[at == v].sum(0) for v in values]), abs=1e-4)
    assert pl._sums(at, rows[:, :3].copy(), 200_000)[1] == pytest.approx(sums[:, :3], abs=1e-4)


def test_words_are_found_where_hashes_share_their_first_bits(model):
    words = np.array([0, 1, 2, 2**40, 2**63, 2**64 - 3, 2**64 - 1], dtype=np.uint64)
    own = pl.Model(**{**{k: model.__dict__[k] for k in pl.Model.__dataclass_fields__}, "words": words})
    others = np.array([3, 2**39, 2**40 + 1, 2**63 - 1, 2**63 + 7, 2**64 - 4, 2**64 - 2], dtype=np.uint64)
    at, found = own.find(np.concatenate([words, others]))
    assert at[:7].tolist() == list(range(7)) and found.tolist() == [True] * 7 + [False] * 7


def test_a_step_follows_the_definition(docs, model):
    """Adagrad on the gradient of the mean loss, token by token and node by node."""
    texts = [r.text for r in docs.limit(8).collect()] + ["never seen w3 words w1"]
    held = [h for _, h in words_by_text(pa.array(texts, pa.string()))]
    hashes, s = np.concatenate(held), model.settings
    row, kind = model.place(hashes)
    line, at = pl._around(row, np.array([len(h) for h in held]), len(model.weights["embed"]) - 1, s.window)
    context, path = line[at[:, None] + pl._offsets(s.window)], model.path(row, hashes)
    w, memory = {k: v.copy() for k, v in model.weights.items()}, {k: np.full_like(v, 1e-2) for k, v in model.weights.items()}
    pl._learn(w, memory, context, kind, s.rate, model.odds, path)
    slow, nodes = {k: np.zeros(v.shape) for k, v in w.items()}, {int(t): [] for t in range(len(row))}
    places, runs, node, side = path
    for tokens, part, long in runs:
        for t, n, x in zip(places[tokens], node[part].reshape(-1, long), side[part].reshape(-1, long), strict=True):
            nodes[int(t)] = list(zip(n.tolist(), x.tolist(), strict=True))
    assert nodes[len(row) - 5] and len(nodes[len(row) - 5]) == s.depth
    old, back_to_rows = {k: v.astype(np.float64) for k, v in model.weights.items()}, []
    for t in range(len(row)):
        seen = old["embed"][context[t]].ravel()
        hidden = np.tanh(seen @ old["hide"] + old["hide_at"])
        raw = hidden @ old["out"] + old["out_at"]
        error = np.exp(raw) / np.exp(raw).sum()
        error[kind[t]] -= 1
        back = old["out"] @ error
        for n, second in nodes[t]:
            wrong = 1 / (1 + np.exp(-model.odds[n] - old["inner"][n] @ hidden)) - second
            back += wrong * old["inner"][n]
            slow["inner"][n] += wrong * hidden / len(row)
        back *= (1 - hidden**2) / len(row)
        slow["out"] += np.outer(hidden, error) / len(row)
        slow["out_at"] += error / len(row)
        slow["hide"] += np.outer(seen, back)
        slow["hide_at"] += back
        back_to_rows.append(back)
    for t, back in enumerate(back_to_rows):  # by the weights as they are after their own step
        np.add.at(slow["embed"], context[t], (w["hide"] @ back).reshape(len(context[t]), -1))
    for k, step in slow.items():
        assert w[k] == pytest.approx(old[k] - s.rate * step / np.sqrt(1e-2 + step**2), abs=2e-5), k
