import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cuvee.llm import packing, queries, word_tokens
from cuvee.llm.word_tokens import encoder

FILE = queries.tokenizer_file()


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


def best_fit(lengths, capacity):
    """One by one."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in range(len(rooms)) if rooms[r] >= n]
        if fits:
            rooms[min(fits, key=lambda r: rooms[r])] -= n
        else:
            rooms.append(capacity - n)
    return len(rooms)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=120))
def test_plan_equals_best_fit_one_by_one(lengths):
    slots = packing.plan(Counter(lengths), 50)
    used, filled = Counter(), {}
    for length, lo, hi, first, each, offset in slots:
        assert lo < hi
        for rank in range(lo, hi):
            used[length, rank] += 1
            sequence, place = first + (rank - lo) // each, offset + (rank - lo) % each * length
            filled.setdefault(sequence, []).append((place, length))
    assert used == Counter((n, r) for n, c in Counter(lengths).items() for r in range(c))
    for parts in filled.values():
        at = 0
        for place, length in sorted(parts):
            assert place == at
            at += length
        assert at <= 50
    assert len(filled) == best_fit(lengths, 50)


def test_plan_is_small_for_large_counts():
    rng = random.Random(1)
    counts = {n: rng.randrange(1, 10**9) for n in range(1, 2049)}
    slots = packing.plan(counts)
    assert len(slots) < 20_000
    assert sum(hi - lo for _, lo, hi, *_ in slots) == sum(counts.values())


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abÉßΣσİ's 'RE\t\n\r\x0b\x1c  ́<|endoftext|>1½😀.,", max_size=60))
def test_chunks_have_the_ids_of_the_whole_text(text):
    whole = Tokenizer.from_file(FILE) if not hasattr(test_chunks_have_the_ids_of_the_whole_text, "t") else test_chunks_have_the_ids_of_the_whole_text.t
    test_chunks_have_the_ids_of_the_whole_text.t = whole
    assert np.frombuffer(encoder(FILE).ids(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


MIXED = st.text(alphabet="abzÉßΣσİдقꟙ'sRE\t\n ́-_()1½😀.,!<|>", max_size=40)


@settings(max_examples=100, deadline=None)
@given(st.lists(MIXED, max_size=6), st.sampled_from([3, 550_000]), st.sampled_from([10, 1_000_000]))
def test_texts_encoded_together_have_their_own_ids(tokenizer, texts, memory, together):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(word_tokens, "_MEMORY", memory)
        patch.setattr(word_tokens, "_TOGETHER", together)
        found = encoder(FILE).all_ids(texts)
    wanted = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == wanted


def test_new_words_of_many_texts_are_encoded_in_few_calls(tokenizer):
    class Counted:
        calls = 0

        def encode_batch_fast(self, *args, **kwargs):
            Counted.calls += 1
            return tokenizer.encode_batch_fast(*args, **kwargs)

    own = word_tokens.ChunkEncoder(FILE)
    own._tokenizer, own._by_word = Counted(), own._by_word and Counted()
    texts = [f"{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}ow {i} new%%%" for i in range(100)]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in own.all_ids(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert Counted.calls <= 4


def check(rows, texts, tokenizer, capacity):
    wanted = Counter()
    for d, t in texts:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for a in range(0, len(ids), capacity):
            part = ids[a : a + capacity]
            wanted[d, a // capacity, a, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_pack(spark, tokenizer):
    rng = random.Random(6)
    texts = [(d, " ".join(rng.choice(["the", "cat", "sat", "Über", "1234"]) for _ in range(rng.randrange(0, 60)))) for d in range(150)]
    texts += [(200 + k, "same words here") for k in range(80)] + [(300, None), (301, ""), (300, None), (None, "no id"), (None, "no id")]
    texts += [(400, "word " * 700)]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in texts], "doc_id long, text string, length int, offset string")
    for parts in (1, 9):
        rows = packing.pack(df.repartition(parts), FILE, 64).collect()
        n = check(rows, texts, tokenizer, 64)
        assert n == best_fit([r.length for r in rows], 64)


def test_sequences_hold_the_ids(spark, tokenizer):
    texts = [(d, f"some words of number {d} " * (d % 5)) for d in range(40)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    packed = packing.pack(df, FILE, 64, keep_ids=True)
    made = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    for p in packed.collect():
        ids = np.frombuffer(made[p.sequence_id].ids, "<u4")[p.offset : p.offset + p.length]
        assert zlib.crc32(ids.astype("<u4").tobytes()) == p.ids_crc32
    assert sum(len(r.ids) for r in made.values()) == 4 * sum(p.length for p in packed.collect())


def test_no_rows_and_long_text(spark, tokenizer):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(df, FILE).count() == 0
    text = "a long text of many words " * 20_000
    rows = packing.pack(spark.createDataFrame([(1, text)], df.schema), FILE).collect()
    assert check(rows, [(1, text)], tokenizer, 2048) == len(rows)
