import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cuvee.llm import token_counts as tc
from cuvee.llm.word_tokens import counter

FILES = {name: public_tokenizers.path(name) for name in ("word_bpe_49k.json", "byte_bpe_50k.json")}
WHOLE = {name: Tokenizer.from_file(file) for name, file in FILES.items()}
TEXT = st.text(alphabet="abc  \n\té'1.ß", max_size=120)
EDIT = st.tuples(st.integers(-3, 140), st.integers(0, 60), st.text(alphabet="ab \n'é", max_size=30))


def full(name, text):
    return len(WHOLE[name].encode(text, add_special_tokens=False).ids)


def changed(text, edits):
    for start, deleted, inserted in edits:
        start = min(max(0, start), len(text))
        text = text[:start] + inserted + text[min(start + deleted, len(text)) :]
    return text


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=150, deadline=None)
@given(TEXT, st.lists(EDIT, max_size=6))
def test_equals_a_full_count(name, text, edits):
    tree = tc.TokenTree(text, counter(FILES[name]), size=7)
    assert tree.n_tokens == full(name, text) and tree.n_chars == len(text) and tree.text() == text
    for k, e in enumerate(edits, 1):
        tree.edit(*e)
        now = changed(text, edits[:k])
        assert tree.text() == now and tree.n_chars == len(now)
        assert tree.n_tokens == full(name, now)


def test_only_touched_leaves_are_encoded():
    text = "some words of a long document " * 2000
    tree = tc.TokenTree(text, counter(FILES["word_bpe_49k.json"]))
    tree.edit(30_000, 4, "XY")
    tree.edit(100, 0, " inserted")
    assert tree.encoded_chars < 8 * tc.LEAF
    assert tree.n_tokens == full("word_bpe_49k.json", tree.text())


def test_a_long_insertion_grows_the_tree():
    tree = tc.TokenTree("a b c", counter(FILES["word_bpe_49k.json"]))
    tree.edit(2, 1, "many new words " * 3000)
    for at in (0, 20_000, 44_000):
        tree.edit(at, 5, "Z z")
    assert tree.n_tokens == full("word_bpe_49k.json", tree.text()) and len(tree._leaves) > 50


def test_table(spark):
    rows = [
        (1, "some words here and there", [(5, 5, "X"), (0, 0, "new ")]),
        (2, None, [(0, 0, "now there is text")]),
        (3, "", None),
        (None, "no id", []),
        (3, "repeated id", [(None, 1, "x"), (2, None, None)]),
        (4, "word " * 50_000, [(100_000, 10, "changed")]),
    ]
    df = spark.createDataFrame(
        [(d, t, e, 1, "x") for d, t, e in rows],
        "doc_id long, text string, edits array<struct<start:long,deleted:long,inserted:string>>, n_tokens int, key string",
    )
    for name in FILES:
        found = sorted(map(tuple, tc.count_with_edits(df.repartition(4), FILES[name]).drop("reencoded_chars").collect()), key=str)
        wanted = []
        for d, t, edits in rows:
            after = changed(t or "", [(s, n or 0, i or "") for s, n, i in edits or [] if s is not None])
            wanted.append((d, full(name, t or ""), full(name, after), len(after)))
        assert found == sorted(wanted, key=str)
    assert tc.count_with_edits(df.limit(0), FILES["word_bpe_49k.json"]).count() == 0


def test_edits_from_a_table(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "d")], "doc_id long, text string")
    changes = spark.createDataFrame([(1, 2, 0, 1, "Y"), (1, 1, 0, 0, "Z ")], "doc_id long, nth int, start long, deleted long, inserted string")
    found = {r.doc_id: r.edits for r in tc.edits_of(docs, changes).collect()}
    assert [e.inserted for e in found[1]] == ["Z ", "Y"] and found[2] is None


def test_the_query_equals_a_full_count(spark, sf_dir):
    from cuvee.llm import queries

    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in queries.op7_token_counts(spark, sf_dir).collect():
        d = docs[r.doc_id]
        n = len(d.text)
        after = changed(d.text, [(n // 2, 3, d.source), (0, 0, f"{d.lang}: "), (n // 3, 40, "")])
        assert (r.n_tokens, r.n_tokens_after) == (full("word_bpe_49k.json", d.text), full("word_bpe_49k.json", after))
