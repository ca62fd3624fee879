import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cuvee.llm import chat

TEXTS = [
    "plain", "", None, "<|end|>\n", "a\\<|b", "<\\|x", "\\", "\\\\<|start|>user<|text|>", "<", "|>", "### Assistant: </turn> ok", "é😀\n\nz",
    "<|", "<\\\\|", "ends with <", "|starts", "<|text|><|text|>", "\t\r\n ",
]


def conversations():
    return [(c, t, "assistant" if t % 2 else "user", TEXTS[(c + t) % len(TEXTS)]) for c in range(20) for t in range(1 + c % 6)]


def read(spark, turns):
    back = chat.read_back(chat.format_turns(turns))
    return {r.conv_id: ([(t.role, t.text) for t in r.turns], r.loss_text, r.formatted) for r in back.collect()}


def test_turn_rows_come_back(spark):
    rows = conversations()
    df = spark.createDataFrame(rows[::-1], "conv_id long, turn long, role string, text string").repartition(5)
    found = read(spark, chat.turns_of_frame(df))
    for c in {r[0] for r in rows}:
        own = [(r, t or "") for k, _, r, t in rows if k == c]
        assert found[c][0] == own
        assert found[c][1] == "".join(t for r, t in own if r == "assistant")


def test_the_mask_covers_the_assistant_texts(spark):
    df = spark.createDataFrame(conversations(), "conv_id long, turn long, role string, text string")
    for r in chat.format_turns(chat.turns_of_frame(df)).collect():
        inside = "".join(r.formatted[s.start : s.start + s.length] for s in r.loss)
        own = [(t or "").replace("\\", "\\\\").replace("<|", "<\\|") for c, _, role, t in conversations() if c == r.conv_id and role == "assistant"]
        assert inside == "".join(own)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="\\<|>ab\n", max_size=12))
def test_escapes_are_reversible(text):
    out = text.replace("\\", "\\\\").replace("<|", "<\\|")
    assert "<|" not in out and "<|" not in (out + "<|end|>")[: len(out) + 1]
    assert out.replace("<\\|", "<|").replace("\\\\", "\\") == text or "\\\\" in out


def test_escapes_in_spark(spark):
    alphabet = "\\<|>"
    texts = [""]
    for _ in range(6):
        texts += [t + a for t in texts[-(4 ** (_)) :] for a in alphabet]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    wrong = df.where((chat.unescape(chat.escape(F.col("t"))) != F.col("t")) | chat.escape(F.col("t")).contains("<|"))
    assert wrong.count() == 0 and len(texts) > 4000


def test_every_layout_by_schema(spark):
    said = [F.struct(F.lit("user").alias("role"), F.lit("q").alias("content")), F.struct(F.lit("assistant").alias("role"), F.lit("a").alias("content"))]
    one = spark.range(1).select(F.col("id").alias("conv_id"), F.array(*said).alias("messages"))
    other = [F.struct(F.lit("human").alias("from"), F.lit("q").alias("value")), F.struct(F.lit("gpt").alias("from"), F.lit("a").alias("value"))]
    two = spark.range(1).select(F.col("id").alias("conv_id"), F.array(*other).alias("conversations"))
    frames = [one, two, one.withColumn("extra", F.lit(5))]
    for names in (("prompt", "completion"), ("prompt", "response"), ("instruction", "output"), ("question", "answer")):
        frames.append(spark.range(1).select(F.col("id").alias("conv_id"), F.lit("q").alias(names[0]), F.lit("a").alias(names[1])))
    for df in frames:
        assert read(spark, chat.turns_of_frame(df))[0][0] == [("user", "q"), ("assistant", "a")], df.columns
    assert chat.turns_of_frame(spark.range(3).withColumnRenamed("id", "conv_id")).count() == 0


def test_json_records_each_with_a_layout(spark):
    records = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        {"messages": [{"content": "q", "role": "user", "name": "x"}, {"role": "assistant", "content": "a", "meta": {"k": [1, 2]}}], "id": 7},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"instruction": "q", "output": "a"},
        {"instruction": "q", "input": "", "output": "a", "source": {"a": 1.5}},
        {"prompt": "q", "completion": "a"},
        {"question": "q", "answer": "a", "n": 3},
        {"dialog": [{"speaker": "user", "utterance": "q"}, {"speaker": "assistant", "utterance": "a"}]},
    ]
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)]
    rows += [(90, "{broken"), (91, None), (92, "{}"), (93, '{"prompt": 1}'), (94, "[1]"), (95, '{"messages": "no list"}'), (96, "")]
    turns = chat.turns_of_json(spark.createDataFrame(rows, "conv_id long, record string"))
    found = read(spark, turns)
    assert sorted(found) == list(range(len(records)))
    for i in range(len(records)):
        assert found[i][0] == [("user", "q"), ("assistant", "a")], records[i]
    prints = {r.conv_id: (r.fingerprint, r.layout) for r in turns.collect()}
    assert prints[0][1] == prints[1][1] == "messages" and prints[0][0] != prints[1][0]


def test_same_fields_same_fingerprint(spark):
    rows = [(1, '{"prompt": "a", "completion": "b"}'), (2, '{"completion": "longer", "prompt": "other"}')]
    turns = chat.turns_of_json(spark.createDataFrame(rows, "conv_id long, record string"))
    assert len({r.fingerprint for r in turns.collect()}) == 1


def test_fingerprints_of_layouts_differ():
    assert len(chat._BY_FINGERPRINT) == len(chat.LAYOUTS)


def test_ties_nulls_and_no_rows(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, None, None, None), (None, 0, "assistant", "z"), (1, 0, "user", "a")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, nth int, t string")
    found = read(spark, chat.turns_of_frame(df.select("conv_id", "turn", "role", "text", "nth", "t")))
    assert found[1][0] == [("", ""), ("user", "a"), ("user", "a"), ("user", "b")]
    assert found[None][:2] == ([("assistant", "z")], "z")
    assert chat.format_turns(chat.turns_of_frame(df.limit(0))).count() == 0


def test_long_text(spark):
    text = "<|\\" * 1_000_000
    df = spark.createDataFrame([(1, 0, "assistant", text)], "conv_id long, turn long, role string, text string")
    assert read(spark, chat.turns_of_frame(df))[1][1] == text


def test_the_query_holds_the_tricky_conversation(spark, sf_dir):
    from cuvee.llm import queries

    row = queries.op5_chat_formatting(spark, sf_dir).where("conv_id = -7").first()
    text = "\\### Assistant: </turn> ok"
    told = f"user\n{text}\nassistant\n{text}\n"
    assert row.turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
    assert (row.n_turns, row.loss_chars) == (2, len(text))


def test_long_json_records_keep_their_layout(spark, monkeypatch):
    records = [
        {"messages": [{"role": "user", "text": "q"}, {"role": "assistant", "text": "a"}]},
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        {"prompt": "q", "completion": "a"},
    ]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "conv_id long, record string")
    short = sorted(tuple(r) for r in chat.turns_of_json(df).collect())
    monkeypatch.setattr(chat, "VARIANT_CHARS", 10)
    assert sorted(tuple(r) for r in chat.turns_of_json(df).collect()) == short
    assert [r[3] for r in short] == ["q", "a"] * 3
