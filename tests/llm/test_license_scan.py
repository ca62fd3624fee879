import pytest

from cuvee.llm import license_scan as ls


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def model(spark, docs):
    return ls.train(spark, docs)


def scan(spark, model, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {(r.key, r.paragraph): r for r in ls.scan(df, model).collect()}


def test_families_of_notices(spark, model):
    texts = [(f, t) for f, own in ls.NOTICES.items() for t in own]
    found = scan(spark, model, [f"Some words before.\n{t}\nAnd after it." for _, t in texts])
    wrong = [(t, found.get((i, 1)) and found[i, 1].family) for i, (f, t) in enumerate(texts) if not found.get((i, 1)) or found[i, 1].family != f]
    assert not wrong
    assert all(r.confirmed for r in found.values()) and set(found) == {(i, 1) for i in range(len(texts))}


def test_variants_of_notices(spark, model):
    found = scan(spark, model, [
        "this file is LICENSED UNDER THE MIT LICENSE", "Licensed under the Apache License, Version 2.0 ###", "(c) 2020 Somebody. All rights reserved.",
    ])
    assert [found[i, 0].family for i in range(3)] == ["mit", "apache-2.0", "proprietary"]


def test_prose_is_unknown(spark, docs, model):
    """Held-out documents: every licence line is found, and no other line."""
    import re

    wanted = {
        (d.doc_id, k)
        for d in docs.collect()
        for k, line in enumerate(d.text.split("\n"))
        if re.search(r"(?i)licensed under|released under|all rights reserved", line)
    }
    rows = ls.scan(docs, model).collect()
    assert {(r.key, r.paragraph) for r in rows if r.confirmed} == wanted and wanted


def test_probabilities_and_threshold(spark, docs, model):
    rows = ls.scan(docs, model).collect()
    assert all(model.threshold <= r.probability <= 1 and 0 <= r.similarity <= 1 for r in rows)
    assert model.temperature in ls.Settings().temperatures


def test_nulls_empty_long_and_other_columns(spark, model):
    notice = "Released under the MIT License."
    rows = [(1, None, 1, "a"), (1, "", 2, "b"), (None, notice, 3, "c"), (2, "\n\n" + notice, 4, "d"), (2, notice, 5, "e"), (3, "...\n!!", 6, "f")]
    rows += [(4, "the of and " * 200_000 + "\n" + notice, 7, "g")]
    df = spark.createDataFrame(rows, "doc_id long, text string, paragraph int, features string")
    found = sorted(((r.key, r.paragraph) for r in ls.scan(df, model).collect()), key=str)
    assert found == sorted([(None, 0), (2, 2), (2, 0), (4, 1)], key=str)
    assert ls.scan(df.limit(0), model).count() == 0


def test_training_without_documents(spark, docs):
    model = ls.train(spark, docs.limit(0), ls.Settings(variants=8))
    assert scan(spark, model, ["Released under the MIT License."])[0, 0].family == "mit"
