import random
import re

import pytest
from test_decontaminate import brute as leaks_of
from test_near_dups import brute as groups_of
from test_packing import best_fit, check, tokenizer  # noqa: F401

import corpus_pipeline as cp
from cuvee.llm import queries, secret_scan

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TOKEN = 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f96{}"'


def corpus():
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(3000)}"
    items = [(i, " ".join(f"q{rng.randrange(500)}" for _ in range(25))) for i in range(10)]
    docs, labels = [], []
    for d in range(500):
        w = [word() for _ in range(rng.randrange(20, 120))]
        toxic = d % 6 == 0
        if toxic:
            for _ in range(5):
                w[rng.randrange(len(w))] = rng.choice(["idiot", "moron", "worthless"])
        if d % 17 == 1:
            w[10:10] = items[d % 10][1].split()[3:17]
        text = " ".join(w)
        if d % 13 == 2:
            text += " " + TOKEN.format(d % 10)
        docs.append([d, text])
        labels.append((d, 1, int(toxic)))
    for k in range(60):
        docs.append([1000 + k, docs[(k * 7) % 50][1] + (" more" if k % 2 else "")])
    docs += [[2000, None], [2001, ""], [2002, "  "], [2003, "short"], [None, "a row without an id"], [2004, "w1 " * 30_000]]
    docs.append([2003, "short"])
    return [(d, t, "en", "src1", len(t or "")) for d, t in docs], items, labels


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("corpus"))
    docs, items, labels = corpus()
    spark.createDataFrame(docs, DOCS).repartition(4).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


def test_pipeline_equals_its_stages_by_brute_force(spark, sf_dir, tokenizer):  # noqa: F811
    docs, items, labels = corpus()
    model = queries.toxicity_model(spark, sf_dir, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    toxic = {d for d, _, y in labels if y}
    left = [r for r in docs if model.score(r[1] or "") < 0.5]
    assert {r[0] for r in docs} - {r[0] for r in left} >= toxic
    assert not {d for d, _, y in labels if not y} - {r[0] for r in left}

    kept = {d for d, _, _, k in groups_of([(r[0], r[1]) for r in left if r[0] is not None], 5) if k}
    left = [r for i, r in enumerate(left) if r[0] is None or (r[0] in kept and r not in left[:i])]
    leaks = {d for d, found in leaks_of([r[:2] for r in left], items).items() if found[-1]}
    assert leaks
    left = [r for r in left if r[0] not in leaks]
    mask = secret_scan.Settings().mask
    texts = [(r[0], re.sub(r'(?<=token = ")[0-9a-f]{40}(?=")', mask, r[1]) if r[1] else r[1]) for r in left]
    assert sum(mask in (t or "") for _, t in texts) > 10

    rows = cp.run(spark, sf_dir).collect()
    n = check(rows, texts, tokenizer, 2048)
    assert n == best_fit([r.length for r in rows], 2048)


def test_stages_keep_the_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).selectExpr("*", "1 AS score", "'x' AS _hash")
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.dtypes == docs.dtypes, name


def test_stages_take_an_empty_table_and_odd_rows(spark, sf_dir):
    empty = spark.createDataFrame([], DOCS)
    odd = spark.createDataFrame([(None, None, None, None, None), (1, None, None, None, None), (1, "", "en", None, 0)], DOCS)
    for name, stage in cp.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0, name
    for name, stage in cp.STAGES[:-1]:
        assert stage(spark, odd, sf_dir).count() == (2 if name == "minhash_near_dedup" else 3), name
    assert cp.STAGES[-1][1](spark, odd, sf_dir).count() == 3


def test_the_length_follows_the_mask(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for r in cp.mask_secrets(spark, docs.where("text is not null"), sf_dir).collect():
        assert r.n_chars == len(r.text)


def test_the_five_stages_in_order():
    assert [n for n, _ in cp.STAGES] == [
        "toxicity", "minhash_near_dedup", "benchmark_decontamination", "secret_scan", "best_fit_packing",
    ]


def test_the_rest_works_without_the_llm_folder():
    """The entry module without this subpackage, in a process that can't import it."""
    import subprocess
    import sys

    code = (
        "import sys; sys.modules['cuvee.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; "
        "q = e.queries(); assert 'pipeline' not in q and len(q) > 50 and not any(n.startswith('op') and n[2].isdigit() for n in q); "
        "assert set(e.oracle_sql()) <= set(q)"
    )
    root = str(__import__("pathlib").Path(cp.__file__).parent)
    assert subprocess.run([sys.executable, "-c", code], cwd=root).returncode == 0
