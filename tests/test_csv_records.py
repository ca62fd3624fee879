import os
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cuvee.sources import csv_records as cr
from cuvee.sources.reviews import read_reviews_csv


def brute_records(content, header=False):
    """Records of one file, character by character."""
    records, now, state, cell_begins = [], "", "out", True
    for c in content:
        if c == '"':
            if state == "in":
                state = "closed"
            elif state == "closed" or cell_begins:
                state = "in"
            else:
                state = "out"
            cell_begins = False
        elif c == "\n" and state != "in":
            records.append(now)
            now, state, cell_begins = "", "out", True
            continue
        elif state != "in":
            state, cell_begins = "out", c == ","
        now += c
    records.append(now)
    told = [r[:-1] if r.endswith("\r") else r for r in records]
    return [r for r in told if r][1 if header else 0 :]


@pytest.fixture()
def split_size(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.execution.arrow.maxRecordsPerBatch")
    before = {n: spark.conf.get(n) for n in names}

    def set_size(size, rows=10_000):
        for name, value in zip(names, (size, 1, rows)):
            spark.conf.set(name, str(value))

    yield set_size
    for name, value in before.items():
        spark.conf.set(name, value)


def store(folder, contents):
    for i, content in enumerate(contents):
        with open(os.path.join(folder, f"{i}.csv"), "w", newline="", encoding="utf-8") as f:
            f.write(content)
    return folder


def messy(seed, records):
    rng = random.Random(seed)
    cells = ["", "a", "b,c", 'say ""hi""', "one\ntwo", "x\r\ny", "\n", "\n\n\n", "é日", '""', ",", "long " * 9, "\n".join("lines")]
    out = []
    for _ in range(records):
        row = [(f'"{c}"' if rng.random() < 0.5 or set(c) & set('\n,"') else c) for c in rng.choices(cells, k=rng.randrange(1, 5))]
        if rng.random() < 0.1:
            row.append(rng.choice(['5" pipe', '"closed" early', 'a "quoted" word', ' "blank first']))
        out.append(",".join(row))
    return rng.choice(["\n", "\r\n"]).join(out) + rng.choice(["", "\n"])


@pytest.mark.parametrize("size", [7, 64, 500, 1 << 20])
@pytest.mark.parametrize("header", [False, True])
def test_records_do_not_depend_on_the_splits(spark, folder, split_size, size, header):
    contents = [messy(i, 60) for i in range(3)] + ["", "only a header", "\n\nblank lines first\nsecond\n"]
    split_size(size, rows=4)
    records = cr.read_records(spark, store(folder, contents), header)
    expected = sorted(r for c in contents for r in brute_records(c, header))
    assert len(expected) > 150
    assert sorted(r.record for r in records.collect()) == expected
    splits = sum(-(-len(c.encode()) // size) for c in contents)
    assert records.rdd.getNumPartitions() >= min(splits, 4)


def test_one_large_file_is_read_in_many_tasks(spark, folder, split_size):
    rows = [f'{i},"Italy","first line\nsecond, ""quoted"" line {i}\n",D,{80 + i % 20},12.5,P,R,S,T,@t,"Wine {i}",V,W' for i in range(2000)]
    path = store(folder, ["\n".join([",country,description", *rows])])
    split_size(4096)
    read = read_reviews_csv(spark, path)
    tasks = read.select(F.spark_partition_id().alias("p"), "row_id", "description").collect()
    assert len({r.p for r in tasks}) > 20
    assert sorted((r.row_id, r.description) for r in tasks) == [(i, f'first line\nsecond, "quoted" line {i}\n') for i in range(2000)]


def test_splits_that_changed_since_the_plan_are_an_error(spark, folder, split_size):
    path = store(folder, [messy(1, 400)])
    split_size(512)
    records = cr.read_records(spark, path)
    split_size(300)
    with pytest.raises(Exception, match="read it again"):
        records.select("record").where(F.length("record") > 2).collect()


def test_a_quote_that_is_never_closed(spark, folder, split_size):
    content = 'h\na,b\nc,"open\n' + "x\n" * 300
    split_size(64)
    found = {r.record for r in cr.read_records(spark, store(folder, [content])).collect()}
    assert found == {"a,b", 'c,"open\n' + "x\n" * 299 + "x"}
    rows = [{"file": 1, "block": b, "first": 0, "to0": 1, "to1": 1, "head0": -1, "head1": 5, "tail0": 0, "tail1": -1} for b in (0, 100, 200)]
    assert cr.plan_splits(rows, longest=200)[1, 200].head_owner == 0
    with pytest.raises(ValueError, match="longer than 150 bytes"):
        cr.plan_splits(rows, longest=150)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text('a",b ', max_size=12), min_size=1, max_size=6))
def test_maps_of_lines(lines):
    f0, f1 = cr.line_maps(pa.array(["before", *lines]).slice(1))
    for line, outside, inside in zip(lines, f0, f1):
        # A line that is still open takes what follows into its record.
        assert outside == (line != "" and len(brute_records(line + "\nz")) == 1)
        assert inside == (len(brute_records('"x' + line + "\nz")) == 1)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 1)), max_size=30), st.integers(0, 1))
def test_states_are_the_maps_one_after_another(maps, begin):
    state, expected = begin, [begin]
    for m in maps:
        state = m[state]
        expected.append(state)
    f0, f1 = (np.array([m[k] for m in maps], dtype=bool) for k in (0, 1))
    assert cr.states(f0, f1, begin).tolist() == expected
