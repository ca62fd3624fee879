"""Run registered queries on Spark and on DuckDB and compare their rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels
conversations""".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=repr)


def compare(spark, con, sf_dir: str, query, sql: str) -> str:
    """Empty if both sides agree exactly, else what differs."""
    df = query(spark, sf_dir)
    columns, mine = _rows(df.columns, df.collect())
    result = con.execute(sql)
    theirs_columns, theirs = _rows([d[0] for d in result.description], result.fetchall())
    if columns != theirs_columns:
        return f"columns {columns} != {theirs_columns}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(wrong)} of {len(mine)} rows differ, first {wrong[0]}" if wrong else ""


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as e
    from cuvee.runtime import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = e.oracle_sql()
    for name, query in e.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        if name in sql:
            outcome = compare(spark, con, sf_dir, query, sql[name]) or "equal"
        else:
            outcome = f"{len(query(spark, sf_dir).collect())} rows, no SQL"
        print(f"{name:28s} {time.time() - start:7.1f}s  {outcome[:400]}", flush=True)
