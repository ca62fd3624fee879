"""Exact top-k search by inner product, pruned by segment statistics from coarse to fine.

A vector is cut into segments; m_s is the mean of segment s times the root of its length, d_s the norm of its deviations from the mean. Then
q.x <= sum_s (m_s(q) m_s(x) + d_s(q) d_s(x)), which is the same as a lower bound of the squared distance |q|^2 + |x|^2 - 2 q.x. With few
segments the bound costs a few products; with many it is tight.

Queries and candidates are dealt to blocks of bounded size. Each pair of blocks is one task, so neither side is broadcast or held
whole. The first candidate block gives every query a score that its k-th best can't fall below; in the other blocks candidates whose
bound is below it are dropped level by level, and only survivors are scored. A block returns k rows a query at most.

Cases: vectors that are null or hold a null, NaN or infinity, and rows with a null id, take no part; rows that share an id are rows of their
own, and a query leaves out only itself; vectors are compared with those of their length only; ties go to the smaller id; scores beyond 64 bits are cut off there; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cuvee.runtime import materialize, ship_package

_FOUND = "query long, vec_id long, row long, score long"
_EXACT = float(2**53)


@dataclass(frozen=True)
class Settings:
    k: int = 20
    #: Components become floor(scale * x).
    scale: float = 64.0
    query_block: int = 2048
    candidate_block: int = 8192
    #: Numbers of segments, from coarse to fine.
    levels: tuple[int, ...] = (1, 4, 16)
    #: Queries scored at once in a task.
    chunk: int = 256


def statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Scaled mean and deviation norm of each segment, side by side, so that a product of two rows is the bound."""
    parts = np.array_split(vectors, min(segments, max(1, vectors.shape[1])), axis=1)
    means = np.stack([p.sum(1) / np.sqrt(max(1, p.shape[1])) for p in parts], axis=1)
    spreads = np.stack([np.sqrt(((p - p.mean(1, keepdims=True)) ** 2).sum(1)) if p.shape[1] else np.zeros(len(p)) for p in parts], axis=1)
    return np.hstack([means, spreads])


def _vectors(column: pa.ChunkedArray, scale: float) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat.reshape(len(lists), -1) * scale)


def _scores(q: np.ndarray, x: np.ndarray, dense: bool) -> np.ndarray:
    """Exact integer products: of all pairs, or of the rows pair by pair; as floats while these are exact."""
    reach = (np.abs(q).max(initial=0) * np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if reach < _EXACT:
        return q @ x.T if dense else np.einsum("ij,ij->i", q, x)
    if reach < 2.0**62:
        q, x = q.astype(np.int64), x.astype(np.int64)
        return q @ x.T if dense else np.einsum("ij,ij->i", q, x)
    q, x = (np.array([[int(c) for c in row] for row in m], dtype=object).reshape(m.shape) for m in (q, x))
    exact = q.dot(x.T) if dense else (q * x).sum(1)
    return np.clip(exact, 1 - 2**63, 2**63 - 1).astype(np.int64)


def best_of_block(
    queries: np.ndarray, q: np.ndarray, floor: np.ndarray, rows: np.ndarray, ids: np.ndarray, x: np.ndarray, settings: Settings
) -> tuple[np.ndarray, ...]:
    """(query, id, row, score) of the k best of ``x`` for each query among those with a score of ``floor`` at least. ``queries`` and ``rows``
    are numbers of rows; a row isn't its own candidate."""
    with np.errstate(over="ignore", invalid="ignore"):  # a bound beyond the range of doubles rules nothing out
        return _best(queries, q, floor, rows, ids, x, settings)


def _best(queries, q, floor, rows_of, ids, x, settings):
    order = np.lexsort((rows_of, ids))
    ids, rows_of, x = ids[order], rows_of[order], x[order]
    of_x = [statistics(x, s) for s in settings.levels]
    out: list[tuple[np.ndarray, ...]] = []
    for at in range(0, len(q), settings.chunk):
        part, own, least = q[at : at + settings.chunk], queries[at : at + settings.chunk], floor[at : at + settings.chunk]
        left = own[:, None] != rows_of[None, :]
        rows, cols = None, None
        for segments, right in zip(settings.levels, of_x, strict=True):
            of_q = statistics(part, segments)
            if rows is None:
                bound = of_q @ right.T
                left &= ~(bound + 1e-9 * np.abs(bound) + 1e-6 < least[:, None])
                if left.mean() < 0.1:
                    rows, cols = np.nonzero(left)
            else:
                bound = np.einsum("ij,ij->i", of_q[rows], right[cols])
                keep = ~(bound + 1e-9 * np.abs(bound) + 1e-6 < least[rows])
                rows, cols = rows[keep], cols[keep]
        if rows is None:
            scores = _scores(part, x, dense=True)
            rows, cols = np.nonzero(left & (scores >= least[:, None]))
            scores = scores[rows, cols]
        else:
            scores = _scores(part[rows], x[cols], dense=False)
            keep = scores >= least[rows]
            rows, cols, scores = rows[keep], cols[keep], scores[keep]
        # By query, then score from high to low, then id; cols follow the ids.
        ranked = np.lexsort((cols, -scores, rows))
        rows, cols, scores = rows[ranked], cols[ranked], scores[ranked]
        nth = np.arange(len(rows)) - np.searchsorted(rows, rows)
        top = nth < settings.k
        out.append((own[rows[top]], ids[cols[top]], rows_of[cols[top]], scores[top].astype(np.int64)))
    return tuple(np.concatenate([o[i] for o in out]) if out else np.zeros(0, np.int64) for i in range(4))


def _usable(rows: DataFrame) -> DataFrame:
    ok = F.col("v").isNotNull() & ~F.exists(
        "v", lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf"))
    )
    return rows.where(F.col("vec_id").isNotNull() & ok)


def search(vectors: DataFrame, is_query: Column, settings: Settings = Settings(), key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best other rows for each row where ``is_query`` holds."""
    spark = vectors.sparkSession
    ship_package(spark)
    given = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    numbered = _usable(given).withColumn("row", F.monotonically_increasing_id())
    rows = materialize(numbered.withColumn("dim", F.size("v")), "vectors")
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("asks"), 1)).alias("q")).first()
    q_blocks = max(1, -(-sizes["q"] // settings.query_block))
    c_blocks = max(1, -(-sizes["n"] // settings.candidate_block))

    def block(n: int, salt: int) -> Column:
        return F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(n)).cast("int")

    asking = rows.where("asks").select("row", "v", "dim", block(q_blocks, 1).alias("qb"))
    # Columns of their own, since a table met with itself would leave open which side is meant.
    offered = rows.select(*[F.col(c).alias(c) for c in ("row", "vec_id", "v", "dim")], block(c_blocks, 2).alias("cb"))
    cut = settings

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        found = (np.zeros(0, np.int64),) * 4
        if left.num_rows and right.num_rows:
            floor = left.column("floor").to_numpy() if "floor" in left.column_names else np.full(left.num_rows, -np.inf)
            found = best_of_block(
                left.column("row").to_numpy(), _vectors(left.column("v"), cut.scale), floor,
                right.column("row").to_numpy(), right.column("vec_id").to_numpy(), _vectors(right.column("v"), cut.scale), cut,
            )
        return pa.table(dict(zip(("query", "vec_id", "row", "score"), map(pa.array, found), strict=True)))

    def each(n: int, name: str, first: int = 0) -> Column:
        return F.explode(F.sequence(F.lit(first), F.lit(n - 1))).alias(name)

    grid = ["dim", "qb", "cb"]
    first = materialize(
        asking.withColumn("cb", F.lit(0)).groupBy(*grid)
        .cogroup(offered.where(F.col("cb") == 0).select("*", each(q_blocks, "qb")).groupBy(*grid)).applyInArrow(compare, _FOUND),
        "first-block",
    )
    if c_blocks > 1:
        # k rows a query at most; the least of k is the floor, fewer give none.
        known = first.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
        floors = known.where(F.col("n") >= settings.k).select(F.col("query").alias("row"), F.col("least").cast("double").alias("floor"))
        with_floor = asking.join(floors, "row", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
        rest = (
            with_floor.select("*", each(c_blocks, "cb", 1)).groupBy(*grid)
            .cogroup(offered.where(F.col("cb") > 0).select("*", each(q_blocks, "qb")).groupBy(*grid)).applyInArrow(compare, _FOUND)
        )
        first = first.unionByName(rest)
    in_order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    ranked = first.withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= settings.k)
    named = rows.where("asks").select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
    return ranked.drop("row").join(named, "query").select("query_id", "rank", "vec_id", "score")
