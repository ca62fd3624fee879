"""Hard negatives: rows of another label that score nearly as high as an anchor's positives, bounded along a spanning tree of anchors.

For a row x and anchors p and a, |a.x - p.x| <= |a - p| |x|. The anchors of a block are joined by a minimum spanning tree. A block of
candidates is scored against the root; from there each anchor's scores are known up to its edge times the candidate's norm, plus
what was unknown at its parent. Only candidates whose range meets the window of scores that is looked for are scored, and for these the range
is a point again. The window narrows as rows are found: below the k-th best of a target nothing is needed.

Anchors are put in order of label and signs of their first components, so that edges are short, and cut into blocks of
bounded size; candidates are dealt to blocks by hash. A pair of blocks is a task and returns k rows a target at most. Positives are looked for
in the blocks that hold an anchor of the row's label, negatives in all.

Cases: rows with a null label, a null vector, or a null or non-finite component take no part; a row with a null id is never an anchor and
stands last among ties; rows that share an id are rows of their own, and an anchor leaves out only itself; vectors are compared with
those of their length only; scores beyond 64 bits are cut off there; an empty table, or no anchors, gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cuvee.llm.common import sized
from cuvee.llm.topk import _scores as exact_products
from cuvee.llm.topk import _vectors as scaled_vectors
from cuvee.operators.scale import ordered_index
from cuvee.runtime import materialize, ship_package

_FOUND = "anchor long, target int, row long, id long, score long"
_LEAST, _MOST = -(2**63), 2**63 - 1


@dataclass(frozen=True)
class Settings:
    positives: int = 5
    negatives: int = 10
    #: A negative scores so many percent of the positive, from and to.
    low: int = 30
    high: int = 90
    #: Components become floor(scale * x).
    scale: float = 256.0
    anchor_block: int = 512
    candidate_block: int = 8192
    #: Candidates bounded at once in a task.
    chunk: int = 1024
    #: Components whose signs put anchors in order.
    signs: int = 16


@dataclass
class Tree:
    """``levels``: the vertices by their distance from the root; ``parent`` and ``edge`` of each vertex."""

    levels: list[np.ndarray]
    parent: np.ndarray
    edge: np.ndarray


def spanning_tree(vectors: np.ndarray) -> Tree:
    """A minimum spanning tree under the Euclidean distance, grown from vertex 0."""
    n = len(vectors)
    parent, edge, depth = np.zeros(n, np.int64), np.full(n, np.inf), np.zeros(n, np.int64)
    left = np.ones(n, bool)
    at = 0
    for _ in range(n):
        left[at] = False
        distance = np.sqrt(((vectors - vectors[at]) ** 2).sum(1))
        nearer = left & ~(distance >= edge)  # a distance that is no number takes part too, as an edge that bounds nothing
        edge[nearer], parent[nearer] = distance[nearer], at
        if left.any():
            at = int(np.flatnonzero(left)[np.argmin(np.where(np.isnan(edge[left]), np.inf, edge[left]))])
            depth[at] = depth[parent[at]] + 1
    edge[0] = 0.0
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1) if n else []
    return Tree(levels, parent, edge)


@dataclass
class Targets:
    """What is looked for: the anchor of each target, the scores it takes, and a number that tells an anchor's targets apart."""

    anchor: np.ndarray
    low: np.ndarray
    high: np.ndarray
    number: np.ndarray


def _windows(targets: Targets, floor: np.ndarray, anchors: int) -> tuple[np.ndarray, np.ndarray]:
    """From and to which score an anchor needs rows for any of its targets; nothing where the first is above the second."""
    low, high = np.full(anchors, np.inf), np.full(anchors, -np.inf)
    least = np.maximum(targets.low, floor)
    open_ = least <= targets.high
    np.minimum.at(low, targets.anchor[open_], least[open_].astype(float))
    np.maximum.at(high, targets.anchor[open_], targets.high[open_].astype(float))
    return low, high


def bounded_scores(tree: Tree, anchors: np.ndarray, x: np.ndarray, low: np.ndarray, high: np.ndarray, allowed: np.ndarray):
    """(anchor, candidate, score) of every allowed pair whose score may lie in the anchor's window; and how many pairs were scored."""
    norms = np.sqrt((x**2).sum(1))
    from_, to = np.empty((len(anchors), len(x))), np.empty((len(anchors), len(x)))
    found, scored = [], 0
    for depth, level in enumerate(tree.levels):
        if depth == 0:
            need = np.ones((1, len(x)), bool)
        else:
            slack = tree.edge[level][:, None] * norms
            up = tree.parent[level]
            slack += 1e-9 * (np.abs(from_[up]) + np.abs(to[up]) + slack) + 1e-6
            from_[level], to[level] = from_[up] - slack, to[up] + slack
            # Written so that a bound that is no number rules nothing out.
            need = allowed[level] & ~(to[level] < low[level][:, None]) & ~(from_[level] > high[level][:, None])
        if not need.any():
            continue
        rows, cols = np.nonzero(need)
        if need.mean() > 0.25:
            exact = exact_products(anchors[level], x, dense=True)[rows, cols]
        else:
            exact = exact_products(anchors[level][rows], x[cols], dense=False)
        scored += len(rows)
        rows = level[rows]
        from_[rows, cols] = to[rows, cols] = exact
        take = allowed[rows, cols] & ~(exact < low[rows]) & ~(exact > high[rows])
        found.append((rows[take], cols[take], exact[take].astype(np.int64)))
    if not found:
        return (np.zeros(0, np.int64),) * 3, scored
    return tuple(np.concatenate([f[i] for f in found]) for i in range(3)), scored


def best_of_block(
    rows: np.ndarray, anchors: np.ndarray, labels: np.ndarray, targets: Targets,
    of_rows: np.ndarray, x: np.ndarray, of_labels: np.ndarray, same: bool, k: int, settings: Settings,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(target, candidate, score): the k best candidates of each target; of equal scores the earlier candidate."""
    with np.errstate(over="ignore", invalid="ignore"):
        tree = spanning_tree(anchors)
        by_anchor = np.argsort(targets.anchor, kind="stable")
        first = np.searchsorted(targets.anchor[by_anchor], np.arange(len(anchors) + 1))
        floor = np.full(len(targets.anchor), _LEAST, np.int64)
        kept = (np.zeros(0, np.int64),) * 3
        for at in range(0, len(x), settings.chunk):
            part = slice(at, at + settings.chunk)
            allowed = ((labels[:, None] == of_labels[part]) == same) & (rows[:, None] != of_rows[part])
            low, high = _windows(targets, floor, len(anchors))
            (a, c, score), _ = bounded_scores(tree, anchors, x[part], low, high, allowed)
            # Each pair meets the targets of its anchor.
            many = first[a + 1] - first[a]
            pair = np.repeat(np.arange(len(a)), many)
            target = by_anchor[np.repeat(first[a], many) + np.arange(len(pair)) - np.repeat(np.cumsum(many) - many, many)]
            score, c = score[pair], c[pair] + at
            fits = (score >= np.maximum(targets.low, floor)[target]) & (score <= targets.high[target])
            merged = [np.concatenate(p) for p in zip(kept, (target[fits], c[fits], score[fits]), strict=True)]
            # By target, then score from high to low; ~s is -s - 1, which has no overflow. Candidates come in the order of ties.
            order = np.lexsort((merged[1], ~merged[2], merged[0]))
            merged = [m[order] for m in merged]
            nth = np.arange(len(order)) - np.searchsorted(merged[0], merged[0])
            kept = tuple(m[nth < k] for m in merged)
            full = nth == k - 1
            floor[merged[0][full]] = merged[2][full]
    return kept


def _usable(label: str) -> Column:
    number = F.exists("v", lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return F.col("v").isNotNull() & F.col(label).isNotNull() & ~number


def _search(anchors: DataFrame, offered: DataFrame, c_blocks: int, same: bool, k: int, settings: Settings) -> DataFrame:
    """The k best of ``offered`` (row, id, v, dim, label, block, cb) for each target of ``anchors`` (row, v, dim, label, block, targets)."""

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        found, number = (np.zeros(0, np.int64),) * 3, np.zeros(0, np.int64)
        rows = left.column("row").to_numpy()
        right = right.sort_by([("id", "ascending"), ("row", "ascending")])  # nulls go last
        if left.num_rows and right.num_rows:
            given = left.column("targets").to_pylist()
            flat = [(at, t["low"], t["high"], t["number"]) for at, own in enumerate(given) for t in own]
            targets = Targets(*(np.array(c, dtype=np.int64) for c in zip(*flat, strict=True)))
            number = targets.number
            found = best_of_block(
                rows, scaled_vectors(left.column("v"), settings.scale), left.column("label").to_numpy(), targets,
                right.column("row").to_numpy(), scaled_vectors(right.column("v"), settings.scale), right.column("label").to_numpy(),
                same, k, settings,
            )
            rows = rows[targets.anchor]
        target, candidate, score = found
        at = pa.array(candidate)
        columns = [pa.array(rows[target]), pa.array(number[target], pa.int32()), right.column("row").take(at), right.column("id").take(at)]
        return pa.table([*columns, pa.array(score)], names=["anchor", "target", "row", "id", "score"])

    grid = ["dim", "block", "cb"]
    dealt = anchors.select("*", F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))).alias("cb"))
    return dealt.groupBy(*grid).cogroup(offered.groupBy(*grid)).applyInArrow(compare, _FOUND)


def _first(found: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame, is_anchor: Column, settings: Settings = Settings(), key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where ``is_anchor`` holds."""
    spark = vectors.sparkSession
    ship_package(spark)
    given = vectors.select(
        F.col(key).cast("long").alias("id"), F.col(vector).alias("v"), F.col(label).cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"),
    )
    numbered = given.where(_usable("label")).withColumn("row", F.monotonically_increasing_id())
    rows = materialize(numbered.withColumn("dim", F.size("v")), "candidates")
    n = rows.count()
    c_blocks = max(1, -(-n // settings.candidate_block))
    signs = F.array_join(F.transform(F.slice("v", 1, settings.signs), lambda x: F.when(x > 0, "1").otherwise("0")), "")
    asking = rows.where(F.col("asks") & F.col("id").isNotNull()).withColumn("code", signs)
    placed = ordered_index(asking, ["dim", "label", "code", "row"], "at")
    anchors = materialize(
        placed.select("row", "id", "v", "dim", "label", F.floor(F.col("at") / settings.anchor_block).cast("int").alias("block")), "anchors"
    )
    blocks = anchors.agg(F.max("block")).first()[0]
    if blocks is None:
        empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return spark.createDataFrame([], empty)

    def target(number: Column, low: Column, high: Column) -> Column:
        return F.struct(number.cast("int").alias("number"), low.cast("long").alias("low"), high.cast("long").alias("high"))

    offered = rows.select(
        *[F.col(c).alias(c) for c in ("row", "id", "v", "dim", "label")], F.pmod(F.xxhash64("row"), F.lit(c_blocks)).cast("int").alias("cb")
    )
    holders = materialize(anchors.select("dim", "label", "block").distinct(), "anchor-labels")
    any_score = anchors.drop("id").withColumn("targets", F.array(target(F.lit(0), F.lit(_LEAST), F.lit(_MOST))))
    nearest = _search(any_score, offered.join(sized(holders), ["dim", "label"]), c_blocks, True, settings.positives, settings)
    positives = materialize(
        _first(nearest, settings.positives, "anchor").select(
            F.col("anchor").alias("row"), F.col("rank").alias("number"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
        ),
        "positives",
    )

    # Whole numbers from low percent, rounded up, to high percent, rounded down. The decimals hold every product of a 64-bit score.
    score = F.col("positive_score").cast("decimal(20,0)")
    low = F.ceil(score * settings.low / F.lit(100).cast("decimal(3,0)"))
    high = F.floor(score * settings.high / F.lit(100).cast("decimal(3,0)"))
    windows = positives.select("row", target(F.col("number"), low, high).alias("t")).where(F.col("t.low") <= F.col("t.high"))
    asked = anchors.drop("id").join(windows.groupBy("row").agg(F.collect_list("t").alias("targets")), "row")
    everywhere = offered.select("*", F.explode(F.sequence(F.lit(0), F.lit(int(blocks)))).alias("block"))
    found = _first(_search(asked, everywhere, c_blocks, False, settings.negatives, settings), settings.negatives, "anchor", "target")
    named = anchors.select("row", F.col("id").alias("anchor_id"))
    told = found.select(
        F.col("anchor").alias("row"), F.col("target").alias("number"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    return told.join(positives, ["row", "number"]).join(named, "row").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
