"""Connected components of a link table, as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuvee.runtime import discard, materialize


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b); component is the smallest id that can be reached.

    Each round maps every node to the first of itself and its neighbours, joins the links to that map and drops loops.
    Odd rounds order nodes by id, which closes stars at once; even rounds by a hash, which halves long chains. A round is
    stored, so a lost executor costs one round. Minima are partial before they are shuffled, and the links of a node with
    very many of them are split by the skew join. Null ids take no part; no links give no rows.
    """
    edges = materialize(
        links.select("a", "b").where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).distinct(),
        "links",
    )
    labels = None
    number = 0
    while edges.limit(1).count():
        order = F.col("n") if number % 2 == 0 else F.xxhash64("n", F.lit(number))
        neighbours = edges.select(F.col("a").alias("v"), F.col("b").alias("n")).union(
            edges.select(F.col("b").alias("v"), F.col("a").alias("n"))
        )
        ranked = neighbours.select("v", F.struct(order.alias("o"), F.col("n")).alias("n"))
        own = F.struct((F.col("v") if number % 2 == 0 else F.xxhash64("v", F.lit(number))).alias("o"), F.col("v").alias("n"))
        first = materialize(
            ranked.groupBy("v").agg(F.min("n").alias("m")).select("v", F.least(F.col("m"), own)["n"].alias("m")), "first"
        )
        to_a = first.select(F.col("v").alias("a"), F.col("m").alias("x"))
        to_b = first.select(F.col("v").alias("b"), F.col("m").alias("y"))
        read = [edges, first, labels]
        edges = materialize(
            edges.join(to_a, "a").join(to_b, "b").where(F.col("x") != F.col("y"))
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            "links",
        )
        if labels is None:
            labels = first.select(F.col("v").alias("id"), F.col("m").alias("root"))
        else:
            moved = first.select(F.col("v").alias("root"), F.col("m").alias("to"))
            labels = labels.join(moved, "root", "left").select("id", F.coalesce("to", "root").alias("root"))
        labels = materialize(labels, "labels")
        discard(*[t for t in read if t is not None])
        number += 1
    discard(edges)
    if labels is None:
        kind = dict(links.dtypes)["a"]
        return links.sparkSession.createDataFrame([], f"id {kind}, component {kind}")
    least = materialize(labels.groupBy("root").agg(F.min("id").alias("component")), "least")
    return labels.join(least, "root").select("id", "component")
