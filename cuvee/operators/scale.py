"""Building blocks that keep their cost bounded when one key holds a large share of the rows.

``attach``          left join to a lookup table, broadcast only when measured small, hot keys split off otherwise
``attach_columns``  the same for several columns and one long lookup table
``ordered_index``   0-based position in a sort order without a single-task window
``exact_medians``   exact medians by narrowing a bucket count, never by gathering the values
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuvee.runtime import discard, materialize

BROADCAST_BYTES = 64 * 1024 * 1024
# A key is hot if it has more than 1/HOT_PARTS of the rows, or more rows than one task should get.
HOT_PARTS = 1000
ROWS_PER_TASK = 5_000_000
MEDIAN_BUCKETS = 4096


def table_bytes(table: DataFrame) -> int:
    """Measured size of a table: string bytes plus a fixed width for the other columns of every row."""
    strings = [c for c, t in table.dtypes if t == "string"]
    arrays = [c for c, t in table.dtypes if t.startswith("array")]
    fixed = 16 + 16 * len(table.columns)
    per_row = reduce(
        lambda a, b: a + b,
        [F.coalesce(F.octet_length(F.col(c)), F.lit(0)) for c in strings]
        + [F.greatest(F.size(F.col(c)), F.lit(0)) * 8 for c in arrays],
        F.lit(fixed),
    )
    return table.agg(F.sum(per_row.cast("long"))).first()[0] or 0


def fits_broadcast(table: DataFrame, limit: int | None = None) -> bool:
    return table_bytes(table) <= (BROADCAST_BYTES if limit is None else limit)


def hot_from(total: int) -> float:
    """Rows above which a key is hot; there are fewer than ``HOT_PARTS`` or ``total / ROWS_PER_TASK`` such keys."""
    return min(total / HOT_PARTS, ROWS_PER_TASK)


def _salts(rows: DataFrame) -> int:
    """Over how many parts a hot key is spread: at least one per shuffle partition."""
    return max(4096, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def hot_keys(rows: DataFrame, on: Sequence[str]) -> DataFrame:
    """The hot keys of ``rows``, from partial counts."""
    total = rows.count()
    keyed = rows.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on]))
    counts = keyed.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    return materialize(counts.where(F.col("_n") > hot_from(total)).drop("_n"), "hot-keys")


def attach(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    spread: Sequence[str],
    *,
    small: bool | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Left join ``rows`` to ``lookup`` (unique on ``on``), keeping every row.

    ``small`` is the outcome of an earlier ``fits_broadcast``; without it the lookup is measured here. A lookup that
    is too large to broadcast is joined by shuffle, but the hot keys of ``rows`` are first taken out: few keys
    can be hot, so their part of the lookup is broadcast, and hot and null keyed rows are spread
    over salts by the hash of the ``spread`` columns. No task then gets more rows for one key than makes it hot. ``hot`` is the outcome of an earlier ``hot_keys`` over the same rows.
    """
    on = list(on)
    if small is None:
        small = fits_broadcast(lookup)
    values = [c for c in lookup.columns if c not in on]
    if small:
        return rows.join(F.broadcast(lookup), on, "left").select(*rows.columns, *values)

    if hot is None:
        hot = hot_keys(rows, on)
    known = hot.join(lookup, on, "left").select(
        *on, F.lit(True).alias("_hot"), *[F.col(c).alias(f"_hot_{c}") for c in values]
    )
    anywhere = F.pmod(F.xxhash64(*[F.col(c) for c in spread]), F.lit(_salts(rows))) + 1
    no_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    salted = rows.join(F.broadcast(known), on, "left").withColumn(
        "_salt", F.when(F.col("_hot") | no_key, anywhere).otherwise(F.lit(0).cast("long"))
    )
    joined = salted.join(lookup.withColumn("_salt", F.lit(0).cast("long")), [*on, "_salt"], "left")
    return joined.select(
        *rows.columns,
        *[F.when(F.col("_hot"), F.col(f"_hot_{c}")).otherwise(F.col(c)).alias(c) for c in values],
    )


def attach_columns(
    rows: DataFrame, lookup: DataFrame, columns: Sequence[str], spread: Sequence[str], small: Mapping[str, bool]
) -> DataFrame:
    """``attach`` for a long lookup (column, value, x): adds ``x`` of the value of each column as ``_x_<column>``.

    Columns with a small part in the lookup are broadcast. The hot values of the others are found on the input, in
    one job for all of them, so that no join is run again to look at its result.
    """
    large = [c for c in columns if not small.get(c, True)]
    hot = None
    if large:
        values = rows.select(*[F.col(c).cast("string").alias(c) for c in large]).unpivot([], large, "column", "value")
        counts = values.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        hot = materialize(counts.where(F.col("n") > hot_from(rows.count())), "hot-keys")
    x = next(c for c in lookup.columns if c not in ("column", "value"))
    for c in columns:
        own = lookup.where(F.col("column") == c).select(F.col("value").alias(c), F.col(x).alias(f"_x_{c}"))
        own_hot = hot.where(F.col("column") == c).select(F.col("value").alias(c)) if c in large else None
        rows = attach(rows, own, [c], spread, small=c not in large, hot=own_hot)
    return rows


def small_columns(lookup: DataFrame, limit: int | None = None) -> dict[str, bool]:
    """For each column of a long lookup (column, value, ...): whether its part may be broadcast.

    The limit holds for all of them together, since one stage holds them all: the smallest are broadcast first.
    """
    left = BROADCAST_BYTES if limit is None else limit
    size = F.sum(F.octet_length("value").cast("long") + 48).alias("size")
    small = {}
    for r in sorted(lookup.groupBy("column").agg(size).collect(), key=lambda r: (r["size"], r["column"])):
        small[r["column"]] = r["size"] <= left
        left -= r["size"] if small[r["column"]] else 0
    return small


def ordered_index(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Add the 0-based position of each row in the order of the ``order`` columns (which must be unique).

    A range-partitioned sort numbers the rows inside each partition; one small count per partition turns that into
    a global position.
    """
    ranked = materialize(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright(F.col("_at"), 33).cast("int")
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ranked.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    starts, seen = [], 0
    for row in sorted(sizes, key=lambda r: r["p"]):
        starts.append((row["p"], seen))
        seen += row["n"]
    # One row per partition of the sort, which is bounded by spark.sql.shuffle.partitions.
    offsets = df.sparkSession.createDataFrame(starts, "p int, start long")
    return (
        ranked.withColumn("p", part)
        .join(F.broadcast(offsets), "p")
        .withColumn(name, F.col("start") + inside)
        .drop("_at", "p", "start")
    )


def _squeezed(x: float) -> float:
    return math.copysign(min(math.log1p(abs(x)), 800.0), x)


def _bucket(x: Column, lo: float, hi: float) -> Column:
    """Number of the step of ``x`` between ``lo`` and ``hi``; it never falls as ``x`` rises. A range whose width might overflow, or
    that holds an infinity, is cut into steps of the logarithm."""
    first = F.when(x <= F.lit(lo), 0).otherwise(1)
    if not (abs(lo) < 1e300 and abs(hi) < 1e300):
        x, lo, hi = F.signum(x) * F.least(F.log1p(F.abs(x)), F.lit(800.0)), _squeezed(lo), _squeezed(hi)
    if lo == hi:  # the logarithms are the same: the lowest value and the rest
        return first
    step = F.floor((x - F.lit(lo)) / F.lit(hi - lo) * MEDIAN_BUCKETS)
    return F.greatest(F.least(step, F.lit(MEDIAN_BUCKETS - 1)), F.lit(0))


def exact_medians(df: DataFrame, values: Mapping[str, Column]) -> dict[str, float | None]:
    """Exact median of each expression over its non-null values; the mean of the middle two for an even count.

    Each pass counts the values of a bracket in ``MEDIAN_BUCKETS`` equal steps and keeps the step that holds the
    middle. The step number never falls as the value rises, so the outcome is exact, and a pass shuffles only
    counters. The bracket shrinks to one value after a few passes.
    """
    names = list(values)
    columns = [F.nanvl(values[n].cast("double"), F.lit(None)).alias(f"v{i}") for i, n in enumerate(names)]
    # Every pass reads the same few columns, so they are worked out once.
    doubles = materialize(df.select(*columns), "median-columns")
    first = doubles.agg(
        *[
            f(F.col(f"v{i}")).alias(f"{tag}{i}")
            for i in range(len(names))
            for tag, f in (("n", F.count), ("lo", F.min), ("hi", F.max))
        ]
    ).first()

    found: dict[int, dict[str, float]] = {}
    open_: dict[int, tuple[float, float, int, int]] = {}
    medians: dict[str, float | None] = {}
    for i, name in enumerate(names):
        n, lo, hi = first[f"n{i}"], first[f"lo{i}"], first[f"hi{i}"]
        if n == 0:
            medians[name] = None
        elif lo == hi:
            medians[name] = lo
        else:
            open_[i] = (lo, hi, (n - 1) // 2, n // 2)

    while open_:
        cells = []
        for i, (lo, hi, _, _) in open_.items():
            x = F.col(f"v{i}")
            step = _bucket(x, lo, hi)
            cells.append(F.when(x.between(lo, hi), F.struct(F.lit(i).alias("i"), step.cast("int").alias("b"), x.alias("x"))))
        counted = (
            doubles.select(F.explode(F.array(*cells)).alias("c"))
            .where(F.col("c").isNotNull())
            .groupBy("c.i", "c.b")
            .agg(F.count(F.lit(1)).alias("n"), F.min("c.x").alias("lo"), F.max("c.x").alias("hi"))
            .collect()
        )
        narrowed: dict[int, tuple[float, float, int, int]] = {}
        for i, (_, _, r1, r2) in open_.items():
            seen = 0
            for cell in sorted((c for c in counted if c["i"] == i), key=lambda c: c["b"]):
                has1 = seen <= r1 < seen + cell["n"]
                has2 = seen <= r2 < seen + cell["n"]
                if has1 and has2:
                    if cell["lo"] == cell["hi"]:
                        medians[names[i]] = cell["lo"]
                    else:
                        narrowed[i] = (cell["lo"], cell["hi"], r1 - seen, r2 - seen)
                elif has1:
                    found.setdefault(i, {})["low"] = cell["hi"]
                elif has2:
                    medians[names[i]] = (found[i]["low"] + cell["lo"]) / 2
                seen += cell["n"]
        open_ = narrowed
    discard(doubles)
    return medians
