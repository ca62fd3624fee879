"""Train/test splits, folds and samples: functions of the row id, so they do not depend on the partitions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuvee.operators.scale import ordered_index
from cuvee.schema import KEY


@dataclass(frozen=True)
class Keys:
    """Number of rows, and whether their keys are 0 .. n - 1, each once."""

    n: int
    contiguous: bool


def keys_of(df: DataFrame, key: str = KEY) -> Keys:
    """Found in one pass over the key. Which numbers occur is held as bits, 32,768 to a row, so little is shuffled and no key is."""
    if dict(df.dtypes)[key] not in ("tinyint", "smallint", "int", "bigint"):
        return Keys(df.count(), False)
    number = F.col(key).cast("long")
    bits = F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(number)))
    blocks = df.groupBy(F.bitmap_bucket_number(number).alias("b")).agg(
        F.count(F.lit(1)).alias("n"), F.min(number).alias("low"), F.max(number).alias("high"), bits.alias("different")
    )
    r = blocks.agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("different").alias("different")).first()
    n = r["n"] or 0
    return Keys(n, n == 0 or (r["low"] == 0 and r["high"] == n - 1 and r["different"] == n))


def with_position(df: DataFrame, key: str = KEY, name: str = "position") -> DataFrame:
    """0-based position by key, for tables whose ids have gaps. Rows that share a key stand in the order of a hash of the row, so the
    position does not follow the partitions. Unneeded when ids run from 0 to n - 1."""
    hashed = [c for c, kind in df.dtypes if "map<" not in kind and "vector" not in kind]
    return ordered_index(df.withColumn("_tie", F.xxhash64(*hashed)), [key, "_tie"], name).drop("_tie")


def positions(df: DataFrame, keys: Keys, key: str = KEY, name: str = "_position") -> DataFrame:
    """``df`` with its 0-based position by key: the key itself if it has no gaps, else the place in its order."""
    return df.withColumn(name, F.col(key)) if keys.contiguous else with_position(df, key, name)


def split_prefix(df: DataFrame, fraction: float, key: str = KEY) -> DataFrame:
    """The first int(n * fraction) rows by key are the test set, all others the train set. With keys 0 .. n - 1 these are
    the rows labelled 0 .. int(n * fraction) - 1."""
    keys = keys_of(df, key)
    placed = positions(df, keys, key)
    return placed.withColumn("split", F.when(F.col("_position") < int(keys.n * fraction), "test").otherwise("train")).drop("_position")


def _uniform(seed: int, key: str) -> Column:
    """A number below 2^60 from the seed and the key, the same in any engine: the start of the MD5 of ``seed:key``."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    return F.conv(F.left(digest, F.lit(15)), 16, 10).cast("long")


def split_hash(df: DataFrame, fraction: float, seed: int, key: str = KEY) -> DataFrame:
    """Random split by a seeded hash of the key: the same rows whatever the order or partitioning."""
    bucket = F.pmod(_uniform(seed, key), F.lit(1_000_000))
    return df.withColumn("split", F.when(bucket < int(round(fraction * 1_000_000)), "test").otherwise("train"))


def sample_rows(df: DataFrame, n: int, seed: int, key: str = KEY) -> DataFrame:
    """A random sample of exactly ``n`` rows (all rows if there are fewer)."""
    return df.orderBy(_uniform(seed, key), key).limit(n)


def fold_of(position: Column, n: int, k: int) -> Column:
    """Contiguous folds 0 .. k-1 of positions 0 .. n-1; the first ``n % k`` folds get one row more."""
    size, extra = divmod(n, k)
    edge = extra * (size + 1)
    later = (position - edge).cast("double") / max(size, 1) + extra
    return F.floor(F.when(position < edge, position.cast("double") / (size + 1)).otherwise(later)).cast("int")


def kfold(df: DataFrame, k: int, position: str = KEY) -> DataFrame:
    """Contiguous folds by key; keys with gaps are numbered in their order first."""
    keys = keys_of(df, position)
    return positions(df, keys, position).withColumn("fold", fold_of(F.col("_position"), keys.n, k)).drop("_position")
