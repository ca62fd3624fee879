"""Near-duplicate documents by min-max hashing: the minimum and the maximum under each permutation are both kept.

1. ``signatures``: one pass; the distinct shingles of a text as 64-bit hashes, their minima and maxima under ``permutations``
   permutations, and ``bands`` of ``band_rows`` of these 2 * permutations values. With the defaults a pair with similarity
   0.8 shares no band with probability (1 - 0.8^5)^32 = 3e-6.
2. ``classes``: documents with equal shingle sets form one class; only its smallest id goes on.
3. ``star_links``: in each bucket of a band every member is paired with the smallest id, and the pair confirmed on full sets.
4. ``residual_links``: buckets whose members are still in several components are worked through in blocks of bounded size;
   every pair across components is compared, on full sets when the signatures don't rule it out, and only the links that
   join components come out. So no bucket is capped and none is expanded into pairs.
5. ``components`` of the links; equal sets get the component of their class.

Cases: null texts, and texts without words, have an empty set and are linked with nothing. Rows that share an id are one
document, with the smallest of their sets by hash; rows with a null id aren't compared nor returned. An empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuvee.llm.common import give_back, sized, to_python
from cuvee.llm.components import components
from cuvee.llm.wordhash import mix, words_by_text
from cuvee.runtime import discard, materialize

_ORDER = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.uint64(0x2545F4914F6CDD1D)


@dataclass(frozen=True)
class Settings:
    shingle_words: int = 5
    #: Least similarity of a link, in hundredths: 100 * intersection >= percent * union.
    percent: int = 80
    permutations: int = 80
    band_rows: int = 5
    #: Members of a bucket that are compared with each other in one task at most.
    block: int = 1024
    #: Pairs whose share of equal signature values is this far below the threshold are not compared on full sets; 4.7
    #: standard deviations of 160 values.
    slack: float = 0.15
    seed: int = 11

    @property
    def bands(self) -> int:
        return 2 * self.permutations // self.band_rows


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; of the whole sequence if it is shorter."""
    if not len(words):
        return words
    size = min(size, len(words))
    runs = words[: len(words) - size + 1].copy()
    for k in range(1, size):
        runs = mix(runs * _ORDER + words[k : len(words) - size + 1 + k])
    return np.unique(mix(runs ^ np.uint64(size)) if size > 1 else runs)


def min_max(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The minima, then the maxima, of the shingles under each permutation x -> x * factor mod 2^64."""
    low = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    high = np.zeros(len(factors), dtype=np.uint64)
    for at in range(0, len(shingles), 2048):
        hashed = shingles[None, at : at + 2048] * factors[:, None]
        np.minimum(low, hashed.min(1), out=low)
        np.maximum(high, hashed.max(1), out=high)
    return np.concatenate([low, high])


def _factors(settings: Settings) -> np.ndarray:
    return np.random.default_rng(settings.seed).integers(1, 2**63, settings.permutations, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def band_hashes(values: np.ndarray, settings: Settings) -> np.ndarray:
    rows = values[: settings.bands * settings.band_rows].reshape(settings.bands, settings.band_rows)
    keys = mix(np.arange(settings.bands, dtype=np.uint64) + _EMPTY)
    for k in range(settings.band_rows):
        keys = mix(keys * _ORDER + rows[:, k])
    return keys


def signatures(docs: DataFrame, settings: Settings, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, h1, h2, bands): h1 and h2 tell sets apart; bands is null for an empty set."""
    to_python(docs.sparkSession)
    factors = _factors(settings)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, one, two, bands = [], [], [], []
            for _, words in words_by_text(batch.column(1)):
                s = shingle_set(words, settings.shingle_words)
                sizes.append(len(s))
                one.append(np.add.reduce(s) if len(s) else np.uint64(0))
                two.append(np.add.reduce(mix(s ^ _EMPTY)) if len(s) else np.uint64(0))
                bands.append(band_hashes(min_max(s, factors), settings).view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(np.array(one, dtype=np.uint64).view(np.int64)),
                    pa.array(np.array(two, dtype=np.uint64).view(np.int64)),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["id", "n_shingles", "h1", "h2", "bands"],
            )
        give_back()

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("t")).where(F.col("id").isNotNull())
    return rows.mapInArrow(sign, "id long, n_shingles long, h1 long, h2 long, bands array<long>")


def shingle_sets(docs: DataFrame, ids: DataFrame, settings: Settings, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, h1, shingles array<long>, signature binary) of the documents in the stored table ``ids`` (id)."""
    to_python(docs.sparkSession)
    factors = _factors(settings)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, one, low, first = [], [], [], 0
            for row, words in words_by_text(batch.column(1)):
                s = shingle_set(words, settings.shingle_words)
                found.append(s.view(np.int64))
                one.append(np.add.reduce(s) if len(s) else np.uint64(0))
                low.append((min_max(s, factors) >> np.uint64(16)).astype(np.uint32).tobytes())
                if len(found) == 256 or row == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(first, len(found)),
                            pa.array(np.array(one, dtype=np.uint64).view(np.int64)),
                            pa.array(found, pa.list_(pa.int64())),
                            pa.array(low, pa.binary()),
                        ],
                        names=["id", "h1", "shingles", "signature"],
                    )
                    found, one, low, first = [], [], [], row + 1
        give_back()

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("t"))
    return rows.join(sized(ids), "id").mapInArrow(sets, "id long, h1 long, shingles array<long>, signature binary")


def classes(signed: DataFrame) -> DataFrame:
    """``signed`` with ``class_id``, the smallest id with the same set; an empty set is a class of its own."""
    sets = signed.where(F.col("n_shingles") > 0)
    first = materialize(sets.groupBy("h1", "h2", "n_shingles").agg(F.min("id").alias("class_id")), "classes")
    joined = sets.join(first, ["h1", "h2", "n_shingles"])
    empty = signed.where(F.col("n_shingles") == 0).withColumn("class_id", F.col("id"))
    return joined.unionByName(empty).select("id", "n_shingles", "class_id", "h1", "bands")


def bucket_members(classed: DataFrame) -> DataFrame:
    """(bucket, band, members, id, n, center, center_n) of the buckets with two classes at least; center is the smallest id."""
    reps = classed.where((F.col("id") == F.col("class_id")) & F.col("bands").isNotNull())
    rows = reps.select("id", F.col("n_shingles").alias("n"), F.posexplode("bands").alias("band", "bucket"))
    shared = materialize(
        rows.groupBy("bucket")
        .agg(F.min(F.struct("id", "n")).alias("c"), F.count(F.lit(1)).alias("members"))
        .where(F.col("members") > 1)
        .select("bucket", F.col("c.id").alias("center"), F.col("c.n").alias("center_n"), "members"),
        "buckets",
    )
    return rows.join(sized(shared), "bucket").select("bucket", "band", "members", "id", "n", "center", "center_n")


def _fits(n: str, m: str, percent: int):
    """Whether sets of these sizes can reach the similarity at all."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def star_links(members: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """(a, b) of the bucket members that are similar to the center of one of their buckets, confirmed on full sets."""
    pairs = (
        members.where((F.col("id") != F.col("center")) & _fits("n", "center_n", settings.percent))
        .select("id", "center", "n", "center_n").distinct()
    )
    own = sets.select("id", F.col("shingles").alias("s"))
    other = sets.select(F.col("id").alias("center"), F.col("shingles").alias("t"))
    both = pairs.join(own, "id").join(other, "center")
    shared = F.size(F.array_intersect("s", "t"))
    return both.where(shared * 100 >= settings.percent * (F.col("n") + F.col("center_n") - shared)).select(
        F.col("id").alias("a"), F.col("center").alias("b")
    )


def block_links(pdf: pd.DataFrame, settings: Settings) -> list[tuple[int, int]]:
    """Links between the components of the rows of one block or of two: every pair across components is looked at.

    Rows: side (0 or 1; pairs are taken across the sides, or within side 0 if there is one side), id, root, shingles, signature.
    """
    ids, n = pdf["id"].to_numpy(), np.array([len(s) for s in pdf["shingles"]])
    sets = [np.asarray(s) for s in pdf["shingles"]]
    low = np.stack([np.frombuffer(s, dtype=np.uint32) for s in pdf["signature"]])
    sides, band = pdf["side"].to_numpy(), int(pdf["band"].iloc[0])
    group, k, two = pdf["root"].to_numpy().copy(), settings.band_rows, bool(sides.any())
    # Members of small components come first; each is compared with those after it that are not in its component.
    number = dict(zip(*np.unique(group, return_counts=True), strict=True))
    order = sorted(range(len(ids)), key=lambda i: (number[group[i]], ids[i]))
    place = np.empty(len(ids), dtype=np.int64)
    place[order] = np.arange(len(ids))
    links = []
    for i in order:
        later = (place > place[i]) & (group != group[i])
        if two:
            later &= sides != sides[i]
        later &= np.minimum(n, n[i]) * 100 >= np.maximum(n, n[i]) * settings.percent
        at = np.flatnonzero(later)
        equal = low[at] == low[i]
        near = equal.sum(1) >= (settings.percent / 100 - settings.slack) * low.shape[1]
        at, equal = at[near], equal[near]
        # A pair that shares several buckets is compared in that of its first common band only.
        common = equal[:, : settings.bands * k].reshape(len(at), settings.bands, k).all(2)
        at = at[common.argmax(1) == band] if len(at) else at
        if not len(at):
            continue
        inside = np.isin(np.concatenate([sets[j] for j in at]), sets[i], kind="sort")
        shared = np.add.reduceat(inside, np.cumsum([0, *n[at[:-1]]]), dtype=np.int64)
        for j in at[shared * 100 >= settings.percent * (n[i] + n[at] - shared)]:
            if group[j] != group[i]:
                links.append((int(ids[i]), int(ids[j])))
                group[group == group[j]] = group[i]
    return links


def residual_links(members: DataFrame, roots: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """(a, b) that join components within the buckets whose members are still in several; members has band."""
    to_python(members.sparkSession)
    rooted = members.join(roots, "id", "left").select("bucket", "band", "members", "id", F.coalesce("component", "id").alias("root"))
    rooted = materialize(rooted, "rooted")
    # Of a bucket of two the star has compared the only pair.
    mixed = materialize(
        rooted.where(F.col("members") > 2).groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
        .where(F.col("lo") != F.col("hi")).select("bucket"),
        "mixed",
    )
    blocks = F.ceil(F.col("members") / F.lit(settings.block)).cast("int")
    dealt = rooted.join(sized(mixed), "bucket").withColumn("blocks", blocks)
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = dealt.select(
        "bucket", "band", "id", "root",
        F.least("mine", "with").alias("i"), F.greatest("mine", "with").alias("j"), (F.col("mine") > F.col("with")).cast("int").alias("side"),
    ).join(sets.select("id", "shingles", "signature"), "id")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(block_links(pdf, settings), columns=["a", "b"]).astype("int64")

    return placed.groupBy("bucket", "i", "j").applyInPandas(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest id that links reach) and kept (it is that id)."""
    signed = materialize(signatures(docs, settings, key, text), "signatures")
    repeated = materialize(
        signed.groupBy("id").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1).select("id"), "repeated"
    )
    some_repeated = bool(repeated.limit(1).count())
    if some_repeated:
        one = signed.join(sized(repeated), "id")
        least = one.groupBy("id").agg(F.min("h1").alias("h1"))
        one = one.join(least, ["id", "h1"]).dropDuplicates(["id"]).select(*signed.columns)
        signed = materialize(signed.join(sized(repeated), "id", "left_anti").unionByName(one), "signatures")

    classed = materialize(classes(signed), "classed")
    members = materialize(bucket_members(classed), "members")
    ids = materialize(members.select("id").distinct(), "member-ids")
    sets = shingle_sets(docs, ids, settings, key, text)
    if some_repeated:
        sets = sets.join(classed.select("id", "h1"), ["id", "h1"]).dropDuplicates(["id"])
    sets = materialize(sets.drop("h1"), "sets")
    links = materialize(star_links(members, sets, settings), "star-links")
    roots = materialize(components(links), "roots")
    more = materialize(residual_links(members, roots, sets, settings), "residual-links")
    if more.limit(1).count():
        discard(roots)
        roots = materialize(components(links.union(more)), "roots")

    # The result reads the classes and the components only.
    discard(signed, members, ids, sets, links, more, repeated)
    of_class = roots.select(F.col("id").alias("class_id"), "component")
    result = classed.select("id", "n_shingles", "class_id").join(of_class, "class_id", "left")
    component = F.coalesce("component", "class_id")
    return result.select(
        F.col("id").alias("doc_id"), "n_shingles", component.alias("component_id"), (F.col("id") == component).alias("kept")
    )
