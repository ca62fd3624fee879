"""Spelling variants: words one edit apart, found by asymmetric q-chunks, and the frequent form that each leads to.

A word is cut into two disjoint chunks. One inserted, deleted or replaced code point touches one of them, so the other stands whole
in the partner, moved by the difference of the lengths at most, which is one. So the longer word (either, if they are as long) gives its two
chunks, the other its positional grams of the same sizes; only the grams that lie within that shift can meet a chunk, and no others are made.

What is left of the word beside the shared chunk is one edit apart as well, so it is cut by the same rule: a key is the length and the
chunks found so far. Every word is cut twice; groups that still hold more than ``group`` words are cut on until the rest is one
code point, where a group can't hold more words than there are letters. No group is capped. Pairs that share a key are verified.

Cases: null and empty texts give no words, a null id counts as the empty string, rows that share an id or a text all count, long texts and
runs are taken whole, an empty table gives no rows, other columns are ignored. Of near words that are as frequent the first in
code-point order is the form. Letters are those of the pattern; only A-Z are lowered.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuvee.llm.common import sized
from cuvee.runtime import discard, materialize


@dataclass(frozen=True)
class Settings:
    #: Code points and occurrences from which a run of letters is a word.
    min_length: int = 6
    min_count: int = 5
    letters: str = "A-Za-zÀ-ÿ"
    #: One in so many (document, run) loses a code point; 0 leaves all as they are.
    damage: int = 0
    #: A form is so many times as frequent as the word.
    times: int = 5
    #: Rows of a key from which it is cut on.
    group: int = 256


def word_counts(docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of the words of all documents."""
    # A run that is too short stays so, whether or not it loses a code point.
    pattern = f"[{settings.letters}]{{{settings.min_length},}}"
    runs = docs.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col(text).cast("string"), F.lit(pattern), F.lit(0))).alias("run"),
    ).withColumn("run", F.translate("run", string.ascii_uppercase, string.ascii_lowercase))
    word = F.col("run")
    if settings.damage:
        h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
        at = F.pmod(h, F.length("run").cast("long")).cast("int")
        cut = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
        word = F.when(F.pmod(h, F.lit(settings.damage)) == 0, cut).otherwise(word)
    counted = runs.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.col("n") >= settings.min_count) & (F.length("word") >= settings.min_length))


def _part(text: Column, start: Column, length: Column) -> Column:
    """``length`` code points of ``text`` after the first ``start``."""
    return F.substring(text, start + 1, length)


def cut(rows: DataFrame) -> DataFrame:
    """Two rows for each: the first chunk, or the last, goes into the key, and the other part stays to be cut. Where only one code
    point is left, the row stays as it is.

    Rows: word, side (0 gives chunks, 1 gives grams), shift (code points that the word is shorter than its partners), key, rest.
    """
    here = F.length("rest")
    whole = here + F.col("shift")  # the partner's rest, by which both sides are cut
    first = F.floor(whole / 2).cast("int")
    last = whole - first

    def keyed(tag: str, chunk: Column) -> Column:
        return F.xxhash64("key", F.lit(tag), chunk)

    both = F.array(
        F.struct(keyed("<", _part(F.col("rest"), F.lit(0), first)).alias("key"), _part(F.col("rest"), first, here - first).alias("rest")),
        F.struct(keyed(">", _part(F.col("rest"), here - last, last)).alias("key"), _part(F.col("rest"), F.lit(0), here - last).alias("rest")),
    )
    parts = F.when(whole > 1, both).otherwise(F.array(F.struct("key", "rest")))
    return rows.withColumn("part", F.explode(parts)).select("word", "side", "shift", "part.key", "part.rest")


def _met(rows: DataFrame) -> DataFrame:
    """(a, b) of words that share a key and are one edit apart; of words as long, a is the smaller."""
    a = rows.where("side = 0").select("key", F.col("word").alias("a"))
    b = rows.where("side = 1").select("key", F.col("word").alias("b"), "shift")
    ordered = (F.col("shift") == 1) | (F.col("a") < F.col("b"))
    return a.join(b, "key").where(ordered & (F.levenshtein("a", "b", 1) == 1)).select("a", "b")


def near_pairs(words: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(a, b), each pair once, of the distinct words in the stored table ``words`` (word) that are one edit apart."""
    length = F.length("word")
    roles = F.array(
        *[F.struct(F.lit(side).alias("side"), F.lit(shift).alias("shift"), (length + shift).alias("of")) for side, shift in ((0, 0), (1, 0), (1, 1))]
    )
    start = words.where(length > 0).select("word", F.explode(roles).alias("r"))
    rows = start.select("word", "r.side", "r.shift", F.xxhash64("r.of").alias("key"), F.col("word").alias("rest"))
    rows = materialize(cut(cut(rows)), "chunks")
    found = None
    while True:
        counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.max(F.length("rest") + F.col("shift")).alias("longest"))
        hot = materialize(counts.where((F.col("rows") > settings.group) & (F.col("longest") > 1)).select("key"), "hot-chunks")
        some = bool(hot.limit(1).count())
        calm = rows.join(sized(hot), "key", "left_anti") if some else rows
        pairs = materialize(_met(calm), "near-words")
        found = pairs if found is None else found.unionByName(pairs)
        if not some:
            return found.distinct()
        # What is too short to be cut again is met in place: no more words differ there than there are letters.
        waiting = rows.join(sized(hot), "key", "left_semi")
        short = F.length("rest") + F.col("shift") <= 1
        found = found.unionByName(materialize(_met(waiting.where(short)), "near-words"))
        rows, old = materialize(cut(waiting.where(~short)), "chunks"), rows
        discard(old, hot)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the stored links (word, form): where forms lead in the end. Each round doubles the steps taken."""
    reached = forms.select("word", F.col("form").alias("root"))
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("to"))
        moved = materialize(reached.join(further, "root", "left").select("word", F.coalesce("to", "root").alias("root"), "to"), "roots")
        if not moved.where(F.col("to").isNotNull()).limit(1).count():
            return moved.drop("to")
        reached = moved.drop("to")


def variants(docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word."""
    words = materialize(word_counts(docs, settings, key, text), "words")
    pairs = materialize(near_pairs(words, settings), "pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    partner = words.select(F.col("word").alias("b"), F.col("n").alias("near_n"))
    best = (
        both.join(partner, "b").groupBy(F.col("a").alias("word"))
        .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("b").alias("form"))).alias("best"))
    )
    joined = words.join(best, "word", "left")
    leads = -F.col("best.n") >= F.lit(settings.times) * F.col("n")
    formed = materialize(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(leads, F.col("best.form")).alias("form"), F.when(leads, -F.col("best.n")).alias("form_n"),
        ),
        "formed",
    )
    led = roots(formed.where(F.col("form").isNotNull()))
    return formed.join(led, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
