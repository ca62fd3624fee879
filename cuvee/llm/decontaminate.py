"""Benchmark decontamination by winnowing, in built-in functions only.

A window is ``window`` consecutive words of a benchmark item, or a whole shorter item. A window of L words holds L - k + 1 k-grams
with k = ceil(L / 2); its fingerprint is their least hash. So a document that holds the window somewhere has the fingerprint of the same
words there: every shared window is found.

1. ``benchmark_windows``: windows and fingerprints of the items, for window lengths that occur (ten at most).
2. ``candidates``: one pass over the documents keeps those with a fingerprint of the benchmark; only counters are shuffled.
3. ``hits``: the candidates' windows with such fingerprints are joined with the benchmark on their full text, and the spans of
   overlapping hits are put together.

Cases: null texts have no words; items without words or id are ignored; repeated items count once; rows that share a doc_id are one
document (hit if one of them is; word count of the longest); rows with a null doc_id are returned as one row, as clean. An
empty benchmark leaves every document clean; no documents, no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cuvee.llm.common import sized
from cuvee.runtime import materialize

WINDOW = 10
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words, once A-Z are lowered.
_BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words(text: Column) -> Column:
    """The words of a text; an empty array for null."""
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _BETWEEN), lambda w: w != "")


def _positions(last: Column) -> Column:
    """0 .. last, empty when last is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def fingerprints(w: Column, n: Column, length: int) -> Column:
    """The fingerprint of each window of ``length`` words, by position."""
    k = (length + 1) // 2
    grams = F.transform(_positions(n - k), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))
    if length == k:
        return grams
    steps = length - k + 1
    # Bound once, as an element of an array of one, so that each window reads the hashes and doesn't make them anew.
    return F.flatten(
        F.transform(
            F.array(grams),
            lambda g: F.transform(_positions(n - length), lambda i: F.least(*[F.get(g, i + j) for j in range(steps)])),
        )
    )


def window_text(w: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(w, start + 1, length), " ")


def benchmark_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, length, fingerprint, window) of every window, once per item."""
    read = items.where(F.col("item_id").isNotNull()).select("item_id", words(F.col("text")).alias("w"))
    read = materialize(read.withColumn("n", F.size("w")).where(F.col("n") > 0), "items")
    parts = []
    for length in range(1, window + 1):
        own = read.where(F.col("n") == length if length < window else F.col("n") >= length)
        found = own.select("item_id", "w", F.posexplode(fingerprints(F.col("w"), F.col("n"), length)).alias("at", "fingerprint"))
        parts.append(
            found.select("item_id", F.lit(length).alias("length"), "fingerprint", window_text(F.col("w"), F.col("at"), F.lit(length)).alias("window"))
        )
    every = parts[0]
    for part in parts[1:]:
        every = every.unionAll(part)
    return materialize(every.distinct(), "benchmark-windows")


def _with_place(length: int):
    return lambda f, i: F.struct(F.lit(length).alias("length"), i.alias("at"), f.alias("fingerprint"))


def _with_length(length: int):
    return lambda f: F.struct(F.lit(length).alias("length"), f.alias("fingerprint"))


def _every_length(lengths: list[int], make) -> Column:
    """The arrays that ``make`` gives for each length, as one array."""
    arrays = [make(length) for length in lengths]
    return arrays[0] if len(arrays) == 1 else F.flatten(F.array(*arrays))


def candidates(docs: DataFrame, prints: DataFrame, lengths: list[int]) -> DataFrame:
    """(doc_id, n_words, shared): shared counts the document's distinct fingerprints that the benchmark has."""
    read = docs.select("doc_id", words(F.col("text")).alias("w")).withColumn("n", F.size("w"))
    if not lengths:
        return read.groupBy("doc_id").agg(F.max("n").alias("n_words"), F.lit(0).cast("long").alias("shared"))
    # Least hashes repeat from window to window, so only distinct ones are dealt out, and looked up where they are made.
    own = _every_length(
        lengths, lambda k: F.transform(F.array_distinct(fingerprints(F.col("w"), F.col("n"), k)), _with_length(k))
    )
    dealt = read.select("doc_id", "n", F.explode_outer(own).alias("f"))
    looked = dealt.select("doc_id", "n", "f.length", "f.fingerprint").join(
        sized(prints).withColumn("known", F.lit(1)), ["length", "fingerprint"], "left"
    )
    return looked.groupBy("doc_id").agg(F.max("n").alias("n_words"), F.count("known").alias("shared"))


def hits(docs: DataFrame, chosen: DataFrame, known: DataFrame, prints: DataFrame, lengths: list[int]) -> DataFrame:
    """(doc_id, at, length, window_id) of every occurrence of a window in the chosen documents (a stored table of doc_id)."""
    read = docs.select("doc_id", "text").join(sized(chosen), "doc_id").select("doc_id", words(F.col("text")).alias("w"))
    read = read.withColumn("n", F.size("w"))
    every = _every_length(lengths, lambda k: F.transform(fingerprints(F.col("w"), F.col("n"), k), _with_place(k)))
    rows = read.select("doc_id", "w", F.explode(every).alias("f"))
    # The look-up drops what is not in the benchmark before the texts of the windows are made.
    near = rows.select("doc_id", "w", "f.length", "f.at", "f.fingerprint").join(sized(prints), ["length", "fingerprint"], "left_semi")
    texts = near.select("doc_id", "at", "length", window_text(F.col("w"), F.col("at"), F.col("length")).alias("window"))
    return texts.join(sized(known), ["length", "window"]).select("doc_id", "at", "length", "window_id")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items (sorted ids as strings), contaminated."""
    windows = benchmark_windows(items, window)
    lengths = [r["length"] for r in windows.select("length").distinct().orderBy("length").collect()]
    prints = materialize(windows.select("length", "fingerprint").distinct(), "fingerprints")
    known = materialize(
        windows.select("length", "window").distinct().withColumn("window_id", F.xxhash64("length", "window")), "windows"
    )
    of_item = materialize(
        windows.select(F.xxhash64("length", "window").alias("window_id"), "item_id").distinct(), "window-items"
    )
    scanned = materialize(candidates(docs, prints, lengths), "scanned")
    if not lengths:
        return _result(scanned)
    chosen = materialize(scanned.where((F.col("shared") > 0) & F.col("doc_id").isNotNull()).select("doc_id"), "candidates")
    found = materialize(hits(docs, chosen, known, prints, lengths), "hits")

    # The union of the spans: what each adds beyond the furthest end before it.
    in_order = Window.partitionBy("doc_id").orderBy("at", "end")
    spans = found.select("doc_id", "at", (F.col("at") + F.col("length")).alias("end")).distinct()
    before = F.coalesce(F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    added = spans.withColumn("added", F.greatest(F.lit(0), F.col("end") - F.greatest("at", before)))
    n_hit = added.groupBy("doc_id").agg(F.sum("added").alias("n_hit"))
    of_doc = found.select("doc_id", "window_id").distinct().join(sized(of_item), "window_id").select("doc_id", "item_id").distinct()
    listed = of_doc.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    return _result(scanned.join(n_hit, "doc_id", "left").join(listed, "doc_id", "left"))


def _result(scanned: DataFrame) -> DataFrame:
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0).cast("long")) if "n_hit" in scanned.columns else F.lit(0).cast("long")
    items = F.col("items") if "items" in scanned.columns else F.lit(None).cast("array<string>")
    items = F.coalesce(items, F.array().cast("array<string>"))
    return scanned.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        items.alias("items"),
        (n_hit > 0).alias("contaminated"),
    )
