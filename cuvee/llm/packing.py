"""Best-fit packing of documents into sequences, planned on the histogram of their lengths.

1. ``pieces``: one pass tokenises; a document longer than a sequence is cut, no other one is.
2. ``plan``: the counts per length (``capacity`` numbers at most, whatever the data) are packed best-fit decreasing, all pieces of a length
   in one step. A step fills a run of equal sequences, so the plan has a few rows per length, however many documents there are.
3. ``place``: a piece gets its rank among those of its length: rank inside a bucket, plus the pieces of the buckets before. Buckets follow
   the hash of the piece, so one frequent length is spread too. The rank picks the planned slot.

Cases: a null or empty text has only the closing id; rows with a null or repeated doc_id are packed each for themselves; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cuvee.llm.common import give_back, shuffle_parts, to_python
from cuvee.llm.word_tokens import encoder
from cuvee.runtime import materialize

CAPACITY = 2048
END_ID = 0


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of each document: its ids and END_ID, cut every ``capacity`` ids."""
    to_python(docs.sparkSession)
    size = 4 * capacity
    end = END_ID.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).all_ids
        for batch in batches:
            texts = batch.column(1)
            for first in range(0, len(texts), 256):
                rows, at, sums, lengths, ids = [], [], [], [], []
                for i, data in enumerate(encode([t or "" for t in texts.slice(first, 256).to_pylist()]), first):
                    data += end
                    for start in range(0, len(data), size):
                        part = data[start : start + size]
                        rows.append(i)
                        at.append(start // 4)
                        sums.append(zlib.crc32(part))
                        lengths.append(len(part) // 4)
                        ids.append(part)
                starts = pa.array(at, pa.int64())
                columns = {
                    "doc_id": batch.column(0).take(pa.array(rows, pa.int64())),
                    "piece": pa.array([a // capacity for a in at], pa.int32()),
                    "start": starts,
                    "length": pa.array(lengths, pa.int64()),
                    "ids_crc32": pa.array(sums, pa.int64()),
                }
                if keep_ids:
                    columns["ids"] = pa.array(ids, pa.binary())
                yield pa.RecordBatch.from_pydict(columns)
        give_back()

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(cut, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Slots (length, rank_from, rank_to, sequence, each, offset): from ``sequence`` on, each sequence takes ``each`` pieces.

    Best-fit decreasing: a piece goes to the open sequence with the least room that holds it, else to a new one. Sequences that are alike
    are handled as a run (first number, how many), so a step costs the same for one piece and for a billion.
    """
    slots = []
    rooms: list[int] = []  # sorted, the keys of ``runs``
    runs: dict[int, list[tuple[int, int]]] = {}
    sequences = 0

    def add(room: int, first: int, n: int) -> None:
        if n and room:
            if room not in runs:
                runs[room] = []
                insort(rooms, room)
            runs[room].append((first, n))

    def fill(length: int, rank: int, left: int, first: int, n: int, room: int) -> tuple[int, int]:
        """Put up to ``left`` pieces into the run; returns how many went in and how many sequences it used."""
        each = room // length
        whole = min(n, left // each)
        if whole:
            slots.append((length, rank, rank + whole * each, first, each, capacity - room))
            add(room - each * length, first, whole)
        rest = min(left - whole * each, each - 1) if whole < n else 0
        if rest:
            at = rank + whole * each
            slots.append((length, at, at + rest, first + whole, rest, capacity - room))
            add(room - rest * length, first + whole, 1)
        return whole * each + rest, whole + bool(rest)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                need = -(-left // (capacity // length))
                fill(length, rank, left, sequences, need, capacity)
                sequences += need
                left = 0
                continue
            room = rooms[at]
            first, n = runs[room].pop()
            if not runs[room]:
                del runs[room]
                rooms.pop(at)
            done, used = fill(length, rank, left, first, n, room)
            add(room, first + used, n - used)
            rank, left = rank + done, left - done
    return slots


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The stored pieces with their sequence_id and offset."""
    spark = cut.sparkSession
    tied = [c for c in ("doc_id", "piece", "ids_crc32") if c in cut.columns]
    buckets = shuffle_parts(cut)
    dealt = cut.withColumn("_bucket", F.pmod(F.xxhash64(*tied), F.lit(buckets)).cast("int"))
    sizes = materialize(dealt.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("n")), "lengths")
    # One number per length, of which there are ``capacity`` at most.
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = spark.createDataFrame(
        plan(counts, capacity), "length long, rank_from long, rank_to long, first long, each long, base long"
    )
    earlier = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("length", "_bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy(*tied)) - 1
    ranked = dealt.withColumn("_inside", inside).join(before, ["length", "_bucket"])
    ranked = ranked.withColumn("_rank", F.col("_inside") + F.col("_before")).drop("_bucket", "_inside", "_before")
    met = F.broadcast(slots).withColumnRenamed("length", "_length")
    met = ranked.join(met, (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("rank_from")) & (F.col("_rank") < F.col("rank_to")))
    nth = F.col("_rank") - F.col("rank_from")
    return met.select(
        *cut.columns,
        (F.col("first") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("base") + F.pmod(nth, F.col("each")) * F.col("length")).cast("long").alias("offset"),
    )


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset."""
    return place(materialize(pieces(docs, tokenizer, capacity, keep_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids): the sequences themselves, from pieces packed with their ids; each has ``capacity`` ids at most."""
    in_order = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    joined = packed.groupBy("sequence_id").agg(in_order.alias("p"))
    ids = F.aggregate("p", F.lit(b""), lambda done, p: F.concat(done, p["ids"]))
    return joined.select("sequence_id", ids.alias("ids"), F.transform("p", lambda p: p["doc_id"]).alias("doc_ids"))
