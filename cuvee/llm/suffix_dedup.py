"""Removal of repeated passages: every byte that lies in a string of ``length`` bytes which also starts in a document with a smaller id.

1. **Which windows can repeat.** The smallest hash of the 24-byte grams in a window of ``length`` bytes depends on the window alone; windows in a
   row that share it are a run. A run's value that stands in two different texts is open. A batch of documents sends each value
   once (twice, if two of its texts hold it), so a value that all documents share is no large group anywhere.
2. **Shards.** The bytes of the open runs go to the shard of their value, so equal windows meet. A shard builds a suffix array by
   Larsson-Sadakane refinement, takes Kasai's common prefixes, and so has the groups of equal windows and the smallest id of each. What is more
   than an array may hold is cut into several, whose windows are merged by binary search.
3. **Hot values**, held by more than ``hot`` texts, would fill a shard. Equal runs of these are made one by a partial aggregate, and the
   windows of the different ones are rows: the smallest id of each by a partial aggregate, met again by a join.

Equal texts are one text, that of the smallest id; the others lose everything. Strings are judged on the input.

Cases: a null or empty text has no bytes; a document with a null id takes nothing away and loses nothing; rows that share an id take
nothing from each other, and rows that share id and text come out alike; texts of any length are taken whole; an empty table gives
no rows; other columns are ignored. Texts are told apart by 128 bits of hash, values by about 50, and windows of hot values by 128.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cuvee.llm.common import give_back, sized, to_python
from cuvee.llm.wordhash import mix
from cuvee.runtime import discard, materialize

_GRAM = 24
_PAD = 64
#: Bytes looked at together: the arrays of one piece stay in the processor's cache.
_PIECE = 1 << 18
#: Bits of a place in a suffix array; three such numbers are sorted as one.
_BITS = 21
_PLACE = np.uint64((1 << _BITS) - 1)


@dataclass(frozen=True)
class Settings:
    #: Bytes of a string that counts as repeated; 24 at least.
    length: int = 50
    #: Bytes of text for each shard. The open runs overlap: if all text is repeated, a shard gets four to five times as many.
    shard_bytes: int = 1 << 19
    #: Texts that hold a value from which it is hot.
    hot: int = 4096
    #: Bytes of one suffix array.
    array_bytes: int = (1 << _BITS) - 2
    #: Windows of a run that are shipped in one row.
    row_windows: int = 256


# Suffix arrays


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes of ``data`` in the order of their first ``depth`` bytes at least, by Larsson-Sadakane refinement.

    Suffixes start out sorted by five bytes. A suffix's rank is the last place of its group, so a finished group keeps its rank; each
    round sorts the members of the other groups by the ranks of what follows them, which doubles the depth.
    """
    n = len(data)
    padded = np.zeros(n + 8, np.uint64)
    padded[:n] = data
    key = np.zeros(n, np.uint64)
    for i in range(5):
        key = (key << np.uint64(8)) | padded[i : n + i]
    packed = np.sort((key << np.uint64(_BITS)) | np.arange(n, dtype=np.uint64))
    order = (packed & _PLACE).astype(np.int64)
    rank = np.zeros(n + 2 * depth, np.uint64)  # beyond the end: before all others

    def number(slots: np.ndarray, members: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Rank the members by their groups; those that are not alone."""
        ends = np.append(keys[1:] != keys[:-1], True)
        last = np.flatnonzero(ends)
        size = np.diff(last, prepend=-1)
        rank[members] = np.repeat(slots[last] + 1, size).astype(np.uint64)
        return slots[np.repeat(size > 1, size)]

    slots = number(np.arange(n), order, packed >> np.uint64(_BITS))
    known = 5
    while known < depth and len(slots):
        members = order[slots]
        packed = (rank[members] << np.uint64(2 * _BITS)) | (rank[members + known] << np.uint64(_BITS)) | members.astype(np.uint64)
        packed.sort()
        members = (packed & _PLACE).astype(np.int64)
        order[slots] = members
        slots = number(slots, members, packed >> np.uint64(_BITS))
        known *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, starts: np.ndarray, limit: int) -> np.ndarray:
    """Of each suffix in the order: bytes that it shares with the one before it, up to ``limit``; Kasai's rule, for all places at once.

    Where a place and the place before it have neighbours in the order that also stand side by side, it shares one byte less than the place
    before it. Only the others, and the ``starts`` of strings, are compared, eight bytes at a time.
    """
    n = len(order)
    words = np.ndarray((n + limit + 8,), "<u8", np.concatenate([data, np.zeros(limit + 16, np.uint8)]).tobytes(), 0, (1,))
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    own = np.ones(n, bool)
    own[1:] = (before[1:] != before[:-1] + 1) | (before[:-1] < 0)
    own[starts] = True
    own &= before >= 0
    shared = value = np.zeros(n, np.int64)
    todo = np.flatnonzero(own)
    here = np.arange(n)
    while len(todo):
        active, other, done = todo, before[todo], np.zeros(len(todo), np.int64)
        left = np.arange(len(todo))
        for at in range(0, limit, 8):
            differ = words[active[left] + at] ^ words[other[left] + at]
            equal = differ == 0
            ended = left[~equal]
            differ = differ[~equal]
            done[ended] = at + np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)).astype(np.int64) // 8
            left = left[equal]
            if not len(left):
                break
        done[left] = limit
        shared[active] = done
        # Each place takes what the last compared place shares, less its distance from it.
        source = np.maximum.accumulate(np.where(own, here, -1))
        value = np.where(source >= 0, shared[np.maximum(source, 0)] - (here - source), 0)
        # A neighbour that shared nothing says nothing about the next place.
        todo = np.flatnonzero((before >= 0) & (value < 0) & np.append(True, value[:-1] >= 0))
        own[todo] = True
    return np.where(before >= 0, value, 0)[order]


@dataclass
class Windows:
    """The windows of one array: the group of each place (-1: no window starts there), and a place and the smallest id of each group."""

    group: np.ndarray
    place: np.ndarray
    least: np.ndarray


def equal_windows(data: np.ndarray, starts: np.ndarray, ids: np.ndarray, length: int) -> Windows:
    """Groups of equal windows, in their order, over strings that begin at ``starts`` and have the ``ids``; no window crosses two strings."""
    n = len(data)
    order = suffix_array(data, length)
    shared = common_prefixes(data, order, starts, 512)
    string = np.repeat(np.arange(len(starts)), np.diff(starts, append=n))
    whole = np.arange(n) + length <= np.append(starts[1:], n)[string]
    fresh = np.cumsum(shared < length)
    kept = whole[order]
    places, number = order[kept], fresh[kept]
    first = np.flatnonzero(np.diff(number, prepend=-1))
    group = np.full(n, -1, np.int64)
    group[places] = np.repeat(np.arange(len(first)), np.diff(first, append=len(places)))
    least = np.minimum.reduceat(ids[string[places]], first) if len(first) else np.zeros(0, np.int64)
    return Windows(group, places[first], least)


def merge_least(parts: list[tuple[np.ndarray, Windows]], length: int) -> None:
    """Give every group the smallest id of the equal groups of all arrays: binary search for each array's windows in the others, which
    are in order."""
    if len(parts) < 2:
        return
    strings = []
    for data, found in parts:
        window = np.lib.stride_tricks.sliding_window_view(data, length) if len(data) >= length else np.zeros((0, length), np.uint8)
        strings.append(np.ascontiguousarray(window[found.place]).view(f"S{length}").ravel())
    before = [found.least.copy() for _, found in parts]
    for i, (_, found) in enumerate(parts):
        for j, others in enumerate(strings):
            if i != j and len(strings[i]) and len(others):
                at = np.minimum(np.searchsorted(others, strings[i]), len(others) - 1)
                same = others[at] == strings[i]
                found.least[same] = np.minimum(found.least[same], before[j][at[same]])


# Runs of windows


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values in a row, and where each begins; one more for the end."""
    wide = column.cast(pa.large_binary())
    _, offsets, data = wide.buffers()
    ends = np.frombuffer(offsets, np.int64)[wide.offset : wide.offset + len(wide) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[ends[0] : ends[-1]], ends - ends[0]


def _slide(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if have < width else x


def window_runs(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, count, value): windows in a row that share the smallest hash of their grams; texts lie between the ``ends``."""
    n = len(data)
    firsts, counts, values = [], [], []
    crossing = np.zeros(n + 1, np.int32)  # places too close to the end of their text
    np.add.at(crossing, np.maximum(ends[:-1], ends[1:] - length + 1), 1)
    np.add.at(crossing, ends[1:], -1)
    valid = np.cumsum(crossing[:n]) == 0
    factors = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
    for at in range(0, n, _PIECE):
        stop = min(n, at + _PIECE)
        ok = valid[at:stop]
        if not ok.any():
            continue
        piece = np.zeros(stop - at + length + _PAD, np.uint8)
        piece[: min(n, stop + length) - at] = data[at : min(n, stop + length)]
        words = np.ndarray((len(piece) - 8,), "<u8", piece, 0, (1,))
        grams = words[:-16] * factors[0] + words[8:-8] * factors[1] + words[16:] * factors[2]
        least = _slide(mix(grams), length - _GRAM + 1)[: stop - at]
        with_next = np.zeros(stop - at, bool)
        with_next[:-1] = ok[:-1] & ok[1:] & (least[1:] == least[:-1])
        first = np.flatnonzero(ok & ~np.append(False, with_next[:-1]))
        last = np.flatnonzero(ok & ~with_next)
        firsts.append(first + at)
        counts.append(last - first + 1)
        values.append(least[first])
    if not firsts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(firsts), np.concatenate(counts), np.concatenate(values)


def _codes(values: np.ndarray, shards: int) -> np.ndarray:
    """Shard in the upper half, lower half of the value in the lower one."""
    half, low = np.uint64(32), np.uint64(0xFFFFFFFF)
    return ((((values >> half) * np.uint64(shards)) >> half) << half | (values & low)).view(np.int64)


def _values(docs: DataFrame, shards: int, settings: Settings) -> DataFrame:
    """(shard, sure, codes, hashes, told): the values of the runs of a batch by shard, and (sure) those of which the batch itself shows
    two texts; these are told already when they come again among the others."""
    length = settings.length

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, batch in enumerate(batches):
            data, ends = _binary(batch.column(1))
            first, _, value = window_runs(data, ends, length)
            if not len(first):
                continue
            code = _codes(value, shards)
            text = batch.column(0).to_numpy()[np.searchsorted(ends, first, side="right") - 1]
            order = np.lexsort((text, code))
            code, text = code[order], text[order]
            once = np.append(True, (code[1:] != code[:-1]) | (text[1:] != text[:-1]))
            code, text = code[once], text[once]
            begins = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
            stops = np.append(begins[1:], len(code)) - 1
            sure = np.repeat(stops > begins, stops - begins + 1)
            sent = np.sort(np.concatenate([begins, stops[stops > begins]]))
            cuts = np.append(np.flatnonzero(np.diff(code[sent] >> 32, prepend=-1)), len(sent))
            rows = []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                some = sent[a:b]
                rows.append((int(code[some[0]] >> 32), False, code[some].astype(np.uint32).tobytes(), text[some].tobytes(), sure[some].tobytes()))
            if sure.any():
                # These need no meeting; they go anywhere.
                anywhere = int(mix(np.array([code[0] + at]).view(np.uint64))[0] % np.uint64(shards))
                rows.append((anywhere, True, code[sure].tobytes(), text[sure].tobytes(), b""))
            kinds = (pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary())
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "sure", "codes", "hashes", "told"])
        give_back()

    return docs.select("h", "t").mapInArrow(send, "shard int, sure boolean, codes binary, hashes binary, told binary")


def open_codes(docs: DataFrame, shards: int, settings: Settings) -> DataFrame:
    """(h, code): the values of each text that stand in another text too. A pair may come more than once."""

    def meet(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        out = []
        for sure, kind in ((True, np.int64), (False, np.uint32)):
            part = table.filter(pc.equal(table.column("sure"), sure))
            if not part.num_rows:
                continue
            code = np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in part.column("codes")]).astype(np.int64)
            text = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in part.column("hashes")])
            if not sure:
                told = np.concatenate([np.frombuffer(x.as_buffer(), bool) for x in part.column("told")])
                order = np.argsort(code, kind="stable")
                code, text, told = code[order] + (shard << 32), text[order], told[order]
                begins = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
                differ = np.minimum.reduceat(text, begins) != np.maximum.reduceat(text, begins)
                keep = np.repeat(differ, np.diff(begins, append=len(code))) & ~told
                code, text = code[keep], text[keep]
            out.append(pa.table({"h": text, "code": code}))
        give_back()
        return pa.concat_tables(out)

    return _values(docs, shards, settings).groupBy("shard").applyInArrow(meet, "h long, code long")


def open_runs(docs: DataFrame, shards: int, settings: Settings) -> DataFrame:
    """(shard, id, h, start, n, bytes): the runs of ``docs`` (id, h, t, codes) whose value is among their codes; n windows from ``start``."""
    length, most = settings.length, settings.row_windows

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = _binary(batch.column(2))
            first, count, value = window_runs(data, ends, length)
            code = _codes(value, shards)
            row = np.searchsorted(ends, first, side="right") - 1
            wanted = batch.column(3)
            owner = np.repeat(np.arange(len(wanted)), pc.list_value_length(wanted).to_numpy())
            own = np.uint64(0x9E3779B97F4A7C15)
            given = mix(wanted.flatten().to_numpy().view(np.uint64) + owner.astype(np.uint64) * own)
            at = np.flatnonzero(np.isin(mix(code.view(np.uint64) + row.astype(np.uint64) * own), given))
            # Long runs, as repeated characters make them, are cut into rows.
            many = -(-count[at] // most)
            at = np.repeat(at, many)
            nth = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
            begin = first[at] + nth * most
            n = np.minimum(count[at] - nth * most, most)
            flat = data.tobytes()
            for a in range(0, len(at), 10_000):
                part = slice(a, a + 10_000)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((code[at[part]] >> 32).astype(np.int32)),
                        batch.column(0).take(pa.array(row[at[part]])),
                        batch.column(1).take(pa.array(row[at[part]])),
                        pa.array(begin[part] - ends[row[at[part]]]),
                        pa.array(n[part].astype(np.int32)),
                        pa.array([flat[b : b + k + length - 1] for b, k in zip(begin[part], n[part], strict=True)], pa.binary()),
                    ],
                    names=["shard", "id", "h", "start", "n", "bytes"],
                )
        give_back()

    return docs.select("id", "h", "t", "codes").mapInArrow(cut, "shard int, id long, h long, start long, n int, bytes binary")


# Repeated windows


def repeated_windows(strings: list[bytes], ids: np.ndarray, settings: Settings) -> np.ndarray:
    """The smallest id of every window of the different ``strings``, string by string; ``ids`` are the smallest of each string."""
    parts, sizes, begin, total = [], [], 0, 0
    for i, s in enumerate([*strings, None]):
        if s is None or (total and total + len(s) + 1 > settings.array_bytes):
            sizes.append((begin, i))
            begin, total = i, 0
        total += len(s) + 1 if s is not None else 0
    for a, b in sizes:
        data = np.frombuffer(b"\xff".join(strings[a:b]) + b"\xff", np.uint8)
        lengths = np.array([len(s) + 1 for s in strings[a:b]])
        starts = np.cumsum(lengths) - lengths
        # The byte between strings belongs to the string before it, and no text holds it.
        parts.append((data, equal_windows(data, starts, ids[a:b], settings.length)))
    merge_least(parts, settings.length)
    out = []
    for (a, b), (data, found) in zip(sizes, parts, strict=True):
        lengths = np.array([len(s) + 1 for s in strings[a:b]])
        inside = np.arange(len(data)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        whole = inside + settings.length < np.repeat(lengths, lengths)
        out.append(found.least[found.group[whole]])
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _islands(hit: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of the hits in a row, row by row."""
    edge = np.append(True, row[1:] != row[:-1])
    first = np.flatnonzero(hit & (edge | ~np.append(False, hit[:-1])))
    last = np.flatnonzero(hit & (np.append(edge[1:], True) | ~np.append(hit[1:], False)))
    return first, last


def shard_hits(runs: DataFrame, settings: Settings) -> DataFrame:
    """(id, h, start, n): windows in a row that also stand in a document with a smaller id, by the suffix arrays of the shards."""

    def resolve(table: pa.Table) -> pa.Table:
        coded = pc.dictionary_encode(table.column("bytes").combine_chunks())
        coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
        which = coded.indices.to_numpy().astype(np.int64)
        strings = coded.dictionary.to_pylist()
        ids = table.column("id").to_numpy()
        least = np.full(len(strings), np.iinfo(np.int64).max)
        np.minimum.at(least, which, ids)
        windows = repeated_windows(strings, least, settings)
        each = np.array([len(s) - settings.length + 1 for s in strings])
        begins = np.cumsum(each) - each
        # A row in which nothing is smaller than its own id is done; most are.
        low = np.minimum.reduceat(windows, begins)[which]
        rows = np.flatnonzero(low < ids)
        n = each[which[rows]]
        row = np.repeat(np.arange(len(rows)), n)
        at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        hit = windows[np.repeat(begins[which[rows]], n) + at] < np.repeat(ids[rows], n)
        first, last = _islands(hit, row) if len(row) else (np.zeros(0, np.int64),) * 2
        of = rows[row[first]] if len(first) else np.zeros(0, np.int64)
        return pa.table(
            {"id": ids[of], "h": table.column("h").to_numpy()[of], "start": table.column("start").to_numpy()[of] + at[first], "n": last - first + 1}
        )

    def shard(table: pa.Table) -> pa.Table:
        found = resolve(table)
        give_back()
        return found

    return runs.groupBy("shard").applyInArrow(shard, "id long, h long, start long, n long")


def row_hits(runs: DataFrame) -> DataFrame:
    """The same for the stored runs of hot values. Equal runs are one first; the windows of the different ones are rows, whose smallest
    ids come back to their run as a list."""
    length = F.octet_length("bytes") - F.col("n") + 1
    marked = runs.withColumn("c1", F.xxhash64("bytes")).withColumn("c2", F.xxhash64(F.lit(1), "bytes"))
    different = materialize(
        marked.groupBy("c1", "c2").agg(F.min("id").alias("own"), F.max("id").alias("most"), F.any_value("bytes").alias("bytes"), F.any_value("n").alias("n")),
        "hot-strings",
    )
    window = F.substring(F.col("bytes"), F.col("at") + 1, length)
    placed = different.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    windows = materialize(
        placed.select("c1", "c2", "at", "own", "most", F.xxhash64(window).alias("w1"), F.xxhash64(F.lit(1), window).alias("w2")), "hot-windows"
    )
    least = materialize(windows.groupBy("w1", "w2").agg(F.min("own").alias("least")), "hot-least")
    met = windows.join(sized(least), ["w1", "w2"]).where(F.col("least") < F.col("most"))
    lists = materialize(met.groupBy("c1", "c2").agg(F.array_sort(F.collect_list(F.struct("at", "least"))).alias("found")), "hot-lists")
    hit = F.transform(F.filter("found", lambda e: e["least"] < F.col("id")), lambda e: e["at"])
    hits = marked.drop("bytes").join(sized(lists), ["c1", "c2"]).withColumn("hit", hit).where(F.size("hit") > 0)
    first = F.filter("hit", lambda x, i: (i == 0) | (F.get("hit", i - 1) != x - 1))
    last = F.filter("hit", lambda x, i: F.coalesce(F.get("hit", i + 1) != x + 1, F.lit(True)))
    spans = F.zip_with(first, last, lambda a, z: F.struct(a.alias("a"), z.alias("z")))
    told = hits.select("id", "h", "start", F.explode(spans).alias("s"))
    return told.select("id", "h", (F.col("start") + F.col("s.a")).alias("start"), (F.col("s.z") - F.col("s.a") + 1).cast("long").alias("n"))


def merged_spans(hits: DataFrame, length: int) -> DataFrame:
    """(id, h, spans): the bytes under the windows as spans (start, length) in order that neither overlap nor touch."""
    whole = hits.select("id", "h", "start", (F.col("start") + F.col("n") + length - 1).alias("stop"))
    in_order = Window.partitionBy("id", "h").orderBy("start", "stop")
    reach = F.max("stop").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum((F.col("reach").isNull() | (F.col("reach") < F.col("start"))).cast("long")).over(in_order)
    spans = whole.withColumn("reach", reach).withColumn("island", island).groupBy("id", "h", "island").agg(
        F.min("start").alias("start"), (F.max("stop") - F.min("start")).alias("length")
    )
    return spans.groupBy("id", "h").agg(F.array_sort(F.collect_list(F.struct("start", "length"))).alias("spans"))


def remove_repeats(docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, spans, kept): the removed spans (start, length) of each document and the bytes that are left."""
    spark = docs.sparkSession
    to_python(spark)
    given = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("t"))
    hashed = given.withColumn("h", F.xxhash64("t"))
    long_enough = hashed.where(F.col("id").isNotNull() & (F.octet_length("t") >= settings.length))

    keys = materialize(long_enough.select("id", "h", F.xxhash64(F.lit(1), "t").alias("h2"), F.octet_length("t").cast("long").alias("size")), "keys")
    total = keys.agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-total // settings.shard_bytes))
    texts = materialize(keys.groupBy("h", "h2", "size").agg(F.min("id").alias("least")), "texts")
    copies = keys.join(texts, ["h", "h2", "size"]).where(F.col("id") > F.col("least"))
    copied = copies.select("id", "h", F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("size").alias("length"))).alias("spans")).distinct()

    pairs = materialize(open_codes(long_enough, shards, settings), "open-codes")
    hot = materialize(pairs.groupBy("code").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > settings.hot).select("code"), "hot-codes")
    some_hot = bool(hot.limit(1).count())

    def runs_of(codes: DataFrame) -> DataFrame:
        by_text = codes.groupBy("h").agg(F.collect_list("code").alias("codes"))
        owners = materialize(by_text.join(texts.select("h", F.col("least").alias("id")), "h"), "open-texts")
        return open_runs(long_enough.join(sized(owners), ["id", "h"]), shards, settings)

    calm = pairs.join(sized(hot), "code", "left_anti") if some_hot else pairs
    hits = materialize(shard_hits(runs_of(calm), settings), "hits")
    found = [hits]
    if some_hot:
        hot_runs = materialize(runs_of(pairs.join(sized(hot), "code", "left_semi")), "hot-runs")
        found.append(materialize(row_hits(hot_runs), "hits"))
        discard(hot_runs)
    discard(pairs, hot)
    spans = merged_spans(found[0].unionByName(found[1]) if some_hot else hits, settings.length)
    removed = materialize(spans.unionByName(copied), "removed")
    discard(keys, texts, *found)

    none = F.array().cast("array<struct<start:bigint,length:bigint>>")
    size = F.octet_length("t").cast("long")
    joined = hashed.join(sized(removed), ["id", "h"], "left").withColumn("spans", F.coalesce("spans", none))
    return joined.select(F.col("id").alias("doc_id"), size.alias("n_bytes"), "spans", _kept(F.col("t"), size, F.col("spans")).alias("kept"))


def _kept(t: Column, size: Column, spans: Column) -> Column:
    """The bytes of ``t`` outside the spans: what lies before each span, and after the last."""
    begins = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda s: s["start"] + s["length"]))
    ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(size))
    pieces = F.zip_with(begins, ends, lambda b, e: F.substring(t, (b + 1).cast("int"), (e - b).cast("int")).cast("string"))
    return F.when(F.size(spans) == 0, t).otherwise(F.array_join(pieces, "").cast("binary"))
