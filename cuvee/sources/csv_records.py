"""Records of CSV files whose quoted cells hold line breaks, read in splits.

Spark reads such files with one task per file, since a split can't tell whether it begins inside a quoted cell. Here it is told:

1. Every line is a map: from the state before it (outside or inside a quoted cell) to the state after it. A line without quotes keeps the
   state, an odd number of quotes turns it round, a stray quote may set it. A split's map is that of its lines one after another.
2. The maps of the splits of a file, one row each, are run through in order: a prefix that gives each split the state it begins in.
3. Each task puts its lines together to records from its first record on. The lines of records that cross splits, at most one record
   at either end of a split, are met by (file, split in which the record begins).

The driver holds one line of numbers per split, as it does for the scan itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuvee.runtime import materialize, ship_package

#: A record longer than this is taken for a quote that was never closed.
LONGEST_RECORD = 1 << 30
_OUTSIDE, _INSIDE, _CLOSED = 0, 1, 2
_QUOTE, _COMMA = ord('"'), ord(",")


def line_maps(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The state (1: inside a quoted cell) after each line that begins outside, and after each that begins inside.

    A quote opens a cell at its beginning only; inside, two quotes are one of the text; any other quote is text. The first quotes of all
    lines are read together, then the second ones, and so on.
    """
    wide = lines.cast(pa.large_string())
    ends = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    data = np.frombuffer(wide.buffers()[2], np.uint8) if wide.buffers()[2] is not None else np.zeros(0, np.uint8)
    quotes = np.flatnonzero(data[ends[0] : ends[-1]] == _QUOTE) + ends[0]
    line = np.searchsorted(ends, quotes, side="right") - 1
    at_start = quotes == ends[line]
    before = data[np.maximum(quotes - 1, 0)]
    after_comma, doubled = ~at_start & (before == _COMMA), ~at_start & (before == _QUOTE)
    first = np.searchsorted(line, np.arange(len(lines)))
    number = np.diff(np.append(first, len(quotes)))
    state = np.zeros((2, len(lines)), np.int8)
    state[1] = _INSIDE
    open_ = np.flatnonzero(number)
    for k in range(int(number.max(initial=0))):
        open_ = open_[number[open_] > k]
        quote = first[open_] + k
        now = state[:, open_]
        opens = after_comma[quote] | (at_start[quote] & (now == _OUTSIDE)) | (doubled[quote] & (now == _CLOSED))
        state[:, open_] = np.where(now == _INSIDE, _CLOSED, np.where(opens, _INSIDE, _OUTSIDE))
    return state[0] == _INSIDE, state[1] == _INSIDE


def join_lines(lines: pa.Array, starts: np.ndarray) -> pa.Array:
    """Lines put together to records that begin at ``starts``, the first of which is 0. In the buffer one line follows the other
    already; the breaks are put in between."""
    wide = lines.cast(pa.large_string())
    ends = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    data = np.frombuffer(wide.buffers()[2], np.uint8)[ends[0] : ends[-1]] if wide.buffers()[2] is not None else np.zeros(0, np.uint8)
    more = np.ones(len(lines), bool)
    more[starts] = False
    joined = np.insert(data, ends[:-1][more] - ends[0], np.uint8(10)) if more.any() else data
    at = np.append(starts, len(lines))
    offsets = ends[at] - ends[0] + at - np.arange(len(at))
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(joined)))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, at, line): ``file`` is a hash of the path, ``at`` follows the lines within a block."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"),
    )


def states(f0: np.ndarray, f1: np.ndarray, begin: int) -> np.ndarray:
    """The state before each line, and after the last: a line that ends in one state either way sets it, others keep it or turn it."""
    n = len(f0)
    sets = f0 == f1
    turns = np.concatenate([[0], np.cumsum(f0 & ~f1)])
    last = np.maximum.accumulate(np.where(sets, np.arange(1, n + 1), 0)) if n else np.zeros(0, np.int64)
    last = np.concatenate([[0], last])
    value = np.where(last > 0, f0[np.maximum(last - 1, 0)], begin) if n else np.array([begin])
    return (value + turns - turns[last]) % 2


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """The rows of a batch by block; blocks follow one another."""
    file, block = batch.column("file").to_numpy(), batch.column("block").to_numpy()
    edges = np.flatnonzero((block[1:] != block[:-1]) | (file[1:] != file[:-1])) + 1
    for a, b in zip([0, *edges], [*edges, len(block)], strict=True):
        yield int(file[a]), int(block[a]), batch.slice(a, b - a)


def _block_maps(lines: DataFrame) -> DataFrame:
    """A row for each block: its first line, its map, and for either state at its beginning (0 outside, 1 inside) the line with which a
    record that began earlier ends (head) and the one with which its last record begins (tail); -1 where there is none."""

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        key, now = None, None
        for batch in batches:
            for file, block, part in _blocks(batch):
                at, (f0, f1) = part.column("at").to_numpy(), line_maps(part.column("line"))
                if (file, block) != key:
                    done += [(*key, *now)] if key else []
                    key, now = (file, block), [int(at[0]), 0, 1, -1, -1, -1, -1]
                for begin in (0, 1):
                    state = states(f0, f1, now[1 + begin])
                    now[1 + begin] = int(state[-1])
                    starts = np.flatnonzero(state[:-1] == 0)
                    if now[5 + begin] < 0 and begin:  # no record has begun: so far all belongs to the head
                        now[3 + begin] = int(at[-1]) if not len(starts) else int(at[starts[0] - 1]) if starts[0] else now[3 + begin]
                    if len(starts):
                        now[5 + begin] = int(at[starts[-1]])
        done += [(*key, *now)] if key else []
        if done:
            names = ["file", "block", "first", "to0", "to1", "head0", "head1", "tail0", "tail1"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*done, strict=True)], names=names)

    schema = "file long, block long, first long, to0 long, to1 long, head0 long, head1 long, tail0 long, tail1 long"
    return lines.mapInArrow(compose, schema)


@dataclass(frozen=True)
class Split:
    """What a task must know of a block: the state it begins in, the lines that belong to records which cross its ends, and the blocks
    in which those records begin (-1: no such record)."""

    begin: int
    first: int
    head: int
    head_owner: int
    tail: int
    crosses: bool


def plan_splits(rows: list, longest: int = LONGEST_RECORD) -> dict[tuple[int, int], Split]:
    """The splits of all files, from the maps of their blocks."""
    found: dict[tuple[int, int], Split] = {}
    state, owner, file = 0, -1, None
    for r in sorted(rows, key=lambda r: (r["file"], r["block"])):
        if r["file"] != file:
            file, state, owner = r["file"], 0, -1
        begin, came_from = state, owner
        state = r["to1"] if begin else r["to0"]
        tail = r["tail1"] if begin else r["tail0"]
        if begin and r["block"] - came_from > longest:
            raise ValueError(f"the quoted cell that is open after the split of a file at byte {came_from} is longer than {longest} bytes")
        # Without a record that begins here, one that is still open goes on.
        owner = (r["block"] if tail >= 0 else came_from) if state else -1
        found[file, r["block"]] = Split(begin, r["first"], r["head1"] if begin else -1, came_from if begin else -1, tail, bool(state) and tail >= 0)
    return found


def _crossing(lines: DataFrame, splits: dict[tuple[int, int], Split], header: bool) -> DataFrame:
    """(record) of the records that cross splits. Read at once, while the lines are numbered as they were for the plan."""
    wanted = []
    for (file, block), s in splits.items():
        if s.head >= 0:
            wanted.append((file, block, s.head_owner, -1, s.head))
        if s.crosses and not (header and block == 0 and s.tail == s.first):
            wanted.append((file, block, block, s.tail, -1))
    kept = {(f, o) for f, b, o, low, _ in wanted if low >= 0}
    wanted = [w for w in wanted if (w[0], w[2]) in kept]
    spark = lines.sparkSession
    # Two rows a split at most: of the size of the scan's own list of splits.
    ranges = spark.createDataFrame(wanted, "file long, block long, owner long, low long, high long")
    inside = (F.col("at") >= F.col("low")) & ((F.col("high") < 0) | (F.col("at") <= F.col("high")))
    pieces = lines.select("file", "block", "at", "line").join(F.broadcast(ranges), ["file", "block"]).where(inside)
    met = pieces.groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("block", "at", "line"))).alias("p"))
    return met.select(F.array_join(F.transform("p", lambda x: x["line"]), "\n").alias("record"))


def read_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """(record string): the records of the CSV files under ``path`` without the line break at their end; blank ones are left out, and with
    ``header`` the first of each file. Lines end in \\n or \\r\\n; line breaks inside quoted cells are kept as they are.

    The files are read once at the call, for the plan, and again by whoever reads the records; the splits must be the same by then.
    """
    ship_package(spark)
    lines = _lines(spark, path)
    splits = plan_splits(_block_maps(lines).collect())

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, open_lines, skip = None, 0, [], False

        def told(records: list[pa.Array]) -> pa.Array:
            """The records as one array, without the header if it is still to come."""
            nonlocal skip
            found = pa.concat_arrays(records) if records else pa.array([], pa.large_string())
            if skip and len(found):
                first = next((i for i, r in enumerate(found) if r.as_py().rstrip("\r")), None)
                found, skip = (found.slice(len(found)), True) if first is None else (found.slice(first + 1), False)
            return found

        def rest() -> pa.Array:
            """The record that is open at the end of a block, unless it goes on in the next."""
            return told([pa.array(["\n".join(open_lines)], pa.large_string())] if open_lines and not state else [])

        for batch in batches:
            out = []
            for file, block, part in _blocks(batch):
                if (file, block) != key:
                    out.append(rest())
                    key, open_lines = (file, block), []
                    if key not in splits:
                        raise ValueError(f"a file is split at byte {block} now, and was not when it was planned; read it again")
                    state, skip = splits[key].begin, header and block == 0
                before = states(*line_maps(part.column("line")), state)
                state = int(before[-1])
                text = part.column("line").cast(pa.large_string())
                starts = np.flatnonzero(before[:-1] == 0)
                first = starts[0] if len(starts) else len(text)
                # Lines before the first record of the block belong to an earlier split.
                open_lines += text.slice(0, first).to_pylist() if open_lines else []
                if not len(starts):
                    continue
                begun = [pa.array(["\n".join(open_lines)], pa.large_string())] if open_lines else []
                # All records but the last are whole; that one may go on in the next batch.
                out.append(told([*begun, join_lines(text.slice(first, starts[-1] - first), starts[:-1] - first)]))
                open_lines = text.slice(starts[-1]).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(out).cast(pa.string()) if out else pa.array([], pa.string())], names=["record"])
        yield pa.RecordBatch.from_arrays([rest().cast(pa.string())], names=["record"])

    records = lines.drop("at").mapInArrow(assemble, "record string")
    if any(s.begin or s.crosses for s in splits.values()):
        records = records.unionByName(materialize(_crossing(lines, splits, header), "crossing-records"))
    whole = F.when(F.endswith("record", F.lit("\r")), F.left("record", F.length("record") - 1)).otherwise(F.col("record"))
    return records.select(whole.alias("record")).where(F.col("record") != "")
