"""Hashes of words straight from the bytes of an Arrow text column, without a Python object per word.

A word is a run of bytes other than blank and \\t..\\r, with A-Z lowered; both are ASCII, so bytes and code points agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, *range(9, 14)]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
#: Bytes handled at once; a longer text is read in pieces cut at a blank.
PIECE = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins and ends; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), ends


def _hashes(piece: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of ``piece``; a word also ends at each of ``cuts``."""
    blank = _BLANK[piece]
    before = np.empty(len(piece), dtype=bool)
    before[0] = True
    before[1:] = blank[:-1]
    before[cuts[cuts < len(piece)]] = True
    starts = np.flatnonzero(~blank & before)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    runs = np.diff(starts, append=len(piece))
    first = int(starts[0])
    at = np.arange(first, len(piece)) - np.repeat(starts, runs)
    powers = np.full(int(runs.max()) + 1, _BASE, dtype=np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    values = (_LOWER[piece[first:]].astype(np.uint64) + np.uint64(1)) * powers[at]
    values[blank[first:]] = 0
    return mix(np.add.reduceat(values, starts - first) + _STEP), starts


def _long(piece: np.ndarray) -> np.ndarray:
    """Word hashes of one text longer than a piece; only the word at a cut is held over."""
    found, at = [], 0
    while at < len(piece):
        end = min(at + PIECE, len(piece))
        if end < len(piece):
            blanks = np.flatnonzero(_BLANK[piece[at:end]])
            while not len(blanks) and end < len(piece):  # a word as long as a piece
                end = min(end + PIECE, len(piece))
                blanks = np.flatnonzero(_BLANK[piece[at:end]])
            if end < len(piece):
                end = at + int(blanks[-1]) + 1
        found.append(_hashes(piece[at:end], np.zeros(0, np.int64))[0])
        at = end
    return np.concatenate(found)


def words_by_text(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(number of the text in the column, hashes of its words in order), for every text."""
    data, ends = text_bytes(column)
    row, n = 0, len(ends) - 1
    while row < n:
        if ends[row + 1] - ends[row] > PIECE:
            yield row, _long(data[ends[row] : ends[row + 1]])
            row += 1
            continue
        last = max(row + 1, int(np.searchsorted(ends, ends[row] + PIECE, side="right")) - 1)
        piece = data[ends[row] : ends[last]]
        cuts = ends[row:last] - ends[row]
        hashes, starts = _hashes(piece, cuts) if len(piece) else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        bounds = np.append(np.searchsorted(starts, cuts), len(hashes))
        for i in range(last - row):
            yield row + i, hashes[bounds[i] : bounds[i + 1]]
        row = last
