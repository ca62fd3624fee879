"""Token ids of a public tokenizer file, with the ids of each blank-separated chunk kept.

Tokenizers that split a text at white space before they merge give a chunk the same ids wherever it stands. So a chunk is encoded
once for each memory and looked up afterwards; chunks are cut at blank, tab and line ends only, and every other kind of white space stays
inside a chunk for the tokenizer itself.
"""

from __future__ import annotations

import json
import os
import re
import threading
from collections.abc import Callable
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_MEMORY = 550_000
#: Characters of texts whose new chunks are encoded together.
_TOGETHER = 1_000_000
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_NOT_LATIN = re.compile("[^a-z\u00df-\u024f ]")
#: The steps around the merges for which ``_by_word`` holds: lower-case Latin words pass them as they are, and marks after a word are cut off as one piece.
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_CUT = {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
_PRE_TOKENIZERS = [
    {"type": "Split", "pattern": _CUT, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
_local: dict[str, ChunkEncoder] = {}
_lock = threading.Lock()


def _by_word(tokenizer):
    """The tokenizer without the steps that leave blank-separated lower-case Latin words as they are; None if its steps are others."""
    from tokenizers import Tokenizer, pre_tokenizers

    steps = json.loads(tokenizer.to_str())
    if steps["normalizer"] != {"type": "Sequence", "normalizers": _NORMALIZER}:
        return None
    if steps["pre_tokenizer"] != {"type": "Sequence", "pretokenizers": _PRE_TOKENIZERS}:
        return None
    lean = Tokenizer(tokenizer.model)
    bytewise = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    lean.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), bytewise])
    return lean


class ChunkEncoder:
    """For tokenizers that drop white space, such as ``word_bpe_49k.json``."""

    def __init__(self, file: str):
        # A task has its own core; threads of its own would take those of other tasks.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(file)
        self._known: dict[str, bytes] = {"": b""}
        # A tokenizer that lowers itself gives a text and its lower case the same ids.
        self._lowers = self.whole("ABC Abc") == self.whole("abc abc")
        # Tokens that end a word, for vocabularies that mark them.
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._by_word = _by_word(self._tokenizer)

    def _encode(self, chunks: list[str]) -> None:
        for at in range(0, len(chunks), 10_000):
            part = chunks[at : at + 10_000]
            for chunk, found in zip(part, self._tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self._known[chunk] = np.array(found.ids, dtype="<u4").tobytes()

    def _encode_words(self, words: list[str]) -> None:
        """Lower-case words of letters only: each is one pre-token, so many are encoded as one text and told apart by their ends."""
        for at in range(0, len(words), 20_000):
            part = words[at : at + 20_000]
            text = " ".join(part)
            # The whole tokenizer may know other letters than Python does, so it reads all but Latin ones.
            tokenizer = self._tokenizer if self._by_word is None or _NOT_LATIN.search(text) else self._by_word
            ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = np.flatnonzero(self._ends[ids]) + 1
            if len(cuts) != len(part):
                self._encode(part)
                continue
            data, begin = ids.tobytes(), 0
            for word, end in zip(part, (4 * cuts).tolist(), strict=True):
                self._known[word] = data[begin:end]
                begin = end

    def _learn(self, chunks: set[str], lowered: bool) -> None:
        if not lowered or not self._ends.any():
            self._encode(list(chunks))
            return
        known, words, marks, marked, others = self._known, set(), set(), [], []
        for chunk in chunks:
            if chunk.isalpha():
                words.add(chunk)
                continue
            word = chunk.rstrip(_MARKS) if self._by_word else chunk[:-1]
            mark = chunk[len(word) :]
            if word.isalpha() and (not _NOT_LATIN.search(word) if self._by_word else mark in ".,"):
                marked.append((chunk, word, mark))
                words.add(word)
                marks.add(mark)
            else:
                others.append(chunk)
        words = words.difference(known)
        rare = {w for w in words if _NOT_LATIN.search(w)} if _NOT_LATIN.search(" ".join(words)) else set()
        self._encode_words(list(words - rare))
        self._encode_words(list(rare))
        self._encode([*others, *marks.difference(known).difference(others)])
        for chunk, word, mark in marked:
            known[chunk] = known[word] + known[mark]

    def _ready(self, text: str) -> tuple[str, bool]:
        """The text with blanks between its chunks, and whether it is lower-case."""
        # Lowering first makes fewer chunks. Where it might not commute with the tokenizer's own steps the text stays as it is.
        low = text.lower() if self._lowers else text
        lowered = self._lowers and (
            text.isascii() or ("\u03a3" not in text and is_normalized("NFC", text) and is_normalized("NFC", low))
        )
        return (low if lowered else text).replace("\n", " ").replace("\t", " ").replace("\r", " "), lowered

    def _ids_of(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        ready, lowered = zip(*map(self._ready, texts))
        split = pc.split_pattern(pa.array(ready, pa.large_string()), " ")
        coded = split.flatten().dictionary_encode()
        number, ends = coded.indices.to_numpy(), split.offsets.to_numpy()
        chunks = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = set(chunks).difference(self._known)
        if new:
            if len(self._known) + len(new) > _MEMORY:
                self._known = {"": b""}
                new = set(chunks).difference(self._known)
            as_is = {chunks[n] for i, low in enumerate(lowered) if not low for n in number[ends[i] : ends[i + 1]].tolist()}
            self._learn(new - as_is, True)
            self._learn((new & as_is).difference(self._known), False)
        found = [self._known[c] for c in chunks]
        ids = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts, sizes = (np.cumsum(sizes) - sizes)[number], sizes[number]
        before = np.append(0, np.cumsum(sizes))
        data = ids[np.repeat(starts - before[:-1], sizes) + np.arange(before[-1])].tobytes()
        cuts = (4 * before[ends]).tolist()
        return [data[begin:end] for begin, end in zip(cuts, cuts[1:])]

    def all_ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers; what is new in several texts is encoded together."""
        found, held, size = [], [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= _TOGETHER:
                found += self._ids_of(held)
                held, size = [], 0
        return found + self._ids_of(held)

    def ids(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit numbers."""
        ready, lowered = self._ready(text)
        chunks = ready.split(" ")
        known = self._known
        missing = set(chunks).difference(known)
        if missing:
            if len(known) + len(missing) > _MEMORY:
                known = self._known = {"": b""}
                missing = set(chunks).difference(known)
            self._learn(missing, lowered)
        return b"".join(map(known.__getitem__, chunks))

    def whole(self, text: str) -> bytes:
        """The ids of a text that is encoded in one piece."""
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def encoder(file: str) -> ChunkEncoder:
    """The encoder of this Python worker."""
    with _lock:
        if file not in _local:
            _local[file] = ChunkEncoder(file)
        return _local[file]


def counter(file: str) -> Callable[[str], int]:
    """Counts the tokens of a text; for tokenizers that keep white space the whole text is encoded."""
    chunks = encoder(file)
    if chunks.ids("a b") == chunks.whole("a b"):
        return lambda text: len(chunks.ids(text)) // 4
    return lambda text: len(chunks.whole(text)) // 4
