"""Token counts that follow edits: a segment tree per document, of which an edit re-encodes the touched leaves only.

A document is cut into leaves of about ``LEAF`` characters, only at a single blank between two characters that aren't white space. There both kinds of
public tokenizer begin a new pre-token, so the counts of the leaves add up. The tree holds characters and tokens of every subtree; an edit finds its
leaves from the top, joins them with their neighbours while a border isn't such a blank (the boundary context), encodes them anew and
corrects the sums above.

Cases: null and empty texts have no tokens; a null or empty list of edits changes nothing; places beyond the end are moved to the end; a negative start
counts as 0, a null one skips the edit, a null insertion is empty; rows with null or repeated ids are each counted; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuvee.llm.common import to_python
from cuvee.llm.word_tokens import counter

LEAF = 512
EDITS = "array<struct<start:long,deleted:long,inserted:string>>"


def is_border(left: str, right: str) -> bool:
    """Whether the counts of ``left`` and ``right`` add up to that of both together."""
    return not left or not right or (not left[-1].isspace() and right[0] == " " and len(right) > 1 and not right[1].isspace())


def leaves(text: str, size: int = LEAF) -> list[str]:
    """``text`` cut at the first border at or after each ``size`` characters."""
    found, at, n = [], 0, len(text)
    while at < n:
        end = text.find(" ", at + size)
        while 0 <= end < n - 1 and (text[end - 1].isspace() or text[end + 1].isspace()):
            end = text.find(" ", end + 1)
        end = n if end < 0 or end >= n - 1 else end
        found.append(text[at:end])
        at = end
    return found


class TokenTree:
    """Subtree sums of characters and tokens over the leaves of one document."""

    def __init__(self, text: str, count: Callable[[str], int], size: int = LEAF):
        self._count, self._size = count, size
        self.encoded_chars = 0
        self._build([(leaf, self._encode(leaf)) for leaf in leaves(text, size)])
        self.encoded_chars = 0

    def _encode(self, leaf: str) -> int:
        self.encoded_chars += len(leaf)
        return self._count(leaf)

    def _build(self, parts: list[tuple[str, int]]) -> None:
        self._leaves = [leaf for leaf, _ in parts]
        self._width = 1
        while self._width < max(1, len(parts)):
            self._width *= 2
        self._chars = [0] * (2 * self._width)
        self._tokens = [0] * (2 * self._width)
        for i, (leaf, n) in enumerate(parts):
            self._chars[self._width + i], self._tokens[self._width + i] = len(leaf), n
        for node in range(self._width - 1, 0, -1):
            self._sum(node)

    def _sum(self, node: int) -> None:
        self._chars[node] = self._chars[2 * node] + self._chars[2 * node + 1]
        self._tokens[node] = self._tokens[2 * node] + self._tokens[2 * node + 1]

    @property
    def n_tokens(self) -> int:
        return self._tokens[1]

    @property
    def n_chars(self) -> int:
        return self._chars[1]

    def text(self) -> str:
        return "".join(self._leaves)

    def _find(self, place: int) -> tuple[int, int]:
        """(leaf that holds the character at ``place``, where it begins)."""
        node, begin = 1, 0
        while node < self._width:
            node *= 2
            if place >= begin + self._chars[node]:
                begin += self._chars[node]
                node += 1
        return node - self._width, begin

    def _set(self, leaf: int, text: str, tokens: int) -> None:
        self._leaves[leaf] = text
        node = self._width + leaf
        self._chars[node], self._tokens[node] = len(text), tokens
        while node > 1:
            node //= 2
            self._sum(node)

    def edit(self, start: int, deleted: int, inserted: str) -> None:
        """Replace ``deleted`` characters from ``start`` on by ``inserted``."""
        start = min(max(0, start), self.n_chars)
        end = min(start + max(0, deleted), self.n_chars)
        if not self._leaves:
            self._build([(leaf, self._encode(leaf)) for leaf in leaves(inserted, self._size)])
            return
        first, begin = self._find(min(start, max(0, self.n_chars - 1)))
        first = min(first, len(self._leaves) - 1)
        last, last_begin = self._find(min(max(start, end - 1), max(0, self.n_chars - 1)))
        last = min(last, len(self._leaves) - 1)
        whole = "".join(self._leaves[first : last + 1])
        changed = whole[: start - begin] + inserted + whole[end - begin :]
        while first > 0 and (not changed or not is_border(self._leaves[first - 1], changed)):
            first -= 1
            changed = self._leaves[first] + changed
        while last < len(self._leaves) - 1 and (not changed or not is_border(changed, self._leaves[last + 1])):
            last += 1
            changed += self._leaves[last]
        parts = leaves(changed, self._size)
        if len(parts) <= last - first + 1:
            for i in range(first, last + 1):
                leaf = parts[i - first] if i - first < len(parts) else ""
                self._set(i, leaf, self._encode(leaf) if leaf else 0)
            return
        # More leaves than there were: the tree is laid out anew, without encoding the others again.
        own = [(leaf, self._encode(leaf)) for leaf in parts]
        known = [(leaf, self._tokens[self._width + i]) for i, leaf in enumerate(self._leaves)]
        self._build([p for p in known[:first] + own + known[last + 1 :] if p[0]])


def count_with_edits(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", edits: str = "edits") -> DataFrame:
    """(key, n_tokens, n_tokens_after, n_chars_after, reencoded_chars); ``edits`` are applied one after the other. One pass, no shuffle."""
    to_python(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer)
        for batch in batches:
            out: list[tuple[int, int, int, int]] = []
            for i in range(batch.num_rows):
                tree = TokenTree(batch.column(1)[i].as_py() or "", count)
                before = tree.n_tokens
                for e in batch.column(2)[i].as_py() or []:
                    if e and e["start"] is not None:
                        tree.edit(e["start"], e["deleted"] or 0, e["inserted"] or "")
                out.append((before, tree.n_tokens, tree.n_chars, tree.encoded_chars))
            columns = zip(*out, strict=True) if out else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in columns]],
                names=["key", "n_tokens", "n_tokens_after", "n_chars_after", "reencoded_chars"],
            )

    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("t"), F.col(edits).cast(EDITS).alias("e"))
    return rows.mapInArrow(run, f"key {kind}, n_tokens long, n_tokens_after long, n_chars_after long, reencoded_chars long")


def edits_of(docs: DataFrame, changes: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` with its edits from a table (key, nth, start, deleted, inserted), as the column ``edits``."""
    listed = F.transform(
        F.array_sort(F.collect_list(F.struct("nth", "start", "deleted", "inserted"))),
        lambda e: F.struct(e["start"].alias("start"), e["deleted"].alias("deleted"), e["inserted"].alias("inserted")),
    )
    return docs.drop("edits").join(changes.groupBy(key).agg(listed.alias("edits")), key, "left")
