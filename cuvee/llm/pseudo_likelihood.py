"""Language-model scores by masked pseudo-likelihood: the sum over all tokens of log P(token | the tokens on both sides).

Tokens are blank-separated words in lower case, as 64-bit hashes. All of them are counted over all documents; the ``vocabulary`` most frequent ones
have an embedding of their own, the others share ``buckets`` of them. The network sees ``window`` tokens on either side and predicts the class of the
token between, then, on a binary tree inside that class, the word: each node of the tree is a logistic regression on the network's hidden layer that starts from
the counts on its two sides. The most frequent words are classes of their own. The other words of the vocabulary share classes by hash; a Huffman tree leads
to each of them. The words outside it share classes by hash, too; ``depth`` further bits of the hash lead to one of 2^depth groups of a class,
and within a group a word has its share in the counts. The counts of those words stay a stored table, which grows with the corpus; scoring looks
each of them up there by a join.

Training is masked: a mask hides one token in ``mask_every`` of every document, and the network predicts it. The rounds deal the ``mask_every`` masks
out among them, so together they hide every token once; with more rounds than masks they begin again. Each task takes its documents in numpy from the
round's parameters, and the results are averaged by the number of tokens, as sums per parameter in a shuffle. The driver holds one set of
parameters and the vocabulary, both of fixed size. Scoring is one pass for the network, then a join of the words outside the vocabulary with their
counts. None of those is frequent, since the most frequent words went out with the model, so no key of the join is hot.

Cases: null and empty texts have no tokens, a score of 0 and a null mean; rows with null or repeated ids are each scored; a text
without repetition of known words scores by shares of its classes; an empty table gives no rows, and trains nothing; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuvee.llm.common import sized, to_python
from cuvee.llm.wordhash import words_by_text
from cuvee.runtime import materialize


@dataclass(frozen=True)
class Settings:
    vocabulary: int = 20_000
    buckets: int = 1_000
    #: Classes: the most frequent words, the rest of the vocabulary by hash, all other words by hash.
    single: int = 40
    known: int = 16
    other: int = 8
    #: Levels of the tree in a class of other words.
    depth: int = 10
    width: int = 8
    hidden: int = 24
    window: int = 3
    mask_every: int = 16
    rounds: int = 2
    batch: int = 1024
    rate: float = 0.05
    seed: int = 3
    #: Distinct words that a task counts before it hands them on.
    held: int = 2_000_000

    @property
    def classes(self) -> int:
        return self.single + self.known + self.other


@dataclass
class Model:
    settings: Settings
    words: np.ndarray  # sorted hashes of the vocabulary
    class_of: np.ndarray
    share: np.ndarray  # log P(word | class)
    other_share: np.ndarray  # log P(word | class) of a word seen once or never, by class of other words
    group_share: np.ndarray  # the same within the group, by class and group
    #: The trees: where the path of each word of the vocabulary begins in nodes and sides; the log odds of each node by the counts.
    path_at: np.ndarray
    path_node: np.ndarray
    path_side: np.ndarray
    odds: np.ndarray
    weights: dict[str, np.ndarray]
    counted: DataFrame | None = None  # (word, log_n) of the words seen more than once, stored

    def __getstate__(self) -> dict:
        return self.__dict__ | {"counted": None}  # tasks get the rest

    @cached_property
    def near(self) -> tuple[np.uint64, np.ndarray, int]:
        """(shift, begins, most): the words that agree in the bits from ``shift`` on begin at ``begins`` of these, and are at most ``most``."""
        bits = len(self.words).bit_length() + 3
        shift = np.uint64(64 - bits)
        begins = np.searchsorted(self.words, np.arange(1 << bits, dtype=np.uint64) << shift)
        return shift, begins, int(np.diff(begins, append=len(self.words)).max())

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the vocabulary has each word, and whether it does."""
        if not len(self.words):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        shift, begins, most = self.near
        at = begins.take((hashes >> shift).astype(np.int64))
        for _ in range(most):
            at += self.words.take(at, mode="clip") < hashes
        np.minimum(at, len(self.words) - 1, out=at)
        return at, self.words.take(at) == hashes

    def place(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(embedding row, class) of each token."""
        s = self.settings
        at, found = self.find(hashes)
        kind = self.class_of.take(at) if len(self.words) else np.empty(len(at), np.int64)
        row = at + s.buckets
        rare = np.flatnonzero(~found)
        row[rare] = hashes[rare] % np.uint64(s.buckets)
        kind[rare] = s.single + s.known + self.group(hashes[rare])[0]
        return row, kind

    def encode(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(embedding row, class, log P(word | class)) of each token."""
        s = self.settings
        row, kind = self.place(hashes)
        share, known = np.empty(len(row)), row >= s.buckets
        share[known] = self.share[row[known] - s.buckets]
        share[~known] = self.other_share[kind[~known] - s.single - s.known]
        return row, kind, share

    def group(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The class, from 0, and the group in it of words outside the vocabulary."""
        s = self.settings
        return (hashes >> np.uint64(40)).astype(np.int64) % s.other, (hashes >> np.uint64(48)).astype(np.int64) & ((1 << s.depth) - 1)

    def path(self, row: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, list[tuple[slice, slice, int]], np.ndarray, np.ndarray]:
        """(places of the tokens that have a way, runs, node, side) of every node on these ways, token by token. The tokens of a run, a part of the
        places and a part of the nodes, have ways of the same length: the words of the vocabulary by length, then the others."""
        s = self.settings
        known = np.flatnonzero(row >= s.buckets)
        word = row[known] - s.buckets
        first = self.path_at.take(word, mode="clip")
        long = self.path_at.take(word + 1, mode="clip") - first
        order = _order(long, 0)
        often = np.bincount(long)
        if len(often):  # a word that is alone in its class has no way
            order = order[often[0] :]
        known, first, long = known[order], first[order], long[order]
        ends = np.cumsum(long)
        at = np.repeat(first - ends + long, long) + np.arange(ends[-1] if len(ends) else 0)
        others = np.flatnonzero(row < s.buckets) if s.depth else np.zeros(0, np.int64)
        of_class, group = (x[:, None] for x in self.group(hashes[others]))
        deep = np.arange(s.depth)
        trees = len(self.odds) - (s.other << s.depth)
        node = (of_class << s.depth) + (trees + (1 << deep)) + (group >> (s.depth - deep))
        side = (group >> (s.depth - 1 - deep)) & 1
        runs, token, begin = [], 0, 0
        for length, n in [*enumerate(often.tolist()), (s.depth, len(others))]:
            if length and n:
                runs.append((slice(token, token + n), slice(begin, begin + n * length), length))
                token, begin = token + n, begin + n * length
        return (
            np.concatenate([known, others]), runs, np.concatenate([self.path_node.take(at), node.ravel()]),
            np.concatenate([self.path_side.take(at), side.ravel().astype(bool)]),
        )

    def outside(self, hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words outside the vocabulary, and where those of each text begin and end; texts end at ``bounds``."""
        _, found = self.find(hashes)
        return hashes[~found], np.concatenate([[0], np.cumsum(~found)])[bounds]


def word_counts(docs: DataFrame, settings: Settings, text: str = "text") -> DataFrame:
    """(word, n) over all documents; each task adds up its own words first."""
    to_python(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def joined(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
            found, n = np.unique(np.concatenate(parts), return_counts=True)
            every, at = np.unique(np.concatenate([words, found]), return_inverse=True)
            total = np.zeros(len(every), np.int64)
            np.add.at(total, at, np.concatenate([numbers, n]))
            return every, total

        parts, size = [], 0
        for batch in batches:
            for _, found in words_by_text(batch.column(0)):
                parts.append(found)
                size += len(found)
                if size >= settings.held:
                    words, numbers = joined(parts)
                    parts, size = [], 0
                    if len(words) >= settings.held:
                        yield _record(word=words.view(np.int64), n=numbers)
                        words, numbers = words[:0], numbers[:0]
        if parts:
            words, numbers = joined(parts)
        for at in range(0, len(words), 100_000):
            yield _record(word=words[at : at + 100_000].view(np.int64), n=numbers[at : at + 100_000])

    rows = docs.select(F.col(text).cast("string").alias("t")).mapInArrow(count, "word long, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def _record(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})


def _vocabulary(counts: DataFrame, settings: Settings) -> Model:
    """Classes and shares from the stored counts; the driver gets the vocabulary and two numbers per class of other words."""
    s = settings
    top = counts.orderBy(F.desc("n"), "word").limit(s.vocabulary).collect()
    words = np.array([r["word"] for r in top], dtype=np.int64).view(np.uint64)
    numbers = np.array([r["n"] for r in top], dtype=np.float64)
    class_of = np.where(np.arange(len(words)) < s.single, np.arange(len(words)), s.single + (words >> np.uint64(33)).astype(np.int64) % s.known)
    of_class = np.zeros(s.classes)
    np.add.at(of_class, class_of, numbers)
    share = np.log(numbers / np.maximum(of_class[class_of], 1)) if len(words) else np.zeros(0)
    # Of the words outside the vocabulary the driver holds the totals of the groups; one more token in each stands for words never seen.
    of_class = F.pmod(F.shiftrightunsigned("word", 40), F.lit(s.other)).cast("int")
    group = F.shiftrightunsigned("word", 48).bitwiseAND(F.lit((1 << s.depth) - 1)).cast("int")
    total = np.ones((s.other, 1 << s.depth))
    for r in counts.groupBy(of_class.alias("c"), group.alias("g")).agg(F.sum("n").alias("n")).collect():
        total[r["c"], r["g"]] += r["n"]
    at = (words >> np.uint64(40)).astype(np.int64) % s.other, (words >> np.uint64(48)).astype(np.int64) & ((1 << s.depth) - 1)
    np.subtract.at(total, at, numbers)
    other_share = -np.log(total.sum(1))
    order = np.argsort(words)
    path_at, path_node, path_side, odds = _huffman(class_of[order], numbers[order])
    odds = np.concatenate([odds, _halving(total).ravel()]).astype(np.float32)
    start = np.random.default_rng(s.seed)
    rows, seen = s.buckets + len(words), 2 * s.window * s.width
    weights = {
        "embed": start.normal(0, 0.1, (rows + 1, s.width)),  # the last row stands beyond the ends of a text
        "hide": start.normal(0, 1 / np.sqrt(seen), (seen, s.hidden)),
        "hide_at": np.zeros(s.hidden),
        "out": start.normal(0, 0.1, (s.hidden, s.classes)),
        "out_at": np.zeros(s.classes),
        "inner": np.zeros((len(odds), s.hidden)),
    }
    trees = (-np.log(total), path_at, path_node, path_side, odds)
    return Model(s, words[order], class_of[order], share[order], other_share, *trees, {k: v.astype(np.float32) for k, v in weights.items()})


def _huffman(class_of: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A Huffman tree in each class: where the path of each word begins, its nodes and sides; the log odds of the second side of each node."""
    paths: list[list[tuple[int, bool]]] = [[] for _ in class_of]
    odds: list[float] = []
    for c in np.unique(class_of):
        heap = [(numbers[w], int(w)) for w in np.flatnonzero(class_of == c)]
        heapq.heapify(heap)
        below: dict[int, tuple[int, int]] = {}  # words count from 0, nodes from -1 down
        while len(heap) > 1:
            (m, a), (n, b) = heapq.heappop(heap), heapq.heappop(heap)
            odds.append(float(np.log(n) - np.log(m)))
            below[-len(odds)] = a, b
            heapq.heappush(heap, (m + n, -len(odds)))
        todo: list[tuple[int, list[tuple[int, bool]]]] = [(heap[0][1], [])]
        while todo:
            at, path = todo.pop()
            if at >= 0:
                paths[at] = path
            else:
                todo += [(to, [*path, (-at - 1, side)]) for to, side in zip(below[at], (False, True), strict=True)]
    flat = [x for path in paths for x in path]
    return (
        np.cumsum([0, *map(len, paths), 0]), np.array([n for n, _ in flat], dtype=np.int64), np.array([x for _, x in flat], dtype=bool), np.array(odds)
    )


def _halving(total: np.ndarray) -> np.ndarray:
    """The log odds of the second half at each node of a tree over the columns; node 1 is the root, 2k and 2k + 1 are below k, 0 is unused."""
    odds, sums = np.zeros(total.shape), total
    while sums.shape[1] > 1:
        half = sums.shape[1] // 2
        odds[:, half : 2 * half] = np.log(sums[:, 1::2]) - np.log(sums[:, ::2])
        sums = sums[:, ::2] + sums[:, 1::2]
    return odds


def _around(rows: np.ndarray, lengths: np.ndarray, beyond: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts one after the other with ``window`` rows ``beyond`` between; and where their tokens are."""
    starts = np.cumsum([0, *(lengths[:-1] + window)]) + window if len(lengths) else np.zeros(0, np.int64)
    at = np.repeat(starts - np.cumsum([0, *lengths[:-1]]), lengths) + np.arange(len(rows)) if len(rows) else np.zeros(0, np.int64)
    line = np.full(len(rows) + window * (len(lengths) + 1), beyond, dtype=np.int64)
    line[at] = rows
    return line, at


def _offsets(window: int) -> np.ndarray:
    return np.array([o for o in range(-window, window + 1) if o])


def _forward(weights: dict[str, np.ndarray], context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What the network sees, its hidden layer, and the output before the softmax, less its largest value: a line per class, so that sums over
    the classes run along the tokens."""
    seen = weights["embed"].take(context, axis=0, mode="clip").reshape(len(context), -1)
    hidden = seen @ weights["hide"]
    hidden += weights["hide_at"]
    np.tanh(hidden, out=hidden)
    raw = weights["out"].T @ hidden.T
    raw += weights["out_at"][:, None]
    raw -= raw.max(0)
    return seen, hidden, raw


def _inside(weights: dict[str, np.ndarray], odds: np.ndarray, hidden: np.ndarray, path: tuple) -> tuple[np.ndarray, ...]:
    """The hidden layer of the tokens with a way, the weights at each node of the ways, and the log odds of its second side."""
    of, runs, node, _ = path
    above, inner, z = hidden.take(of, axis=0), weights["inner"].take(node, axis=0, mode="clip"), odds.take(node)
    for tokens, nodes, long in runs:
        z[nodes] += np.einsum("nd,nld->nl", above[tokens], inner[nodes].reshape(-1, long, inner.shape[1])).ravel()
    return above, inner, z


def _order(at: np.ndarray, below: int) -> np.ndarray:
    """Stable order of numbers from 0 to ``below``, by 16 bits at a time: these are sorted by counting."""
    order = np.argsort(at.astype(np.uint16), kind="stable")
    for shift in range(16, int(below).bit_length(), 16):
        order = order[np.argsort((at >> shift).astype(np.uint16)[order], kind="stable")]
    return order


def _sums(at: np.ndarray, rows: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    """The different values of ``at``, all less than ``below``, and the sum of the rows of each."""
    order = _order(at, below)
    ordered = at[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    often = np.diff(first, append=len(at))
    sums, many = rows.take(order[first], axis=0), often > 1
    if many.any():  # most values stand there once
        added = rows.take(order[np.repeat(many, often)], axis=0)
        begins = np.cumsum(often[many]) - often[many]
        if added.shape[1] % 2 == 0 and added.dtype == np.float32:  # two columns at a time
            added = np.add.reduceat(added.view(np.complex64), begins, axis=0).view(np.float32)
        else:
            added = np.add.reduceat(added, begins, axis=0)
        sums[many] = added
    return ordered[first], sums


def _as_items(rows: np.ndarray) -> np.ndarray:
    """Each row as one item, so that it is written in one go."""
    return rows.view(np.dtype((np.void, rows.shape[1] * rows.itemsize)))[:, 0]


def _step_rows(weights: np.ndarray, memory: np.ndarray, at: np.ndarray, step: np.ndarray, rate: float, least: float) -> None:
    """An Adagrad step of some rows."""
    past = memory.take(at, axis=0, mode="clip")
    past += step * step
    _as_items(memory)[at] = _as_items(past)
    if least:
        past += np.float32(least)
    np.sqrt(past, out=past)
    step *= np.float32(rate)
    step /= past
    _as_items(weights)[at] = _as_items(np.subtract(weights.take(at, axis=0, mode="clip"), step, out=step))


def _learn(weights: dict[str, np.ndarray], memory: dict[str, np.ndarray], context: np.ndarray, target: np.ndarray, rate: float,
           odds: np.ndarray, path: tuple) -> None:
    """One Adagrad step on the mean loss of a batch, of the classes and of the trees."""
    seen, hidden, error = _forward(weights, context)
    np.exp(error, out=error)
    error *= 1 / (error.sum(0) * np.float32(len(target)))
    error[target, np.arange(len(target))] -= np.float32(1 / len(target))
    back = error.T @ weights["out"].T
    of, runs, node, side = path
    if len(node):
        above, inner, z = _inside(weights, odds, hidden, path)
        wrong = ((1 / (1 + np.exp(-np.clip(z, -60, 60))) - side) / np.float32(len(target))).astype(np.float32)
        below = np.empty_like(above)
        for tokens, nodes, long in runs:
            share, ways = wrong[nodes].reshape(-1, long), inner[nodes].reshape(-1, long, inner.shape[1])
            np.einsum("nl,nld->nd", share, ways, out=below[tokens])
            np.multiply(share[:, :, None], above[tokens][:, None, :], out=ways)
        back[of] += below
        _step_rows(weights["inner"], memory["inner"], *_sums(node, inner, len(weights["inner"])), rate, 0.0)
    back *= 1 - hidden * hidden
    steps = {"out": (error @ hidden).T, "out_at": error.sum(1), "hide": seen.T @ back, "hide_at": back.sum(0)}
    for name, step in steps.items():
        memory[name] += step * step
        weights[name] -= rate * step / np.sqrt(memory[name] + 1e-8)
    of_rows = (back @ weights["hide"].T).reshape(-1, weights["embed"].shape[1])
    _step_rows(weights["embed"], memory["embed"], *_sums(context.ravel(), of_rows, len(weights["embed"])), rate, 1e-8)


def _texts(column: pa.Array, model: Model, limit: int = 1 << 18) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """Runs of texts with about ``limit`` words together: (first, last + 1, their hashes)."""
    first, size, held = 0, 0, []
    for i, words in words_by_text(column):
        held.append(words)
        size += len(words)
        if size >= limit:
            yield first, i + 1, held
            first, size, held = i + 1, 0, []
    if held:
        yield first, first + len(held), held


def masks(settings: Settings, number: int) -> range:
    """The masks of a round."""
    return range(number % settings.mask_every, settings.mask_every, settings.rounds)


def _round(docs: DataFrame, model: Model, number: int, text: str) -> dict[str, np.ndarray]:
    s = model.settings
    shapes = {k: v.shape for k, v in model.weights.items()}
    piece = 8192

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = {k: v.copy() for k, v in model.weights.items()}
        memory = {k: np.full_like(v, {"embed": 1e-3, "inner": 1e-6}.get(k, 1e-2)) for k, v in weights.items()}
        offsets, tokens = _offsets(s.window), 0
        beyond = len(weights["embed"]) - 1
        for batch in batches:
            for _, _, held in _texts(batch.column(0), model):
                hashes = np.concatenate(held)
                row, kind = model.place(hashes)
                line, at = _around(row, np.array([len(h) for h in held]), beyond, s.window)
                # Which tokens are hidden moves with the round and from text to text.
                shift = np.repeat([int(h[0] % np.uint64(s.mask_every)) if len(h) else 0 for h in held], [len(h) for h in held])
                place = (np.arange(len(row)) + shift) % s.mask_every
                order, ends = _order(place, s.mask_every), np.cumsum(np.bincount(place, minlength=s.mask_every))
                for mask in masks(s, number):
                    hidden = order[ends[mask - 1] if mask else 0 : ends[mask]]
                    for k in range(0, len(hidden), s.batch):
                        part = hidden[k : k + s.batch]
                        path = model.path(row[part], hashes[part])
                        _learn(weights, memory, line.take(at[part][:, None] + offsets), kind[part], s.rate, model.odds, path)
                    tokens += len(hidden)
        if tokens:
            flat = np.concatenate([weights[k].ravel() for k in shapes])
            for k in range(0, len(flat), piece):
                yield pa.RecordBatch.from_pydict({"at": [k], "n": [tokens], "x": [flat[k : k + piece].tobytes()]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for at, n, x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                m, y = total.get(at, (0, 0.0))
                total[at] = m + n, y + np.frombuffer(x, np.float32).astype(np.float64) * n
        for at, (n, x) in total.items():
            yield pa.RecordBatch.from_pydict({"at": [at], "x": [(x / n).tobytes()]})

    # In pieces, so that a task hands on few rows; each piece is added up in one place, one row at a time.
    rows = docs.select(F.col(text).cast("string").alias("t")).mapInArrow(work, "at long, n long, x binary")
    flat = np.concatenate([v.ravel() for v in model.weights.values()]).astype(np.float64)
    for r in rows.repartition("at").mapInArrow(add, "at long, x binary").collect():
        mean = np.frombuffer(r["x"])
        flat[r["at"] : r["at"] + len(mean)] = mean
    out, begin = {}, 0
    for k, shape in shapes.items():
        size = int(np.prod(shape))
        out[k] = flat[begin : begin + size].reshape(shape).astype(np.float32)
        begin += size
    return out


def train(docs: DataFrame, settings: Settings = Settings(), text: str = "text") -> Model:
    counts = materialize(word_counts(docs, settings, text), "word-counts")
    model = _vocabulary(counts, settings)
    model.counted = materialize(counts.where("n > 1").select("word", F.log("n").alias("log_n")), "word-shares")
    for number in range(settings.rounds):
        model.weights = _round(docs, model, number, text)
    return model


def log_probabilities(model: Model, held: list[np.ndarray]) -> np.ndarray:
    """log P(token | both sides) of every token of some texts; a word outside the vocabulary as if seen once."""
    s = model.settings
    hashes = np.concatenate(held)
    row, kind = model.place(hashes)
    line, at = _around(row, np.array([len(h) for h in held]), len(model.weights["embed"]) - 1, s.window)
    offsets, found = _offsets(s.window), np.empty(len(row))
    for k in range(0, len(row), 4096):
        part = slice(k, min(k + 4096, len(row)))
        _, hidden, raw = _forward(model.weights, line.take(at[part][:, None] + offsets))
        path = of, runs, _, side = model.path(row[part], hashes[part])
        z = _inside(model.weights, model.odds, hidden, path)[2]
        chosen = np.log1p(np.exp(np.clip(np.where(side, -z, z), -60, 60)))
        own = raw[kind[part], np.arange(len(hidden))]
        found[part] = own - np.log(np.exp(raw, out=raw).sum(0))
        for tokens, nodes, long in runs:
            found[part.start + of[tokens]] -= chosen[nodes].reshape(-1, long).sum(1, dtype=np.float64)
    rare = row < s.buckets
    found[rare] += model.group_share[model.group(hashes[rare])]
    return found


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, log_probability, mean_log_probability) of every document.

    The words outside the vocabulary are scored as seen once by the network's pass; the logarithm of their counts is added by a join.
    """
    to_python(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, held in _texts(batch.column(1), model):
                lengths = np.array([len(h) for h in held])
                ends = np.concatenate([[0.0], np.cumsum(log_probabilities(model, held))])
                bounds = np.cumsum([0, *lengths])
                rare, starts = model.outside(np.concatenate(held), bounds)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first), pa.array(lengths, pa.int64()), pa.array(ends[bounds[1:]] - ends[bounds[:-1]]),
                        pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(rare.view(np.int64))),
                    ],
                    names=["key", "n_tokens", "x", "rare"],
                )

    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("t"))
    parts = rows.mapInArrow(work, f"key {kind}, n_tokens long, x double, rare array<long>")
    if model.counted is not None:
        # Stored, so that the numbers of its rows are the same on both sides.
        parts = materialize(parts.withColumn("row", F.monotonically_increasing_id()), "lm-parts")
        words = parts.select("row", F.explode("rare").alias("word"))
        more = words.join(sized(model.counted), "word").groupBy("row").agg(F.sum("log_n").alias("more"))
        parts = parts.drop("rare").join(more, "row", "left").withColumn("x", F.col("x") + F.coalesce("more", F.lit(0.0)))
    mean = F.when(F.col("n_tokens") > 0, F.col("x") / F.col("n_tokens"))
    return parts.select("key", "n_tokens", F.col("x").alias("log_probability"), mean.alias("mean_log_probability"))
