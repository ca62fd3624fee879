"""Toxicity: a learned lexicon matched by Levenshtein automata, with quotation told from abuse by the words around.

1. The lexicon is learned from labelled documents: words and word beginnings that are much more frequent in toxic ones.
2. ``LexiconAutomaton`` finds its terms in a text, misspelled ones too: every term of five letters or more, and every chosen word beneath a stem.
3. Each hit is weighed by its context window: quotation marks around it and verbs of speech move its weight from abuse to
   quotation.
4. A logistic regression on the sums of a document gives the score.

Scoring is one pass without a shuffle. Model and lexicon are bounded (``Settings``), and so is what training gathers.

Cases: a null text counts as empty, an empty text gets the score of a document without hits; rows with a null or repeated
id are each scored; an empty table gives no rows; other columns pass through. Labels of null and rows without a text are left out
of training; where an id has several labels, the toxic one counts. Without both labels in the training rows every score is 0.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cuvee.llm.common import give_back, to_python
from cuvee.llm.lexicon import LexiconAutomaton, Term
from cuvee.runtime import materialize

_WORD = re.compile(r"[^\W_]+")
_OPEN, _CLOSE = "\"“„«‹「", "\"”“»›」"
#: Verbs of speech that announce a quotation.
_SPEECH = frozenset(
    "said says say called calls wrote writes quoted quote quoting stated claims claimed term word slur "
    "dit écrit appelé sagte sagt schrieb nannte dijo dice escribió llamó".split()
)
N_FEATURES = 8


@dataclass(frozen=True)
class Settings:
    #: Labelled documents that training reads at most, chosen by the hash of their id.
    train_rows: int = 20_000
    terms: int = 300
    #: Different words that must precede a term in toxic training documents.
    support: int = 5
    #: Least logarithm of how much more frequent a term is in toxic documents.
    lift: float = 1.2
    stem_lengths: tuple[int, ...] = (4, 5, 6, 7, 8)
    #: Words on either side of a hit that tell quotation from abuse.
    window: int = 6
    penalty: float = 1.0


@dataclass
class ToxicityModel:
    terms: list[Term]
    weights: list[float]
    means: list[float]
    scales: list[float]
    window: int = 6
    constant: float | None = None
    automaton: LexiconAutomaton = field(init=False, repr=False)

    def __post_init__(self):
        self.automaton = LexiconAutomaton(self.terms)

    def features(self, text: str) -> list[float]:
        return document_features(text, self.automaton, self.window)

    def score(self, text: str) -> float:
        if self.constant is not None:
            return self.constant
        z = self.weights[-1] + sum(
            w * (x - m) / s
            for w, x, m, s in zip(self.weights, self.features(text), self.means, self.scales, strict=False)
        )
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def quoted_share(low: str, spans: list[tuple[int, int]], i: int, window: int) -> float:
    """How far the hit at word ``i`` is a quotation, 0 to 1: marks on both sides, or one and a verb of speech."""
    first, last = max(0, i - window), min(len(spans) - 1, i + window)
    left, right = low[spans[first][0] : spans[i][0]], low[spans[i][1] : spans[last][1] + 1]
    straight = left.count('"') % 2 == 1
    opened = straight or any(left.rfind(o) > left.rfind(c) for o, c in zip(_OPEN[1:], _CLOSE[1:], strict=True))
    closed = any(c in right for c in _CLOSE)
    spoken = any(low[a:b] in _SPEECH for a, b in spans[first:i])
    return min(1.0, 0.45 * opened + 0.35 * (opened and closed) + 0.35 * spoken)


def document_features(text: str, automaton: LexiconAutomaton, window: int) -> list[float]:
    low = text.lower()
    words = _WORD.findall(low)
    hits = automaton.matches(set(words))
    abuse = quoted = fuzzy = 0.0
    seen: set[int] = set()
    count = 0
    if hits:
        spans = [m.span() for m in _WORD.finditer(low)]
        for i, w in enumerate(words):
            if w in hits:
                term, edits = hits[w]
                weight = automaton.terms[term].weight
                share = quoted_share(low, spans, i, window)
                if edits:
                    fuzzy += weight * (1 - share)
                else:
                    abuse += weight * (1 - share)
                    count += share < 1
                    if share < 0.5:
                        seen.add(term)
                quoted += weight * share
    n = len(words)
    return [
        math.log1p(abuse),
        math.log1p(100 * abuse / (n + 20)),
        math.log1p(count),
        math.log1p(len(seen)),
        math.log1p(fuzzy),
        math.log1p(quoted),
        math.log1p(n),
        float(count >= 2),
    ]


def _word_features(text: str, lengths: tuple[int, ...]) -> tuple[Counter, dict[str, int]]:
    """Words and word beginnings (marked by a trailing star) of a text, counted up to five, and by which words they are preceded: one bit of
    63 for each, by its checksum."""
    words = _WORD.findall(text.lower())
    found: Counter = Counter()
    after: dict[str, int] = {}
    before = ""
    for w in words:
        if not w.isdigit():
            bit = 1 << zlib.crc32(before.encode()) % 63
            for term in (w, *(w[:k] + "*" for k in lengths if len(w) > k)):
                found[term] += 1
                after[term] = after.get(term, 0) | bit
        before = w
    return Counter({w: min(n, 5) for w, n in found.items()}), after


def _toxic_counts(texts: DataFrame, settings: Settings) -> DataFrame:
    """(term, n, contexts) in toxic documents; contexts is how many different words precede it, up to 63.

    Copies of one document hold its words in the same context, so they alone make no term.
    """
    lengths = settings.stem_lengths

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        seen: dict[str, int] = {}
        for batch in batches:
            for text in (v.as_py() for v in batch.column(0)):
                found, after = _word_features(text, lengths)
                total.update(found)
                for term, bits in after.items():
                    seen[term] = seen.get(term, 0) | bits
        names = list(total)
        yield pa.RecordBatch.from_pydict(
            {"term": pa.array(names, pa.string()), "n": pa.array([total[w] for w in names], pa.int64()),
             "bits": pa.array([seen[w] for w in names], pa.int64())}
        )

    rows = texts.mapInArrow(count, "term string, n long, bits long")
    return rows.groupBy("term").agg(F.sum("n").alias("n"), F.bit_count(F.bit_or("bits")).alias("contexts"))


def _clean_counts(texts: DataFrame, known: frozenset, settings: Settings) -> DataFrame:
    """(term, n) of the known terms in other documents."""
    lengths = settings.stem_lengths

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for text in (v.as_py() for v in batch.column(0)):
                found: Counter = Counter()
                for w, n in Counter(_WORD.findall(text.lower())).items():
                    for term in (w, *(w[:k] + "*" for k in lengths if len(w) > k)):
                        if term in known:
                            found[term] += n
                total.update({term: min(n, 5) for term, n in found.items()})
        yield pa.RecordBatch.from_pydict(
            {"term": pa.array(list(total), pa.string()), "n": pa.array(list(total.values()), pa.int64())}
        )

    return texts.mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def learn_lexicon(sample: DataFrame, settings: Settings) -> list[Term]:
    """Terms from a stored sample (text, toxic): the strongest first, longer ones only where they say more."""
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return []
    frequent = _toxic_counts(sample.where(F.col("toxic") == 1).select("text"), settings)
    found = frequent.where(F.col("contexts") >= settings.support).collect()
    toxic = {r["term"]: (r["n"], r["contexts"]) for r in found}
    counted = _clean_counts(sample.where(F.col("toxic") == 0).select("text"), frozenset(toxic), settings)
    clean = {r["term"]: r["n"] for r in counted.collect()}
    # A beginning that stands for one longer beginning or one word is left to that one.
    longer: Counter = Counter()
    for term, (n, _) in toxic.items():
        word = term.rstrip("*")
        for k in settings.stem_lengths:
            if k < len(word) or (k == len(word) and term == word):
                longer[word[:k] + "*"] = max(longer[word[:k] + "*"], n)
    scored = []
    for term, (n, contexts) in toxic.items():
        if longer[term] >= 0.9 * n:
            continue
        lift = math.log((n + 0.5) / (sizes[1] + 1)) - math.log((clean.get(term, 0) + 0.5) / (sizes[0] + 1))
        # What the lift could owe to chance, among so many terms, falls with the count.
        sure = lift - 4 / math.sqrt(n)
        if sure >= settings.lift:
            scored.append((sure * math.log1p(contexts), term, lift))
    chosen: dict[str, float] = {}
    beneath: dict[str, float] = {}
    for _, term, lift in sorted(scored, key=lambda s: (-s[0], s[1])):
        word = term.rstrip("*")
        covered = [chosen[word[:k] + "*"] for k in settings.stem_lengths if word[:k] + "*" in chosen]
        if covered and max(covered) >= lift - 0.7:
            if term == word and len(word) >= 5:
                # Its stem finds the word, but not all its misspellings.
                beneath[term] = lift
        elif len(chosen) < settings.terms:
            chosen[term] = lift
    return [Term(t.rstrip("*"), lift, t.endswith("*"), fuzzy_stem=True) for t, lift in [*chosen.items(), *beneath.items()]]


def _fit(x: np.ndarray, y: np.ndarray, penalty: float) -> tuple[list[float], list[float], list[float]]:
    """Logistic regression by Newton steps; the last weight is the constant."""
    means, scales = x.mean(0), x.std(0)
    scales[scales < 1e-9] = 1.0
    z = np.column_stack([(x - means) / scales, np.ones(len(x))])
    ridge = penalty * np.diag([1.0] * x.shape[1] + [1e-6])
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z.T * (p * (1 - p) + 1e-9)) @ z + ridge, z.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist(), means.tolist(), scales.tolist()


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> ToxicityModel:
    """Fit lexicon and score on at most ``settings.train_rows`` documents (doc_id, text) with labels (doc_id, toxic)."""
    to_python(docs.sparkSession)
    marked = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    )
    chosen = materialize(marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.train_rows), "train-ids")
    sample = materialize(
        docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id").select("text", "toxic"),
        "train-docs",
    )
    terms = learn_lexicon(sample, settings)
    if not terms:
        return ToxicityModel([], [], [], [], settings.window, constant=0.0)
    automaton = LexiconAutomaton(terms)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [document_features(t, automaton, settings.window) for t in (v.as_py() for v in batch.column(0))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.list_(pa.float64())), batch.column(1)], names=["x", "toxic"]
            )

    # One short row per training document, so bounded by train_rows. Sorted, so that the fit doesn't depend on task order.
    rows = sorted((tuple(r["x"]), r["toxic"]) for r in sample.mapInArrow(measure, "x array<double>, toxic int").collect())
    weights, means, scales = _fit(np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=float), settings.penalty)
    return ToxicityModel(terms, weights, means, scales, settings.window)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a column ``name``, in place of one that has that name; one pass, no shuffle."""
    to_python(docs.sparkSession)
    rest = [f for f in docs.schema.fields if f.name != name]
    at = [f.name for f in rest].index(text)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 500):  # few texts at a time as Python objects
                part = batch.slice(first, 500)
                scores = pa.array([model.score(t or "") for t in part.column(at).to_pylist()], pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, scores], names=[*part.schema.names, name])
        give_back()

    schema = T.StructType([*rest, T.StructField(name, T.DoubleType())])
    return docs.select(*[f.name for f in rest]).mapInArrow(add, schema)
