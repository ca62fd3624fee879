"""A lexicon trie intersected with Levenshtein automata, determinised as words ask for it."""

from __future__ import annotations

from dataclasses import dataclass

_DEAD = -1


@dataclass(frozen=True)
class Term:
    text: str
    weight: float
    #: A stem matches every word that begins with it; other terms match whole words.
    stem: bool = False
    #: Whether words match that begin with a misspelled stem.
    fuzzy_stem: bool = False

    @property
    def edits(self) -> int:
        """Edits allowed: none in short terms, one from five letters, two from nine; in stems only if ``fuzzy_stem``."""
        return 0 if self.stem and not self.fuzzy_stem or len(self.text) < 5 else 1 if len(self.text) < 9 else 2


class LexiconAutomaton:
    """Finds the term nearest to a word, within the edits that the term allows.

    A state is the set of (trie node, edits so far) that the letters read so far can reach: the product of the trie and
    the Levenshtein automata of all its terms. Its steps are worked out once and remembered, so a word costs one lookup a
    letter and most words end after a few. ``MEMORY`` bounds what is remembered; beyond it the memory starts anew.
    """

    MEMORY = 200_000
    HEAD = 4

    def __init__(self, terms: list[Term]):
        self.terms = terms
        self._children: list[dict[str, int]] = [{}]
        self._ends: list[list[int]] = [[]]
        self._budget = [0]
        for number, term in enumerate(terms):
            node = 0
            self._budget[0] = max(self._budget[0], term.edits)
            for letter in term.text:
                if letter not in self._children[node]:
                    self._children[node][letter] = len(self._children)
                    self._children.append({})
                    self._ends.append([])
                    self._budget.append(0)
                node = self._children[node][letter]
                self._budget[node] = max(self._budget[node], term.edits)
            self._ends[node].append(number)
        self._forget()

    def __reduce__(self):
        return LexiconAutomaton, (self.terms,)

    def _forget(self) -> None:
        self._numbers: dict[frozenset, int] = {}
        self._states: list[dict[int, int]] = []
        self._steps: list[dict[str, int]] = []
        self._whole: list[tuple[int, int] | None] = []
        self._stems: list[tuple[int, int] | None] = []
        self._words: dict[str, tuple[int, int] | None] = {}
        #: First letters after which no term can be reached; most words end there, and need no memory of their own.
        self.dead_heads: set[str] = set()
        self._held = 0
        self._start = self._number(self._closed({0: 0}))

    def _closed(self, state: dict[int, int]) -> dict[int, int]:
        """Adds what is reached by leaving out letters of a term."""
        todo = list(state.items())
        while todo:
            node, edits = todo.pop()
            for child in self._children[node].values():
                if edits + 1 <= self._budget[child] and state.get(child, 99) > edits + 1:
                    state[child] = edits + 1
                    todo.append((child, edits + 1))
        return state

    def _number(self, state: dict[int, int]) -> int:
        if not state:
            return _DEAD
        key = frozenset(state.items())
        if key not in self._numbers:
            self._numbers[key] = len(self._states)
            self._states.append(state)
            self._held += len(state)
            self._steps.append({})
            whole = [
                (edits, -self.terms[t].weight, t)
                for node, edits in state.items()
                for t in self._ends[node]
                if not self.terms[t].stem and edits <= self.terms[t].edits
            ]
            stems = [
                (edits, -self.terms[t].weight, t)
                for node, edits in state.items()
                for t in self._ends[node]
                if self.terms[t].stem and edits <= self.terms[t].edits
            ]
            self._whole.append((min(whole)[2], min(whole)[0]) if whole else None)
            self._stems.append((min(stems)[2], min(stems)[0]) if stems else None)
        return self._numbers[key]

    def _step(self, number: int, letter: str) -> int:
        reached: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self._budget[node] and reached.get(node, 99) > edits:
                reached[node] = edits

        for node, edits in self._states[number].items():
            reach(node, edits + 1)  # a letter too many
            for own, child in self._children[node].items():
                reach(child, edits + (own != letter))
        to = self._steps[number][letter] = self._number(self._closed(reached))
        return to

    def _nearer(self, one: tuple[int, int], other: tuple[int, int]) -> bool:
        return (one[1], -self.terms[one[0]].weight) < (other[1], -self.terms[other[0]].weight)

    def match(self, word: str) -> tuple[int, int] | None:
        """(number of the nearest term, edits) or None; of equally near terms the heaviest, then the first."""
        if word in self._words:
            return self._words[word]
        if len(self._words) + self._held + len(self.dead_heads) > self.MEMORY:
            self._forget()
        state, best, read = self._start, None, 0
        for letter in word:
            read += 1
            to = self._steps[state].get(letter)
            state = self._step(state, letter) if to is None else to
            if state == _DEAD:
                break
            stem = self._stems[state]
            if stem and (best is None or self._nearer(stem, best)):
                best = stem
        else:
            whole = self._whole[state]
            if whole and (best is None or self._nearer(whole, best)):
                best = whole
        if state == _DEAD and best is None and read <= self.HEAD <= len(word):
            self.dead_heads.add(word[: self.HEAD])
        else:
            self._words[word] = best
        return best

    def matches(self, words: set[str]) -> dict[str, tuple[int, int]]:
        """The words that match a term, with what ``match`` gives."""
        dead, head = self.dead_heads, self.HEAD
        found = {}
        for word in words:
            if word[:head] not in dead:
                hit = self.match(word)
                dead = self.dead_heads
                if hit is not None:
                    found[word] = hit
        return found
