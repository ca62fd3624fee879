"""Suffix stripping after Porter (1980), with the extensions common in text toolkits.

Applied to the distinct words of a batch of texts (see ``operators.text``); a task remembers the stems of the words it met last.
"""

from __future__ import annotations

from functools import lru_cache

# Whole words with a stem of their own.
IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

# The published suffix tables of steps 2, 3 and 4.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble", "alli": "al",
    "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al",
    "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
    "fulli": "ful", "logi": "log",
}
STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP_4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism",
          "ate", "iti", "ous", "ive", "ize"]


def _shape(word: str) -> str:
    """One letter per character: ``c`` consonant, ``v`` vowel; ``y`` is a vowel after a consonant."""
    shape = ""
    for ch in word:
        vowel = ch in "aeiou" or (ch == "y" and shape.endswith("c"))
        shape += "v" if vowel else "c"
    return shape


def _measure(word: str) -> int:
    return _shape(word).count("vc")


def _short_end(word: str) -> bool:
    """Ends consonant, vowel, consonant other than w, x, y; or is a vowel and a consonant alone."""
    shape = _shape(word)
    return shape == "vc" or (shape.endswith("cvc") and word[-1] not in "wxy")


def _longest(word: str, suffixes) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


def _plural(word: str) -> str:
    if word.endswith("sses"):
        return word[:-2]
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("s") and not word.endswith("ss"):
        return word[:-1]
    return word


def _past(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    ending = _longest(word, ("ed", "ing"))
    base = word[: -len(ending)] if ending else ""
    if "v" not in _shape(base):
        return word
    if base.endswith(("at", "bl", "iz")):
        return base + "e"
    if len(base) > 1 and base[-1] == base[-2] and _shape(base)[-1] == "c":
        return base if base[-1] in "lsz" else base[:-1]
    return base + "e" if _measure(base) == 1 and _short_end(base) else base


def _final_y(word: str) -> str:
    base = word[:-1]
    return base + "i" if word.endswith("y") and len(base) > 1 and _shape(base)[-1] == "c" else word


def _derived(word: str) -> str:
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        return _derived(word[:-2])
    ending = _longest(word, STEP_2)
    if ending is None:
        return word
    # The l of logi counts as part of the base, so that short bases such as geo- are reduced too.
    base = word[:-3] if ending == "logi" else word[: -len(ending)]
    return word[: -len(ending)] + STEP_2[ending] if _measure(base) > 0 else word


def _quality(word: str) -> str:
    ending = _longest(word, STEP_3)
    if ending is None or _measure(word[: -len(ending)]) == 0:
        return word
    return word[: -len(ending)] + STEP_3[ending]


def _residual(word: str) -> str:
    ending = _longest(word, STEP_4)
    if ending is None:
        return word
    base = word[: -len(ending)]
    if _measure(base) <= 1 or (ending == "ion" and base[-1] not in "st"):
        return word
    return base


def _tidy(word: str) -> str:
    if word.endswith("e"):
        base = word[:-1]
        if _measure(base) > 1 or (_measure(base) == 1 and not _short_end(base)):
            word = base
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


def stem(word: str) -> str:
    word = word.lower()
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    for step in (_plural, _past, _final_y, _derived, _quality, _residual, _tidy):
        word = step(word)
    return word


def stem_words(terms: list[str]) -> list[str]:
    return [_known_stem(t) for t in terms]


#: At most so many words are remembered, some ten megabytes.
_known_stem = lru_cache(1 << 16)(stem)
