"""Text cleaning as built-in column expressions, fused by Catalyst into the scan stage."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cuvee.functions import words
from cuvee.schema import MISSING

TRAILING_BRACKET = r"\((.+)\)\s*$"


def fill_missing(c: Column, value: str = MISSING) -> Column:
    return F.coalesce(c, F.lit(value))


def fold(c: Column) -> Column:
    """Latin letters to ASCII. A text with as many bytes as characters is ASCII already and passes as it is."""
    one = F.translate(c, words.FOLD_FROM, words.FOLD_TO)
    folded = reduce(lambda x, m: F.replace(x, F.lit(m[0]), F.lit(m[1])), words.FOLD_MANY.items(), one)
    # One look for what has a longer spelling spares most texts the replacements.
    longer = F.when(one.rlike("[" + "".join(words.FOLD_MANY) + "]"), folded).otherwise(one)
    return F.when(F.octet_length(c) == F.char_length(c), c).otherwise(longer)


def normalize_category(c: Column, missing: str = MISSING) -> Column:
    """Missing becomes a category of its own; lower case comes before folding."""
    return fold(F.lower(fill_missing(c, missing)))


def title_year(title: Column) -> Column:
    """First run of four or more digits of the raw title, without a range check; null when there is none."""
    digits = F.nullif(F.regexp_extract(title, r"(?U)(\d{4,})", 1), F.lit(""))
    return F.translate(digits, words.DIGITS_FROM, words.DIGITS_TO).try_cast("double")


def strip_title(title: Column) -> Column:
    """Drop numbers followed by a blank, then the last bracket (from the first opening one), then squeeze blanks.

    Not trimmed: the blank before the bracket stays.
    """
    no_numbers = F.regexp_replace(title, r"(\d+ )", "")
    no_place = F.regexp_replace(no_numbers, TRAILING_BRACKET, "")
    return F.regexp_replace(no_place, r"\s{2,}", " ")


def clean_title(title: Column) -> Column:
    return strip_title(normalize_category(title))


def title_place(title: Column) -> Column:
    """Text of the trailing bracket, null when there is none."""
    return F.nullif(F.regexp_extract(title, TRAILING_BRACKET, 1), F.lit(""))


def word_list(c: Column) -> Column:
    """Array of the words of a lower-case text, clitics, numbers and marks included, in order."""
    quoted = F.regexp_replace(c, words.OPENING_QUOTE, " `` ")
    apart = F.replace(F.regexp_replace(quoted, words.APART, " $0 "), F.lit('"'), F.lit("''"))
    unclipped = F.regexp_replace(apart, words.CLITIC, " $0")
    return F.filter(F.split(F.regexp_replace(unclipped, words.JOINED, "$0 "), r"\s+"), lambda w: w != "")


def content_words(c: Column) -> Column:
    """Words of the folded text that are neither stop words nor single punctuation marks."""
    return F.filter(
        word_list(fold(F.lower(fill_missing(c)))),
        lambda w: ~w.isin(words.STOP_WORDS + words.PUNCTUATION),
    )


def index_terms(c: Column) -> Column:
    """Terms for weighting: runs of at least two word characters, case kept."""
    def runs(pattern: str) -> Column:
        return F.regexp_extract_all(c, F.lit(pattern), F.lit(0))

    # Of ASCII the plain pattern finds the same runs, each from its beginning, without asking for the classes of Unicode.
    return F.when(F.octet_length(c) == F.char_length(c), runs(r"\w\w+")).otherwise(runs(r"(?U)\b\w\w+\b"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where the body uses it inside another lambda."""
    return F.get(F.transform(F.array(value), body), 0)


def term_counts(terms: Column) -> Column:
    """Array of (term, n) sorted by term, counted inside the row: sort, find run starts, take differences."""

    def counts(ordered: Column, starts: Column) -> Column:
        return F.transform(
            starts,
            lambda at, j: F.struct(
                F.get(ordered, at).alias("term"),
                (F.coalesce(F.get(starts, j + 1), F.size(ordered)) - at).cast("int").alias("n"),
            ),
        )

    def run_starts(ordered: Column) -> Column:
        places = F.transform(ordered, lambda _, i: i)
        return F.filter(places, lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)))

    return let(F.sort_array(terms), lambda o: let(run_starts(o), lambda s: counts(o, s)))
