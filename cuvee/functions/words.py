"""Fixed values of the text jobs: these must equal the published lists for results to be right."""

from __future__ import annotations

import sys
import unicodedata

# The published English stop list (179 words), in its natural order.
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves
he him his himself she she's her hers herself it it's its itself they them their theirs themselves
what which who whom this that that'll these those am is are was were be been being
have has had having do does did doing a an the and but if or because as until while
of at by for with about against between into through during before after above below
to from up down in out on off over under again further then once here there when where why how
all any both each few more most other some such no nor not only own same so than too very
s t can will just don don't should should've now d ll m o re ve y
ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't
isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't
wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# The 32 ASCII punctuation marks, dropped when they stand alone.
PUNCTUATION = list("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")

# Word splitting rules of the published Penn Treebank tokeniser, as Java patterns.
# A quote at the start of a word; a mark that stands apart; a clitic at the end of a word; two words written as one.
# The leading look-ahead only saves time: most characters fail it at once.
OPENING_QUOTE = r'"(?<=(?:^|[\s(\[{<])")'
APART = (
    r"(?=[.,:;?!@#$%&\-\[\](){}<>\"])(?:"
    r"\.(?<!\.\.)(?=[\])}>\"']*(?:\s|$))"  # the period that ends a sentence
    r"|\.\.\.|--"
    r"|[;@#$%&?!\[\](){}<>\"]"
    r"|[:,](?![0-9]))"
)
CLITIC = r"(?=['n])(?<=[^'\s])(?:'(?:s|m|d|ll|re|ve)?|n't)(?=\s|$)"
JOINED = (
    r"(?=[cgldmw'])(?:"
    r"\b(?:can(?=not\b)|gim(?=me\b)|gon(?=na\b)|got(?=ta\b)|lem(?=me\b)|wan(?=na\b)|more(?='n\b)|d(?='ye\b))"
    r"|'t(?<=\s't)(?=(?:is|was)\b))"
)

# Spellings the CSV reader of the original job takes for missing.
CSV_MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
]

# Letters, marks and symbols whose ASCII spelling is not their base letter.
FOLD_MANY = {
    "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "Th",
    "¢": "C/", "£": "PS", "¤": "$?", "¥": "Y=", "§": "SS", "©": "(c)", "«": "<<", "®": "(r)", "°": "deg", "±": "+-",
    "»": ">>", "¼": "1/4", "½": "1/2", "¾": "3/4",
    "—": "--", "―": "--", "‖": "||", "„": ",,", "‡": "++", "‣": "*>", "‥": "..", "…": "...", "‰": "%0",
    "″": "''", "‴": "\'\'\'", "‼": "!!", "€": "EUR", "™": "(tm)",
}
FOLD_ONE = {
    "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "ħ": "h", "Ħ": "H", "ı": "i",
    "ł": "l", "Ł": "L", "ŧ": "t", "Ŧ": "T",
    "\u00a0": " ", "¡": "!", "¦": "|", "¨": '"', "ª": "a", "¬": "!", "¯": "-", "²": "2", "³": "3", "´": "'", "µ": "u",
    "¶": "P", "·": "*", "¸": ",", "¹": "1", "º": "o", "¿": "?", "×": "x", "÷": "/",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "‗": "_", "‘": "'", "’": "'", "‚": ",", "‛": "'", "“": '"', "”": '"', "‟": '"',
    "†": "+", "•": "*", "․": ".", "‧": ".", "\u202f": " ", "′": "'", "‹": "<", "›": ">", "⁄": "/", "\u205f": " ",
}


def _fold_table() -> tuple[str, str]:
    """One-to-one letters by rule: the base letter of every accented Latin letter; combining marks are dropped."""
    source, target = list(FOLD_ONE), list(FOLD_ONE.values())
    for code in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        letter = chr(code)
        base = "".join(c for c in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(c))
        if len(base) == 1 and base.isascii():
            source.append(letter)
            target.append(base)
    # Blanks of other widths; marks and invisible characters have no spelling and are dropped.
    source.extend(chr(code) for code in range(0x2000, 0x200B))
    target.extend(" " * (0x200B - 0x2000))
    source.extend(chr(code) for code in [0x00AD, *range(0x200B, 0x2010), *range(0x0300, 0x0370)])
    return "".join(source), "".join(target)


def _digit_table() -> tuple[str, str]:
    """Every decimal digit of Unicode and its ASCII digit."""
    digits = [
        chr(c) for c in range(0x80, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Nd" and c < 0x10000
    ]
    return "".join(digits), "".join(str(unicodedata.decimal(d)) for d in digits)


FOLD_FROM, FOLD_TO = _fold_table()
DIGITS_FROM, DIGITS_TO = _digit_table()
