"""Secret scans: wide patterns find candidates, a random forest trained on labelled findings removes the false ones.

Everything is built-in functions and ``pyspark.ml``. Features of a candidate: its length, how often it changes between lower case,
upper case, digits and signs, the share of its characters that dictionary words cover, repeated characters, what stands before it (name
and sign of an assignment), and what the path and the words around say.

The dictionary is counted over all documents; the forest is trained on ``Settings.findings`` labelled findings, which are made from fixed
rules and hashes (positives) and from words, numbers and digests (negatives).

Cases: a null or empty text has no candidates; a null path counts as empty; rows with null or repeated ids are each scanned; an empty
table gives no rows; other columns are ignored by ``find`` and handed on by ``redact``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.pipeline import Pipeline
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cuvee.llm.common import sized
from cuvee.runtime import materialize

_NAMED = r"(?:secret|token|passw|pwd|api[_-]?key|auth|credential|private|access[_-]?key|bearer)[a-z0-9_.-]{0,20}"
_ISSUED = r"(?:AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|glpat-|xox[abp]-|sk_live_|sk-|rk_live_|AIza|eyJ|SG\.|npm_|pypi-)"
#: The value of an assignment to a secret-like name, quoted (blanks allowed) or not, from 6 characters; what begins like an issuer's key; runs of at
#: least 12 characters of the kinds that keys are made of, with a digit; other quoted values of an assignment from 8. A run leaves the value of a
#: secret-like name to its own pattern if that goes on with other signs.
CANDIDATE = (
    r"(?<=[=:>] {0,2}[\"'`])(?<=(?i:" + _NAMED + r")[\"']? {0,2}(?:=>|[=:]) {0,2}[\"'`])[^\n\"'`]{6,200}(?=[\"'`])"
    r"|(?<=[=:>] {0,2})(?=[^\s\"'`]{6})(?<=(?i:" + _NAMED + r")[\"']? {0,2}(?:=>|[=:]) {0,2})[^\s\"'`]{5,}[^\s\"'`,;)\]}]"
    r"|(?<![A-Za-z0-9])" + _ISSUED + r"[A-Za-z0-9+/_=.~-]{7,}[A-Za-z0-9+/_=~-]"
    r"|(?<![A-Za-z0-9+/_=.~-])(?=[A-Za-z+/_=.~-]*+[0-9])(?!(?i:[a-z0-9_.-]{0,20}" + _NAMED + r")=[A-Za-z0-9+/_=.~-]*+[^\sA-Za-z0-9+/_=.~\"'`,;)\]}-])"
    r"[A-Za-z0-9+/_=.~-]{11,}[A-Za-z0-9+/_=~-]"
    r"|(?<=[=:] {0,2}[\"'`])[^\s\"'`]{8,}"
)
#: Characters looked at on either side.
AROUND = 48
SECRET_NAMES = r"(?i)(secret|token|passw|passwd|pwd|api[_-]?key|apikey|auth|credential|private|access[_-]?key|bearer)"
DECOY_NAMES = r"(?i)(sha|md5|digest|checksum|commit|uuid|guid|etag|example|sample|dummy|placeholder|public|integrity|version)"
SOURCE_PATHS = r"(?i)(\.env|\.ya?ml|\.json|\.cfg|\.ini|\.conf|\.py|\.js|config|secret|deploy|src)"
#: Beginnings that issuers give their keys. Fixed values.
KNOWN_PREFIX = r"^(AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|glpat-|xox[abp]-|sk_live_|sk-|rk_live_|AIza|eyJ|SG\.|npm_|pypi-)"


@dataclass(frozen=True)
class Settings:
    #: Labelled findings that the forest is trained on.
    findings: int = 4000
    trees: int = 30
    depth: int = 8
    #: Words of the dictionary.
    dictionary: int = 600
    threshold: float = 0.5
    mask: str = "[SECRET]"
    seed: int = 7


FEATURES = [
    "f_length", "f_changes", "f_digits", "f_upper", "f_signs", "f_covered", "f_distinct", "f_hex", "f_digits_only", "f_letters_only",
    "f_prefix", "f_assigned", "f_quoted", "f_secret_near", "f_decoy_near", "f_path", "f_dots",
]


def dictionary(docs: DataFrame, size: int) -> list[str]:
    """The most frequent lower-case words of 4 to 12 letters over all documents; ``size`` of them at most."""
    words = docs.select(F.explode(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+")).alias("w"))
    counts = words.where(F.length("w").between(4, 12)).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    return sorted((r["w"] for r in counts.orderBy(F.desc("n"), "w").limit(size).collect()), key=lambda w: (-len(w), w))


def features(rows: DataFrame, words: list[str]) -> DataFrame:
    """Adds FEATURES to rows with value, before, after and path."""
    value, before, after, path = F.col("value"), F.col("before"), F.col("after"), F.coalesce(F.col("path"), F.lit(""))
    n = F.greatest(F.length(value), F.lit(1))
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0"), "[^aA0]", "_")
    merged = F.regexp_replace(kinds, r"(.)\1+", "$1")
    covered = F.length(value) - F.length(F.regexp_replace(F.lower(value), "|".join(words), "")) if words else F.lit(0)
    name = F.regexp_extract(before, r"([A-Za-z_][A-Za-z0-9_.-]*)[\"']?\s*(?:=|:|=>)\s*[\"'`]?$", 1)

    def share(pattern: str) -> Column:
        return F.regexp_count(value, F.lit(pattern)) / n

    def flag(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False)).cast("double")

    assigned = name != ""
    made = {
        "f_length": F.least(n, F.lit(200)).cast("double"),
        "f_changes": (F.length(merged) - 1) / n,
        "f_digits": share("[0-9]"),
        "f_upper": share("[A-Z]"),
        "f_signs": share("[^A-Za-z0-9]"),
        "f_covered": covered / n,
        "f_distinct": F.size(F.array_distinct(F.split(value, ""))) / n,
        "f_hex": flag(value.rlike("^([0-9a-f]+|[0-9A-F]+)$") & value.rlike("[0-9]") & value.rlike("[A-Fa-f]")),
        "f_digits_only": flag(value.rlike(r"^[0-9.+=-]+$")),
        "f_letters_only": flag(value.rlike(r"^[A-Za-z.=-]+$")),
        "f_prefix": flag(value.rlike(KNOWN_PREFIX)),
        "f_assigned": flag(assigned),
        "f_quoted": flag(before.rlike("[\"'`]$")),
        "f_secret_near": flag(F.when(assigned, name.rlike(SECRET_NAMES)).otherwise(before.rlike(SECRET_NAMES))),
        "f_decoy_near": flag(F.when(assigned, name.rlike(DECOY_NAMES)).otherwise(before.rlike(DECOY_NAMES) | after.rlike(DECOY_NAMES))),
        "f_path": flag(path.rlike(SOURCE_PATHS)),
        "f_dots": share("[.]"),
    }
    return rows.withColumns({k: v.cast("double") for k, v in made.items()})


def labelled_findings(spark: SparkSession, words: list[str], n: int) -> DataFrame:
    """(value, before, after, path, label): ``n`` findings by rule, the same for the same arguments."""
    known = F.array(*[F.lit(w) for w in (words or ["word", "other", "name"])])
    i = F.col("id")

    def bits(salt: int) -> Column:
        return F.sha2(F.concat(i.cast("string"), F.lit(f"/{salt}")), 256)

    def pick(options: list[str], salt: int) -> Column:
        return F.element_at(F.array(*[F.lit(o) for o in options]), (F.pmod(F.xxhash64(i, F.lit(salt)), F.lit(len(options))) + 1).cast("int"))

    def word(salt: int) -> Column:
        return F.element_at(known, (F.pmod(F.xxhash64(i, F.lit(salt)), F.size(known)) + 1).cast("int"))

    size = (F.lit(20) + F.pmod(F.xxhash64(i, F.lit(1)), F.lit(21))).cast("int")
    base = F.regexp_replace(F.base64(F.unhex(bits(2))), "=", "")
    hexed = F.substr(bits(3), F.lit(1), F.greatest(size, F.lit(24)))
    mixed = F.substr(base, F.lit(1), size)
    prefixed = F.concat(pick(["AKIA", "ghp_", "glpat-", "xoxb-", "sk_live_", "sk-", "AIza", "npm_"], 4), F.regexp_replace(mixed, "[+/]", "x"))
    password = F.concat(F.initcap(F.substr(bits(5), F.lit(1), F.lit(5))), pick(["_", "-", ".", "~"], 6), F.upper(F.substr(bits(6), F.lit(9), F.lit(4))), F.substr(base, F.lit(3), F.lit(7)))
    digits = F.substr(F.translate(bits(7), "abcdef", "012345"), F.lit(1), F.lit(16))
    uuid = F.concat_ws("-", *[F.substr(bits(8), F.lit(a), F.lit(b)) for a, b in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    prose = F.concat(word(9), word(10), word(11), word(12))
    snake = F.concat_ws("_", word(9), word(10), word(11), word(12))
    dotted = F.concat_ws(".", word(9), word(10), word(11), F.lit("example"), F.lit("com"))
    held = F.concat(pick(["your_", "my-", "example_", "test_", "xxxx"], 13), pick(["api_key_here", "secret-goes-here", "token_value_1234", "xxxxxxxxxxxx"], 14))
    address = F.concat_ws(".", *[F.conv(F.substr(bits(8), F.lit(a), F.lit(2)), 16, 10) for a in (1, 3, 5, 7)])

    secret_name = pick(["token", "api_key", "secret", "password", "access_key", "auth_token", "client_secret", "API_TOKEN"], 15)
    plain_name = pick(["commit", "sha256", "checksum", "etag", "uuid", "digest", "integrity", "name", "title", "id", "color"], 16)
    sign = pick([' = "', '="', ": ", ": '", "=", " = '"], 17)
    around = F.concat_ws(" ", word(18), word(19), F.lit(""))
    of_secret = F.concat(around, secret_name, sign)
    of_plain = F.concat(around, plain_name, sign)
    signed = F.concat(F.initcap(F.substr(bits(24), F.lit(1), F.lit(4))), pick(["@", "!", "#", "$", "%", "&", "*"], 25), F.substr(base, F.lit(5), F.lit(5)), pick(["!", "#", "?", "@"], 26), F.substr(digits, F.lit(1), F.lit(4)))
    signed_word = F.concat(F.initcap(word(27)), pick(["@", "!", "#", "$", "%", "&", "*"], 25), F.substr(bits(28), F.lit(1), F.lit(4)), pick(["", "!", "#", "Pass2024"], 26))
    short = F.concat(word(29), F.substr(digits, F.lit(3), F.lit(1)), F.substr(bits(30), F.lit(1), F.lit(2)))
    capitals = F.concat(pick(["AKIA", "ASIA"], 31), F.substr(F.upper(F.translate(bits(32), "0123456789", "GHJKLMNPQR")), F.lit(1), F.lit(16)))
    blanks = F.concat_ws(" ", F.substr(base, F.lit(1), F.lit(5)), F.concat(F.substr(bits(33), F.lit(1), F.lit(4)), pick(["&", "!", "#"], 34)), F.substr(base, F.lit(9), F.lit(4)))
    bare = pick(["=", ": ", " = "], 35)
    phrase = F.concat_ws(" ", word(36), word(37), word(38))
    given = F.concat(pick(["os.environ.", "config.", "$", "get_", "settings."], 39), secret_name, pick(["", "()", "_value", "[0]"], 40))
    of_bare = F.concat(around, secret_name, bare)
    of_quoted = F.concat(around, secret_name, pick([' = "', '="', ": '", " = '"], 41))
    kind = F.pmod(i, F.lit(24))
    rule = [  # value, what stands before, label
        (hexed, of_secret, 1), (mixed, of_secret, 1), (prefixed, of_secret, 1), (password, of_secret, 1),
        (prefixed, around, 1), (hexed, of_secret, 1), (mixed, of_secret, 1),
        (hexed, of_plain, 0), (uuid, of_plain, 0), (digits, around, 0), (prose, around, 0), (snake, of_plain, 0),
        (dotted, around, 0), (held, of_secret, 0), (address, around, 0), (prose, of_secret, 0),
        (signed, of_secret, 1), (signed_word, of_bare, 1), (short, of_bare, 1), (capitals, F.when(F.pmod(F.xxhash64(i), F.lit(2)) == 0, around).otherwise(of_bare), 1),
        (blanks, of_quoted, 1), (phrase, of_quoted, 0), (F.concat(word(42), pick(["", "", ".", "ing"], 43)), of_bare, 0), (given, of_bare, 0),
    ]
    def choose(at: int) -> Column:
        made = F.lit(None)
        for k, r in enumerate(rule):
            made = F.when(kind == k, F.lit(r[at]) if isinstance(r[at], int) else r[at]).otherwise(made)
        return made

    return spark.range(0, n, 1, 4).select(
        choose(0).alias("value"),
        choose(1).alias("before"),
        F.concat(pick(['" ', "' ", " ", "\n"], 20), word(21), F.lit(" "), word(22)).alias("after"),
        pick(["src3", "app/config.yaml", "notes.txt", "docs/readme.md", ".env", "src/main.py", "blog"], 23).alias("path"),
        choose(2).cast("double").alias("label"),
    )


def train(spark: SparkSession, words: list[str], settings: Settings = Settings()) -> PipelineModel:
    # Stored first: the features name each value many times, and the rules that make it are long.
    findings = materialize(labelled_findings(spark, words, settings.findings), "labelled-findings")
    rows = features(findings, words)
    # One task in a fixed order, so that the forest is the same on any cluster; ``findings`` bounds it.
    rows = rows.repartition(1).sortWithinPartitions("value", "before", "after")
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=settings.trees, maxDepth=settings.depth, seed=settings.seed
    )
    return Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), forest]).fit(rows)


def _row_key(key: str, text: str) -> list[Column]:
    """Tells rows apart whose id is null or repeated; equal rows have equal findings."""
    no_id = F.col(key).isNull()
    return [F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_id"), no_id.alias("_no_id"), F.xxhash64(text).alias("_hash")]


_KEYS = ["_id", "_no_id", "_hash"]


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """(row key, key, nth, gap, value, before, after, path) of every candidate; gap is the length since the one before it."""
    rows = docs.where(F.col(text).rlike(CANDIDATE)).select(
        *_row_key(key, text), F.col(key).alias("key"), F.col(path).cast("string").alias("path"),
        F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("c"), F.split(text, CANDIDATE).alias("g"),
    ).dropDuplicates(_KEYS)
    dealt = rows.select(
        *_KEYS, "key", "path", F.posexplode(F.arrays_zip(
            F.col("c"), F.slice("g", F.lit(1), F.size("c")).alias("gap"), F.slice("g", F.lit(2), F.size("c")).alias("next"),
            F.concat(F.array(F.lit("")), F.slice("c", F.lit(1), F.size("c") - 1)).alias("last"),
        )).alias("nth", "x"),
    )
    return dealt.select(
        *_KEYS, "key", "nth", F.length("x.gap").alias("gap"), F.col("x.c").alias("value"),
        F.right(F.concat("x.last", "x.gap"), F.lit(AROUND)).alias("before"), F.left("x.next", F.lit(AROUND)).alias("after"), "path",
    )


def find(docs: DataFrame, model: PipelineModel, words: list[str], settings: Settings = Settings(), key: str = "doc_id",
         text: str = "text", path: str = "source") -> DataFrame:
    """(row key, key, nth, start, length, value, probability) of the candidates that the forest takes for secrets.

    start is the 0-based code point. All candidates of a row are needed to place one, and a row has as many as its text is long.
    """
    found = candidates(docs, key, text, path)
    earlier = Window.partitionBy(*_KEYS).orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    placed = found.withColumn("length", F.length("value")).withColumn(
        "start", F.coalesce(F.sum(F.col("gap") + F.col("length")).over(earlier), F.lit(0)) + F.col("gap")
    )
    judged = model.transform(features(placed, words)).withColumn("probability", vector_to_array("probability")[1])
    return judged.where(F.col("probability") >= settings.threshold).select(*_KEYS, "key", "nth", "start", "length", "value", "probability")


def redact(docs: DataFrame, found: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the stored findings masked in the text; all other rows and columns as they are."""
    marked = found.groupBy(*_KEYS).agg(F.collect_set("nth").alias("_nth"))
    # The row as one value, so that its columns can have any names.
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), *_row_key(key, text))
    joined = keyed.join(sized(materialize(marked, "marked")), _KEYS, "left")
    whole = F.col("_row").getField(text)
    values, gaps = F.regexp_extract_all(whole, F.lit(CANDIDATE), F.lit(0)), F.split(whole, CANDIDATE)
    parts = F.transform(
        F.arrays_zip(values.alias("c"), F.slice(gaps, F.lit(1), F.size(values)).alias("g")),
        lambda x, i: F.concat(x["g"], F.when(F.array_contains("_nth", i), F.lit(settings.mask)).otherwise(x["c"])),
    )
    masked = F.when(F.col("_nth").isNotNull(), F.concat(F.array_join(parts, ""), F.element_at(gaps, -1))).otherwise(whole)
    return joined.select(*[(masked if c == text else F.col("_row").getField(c)).alias(c) for c in docs.columns])
