"""Chat formatting: records of many layouts become canonical turns, and these a text with reversible escapes and a loss mask.

1. A layout is known by its fingerprint, the hash of its nested field paths. ``turns_of_frame`` reads it from the schema of a DataFrame,
   ``turns_of_json`` from each JSON record. ``LAYOUTS`` says for each which fields hold which role; a record with more fields than a layout has
   takes the richest layout that its paths contain.
2. ``format_turns`` writes ``<|start|>role<|text|>text<|end|>`` and a line feed for each turn. In role and text a backslash is doubled and
   ``<|`` becomes ``<\\|``, so no text can hold a marker. The loss mask has one span per turn: the text of an assistant's turn, else nothing.
3. ``read_back`` takes the turns and the text under the mask out of the formatted text again.

Built-in functions only. One shuffle, by conversation.

Cases: a null role or text is empty; equal turn numbers are ordered by role and text, null numbers come first; rows with a null
conversation id make one conversation; records of no known layout, broken JSON and null records have no turns; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

START, TEXT, END = "<|start|>", "<|text|>", "<|end|>\n"
LOSS_ROLE = "assistant"
#: Names that corpora use for the three roles. Fixed values.
ROLE_NAMES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "chatbot": "assistant"}
#: JSON records up to this many characters are fingerprinted with all nested paths, longer ones with those that some layout has.
VARIANT_CHARS = 4_000_000


@dataclass(frozen=True)
class Layout:
    """``turns`` maps fields to roles in order, or ``many`` names an array with the fields of role and text."""

    name: str
    turns: tuple[tuple[str, str], ...] = ()
    many: tuple[str, str, str] | None = None
    rows: tuple[str, str, str, str] | None = None

    @property
    def paths(self) -> frozenset[str]:
        if self.rows:
            return frozenset(self.rows)
        if self.many:
            return frozenset(f"{self.many[0]}[].{f}" for f in self.many[1:])
        return frozenset(f for f, _ in self.turns)


LAYOUTS = [
    Layout("turn_rows", rows=("conv_id", "turn", "role", "text")),
    Layout("messages", many=("messages", "role", "content")),
    Layout("message_texts", many=("messages", "role", "text")),
    Layout("conversations", many=("conversations", "from", "value")),
    Layout("dialog", many=("dialog", "speaker", "utterance")),
    Layout("system_prompt_response", (("system", "system"), ("prompt", "user"), ("response", "assistant"))),
    Layout("instruction_input_output", (("instruction", "user"), ("input", "user"), ("output", "assistant"))),
    Layout("instruction_output", (("instruction", "user"), ("output", "assistant"))),
    Layout("prompt_completion", (("prompt", "user"), ("completion", "assistant"))),
    Layout("prompt_response", (("prompt", "user"), ("response", "assistant"))),
    Layout("question_answer", (("question", "user"), ("answer", "assistant"))),
]


def schema_paths(kind: T.DataType, at: str = "") -> list[str]:
    """The nested field paths of a type, sorted; an array adds [] to its path."""
    if isinstance(kind, T.StructType):
        return sorted(p for f in kind.fields for p in schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name))
    if isinstance(kind, T.ArrayType):
        return schema_paths(kind.elementType, f"{at}[]")
    return [at]


def fingerprint(paths: Sequence[str] | frozenset[str]) -> int:
    """A stable number for a set of paths (FNV-1a over the sorted paths)."""
    number = 0xCBF29CE484222325
    for byte in "\n".join(sorted(paths)).encode():
        number = ((number ^ byte) * 0x100000001B3) % 2**64
    return number


_BY_FINGERPRINT = {fingerprint(layout.paths): layout for layout in LAYOUTS}


def choose_layout(paths: Sequence[str]) -> Layout | None:
    """The layout of that fingerprint, else the one with the most paths among those that ``paths`` contains."""
    exact = _BY_FINGERPRINT.get(fingerprint(paths))
    if exact:
        return exact
    held = [layout for layout in LAYOUTS if layout.paths <= set(paths)]
    return max(held, key=lambda layout: len(layout.paths)) if held else None


def _role(role: Column) -> Column:
    low = F.lower(role)
    known = F.lit(None).cast("string")
    for name, to in ROLE_NAMES.items():
        known = F.when(low == name, F.lit(to)).otherwise(known)
    return F.coalesce(known, role, F.lit(""))


def _turn(role: Column, text: Column) -> Column:
    return F.struct(_role(role).alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def _turns(layout: Layout, field) -> Column:
    """The turns of one record as an array; ``field`` gives the column of a top-level field."""
    if layout.many:
        name, role, text = layout.many
        return F.transform(field(name), lambda t: _turn(t[role].cast("string"), t[text]))
    parts = [F.when(field(f).isNotNull() & ((field(f) != "") | F.lit(r == LOSS_ROLE)), _turn(F.lit(r), field(f))) for f, r in layout.turns]
    return F.filter(F.array(*parts), lambda t: t.isNotNull())


def turns_of_frame(records: DataFrame, key: str = "conv_id") -> DataFrame:
    """(conv_id, nth, role, text) of a DataFrame whose layout its schema shows; no rows if the layout is unknown."""
    paths = schema_paths(records.schema)
    layout = choose_layout([p for p in paths if p != key or key in {"conv_id"} and {"turn", "role", "text"} <= set(paths)])
    if layout is None:
        return records.select(F.col(key).alias("conv_id"), F.lit(0).alias("nth"), F.lit("").alias("role"), F.lit("").alias("text")).limit(0)
    if layout.rows:
        conv, turn, role, text = layout.rows
        order = Window.partitionBy(conv).orderBy(F.col(turn).asc_nulls_first(), "role", "text")
        rows = records.select(conv, turn, _turn(F.col(role).cast("string"), F.col(text)).alias("t")).select(conv, turn, "t.role", "t.text")
        return rows.select(F.col(conv).alias("conv_id"), (F.row_number().over(order) - 1).alias("nth"), "role", "text")
    return records.select(F.col(key).alias("conv_id"), F.posexplode(_turns(layout, F.col)).alias("nth", "t")).select("conv_id", "nth", "t.role", "t.text")


def _nested(read: Column, name: str, inner: list[str]) -> Column:
    """The skeleton of an array of records by its fields that aren't null, or its name alone."""

    def held(f: str) -> Column:
        return F.when(F.exists(read[name], lambda t: t[f].isNotNull()), F.lit(f))

    fields = F.array_compact(F.array(*[held(f) for f in inner]))
    return F.when(F.size(fields) > 0, F.concat(F.lit(f"{name}: ARRAY<OBJECT<"), F.array_join(fields, ", "), F.lit(">>"))).otherwise(F.lit(name))


def json_skeleton(record: Column, read: Column, arrays: dict[str, list[str]]) -> Column:
    """The nested fields of a JSON record without their types and values, such as OBJECT<messages: ARRAY<OBJECT<content, role>>>."""
    kinds = F.schema_of_variant(F.try_parse_json(F.when(F.length(record) <= VARIANT_CHARS, record)))
    nested = F.regexp_replace(kinds, r": (?!OBJECT|ARRAY)[A-Z]+(\(\d+,\s*\d+\))?", "")
    keys = F.json_object_keys(F.when(F.length(record) > VARIANT_CHARS, record))

    def deep(k: Column) -> Column:
        out = k
        for name, inner in arrays.items():
            out = F.when(k == name, _nested(read, name, inner)).otherwise(out)
        return out

    return F.coalesce(nested, F.concat(F.lit("OBJECT<"), F.array_join(F.transform(F.array_sort(keys), deep), ", "), F.lit(">")))


def _exact(layout: Layout) -> str:
    """The skeleton of the records that have the fields of the layout alone."""
    if layout.many:
        return f"OBJECT<{layout.many[0]}: ARRAY<OBJECT<{', '.join(sorted(layout.many[1:]))}>>>"
    return f"OBJECT<{', '.join(sorted(layout.paths))}>"


def _shape(layout: Layout) -> str:
    """A pattern for the skeletons that contain the layout."""
    if layout.many:
        first, second = sorted(layout.many[1:])
        return rf"^OBJECT<(?:.*, )?{layout.many[0]}(: ARRAY<OBJECT<(?:[^<>]*, )?{first}[,>](?:.*[ ,])?{second}[,>]|[,>])"
    return "^OBJECT<" + "".join(rf"(?=(?:[^<>]*, )?{f}[,:>])" for f, _ in layout.turns)


def turns_of_json(records: DataFrame, key: str = "conv_id", column: str = "record") -> DataFrame:
    """(conv_id, nth, role, text, fingerprint, layout) of JSON records, each with a layout of its own."""
    layouts = sorted((x for x in LAYOUTS if not x.rows), key=lambda x: -len(x.paths))
    skeleton = F.col("_skeleton")
    chosen = F.lit(None).cast("string")
    for layout in reversed(layouts):
        chosen = F.when(skeleton.rlike(_shape(layout)), F.lit(layout.name)).otherwise(chosen)
    # The fingerprint decides; containing a layout is for records with more fields.
    for layout in layouts:
        chosen = F.when(F.xxhash64(skeleton) == F.xxhash64(F.lit(_exact(layout))), F.lit(layout.name)).otherwise(chosen)
    arrays: dict[str, list[str]] = {}
    fields: dict[str, str] = {f: "string" for x in layouts for f, _ in x.turns}
    for x in layouts:
        if x.many:
            inner = sorted({f for y in layouts if y.many and y.many[0] == x.many[0] for f in y.many[1:]})
            arrays[x.many[0]] = inner
            fields[x.many[0]] = "array<struct<" + ", ".join(f"`{f}`: string" for f in inner) + ">>"
    schema = ", ".join(f"`{f}` {kind}" for f, kind in fields.items())
    read = records.select(F.col(key).alias("conv_id"), F.from_json(F.col(column), schema).alias("r"), F.col(column).alias("_record"))
    read = read.withColumn("_skeleton", json_skeleton(F.col("_record"), F.col("r"), arrays))
    read = read.select("conv_id", F.xxhash64(skeleton).alias("fingerprint"), chosen.alias("layout"), "r")
    turns = F.lit(None).cast("array<struct<role:string,text:string>>")
    for layout in layouts:
        turns = F.when(F.col("layout") == layout.name, _turns(layout, lambda f: F.col("r")[f])).otherwise(turns)
    dealt = read.select("conv_id", "fingerprint", "layout", F.posexplode(turns).alias("nth", "t"))
    return dealt.select("conv_id", "nth", "t.role", "t.text", "fingerprint", "layout")


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): loss has a span (start, length) per turn, in code points of ``formatted``."""
    head = F.concat(F.lit(START), escape(F.col("role")), F.lit(TEXT))
    body = escape(F.col("text"))
    rows = turns.select("conv_id", "nth", F.concat(head, body, F.lit(END)).alias("line"), F.length(head).alias("head"),
                        F.when(F.col("role") == LOSS_ROLE, F.length(body)).otherwise(0).alias("length"))
    earlier = Window.partitionBy("conv_id").orderBy("nth", "line").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("line")).over(earlier), F.lit(0)) + F.col("head")
    placed = rows.withColumn("start", start.cast("int"))
    # One conversation is one training example, so its turns meet in one row.
    gathered = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("nth", "start", "length", "line"))).alias("t"))
    return gathered.select(
        "conv_id",
        F.array_join(F.transform("t", lambda t: t["line"]), "").alias("formatted"),
        F.transform("t", lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"))).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, loss_text) from the formatted text and its mask alone."""
    lines = F.filter(F.split("formatted", r"<\|end\|>\n"), lambda x: x != "")
    cut = formatted.select("conv_id", "formatted", "loss", F.transform(lines, lambda x: F.split(x, r"<\|text\|>")).alias("p"))
    turns = F.transform(
        "p", lambda p: F.struct(unescape(F.substr(p[0], F.lit(len(START) + 1))).alias("role"), unescape(p[1]).alias("text"))
    )
    # The spans follow the turns; a span covers the whole text of its turn or nothing.
    masked = F.zip_with("p", "loss", lambda p, s: F.when(s["length"] > 0, unescape(F.left(p[1], s["length"]))).otherwise(F.lit("")))
    return cut.select("conv_id", "formatted", turns.alias("turns"), F.array_join(masked, "").alias("loss_text"))
