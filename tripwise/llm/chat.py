"""Chat formatting by schema fingerprints, with DataFrame functions only.

Records come in many layouts (prompt / completion, instruction / input / output,
message lists, one row a turn).  The nested field paths a record has, out of those
the mappings know, are hashed to a fingerprint; the fingerprint selects the
declarative mapping that makes canonical turns, array<struct<role, text>>.  The turns
are then put into a template whose control strings are escaped inside texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURNS = "array<struct<role:string,text:string>>"
_ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
#: Marks of the template: what opens a turn's header, and what closes its text.
OPEN, CLOSE = "### ", "\n</turn>\n"


@dataclass(frozen=True)
class Layout:
    """A mapping: the field paths that identify the layout, and how its turns come from a JSON variant."""

    name: str
    paths: tuple[str, ...]
    turns: Callable[[Column], Column]


def _text(v: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(v, path, "string"), F.lit(""))


def _turn(role: str, text: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), text.alias("text"))


def _role(role: Column) -> Column:
    known = F.create_map(*[F.lit(x) for kv in _ROLE_NAMES.items() for x in kv])
    return F.coalesce(F.element_at(known, F.coalesce(role, F.lit(""))), role, F.lit(""))


def _listed(path: str, role: str, text: str) -> Callable[[Column], Column]:
    def turns(v: Column) -> Column:
        items = F.try_variant_get(v, path, f"array<struct<{role}:string,{text}:string>>")
        return F.transform(items, lambda m: F.struct(_role(m[role]).alias("role"),
                                                     F.coalesce(m[text], F.lit("")).alias("text")))
    return turns


def _instructed(v: Column) -> Column:
    extra = _text(v, "$.input")
    asked = F.concat(_text(v, "$.instruction"), F.when(extra != "", F.concat(F.lit("\n"), extra)).otherwise(""))
    return F.array(_turn("user", asked), _turn("assistant", _text(v, "$.output")))


def _pair(ask: str, answer: str) -> Callable[[Column], Column]:
    return lambda v: F.array(_turn("user", _text(v, ask)), _turn("assistant", _text(v, answer)))


def _with_system(turns: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda v: F.concat(F.array(_turn("system", _text(v, "$.system"))), turns(v))


_MESSAGES, _SHARED = _listed("$.messages", "role", "content"), _listed("$.conversations", "from", "value")
_PROMPT, _QA = _pair("$.prompt", "$.completion"), _pair("$.question", "$.answer")
LAYOUTS = (
    Layout("messages", ("messages[].content", "messages[].role"), _MESSAGES),
    Layout("messages_system", ("messages[].content", "messages[].role", "system"), _with_system(_MESSAGES)),
    Layout("shared", ("conversations[].from", "conversations[].value"), _SHARED),
    Layout("shared_system", ("conversations[].from", "conversations[].value", "system"), _with_system(_SHARED)),
    Layout("prompt", ("completion", "prompt"), _PROMPT),
    Layout("prompt_system", ("completion", "prompt", "system"), _with_system(_PROMPT)),
    Layout("prompt_response", ("prompt", "response"), _pair("$.prompt", "$.response")),
    Layout("instruction", ("instruction", "output"), _instructed),
    Layout("instruction_input", ("input", "instruction", "output"), _instructed),
    Layout("question", ("answer", "question"), _QA),
)
#: The layout of a table with a row for each turn.
TURN_ROWS = ("conv_id", "role", "text", "turn")


def fingerprint(paths: Column) -> Column:
    """Hash of an array of field paths, whatever their order."""
    return F.xxhash64(F.array_join(F.array_sort(F.array_distinct(paths)), "\n"))


def known_paths(layouts: tuple[Layout, ...] = LAYOUTS) -> list[str]:
    return sorted({p for x in layouts for p in x.paths})


def record_paths(v: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """Those of the mappings' paths that a JSON variant has; other fields do not count.

    A path into a list counts if any of the list's elements has it.
    """
    def there(path: str) -> Column:
        outer, _, inner = path.partition("[].")
        if not inner:
            return F.when(F.try_variant_get(v, f"$.{path}", "variant").isNotNull(), F.lit(path))
        items = F.try_variant_get(v, f"$.{outer}", "array<variant>")
        return F.when(F.exists(items, lambda x: F.try_variant_get(x, f"$.{inner}", "variant").isNotNull()), F.lit(path))

    return F.filter(F.array(*[there(p) for p in known_paths(layouts)]), lambda p: p.isNotNull())


def schema_paths(schema: T.StructType, prefix: str = "") -> list[str]:
    """Nested field paths of a table ("messages[].role")."""
    out = []
    for f in schema.fields:
        kind, path = f.dataType, prefix + f.name
        while isinstance(kind, T.ArrayType):
            kind, path = kind.elementType, path + "[]"
        out += schema_paths(kind, path + ".") if isinstance(kind, T.StructType) else [path]
    return out


def schema_fingerprint(paths: Iterable[str]) -> int:
    """``fingerprint`` of paths that are known before any row is read."""
    h = xxhash.xxh64_intdigest("\n".join(sorted(set(paths))), 42)
    return h - (1 << 64) if h >> 63 else h


def _turn_rows(df: DataFrame) -> DataFrame:
    """(conv_id, turns) of a table with a row for each turn."""
    row = F.struct(F.col("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                   F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    turns = F.transform(F.array_sort(F.collect_list(row)), lambda t: F.struct(t["role"], t["text"]))
    return df.groupBy("conv_id").agg(turns.cast(TURNS).alias("turns"))


#: Mappings of whole tables by the fingerprint of their schema's paths: name and how the turns come from the rows.
TABLE_LAYOUTS = {schema_fingerprint(TURN_ROWS): ("turn_rows", _turn_rows)}


def canonical_records(df: DataFrame, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Adds fingerprint, layout and turns to rows whose column ``record`` holds a JSON text.

    Rows of no known fingerprint (broken JSON and null too) are kept with null layout
    and turns.  Null texts are empty, null roles empty, ``human`` is ``user`` and
    ``gpt``, ``bot`` and ``model`` are ``assistant``.
    """
    v = F.col("_variant")
    rows = df.withColumn("_variant", F.try_parse_json(F.col(record).cast("string")))
    rows = rows.withColumn("fingerprint", F.when(v.isNotNull(), fingerprint(record_paths(v, layouts))))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for x in layouts:
        chosen = F.col("fingerprint") == fingerprint(F.array(*map(F.lit, x.paths)))
        name = F.when(chosen, F.lit(x.name)).otherwise(name)
        turns = F.when(chosen, x.turns(v).cast(TURNS)).otherwise(turns)
    return rows.withColumns({"layout": name, "turns": turns}).drop("_variant")


def canonical_table(df: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(conv_id, fingerprint, layout, turns) of a typed table, by the fingerprint of its schema's field paths.

    A table with conv_id, turn, role and text has a row for each turn: a
    conversation's rows are ordered by (turn, role, text), nulls first, and repeated
    rows are repeated turns; rows of null conv_id are one conversation.  Any other
    table has a record a row (conv_id null unless it has that column); its rows go
    through ``canonical_records`` as JSON.  Further columns play no part.
    """
    paths = schema_paths(df.schema)
    own = schema_fingerprint(p for p in paths if p in TURN_ROWS)  # other columns do not count
    if own in TABLE_LAYOUTS:
        name, mapping = TABLE_LAYOUTS[own]
        return mapping(df).select("conv_id", F.lit(own).alias("fingerprint"), F.lit(name).alias("layout"), "turns")
    known = {p.split("[")[0] for p in known_paths(layouts)}
    body = F.to_json(F.struct(*[F.col(c) for c in df.columns if c in known]), {"ignoreNullFields": "true"})
    ident = F.col("conv_id") if "conv_id" in paths else F.lit(None).cast("long")
    return (canonical_records(df.select(ident.alias("conv_id"), body.alias("record")), "record", layouts)
            .select("conv_id", "fingerprint", "layout", "turns"))


def escaped(text: Column) -> Column:
    """Text whose backslashes, header marks and end marks have a backslash before them."""
    return F.regexp_replace(text, r"(\\|###|</turn>)", r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _header(role: Column) -> Column:
    return F.concat(F.lit(OPEN), F.url_encode(role), F.lit("\n"))


def format_turns(df: DataFrame, turns: str = "turns") -> DataFrame:
    """Adds formatted (the template's text) and loss_spans (start and length in code points).

    A turn is ``### role`` (percent-encoded), its escaped text and ``</turn>``, each on
    lines of its own.  loss_spans cover the escaped texts of assistant turns, in order.
    Null turns give a null text.
    """
    parts = F.transform(F.col(turns), lambda t: F.struct(
        t["role"].alias("role"), _header(t["role"]).alias("head"), escaped(t["text"]).alias("body")))
    sizes = F.transform(F.col("_parts"), lambda p: F.struct(
        (p["role"] == "assistant").alias("loss"), F.char_length(p["head"]).cast("long").alias("head"),
        F.char_length(p["body"]).cast("long").alias("body")))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,length:long>>")
                    .alias("spans"))
    spans = F.aggregate(F.col("_sizes"), zero, lambda acc, p: F.struct(
        (acc["at"] + p["head"] + p["body"] + len(CLOSE)).alias("at"),
        F.when(p["loss"], F.concat(acc["spans"], F.array(F.struct(
            (acc["at"] + p["head"]).alias("start"), p["body"].alias("length"))))).otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    whole = F.array_join(F.transform(F.col("_parts"), lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "")
    return (df.withColumn("_parts", parts).withColumn("_sizes", sizes)
            .withColumns({"formatted": whole, "loss_spans": spans}).drop("_parts", "_sizes"))


def parsed_turns(formatted: Column) -> Column:
    """Turns of a formatted text; the end mark cannot occur in an escaped text."""
    pieces = F.filter(F.split(formatted, CLOSE.replace("/", "\\/"), -1), lambda p: p != "")

    def turn(p: Column) -> Column:
        head = F.substring_index(p, "\n", 1)
        return F.struct(F.url_decode(F.regexp_replace(head, "^### ", ""))
                        .alias("role"),
                        unescaped(F.regexp_replace(p, r"(?s)\A[^\n]*\n", "")).alias("text"))

    return F.transform(pieces, turn)


def loss_text(formatted: str = "formatted", spans: str = "loss_spans") -> Column:
    """All text under the loss mask, unescaped, in order, with nothing between."""
    return F.array_join(F.transform(F.col(spans), lambda s: unescaped(F.substring(
        F.col(formatted), (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
