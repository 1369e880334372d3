"""Chat formatting by schema fingerprints.

Records of any layout come as JSON text.  The nested field paths that a record
shares with the declared layouts are hashed; the hash selects a declarative
mapping, which turns the record into canonical turns.  Turns are rendered in a
template whose control strings cannot occur inside a text, with a loss mask.
Everything is a DataFrame expression.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsift.llm._store import free_name

START, END = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"
#: Characters of a string that the JSON parser takes.
MAX_JSON_STRING = 20_000_000


@dataclass(frozen=True)
class Layout:
    """How records of one layout become turns.

    ``fields`` are (path, role) pairs, in the order of the turns, for layouts
    with one field per turn.  ``turns`` is the path of a list, whose elements have
    the ``role`` and ``text`` fields; an empty path means the record is one turn
    itself.  ``optional`` top-level fields may be missing.  ``parts`` says that
    the text is a list of parts with a text each.
    """

    name: str
    fields: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()
    turns: str | None = None
    role: str = ""
    text: str = ""
    parts: bool = False


LAYOUTS = (
    Layout("turn", turns="", role="role", text="text"),
    Layout("turn_content", turns="", role="role", text="content"),
    Layout("messages", (("system", "system"),), ("system",), "messages", "role", "content"),
    Layout("message_parts", (("system", "system"),), ("system",), "messages", "role", "content", True),
    Layout("conversations", (("system", "system"),), ("system",), "conversations", "from", "value"),
    Layout(
        "instruction",
        (("system", "system"), ("instruction", "user"), ("input", "user"), ("output", "assistant")),
        ("system", "input"),
    ),
    Layout(
        "instruction_response",
        (("system", "system"), ("instruction", "user"), ("context", "user"), ("response", "assistant")),
        ("system", "context"),
    ),
    Layout("completion", (("system", "system"), ("prompt", "user"), ("completion", "assistant")), ("system",)),
    Layout("response", (("system", "system"), ("prompt", "user"), ("response", "assistant")), ("system",)),
    Layout("question", (("system", "system"), ("question", "user"), ("answer", "assistant")), ("system",)),
    Layout("preference", (("system", "system"), ("prompt", "user"), ("chosen", "assistant")), ("system",)),
)

#: Roles of list layouts by the names used for them.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def _inner_names(layouts: tuple[Layout, ...]) -> list[str]:
    names = {n for one in layouts if one.turns for n in (one.role, one.text)}
    return sorted(names | {"text"} if any(one.parts for one in layouts) else names)


def _top_names(layouts: tuple[Layout, ...]) -> list[str]:
    names = {path for one in layouts for path, _ in one.fields}
    names |= {one.turns for one in layouts if one.turns}
    return sorted(names | {n for one in layouts if one.turns == "" for n in (one.role, one.text)})


def _skeleton(value: Column, inner: list[str]) -> Column:
    """Nested field paths of a value: leaf types and unknown inner fields removed."""
    shape = F.regexp_replace(F.schema_of_variant(value), r"\b[A-Z][A-Z0-9_]*(\([0-9, ]*\))?(?![\w<`:])", "_")
    known = "|".join(map(re.escape, inner))
    for _ in range(3):
        shape = F.regexp_replace(shape, rf"(?<=[<, ])(?!(?:{known}): )(?:`[^`]*`|\w+): _(?=[,>])", "")
        shape = F.regexp_replace(shape, r"(?:, )+(?=[,>])|(?<=<)(?:, )+", "")
        shape = F.regexp_replace(shape, r"(OBJECT|ARRAY)<_?>", "_")
    return shape


def _shapes(layout: Layout) -> list[dict[str, str]]:
    """Every set of top-level paths that the layout accepts, with their skeletons."""
    shapes: list[dict[str, str]] = [{}]
    if layout.turns == "":
        return [{layout.role: "_", layout.text: "_"}]
    for path, _ in layout.fields:
        with_it = [shape | {path: "_"} for shape in shapes]
        shapes = shapes + with_it if path in layout.optional else with_it
    if layout.turns:
        body = "ARRAY<OBJECT<text: _>>" if layout.parts else "_"
        pairs = sorted([(layout.role, "_"), (layout.text, body)])
        inner = ", ".join(f"{name}: {kind}" for name, kind in pairs)
        listed = {layout.turns: f"ARRAY<OBJECT<{inner}>>"}
        shapes = [shape | listed for shape in shapes]
    return shapes


def _paths(shape: dict[str, str]) -> str:
    return ";".join(f"{name}={shape[name]}" for name in sorted(shape))


def fingerprint(record: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """Hash of the nested field paths that a parsed record shares with the layouts.

    Fields that no layout names are left out, so added metadata changes nothing.
    """
    inner = _inner_names(layouts)
    fields = [
        F.when(
            F.try_variant_get(record, f"$.{name}", "variant").isNotNull(),
            F.concat(F.lit(f"{name}="), _skeleton(F.try_variant_get(record, f"$.{name}", "variant"), inner)),
        )
        for name in _top_names(layouts)
    ]
    return F.xxhash64(F.concat_ws(";", *fields))


def layout_prints(df: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """Map literal from fingerprint to layout name; its size is that of the declarations."""
    pairs: dict[str, str] = {}
    for layout in layouts:
        for shape in _shapes(layout):
            pairs.setdefault(_paths(shape), layout.name)
    return F.create_map(*[x for paths, name in pairs.items() for x in (F.xxhash64(F.lit(paths)), F.lit(name))])


def _turn(role: Column, text: Column) -> Column:
    return F.struct(
        F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text")
    )


def _named_role(role: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in ROLE_NAMES.items() for x in pair])
    return F.coalesce(names[role], role)


def _mapped(layout: Layout, record: Column, beside: dict[str, Column]) -> Column:
    """The turns of a record of this layout."""

    def text_at(path: str) -> Column:
        return F.try_variant_get(record, f"$.{path}", "string")

    if layout.turns == "":
        return F.array(_turn(*[beside.get(path, text_at(path)) for path in (layout.role, layout.text)]))
    given = F.array(
        *[
            F.when(F.try_variant_get(record, f"$.{path}", "variant").isNotNull() | F.lit(path not in layout.optional), _turn(F.lit(role), text_at(path)))
            for path, role in layout.fields
        ]
    )
    given = F.filter(given, lambda x: x.isNotNull())
    if not layout.turns:
        return given
    body = f"array<struct<text: string>>" if layout.parts else "string"
    kind = f"array<struct<`{layout.role}`: string, `{layout.text}`: {body}>>"
    listed = F.try_variant_get(record, f"$.{layout.turns}", kind)

    def turn(x: Column) -> Column:
        text = x[layout.text]
        if layout.parts:
            text = F.array_join(F.transform(text, lambda p: p["text"]), "")
        return _turn(_named_role(x[layout.role]), text)

    return F.concat(given, F.coalesce(F.transform(listed, turn), F.array().cast("array<struct<role: string, text: string>>")))


def canonical_turns(
    records: DataFrame,
    record: str = "record",
    layouts: tuple[Layout, ...] = LAYOUTS,
    beside: dict[str, str] | None = None,
) -> DataFrame:
    """Add ``layout_print``, ``layout`` and ``turns`` to records given as JSON text.

    Null or broken JSON and records of no declared layout keep their row, with a
    null layout and no turns.  Null roles and texts become empty texts.  The parser
    takes strings of up to ``MAX_JSON_STRING`` characters; a record that is longer and
    cannot be parsed is an error, not a broken one.  Longer texts of records that are one turn
    go beside it: ``beside`` names the column that holds a field's text in full, and the
    record has a short piece of it.
    """
    named, full = free_name(records, "parsed"), {path: records[c] for path, c in (beside or {}).items()}
    value = F.col(named)
    parsed = records.withColumn(named, F.try_parse_json(records[record]))
    printed = parsed.withColumn("layout_print", F.when(value.isNotNull(), fingerprint(value, layouts)))
    too_long = value.isNull() & (F.length(records[record]) > MAX_JSON_STRING)
    failed = F.raise_error(F.lit(f"a record with a text of over {MAX_JSON_STRING} characters: give it beside")).cast("string")
    known = printed.withColumn(
        "layout", F.when(too_long, failed).otherwise(layout_prints(records, layouts)[F.col("layout_print")])
    )
    turns = reduce(
        lambda rest, layout: F.when(F.col("layout") == layout.name, _mapped(layout, value, full)).otherwise(rest),
        layouts,
        F.array().cast("array<struct<role: string, text: string>>"),
    )
    return known.withColumn("turns", turns).drop(named)


def one_row_per_turn(records: DataFrame, *keep: str) -> DataFrame:
    """Kept columns, ``place`` in the record, ``role`` and ``text``.

    A record without turns is one turn of empty role and text, so no row goes.  The outer
    form is used since the optimizer would otherwise test the turns in a filter of its own
    and compute the mapping several times.
    """
    rows = records.select(*keep, F.posexplode_outer("turns").alias("place", "one"))
    empty = F.lit("")
    return rows.select(
        *keep,
        F.coalesce("place", F.lit(0)).alias("place"),
        F.coalesce("one.role", empty).alias("role"),
        F.coalesce("one.text", empty).alias("text"),
    )


def escaped(text: Column) -> Column:
    """A text without ``<|``: one backslash more inside every ``<``, backslashes, ``|``."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _escaped_role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _unescaped_role(role: Column) -> Column:
    marked = F.replace(unescaped(role), F.lit("\\\\"), F.lit("\\\u0000"))
    return F.replace(F.replace(marked, F.lit("\\n"), F.lit("\n")), F.lit("\\\u0000"), F.lit("\\"))


def rendered(role: Column, text: Column) -> Column:
    """One turn in the template."""
    return F.concat(F.lit(START), _escaped_role(role), F.lit("\n"), escaped(text), F.lit(END + "\n"))


def format_chats(
    turns: DataFrame, key: str = "conv_id", order: tuple[str, ...] = ("turn", "place"), trained: str = TRAINED_ROLE
) -> DataFrame:
    """One row per conversation: ``formatted`` text and ``loss`` mask.

    ``turns`` has the key, order columns, ``role`` and ``text``.  The mask lists
    (turn, start, end): code points start to end of that rendered turn bear loss.
    Turns are rendered before they move.  Equal orders are broken by role and
    text; rows with a null key form one conversation.  A conversation is one
    text in the end, so it is gathered whole: its rows are what one task holds.
    """
    role = F.coalesce(turns["role"], F.lit(""))
    text = F.coalesce(turns["text"], F.lit(""))
    head = F.length(_escaped_role(role)) + F.lit(len(START) + 1)
    rows = turns.select(
        turns[key].alias("key"),
        F.struct(
            *[turns[c].alias(f"o{i}") for i, c in enumerate(order)],
            rendered(role, text).alias("piece"),
            F.when(role == trained, head).alias("start"),
            (head + F.length(escaped(text))).alias("end"),
        ).alias("row"),
    )
    whole = rows.groupBy("key").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    marks = F.transform("rows", lambda r, i: F.struct(i.cast("long").alias("turn"), r["start"].cast("long").alias("start"), r["end"].cast("long").alias("end")))
    return whole.select(
        F.col("key").alias(key),
        F.array_join(F.transform("rows", lambda r: r["piece"]), "").alias("formatted"),
        F.filter(marks, lambda m: m["start"].isNotNull()).alias("loss"),
    )


def parsed_chats(chats: DataFrame) -> DataFrame:
    """Read the output back: add ``turns`` (role, text) and ``loss_texts``."""
    named = free_name(chats, "pieces")
    pieces = F.filter(F.split("formatted", r"<\|im_end\|>\n", -1), lambda p: p != "")

    def turn(piece: Column) -> Column:
        body = F.substring(piece, F.lit(len(START) + 1), F.length(piece))
        cut = F.locate("\n", body) if isinstance(body, str) else F.instr(body, "\n")
        return F.struct(
            _unescaped_role(F.substring(body, F.lit(1), cut - 1)).alias("role"),
            unescaped(F.substring(body, cut + 1, F.length(body))).alias("text"),
        )

    def masked(mark: Column) -> Column:
        piece = F.get(F.col(named), mark["turn"].cast("int"))
        return unescaped(F.substring(piece, (mark["start"] + 1).cast("int"), (mark["end"] - mark["start"]).cast("int")))

    split = chats.withColumn(named, pieces)
    return split.withColumn("turns", F.transform(named, turn)).withColumn(
        "loss_texts", F.transform("loss", masked)
    ).drop(named)
