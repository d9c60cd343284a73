r"""Chat formatting: schema fingerprints pick declarative mappings to canonical turns.

Input records are JSON strings in any of several layouts, of any size.  The nested
field paths of a record (without value types) are hashed to a fingerprint; a table of
declarative ``Layout`` s gives, for each known fingerprint of the paths it declares,
where turns are found; further fields change nothing.  Adding a layout is adding a row,
not code.  All steps are SQL expressions.

Template, one turn after the other: ``### <role>: <text>``, a newline,
``</turn>``, a newline.  Inside roles and texts a backslash goes before every
``\``, ``#``, ``<`` and ``:``, so no text can form a turn mark (a mark's ``<``
follows a newline, a text's ``<`` a backslash), and taking one backslash away
before each escaped character restores it.

The loss mask is a list of ``(start, length)`` spans (code points, from 0) of the
formatted string that cover the escaped texts of the learned roles and nothing
else.

Defined cases: null text or role is empty text; a record without turns formats
to an empty string; a record that is no JSON object, or that no layout fits,
keeps a null ``turns`` and a null ``formatted``, with its fingerprint, so it can
be reported; repeated records are each formatted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tumbleweed.llm.common import computed, quoted, without

TURNS = "array<struct<role:string,text:string>>"
END = "\n</turn>\n"
OUTPUT = ["fingerprint", "turns", "formatted", "loss_spans"]


@dataclass(frozen=True)
class Layout:
    """Where one layout keeps its turns.

    ``paths``: the nested field paths whose fingerprint selects the layout.
    ``fields``: ``(role, json path)`` in turn order, a missing value or null gives no turn; or
    ``each``: ``(list path, role field, text field)`` for a list of messages.
    ``roles``: renamings of role names found in the data.
    """

    paths: tuple[str, ...]
    fields: tuple[tuple[str, str], ...] = ()
    each: tuple[str, str, str] | None = None
    roles: tuple[tuple[str, str], ...] = ()


#: Role names that mean the same.
ALIASES = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))

LAYOUTS = (
    Layout(("messages[].content", "messages[].role"), each=("messages", "role", "content")),
    Layout(("conversations[].from", "conversations[].value"), each=("conversations", "from", "value"), roles=ALIASES),
    Layout(("completion", "prompt"), fields=(("user", "$.prompt"), ("assistant", "$.completion"))),
    Layout(("completion", "prompt", "system"), fields=(("system", "$.system"), ("user", "$.prompt"), ("assistant", "$.completion"))),
    Layout(("instruction", "output"), fields=(("user", "$.instruction"), ("assistant", "$.output"))),
    Layout(("input", "instruction", "output"), fields=(("system", "$.instruction"), ("user", "$.input"), ("assistant", "$.output"))),
)


def shape_of(paths: tuple[str, ...]) -> str:
    """The text that is hashed for a set of field paths: sorted, one per line."""
    return "\n".join(sorted(paths))


def field_paths(record: Column, lists: tuple[str, ...] = ("messages", "conversations")) -> Column:
    """Sorted nested field paths of a JSON record; null when it is no JSON object.

    A field is its name; a field of ``lists`` that holds a list of objects is
    ``name[].field`` for every field of its elements, ``name[]`` if it is empty.
    Everything is read as text, so a record may be of any size.
    """
    keys = F.json_object_keys(record)
    parsed = F.from_json(record, "struct<" + ",".join(f"`{k}`:array<map<string,string>>" for k in lists) + ">")
    under = lambda k: lambda n: F.concat(F.lit(f"{k}[]."), n)
    inner = F.array()
    for k in lists:
        names = F.array_distinct(F.flatten(F.transform(F.filter(parsed[k], lambda m: m.isNotNull()), F.map_keys)))
        paths = F.when(F.size(parsed[k]) == 0, F.array(F.lit(f"{k}[]"))).otherwise(F.transform(names, under(k)))
        inner = F.concat(inner, F.coalesce(F.when(parsed[k].isNotNull(), paths), F.array()))
    plain = F.filter(keys, lambda key: ~F.coalesce(F.array_contains(F.array(*[F.when(parsed[k].isNotNull(), F.lit(k)) for k in lists]), key), F.lit(False)))
    return F.array_sort(F.array_distinct(F.concat(plain, inner)))


def _layout_turns(layout: Layout, record: Column) -> Column:
    if layout.each:
        at, role, text = layout.each
        parsed = F.from_json(record, f"struct<`{at}`:array<struct<`{role}`:string,`{text}`:string>>>")
        names = {a: b for a, b in layout.roles}
        renamed = lambda r: F.coalesce(F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[r], r) if names else r
        return F.transform(parsed[at], lambda m: F.struct(F.coalesce(renamed(m[role]), F.lit("")).alias("role"), F.coalesce(m[text], F.lit("")).alias("text")))
    turns = F.array(*[
        F.when(F.get_json_object(record, path).isNotNull(), F.struct(F.lit(role).alias("role"), F.get_json_object(record, path).alias("text")))
        for role, path in layout.fields])
    return F.filter(turns, lambda t: t.isNotNull())


def canonical_turns(records: DataFrame, column: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Adds ``fingerprint`` (hash of all field paths) and ``turns`` of every record.

    A layout is selected by the hash of those of the record's paths that it declares:
    other fields don't matter.  Of several layouts the one with most paths counts.
    """
    lists = tuple(dict.fromkeys(x.each[0] for x in layouts if x.each)) or ("messages",)
    base = without(records, ["fingerprint", "turns"]).withColumn("__paths", computed(field_paths(quoted(column), lists)))
    out = base.withColumn("fingerprint", F.sha2(F.array_join("__paths", "\n"), 256))
    turns = F.lit(None).cast(TURNS)
    for layout in sorted(layouts, key=lambda x: len(x.paths)):
        declared = F.array_intersect(F.col("__paths"), F.array(*[F.lit(p) for p in layout.paths]))
        known = F.sha2(F.array_join(F.array_sort(declared), "\n"), 256) == F.sha2(F.lit(shape_of(layout.paths)), 256)
        turns = F.when(known, _layout_turns(layout, quoted(column)).cast(TURNS)).otherwise(turns)
        if layout.each:  # a list without messages shows no fields
            turns = F.when(F.array_contains("__paths", f"{layout.each[0]}[]"), F.array().cast(TURNS)).otherwise(turns)
    return out.withColumn("turns", turns).drop("__paths")


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"([\\#<:])", r"\\$1")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"\\([\\#<:])", "$1")


def format_turns(df: DataFrame, learned: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Adds ``formatted`` and ``loss_spans`` for the ``turns`` column."""
    pieces = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit("### "), escape(t["role"]), F.lit(": ")).alias("head"),
        escape(t["text"]).alias("body"),
        t["role"].isin(*learned).alias("learned")))
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    tail = F.lit(END)

    def step(acc, p):
        start = acc["at"] + F.length(p["head"])
        span = F.struct(start.alias("start"), F.length(p["body"]).alias("length"))
        return F.struct((start + F.length(p["body"]) + F.length(tail)).alias("at"),
                        F.when(p["learned"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return (without(df, ["formatted", "loss_spans"]).withColumn("__pieces", pieces)
            .withColumn("formatted", F.array_join(F.transform("__pieces", lambda p: F.concat(p["head"], p["body"], tail)), ""))
            .withColumn("loss_spans", F.aggregate("__pieces", state, step, lambda acc: acc["spans"]))
            .drop("__pieces"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted string: the inverse of the template."""
    parts = F.filter(F.split(formatted, END, -1), lambda p: p.startswith("### "))

    def turn(p):
        body = F.substring(p, F.lit(5), F.length(p))
        role = F.regexp_extract(body, r"^((?:[^\\:]|\\[\\#<:])*)", 1)
        return F.struct(unescape(role).alias("role"),
                        unescape(F.substring(body, F.length(role) + F.lit(3), F.length(body))).alias("text"))

    return F.transform(parts, turn)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order, with nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + F.lit(1), s["length"]))), "")


def format_chats(records: DataFrame, column: str = "record", layouts: tuple[Layout, ...] = LAYOUTS,
                 learned: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Fingerprint, map to turns, format: adds ``fingerprint``, ``turns``, ``formatted``, ``loss_spans``."""
    return format_turns(canonical_turns(records, column, layouts), learned)
