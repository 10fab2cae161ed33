"""Chat formatting by schema fingerprints.

Conversations arrive in many layouts: prompt and answer columns, instructions with an input, lists of
messages, a table with a row per turn. The fingerprint of a record is a hash of its nested field
paths; a registry maps fingerprints to declarative mappings, and one expression per mapping turns
the record into canonical turns, an array of (role, text). JSON records are fingerprinted row by
row, so one table may mix layouts; a typed table has one fingerprint, that of its schema.

The template marks turns and escapes its control strings inside roles and texts, so that a formatted
conversation can be read back exactly. Everything is an expression of built-in functions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from .scratch import pick

TURNS = "array<struct<role: string, text: string>>"


# --- fingerprints ------------------------------------------------------------------------------------


def fingerprint(paths: Sequence[str]) -> int:
    """A 64-bit hash of a set of field paths. ``a[].b`` is the field b of the elements of a."""
    import xxhash

    return int.from_bytes(xxhash.xxh64_digest("\n".join(sorted(set(paths)))), "big", signed=True)


def schema_paths(kind: DataType, at: str = "") -> list[str]:
    """Paths of the leaves of a type."""
    if isinstance(kind, StructType):
        return [p for f in kind.fields for p in schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, ArrayType):
        return schema_paths(kind.elementType, f"{at}[]")
    return [at]


@dataclass(frozen=True)
class Mapping:
    """How one layout becomes turns.

    ``turns`` are (role, field) pairs of top-level text fields, in order; an empty or absent field
    gives no turn. ``messages`` names a list of objects whose ``role`` and ``text`` fields make the
    turns after those, with ``roles`` renaming roles. ``paths`` are the field paths of the layout.
    """

    name: str
    paths: tuple[str, ...]
    turns: tuple[tuple[str, str], ...] = ()
    messages: str | None = None
    role: str = "role"
    text: str = "content"
    roles: tuple[tuple[str, str], ...] = ()
    # A field that is put after the last turn so far, parted by an empty line.
    joined: str | None = None
    key: tuple[str, ...] = ()
    order: str | None = None


# Field names of common layouts.
LAYOUTS = (
    Mapping("prompt", ("prompt", "response"), (("user", "prompt"), ("assistant", "response"))),
    Mapping("completion", ("prompt", "completion"), (("user", "prompt"), ("assistant", "completion"))),
    Mapping("question", ("question", "answer"), (("user", "question"), ("assistant", "answer"))),
    Mapping("instruction", ("instruction", "output"), (("user", "instruction"), ("assistant", "output"))),
    Mapping(
        "instruction-input",
        ("instruction", "input", "output"),
        (("user", "instruction"), ("assistant", "output")),
        joined="input",
    ),
    Mapping(
        "system-question",
        ("system_prompt", "question", "response"),
        (("system", "system_prompt"), ("user", "question"), ("assistant", "response")),
    ),
    Mapping("messages", ("messages[].role", "messages[].content"), messages="messages"),
    Mapping(
        "system-messages",
        ("system", "messages[].role", "messages[].content"),
        (("system", "system"),),
        messages="messages",
    ),
    Mapping(
        "conversations",
        ("conversations[].from", "conversations[].value"),
        messages="conversations",
        role="from",
        text="value",
        roles=(("human", "user"), ("gpt", "assistant")),
    ),
    Mapping("turn-rows", ("conv_id", "turn", "role", "text"), role="role", text="text", key=("conv_id",), order="turn"),
)


def registry(layouts: Sequence[Mapping] = LAYOUTS) -> dict[int, Mapping]:
    return {fingerprint(m.paths): m for m in layouts}


def record_paths(record: Column) -> Column:
    """Sorted field paths of a JSON record: its keys, and the keys of objects inside lists and objects."""
    fields = F.from_json(record, "map<string, string>")

    def below(key: Column, value: Column) -> Column:
        first = F.get_json_object(value, "$[0]")
        inside = F.json_object_keys(value)
        inside_list = F.json_object_keys(first)
        return (
            F.when(value.startswith("{"), F.transform(inside, lambda k: F.concat(key, F.lit("."), k)))
            .when(value.startswith("[") & first.startswith("{"), F.transform(inside_list, lambda k: F.concat(key, F.lit("[]."), k)))
            .when(value.startswith("["), F.array(F.concat(key, F.lit("[]"))))
            .otherwise(F.array(key))
        )

    nested = F.transform(F.map_entries(fields), lambda e: F.coalesce(below(e["key"], e["value"]), F.array(e["key"])))
    return F.array_sort(F.array_distinct(F.flatten(nested)))


def _present(turns: Column) -> Column:
    return F.filter(turns, lambda t: t["text"].isNotNull() & (t["text"] != ""))


def _record_turns(record: Column, layout: Mapping) -> Column:
    def field(name: str) -> Column:
        return F.get_json_object(record, f"$.{name}")

    pairs = []
    for role, name in layout.turns:
        text = field(name)
        if layout.joined and role == "user":
            extra = field(layout.joined)
            text = F.when(extra.isNotNull() & (extra != ""), F.concat(text, F.lit("\n\n"), extra)).otherwise(text)
        pairs.append(F.struct(F.lit(role).alias("role"), text.alias("text")))
    turns = _present(F.array(*pairs)) if pairs else F.array().cast(TURNS)
    if not layout.messages:
        return turns
    listed = F.from_json(field(layout.messages), f"array<struct<`{layout.role}`: string, `{layout.text}`: string>>")

    def turn(message: Column) -> Column:
        role = message[layout.role]
        for known, name in layout.roles:
            role = F.when(message[layout.role] == known, F.lit(name)).otherwise(role)
        return F.struct(role.alias("role"), F.coalesce(message[layout.text], F.lit("")).alias("text"))

    return F.concat(turns, F.coalesce(F.transform(listed, turn), F.array().cast(TURNS)))


def record_turns(records: DataFrame, record: str, layouts: Sequence[Mapping] = LAYOUTS) -> DataFrame:
    """``records`` with ``layout`` and ``turns`` of the JSON column ``record``.

    A record that is null, not an object, or of a layout that the registry lacks has null in both. A
    message without a text has an empty one.
    """
    known = [m for m in layouts if not m.key]
    paths = F.array_join(record_paths(records[record]), "\n")
    # The same function on both sides, so that a fingerprint is one number everywhere.
    mark = F.xxhash64(paths)
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for m in known:
        same = mark == F.xxhash64(F.lit("\n".join(sorted(m.paths))))
        layout = F.when(same, F.lit(m.name)).otherwise(layout)
        turns = F.when(same, _record_turns(records[record], m)).otherwise(turns)
    return records.select("*", layout.alias("layout"), turns.alias("turns"))


def table_turns(rows: DataFrame, layouts: Sequence[Mapping] = LAYOUTS) -> DataFrame:
    """(key columns, turns) of a table with a row per turn, by the mapping that its schema selects.

    A null role or text is empty. Rows of a conversation are ordered by the order column, nulls first,
    then by role and text; repeated rows are turns of their own. One conversation meets in one task,
    as its formatted text must.
    """
    columns = {p for m in layouts if m.key for p in m.paths}
    rows = pick(rows, *[c for c in rows.columns if c in columns])
    layout = registry([m for m in layouts if m.key]).get(fingerprint(schema_paths(rows.schema)))
    if layout is None:
        raise ValueError(f"no mapping for the fields {sorted(schema_paths(rows.schema))}")
    turn = F.struct(
        F.col(layout.order).alias("at"),
        F.coalesce(layout.role, F.lit("")).alias("role"),
        F.coalesce(layout.text, F.lit("")).alias("text"),
    )
    grouped = rows.groupBy(*layout.key).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    plain = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return grouped.select(*layout.key, plain.alias("turns"))


# --- the template ------------------------------------------------------------------------------------

OPEN, MIDDLE, CLOSE = "[INST:", "]", "</s>"
# Control strings begin with these; inside texts each is written as a backslash and a letter.
ESCAPES = (("\\", "\\e"), ("<", "\\l"), ("[", "\\s"), ("]", "\\r"))


def escape(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def formatted(turns: Column) -> Column:
    """Every turn as its role in an opening mark, its text and a closing mark."""
    return F.array_join(
        F.transform(
            turns,
            lambda t: F.concat(F.lit(OPEN), escape(t["role"]), F.lit(MIDDLE), escape(t["text"]), F.lit(CLOSE)),
        ),
        "",
    )


def parsed(text: Column) -> Column:
    """(role, text, length) of every turn of a formatted conversation; length is that of its written text."""
    turns = F.slice(F.split(text, CLOSE, -1), 1, F.size(F.split(text, CLOSE, -1)) - 1)

    def turn(t: Column) -> Column:
        mark = F.instr(t, MIDDLE)
        written = F.substring(t, mark + 1, F.length(t))
        role = F.substring(t, F.lit(len(OPEN) + 1), mark - F.lit(len(OPEN) + 1))
        return F.struct(unescape(role).alias("role"), unescape(written).alias("text"), F.length(written).alias("length"))

    return F.transform(turns, turn)


def loss_spans(turns: Column) -> Column:
    """(start, length), from 0 in code points of the formatted text, of each assistant's text."""
    start = F.aggregate(
        turns,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start: int, length: int>>").alias("spans")),
        lambda done, t: F.struct(
            (done["at"] + len(OPEN + MIDDLE + CLOSE) + F.length(escape(t["role"])) + F.length(escape(t["text"]))).alias("at"),
            F.when(
                t["role"] == "assistant",
                F.array_append(
                    done["spans"],
                    F.struct(
                        (done["at"] + len(OPEN + MIDDLE) + F.length(escape(t["role"]))).alias("start"),
                        F.length(escape(t["text"])).alias("length"),
                    ),
                ),
            )
            .otherwise(done["spans"])
            .alias("spans"),
        ),
    )
    return start["spans"]


def format_turns(conversations: DataFrame) -> DataFrame:
    """``conversations`` with ``turns`` replaced by ``formatted`` and ``loss_spans``."""
    marked = conversations.select("*", formatted(F.col("turns")).alias("formatted"), loss_spans(F.col("turns")).alias("loss_spans"))
    return marked.drop("turns")


def chat_query(conversations: DataFrame) -> DataFrame:
    """Digests of all conversations and number -1, read back from the formatted text and its loss spans."""
    control = conversations.sparkSession.sql(
        "select * from values (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]')"
        " as (conv_id, turn, role, text)"
    )
    rows = pick(conversations, "conv_id", "turn", "role", "text").unionByName(control)
    done = format_turns(table_turns(rows))
    read = done.select("*", parsed(F.col("formatted")).alias("read"))
    lost = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    read = read.select("*", F.array_join(lost, "").alias("loss"))
    turns = F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("read").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(11 + length(role || text) + length(regexp_replace(role || text, '[^]<[\\]', '', 'g'))) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id
"""
