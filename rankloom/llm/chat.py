"""Chat formatting by schema fingerprint.

Records come in many layouts: prompt and completion, instruction with input and output, lists of
messages under several names. All layouts are fields of one wide record, of which a row fills some.
The fingerprint of a row is a hash of the nested field paths it fills; a declared mapping per
fingerprint turns the row into canonical turns ``(role, text)``. A row of an unknown layout has none.

The template writes each turn as ``### role: text </turn>`` and a line break. Inside roles and texts the
control strings are escaped, so a formatted conversation can be read back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MESSAGES = "array<struct<role string, content string>>"
_SHARED = "array<struct<from string, value string>>"

_TEXTS = "system prompt completion response instruction input output question answer".split()

#: Every field a record can have, with its type; the parts of list elements count as nested fields.
FIELDS = {"messages": _MESSAGES, "conversations": _SHARED} | dict.fromkeys(_TEXTS, "string")
PARTS = {"messages": ("content", "role"), "conversations": ("from", "value")}

OPEN, NAMED, CLOSE = "### ", ": ", " </turn>\n"

# Escapes in order of writing; each starts with the backslash, which is escaped first.
_ESCAPES = (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\t"))
_ROLE_ESCAPES = (*_ESCAPES, (":", "\\c"))

_ROLES = {"human": "user", "gpt": "assistant"}


def _turn(role: str, text: str | Column) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.struct(F.lit(role).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _listed(field: str, role: str, text: str) -> Column:
    def turn(message: Column) -> Column:
        named = message[role]
        for theirs, ours in _ROLES.items() if role == "from" else ():
            named = F.when(named == theirs, ours).otherwise(named)
        return F.struct(F.coalesce(named, F.lit("")).alias("role"), F.coalesce(message[text], F.lit("")).alias("text"))

    return F.transform(field, turn)


def _asked(question: str | Column, answer: str, system: bool) -> Column:
    turns = [_turn("user", question), _turn("assistant", answer)]
    return F.array(*([_turn("system", "system")] if system else []), *turns)


def _mappings() -> dict[tuple[str, ...], Column]:
    """Filled field paths to turns."""
    with_input = F.concat_ws("\n", "instruction", "input")
    found = {
        ("messages", "messages.content", "messages.role"): _listed("messages", "role", "content"),
        ("conversations", "conversations.from", "conversations.value"): _listed("conversations", "from", "value"),
    }
    for question, asked, answer in (
        (("prompt",), "prompt", "completion"),
        (("prompt",), "prompt", "response"),
        (("question",), "question", "answer"),
        (("instruction",), "instruction", "output"),
        (("input", "instruction"), with_input, "output"),
    ):
        for system in (False, True):
            paths = (*question, answer, *(["system"] if system else []))
            found[tuple(sorted(paths))] = _asked(asked, answer, system)
    return found


def fingerprint(paths: Column) -> Column:
    """Hash of sorted field paths."""
    return F.sha2(F.array_join(paths, "\n"), 256)


def _filled_paths() -> Column:
    """Sorted paths of the fields that a record fills. The elements of a list count together."""
    paths = []
    for name in FIELDS:
        paths.append(F.when(F.col(name).isNotNull(), F.lit(name)))
        for part in PARTS.get(name, ()):
            paths.append(F.when(F.exists(name, lambda x: x[part].isNotNull()), F.lit(f"{name}.{part}")))
    return F.array_sort(F.array_compact(F.array(*paths)))


def canonical_turns(records: DataFrame, key: str = "conv_id") -> DataFrame:
    """``(key, fingerprint, turns array<struct<role, text>>)`` for each record.

    ``records`` has any of ``FIELDS``; those it lacks are null, other columns are
    ignored. Null texts inside a known layout are empty; ``turns`` is null for an unknown one.
    """
    rows = records.select(
        key,
        *[
            (F.col(name) if name in records.columns else F.lit(None)).cast(kind).alias(name)
            for name, kind in FIELDS.items()
        ],
    ).withColumn("fingerprint", fingerprint(_filled_paths()))
    turns = F.lit(None).cast("array<struct<role string, text string>>")
    for paths, mapping in _mappings().items():
        known = fingerprint(F.array(*[F.lit(path) for path in paths]))
        turns = F.when(F.col("fingerprint") == known, mapping).otherwise(turns)
    return rows.select(key, "fingerprint", turns.alias("turns"))


def from_json(rows: DataFrame, column: str, key: str = "conv_id") -> DataFrame:
    """Records from a column of JSON objects; what is no object has no field."""
    return rows.select(key, F.from_json(column, ", ".join(f"{name} {kind}" for name, kind in FIELDS.items())).alias("record")).select(key, "record.*")


def _escaped(text: Column, escapes=_ESCAPES) -> Column:
    for plain, written in escapes:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def _unescaped(text: Column, escapes=_ESCAPES) -> Column:
    for plain, written in reversed(escapes):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def formatted(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """``(key, formatted, loss_mask array<struct<start, length>>)`` from ``(key, turns)``.

    The mask has the place (from 1) and the length, in code points, of each assistant text in the
    formatted string. No turns give an empty string and no mask.
    """
    parts = F.transform(
        F.coalesce("turns", F.array().cast("array<struct<role string, text string>>")),
        lambda t: F.struct(
            F.concat(F.lit(OPEN), _escaped(t["role"], _ROLE_ESCAPES), F.lit(NAMED)).alias("head"),
            _escaped(t["text"]).alias("body"),
            (t["role"] == "assistant").alias("learned"),
        ),
    )
    rows = turns.select(key, parts.alias("parts"))
    zero = F.struct(F.lit(1).cast("long").alias("at"), F.array().cast("array<struct<start:long,length:long>>").alias("mask"))

    def place(state: Column, part: Column) -> Column:
        start = state["at"] + F.length(part["head"])
        size = F.length(part["body"]).cast("long")
        span = F.struct(start.alias("start"), size.alias("length"))
        mask = F.when(part["learned"], F.array_append(state["mask"], span)).otherwise(state["mask"])
        return F.struct((start + size + len(CLOSE)).alias("at"), mask.alias("mask"))

    return rows.select(
        key,
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "").alias("formatted"),
        F.aggregate("parts", zero, place)["mask"].alias("loss_mask"),
    )


def read_back(rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """``(key, turns, loss_texts, formatted)`` from :func:`formatted`: the turns, and the unescaped texts
    under the loss mask."""
    written = F.filter(F.split("formatted", " </turn>\n", -1), lambda part: part != "")
    turn = lambda part: F.struct(
        _unescaped(F.substr(part, F.lit(len(OPEN) + 1), F.instr(part, F.lit(NAMED)) - len(OPEN) - 1), _ROLE_ESCAPES).alias("role"),
        _unescaped(F.substr(part, F.instr(part, F.lit(NAMED)) + len(NAMED))).alias("text"),
    )
    masked = lambda span: _unescaped(F.substr("formatted", span["start"].cast("int"), span["length"].cast("int")))
    return rows.select(
        key, F.transform(written, turn).alias("turns"), F.transform("loss_mask", masked).alias("loss_texts"), "formatted"
    )


def conversation_records(rows: DataFrame) -> DataFrame:
    """``(conv_id, messages)`` from rows ``(conv_id, turn, role, text)``, in order of turn.

    Null roles and texts are empty. Turns that are null come first; rows of the same turn go by
    role and text, and repeated rows are repeated turns. A conversation is one record, so its rows
    meet in one task; a null conv_id is a conversation too.
    """
    message = F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content"))
    in_order = F.sort_array(F.collect_list(F.struct("turn", message.alias("message"))))
    return rows.groupBy("conv_id").agg(F.transform(in_order, lambda t: t["message"]).alias("messages"))


def chat_digest(records: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)``: format every
    record and digest what can be read back from the output."""
    back = read_back(formatted(canonical_turns(records)))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join("loss_texts", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
