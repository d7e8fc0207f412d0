"""Chat formatting: records of many layouts become canonical turns, then one training text with a loss mask.

A record is a VARIANT value (``parse_json`` of a JSON text, ``to_variant_object`` of typed columns). Its schema fingerprint is
the digest of the nested field paths it has, of those that any declared layout names; other fields do not matter. A layout is
a declaration: the paths it needs, those it may have, and where its turns are. Fingerprints of all layouts are known when the
query is planned, so the fingerprint of a record selects the mapping in place, without a join. A record whose fingerprint no
layout has keeps a null layout and null turns (``unmapped`` rows are for the caller to count or mend).

The template is ``<|im_start|>role<|im_sep|>text<|im_end|>`` per turn. Control strings of this and other common templates that
stand in a role or text get a backslash after their first character; where backslashes stand there already, one more. So no control
string stays, the backslashes of ordinary text are untouched, and taking one away again is exact. The loss mask is the list of spans
(start, length in code points of the formatted text) that cover the escaped texts of assistant turns and nothing else.

Everything is column expressions; the only shuffle is the grouping of a table that holds one turn a row. Defined results: null roles and
texts are empty strings; a null or unreadable record is unmapped; turns of a table are ordered by turn, role and text, nulls
first, repeated rows are repeated turns; a null conversation id is one conversation of its own; no turns give an empty text;
extra columns pass through; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.expr import let

BEGIN, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Control strings of the template and of others; none starts with the end of another.
CONTROLS = (
    BEGIN, SEPARATOR, END, "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<s>", "</s>", "<unk>", "<pad>",
    "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)
TURNS = "array<struct<role:string,text:string>>"


def _marked(backslashes: str) -> list[str]:
    """One pattern per first character: (first character)(backslashes)(rest of a control string)."""
    heads = sorted({c[0] for c in CONTROLS})
    return [f"({re.escape(h)}){backslashes}({'|'.join(re.escape(c[1:]) for c in CONTROLS if c[0] == h)})" for h in heads]


def escaped(text: Column) -> Column:
    """``text`` without control strings."""
    for pattern in _marked(r"(\\*)"):
        text = F.regexp_replace(text, pattern, r"$1\\$2$3")
    return text


def unescaped(text: Column) -> Column:
    for pattern in _marked(r"\\(\\*)"):
        text = F.regexp_replace(text, pattern, "$1$2$3")
    return text


@dataclass(frozen=True)
class Turn:
    """Where turns come from: texts at ``text`` with the role at ``role`` or the fixed ``says``.

    ``each`` names the list whose elements hold both, or is empty for fields of the record itself. Several texts of one turn are joined by an
    empty line, absent or empty ones left out. ``{list}[].{field}`` as a text joins the fields of a nested list."""

    text: tuple[str, ...]
    role: str = ""
    says: str = ""
    each: str = ""
    renamed: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class Layout:
    """Paths that every record of the layout has, those it may have, and its turns in order."""

    name: str
    needs: tuple[str, ...]
    turns: tuple[Turn, ...]
    may: tuple[str, ...] = field(default=())


_SYSTEM = Turn(("system",), says="system")
LAYOUTS = (
    Layout("messages", ("messages[].role", "messages[].content"), (Turn(("content",), role="role", each="messages"),)),
    Layout("message_parts", ("messages[].role", "messages[].content", "messages[].content[].text"), (
        Turn(("content[].text", "content"), role="role", each="messages"),
    )),
    Layout("speakers", ("conversations[].from", "conversations[].value"), (
        _SYSTEM, Turn(("value",), role="from", each="conversations", renamed=(("human", "user"), ("gpt", "assistant"))),
    ), may=("system",)),
    Layout("prompt_completion", ("prompt", "completion"), (_SYSTEM, Turn(("prompt",), says="user"), Turn(("completion",), says="assistant")), may=("system",)),
    Layout("prompt_response", ("prompt", "response"), (_SYSTEM, Turn(("prompt",), says="user"), Turn(("response",), says="assistant")), may=("system",)),
    Layout("instruction", ("instruction", "output"), (
        _SYSTEM, Turn(("instruction", "input"), says="user"), Turn(("output",), says="assistant"),
    ), may=("input", "system")),
    Layout("question_answer", ("question", "answer"), (_SYSTEM, Turn(("context", "question"), says="user"), Turn(("answer",), says="assistant")), may=("context", "system")),
)


def _digest(paths: list[str] | tuple[str, ...]) -> str:
    return hashlib.md5("\n".join(sorted(set(paths))).encode()).hexdigest()


def known_fingerprints(layouts: tuple[Layout, ...] = LAYOUTS) -> dict[str, str]:
    """Fingerprint to layout, one for every choice of optional paths; two layouts may not share one."""
    found: dict[str, str] = {}
    for layout in layouts:
        for n in range(len(layout.may) + 1):
            for chosen in combinations(layout.may, n):
                if found.setdefault(_digest(layout.needs + chosen), layout.name) != layout.name:
                    raise ValueError(f"layout {layout.name} has the paths of another one")
    return found


def _part(value: Column, name: str, kind: str) -> Column:
    return F.try_variant_get(value, f"$.{name}", kind)


def _has(value: Column, path: str) -> Column:
    """Whether the record has a nested field path (``a``, ``list[].a``, ``list[].inner[].a``), with any value, null too."""
    first, _, rest = path.partition("[].")
    if not rest:
        return _part(value, first, "variant").isNotNull()
    return F.coalesce(F.exists(_part(value, first, "array<variant>"), lambda e: _has(e, rest)), F.lit(False))


def fingerprint(record: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """Digest of the sorted nested field paths of ``record``, of those that any layout names."""
    vocabulary = sorted({p for layout in layouts for p in layout.needs + layout.may})
    return F.md5(F.concat_ws("\n", *[F.when(_has(record, p), F.lit(p)) for p in vocabulary]).cast("binary"))


def _text(value: Column, path: str) -> Column:
    """Text at the path; a list of parts joined, null where there is none."""
    first, _, rest = path.partition("[].")
    if not rest:
        return _part(value, first, "string")
    return F.array_join(F.transform(_part(value, first, "array<variant>"), lambda e: F.coalesce(_text(e, rest), F.lit(""))), "")


def _turns(record: Column, turn: Turn) -> Column:
    def one(value: Column) -> Column:
        if len(turn.text) > 1 and any("[]" in p for p in turn.text):
            text = F.coalesce(*[_text(value, p) for p in turn.text])
        else:
            text = F.array_join(F.filter(F.array(*[_text(value, p) for p in turn.text]), lambda t: t != ""), "\n\n")
        role = F.coalesce(_text(value, turn.role), F.lit("")) if turn.role else F.lit(turn.says)
        for old, new in turn.renamed:
            role = F.when(role == old, new).otherwise(role)
        return F.struct(role.alias("role"), F.coalesce(text, F.lit("")).alias("text"))

    if turn.each:
        return F.transform(_part(record, turn.each, "array<variant>"), one)
    if turn.says == "system":
        return F.when(_text(record, turn.text[0]).isNotNull(), F.array(one(record))).otherwise(F.array().cast(TURNS))
    return F.array(one(record))


def canonical(records: DataFrame, record: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``records`` with ``fingerprint``, ``layout`` and ``turns`` of the VARIANT column ``record`` in place of it.

    A column of ``records`` with one of these names is the caller's to rename first."""
    found = records.withColumn("fingerprint", fingerprint(F.col(record), layouts))
    names: dict[str, list[str]] = {}
    for digest, name in known_fingerprints(layouts).items():
        names.setdefault(name, []).append(digest)
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for one in layouts:
        mine = F.col("fingerprint").isin(names[one.name])
        layout = F.when(mine, one.name).otherwise(layout)
        turns = F.when(mine, F.concat(*[_turns(F.col(record), t) for t in one.turns]).cast(TURNS)).otherwise(turns)
    return found.withColumn("layout", layout).withColumn("turns", turns).drop(record)


def by_conversation(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as one record of messages per conversation, in a VARIANT column ``record``."""
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    grouped = rows.groupBy("conv_id").agg(ordered.alias("_turns"))
    messages = F.transform("_turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content")))
    return grouped.select("conv_id", F.to_variant_object(F.struct(messages.alias("messages"))).alias("record"))


def formatted(turns: Column) -> Column:
    """Struct of the training text and the spans under the loss mask."""
    pieces = F.transform(turns, lambda t: F.struct(
        F.concat(F.lit(BEGIN), escaped(F.coalesce(t["role"], F.lit(""))), F.lit(SEPARATOR)).alias("head"),
        escaped(F.coalesce(t["text"], F.lit(""))).alias("text"), F.coalesce(t["role"] == "assistant", F.lit(False)).alias("loss"),
    ))

    def spans(parts: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,length:long>>").alias("spans"))

        def step(done: Column, p: Column) -> Column:
            begin, size = done["at"] + F.length(p["head"]), F.length(p["text"]).cast("long")
            mine = F.when(p["loss"], F.array(F.struct(begin.alias("start"), size.alias("length")))).otherwise(F.array().cast("array<struct<start:long,length:long>>"))
            return F.struct((begin + size + len(END)).alias("at"), F.concat(done["spans"], mine).alias("spans"))

        return F.aggregate(parts, start, step)["spans"]

    return let(pieces, lambda parts: F.struct(
        F.array_join(F.transform(parts, lambda p: F.concat(p["head"], p["text"], F.lit(END))), "").alias("text"), spans(parts).alias("loss"),
    ))


def read_turns(text: Column) -> Column:
    """Turns of a formatted text."""
    pieces = F.filter(F.split(text, re.escape(END), -1), lambda p: p != "")
    return F.transform(pieces, lambda p: let(F.split(F.substring(p, len(BEGIN) + 1, 2**31 - 1), re.escape(SEPARATOR), 2), lambda two: F.struct(
        unescaped(F.get(two, F.lit(0))).alias("role"), unescaped(F.get(two, F.lit(1))).alias("text"),
    )))


def read_loss(text: Column, loss: Column) -> Column:
    """Unescaped texts under the mask, in order."""
    return F.transform(loss, lambda s: unescaped(F.substring(text, (s["start"] + 1).cast("int"), s["length"].cast("int"))))


def format_records(records: DataFrame, record: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``canonical`` rows with ``formatted`` (text and loss spans) added; unmapped rows have a null one."""
    found = canonical(records, record, layouts)
    return found.withColumn("formatted", F.when(F.col("turns").isNotNull(), formatted(F.col("turns"))))
