"""Chat formatting: records of any known layout become turns, turns become marked text with a loss mask.

A record is a JSON object.  Its nested field paths (list items as ``[]``), sorted and hashed, are its
schema fingerprint; the fingerprint selects a declarative mapping (``LAYOUTS``) that says where role and
text are.  Records of an unknown layout give no turns and are listed by ``unknown_layouts``.

Every turn is formatted on its own row, so a conversation of any length is never gathered; the
formatted text of a conversation is its rows joined in order.  Digests need the order of a whole
conversation: rows are sorted within partitions and streamed through incremental hashes, with memory
for one batch.  One conversation's hash is sequential by definition; everything before it is not.

Defined cases: null or missing text and role count as empty; roles outside the template get a
marker of their own with the name percent-encoded; repeated rows are repeated turns (ties in order are
broken by role and text); rows with a null id form one conversation; records without turns give no
rows; an empty table gives an empty result."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxframe.llm.textkit import small_batches, written


@dataclass(frozen=True)
class Layout:
    """Where the turns of a record are: a list (``items``) of objects with a role and a text field, or
    ``turns`` of fixed role, each made of the fields named (empty ones left out, joined by a blank line)."""

    name: str
    paths: frozenset[str]
    items: str = ""
    role: str = ""
    text: str = ""
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()


def _pairs(name: str, *turns: tuple[str, tuple[str, ...]]) -> Layout:
    return Layout(name, frozenset(f for _, fields in turns for f in fields), turns=turns)


def _listed(name: str, items: str, role: str, text: str) -> Layout:
    return Layout(name, frozenset({f"{items}[].{role}", f"{items}[].{text}"}), items, role, text)


LAYOUTS = (
    Layout("turn", frozenset({"role", "text"}), role="role", text="text"),
    Layout("turn_content", frozenset({"role", "content"}), role="role", text="content"),
    _listed("messages", "messages", "role", "content"),
    _listed("turns", "turns", "role", "text"),
    _listed("from_value", "conversations", "from", "value"),
    _pairs("prompt_response", ("user", ("prompt",)), ("assistant", ("response",))),
    _pairs("prompt_completion", ("user", ("prompt",)), ("assistant", ("completion",))),
    _pairs("system_prompt_response", ("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))),
    _pairs("instruction", ("user", ("instruction",)), ("assistant", ("output",))),
    _pairs("instruction_input", ("user", ("instruction", "input")), ("assistant", ("output",))),
    _pairs("question_answer", ("user", ("question",)), ("assistant", ("answer",))),
)
#: Other names of the template's roles.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
TEMPLATE = {"system": ("<<SYS>>\n", "\n<</SYS>>\n"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s>", "</s>")}
LEARNED = "assistant"
_AHEAD = r"(?=<SYS>>|</SYS>>|/?s>|/?INST\]|ROLE |/ROLE\])"
_CONTROL = re.compile(r"([<\[])(\\*)" + _AHEAD)
_ESCAPED = re.compile(r"([<\[])\\(\\*)" + _AHEAD)


def field_paths(value, prefix: str = "") -> set[str]:
    """Paths of the leaves of a JSON value."""
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in field_paths(v, f"{prefix}.{k}" if prefix else k)}
    if isinstance(value, list):
        return {p for v in value for p in field_paths(v, prefix + "[]")} or {prefix + "[]"}
    return {prefix}


def fingerprint(paths) -> str:
    return hashlib.md5("\n".join(sorted(paths)).encode()).hexdigest()


BY_FINGERPRINT = {fingerprint(x.paths): x for x in LAYOUTS}


def _string(value) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def turns_of(record: str | None) -> tuple[str | None, list[tuple[str, str]]]:
    """(layout name or None, [(role, text)]) of one record."""
    try:
        value = json.loads(record) if record is not None else None
    except ValueError:
        value = None
    layout = BY_FINGERPRINT.get(fingerprint(field_paths(value))) if isinstance(value, dict) else None
    if layout is None:
        return None, []
    if layout.turns:
        return layout.name, [(role, "\n\n".join(x for x in (_string(value.get(f)) for f in fields) if x)) for role, fields in layout.turns]
    items = value[layout.items] if layout.items else [value]
    found = [(_string(x.get(layout.role)), _string(x.get(layout.text))) for x in items]
    return layout.name, [(ROLE_NAMES.get(r, r) if layout.items else r, t) for r, t in found]


def escape(text: str) -> str:
    """A backslash after the first character of every control string, also where some are already."""
    return _CONTROL.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def markers(role: str) -> tuple[str, str]:
    return TEMPLATE.get(role) or (f"[ROLE {quote(role, safe='')}] ", "[/ROLE]")


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """(formatted text, start and end of the part under the loss mask)."""
    before, after = markers(role)
    body = escape(text)
    start = len(before)
    end = start + len(body) if role == LEARNED else start
    return before + body + after, start, end


def read_turn(formatted: str) -> tuple[str, str]:
    """(role, text) of a formatted turn."""
    for role, (before, after) in TEMPLATE.items():
        if formatted.startswith(before) and formatted.endswith(after):
            return role, unescape(formatted[len(before): len(formatted) - len(after)])
    name, body = formatted[len("[ROLE "):].split("] ", 1)
    return unquote(name), unescape(body[: -len("[/ROLE]")])


def format_records(records: DataFrame) -> DataFrame:
    """(conv_id, seq, part, layout, formatted, loss_start, loss_end) from (conv_id, seq, record): one row
    per turn; a record of an unknown layout is one row with nulls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for conv, seq, record in zip(*(b.column(i).to_pylist() for i in range(3))):
                layout, turns = turns_of(record)
                if layout is None:
                    rows.append((conv, seq, 0, None, None, None, None))
                rows.extend((conv, seq, k, layout, *format_turn(r, t)) for k, (r, t) in enumerate(turns))
            cols = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

    names = ["conv_id", "seq", "part", "layout", "formatted", "loss_start", "loss_end"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int32()]
    return records.select("conv_id", F.col("seq").cast("bigint"), "record").mapInArrow(
        run, "conv_id bigint, seq bigint, part int, layout string, formatted string, loss_start int, loss_end int")


def unknown_layouts(formatted: DataFrame) -> DataFrame:
    """Number of records whose layout has no mapping."""
    return formatted.filter("layout is null").agg(F.count(F.lit(1)).alias("n_records"))


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) read back from
    formatted turns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, out = None, None, []

        def close() -> None:
            if state is not None:
                out.append((now[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        def drain() -> pa.RecordBatch:
            cols = list(zip(*out)) or [()] * 6
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

        for b in batches:
            for conv, text, lo, hi in zip(*(b.column(i).to_pylist() for i in range(4))):
                if now is None or now[0] != conv:
                    close()
                    now, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, body = read_turn(text)
                learned = unescape(text[lo:hi])
                state[0] += 1
                state[1].update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
                state[2] += len(learned)
                state[3].update(learned.encode("utf-8", "surrogatepass"))
                state[4] += len(text)
            if len(out) >= 1024:
                yield drain()
        close()
        yield drain()

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return (formatted.filter("layout is not null").repartition("conv_id")
            .sortWithinPartitions("conv_id", "seq", "part", "formatted")
            .select("conv_id", "formatted", "loss_start", "loss_end")
            .mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint,"
                             " loss_sha256 string, formatted_chars bigint"))


def turn_records(conversations: DataFrame) -> DataFrame:
    """(conv_id, seq, record) of a table with one row per turn."""
    record = F.to_json(F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))
    return conversations.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint").alias("seq"), record.alias("record"))


def format_conversations(records: DataFrame) -> DataFrame:
    """Formatted turns, written to the session's checkpoint folder and read again from there."""
    small_batches(records.sparkSession)
    return written(format_records(records))
