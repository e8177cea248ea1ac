"""Chat formatting: schema fingerprints choose the mapping of a record, a template writes its turns.

A record is JSON text.  Its schema fingerprint is the hash of its sorted nested field paths
(``messages[].role``).  A table from fingerprint to declarative mapping says which paths hold the turns;
records of a layout that no mapping covers are an error row, not a guess.

The template marks each turn and escapes control strings inside texts: a backslash goes behind the
first character of each, backslashes are doubled.  No control string overlaps another one, so an
escaped text holds none and can be read back exactly.  The loss mask covers the escaped text of
assistant turns.

Turns are formatted one by one; those of a conversation are only put in order, never gathered, so a
conversation of any length fits.  Null texts and roles are empty.  Turns of one number are in a
fixed order, by hash of their record; repeated rows stay; null conversation ids are one conversation; empty tables give
empty tables; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced

ASSISTANT = "assistant"


def field_paths(value: Any, path: str = "") -> set[str]:
    """The paths of the leaves of a JSON value; list items share ``[]``."""
    if isinstance(value, dict) and value:
        return set().union(*(field_paths(v, f"{path}.{k}" if path else k) for k, v in value.items()))
    if isinstance(value, list) and value:
        return set().union(*(field_paths(v, path + "[]") for v in value))
    return {path + "[]" if isinstance(value, list) else path}


def fingerprint(paths: Iterator[str] | set[str] | Sequence[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns: ``turns`` are (role, path) in order, paths joined by ``+`` make one
    text of two paragraphs, a null text is an empty turn; or ``each`` is a list whose
    items hold role and text at ``role`` and ``text``, with ``roles`` renaming roles."""

    paths: tuple[str, ...]
    turns: tuple[tuple[str, str], ...] = ()
    each: str = ""
    role: str = "role"
    text: str = "content"
    roles: tuple[tuple[str, str], ...] = ()

    def read(self, record: dict) -> list[tuple[str, str]]:
        if self.turns:
            return [(role, "\n\n".join(filter(None, (_text(_at(record, p)) for p in path.split("+"))))) for role, path in self.turns]
        items = _at(record, self.each) if self.each else [record]
        names = dict(self.roles)
        return [(names.get(r := _text(_at(x, self.role)), r), _text(_at(x, self.text))) for x in items or []]


def _at(value: Any, path: str) -> Any:
    for key in path.split("."):
        value = value.get(key) if isinstance(value, dict) else None
    return value


def _text(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, sort_keys=True)


OTHER_NAMES = (("human", "user"), ("prompter", "user"), ("gpt", ASSISTANT), ("bot", ASSISTANT), ("model", ASSISTANT))

# The layouts in wide use.
MAPPINGS: Sequence[Mapping] = (
    Mapping(("prompt",), (("user", "prompt"),)),
    Mapping(("completion",), ((ASSISTANT, "completion"),)),
    Mapping(("system",), (("system", "system"),)),
    Mapping(("prompt", "completion"), (("user", "prompt"), (ASSISTANT, "completion"))),
    Mapping(("prompt", "response"), (("user", "prompt"), (ASSISTANT, "response"))),
    Mapping(("system", "prompt", "response"), (("system", "system"), ("user", "prompt"), (ASSISTANT, "response"))),
    Mapping(("question", "answer"), (("user", "question"), (ASSISTANT, "answer"))),
    Mapping(("instruction", "output"), (("user", "instruction"), (ASSISTANT, "output"))),
    Mapping(("instruction", "input", "output"), (("user", "instruction+input"), (ASSISTANT, "output"))),
    Mapping(("role", "content"), roles=OTHER_NAMES),
    Mapping(("message.role", "message.content"), role="message.role", text="message.content"),
    Mapping(("messages[].role", "messages[].content"), each="messages", roles=OTHER_NAMES),
    Mapping(("conversations[].from", "conversations[].value"), each="conversations", role="from", text="value", roles=OTHER_NAMES),
)


def by_fingerprint(mappings: Sequence[Mapping] = MAPPINGS) -> dict[str, Mapping]:
    return {fingerprint(m.paths): m for m in mappings}


@dataclass(frozen=True)
class Template:
    """How turns are written: begin, role, middle, text, end."""

    begin: str = "[INST]"
    middle: str = "[/INST]"
    end: str = "</s>"
    others: tuple[str, ...] = ("<s>", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")

    def __post_init__(self) -> None:
        control = self.control
        for a in control:
            for b in control:
                if any(a.endswith(b[:n]) for n in range(1, len(b))) or (a != b and a in b):
                    raise ValueError(f"control strings {a!r} and {b!r} overlap")
        if any("\\" in c or len(c) < 2 for c in control):
            raise ValueError("control strings have two characters or more and no backslash")

    @property
    def control(self) -> tuple[str, ...]:
        return (self.begin, self.middle, self.end, *self.others)

    def escape(self, text: str) -> str:
        found = "|".join(re.escape(c) for c in sorted(self.control, key=len, reverse=True))
        return re.sub(found, lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))

    def unescape(self, text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)

    def write(self, role: str, text: str) -> tuple[str, int, int]:
        """The formatted turn, and the begin and end of its loss mask (equal: none)."""
        head = self.begin + self.escape(role) + self.middle
        body = self.escape(text)
        return head + body + self.end, len(head), len(head) + len(body) * (role == ASSISTANT)

    def read(self, piece: str) -> tuple[str, str]:
        """Role and text of a formatted turn."""
        if not piece.startswith(self.begin) or not piece.endswith(self.end):
            raise ValueError("not a formatted turn")
        role, middle, text = piece[len(self.begin) : -len(self.end)].partition(self.middle)
        if not middle or any(c in role + "\0" + text for c in self.control):
            raise ValueError("not a formatted turn")
        return self.unescape(role), self.unescape(text)


TEMPLATE = Template()


def formatted(records: DataFrame, id_column: str, order: str, record: str = "record", template: Template = TEMPLATE, mappings: Sequence[Mapping] = MAPPINGS) -> DataFrame:
    """(id, order, record_hash, turn_no, schema, role, text, formatted, loss_begin, loss_end, problem): the turns of every record.

    ``turn_no`` counts the turns of one record.  A record that is no JSON object or whose layout is
    unknown gives one row with a ``problem`` and no turn.
    """
    rows = records.select(F.col(id_column).alias("id"), F.col(order).alias("place"), F.col(record).alias("record"), F.xxhash64(record).alias("record_hash"))
    known = by_fingerprint(mappings)
    kinds = [rows.schema[c].dataType.simpleString() for c in ("id", "place")]
    names = ["id", "place", "record_hash", "turn_no", "schema", "role", "text", "formatted", "loss_begin", "loss_end", "problem"]

    def turns(record: str | None) -> list[tuple]:
        try:
            value = json.loads(record or "")
        except ValueError:
            value = None
        if not isinstance(value, dict):
            return [(0, None, None, None, None, None, None, "not a JSON object")]
        schema = fingerprint(field_paths(value))
        if schema not in known:
            return [(0, schema, None, None, None, None, None, "unknown layout")]
        return [(n, schema, role, text, *template.write(role, text), None) for n, (role, text) in enumerate(known[schema].read(value))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int32(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string()]
        for batch in sliced(batches):
            at, out = [], []
            for i, value in enumerate(batch.column(2).to_pylist()):
                found = turns(value)
                at += [i] * len(found)
                out += found
            if out:
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                picked = pa.array(at)
                yield pa.RecordBatch.from_arrays([*(batch.column(n).take(picked) for n in ("id", "place", "record_hash")), *columns], names=names)

    made = rows.mapInArrow(run, f"id {kinds[0]}, place {kinds[1]}, record_hash long, turn_no int, schema string, role string, text string, formatted string, loss_begin int, loss_end int, problem string")
    return made.withColumnsRenamed({"id": id_column, "place": order})


def digests(turns: DataFrame, id_column: str, order: str, template: Template = TEMPLATE) -> DataFrame:
    """(id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_problems), read back from
    the formatted turns of each conversation in order.

    Records with a problem are counted and give no turn; a conversation of such records only has a row.  A task reads its conversations turn by turn and holds no more than one.
    """
    kind = turns.schema[id_column].dataType.simpleString()
    rows = turns.select(F.col(id_column).alias("id"), F.col(order).alias("place"), "record_hash", "turn_no", "formatted", "loss_begin", "loss_end")
    rows = rows.repartition("id").sortWithinPartitions("id", "place", "record_hash", "turn_no").select("id", "formatted", "loss_begin", "loss_end")
    names = [id_column, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_problems"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None

        def closed() -> tuple:
            return (current, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5])

        for batch in sliced(batches):
            done = []
            for name, piece, begin, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if state is None or name != current:
                    if state is not None:
                        done.append(closed())
                    current, state = name, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                if piece is None:
                    state[5] += 1
                    continue
                role, text = template.read(piece)
                lost = template.unescape(piece[begin:end])
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                state[2] += len(lost)
                state[3].update(lost.encode("utf-8", "surrogatepass"))
                state[4] += len(piece)
            if done:
                yield rows_of(done, batch.schema.field(0).type)
            kind_ = batch.schema.field(0).type
        if state is not None:
            yield rows_of([closed()], kind_)

    def rows_of(done: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        types = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names=names)

    return rows.mapInArrow(run, f"`{id_column}` {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_problems long")
