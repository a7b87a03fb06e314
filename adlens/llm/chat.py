"""Chat formatting by schema fingerprints.

A record is one JSON object of any known layout (messages, from/value pairs,
prompt and completion, instruction fields, single turns).  Its nested field
paths are hashed; the fingerprint selects the declared layout, whose mapping
turns the record into canonical turns.  No layout is guessed from values.

The template writes each turn as ``### role: text</turn>`` and a line end.
Inside roles and texts the characters that control strings begin with are
escaped by a backslash (and so is the backslash), so no text can open or close
a turn, and unescaping gives back every character.  The loss mask covers the
texts of assistant turns.

Records are converted and formatted where they lie; reading back sorts the
segments by conversation and place and streams through them, so a
conversation of any length takes bounded memory.

Defined results: null or missing texts and roles are empty; a record whose
fingerprint no layout has, that is no JSON object, is nested beyond what the
JSON reader takes (thousands of levels) or is null, gives no turns and is
listed by ``unknown_records``; half of a character (a lone surrogate) becomes
U+FFFD; keys that hold the signs of paths are not taken for paths; repeated rows are turns of their own,
equal places are ordered by segment; null conversation ids form one
conversation; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
_ROLE = re.compile(r"[\\#<:]")
_TEXT = re.compile(r"[\\#<]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_SEGMENT = re.compile(r"### ([^\\:]*(?:\\.[^\\:]*)*): ([^\\<]*(?:\\.[^\\<]*)*)</turn>\n", re.DOTALL)


@dataclass(frozen=True)
class Layout:
    """``fields`` maps each field to the role of its text; with ``items``, the
    turns are the objects of that list, whose ``role_field`` and ``text_field``
    hold role and text.  ``roles`` renames roles.  Any non-empty choice of the
    fields of a layout without ``items`` is one of its schemas."""

    name: str
    fields: tuple[tuple[str, str], ...] = ()
    items: str | None = None
    role_field: str = "role"
    text_field: str = "content"
    roles: dict[str, str] = field(default_factory=dict)

    def schemas(self) -> list[frozenset[str]]:
        if self.items is not None:
            top = f"{self.items}[]." if self.items else ""
            return [frozenset({top + self.role_field, top + self.text_field})]
        names = [n for n, _ in self.fields]
        return [frozenset(c) for k in range(1, len(names) + 1) for c in combinations(names, k)]

    def turns(self, record: dict) -> list[tuple[str, str]]:
        if self.items is None:
            return [(role, str(record[n] if record[n] is not None else "")) for n, role in self.fields if n in record]
        out = []
        for x in record[self.items] if self.items else [record]:
            role = str(x.get(self.role_field) or "")
            text = x.get(self.text_field)
            out.append((self.roles.get(role, role), "" if text is None else str(text)))
        return out


LAYOUTS = (
    Layout("messages", items="messages"),
    Layout("from_value", items="conversations", role_field="from", text_field="value",
           roles={"human": "user", "gpt": "assistant"}),
    Layout("turn", items="", text_field="text"),
    Layout("prompt_completion", fields=(("prompt", "user"), ("completion", "assistant"))),
    Layout("instruction", fields=(("system", "system"), ("instruction", "user"), ("input", "user"), ("output", "assistant"))),
)


_KEY = re.compile(r"[\\.\[\]]")
_LONE = re.compile("[\ud800-\udfff]")


def whole(text: str) -> str:
    """``text`` with U+FFFD for every half of a character (a surrogate without its pair)."""
    return _LONE.sub("\ufffd", text)


def path_key(key: str) -> str:
    """A key as a path has it: the signs of paths escaped, so no key looks like a path; the empty key is ``\\e``."""
    return _KEY.sub(lambda m: "\\" + m.group(), whole(key)) or "\\e"


def field_paths(value) -> set[str]:
    """The paths of a JSON value's leaves; list elements share one path, empty lists and objects are leaves."""
    out, open_ = set(), [("", value)]
    while open_:
        at, x = open_.pop()
        if isinstance(x, dict) and x:
            open_ += [(f"{at}.{path_key(k)}" if at else path_key(k), v) for k, v in x.items()]
        elif isinstance(x, list) and x:
            open_ += [(at + "[]", v) for v in x]
        else:
            out.add(at)
    return out


def fingerprint(paths) -> str:
    return hashlib.sha1("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def _table(layouts: tuple[Layout, ...]) -> dict[str, Layout]:
    return {fingerprint(s): x for x in layouts for s in x.schemas()}


def _parsed(payload: str | None):
    try:
        record = json.loads(payload) if payload else None
    except (ValueError, RecursionError):                      # no JSON, or nested beyond what the reader takes
        return None
    return record if isinstance(record, dict) else None


def canonical_turns(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(conv_id, place, sub, role, text, layout, schema) of every turn of ``records`` (conv_id, place, payload);
    a record without a known layout is one row with null layout, role and text."""
    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _table(layouts)
        for batch in batches:
            rows = []
            for conv, place, payload in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "place", "payload")]):
                record = _parsed(payload)
                mark = fingerprint(field_paths(record)) if record is not None else None
                layout = known.get(mark)
                if layout is None:
                    rows.append((conv, place, 0, None, None, None, mark))
                else:
                    rows += [(conv, place, i, whole(role), whole(text), layout.name, mark)
                             for i, (role, text) in enumerate(layout.turns(record))]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
                                             names=["conv_id", "place", "sub", "role", "text", "layout", "schema"])

    return records.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("place").cast("long").alias("place"), "payload") \
        .mapInArrow(convert, "conv_id long, place long, sub int, role string, text string, layout string, schema string")


def unknown_records(turns: DataFrame) -> DataFrame:
    return turns.where("layout is null").select("conv_id", "place", "schema")


def escaped(text: str, role: bool = False) -> str:
    return (_ROLE if role else _TEXT).sub(lambda m: "\\" + m.group(), text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def formatted(turns: DataFrame) -> DataFrame:
    """(conv_id, place, sub, segment, mask_start, mask_end): the output of each turn and the
    code points of it that the loss counts (null for turns of others)."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            segments, starts, ends = [], [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                head, body = f"### {escaped(role or '', True)}: ", escaped(text or "")
                segments.append(f"{head}{body}</turn>\n")
                learns = role == ASSISTANT
                starts.append(len(head) if learns else None)
                ends.append(len(head) + len(body) if learns else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("place"), batch.column("sub"), pa.array(segments, pa.string()),
                 pa.array(starts, pa.int64()), pa.array(ends, pa.int64())],
                names=["conv_id", "place", "sub", "segment", "mask_start", "mask_end"])

    return turns.where("layout is not null").select("conv_id", "place", "sub", "role", "text").mapInArrow(
        write, "conv_id long, place long, sub int, segment string, mask_start long, mask_end long")


def parsed_segment(segment: str) -> tuple[str, str]:
    """Role and text of a turn's output."""
    m = _SEGMENT.fullmatch(segment)
    if m is None:
        raise ValueError("not the output of one turn")
    return unescaped(m[1]), unescaped(m[2])


class _Digest:
    def __init__(self, conv_id):
        self.conv_id, self.n_turns, self.loss_chars, self.formatted_chars = conv_id, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, start: int | None, end: int | None) -> None:
        role, text = parsed_segment(segment)
        self.turns.update(f"{role}\n{text}\n".encode())
        self.n_turns += 1
        self.formatted_chars += len(segment)
        if start is not None:
            masked = unescaped(segment[start:end])
            self.loss.update(masked.encode())
            self.loss_chars += len(masked)

    def row(self) -> tuple:
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(rows):
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)

    now: _Digest | None = None
    for batch in batches:
        done = []
        for conv, segment, start, end in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "segment", "mask_start", "mask_end")]):
            if now is None or now.conv_id != conv:
                if now is not None:
                    done.append(now.row())
                now = _Digest(conv)
            now.add(segment, start, end)
        yield out(done)
    if now is not None:
        yield out([now.row()])


def read_back(segments: DataFrame) -> DataFrame:
    """Counts and digests of every conversation, from the formatted output alone."""
    rows = segments.repartition("conv_id").sortWithinPartitions("conv_id", "place", "sub", "segment")
    return rows.select("conv_id", "segment", "mask_start", "mask_end").mapInArrow(
        _read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
