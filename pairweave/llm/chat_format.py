"""Chat formatting: records of many layouts to canonical turns, and turns to one marked text with a loss mask.

*Layouts.* The fingerprint of a record is a hash of the nested field paths it fills (``messages[].role``). Only paths that
some mapping names enter it, so other fields are metadata. A declarative mapping lists the paths it needs and those it
may have, and how they become turns; the fingerprint selects it by one lookup. ``canonical_turns`` reads JSON records of
mixed layouts, ``table_turns`` reads typed columns, where fingerprints and mappings are column expressions.

*Template.* A turn is ``<turn ROLE>TEXT</turn>`` and a line break. A backslash stands before every backslash and every
control string inside a role or text, so an unescaped marker is always the template's own and parsing gives back what
was formatted, whatever the texts hold. The loss mask is the span of each trained turn's text.

Formatted conversations are rows of a bounded stretch each (see ``turns``); concatenated by ``(part, seq)`` they are the
whole conversation.

Defined cases: null roles and texts count as empty; a null ``conv_id`` is a conversation; turns come by number, nulls
first, then by role and text; repeated rows are turns of their own; a record that fits no mapping, or is no JSON object,
is returned as one row without mapping, its text being the record; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pairweave.llm.turns import CHUNK_BYTES, CHUNK_ROWS, chunk_turns


@dataclass(frozen=True)
class Mapping:
    """How one layout becomes turns.

    ``turns`` lists ``(role, path)`` with a fixed role, or ``(path of the role, path of the text)`` under one list. A role
    that starts with ``@`` is a path. Several paths joined by ``+`` give one text, their parts separated by an empty line.
    """

    name: str
    needs: frozenset[str]
    may: frozenset[str]
    turns: tuple[tuple[str, str], ...]
    roles: dict[str, str] = field(default_factory=dict, hash=False)

    def layouts(self) -> Iterator[frozenset[str]]:
        """Every set of paths that this mapping reads."""
        for n in range(len(self.may) + 1):
            for extra in itertools.combinations(sorted(self.may), n):
                yield self.needs | set(extra)


def mapping(name: str, needs: str, may: str, *turns: tuple[str, str], roles: dict[str, str] | None = None) -> Mapping:
    """A mapping out of path lists separated by blanks."""
    return Mapping(name, frozenset(needs.split()), frozenset(may.split()), turns, roles or {})


_SPEAKERS = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "chatgpt": "assistant"}
MAPPINGS = [
    mapping("messages", "messages[].role messages[].content", "system messages[].content[].text", ("system", "system"), ("@messages[].role", "messages[].content"), roles=_SPEAKERS),
    mapping("messages_parts", "messages[].role messages[].content[].text", "system", ("system", "system"), ("@messages[].role", "messages[].content"), roles=_SPEAKERS),
    mapping("no_messages", "messages[]", "system", ("system", "system")),
    mapping("conversations", "conversations[].from conversations[].value", "system", ("system", "system"), ("@conversations[].from", "conversations[].value"), roles=_SPEAKERS),
    mapping("prompt_completion", "prompt completion", "system", ("system", "system"), ("user", "prompt"), ("assistant", "completion")),
    mapping("prompt_response", "prompt response", "system", ("system", "system"), ("user", "prompt"), ("assistant", "response")),
    mapping("instruction", "instruction output", "input system", ("system", "system"), ("user", "instruction+input"), ("assistant", "output")),
    mapping("question_answer", "question answer", "context system", ("system", "system"), ("user", "context+question"), ("assistant", "answer")),
    mapping("turn", "", "role text", ("@role", "text")),
]


def hash_paths(paths: frozenset[str] | set[str]) -> str:
    """The fingerprint of a set of field paths."""
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def registry(mappings: list[Mapping]) -> dict[str, Mapping]:
    """Mappings by fingerprint; an error where two claim one layout."""
    found: dict[str, Mapping] = {}
    for m in mappings:
        for layout in m.layouts():
            if found.setdefault(hash_paths(layout), m) is not m:
                raise ValueError(f"{m.name} and {found[hash_paths(layout)].name} read the same layout")
    return found


def known_paths(mappings: list[Mapping]) -> frozenset[str]:
    """Every path that a mapping names."""
    return frozenset().union(*(m.needs | m.may for m in mappings))


def filled_paths(value: object, at: str = "") -> set[str]:
    """Paths of the fields that are not null; ``[]`` stands for any place of a list, a list without filled fields is a path itself."""
    if isinstance(value, dict):
        return set().union(*(filled_paths(v, f"{at}.{k}" if at else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union(*(filled_paths(v, f"{at}[]") for v in value)) or {f"{at}[]"}
    return set() if value is None else {at}


def _plain(value: object) -> str:
    """The text of a field: strings as they are, parts of a message one after the other, other values as JSON."""
    if isinstance(value, list) and all(isinstance(p, dict) for p in value):
        return "".join(_plain(p.get("text")) for p in value)
    return value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False)


def _at(record: object, path: str) -> object:
    for name in path.split("."):
        record = record.get(name) if isinstance(record, dict) else None
    return record


def read_record(record: dict, m: Mapping) -> list[tuple[str, str]]:
    """``(role, text)`` of the turns that a mapping finds."""
    turns = []
    for role, path in m.turns:
        if role.startswith("@") and "[]." in role:
            items, own = role[1:].split("[].", 1)
            text = path.split("[].", 1)[1]
            said = [(_plain(_at(x, own)), _plain(_at(x, text))) for x in _at(record, items) or []]
        elif role.startswith("@"):
            said = [(_plain(_at(record, role[1:])), _plain(_at(record, path)))]
        else:
            parts = [x for p in path.split("+") if (x := _at(record, p)) is not None]
            said = [(role, "\n\n".join(filter(None, map(_plain, parts))))] if parts else []
        turns += [(m.roles.get(r, r), t) for r, t in said]
    return turns


_TURNS = "conv_id bigint, turn bigint, role string, text string, fingerprint string, mapping string"
_TURN_ROW = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), *[(c, pa.string()) for c in ("role", "text", "fingerprint", "mapping")]])


def canonical_turns(records: DataFrame, mappings: list[Mapping] = MAPPINGS) -> DataFrame:
    """``(conv_id, turn, role, text, fingerprint, mapping)`` out of ``records`` (``conv_id, record``), JSON of any known layout."""
    chosen, known = registry(mappings), known_paths(mappings)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv_id, raw in zip(*(c.to_pylist() for c in batch.columns)):
                try:
                    record = json.loads(raw or "")
                except ValueError:
                    record = None
                paths = filled_paths(record) & known if isinstance(record, dict) else set()
                mark = hash_paths(paths) if paths else None
                if m := chosen.get(mark):
                    rows += [(conv_id, i, role, text, mark, m.name) for i, (role, text) in enumerate(read_record(record, m))]
                else:
                    rows.append((conv_id, None, None, raw, mark, None))
            yield pa.RecordBatch.from_pylist([dict(zip(_TURN_ROW.names, r)) for r in rows], _TURN_ROW)

    return records.select(F.col("conv_id").cast("bigint"), F.col("record").cast("string")).mapInArrow(read, _TURNS)


def table_turns(df: DataFrame, mappings: list[Mapping] = MAPPINGS) -> DataFrame:
    """``canonical_turns`` of a table with one turn in a row (``conv_id, turn`` and flat string columns); nothing leaves the JVM."""
    columns = {c.lower(): c for c in df.columns}
    paths = sorted(p for p in known_paths(mappings) if p in columns)
    filled = F.concat_ws("\n", *[F.when(F.col(f"`{columns[p]}`").isNotNull(), F.lit(p)) for p in paths])
    mark = F.substring(F.sha2(filled.cast("binary"), 256), 1, 16)
    rows = [m for m in mappings if all(r.startswith("@") and "[]" not in r for r, _ in m.turns)]

    def chosen(value: Column | None, of: Mapping, otherwise: Column | None) -> Column | None:
        marks = [hash_paths(x) for x in of.layouts() if x <= set(paths)]
        hit = F.when(F.col("fingerprint").isin(marks), value)
        return hit if otherwise is None else hit.otherwise(otherwise)

    take = lambda path: F.coalesce(F.col(f"`{columns[path]}`").cast("string"), F.lit("")) if path in columns else F.lit("")
    role = text = name = None
    for m in rows:
        (said, path), spoken = m.turns[0], None
        spoken = take(said[1:])
        for old, new in m.roles.items():
            spoken = F.when(take(said[1:]) == old, new).otherwise(spoken)
        role, text, name = chosen(spoken, m, role), chosen(take(path), m, text), chosen(F.lit(m.name), m, name)
    marked = df.withColumn("fingerprint", mark)
    return marked.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), role.alias("role"), text.alias("text"), "fingerprint", name.alias("mapping"))


@dataclass(frozen=True)
class Template:
    """Markers of a turn, further strings to escape, and the role whose texts are trained on."""

    begin: str = "<turn "
    role_end: str = ">"
    end: str = "</turn>"
    others: tuple[str, ...] = ("### ", "<|")
    trained: str = "assistant"

    def escape(self, text: str, *more: str) -> str:
        """A backslash before each backslash and each control string."""
        text = text.replace("\\", "\\\\")
        for control in (self.begin, self.end, *self.others, *more):
            text = text.replace(control, "\\" + control)
        return text

    @staticmethod
    def unescape(text: str) -> str:
        """The inverse of ``escape``."""
        return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text

    def format(self, turns: list[tuple[str | None, str | None]]) -> tuple[str, list[tuple[int, int]]]:
        """The marked text of turns, and the spans of it under the loss mask, in code points."""
        pieces, spans, at = [], [], 0
        for role, text in turns:
            head, body = self.begin + self.escape(role or "", self.role_end) + self.role_end, self.escape(text or "")
            if role == self.trained:
                spans.append((at + len(head), at + len(head) + len(body)))
            pieces += [head, body, self.end, "\n"]
            at += len(head) + len(body) + len(self.end) + 1
        return "".join(pieces), spans

    def _closing(self, text: str, marker: str, at: int) -> int:
        """Where the next marker that no backslash escapes begins."""
        while (found := text.index(marker, at)) >= 0:
            escapes = found
            while escapes > at and text[escapes - 1] == "\\":
                escapes -= 1
            if (found - escapes) % 2 == 0:
                return found
            at = found + 1
        raise ValueError("no end marker")

    def parse(self, text: str) -> list[tuple[str, str]]:
        """The turns of a marked text; an error where it is none."""
        turns, at = [], 0
        while at < len(text):
            if not text.startswith(self.begin, at):
                raise ValueError(f"no turn at {at}")
            role_at = at + len(self.begin)
            role_end = self._closing(text, self.role_end, role_at)
            body = role_end + len(self.role_end)
            end = self._closing(text, self.end, body)
            turns.append((self.unescape(text[role_at:role_end]), self.unescape(text[body:end])))
            at = end + len(self.end) + 1
        return turns


FORMATTED = "conv_key string, conv_id bigint, part int, seq bigint, edge boolean, n_turns bigint, formatted string, loss array<struct<start:bigint,end:bigint>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_PLACE = ("conv_key", "conv_id", "part", "seq", "edge")


def format_chats(turns: DataFrame, template: Template = Template(), chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Marked texts of canonical turns, a row for each bounded stretch of a conversation, with the loss mask of the stretch."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [template.format(list(zip(r, t))) for r, t in zip(batch.column("roles").to_pylist(), batch.column("texts").to_pylist())]
            columns = {c: batch.column(c) for c in _PLACE} | {
                "n_turns": pa.array([len(r) for r in batch.column("roles").to_pylist()], pa.int64()),
                "formatted": pa.array([text for text, _ in done], pa.string()),
                "loss": pa.array([[{"start": a, "end": b} for a, b in spans] for _, spans in done], _SPANS),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return chunk_turns(turns, chunk_rows, chunk_bytes).mapInArrow(write, FORMATTED)


DIGEST = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
_DIGEST_ROW = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
])


class _Running:
    """Sums and digests of one conversation while its stretches come by."""

    def __init__(self, conv_id: int | None):
        self.row = {"conv_id": conv_id, "n_turns": 0, "loss_chars": 0, "formatted_chars": 0}
        self.said, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, spans: list[dict], template: Template) -> None:
        for role, words in template.parse(text):
            self.said.update(f"{role}\n{words}\n".encode())
            self.row["n_turns"] += 1
        for span in spans:
            trained = template.unescape(text[span["start"] : span["end"]])
            self.loss.update(trained.encode())
            self.row["loss_chars"] += len(trained)
        self.row["formatted_chars"] += len(text)

    def done(self) -> dict:
        return self.row | {"turns_sha256": self.said.hexdigest(), "loss_sha256": self.loss.hexdigest()}


def chat_digest(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation out of written texts: they are parsed, and the loss mask is cut out of them.

    A conversation in one row is summed up where it lies. The others are dealt by conversation and read in order, row by
    row; a task holds one batch of rows and two running digests, however long the conversation is.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, running = None, None
        for batch in batches:
            rows = []
            for part in batch.to_pylist():
                if part["conv_key"] != key:
                    if running:
                        rows.append(running.done())
                    key, running = part["conv_key"], _Running(part["conv_id"])
                running.add(part["formatted"], part["loss"], template)
            yield pa.RecordBatch.from_pylist(rows, _DIGEST_ROW)
        if running:
            yield pa.RecordBatch.from_pylist([running.done()], _DIGEST_ROW)

    parts = formatted.select(*_PLACE, "formatted", "loss")
    alone = parts.filter(~F.col("edge")).mapInArrow(read, DIGEST)
    split = parts.filter("edge").repartition("conv_key").sortWithinPartitions("conv_key", "part", "seq").mapInArrow(read, DIGEST)
    return alone.unionByName(split)
