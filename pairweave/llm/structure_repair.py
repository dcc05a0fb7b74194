"""Conversation structure repair: the cheapest edits that make roles alternate, with an audit trail.

The roles of a repaired conversation are an optional system turn and then user and assistant turns in pairs (by first
letters ``(s?(ua)+)?``). Each row is kept (0), given the role that fits (2) or deleted (3, a must for blank and repeated
rows); a turn with empty text may be inserted anywhere (2); a truncated row that stays adds 1. Of the cheapest edits the
ones whose letters (D, I, K, R) come first in ASCII order are taken; the letters settle every role.

*Method.* Rank-convergence parallel Viterbi, backwards: the costs to the end, one for each of four states, follow from
those one row later. A conversation of one chunk is solved where it lies. Of longer ones every span (a run of chunks,
one byte per row) first starts from a speculative cost vector; in fix-up passes a span whose successor came out
differently runs again, and stops as soon as its vector differs from the last run's only by a constant, as all vectors
before then do too. Passes end when no span changes: the stitched vectors are then exact up to constants, which is all
that tracing needs. The trace runs forward and takes the least letter that loses nothing; spans trace from each entry state
and the actual ones follow from composing those few numbers.

Vectors without their constants are few, so a step is one dictionary lookup.

Defined cases: rows come by turn, nulls first, then by role and text; a null role or text is one blank; a null ``conv_id``
is a conversation; a row is a duplicate where role and text were seen earlier in the conversation, whatever its turn;
a row's first fault of blank, duplicate, truncated counts; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairweave.llm.turns import CHUNK_BYTES, CHUNK_ROWS, chunk_turns
from pairweave.operators.numbering import number_rows
from pairweave.session import remove, rewrite

#: Chunks in a span: with chunks of 1,024 rows, 4 MB of codes.
SPAN_CHUNKS = 4096
BLANKS = " \t\n\x0b\x0c\r"

# States: nothing yet, after a system turn, after a user turn, after an assistant turn.
_FITTING = (2, 2, 3, 2)
_KEPT = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}
_ROLE = {2: "user", 3: "assistant"}
#: Cost of what is inserted after the last row, by state.
END = (0, 4, 2, 0)
_TAIL = ("", "II", "I", "")
# Row codes: the initial (s, u, a, other), plus 4 where truncated; duplicates and blanks are deleted whatever they say.
_INITIAL = {"s": 0, "u": 1, "a": 2}
_DUPLICATE, _BLANK = 8, 9


@lru_cache(None)
def _costs(code: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs before a row out of the costs after it, inserts before the row included."""
    best = [3 + c for c in after]
    if code < _DUPLICATE:
        for q in range(4):
            cut = code >> 2
            best[q] = min(best[q], 2 + cut + after[_FITTING[q]])
            if (q, code & 3) in _KEPT:
                best[q] = min(best[q], cut + after[_KEPT[q, code & 3]])
    return tuple(min(best[q], 2 + best[_FITTING[q]], 4 + best[_FITTING[_FITTING[q]]]) for q in range(4))


@lru_cache(None)
def back(code: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """``_costs`` less the least of them."""
    costs = _costs(code, after)
    return tuple(c - min(costs) for c in costs)


@lru_cache(None)
def step(code: int, after: tuple[int, ...], state: int) -> tuple[str, int, int]:
    """The least letters that take a row from a state at least cost, the state after it, and what they cost."""
    before, letters, spent = _costs(code, after), "", 0
    while True:
        if 3 + after[state] == before[state]:
            return letters + "D", state, spent + 3
        if 2 + before[_FITTING[state]] == before[state]:
            letters, state, spent = letters + "I", _FITTING[state], spent + 2
            continue
        cut, kept = code >> 2, _KEPT.get((state, code & 3))
        if kept is not None and cut + after[kept] == before[state]:
            return letters + "K", kept, spent + cut
        return letters + "R", _FITTING[state], spent + 2 + cut


def vectors(codes: bytes, after: tuple[int, ...]) -> list[tuple[int, ...]]:
    """The cost vector after each row, and before the first one in front; the last is ``after``."""
    out = [after]
    for code in reversed(codes):
        after = back(code, after)
        out.append(after)
    out.reverse()
    return out


def run_back(codes: bytes, after: tuple[int, ...], known: tuple[tuple[int, ...], tuple[int, ...]] | None = None) -> tuple[int, ...]:
    """The vector before the first row. ``known`` is the last run's ``(after, result)``: where the two runs meet, the rest is the same."""
    if known is None:
        for code in reversed(codes):
            after = back(code, after)
        return after
    other, result = known
    for code in reversed(codes):
        if after == other:
            return result
        after, other = back(code, after), back(code, other)
    return after


def trace(codes: bytes, costs: list[tuple[int, ...]], state: int) -> tuple[str, int, int]:
    """Letters, last state and cost of rows whose vectors are known."""
    letters, spent = [], 0
    for code, after in zip(codes, costs[1:]):
        said, state, cost = step(code, after, state)
        letters.append(said)
        spent += cost
    return "".join(letters), state, spent


def apply_edits(audit: str, state: int, roles: list[str], texts: list[str]) -> tuple[list[str], list[str]]:
    """Roles and texts after the edits of a stretch that is entered in ``state``."""
    new_roles, new_texts, row = [], [], 0
    for letter in audit:
        if letter == "I":
            state = _FITTING[state]
            new_roles.append(_ROLE[state])
            new_texts.append("")
            continue
        if letter != "D":
            state = _KEPT[state, _INITIAL.get(roles[row][:1], 3)] if letter == "K" else _FITTING[state]
            new_roles.append(roles[row] if letter == "K" else _ROLE[state])
            new_texts.append(texts[row])
        row += 1
    return new_roles, new_texts


def codes_of(roles: list[str], texts: list[str]) -> tuple[bytearray, dict[int, bytes]]:
    """Codes of consecutive rows, and the digest of each row that is neither blank nor a repeat within them."""
    codes, first, seen = bytearray(), {}, set()
    for row, (role, text) in enumerate(zip(roles, texts)):
        shown = text.rstrip(BLANKS)
        if not shown:
            codes.append(_BLANK)
            continue
        digest = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        if digest in seen:
            codes.append(_DUPLICATE)
            continue
        seen.add(digest)
        first[row] = digest
        codes.append(_INITIAL.get(role[:1], 3) + 4 * (shown[-1] not in ".!?"))
    return codes, first


def _facts(codes: bytes, roles: list[str], turns: list[int | None]) -> dict:
    """What a stretch contributes to the report on its conversation."""
    initials = [r[:1] for r in roles]
    numbers = [t for t in turns if t is not None]
    return {
        "blank": codes.count(_BLANK), "duplicate": codes.count(_DUPLICATE), "truncated": sum(4 <= c < _DUPLICATE for c in codes),
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "first_initial": initials[0], "last_initial": initials[-1],
        "first_turn": min(numbers, default=None), "last_turn": max(numbers, default=None), "n_turns": len(set(numbers)),
    }


_PIECE = pa.schema([
    ("conv_key", pa.string()), ("conv_id", pa.int64()), ("place", pa.int64()), ("audit", pa.string()), ("roles", pa.list_(pa.string())),
    ("texts", pa.list_(pa.string())), ("cost", pa.int64()), *[(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")],
    ("first_initial", pa.string()), ("last_initial", pa.string()), *[(c, pa.int64()) for c in ("first_turn", "last_turn", "n_turns")],
])
PIECES = (
    "conv_key string, conv_id bigint, place bigint, audit string, roles array<string>, texts array<string>, cost bigint, blank bigint, duplicate bigint, "
    "truncated bigint, illegal bigint, first_initial string, last_initial string, first_turn bigint, last_turn bigint, n_turns bigint"
)


def _spoken(values: list[str | None]) -> list[str]:
    return [" " if v is None else v for v in values]


def _piece(row: dict, place: int, codes: bytes, audit: str, state: int, cost: int) -> dict:
    roles, texts = _spoken(row["roles"]), _spoken(row["texts"])
    new_roles, new_texts = apply_edits(audit, state, roles, texts)
    facts = _facts(codes, roles, row["turns"])
    return {"conv_key": row["conv_key"], "conv_id": row["conv_id"], "place": place, "audit": audit, "roles": new_roles, "texts": new_texts, "cost": cost} | facts


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations of one chunk."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            codes, _ = codes_of(_spoken(row["roles"]), _spoken(row["texts"]))
            costs = vectors(codes, END)
            audit, state, cost = trace(codes, costs, 0)
            rows.append(_piece(row, 0, codes, audit + _TAIL[state], 0, cost + 2 * len(_TAIL[state])))
        yield pa.RecordBatch.from_pylist(rows, _PIECE)


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(conv_key, part, seq, codes, rows, digests)`` of chunks."""
    for batch in batches:
        coded = [codes_of(_spoken(r), _spoken(t)) for r, t in zip(batch.column("roles").to_pylist(), batch.column("texts").to_pylist())]
        columns = {c: batch.column(c) for c in ("conv_key", "part", "seq")}
        columns["codes"] = pa.array([bytes(c) for c, _ in coded], pa.binary())
        columns["digests"] = pa.array([[{"row": i, "digest": d} for i, d in first.items()] for _, first in coded], pa.list_(pa.struct([("row", pa.int32()), ("digest", pa.binary())])))
        yield pa.RecordBatch.from_pydict(columns)


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Codes with the rows that repeat a row of an earlier chunk."""
    for batch in batches:
        codes = [bytearray(c) for c in batch.column("codes").to_pylist()]
        for own, rows in zip(codes, batch.column("repeats").to_pylist()):
            for row in rows or ():
                own[row] = _DUPLICATE
        columns = {c: batch.column(c) for c in ("conv_key", "part", "seq", "place")}
        yield pa.RecordBatch.from_pydict(columns | {"codes": pa.array([bytes(c) for c in codes], pa.binary())})


def _run_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans with their vectors; one runs (again) where ``wanted`` is not the vector it ran from."""
    for batch in batches:
        rows = batch.to_pylist()
        for row in rows:
            wanted = tuple(row.pop("wanted") or END)
            row["changed"] = False
            if row["after"] is None or wanted != tuple(row["after"]):
                known = None if row["after"] is None else (tuple(row["after"]), tuple(row["before"]))
                before = list(run_back(b"".join(row["codes"]), wanted, known))
                row.update(changed=before != row["before"], after=list(wanted), before=before)
        yield pa.RecordBatch.from_pylist(rows, _SPAN)


_SPAN = pa.schema([
    ("conv_key", pa.string()), ("span", pa.int64()), ("codes", pa.list_(pa.binary())), ("after", pa.list_(pa.int32())),
    ("before", pa.list_(pa.int32())), ("changed", pa.bool_()),
])
_SPANS = "conv_key string, span bigint, codes array<binary>, after array<int>, before array<int>, changed boolean"


def _converge(spans: DataFrame) -> tuple[DataFrame, str]:
    """Fix-up passes over ``(conv_key, span, codes)`` until no vector changes. Returns the spans and their path."""
    spark = spans.sparkSession
    none = F.lit(None).cast("array<int>")
    state, path = rewrite(spans.select("*", none.alias("after"), none.alias("before"), none.alias("wanted")).mapInArrow(_run_spans, _SPANS), "spans")
    while state.filter("changed and span > 0").limit(1).count():
        following = state.select("conv_key", (F.col("span") - 1).alias("span"), F.col("before").alias("wanted"))
        state, new = rewrite(state.drop("changed").join(following, ["conv_key", "span"], "left").mapInArrow(_run_spans, _SPANS), "spans")
        remove(spark, path)
        path = new
    return state, path


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in which each span is left, by the state it is entered in."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            codes = b"".join(row["codes"])
            costs = vectors(codes, tuple(row["after"]))
            rows.append([trace(codes, costs, q)[1] for q in range(4)])
        columns = {c: batch.column(c) for c in ("conv_key", "span")} | {"exits": pa.array(rows, pa.list_(pa.int32()))}
        yield pa.RecordBatch.from_pydict(columns)


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where each span of a conversation is entered: ``(conv_key, entries)``."""
    for batch in batches:
        entries = []
        for exits in batch.column("exits").to_pylist():
            states = [0]
            for e in exits[:-1]:
                states.append(e["exits"][states[-1]])
            entries.append(states)
        yield pa.RecordBatch.from_pydict({"conv_key": batch.column("conv_key"), "entries": pa.array(entries, pa.list_(pa.int32()))})


_TRACED = pa.schema([("conv_key", pa.string()), ("place", pa.int64()), ("codes", pa.binary()), ("state", pa.int32()), ("audit", pa.string()), ("cost", pa.int64())])


def _trace_spans(span_chunks: int):
    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rows, at, state = [], 0, row["entry"]
                costs = vectors(b"".join(row["codes"]), tuple(row["after"]))
                for i, codes in enumerate(row["codes"]):
                    audit, left, cost = trace(codes, costs[at : at + len(codes) + 1], state)
                    if row["last"] and i == len(row["codes"]) - 1:
                        audit, cost = audit + _TAIL[left], cost + 2 * len(_TAIL[left])
                    rows.append({"conv_key": row["conv_key"], "place": row["span"] * span_chunks + i, "codes": codes, "state": state, "audit": audit, "cost": cost})
                    at, state = at + len(codes), left
                yield pa.RecordBatch.from_pylist(rows, _TRACED)

    return traced


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_pylist([_piece(r, r["place"], r["codes"], r["audit"], r["state"], r["cost"]) for r in batch.to_pylist()], _PIECE)


def _solve_long(chunks: DataFrame, span_chunks: int) -> DataFrame:
    """Conversations that may have several chunks."""
    digests = "array<struct<row:int,digest:binary>>"
    coded = chunks.select("conv_key", "part", "seq", "roles", "texts").mapInArrow(_encode, f"conv_key string, part int, seq bigint, codes binary, digests {digests}")
    coded, _ = rewrite(coded, "coded")
    placed, _ = rewrite(number_rows(coded, ["conv_key"], "part", ["seq"], "place"), "placed")
    said = placed.select("conv_key", "place", F.explode("digests").alias("d")).select("conv_key", "place", "d.row", "d.digest")
    first = said.groupBy("conv_key", "digest").agg(F.min("place").alias("first"))
    again = said.join(first, ["conv_key", "digest"]).filter("place > first").groupBy("conv_key", "place").agg(F.collect_list("row").alias("repeats"))
    marked = placed.join(again, ["conv_key", "place"], "left").mapInArrow(_marked, "conv_key string, part int, seq bigint, place bigint, codes binary")
    marked, _ = rewrite(marked, "marked")
    span = F.floor(F.col("place") / span_chunks).alias("span")
    spans = marked.groupBy("conv_key", span).agg(F.array_sort(F.collect_list(F.struct("place", "codes"))).alias("c")).select("conv_key", "span", "c.codes")
    state, _ = _converge(spans)
    exits = state.select("conv_key", "span", "codes", "after").mapInArrow(_exits, "conv_key string, span bigint, exits array<int>")
    gathered = exits.groupBy("conv_key").agg(F.array_sort(F.collect_list(F.struct("span", "exits"))).alias("exits"))
    entered = gathered.mapInArrow(_compose, "conv_key string, entries array<int>").select("conv_key", F.size("entries").alias("n"), F.posexplode("entries").alias("span", "entry"))
    entered = entered.select("conv_key", F.col("span").cast("bigint").alias("span"), "entry", (F.col("span") == F.col("n") - 1).alias("last"))
    traced = state.select("conv_key", "span", "codes", "after").join(entered, ["conv_key", "span"])
    traced = traced.mapInArrow(_trace_spans(span_chunks), "conv_key string, place bigint, codes binary, state int, audit string, cost bigint")
    texts = chunks.join(marked.select("conv_key", "part", "seq", "place"), ["conv_key", "part", "seq"])
    return texts.join(traced, ["conv_key", "place"]).mapInArrow(_finish, PIECES)


def repair_parts(turns: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES, span_chunks: int = SPAN_CHUNKS) -> tuple[DataFrame, DataFrame]:
    """Repaired conversations that are one row each, and the rows of all others, ordered by ``(conv_key, place)``."""
    chunks, _ = rewrite(chunk_turns(turns, chunk_rows, chunk_bytes), "chunks")
    return chunks.filter(~F.col("edge")).mapInArrow(_solve, PIECES), _solve_long(chunks.filter("edge"), span_chunks)


def repair_conversations(turns: DataFrame) -> DataFrame:
    """Repaired conversations, a row for each bounded stretch: roles and texts after the edits, the audit, its cost, and fault counts."""
    alone, split = repair_parts(turns)
    return alone.unionByName(split)


_REPORT = pa.schema([
    ("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()), ("repaired_sha256", pa.string()),
])
REPORT = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


class _Running:
    """The report on one conversation while its stretches come by."""

    def __init__(self, conv_id: int | None):
        self.sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)
        self.conv_id, self.audit, self.said, self.lines = conv_id, [], hashlib.sha256(), 0
        self.low = self.high = self.initial = None
        self.distinct = 0

    def add(self, piece: dict) -> None:
        for c in self.sums:
            self.sums[c] += piece[c]
        if self.initial is not None:
            self.sums["illegal"] += self.initial + piece["first_initial"] not in ("su", "ua", "au")
        self.initial = piece["last_initial"]
        if piece["first_turn"] is not None:
            self.distinct += piece["n_turns"] - (self.high == piece["first_turn"])
            self.low, self.high = piece["first_turn"] if self.low is None else self.low, piece["last_turn"]
        self.audit.append(piece["audit"])
        for role, text in zip(piece["roles"], piece["texts"]):
            self.said.update(("\n" * (self.lines > 0) + f"{role}:{text}").encode())
            self.lines += 1

    def done(self) -> dict:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return {"conv_id": self.conv_id, "gaps": gaps, "audit": "".join(self.audit), "repaired_sha256": self.said.hexdigest()} | self.sums


def repair_report(alone: DataFrame, split: DataFrame) -> DataFrame:
    """One row per conversation: gaps between turn numbers, faults, cost, audit and a digest of the repaired text.

    Takes the two results of ``repair_parts``. Only the second is dealt by conversation; a task reads it in order and holds
    one batch of stretches and the letters of one audit.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, running = None, None
        for batch in batches:
            rows = []
            for piece in batch.to_pylist():
                if piece["conv_key"] != key:
                    if running:
                        rows.append(running.done())
                    key, running = piece["conv_key"], _Running(piece["conv_id"])
                running.add(piece)
            yield pa.RecordBatch.from_pylist(rows, _REPORT)
        if running:
            yield pa.RecordBatch.from_pylist([running.done()], _REPORT)

    ordered = split.repartition("conv_key").sortWithinPartitions("conv_key", "place")
    return alone.mapInArrow(read, REPORT).unionByName(ordered.mapInArrow(read, REPORT))
