"""LM scoring: a Katz backoff model with Good-Turing discounts, counted, stored and evaluated over all documents.

Tokens of a document are its words (ASCII letters in lower case) and one end token; histories start with a begin token.
``p_n(w | h) = d(c) c(hw) / (c(h) + RESERVED)`` where ``hw`` was seen in training, else ``alpha(h) p_(n-1)(w | shorter h)``;
a history that was never seen gives ``p_(n-1)``. ``d`` is Katz' Good-Turing discount for counts up to five and one above.
``alpha(h) = (1 - sum of the seen p_n) / (1 - sum of their p_(n-1))``, so every history sums to exactly one. Below the words
stands one unknown word, which has the mass that the unigrams leave. ``RESERVED`` is a tenth of a count, so that a history
of only frequent followers leaves some mass too.

Per order there are two rounds over the stored blocks. In the first every block asks once for each distinct n-gram it
holds, with its count in training documents; the bucket of the n-gram answers with the total and makes one block its owner.
In the second the owners add what their n-grams free and cover, per history, and blocks get the backoff weight of the
histories they need. Both tables are stored by order and bucket: ``counts`` (keys, counts) and ``backoff`` (keys, weights),
keys being 64-bit hashes. Every n-gram counts; nothing is pruned, and what is exchanged grows with the corpus.

Defined cases: null and empty texts are one end token. Rows that share an id are documents of their own; a null id is a
training document. Without any training document every token is the unknown word, whose probability is one. Empty tables
give no rows. Only the id and the text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairweave.llm.blocks import Block, blocks_in, dealt, pack_counts, pack_keys, store_blocks, unpack_counts, unpack_keys
from pairweave.llm.words import mix, words_of
from pairweave.session import scratch_path

#: Largest count that Good-Turing discounts.
DISCOUNTED = 5
RESERVED = 0.1
_END, _BEGIN = np.uint64(0x0E4D), np.uint64(0xBE61)
_SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
_COUNTED = pa.schema(
    [("kind", pa.string()), ("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())]
    + [("owned", pa.binary()), ("size", pa.int32()), ("stats", pa.list_(pa.int64()))]
)
_WEIGHED = pa.schema([("kind", pa.string()), ("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("weights", pa.binary())])
# The same schemas as Spark names them.
_COUNTED_TABLE = "kind string, bucket int, block bigint, keys binary, counts binary, owned binary, size int, stats array<bigint>"
_WEIGHED_TABLE = "kind string, bucket int, block bigint, keys binary, weights binary"


def is_held_out(doc_id: int | None) -> bool:
    """Whether a document is kept out of training."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def good_turing(of_count: list[int]) -> np.ndarray:
    """``d`` for counts 0 to ``DISCOUNTED``; ``of_count[r - 1]`` n-grams have count ``r``, for ``r`` up to ``DISCOUNTED + 1``.

    Where the counts of counts give no discount between zero and one (little data), absolute discounting takes its place.
    """
    n = [0, *of_count]
    common = (DISCOUNTED + 1) * n[DISCOUNTED + 1] / n[1] if n[1] else 1.0
    d = [1.0]
    for r in range(1, DISCOUNTED + 1):
        ratio = (r + 1) * n[r + 1] / (r * n[r]) if n[r] else 0.0
        d.append((ratio - common) / (1 - common) if common < 1 else 0.0)
    if not all(0 < x <= 1 for x in d):
        off = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] and n[2] else 0.5
        d = [1.0, *[(r - off) / r for r in range(1, DISCOUNTED + 1)]]
    return np.array(d)


@dataclass
class Model:
    """What the driver knows: totals and discounts, a few numbers per order."""

    discounts: list[np.ndarray] = field(default_factory=list)
    tokens: int = 0
    types: int = 0
    documents: int = 0
    unknown: float = 1.0

    def discounted(self, order: int, counts: np.ndarray) -> np.ndarray:
        """``d(c) c``."""
        return counts * self.discounts[order - 1][np.where(counts <= DISCOUNTED, counts, 0)]

    def add_order(self, stats: list[int]) -> None:
        """``stats``: tokens, types, and how many n-grams have each count up to ``DISCOUNTED + 1``."""
        self.discounts.append(good_turing(stats[2:]))
        if len(self.discounts) == 1:
            self.tokens, self.types = stats[0], stats[1]
            freed = sum((1 - self.discounts[0][r]) * r * stats[1 + r] for r in range(1, DISCOUNTED + 1))
            self.unknown = (freed + RESERVED) / (self.tokens + RESERVED)


class Tokens:
    """The tokens of a block and, order by order, what is known about them."""

    def __init__(self, block: Block):
        words = words_of([t.lower() for t in block.texts])
        self.ids = block.ids
        self.sizes = np.diff(words.first) + 1
        self.events = np.insert(words.hashes(), words.first[1:], _END)
        self.begins = np.concatenate(([0], np.cumsum(self.sizes)[:-1]))
        self.held_out = np.array([is_held_out(i) for i in block.ids], bool)
        self.grams = self.events
        self.history = np.zeros(0, np.uint64)

    @property
    def text(self) -> np.ndarray:
        """The document of each token."""
        return np.repeat(np.arange(len(self.sizes)), self.sizes)

    @property
    def training(self) -> np.ndarray:
        """Whether each token is learnt from."""
        return np.repeat(~self.held_out, self.sizes)

    def previous(self, values: np.ndarray, first: object) -> np.ndarray:
        """Each token's value of the token before it; ``first`` at the beginning of a document."""
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[self.begins] = first
        return out

    def lengthen(self) -> None:
        """From n-grams to n-grams of one token more."""
        self.history = self.previous(self.grams, _BEGIN)
        with np.errstate(over="ignore"):
            self.grams = mix(self.history * np.uint64(0x9E3779B97F4A7C15) + self.events)


def counted_answers(answers: list[dict] | None) -> tuple[np.ndarray, np.ndarray]:
    """Counts and ownership of a block's distinct n-grams, in order of their keys."""
    answers = sorted(answers or [], key=lambda a: a["bucket"])
    counts = [unpack_counts(a["counts"]) for a in answers]
    owned = [np.unpackbits(np.frombuffer(a["owned"], np.uint8), count=a["size"]) for a in answers]
    return np.concatenate([np.zeros(0, np.int64), *counts]).astype(np.int64), np.concatenate([np.zeros(0, np.uint8), *owned]).astype(bool)


class Evaluation:
    """Probabilities of a block's tokens under the orders whose answers have arrived."""

    def __init__(self, block: Block, model: Model):
        self.tokens, self.model = Tokens(block), model
        self.order = 0

    def count(self, answers: list[dict] | None) -> None:
        """Take the counts of the next order."""
        tokens = self.tokens
        if self.order:
            self.history_count = tokens.previous(self.counts, self.model.documents)
            tokens.lengthen()
        self.order += 1
        self.keys, self.place = np.unique(tokens.grams, return_inverse=True)
        self.distinct, self.owned = counted_answers(answers)
        self.counts = self.distinct[self.place]
        if self.order == 1:
            self.known = self.counts
            seen = self.model.discounted(1, self.counts) / (self.model.tokens + RESERVED)
            self.lower, self.probability = None, np.where(self.counts > 0, seen, self.model.unknown)
        else:
            self.lower = self.probability

    def needs(self) -> np.ndarray:
        """Tokens that back off from a history that was seen."""
        return (self.counts == 0) & (self.history_count > 0)

    def shares(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(histories, discounted counts, lower probabilities, needed)`` of owned n-grams and of backoffs, summed by history."""
        first = np.full(len(self.keys), len(self.place))
        np.minimum.at(first, self.place, np.arange(len(self.place)))
        own = first[self.owned]
        wanted = np.flatnonzero(self.needs())
        at = np.concatenate([own, wanted])
        histories, place = np.unique(self.tokens.history[at], return_inverse=True)
        n = len(own)
        total = lambda values: np.bincount(place[:n], values, len(histories))
        used = np.bincount(place[n:], minlength=len(histories)) > 0
        return histories, total(self.model.discounted(self.order, self.counts[own])), total(self.lower[own]), used

    def back_off(self, answers: list[dict] | None) -> None:
        """Take the weights of the histories that ``needs`` names, and finish the order."""
        answers = sorted(answers or [], key=lambda a: a["bucket"])
        weights = np.concatenate([np.zeros(0), *[np.frombuffer(a["weights"], np.float64) for a in answers]])
        needed, at = self.needs(), np.zeros(0, np.int64)
        if len(weights):
            at = np.searchsorted(np.unique(self.tokens.history[needed]), self.tokens.history[needed])
        seen = self.model.discounted(self.order, self.counts) / (self.history_count + RESERVED)
        self.probability = np.where(self.counts > 0, seen, self.lower)
        self.probability[needed] = weights[at] * self.lower[needed]


def _evaluated(batch: pa.RecordBatch, model: Model, orders: int) -> Iterator[Evaluation]:
    """Blocks with the answers ``count1, count2, weight2, ...`` of a batch taken, as far as there are columns."""
    for row, block in blocks_in(batch):
        found = Evaluation(block, model)
        for order in range(1, orders + 1):
            found.count(batch.column(f"count{order}")[row].as_py())
            if f"weight{order}" in batch.schema.names:
                found.back_off(batch.column(f"weight{order}")[row].as_py())
        yield found


def _ask_counts(model: Model, orders: int, bits: int):
    schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, block in blocks_in(batch):
                tokens = Tokens(block)
                for _ in range(orders):
                    tokens.lengthen()
                keys, place = np.unique(tokens.grams, return_inverse=True)
                counts = np.bincount(place, tokens.training, len(keys)).astype(np.int64)
                rows = [{"bucket": b, "block": block.number, "keys": pack_keys(keys[s]), "counts": pack_counts(counts[s])} for b, s in dealt(keys, bits)]
                yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def add_counts(table: pa.Table) -> pa.Table:
    """One bucket's answers, its counts to store, and its counts of counts."""
    asks = table.sort_by("block").to_pydict()
    asked = [unpack_keys(k) for k in asks["keys"]]
    given = [unpack_counts(c) for c in asks["counts"]]
    sizes = [len(k) for k in asked]
    every, add = np.concatenate(asked), np.concatenate(given)
    keys, place = np.unique(every, return_inverse=True)
    totals = np.bincount(place, add, len(keys)).astype(np.int64)  # exact up to 2**53
    first = np.full(len(keys), len(every))
    with_count = np.flatnonzero(add > 0)
    np.minimum.at(first, place[with_count], with_count)
    owned = np.zeros(len(every) + 1, bool)
    owned[first] = True
    cuts = np.cumsum(sizes)[:-1]
    rows = [
        {"kind": "answer", "bucket": bucket, "block": block, "counts": pack_counts(c), "owned": np.packbits(o).tobytes(), "size": len(c)}
        for bucket, block, c, o in zip(asks["bucket"], asks["block"], np.split(totals[place], cuts), np.split(owned[:-1], cuts))
    ]
    seen = totals > 0
    stats = [int(totals.sum()), int(seen.sum()), *[int((totals == r).sum()) for r in range(1, DISCOUNTED + 2)]]
    rows.append({"kind": "counts", "bucket": asks["bucket"][0], "keys": pack_keys(keys[seen]), "counts": pack_counts(totals[seen]), "stats": stats})
    return pa.Table.from_pylist(rows, _COUNTED)


def _ask_weights(model: Model, order: int, bits: int):
    schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), *[(n, pa.binary()) for n in ("keys", "seen", "lower", "needed")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (_, block), found in zip(blocks_in(batch), _evaluated(batch, model, order)):
                keys, seen, lower, needed = found.shares()
                # Every block knows how often a history of its own occurs, so shares are sent as probabilities.
                at = np.minimum(np.searchsorted(keys, found.tokens.history), max(0, len(keys) - 1))
                inside = keys[at] == found.tokens.history if len(keys) else np.zeros(len(at), bool)
                totals = np.zeros(len(keys), np.int64)
                totals[at[inside]] = found.history_count[inside]
                rows = [
                    {"bucket": b, "block": block.number, "keys": pack_keys(keys[s]), "seen": (seen / (totals + RESERVED))[s].tobytes(), "lower": lower[s].tobytes(), "needed": np.packbits(needed[s]).tobytes()}
                    for b, s in dealt(keys, bits)
                ]
                yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def add_weights(table: pa.Table) -> pa.Table:
    """One bucket's backoff weights: to the blocks that need them, and to store."""
    asks = table.to_pydict()
    asked = [unpack_keys(k) for k in asks["keys"]]
    keys, place = np.unique(np.concatenate(asked), return_inverse=True)
    total = lambda name: np.bincount(place, np.concatenate([np.frombuffer(v, np.float64) for v in asks[name]]), len(keys))
    weights = np.maximum(1 - total("seen"), 0) / np.maximum(1 - total("lower"), 1e-300)
    rows = [{"kind": "backoff", "bucket": asks["bucket"][0], "keys": pack_keys(keys), "weights": weights.tobytes()}]
    for bucket, block, mine, needed in zip(asks["bucket"], asks["block"], np.split(weights[place], np.cumsum([len(k) for k in asked])[:-1]), asks["needed"]):
        used = np.unpackbits(np.frombuffer(needed, np.uint8), count=len(mine)).astype(bool)
        if used.any():
            rows.append({"kind": "answer", "bucket": bucket, "block": block, "weights": mine[used].tobytes()})
    return pa.Table.from_pylist(rows, _WEIGHED)


def _score(model: Model, order: int):
    names = [c.split()[0] for c in _SCORES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in _evaluated(batch, model, order):
                tokens, n = found.tokens, len(found.tokens.sizes)
                base = np.log10((found.known + 0.5) / (model.tokens + 0.5 * (model.types + 1)))
                text = tokens.text
                by_text = lambda values: np.bincount(text, values, n)
                columns = [
                    pa.array(tokens.ids, pa.int64()),
                    pa.array(tokens.held_out, pa.bool_()),
                    pa.array(tokens.sizes, pa.int64()),
                    pa.array(by_text(found.known > 0).astype(np.int64), pa.int64()),
                    pa.array(np.full(n, model.tokens), pa.int64()),
                    pa.array(by_text(base), pa.float64()),
                    pa.array(by_text(np.log10(found.probability)), pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def score_documents(docs: DataFrame, order: int = 2, path: str | None = None) -> DataFrame:
    """Train on ``docs`` (``doc_id, text``) that are not held out, and score all of them.

    ``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per row. The model's tables are written below
    ``path`` (a new folder of the shared one by default) as ``counts<order>`` and ``backoff<order>``.
    """
    spark = docs.sparkSession
    store, path, model = store_blocks(docs), path or scratch_path(spark, "model"), Model()
    known = store.blocks
    held_out = F.coalesce(F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(5)) == 1, F.lit(False))
    ids = store.blocks.select(F.explode("ids").alias("id"))
    model.documents = ids.filter(~held_out).count()
    for n in range(1, order + 1):
        asked = store.blocks.mapInArrow(_ask_counts(model, n - 1, store.bits), "bucket int, block bigint, keys binary, counts binary")
        where = f"{path}/counts{n}"
        asked.groupBy("bucket").applyInArrow(add_counts, _COUNTED_TABLE).write.partitionBy("kind").parquet(where)
        written = spark.read.schema(_COUNTED_TABLE).parquet(where)
        stats = written.filter("kind = 'counts'").agg(*[F.sum(F.element_at("stats", i + 1)) for i in range(DISCOUNTED + 3)]).first()
        model.add_order([int(x or 0) for x in stats])
        known = store.with_answers(written.filter("kind = 'answer'").select("block", "bucket", "counts", "owned", "size"), f"count{n}", known)
        if n > 1:
            asked = known.mapInArrow(_ask_weights(model, n, store.bits), "bucket int, block bigint, keys binary, seen binary, lower binary, needed binary")
            where = f"{path}/backoff{n}"
            asked.groupBy("bucket").applyInArrow(add_weights, _WEIGHED_TABLE).write.partitionBy("kind").parquet(where)
            answers = spark.read.schema(_WEIGHED_TABLE).parquet(where).filter("kind = 'answer'")
            known = store.with_answers(answers.select("block", "bucket", "weights"), f"weight{n}", known)
    return known.mapInArrow(_score(model, order), _SCORES)
