"""Target-distribution importance resampling: documents drawn in proportion to how much they look like a target corpus.

Features are runs of words, hashed into buckets by CRC-32. A bucket's gain is the scaled log ratio of its shares in the
target and in all documents; a document's weight is the mean gain of its features. Gumbel noise from a hash of the id is
added, and the highest sums are drawn, which is sampling without replacement in proportion to the exponential of the weight.

*Position-table CRC.* CRC-32 is linear over XOR: it is a constant for the length, combined with one contribution for each
byte, which depends on the byte and on how far it stands from the end. A table holds the contributions of 64 distances;
``bitwise_xor.reduceat`` folds those of all features of a batch at once. Longer features fold blockwise: blocks of 64 bytes, counted
from the end, are folded by the table and then carried over the bytes behind them by powers of the shift by one byte. Features
longer than ``PIECE_BYTES`` are folded piece by piece in the same way.

Counts are sums by bucket in each task, then over tasks; 10,000 gains are all that is sent to the tasks. The draw needs no
sort of all rows: scores are whole numbers, so counts by score give the lowest one drawn, and only rows from there on are
numbered, slice by slice.

Words are lower case in ASCII only; a word is a run of digits, ASCII letters and characters above U+007F.

Defined cases: null and empty texts have no feature and weight 0, as have documents without features; null ids are hashed as
an empty string and come last among equals; repeated rows are drawn each for themselves; an empty target or an empty table gives
gains by the same formula; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairweave.llm.words import by_size
from pairweave.operators.numbering import SLICE_ROWS, number_rows, range_slice
from pairweave.session import rewrite

#: Distances from the end that the position table holds.
DISTANCES = 64
#: Longest span that is folded at once, and bytes of text that are worked on together.
PIECE_BYTES = 1 << 20
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_WORD = np.array([48 <= c <= 57 or 97 <= c <= 122 or c >= 128 for c in range(256)])


@lru_cache(None)
def _position_table() -> np.ndarray:
    """``table[d][b]``: what byte ``b`` contributes to a CRC-32 when ``d`` bytes follow it."""
    row = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        row = (row >> 1) ^ (np.uint32(0xEDB88320) * (row & 1))
    rows = [row]
    for _ in range(DISTANCES - 1):
        rows.append(rows[0][rows[-1] & 0xFF] ^ (rows[-1] >> 8))
    return np.stack(rows)


@lru_cache(None)
def _shift(power: int) -> np.ndarray:
    """Tables, one for each byte of a register, that carry it over ``2**power`` zero bytes."""
    if power == 0:
        step, registers = _position_table()[0], np.arange(256, dtype=np.uint32)
        return np.stack([step[(registers << (8 * k)) & 0xFF] ^ ((registers << (8 * k)) >> 8) for k in range(4)])
    half = _shift(power - 1)
    return _carry(_carry(np.stack([np.arange(256, dtype=np.uint32) << (8 * k) for k in range(4)]), half), half)


def _carry(registers: np.ndarray, tables: np.ndarray) -> np.ndarray:
    return tables[0][registers & 0xFF] ^ tables[1][(registers >> 8) & 0xFF] ^ tables[2][(registers >> 16) & 0xFF] ^ tables[3][registers >> 24]


def advance(registers: np.ndarray, distance: np.ndarray) -> np.ndarray:
    """Each register carried over its number of zero bytes, one bit of the numbers at a time."""
    registers, power = registers.astype(np.uint32), 0
    while len(distance) and int(distance.max()) >> power:
        on = np.flatnonzero((distance >> power) & 1)
        registers[on] = _carry(registers[on], _shift(power))
        power += 1
    return registers


@lru_cache(1 << 16)
def length_constant(length: int) -> int:
    """CRC-32 of so many zero bytes, which is what a CRC of this length holds besides its bytes."""
    return int(advance(np.array([0xFFFFFFFF], np.uint32), np.array([length]))[0]) ^ 0xFFFFFFFF


def _fold(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The contributions of the bytes of each span, folded."""
    sizes = ends - starts
    firsts = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum()))
    distance = np.repeat(firsts + sizes - 1, sizes) - place
    contributions = _position_table()[distance % DISTANCES, data[place + np.repeat(starts - firsts, sizes)]]
    if sizes.max() <= DISTANCES:
        return np.bitwise_xor.reduceat(contributions, firsts)
    opens = distance % DISTANCES == DISTANCES - 1
    opens[firsts] = True
    blocks = np.flatnonzero(opens)
    folded = advance(np.bitwise_xor.reduceat(contributions, blocks), distance[blocks] // DISTANCES * DISTANCES)
    return np.bitwise_xor.reduceat(folded, np.searchsorted(blocks, firsts))


def span_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of each ``data[start:end]``; spans may overlap and have at least one byte."""
    if not len(starts):
        return np.zeros(0, np.uint32)
    sizes = ends - starts
    pieces = -(-sizes // PIECE_BYTES)
    owner = np.repeat(np.arange(len(sizes)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    low = starts[owner] + nth * PIECE_BYTES
    high = np.minimum(low + PIECE_BYTES, ends[owner])
    folded = np.zeros(len(owner), np.uint32)
    for a, b in by_size((high - low).tolist(), PIECE_BYTES):
        folded[a:b] = _fold(data, low[a:b], high[a:b])
    folded = np.bitwise_xor.reduceat(advance(folded, ends[owner] - high), np.cumsum(pieces) - pieces)
    lengths, which = np.unique(sizes, return_inverse=True)
    return folded ^ np.array([length_constant(n) for n in lengths.tolist()], np.uint32)[which]


@dataclass
class Hashed:
    """Buckets of the features of some texts, with the text that each belongs to, and the number of words by text."""

    owner: np.ndarray
    bucket: np.ndarray
    n_words: np.ndarray


def _stretches(text: bytes) -> Iterator[bytes]:
    """A text in stretches of about ``PIECE_BYTES`` that end after a byte outside of words."""
    low = 0
    while len(text) - low > PIECE_BYTES:
        high = low + PIECE_BYTES
        while high < len(text) and _WORD[text[high - 1]]:
            high += 1
        yield text[low:high]
        low = high
    yield text[low:]


def _hash_texts(texts: list[bytes], max_words: int, buckets: int, carried: int = 0) -> Hashed:
    """``carried`` words of the one text were counted before and only begin features."""
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _WORD[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    text = np.searchsorted(text_ends, starts, "right")
    sizes = ends - starts
    if max_words > 1:  # runs of several words are joined by one blank
        keep = inside[1:-1] | inside[:-2]
        joined = data[keep].copy()
        joined[~inside[1:-1][keep]] = 32
        data, starts = joined, np.cumsum(sizes + 1) - sizes - 1
        ends = starts + sizes
    owners, crcs = [], []
    for n in range(1, max_words + 1):
        last = np.arange(n - 1, len(starts))
        last = last[(text[last - n + 1] == text[last]) & (last >= carried)] if len(last) else last
        owners.append(text[last])
        crcs.append(span_crcs(data, starts[last - n + 1], ends[last]))
    n_words = np.bincount(text, minlength=len(texts))
    if carried:
        n_words[0] -= carried
    return Hashed(np.concatenate(owners), (np.concatenate(crcs) % np.uint32(buckets)).astype(np.int64), n_words)


def hashed_features(texts: list[str | None], max_words: int, buckets: int) -> Iterator[tuple[int, Hashed]]:
    """``(number of the first text, features)`` of groups of texts; a long text comes in several groups."""
    raw = [(t or "").encode().translate(_LOWER) for t in texts]
    for a, b in by_size([len(t) for t in raw], PIECE_BYTES):
        if b - a > 1 or len(raw[a]) <= 2 * PIECE_BYTES:
            yield a, _hash_texts(raw[a:b], max_words, buckets)
            continue
        tail: list[bytes] = []
        for stretch in _stretches(raw[a]):
            yield a, _hash_texts([b" ".join([*tail, stretch])], max_words, buckets, len(tail))
            if max_words > 1:
                tail = [*tail, *_words(stretch)][1 - max_words :]


def _words(stretch: bytes) -> list[bytes]:
    return bytes(np.where(_WORD[np.frombuffer(stretch, np.uint8)], np.frombuffer(stretch, np.uint8), 32).astype(np.uint8)).split()


def bucket_counts(texts: DataFrame, max_words: int = 1, buckets: int = 10_000) -> DataFrame:
    """``(bucket, n)``: how many features of all ``texts`` (``text``) fall in each bucket. A task sends one row per bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, found in hashed_features(batch.column(0).to_pylist(), max_words, buckets):
                held += np.bincount(found.bucket, minlength=buckets)
        there = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(there, pa.int64()), "n": pa.array(held[there], pa.int64())})

    return texts.select(F.col("text").cast("string")).mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def _collected(counts: DataFrame, buckets: int) -> list[int]:
    """Counts by bucket as a list: at most ``buckets`` rows, whatever the corpus."""
    out = [0] * buckets
    for r in counts.collect():
        out[r.bucket] = r.n
    return out


def bucket_gains(source: list[int], target: list[int]) -> list[int]:
    """The scaled log ratio of smoothed shares, by bucket, as whole numbers."""
    s_all, t_all, n = sum(source), sum(target), len(source)
    return [math.floor(1000 * math.log(float((t + 1) * (s_all + n)) / float((s + 1) * (t_all + n)))) for s, t in zip(source, target)]


SCORED = "doc_id bigint, n_features bigint, n_words bigint, weight bigint"


def weigh(docs: DataFrame, gains: list[int], max_words: int = 1) -> DataFrame:
    """``(doc_id, n_features, n_words, weight)`` of each row, decided where the row lies."""
    shared = docs.sparkSession.sparkContext.broadcast(np.array(gains, np.float64))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            features, words, total = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for first, found in hashed_features(batch.column(1).to_pylist(), max_words, len(shared.value)):
                at = slice(first, first + len(found.n_words))
                features[at] += np.bincount(found.owner, minlength=len(found.n_words))
                words[at] += found.n_words
                total[at] += np.bincount(found.owner, shared.value[found.bucket], len(found.n_words)).astype(np.int64)
            weight = np.where(features > 0, total // np.maximum(features, 1), 0)
            columns = {"n_features": features, "n_words": words, "weight": weight}
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0)} | {c: pa.array(v, pa.int64()) for c, v in columns.items()})

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(score, SCORED)


def resample(docs: DataFrame, target: DataFrame, max_words: int = 1, buckets: int = 10_000, least_words: int = 20, percent: int = 10, seed: int = 2024, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` of every document; ``rank`` counts the drawn ones from 1 and is null for the rest.

    Of the documents with ``least_words`` words or more, ``percent`` in a hundred are drawn, equal scores by smaller ``doc_id``.
    """
    gains = bucket_gains(_collected(bucket_counts(docs, max_words, buckets), buckets), _collected(bucket_counts(target, max_words, buckets), buckets))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") + 0.5) / 4294967296.0
    noise = F.floor(-1000 * F.log(-F.log(share)))
    weighed = weigh(docs, gains, max_words)
    scored, _ = rewrite(weighed.withColumn("score", (F.col("weight") + noise).cast("bigint")), "scored")

    eligible = scored.filter(F.col("n_words") >= least_words)
    # Scores are whole thousandths of a logarithm, some ten thousand values however many documents there are.
    levels = sorted(((r.score, r.n) for r in eligible.groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    drawn = percent * sum(n for _, n in levels) // 100
    lowest, above, most = None, 0, 0
    for score, n in levels:
        if above >= drawn:
            break
        lowest, above, most = score, above + n, max(most, n)
    out = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("bigint").alias("rank")
    if lowest is None:
        return scored.select(*out, none)
    high = (F.col("n_words") >= least_words) & (F.col("score") >= lowest)
    # Equal scores are cut by id, so that a slice stays small at any corpus size.
    cuts = -(-most // slice_rows)
    candidates = range_slice(scored.filter(high), "doc_id", "_ids", max(1, -(-above // cuts))) if cuts > 1 else scored.filter(high).withColumn("_ids", F.lit(0))
    sliced = candidates.withColumns({
        "_down": -F.col("score"), "_last": F.col("doc_id").isNull(),
        "_slice": (F.lit(levels[0][0]) - F.col("score")) * (cuts + 1) + F.when(F.col("doc_id").isNull(), cuts).otherwise(F.col("_ids")),
    })
    placed = number_rows(sliced, [], "_slice", ["_down", "_last", "doc_id", "n_features", "weight"], "_place")
    ranked = placed.select(*out, F.when(F.col("_place") < drawn, F.col("_place") + 1).alias("rank"))
    return ranked.unionByName(scored.filter(~high).select(*out, none))
