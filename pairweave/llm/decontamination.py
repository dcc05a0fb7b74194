"""Benchmark decontamination: pigeonhole pieces, exact hits, and Myers' bit-parallel distance.

Both sides are lower-cased, ASCII punctuation counts as blank, and words are the symbols that are edited. An item of
``m`` words may differ in ``k = floor((1 - similarity) * m)`` word insertions, deletions and replacements. It is split
into ``k + 1`` pieces: of any occurrence within the budget at least one piece is intact. A hit of a piece opens a window
of ``m + 2 k`` words, overlapping windows of an item are joined, and Myers' recurrence runs over them once, with the item
as one machine word of ``m`` bits (Python integers, so any length).

The items reach the tasks as a broadcast of at most ``BLOCK_WORDS`` words; a larger benchmark is searched block by block,
all documents for each, and one block is gone before the next is made. Documents are not shuffled; only matches leave a task.

Items of fewer than ``min_words`` words (five) would be met by chance inside any text: they match, unedited, where they are a
whole line or the whole document.

Defined cases: null and empty texts and items without words match nothing. Repeated item ids are searched each for themselves and give a row each. Repeated
documents give a row each. A null document or item id is passed on. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairweave.llm.words import by_size, plain, window_hashes, words_of
from pairweave.session import rewrite

#: Words of items that one broadcast holds at most, but for a single longer item.
BLOCK_WORDS = 1_000_000
MATCH = "doc_id bigint, item_id bigint, distance bigint, item_words bigint, end_word bigint"
_FILTER_BITS = 22


def budget_of(m: int, similarity: float) -> int:
    """Word edits that an item of ``m`` words may have."""
    return int((1 - similarity) * m + 1e-9)


def split_pieces(m: int, k: int) -> list[tuple[int, int]]:
    """``k + 1`` consecutive ranges of nearly equal size that cover ``m`` words."""
    cuts = [m * i // (k + 1) for i in range(k + 2)]
    return list(zip(cuts[:-1], cuts[1:]))


def best_match(pattern: list[int], text: list[int]) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to any run of ``text`` and the first place where such a run ends."""
    m, masks = len(pattern), {}
    for i, word in enumerate(pattern):
        masks[word] = masks.get(word, 0) | 1 << i
    ones, last = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = ones, 0, m
    best = (m, 0)
    for j, word in enumerate(text, 1):
        eq = masks.get(word, 0)
        x = eq | minus
        diagonal = (((eq & plus) + plus) ^ plus) | eq
        up, down = minus | ~(diagonal | plus) & ones, plus & diagonal
        score += bool(up & last) - bool(down & last)
        up, down = up << 1 & ones, down << 1 & ones
        plus, minus = down | ~(x | up) & ones, up & x
        best = min(best, (score, j))
    return best


class Items:
    """Pieces of a block of items, by piece length."""

    def __init__(self, items: list[tuple[int | None, str | None]], similarity: float, min_words: int):
        self.items: list[tuple[int | None, list[int], int]] = []
        self.short: dict[bytes, list[tuple[int | None, int]]] = {}
        found: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for item_id, text in items:
            hashes = words_of([plain(text)]).hashes()
            m = len(hashes)
            if m < min_words:
                if m:
                    self.short.setdefault(b" ".join(plain(text).split()), []).append((item_id, m))
                continue
            k = budget_of(m, similarity)
            for a, b in split_pieces(m, k):
                key = int(window_hashes(hashes[a:b], b - a)[0])
                found.setdefault(b - a, {}).setdefault(key, []).append((len(self.items), a))
            self.items.append((item_id, hashes.tolist(), k))
        self.pieces = {}
        for length, keys in found.items():
            bits = np.zeros(1 << _FILTER_BITS, bool)
            bits[np.fromiter(keys, np.uint64, len(keys)) & np.uint64((1 << _FILTER_BITS) - 1)] = True
            self.pieces[length] = (np.packbits(bits), keys)

    @classmethod
    def of(cls, state: dict) -> "Items":
        """The block again, from its ``__dict__`` (what is broadcast is plain data)."""
        block = cls.__new__(cls)
        block.__dict__.update(state)
        return block

    def search(self, ids: list, texts: list[str | None]) -> Iterator[tuple]:
        """Matches of some texts: ``(index of the text, *row of MATCH)``."""
        filters = {length: np.unpackbits(bits).view(bool) for length, (bits, _) in self.pieces.items()}
        cleaned = [plain(t) for t in texts]
        for a, b in by_size([len(t) for t in cleaned]):
            for text, *found in self._matches(cleaned[a:b], filters):
                yield (a + text, ids[a + text], *found)
        for i, text in enumerate(cleaned if self.short else ()):
            for item_id, m, end in self._whole(text):
                yield i, ids[i], item_id, 0, m, end

    def _whole(self, text: bytes) -> Iterator[tuple[int | None, int, int]]:
        """Short items that are the text or a line of it: ``(item, words, end of the first)``, one row per item."""
        longest, seen, at = max(m for found in self.short.values() for _, m in found), set(), 0
        for line in [*text.splitlines(), None]:
            words = text.split() if line is None else line.split()
            at = len(words) if line is None else at + len(words)
            key = b" ".join(words) if 0 < len(words) <= longest else b""
            if key not in seen:
                seen.add(key)
                yield from ((item_id, m, at) for item_id, m in self.short.get(key, ()))

    def _matches(self, texts: list[bytes], filters: dict[int, np.ndarray]) -> Iterator[tuple]:
        words = words_of(texts)
        hashes, left = words.hashes(), words.left()
        starts: dict[tuple[int, int], list[int]] = {}
        for length, (_, keys) in self.pieces.items():
            grams = window_hashes(hashes, length)
            hits = np.flatnonzero(filters[length][grams & np.uint64((1 << _FILTER_BITS) - 1)] & (left[: len(grams)] >= length))
            for at, key, text in zip(hits.tolist(), grams[hits].tolist(), (np.searchsorted(words.first, hits, "right") - 1).tolist()):
                for item, offset in keys.get(key, ()):
                    starts.setdefault((text, item), []).append(at - offset)
        for (text, item), places in sorted(starts.items()):
            item_id, pattern, k = self.items[item]
            low, high = int(words.first[text]), int(words.first[text + 1])
            best, reach = None, [-1, -1]
            for at in [*sorted(places), None]:  # overlapping windows are joined; None ends the last
                begin = None if at is None else max(low, at - k)
                if at is not None and reach[0] >= 0 and begin <= reach[1]:
                    reach[1] = min(high, at + len(pattern) + k)
                    continue
                if reach[0] >= 0:
                    distance, end = best_match(pattern, hashes[reach[0] : reach[1]].tolist())
                    if distance <= k and (best is None or distance < best[0]):
                        best = (distance, reach[0] - low + end)
                if at is not None:
                    reach = [begin, min(high, at + len(pattern) + k)]
            if best:
                yield text, item_id, best[0], len(pattern), best[1]


def item_blocks(benchmark: DataFrame, similarity: float, min_words: int) -> Iterator[tuple[Items, bool]]:
    """The pieces of ``(item_id, text)``, in blocks of at most about ``BLOCK_WORDS`` words; whether a block is the last."""
    items = benchmark.select("item_id", "text")
    size = items.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1)).first()[0] or 0
    blocks = max(1, -(-size // (2 * BLOCK_WORDS)))  # a word takes two bytes or more
    for block in range(blocks):
        part = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield Items([tuple(r) for r in part.collect()], similarity, min_words), block == blocks - 1


def find_contamination(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, min_words: int = 5) -> DataFrame:
    """``(doc_id, item_id, distance, item_words, end_word)`` for each document and item within the budget.

    ``docs`` has ``doc_id, text``, ``benchmark`` has ``item_id, text``. ``end_word`` is where the closest run ends, in words.
    """
    names = [c.split()[0] for c in MATCH.split(", ")]

    def matches(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items.of(shared.value)
        for batch in batches:
            rows = list(items.search(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_pydict({n: pa.array([r[i] for r in rows], pa.int64()) for i, n in enumerate(names, 1)})

    spark, found = docs.sparkSession, []
    for items, last in item_blocks(benchmark, similarity, min_words):
        shared = spark.sparkContext.broadcast(vars(items))
        searched = docs.select("doc_id", "text").mapInArrow(partial(matches, shared), MATCH)
        if not (last and not found):
            searched, _ = rewrite(searched, "matches")
            shared.unpersist()
        found.append(searched)
    return reduce(DataFrame.unionByName, found)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, min_words: int = 5) -> DataFrame:
    """The rows of ``docs`` whose text matches no item, with all their columns; decided where the row lies, so nothing moves."""

    def clean(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items.of(shared.value)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            hit = {found[0] for found in items.search(texts, texts)}
            yield batch.filter(pa.array([i not in hit for i in range(len(texts))], pa.bool_()))

    for items, last in item_blocks(benchmark, similarity, min_words):
        shared = docs.sparkSession.sparkContext.broadcast(vars(items))
        docs = docs.mapInArrow(partial(clean, shared), docs.schema)
        if not last:
            docs, _ = rewrite(docs, "clean")
            shared.unpersist()
    return docs
