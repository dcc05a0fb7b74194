"""Substring dedup: repeated word runs are found level by level, each level twice as long as the one before.

A *window* is ``window`` consecutive words of one document. Levels are runs of ``window / 4``, ``window / 2`` and ``window``
words. A short run inside a window stands for it: the run with the least hash (an *anchor*), which is the same in every
copy of the window. Level one asks the corpus which anchors repeat. Only windows whose anchor repeats are extended: their
anchors of twice the length are asked about next, and so on until no candidates survive or the window itself is compared,
by 96 bits of hash. Longer repeats are unions of repeated windows, so no longer level is needed to find what to remove.

Every word covered by a window that also starts earlier (in a smaller document id, or earlier in the same document) is
removed; windows are judged on the input. Each block of documents asks once per distinct run, so a passage in a third of
all documents is one entry per block.

Defined cases: null texts count as empty: no words, nothing removed, an empty kept text. Texts shorter than a window lose
nothing. Null ids come last in the order. Rows that share an id are documents of their own, ordered by a checksum of their
text; of rows alike in id and text one, and only one, counts as first. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from pairweave.llm.blocks import Block, blocks_in, dealt, from_planes, planes, store_blocks, within
from pairweave.llm.words import Words, window_hashes, words_of
from pairweave.session import rewrite

_ASK = "bucket int, block bigint, keys binary, twice binary"
_NULL = np.iinfo(np.int64).max
_COLUMNS = (("k1", np.uint64), ("k2", np.uint32), ("doc", np.int64), ("tie", np.uint32), ("pos", np.uint32))


class Windows:
    """The windows of a block and the anchors in them."""

    def __init__(self, block: Block, window: int):
        self.block, self.window = block, window
        self.words: Words = words_of(block.texts)
        self.hashes = self.words.hashes()
        self.starts = np.flatnonzero(self.words.left() >= window)

    def anchors(self, length: int, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each window the place and the hash of its run of ``length`` words with the least hash (the first of equal ones)."""
        runs = window_hashes(self.hashes, length)
        best, place = runs[starts], starts.copy()
        for shift in range(1, self.window - length + 1):
            other = runs[starts + shift]
            less = other < best
            best[less], place[less] = other[less], starts[less] + shift
        return place, best

    def candidates(self, length: int, survivors: np.ndarray) -> np.ndarray:
        """Starts of the windows whose anchor of ``length`` words survived."""
        _, keys = self.anchors(length, self.starts)
        return self.starts[within(keys, survivors)]

    def entries(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct windows in order of their hash: ``(k1, k2, first start)``, and for each start the place of its entry."""
        k1 = window_hashes(self.hashes, self.window)[starts]
        k2 = (window_hashes(self.words.hashes(1), self.window, 1)[starts] >> np.uint64(32)).astype(np.uint32)
        order = np.lexsort((starts, k2, k1))
        new = np.ones(len(starts), bool)
        new[1:] = (k1[order][1:] != k1[order][:-1]) | (k2[order][1:] != k2[order][:-1])
        entry = np.empty(len(starts), np.int64)
        entry[order] = np.cumsum(new) - 1
        firsts = order[new]
        return k1[firsts], k2[firsts], starts[firsts], entry


def survivors_of(answers: list[dict] | None) -> np.ndarray:
    """Sorted keys of a level's answers."""
    return np.sort(np.concatenate([np.zeros(0, np.uint64), *[np.frombuffer(a["keys"], np.uint64) for a in answers or []]]))


def _ask(length: int, below: int | None, window: int, bits: int):
    """The step that asks about anchors of ``length``, for windows whose anchor of ``below`` words survived."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, block in blocks_in(batch):
                windows = Windows(block, window)
                starts = windows.starts if below is None else windows.candidates(below, survivors_of(batch.column("survivors")[row].as_py()))
                place, keys = windows.anchors(length, starts)
                _, first = np.unique(place, return_index=True)
                keys, counts = np.unique(keys[first], return_counts=True)
                parts = [(b, keys[s].tobytes(), keys[s][counts[s] > 1].tobytes()) for b, s in dealt(keys, bits)]
                columns = [pa.array([p[0] for p in parts], pa.int32()), pa.array([block.number] * len(parts), pa.int64())]
                columns += [pa.array([p[i] for p in parts], pa.binary()) for i in (1, 2)]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "block", "keys", "twice"])

    return run


def repeated_keys(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each block the keys that occur again, in another block or its own."""
    asked = [np.frombuffer(k, np.uint64) for k in pdf["keys"]]
    keys, counts = np.unique(np.concatenate([*asked, *[np.frombuffer(k, np.uint64) for k in pdf["twice"]]]), return_counts=True)
    again = keys[counts > 1]
    found = [k[within(k, again)].tobytes() for k in asked]
    out = pd.DataFrame({"block": pdf["block"], "keys": found})
    return out[[len(k) > 0 for k in found]]


def _ask_windows(below: int, window: int, bits: int):
    schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), *[(n, pa.binary()) for n, _ in _COLUMNS]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, block in blocks_in(batch):
                windows = Windows(block, window)
                k1, k2, first, _ = windows.entries(windows.candidates(below, survivors_of(batch.column("survivors")[row].as_py())))
                text = np.searchsorted(windows.words.first, first, "right") - 1
                ids = np.array([_NULL if i is None else i for i in block.ids], np.int64)
                ties = np.array([zlib.crc32(t) for t in block.texts], np.uint32)
                values = (k1, k2, ids[text], ties[text], (first - windows.words.first[text]).astype(np.uint32))
                rows = [{"bucket": b, "block": block.number, **{n: planes(v[s]) for (n, _), v in zip(_COLUMNS, values)}} for b, s in dealt(k1, bits)]
                yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def earlier_windows(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each block a bit per window it asked about: whether another block holds an earlier one."""
    columns = [np.concatenate([from_planes(v, kind) for v in pdf[name]]) for name, kind in _COLUMNS]
    sizes = [len(v) // 8 for v in pdf["k1"]]
    k1, k2, doc, tie, pos = columns
    order = np.lexsort((np.repeat(pdf["block"].to_numpy(), sizes), pos, tie, doc, k2, k1))
    later = np.zeros(len(k1), bool)
    later[order[1:]] = (k1[order][1:] == k1[order][:-1]) & (k2[order][1:] == k2[order][:-1])
    bits = [np.packbits(part).tobytes() for part in np.split(later, np.cumsum(sizes)[:-1])]
    return pd.DataFrame({"bucket": pdf["bucket"], "block": pdf["block"], "size": sizes, "bits": bits})


def _remove(below: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, block in blocks_in(batch):
                windows = Windows(block, window)
                words, n = windows.words, len(windows.hashes)
                removed = np.zeros(n, bool)
                answers = sorted(batch.column("answers")[row].as_py() or [], key=lambda a: a["bucket"])
                if answers:
                    starts = windows.candidates(below, survivors_of(batch.column("survivors")[row].as_py()))
                    _, _, first, entry = windows.entries(starts)
                    later = np.concatenate([np.unpackbits(np.frombuffer(a["bits"], np.uint8), count=a["size"]) for a in answers]).astype(bool)
                    again = starts[later[entry] | (first[entry] != starts)]
                    edges = np.zeros(n + 1, np.int64)
                    np.add.at(edges, again, 1)
                    np.add.at(edges, again + window, -1)
                    removed = np.cumsum(edges[:-1]) > 0
                lost = np.concatenate(([0], np.cumsum(removed)))[words.first]
                counts, lost = np.diff(words.first), np.diff(lost)
                kept = []
                for i, text in enumerate(block.texts):
                    if lost[i]:
                        at = words.first[i] + np.flatnonzero(~removed[words.first[i] : words.first[i + 1]])
                        kept.append(b" ".join([words.blob[a:b] for a, b in zip(words.starts[at].tolist(), words.ends[at].tolist())]))
                    else:
                        kept.append(b" ".join(text.split()))
                columns = [pa.array(block.ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(lost, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept_text"])

    return run


def substring_dedup(docs: DataFrame, window: int = 20) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_text)`` per row of ``docs`` (``doc_id, text``); kept words are joined by one blank."""
    store = store_blocks(docs)
    lengths = [max(1, -(-window // 4)), max(1, -(-window // 2))]
    lengths = lengths if lengths[0] < lengths[1] else lengths[:1]
    blocks, below = store.blocks, None
    for length in lengths:
        asked = blocks.mapInArrow(_ask(length, below, window, store.bits), _ASK)
        survivors, _ = rewrite(asked.groupBy("bucket").applyInPandas(repeated_keys, "block bigint, keys binary"), "survivors")
        blocks, below = store.with_answers(survivors, "survivors"), length
        if survivors.isEmpty():
            break
    asked = blocks.mapInArrow(_ask_windows(below, window, store.bits), "bucket int, block bigint, " + ", ".join(f"{n} binary" for n, _ in _COLUMNS))
    answers, _ = rewrite(asked.groupBy("bucket").applyInPandas(earlier_windows, "bucket int, block bigint, size int, bits binary"), "answers")
    return store.with_answers(answers, "answers", blocks).mapInArrow(
        _remove(below, window), "doc_id bigint, n_words bigint, n_removed bigint, kept_text string"
    )
