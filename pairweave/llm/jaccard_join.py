"""N-gram Jaccard join: minimum-hash bands find candidates, full n-gram sets decide.

Words are taken unchanged; a text's set holds its runs of five words (the whole text if it has fewer). Texts with equal
sets are one entry from the start, whatever their number. An entry's ``bands * rows`` minimum hashes are cut in bands, the
numbers being the cheapest that find a pair at the threshold with the wanted recall. Entries that share a band hash are
linked to the least of them (never all pairs), and connected components of these links are the sets of candidates.

Inside a component every pair is compared by exact set sizes and intersections. A component is dealt out in blocks of
bounded size, one task per pair of blocks, and counts leave the task, not pairs: for each entry how many others, and how
many documents, it is linked with, and the least entry it is connected to. No pair of a component is skipped, however large
it is; a component of n entries takes the n^2 / 2 comparisons that its links need, in parallel.

The result is one row per document: ``doc_id``; ``class_id``, the least id among the documents it is connected with by
links; ``copy_id``, the least id with the same set; ``n_links``, how many other documents are at the threshold or above;
``n_texts``, how many other sets; ``n_grams``; and ``class_key``, which names the class also where ids are null.

Defined cases: null, empty and blank texts have the empty set; they are copies of each other and linked with nothing else.
Rows alike in id and text are documents of their own (copies). Null ids are passed on, sort last, and do not name a class
unless all its ids are null. Empty tables give no rows. Only the id and the text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairweave.llm.components import connected_components
from pairweave.llm.words import by_size, mix, window_hashes, words_of
from pairweave.session import rewrite

#: Most entries and about the most n-grams of a block; bounds the memory of a comparison, not what is compared.
BLOCK_TEXTS = 512
BLOCK_GRAMS = 1 << 20
_SETS = "doc_id bigint, text_hash bigint, set_id binary, n_grams bigint, bands array<bigint>"


def choose_bands(threshold: float, recall: float) -> tuple[int, int]:
    """``(bands, rows)`` with the fewest hashes such that a pair at the threshold shares a band with probability ``recall``.

    At least four rows, so that pairs far below the threshold rarely share one.
    """
    options = [(math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)), rows) for rows in range(4, 9)]
    return min(options, key=lambda o: o[0] * o[1])


def gram_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """The sorted hashes of each text's n-gram set."""
    words = words_of(texts)
    hashes = words.hashes()
    grams = window_hashes(hashes, n)
    out = []
    for low, high in zip(words.first[:-1], words.first[1:]):
        if high - low >= n:
            out.append(np.unique(grams[low : high - n + 1]))
        else:
            out.append(window_hashes(hashes[low:high], int(high - low)) if high > low else np.zeros(0, np.uint64))
    return out


def set_digest(grams: np.ndarray) -> bytes:
    """16 bytes that name a set: two sums of differently mixed hashes."""
    with np.errstate(over="ignore"):
        return mix(grams).sum(dtype=np.uint64).tobytes() + mix(grams * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)).sum(dtype=np.uint64).tobytes()


def minimum_hashes(grams: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The least of each hash function (a multiplication of 64 bits, upper half) over a set, piecewise."""
    least = np.full(len(factors), np.iinfo(np.uint64).max)
    with np.errstate(over="ignore"):
        for low in range(0, len(grams), 4096):
            np.minimum(least, (grams[low : low + 4096, None] * factors[None, :]).min(0), out=least)
    return least


def _sets(batches: Iterator[pa.RecordBatch], n: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    factors = np.random.default_rng(11).integers(0, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    weights = np.random.default_rng(12).integers(0, 2**63, (bands, rows), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for batch in batches:
        raw = [(t or "").encode() for t in batch.column(1).to_pylist()]
        for a, b in by_size([len(t) for t in raw]):
            sets, found = gram_sets(raw[a:b], n), []
            for grams in sets:
                with np.errstate(over="ignore"):
                    least = minimum_hashes(grams, factors).reshape(bands, rows) >> np.uint64(20)
                    band = mix((least * weights).sum(1, dtype=np.uint64) + np.arange(bands, dtype=np.uint64))
                found.append(band.view(np.int64) if len(grams) else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0).slice(a, b - a),
                    "text_hash": batch.column(2).slice(a, b - a),
                    "set_id": pa.array([set_digest(g) for g in sets], pa.binary()),
                    "n_grams": pa.array([len(g) for g in sets], pa.int64()),
                    "bands": pa.array(found, pa.list_(pa.int64())),
                }
            )


def _intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set on the left with every set on the right, as products of 0/1 matrices."""
    both = left + right
    ids = np.concatenate([*both, np.zeros(0, np.uint64)])
    owner = np.repeat(np.arange(len(both)), [len(g) for g in both])
    order = np.argsort(ids, kind="stable")
    ids, owner = ids[order], owner[order]
    column = np.concatenate(([0], np.cumsum(ids[1:] != ids[:-1]))) if len(ids) else ids.astype(np.int64)
    shared = np.bincount(column)[column] > 1 if len(ids) else np.zeros(0, bool)
    owner, column = owner[shared], column[shared]
    column = np.concatenate(([0], np.cumsum(column[1:] != column[:-1]))) if len(column) else column
    total = np.zeros((len(left), len(right)), np.int64)
    step = 1 << 12
    cuts = np.searchsorted(column, np.arange(0, (column[-1] + 1 if len(column) else 0) + step, step))
    for low, high in zip(cuts[:-1], cuts[1:]):
        if low < high:
            dense = np.zeros((len(both), step), np.float32)
            dense[owner[low:high], column[low:high] - column[low]] = 1
            total += (dense[: len(left)] @ dense[len(left) :].T).astype(np.int64)
    return total


def compare_blocks(
    ids: list[bytes], copies: np.ndarray, sets: list[np.ndarray], sides: np.ndarray, pair: tuple[int, int], threshold: float
) -> list[tuple[bytes, int, int, bytes]]:
    """Links between the two blocks of ``pair``, or inside one block if they are the same.

    ``(set_id, n_texts, n_docs, root)`` per entry with a link; ``root`` is the least entry it is connected with in this pair.
    A pair of two blocks of which one is empty has no links: those inside the other belong to its pair with itself.
    """
    left, right = np.flatnonzero(sides == pair[0]), np.flatnonzero(sides == pair[1])
    if not (len(left) and len(right)):
        return []
    sizes = np.array([len(g) for g in sets], np.int64)
    inter = _intersections([sets[i] for i in left], [sets[i] for i in right])
    union = sizes[left][:, None] + sizes[right][None, :] - inter
    linked = (inter >= threshold * union - 1e-9) & (left[:, None] != right[None, :]) & (inter > 0)
    texts, docs = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    texts[left], docs[left] = linked.sum(1), (linked * copies[right][None, :]).sum(1)
    if pair[0] != pair[1]:
        texts[right], docs[right] = linked.sum(0), (linked * copies[left][:, None]).sum(0)
    rank = np.empty(len(ids), np.int64)
    rank[sorted(range(len(ids)), key=ids.__getitem__)] = np.arange(len(ids))
    far = len(ids)
    while True:  # least label among neighbours, until none changes
        new = rank.copy()
        if linked.size:
            np.minimum.at(new, left, np.where(linked, rank[right][None, :], far).min(1))
            np.minimum.at(new, right, np.where(linked, rank[left][:, None], far).min(0))
        if (new == rank).all():
            break
        rank = new
    by_rank = sorted(ids)
    return [(ids[i], int(texts[i]), int(docs[i]), by_rank[rank[i]]) for i in np.flatnonzero(texts)]


def jaccard_join(docs: DataFrame, threshold: float = 0.8, n: int = 5, recall: float = 0.9999) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, text``); see the module for the columns."""
    bands, rows = choose_bands(threshold, recall)
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    found = texts.mapInArrow(lambda batches: _sets(batches, n, bands, rows), _SETS)
    # One row per (document, text) and its copies; the bands only depend on the set.
    members, _ = rewrite(found.groupBy("set_id", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("copies"), F.first("n_grams").alias("n_grams"), F.first("bands").alias("bands")), "members")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")).alias("first")
    entries = members.groupBy("set_id").agg(first, F.sum("copies").alias("copies"), F.first("n_grams").alias("n_grams"), F.first("bands").alias("bands"))
    entries, _ = rewrite(entries.select("set_id", "first.doc_id", "first.text_hash", "copies", "n_grams", "bands"), "entries")

    in_band = entries.select("set_id", F.explode("bands").alias("band"))
    leaders = in_band.groupBy("band").agg(F.min("set_id").alias("leader"), F.max("set_id").alias("other")).filter("leader <> other")
    stars = in_band.join(leaders.select("band", "leader"), "band").filter("set_id <> leader")
    candidates = connected_components(stars.select(F.col("set_id").alias("a"), F.col("leader").alias("b")).distinct())

    placed = candidates.select(F.col("node").alias("set_id"), F.col("root").alias("component")).join(entries.drop("bands"), "set_id")
    sizes = placed.groupBy("component").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS), F.ceil(F.sum("n_grams") / BLOCK_GRAMS)).cast("int").alias("blocks")
    )
    placed, _ = rewrite(placed.join(sizes, "component"), "candidates")
    grams = placed.agg(F.sum("n_grams")).first()[0] or 0
    tasks = max(1, -(-grams // BLOCK_GRAMS))
    mine = F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")
    # A small component shares a task with others; a large one gets a task per pair of blocks.
    pairs = F.when(F.col("blocks") == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.struct(F.least(mine, other).alias("i"), F.greatest(mine, other).alias("j")))
    )
    group = F.when(F.col("blocks") == 1, F.concat(F.lit("t"), F.pmod(F.xxhash64("component"), F.lit(tasks)))).otherwise(
        F.concat_ws(":", F.hex("component"), "pair.i", "pair.j")
    )
    keyed = placed.withColumn("side", mine).withColumn("pair", F.explode(pairs)).withColumn("task", group)
    # Texts are shuffled at any size of the candidates, so that the job behaves alike on small and large tables.
    chosen = placed.select("set_id", "doc_id", "text_hash").alias("p").hint("merge").join(
        texts.alias("t"), F.col("p.text_hash").eqNullSafe(F.col("t.text_hash")) & F.col("p.doc_id").eqNullSafe(F.col("t.doc_id"))
    ).select("p.set_id", "t.text").dropDuplicates(["set_id"])
    work = keyed.select("task", "component", "side", "pair.i", "pair.j", "set_id", "copies").join(chosen, "set_id")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in pdf.groupby("component", sort=False):
            sets = gram_sets([t.encode() for t in part["text"]], n)
            out += compare_blocks([bytes(s) for s in part["set_id"]], part["copies"].to_numpy(), sets, part["side"].to_numpy(), (part["i"].iat[0], part["j"].iat[0]), threshold)
        return pd.DataFrame(out, columns=["set_id", "texts", "docs", "root"])

    compared, _ = rewrite(work.groupBy("task").applyInPandas(compare, "set_id binary, texts bigint, docs bigint, root binary"), "links")
    classes = connected_components(compared.select(F.col("set_id").alias("a"), F.col("root").alias("b")))
    links = compared.groupBy("set_id").agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    labelled = entries.select("set_id", F.col("doc_id").alias("copy_id"), F.col("copies").alias("alike")).join(links, "set_id", "left")
    labelled = labelled.join(classes.select(F.col("node").alias("set_id"), "root"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    named = labelled.groupBy("root").agg(F.min("copy_id").alias("class_id"))
    per_set = labelled.join(named, "root").select(
        "set_id", "copy_id", "class_id", "alike", F.coalesce("texts", F.lit(0)).alias("n_texts"), F.coalesce("docs", F.lit(0)).alias("linked"), F.lower(F.hex("root")).alias("class_key")
    )
    each = members.drop("bands").join(per_set, "set_id").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return each.select("doc_id", "class_id", "copy_id", (F.col("linked") + F.col("alike") - 1).alias("n_links"), "n_texts", "n_grams", "class_key", "text_hash", F.col("_copy").alias("copy"))
