"""Exact deduplication: static filters over an immutable snapshot screen the digests of an incoming batch.

Texts are equal when they are identical after deleting the characters space and U+0009 to U+000D. A snapshot stores one
text per distinct digest (the exact buckets) and a binary-fuse filter per bucket. A batch digest that its bucket's
filter rejects cannot be in the snapshot; a positive joins the exact bucket and is compared byte by byte. Whatever is
not confirmed is new, and new rows are grouped among themselves.

Defined cases: a null text counts as empty, so null, empty and all-blank texts are one group. A null id sorts after
every number. Rows alike in id and text are one entry with a multiplicity, so exactly one of them is kept. Of rows with
the same id and length but different blanks the one with the larger hash of the original text is kept. Empty tables
give empty results. Only the id and the text column are read, so other columns can have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pairweave.session import rewrite, scratch_path

BLANKS = b" \t\n\x0b\x0c\r"
#: Digests per bucket that one filter is built over; bounds the memory of a task, not the data.
BUCKET_DIGESTS = 65_536
_ROW = ["doc_id", "digest", "fp", "n_points", "text_hash"]


def digest_batches(batches: Iterator[pa.RecordBatch], with_text: bool = False) -> Iterator[pa.RecordBatch]:
    """``(doc_id, text, text_hash)`` to digest, 64-bit fingerprint and code points; optionally the bytes."""
    for batch in batches:
        ids, texts = batch.column(0), pc.fill_null(batch.column(1), "")  # the third column hashes the original
        raw = [t.encode() for t in texts.to_pylist()]
        plain = [t.translate(None, BLANKS) for t in raw]
        digests = [hashlib.sha256(t).digest() for t in plain]
        columns = {
            "doc_id": ids,
            "digest": pa.array(digests, pa.binary()),
            "fp": pa.array(np.frombuffer(b"".join(d[:8] for d in digests), np.int64), pa.int64()),
            "n_points": pc.cast(pc.utf8_length(texts), pa.int64()),
            "text_hash": batch.column(2),
        }
        if with_text:
            columns["plain"] = pa.array(plain, pa.binary())
        yield pa.RecordBatch.from_pydict(columns)


def text_digests(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """One row per document, nothing moved."""
    schema = "doc_id bigint, digest binary, fp bigint, n_points bigint, text_hash bigint" + (", plain binary" if with_text else "")
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(lambda batches: digest_batches(batches, with_text), schema)


# --- binary-fuse filter of 64-bit keys: three slots in neighbouring segments, 8-bit fingerprints


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = keys + np.uint64((seed * 0x9E3779B97F4A7C15) & (2**64 - 1))
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> np.uint64(33))


def _slots(h: np.ndarray, segment: int, segments: int) -> np.ndarray:
    start = ((h >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64) * segment
    inside = [(h >> np.uint64(shift)).astype(np.int64) & (segment - 1) for shift in (0, 16, 40)]
    return np.stack([start + i * segment + x for i, x in enumerate(inside)])


def build_filter(keys: np.ndarray) -> bytes:
    """Filter of distinct ``uint64`` keys. Keys of degree one are peeled in rounds, then slots are filled backwards."""
    keys = np.unique(keys)
    segment = 1 << max(2, int(np.log(max(len(keys), 2)) / np.log(3.33) + 2.25))
    segment = min(segment, 1 << 14)
    size = int(max(len(keys), 1) * max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(len(keys), 2)))) + 32
    segments = max(1, -(-size // segment) - 2)
    for seed in range(1, 1000):
        h = _mixed(keys, seed)
        slots = _slots(h, segment, segments)
        table = (segments + 2) * segment
        degree = np.bincount(slots.ravel(), minlength=table)
        owner = np.zeros(table, np.int64)
        for row in slots:
            np.bitwise_xor.at(owner, row, np.arange(len(keys)))
        rounds, left = [], len(keys)
        while left:
            single = np.flatnonzero(degree == 1)
            peeled, first = np.unique(owner[single], return_index=True)
            if not len(peeled):
                break
            rounds.append((peeled, single[first]))
            left -= len(peeled)
            for row in slots[:, peeled]:
                np.subtract.at(degree, row, 1)
                np.bitwise_xor.at(owner, row, peeled)
        if left:
            continue
        prints, values = (h & np.uint64(0xFF)).astype(np.uint8), np.zeros(table, np.uint8)
        for peeled, slot in reversed(rounds):
            a, b, c = slots[:, peeled]
            values[slot] = prints[peeled] ^ values[a] ^ values[b] ^ values[c]
        return np.array([seed, segment, segments], np.int64).tobytes() + values.tobytes()
    raise RuntimeError("no seed gives a filter")


def filter_holds(filter_: bytes, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be in the filter; never false for a key it was built with."""
    seed, segment, segments = (int(x) for x in np.frombuffer(filter_[:24], np.int64))
    values, h = np.frombuffer(filter_[24:], np.uint8), _mixed(keys, seed)
    a, b, c = _slots(h, segment, segments)
    return (values[a] ^ values[b] ^ values[c]) == (h & np.uint64(0xFF)).astype(np.uint8)


# --- snapshot


def _bucket(buckets: int) -> Column:
    return F.pmod(F.hash("fp"), F.lit(buckets))


def build_snapshot(docs: DataFrame, rows: DataFrame, path: str) -> int:
    """Write the immutable snapshot of ``docs`` (whose distinct ``rows`` are given) below ``path``; returns its buckets.

    ``exact`` holds the bytes of one row per digest. That row is found among the narrow rows, so that texts move once and
    spread over (digest, id): a digest with a third of all rows does not send its texts to one task.
    """
    spark = docs.sparkSession
    first = rows.groupBy("digest").agg(F.min(F.struct("text_hash", F.struct("doc_id"))).alias("first"))
    chosen = first.select("digest", F.col("first.text_hash").alias("text_hash"), F.col("first.col2.doc_id").alias("chosen"))
    texts = text_digests(docs, with_text=True)
    same = (texts.digest == chosen.digest) & (texts.text_hash == chosen.text_hash) & texts.doc_id.eqNullSafe(chosen.chosen)
    texts.join(chosen, same, "left_semi").select("fp", "digest", "plain").write.parquet(f"{path}/exact")
    distinct = rows.select("fp").distinct()
    buckets = max(1, -(-distinct.count() // BUCKET_DIGESTS))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = pdf["fp"].to_numpy(np.int64).view(np.uint64)
        return pd.DataFrame({"bucket": pdf["bucket"].iloc[:1], "filter": [build_filter(keys)]})

    keyed = distinct.withColumn("bucket", _bucket(buckets))
    keyed.groupBy("bucket").applyInPandas(build, "bucket int, filter binary").write.parquet(f"{path}/filters")
    return buckets


def screen(rows: DataFrame, path: str, buckets: int) -> DataFrame:
    """The distinct ``fp`` of ``rows`` that the snapshot's filters let through."""
    spark = rows.sparkSession
    filters = spark.read.schema("bucket int, filter binary").parquet(f"{path}/filters")

    def probe(keys: pd.DataFrame, built: pd.DataFrame) -> pd.DataFrame:
        if keys.empty or built.empty:
            return pd.DataFrame({"fp": np.zeros(0, np.int64)})
        fp = keys["fp"].to_numpy(np.int64)
        return pd.DataFrame({"fp": fp[filter_holds(built["filter"].iloc[0], fp.view(np.uint64))]})

    keyed = rows.select("fp").distinct().withColumn("bucket", _bucket(buckets))
    return keyed.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(probe, "fp bigint")


def confirm(docs: DataFrame, rows: DataFrame, positives: DataFrame, path: str) -> DataFrame:
    """``(digest)`` of the batch texts whose bytes equal a text in their exact bucket.

    One document stands for all with its digest and original text; it is found among the narrow ``rows``, so texts move
    spread over (digest, text, id), and a text with a third of all rows is compared once.
    """
    exact = docs.sparkSession.read.schema("fp bigint, digest binary, plain binary").parquet(f"{path}/exact")
    first = rows.join(positives, "fp", "left_semi").groupBy("digest", "text_hash").agg(F.min(F.struct("doc_id")).alias("first"))
    chosen = first.select("digest", "text_hash", F.col("first.doc_id").alias("chosen"))
    texts = text_digests(docs, with_text=True)
    same = (texts.digest == chosen.digest) & (texts.text_hash == chosen.text_hash) & texts.doc_id.eqNullSafe(chosen.chosen)
    picked = texts.join(chosen, same, "left_semi").select("fp", "digest", "plain")
    equal = (picked.fp == exact.fp) & (picked.plain == exact.plain)
    return picked.join(exact.hint("shuffle_merge"), equal, "left_semi").select("digest").distinct()


def exact_dedup(snapshot: DataFrame, batch: DataFrame) -> DataFrame:
    """One row per document of both inputs ``(doc_id, text)``, with the row its group keeps.

    Columns: ``doc_id, keep_id, group_size, kept, text_sha256, in_snapshot, screened`` (a batch row that the filters let
    through), ``text_hash`` (``xxhash64`` of the original). The row with the most code points in the original text stays, then the one with the smallest id.
    """
    spark: SparkSession = snapshot.sparkSession
    parts = [text_digests(df).withColumn("in_snapshot", F.lit(old)) for df, old in ((snapshot, True), (batch, False))]
    rows, _ = rewrite(parts[0].unionByName(parts[1]).groupBy("in_snapshot", *_ROW).agg(F.count(F.lit(1)).alias("copies")), "digests")
    old, new = rows.filter("in_snapshot"), rows.filter("not in_snapshot")
    path = scratch_path(spark, "snapshot")
    buckets = build_snapshot(snapshot, old, path)
    positives, _ = rewrite(screen(new, path, buckets), "positives")
    confirmed, _ = rewrite(confirm(batch, new, positives, path).withColumn("known", F.lit(True)), "confirmed")
    flagged = new.join(positives.withColumn("screened", F.lit(True)), "fp", "left").join(confirmed, "digest", "left")
    flagged = flagged.withColumns({"screened": F.coalesce("screened", F.lit(False)), "known": F.coalesce("known", F.lit(False))})
    everything = old.withColumns({"screened": F.lit(False), "known": F.lit(True)}).unionByName(flagged)
    rank = F.struct("n_points", F.coalesce(-F.col("doc_id"), F.lit(-(2**63)).cast("bigint")).alias("r"), "text_hash")
    ranked = everything.withColumn("rank", rank)
    # Old groups and groups of new rows only differ in ``known``; both are summed before they are shuffled.
    groups = ranked.groupBy("digest", "known").agg(
        F.sum("copies").alias("group_size"), F.max(F.struct("rank", F.struct("doc_id"), F.col("in_snapshot"))).alias("best")
    )
    joined = ranked.join(groups, ["digest", "known"])
    is_best = (F.col("rank") == F.col("best.rank")) & (F.col("in_snapshot") == F.col("best.in_snapshot"))
    each = joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return each.select(
        "doc_id",
        F.col("best.col2.doc_id").alias("keep_id"),
        "group_size",
        (is_best & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "in_snapshot",
        "screened",
        "text_hash",
    )
