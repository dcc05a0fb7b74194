"""A corpus in blocks: rows that hold a few megabytes of documents each, stored so that answers can be brought to them.

Some operators ask the whole corpus about each word or word run ("how often", "where first"). Sending every occurrence
through a shuffle costs many times the text. Here a block asks once for each distinct key it holds; keys are dealt to
buckets by their upper bits, a bucket answers all blocks, and a block meets its answers again by its number. The store is
bucketed by that number, so the texts themselves are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from pairweave.session import scratch_table

#: Bytes of text after which a block is closed; a longer text is a block of its own.
BLOCK_BYTES = 3 << 20
#: Bytes of text per bucket of keys and per bucket of the store.
BUCKET_BYTES = 8 << 20
_STORED = "block bigint, raw_bytes bigint, ids array<bigint>, sizes array<int>, texts binary"


@dataclass
class Block:
    """Ids and texts in order: by id (null last), then by text."""

    number: int
    ids: list[int | None]
    texts: list[bytes]


def _close(number: int, rows: list[tuple[int | None, bytes]]) -> dict:
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    joined = b"".join(t for _, t in rows)
    return {
        "block": number,
        "raw_bytes": len(joined),
        "ids": [i for i, _ in rows],
        "sizes": [len(t) for _, t in rows],
        "texts": zstandard.ZstdCompressor(level=1).compress(joined),
    }


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("block", pa.int64()), ("raw_bytes", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("texts", pa.binary())])
    number, rows, held = TaskContext.get().partitionId() << 32, [], 0
    for batch in batches:
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            raw = (text or "").encode()
            rows.append((i, raw))
            held += len(raw) + 64
            if held >= BLOCK_BYTES:
                yield pa.RecordBatch.from_pylist([_close(number, rows)], schema)
                number, rows, held = number + 1, [], 0
    if rows:
        yield pa.RecordBatch.from_pylist([_close(number, rows)], schema)


def blocks_in(batch: pa.RecordBatch) -> Iterator[tuple[int, Block]]:
    """``(row number, block)`` of the rows of a stored batch."""
    for row in range(len(batch)):
        texts = zstandard.ZstdDecompressor().decompress(batch.column("texts")[row].as_py())
        ends = np.cumsum([0, *batch.column("sizes")[row].as_py()])
        yield row, Block(batch.column("block")[row].as_py(), batch.column("ids")[row].as_py(), [texts[a:b] for a, b in zip(ends[:-1], ends[1:])])


@dataclass
class BlockStore:
    """The stored blocks (a table bucketed by block number) and the number of key buckets, a power of two."""

    spark: SparkSession
    table: str
    bits: int

    @property
    def blocks(self) -> DataFrame:
        return self.spark.table(self.table)

    def with_answers(self, answers: DataFrame, name: str, blocks: DataFrame | None = None) -> DataFrame:
        """Blocks (those of the store, or ``blocks`` made from them) with an array ``name`` of their rows of ``answers``
        (all columns but ``block``); null where there are none."""
        columns = [c for c in answers.columns if c != "block"]
        per_block = answers.groupBy("block").agg(F.collect_list(F.struct(*columns)).alias(name))
        return (self.blocks if blocks is None else blocks).join(per_block.hint("shuffle_hash"), "block", "left")


def store_blocks(docs: DataFrame) -> BlockStore:
    """Store ``docs`` (``doc_id, text``) in the warehouse. Numbers come from the task and its progress, and stay once written."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 1)).first()[0] or 0
    # No fewer than answers are dealt to by default, or a join would rather deal the blocks anew.
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // (4 * BUCKET_BYTES)))
    table = scratch_table("blocks")
    stored = docs.select("doc_id", "text").mapInArrow(_blocks, _STORED)
    stored.write.bucketBy(buckets, "block").format("parquet").option("compression", "uncompressed").saveAsTable(table)
    return BlockStore(spark, table, max(6, int(np.ceil(np.log2(max(1, size / BUCKET_BYTES))))))


def dealt(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """``(bucket, range)`` of sorted keys by their upper bits; buckets without keys are left out."""
    cuts = np.searchsorted(keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
    for bucket in np.flatnonzero(np.diff(cuts)).tolist():
        yield bucket, slice(int(cuts[bucket]), int(cuts[bucket + 1]))


def within(values: np.ndarray, sorted_keys: np.ndarray) -> np.ndarray:
    """Whether each value is among the sorted keys."""
    if not len(sorted_keys):
        return np.zeros(len(values), bool)
    return sorted_keys[np.minimum(np.searchsorted(sorted_keys, values), len(sorted_keys) - 1)] == values


def planes(values: np.ndarray) -> bytes:
    """The bytes of an integer array, all first bytes, then all second ones and so on, which shuffles compress better."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def from_planes(data: bytes, dtype: type) -> np.ndarray:
    """The inverse of ``planes``."""
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as differences, by planes: what the keys of one bucket share costs nothing."""
    return planes(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    """The inverse of ``pack_keys``."""
    return np.cumsum(from_planes(data, np.uint64), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    """Counts of any size as planes of the fewest bytes that hold the largest, behind that number of bytes."""
    kind = np.min_scalar_type(int(counts.max(initial=0)))
    return bytes([kind.itemsize]) + planes(counts.astype(kind))


def unpack_counts(data: bytes) -> np.ndarray:
    """The inverse of ``pack_counts``."""
    return from_planes(data[1:], np.dtype(f"u{data[0]}").type).astype(np.int64)
