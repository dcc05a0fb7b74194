"""Conversation turns in order, as rows that hold a bounded stretch of one conversation each.

Turns are range partitioned by conversation and place and sorted, so a conversation of any length is dealt over as many
tasks as its share of the rows asks for. A chunk is a stretch of one conversation inside one task. Most conversations are
one chunk; those that may go on in another chunk are marked ``edge``, and only these need a shuffle to be put together.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

#: Most turns, and about the most bytes of text, in a chunk; a longer turn is a chunk of its own.
CHUNK_ROWS = 1024
CHUNK_BYTES = 1 << 20
_SCHEMA = "conv_key string, conv_id bigint, part int, seq bigint, edge boolean, turns array<bigint>, roles array<string>, texts array<string>"
_ARROW = pa.schema([
    ("conv_key", pa.string()), ("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int64()), ("edge", pa.bool_()),
    ("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
])


def chunk_turns(turns: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Chunks of ``turns`` (``conv_id, turn, role, text``); ``(part, seq)`` is their order in a conversation.

    Rows come by turn, nulls first, then by role and text. ``conv_key`` is the id as text, ``null`` for the rows without
    an id, which are one conversation. Write the result before it is used twice: ``part`` numbers this plan's tasks.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, conversations, conv, held, size, split = TaskContext.get().partitionId(), 0, 0, None, [], 0, False
        out, weight = [], 0

        def close(edge: bool) -> None:
            nonlocal seq, held, size, weight
            columns = zip(*held)
            out.append({"conv_key": "null" if conv is None else str(conv), "conv_id": conv, "part": part, "seq": seq, "edge": edge} | dict(zip(("turns", "roles", "texts"), map(list, columns))))
            seq, weight, held, size = seq + 1, weight + size, [], 0

        for batch in batches:
            for conv_id, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and conv_id != conv:
                    close(conversations == 1 or split)
                if not conversations or conv_id != conv:
                    conv, split, conversations = conv_id, False, conversations + 1
                if held and (len(held) >= chunk_rows or size >= chunk_bytes):
                    split = True
                    close(True)
                held.append(row)
                size += 16 + len(row[2] or "")
                if weight > CHUNK_BYTES:
                    yield pa.RecordBatch.from_pylist(out, _ARROW)
                    out, weight = [], 0
        if held:
            close(True)
        if out:
            yield pa.RecordBatch.from_pylist(out, _ARROW)

    rows = turns.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.col("role").cast("string"), F.col("text").cast("string"))
    # A text's beginning sorts as the text does, and keeps what the range sampler sends to the driver small.
    dealt = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 32))
    return dealt.sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(cut, _SCHEMA)
