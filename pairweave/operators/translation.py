"""Batch translation through a supplied model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Called once per worker task; gives a function from a list of sources to a list of translations.
TranslatorFactory = Callable[[], Callable[[list[str]], list[str]]]


def translate_batches(
    df: DataFrame, translator: TranslatorFactory, batch_size: int = 512, key: str = "pair_id", source: str = "src_text"
) -> DataFrame:
    """Add ``hyp_text``. Rows are range-partitioned by source length, so a batch holds sentences of similar length.

    The key is part of the range, which splits a length that a large share of all sentences has. Batches run across the
    frames of a task, so only its last one is smaller. A missing source gives a missing translation.
    """
    sized = df.withColumn("_len", F.char_length(source))
    sorted_rows = sized.repartitionByRange("_len", key).sortWithinPartitions("_len", key).drop("_len")
    schema = StructType([*sorted_rows.schema.fields, StructField("hyp_text", StringType())])

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        translate, left, waiting = None, [], 0  # rows of a batch that is not yet full

        def translated(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            nonlocal translate
            translate = translate or translator()
            (part,) = pa.Table.from_batches(parts).combine_chunks().to_batches()
            sources = part.column(source).to_pylist()
            there = [s for s in sources if s is not None]
            found = iter(translate(there) if there else [])
            out = [None if s is None else next(found) for s in sources]
            return pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.string())], [*part.schema.names, "hyp_text"])

        for frame in frames:
            at = 0
            while at < len(frame):
                part = frame.slice(at, batch_size - waiting)
                left, waiting, at = [*left, part], waiting + len(part), at + len(part)
                if waiting == batch_size:
                    yield translated(left)
                    left, waiting = [], 0
        if left:
            yield translated(left)

    return sorted_rows.mapInArrow(run, schema)
