"""The row-wise part of preprocessing on a stream of pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pairweave.operators.cells import assign_cell
from pairweave.operators.lengths import LengthRange
from pairweave.operators.vocabulary import Bpe
from pairweave.plans.preprocess import tokenize_pairs
from pairweave.sources.bitext import PAIR_SCHEMA, flatten_pairs, validate_bitext


def stream_bitext(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """Pairs as files arrive in a folder."""
    return spark.readStream.schema(PAIR_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def place_stream(
    stream: DataFrame, src: Bpe, tgt: Bpe, src_ranges: list[LengthRange], tgt_ranges: list[LengthRange], max_length: int = 128
) -> DataFrame:
    """Validate, encode, filter, shift and place pairs, given a vocabulary and edges. Stateless, so nothing is kept."""
    pairs = flatten_pairs(validate_bitext(stream, "drop"))
    return assign_cell(tokenize_pairs(pairs, src, tgt, max_length), src_ranges, tgt_ranges)


def append_placed(placed: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append placed pairs to a parquet folder and stop when the waiting files are done; restartable exactly once."""
    writer = placed.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(availableNow=True).start()
