"""Fixed-size batches and their padding widths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pairweave.operators.numbering import SLICE_ROWS, number_rows, range_slice


def assign_batches(sharded: DataFrame, size: int | Column, max_samples: int) -> DataFrame:
    """Add ``batch_id`` and ``batch_pos`` within each shard; the tail batch is kept.

    A row's place in its shard follows from its place in the cell, so this is a projection. ``max_samples`` must be the
    shard size that ``assign_shards`` was given.
    """
    size = size if isinstance(size, Column) else F.lit(size)
    place = F.col("cell_rank") - F.col("shard_idx") * F.lit(max_samples).cast("bigint")
    return sharded.withColumns({"batch_id": F.floor(place / size).cast("bigint"), "batch_pos": (place % size).cast("int")})


def assign_batches_global(df: DataFrame, size: int, key: str = "pair_id", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Batches over a whole data set in key order (missing keys first), numbered slice by slice rather than in one task.

    The key may be of any ordered type; rows with equal keys come in any order.
    """
    numbered = number_rows(range_slice(df, key, "_slice", slice_rows), [], "_slice", [key], "_place").drop("_slice")
    return numbered.withColumns(
        {"batch_id": F.floor(F.col("_place") / size).cast("bigint"), "batch_pos": (F.col("_place") % size).cast("int")}
    ).drop("_place")


def dynamic_width(df: DataFrame, ids: str, batch: str = "batch_id") -> DataFrame:
    """Add ``width``, the longest row of each batch. A batch is one window group and holds at most the batch size."""
    return df.withColumn("width", F.max(F.size(ids)).over(Window.partitionBy(batch)))


def stack_batches(df: DataFrame, columns: Sequence[str], batch: Sequence[str] = ("batch_id",)) -> DataFrame:
    """One row per batch: the rows' arrays stacked in batch order. A batch is bounded by its size."""
    rows = F.array_sort(F.collect_list(F.struct("batch_pos", *columns)))
    return df.groupBy(*batch).agg(rows.alias("_rows")).select(*batch, *[F.col(f"_rows.{c}").alias(c) for c in columns])
