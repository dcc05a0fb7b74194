"""Row numbers and running totals inside groups that may be far larger than one task.

``row_number() OVER (PARTITION BY g ORDER BY k)`` sorts a whole group in one task, so a group with a third of all rows
stops the job. Here each group is cut into *slices* that follow the order (every key of slice 0 sorts before every key
of slice 1). The rows of each slice are counted first, with map-side combine; a prefix sum over those few counts gives
each slice its offset; and the window then only spans one slice.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

#: Rows that one slice, and so one window, holds on average.
SLICE_ROWS = 100_000


def hash_key(seed: int | Column, *keys: Column | str) -> Column:
    """A sort key that looks random but depends only on the seed and the row's own key, never on its partition."""
    seed = seed if isinstance(seed, Column) else F.lit(str(seed))
    return F.md5(F.concat_ws(":", seed.cast("string"), *[F.col(k) if isinstance(k, str) else k for k in keys]))


def hash_slice(key: Column, slices: int | Column) -> Column:
    """Slice number of a hexadecimal hash key, monotone in the key, so equal shares of the key space."""
    head = F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint")
    slices = slices if isinstance(slices, Column) else F.lit(slices)
    return F.shiftrightunsigned(head * slices.cast("bigint"), 32).cast("int")


def slices_for(rows: int) -> int:
    """How many slices ``rows`` rows are cut into."""
    return max(1, -(-rows // SLICE_ROWS))


def number_rows(
    df: DataFrame,
    groups: Sequence[str],
    slice_col: str,
    order: Sequence[str],
    out: str,
    running: dict[str, str] | None = None,
) -> DataFrame:
    """Add ``out``: the 0-based position of each row in its group.

    ``order`` must be a total order and ``slice_col`` must not decrease along it. ``running`` maps an output column to
    a numeric column whose total over all *earlier* rows of the group is wanted. The offsets hold one row per slice;
    the join on (groups, slice) leaves rows partitioned as the window needs them, so the rows are shuffled once.
    """
    running = running or {}
    keys = [*groups, slice_col]
    sliced = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(c).cast("bigint").alias(f"_sum_{o}") for o, c in running.items()]
    )
    before = Window.partitionBy(*groups).orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    offsets = sliced.select(
        *keys,
        F.coalesce(F.sum("_rows").over(before), zero).alias("_offset"),
        *[F.coalesce(F.sum(f"_sum_{o}").over(before), zero).alias(f"_from_{o}") for o in running],
    )
    inside = Window.partitionBy(*keys).orderBy(*order)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice, so the offsets of a partition always fit a hash table and the rows are sorted only once.
    joined = df.join(offsets.hint("shuffle_hash"), keys)
    added = {out: F.col("_offset") + F.row_number().over(inside) - 1}
    for name, column in running.items():
        added[name] = F.col(f"_from_{name}") + F.coalesce(F.sum(column).over(earlier), F.lit(0)).cast("bigint")
    return joined.withColumns(added).drop("_offset", *[f"_from_{o}" for o in running])


def range_slice(df: DataFrame, key: str, out: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Add ``out``, the slice of a key of any ordered type, so that a slice has about ``slice_rows`` rows.

    The cuts are taken from the keys with the least hashes, 20 for each slice and at most a million, which is what
    reaches the driver. Any cuts give right results, better ones only give more even slices. Missing keys are in the first.
    """
    slices = max(1, -(-df.count() // slice_rows))
    if slices == 1:
        return df.withColumn(out, F.lit(0))
    sample = df.select(key).filter(F.col(key).isNotNull()).orderBy(F.xxhash64(key), key).limit(min(20 * slices, 1_000_000))
    keys = np.array(sorted(r[0] for r in sample.collect()), dtype=object)
    cuts = df.sparkSession.sparkContext.broadcast(keys[np.unique(np.arange(1, slices) * len(keys) // slices)] if len(keys) else keys)

    @F.pandas_udf("int")
    def place(values: pd.Series) -> pd.Series:
        there = values.notna()
        found = np.zeros(len(values), np.int32)
        found[there] = np.searchsorted(cuts.value, values[there].to_numpy(object), "right")
        return pd.Series(found)

    return df.withColumn(out, place(key))
