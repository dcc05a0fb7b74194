"""Seeded shuffles that give the same order on any cluster layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairweave.operators.numbering import hash_key, hash_slice, number_rows, slices_for


def seeded_shuffle(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Rows in pseudo-random order: one range-partitioned sort on a hash of the row's key."""
    return df.withColumn("shuffle_key", hash_key(seed, key)).orderBy("shuffle_key", key)


def shuffle_rank(df: DataFrame, key: str, seed: int = 42, slices: int | None = None) -> DataFrame:
    """Add ``shuffle_rank``, each row's 0-based place in the seeded order, without sorting everything in one task."""
    keyed = df.withColumn("shuffle_key", hash_key(seed, key))
    keyed = keyed.withColumn("_slice", hash_slice(F.col("shuffle_key"), slices or slices_for(df.count())))
    return number_rows(keyed, [], "_slice", ["shuffle_key", key], "shuffle_rank").drop("_slice")
