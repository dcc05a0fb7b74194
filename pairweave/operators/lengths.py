"""Length histograms and the cut points that minimise padding."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

RANGES = "array<struct<start:int,end:int>>"


class LengthRange(NamedTuple):
    """Half-open range of lengths: ``start <= length < end``."""

    start: int
    end: int


def length_histogram(df: DataFrame, length: str) -> DataFrame:
    """Rows per length; partial counts are combined before the shuffle, which moves one row per length and task."""
    return df.groupBy(F.col(length).alias("len")).agg(F.count(F.lit(1)).alias("cnt"))


def pair_histogram(df: DataFrame) -> DataFrame:
    """Rows per (src_len, tgt_len): the one pass over the data from which edges, cells and totals are derived."""
    return df.groupBy("src_len", "tgt_len").agg(F.count(F.lit(1)).alias("cnt"))


def side_histograms(pairs: DataFrame) -> DataFrame:
    """``(side, len, cnt)`` of both sides out of a pair histogram."""
    sides = F.expr("stack(2, 'src', src_len, 'tgt', tgt_len)").alias("side", "len")
    return pairs.select(sides, "cnt").groupBy("side", "len").agg(F.sum("cnt").alias("cnt"))


def small_cuts(hist: DataFrame) -> DataFrame:
    """One range per length, each ending where the next begins; used when there are no more lengths than cuts."""
    following = F.lead("len").over(Window.orderBy("len"))
    return hist.select(F.col("len").cast("int").alias("start"), F.coalesce(following, F.col("len") + 1).cast("int").alias("end"))


def optimal_cuts(hist: DataFrame, num_cuts: int, by: Sequence[str] = ()) -> DataFrame:
    """Exactly ``num_cuts`` ranges ``(*by, bucket, start, end)`` with the least total padding, ties to the smallest cut.

    Spark reduces the data to one row per distinct length; that histogram is gathered as two arrays and cut in one
    vectorised call. The number of lengths is bounded by the longest sentence, not by the data.
    ``by`` names columns of ``hist`` that separate independent histograms, such as the two sides of a grid.
    """
    entry = F.struct(F.col("len").cast("bigint").alias("len"), F.col("cnt").cast("bigint").alias("cnt"))
    gathered = hist.groupBy(*by).agg(F.array_sort(F.collect_list(entry)).alias("h"))
    cut = _cuts_udf(num_cuts)(F.col("h.len"), F.col("h.cnt"))
    ranges = gathered.select(*by, F.posexplode(cut).alias("bucket", "r"))
    return ranges.select(*by, "bucket", "r.start", "r.end")


def _cuts_udf(num_cuts: int):
    @F.pandas_udf(RANGES)
    def cut(lengths: pd.Series, counts: pd.Series) -> pd.Series:
        return pd.Series(
            [[{"start": s, "end": e} for s, e in plan_cuts(np.asarray(n), np.asarray(c), num_cuts)] for n, c in zip(lengths, counts)]
        )

    return cut


def plan_cuts(lengths: np.ndarray, counts: np.ndarray, num_cuts: int) -> list[tuple[int, int]]:
    """Cut a sorted histogram into ``num_cuts`` groups with the least padding.

    Padding all of lengths k+1..i to length i costs ``L_i (C_i - C_k) - (S_i - S_k)`` with prefix counts C and prefix
    token sums S. That cost is Monge, so within a layer the best k never decreases with i, and each layer is solved
    level by level, halving the open intervals: about ``num_cuts * n * log n`` array steps.
    """
    n = len(lengths)
    if n == 0:
        return []
    if n <= num_cuts:
        ends = np.append(lengths[1:], lengths[-1] + 1)
        return list(zip(lengths.tolist(), ends.tolist()))
    size = np.concatenate(([0], lengths)).astype(np.int64)
    rows = np.concatenate(([0], np.cumsum(counts))).astype(np.int64)
    tokens = np.concatenate(([0], np.cumsum(lengths * counts))).astype(np.int64)

    best = size * rows - tokens
    choices = []
    for layer in range(2, num_cuts + 1):
        best, choice = _relax(best, layer, size, rows, tokens)
        choices.append(choice)
    stops = [n]
    for choice in reversed(choices):
        stops.append(int(choice[stops[-1]]))
    stops.append(0)
    stops.reverse()
    return [(int(size[k + 1]), int(size[i] + 1)) for k, i in zip(stops, stops[1:])]


def _relax(best, layer, size, rows, tokens):
    n = len(size) - 1
    cost = np.zeros(n + 1, dtype=np.int64)
    choice = np.full(n + 1, layer - 1, dtype=np.int64)
    first, last = np.array([layer]), np.array([n])
    low, high = np.array([layer - 1]), np.array([n - 1])
    while first.size:
        mid = (first + last) // 2
        width = np.minimum(high, mid - 1) - low + 1
        starts = np.cumsum(width) - width
        k = np.arange(width.sum()) - np.repeat(starts - low, width)
        i = np.repeat(mid, width)
        total = best[k] + size[i] * (rows[i] - rows[k]) - (tokens[i] - tokens[k])
        least = np.minimum.reduceat(total, starts)
        hits = np.flatnonzero(total == np.repeat(least, width))
        picked = k[hits[np.searchsorted(hits, starts)]]
        cost[mid], choice[mid] = least, picked
        left, right = first < mid, mid < last
        first, last, low, high = (
            np.concatenate((first[left], mid[right] + 1)),
            np.concatenate((mid[left] - 1, last[right])),
            np.concatenate((low[left], picked[right])),
            np.concatenate((picked[left], high[right])),
        )
    return cost, choice


def collect_ranges(cuts: DataFrame) -> list[LengthRange]:
    """The edge list as plain values: at most ``num_cuts`` rows, whatever the data size."""
    return sorted(LengthRange(r.start, r.end) for r in cuts.select("start", "end").collect())


def collect_sides(cuts: DataFrame) -> tuple[list[LengthRange], list[LengthRange]]:
    """The edge lists of both sides out of cuts made by ``side``."""
    rows = cuts.select("side", "start", "end").collect()
    src, tgt = (sorted(LengthRange(r.start, r.end) for r in rows if r.side == side) for side in ("src", "tgt"))
    return src, tgt


#: Lengths up to here are placed by an array of one entry per length; ranges that end later by comparisons.
LOOKUP_LENGTHS = 1 << 16


def range_value(length: Column, ranges: list[LengthRange], values: list[int]) -> Column:
    """The value that belongs to the range holding a length, null where none does. ``ranges`` must be sorted.

    The array of values by length is one constant, so the result is a single cheap expression over the length: Spark may
    repeat it wherever it is used. (``get`` is used because ``element_at`` is not null-safe in its index under ANSI mode.)
    """
    if not ranges:
        return F.lit(None).cast("int")
    if ranges[-1].end <= LOOKUP_LENGTHS:
        by_length: list[int | None] = [None] * ranges[-1].end
        for r, value in zip(ranges, values):
            by_length[r.start : r.end] = [value] * (r.end - r.start)
        return F.get(F.from_json(F.lit(json.dumps(by_length)), "array<int>"), length)
    begun = reduce(lambda a, b: a + b, [(length >= r.start).cast("int") for r in ranges])
    constant = lambda of: F.from_json(F.lit(json.dumps(of)), "array<int>")
    return F.when(length < F.get(constant([r.end for r in ranges]), begun - 1), F.get(constant(values), begun - 1))


def range_index(length: Column, ranges: list[LengthRange]) -> Column:
    """Index of the range that holds a length, null where none does."""
    return range_value(length, ranges, list(range(len(ranges))))


def assign_range(df: DataFrame, length: str, ranges: list[LengthRange], prefix: str) -> DataFrame:
    """Add ``{prefix}_bucket``, ``{prefix}_start`` and ``{prefix}_end``; null where no range holds the length.

    A projection over constants: no join and no shuffle.
    """
    values = {"bucket": list(range(len(ranges))), "start": [r.start for r in ranges], "end": [r.end for r in ranges]}
    return df.withColumns({f"{prefix}_{name}": range_value(F.col(length), ranges, of) for name, of in values.items()})
