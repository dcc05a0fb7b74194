"""The two-dimensional grid of length ranges: counting cells, dropping thin ones, padding totals."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pairweave.operators.lengths import (
    LengthRange,
    assign_range,
    collect_sides,
    optimal_cuts,
    pair_histogram,
    side_histograms,
)
from pairweave.session import cut_lineage

#: Most edges per side: a million cells, the largest table of cells that is broadcast.
MAX_CUTS = 1000

CELL = ["src_start", "src_end", "tgt_start", "tgt_end"]


@dataclass(frozen=True)
class Grid:
    """Edges of both sides and the pair histogram they were computed from."""

    src: list[LengthRange]
    tgt: list[LengthRange]
    pairs: DataFrame

    @property
    def placed(self) -> DataFrame:
        """The histogram with every (src_len, tgt_len) placed in its cell."""
        return assign_cell(self.pairs, self.src, self.tgt)


def build_grid(df: DataFrame, num_cuts: int) -> Grid:
    """Edges of both sides from one pass over ``df``.

    ``num_cuts`` is checked, since up to its square of cells is broadcast later.

    The pair histogram is written once, since the edges, cell counts and totals all start from it; it has one row per
    length pair, however many sentences there are.
    """
    if not 0 < num_cuts <= MAX_CUTS:
        raise ValueError(f"num_cuts must be between 1 and {MAX_CUTS}")
    pairs = cut_lineage(pair_histogram(df))
    src, tgt = collect_sides(optimal_cuts(side_histograms(pairs), num_cuts, by=["side"]))
    return Grid(src, tgt, pairs)


def assign_cell(df: DataFrame, src: list[LengthRange], tgt: list[LengthRange]) -> DataFrame:
    """Add the ranges of both lengths. A projection: nothing is joined or shuffled."""
    return assign_range(assign_range(df, "src_len", src, "src"), "tgt_len", tgt, "tgt")


def cell_key() -> Column:
    """One number for the cell of a row, from its two range starts; -1 where it has none.

    Joins use it instead of the four range columns: it is never null, so Spark infers no filter that would repeat how the
    ranges were found.
    """
    return F.coalesce(F.shiftleft(F.col("src_start").cast("bigint"), 32) + F.col("tgt_start"), F.lit(-1).cast("bigint"))


def _matched(placed: DataFrame, cells: DataFrame, how: str) -> DataFrame:
    keys = F.broadcast(cells.select(cell_key().alias("_cell")))
    return placed.withColumn("_cell", cell_key()).join(keys, "_cell", how).drop("_cell")


def count_cells(placed: DataFrame, weight: str | None = None) -> DataFrame:
    """Rows per non-empty cell; ``weight`` names the count column when ``placed`` is a histogram."""
    rows = F.sum(weight) if weight else F.count(F.lit(1))
    inside = placed.filter(F.col("src_start").isNotNull() & F.col("tgt_start").isNotNull())
    return inside.groupBy(*CELL).agg(rows.cast("bigint").alias("n"))


def cell_grid(spark: SparkSession, src: list[LengthRange], tgt: list[LengthRange], counts: DataFrame) -> DataFrame:
    """Every cell of the grid with its count, empty cells included; at most ``num_cuts`` squared rows."""
    cells = [(*s, *t) for s in src for t in tgt]
    grid = spark.createDataFrame(cells, ", ".join(f"{c} int" for c in CELL))
    counted = counts.select(cell_key().alias("_cell"), "n")
    return grid.withColumn("_cell", cell_key()).join(counted, "_cell", "left").select(*CELL, F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


def filter_min_samples(counts: DataFrame, min_samples: int) -> DataFrame:
    """Cells with at least ``min_samples`` rows."""
    return counts.filter(F.col("n") >= min_samples)


def valid_cells(grid: Grid, min_samples: int) -> DataFrame:
    """The kept cells of a grid, counted on its histogram."""
    return filter_min_samples(count_cells(grid.placed, "cnt"), min_samples)


def keep_valid(placed: DataFrame, cells: DataFrame) -> DataFrame:
    """Rows whose cell is kept. ``cells`` has at most ``num_cuts`` squared rows, hence the broadcast."""
    return _matched(placed, cells, "left_semi")


def discarded(placed: DataFrame, cells: DataFrame) -> DataFrame:
    """Rows whose cell was dropped, or whose lengths no range holds."""
    return _matched(placed, cells, "left_anti")


def padding_totals(kept: DataFrame, weight: str | None = None) -> DataFrame:
    """Kept rows, padding up to the last length of the cell, and real tokens, in one global aggregate."""
    times = F.col(weight) if weight else F.lit(1)
    pad = (F.col("src_end") - 1 - F.col("src_len")) + (F.col("tgt_end") - 1 - F.col("tgt_len"))
    total = lambda value: F.coalesce(F.sum(value.cast("bigint") * times), F.lit(0)).cast("bigint")
    return kept.agg(
        total(F.lit(1)).alias("total_samples"),
        total(pad).alias("total_padding"),
        total(F.col("src_len") + F.col("tgt_len")).alias("total_actual_tokens"),
    )


def grid_totals(grid: Grid, num_cuts: int, min_samples: int, max_samples: int) -> DataFrame:
    """The one-row run summary, computed on the histogram instead of the rows."""
    kept = keep_valid(grid.placed, valid_cells(grid, min_samples))
    original = grid.pairs.agg(F.coalesce(F.sum("cnt"), F.lit(0)).cast("bigint").alias("total_original_samples"))
    both = padding_totals(kept, "cnt").withColumn("k", F.lit(1)).join(original.withColumn("k", F.lit(1)), "k")
    return both.select(
        F.lit(num_cuts).alias("num_cuts"),
        F.lit(min_samples).alias("min_samples"),
        F.lit(max_samples).alias("max_samples"),
        "total_samples",
        "total_original_samples",
        (F.col("total_original_samples") - F.col("total_samples")).alias("discarded_samples"),
        "total_padding",
        "total_actual_tokens",
    )
