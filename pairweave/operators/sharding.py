"""Cutting kept cells into shards, and everything that is known per shard: manifest, batch sizes, statistics."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from pairweave.operators.cells import CELL, cell_key
from pairweave.operators.numbering import SLICE_ROWS, hash_key, hash_slice, number_rows
from pairweave.session import cut_lineage

#: Token positions per batch; close to what the published run used over its cells.
DEFAULT_TOKEN_BUDGET = 116_000


def shard_count(n: Column, max_samples: int) -> Column:
    """Shards of a cell of ``n`` rows. A last shard of at most half the maximum joins the one before it."""
    base = F.greatest(F.lit(1), F.ceil(n / max_samples))
    rest = n % max_samples
    last = F.when((rest == 0) & (n > 0), F.lit(max_samples)).otherwise(rest)
    return F.when((base > 1) & (last <= max_samples * 0.5), base - 1).otherwise(base).cast("int")


def assign_shards(placed: DataFrame, cells: DataFrame, max_samples: int, key: str = "pair_id", seed: int = 42) -> DataFrame:
    """Add ``cell_rank`` (place in the seeded order of the cell), ``num_shards`` and ``shard_idx``; drop other cells.

    The cell counts are known, so each cell is cut into slices of a fixed number of rows, however large its shards are. Slices of
    small shards hold many of them whole, so few shards are split between tasks, and files. ``cells`` has at most ``num_cuts`` squared rows and is broadcast.
    """
    sized = cells.select(
        cell_key().alias("_cell"),
        shard_count(F.col("n"), max_samples).alias("num_shards"),
        F.greatest(F.lit(1), F.ceil(F.col("n") / SLICE_ROWS)).cast("int").alias("_slices"),
    )
    keyed = placed.withColumn("_cell", cell_key()).join(F.broadcast(sized), "_cell").withColumn("shuffle_key", hash_key(seed, key))
    keyed = keyed.withColumn("_slice", hash_slice(F.col("shuffle_key"), F.col("_slices")))
    ranked = number_rows(keyed, ["_cell"], "_slice", ["shuffle_key", key], "cell_rank")
    shard = F.least(F.floor(F.col("cell_rank") / max_samples), F.col("num_shards") - 1).cast("int")
    return ranked.withColumn("shard_idx", shard).drop("_cell", "_slice", "_slices", "shuffle_key")


def shard_manifest(sharded: DataFrame) -> DataFrame:
    """Manifest rows counted from sharded data."""
    return sharded.groupBy(*CELL, "shard_idx", "num_shards").agg(
        F.lit(0).alias("suggested_batch_size"), F.count(F.lit(1)).cast("int").alias("num_samples")
    )


def manifest_from_counts(cells: DataFrame, max_samples: int) -> DataFrame:
    """The same manifest from cell counts alone, so that writing it needs no further pass over the data."""
    sized = cells.withColumn("num_shards", shard_count(F.col("n"), max_samples))
    each = sized.withColumn("shard_idx", F.explode(F.when(F.col("num_shards") > 0, F.sequence(F.lit(0), F.col("num_shards") - 1))))
    first = F.col("shard_idx") * F.lit(max_samples).cast("bigint")
    size = F.when(F.col("shard_idx") == F.col("num_shards") - 1, F.col("n") - first).otherwise(F.lit(max_samples))
    return each.select(
        *CELL, "shard_idx", "num_shards", F.lit(0).alias("suggested_batch_size"), size.cast("int").alias("num_samples")
    )


def curriculum_order(shards: DataFrame) -> DataFrame:
    """Add ``position``: short targets first, then short sources, then shard index."""
    order = Window.partitionBy("tgt_start").orderBy("src_start", "shard_idx")
    # Few distinct targets: number within each target start and add the shards of all smaller ones.
    per_target = shards.groupBy("tgt_start").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("tgt_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_target.select("tgt_start", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    numbered = shards.join(offsets, "tgt_start").withColumn("position", F.col("_offset") + F.row_number().over(order) - 1)
    return numbered.select(*shards.columns, F.col("position").cast("bigint"))


def batch_size_for(src_end: Column, tgt_end: Column, budget: int = DEFAULT_TOKEN_BUDGET) -> Column:
    """Rows per batch so that the padded tokens of both sides stay within the budget; at least one."""
    return F.greatest(F.lit(1), F.floor(F.lit(budget) / (src_end + tgt_end))).cast("int")


def spread_batch_size(shards: DataFrame, size: Callable[[Column, Column], Column] = batch_size_for) -> DataFrame:
    """Work out one batch size per distinct cell (at most ``num_cuts`` squared) and copy it to all shards of the cell."""
    sizes = shards.select(*CELL).distinct().withColumn("suggested_batch_size", size(F.col("src_end"), F.col("tgt_end")))
    return shards.drop("suggested_batch_size").join(F.broadcast(sizes), CELL)


def largest_batch(fits: Callable[[int], bool], most: int = 16_384) -> int:
    """The largest batch size that a probe was seen to bear, by halving the sizes from 1 to ``most``; 0 if it bore none.

    At most ``ceil(log2(most))`` sizes are tried. A probe that raises does not bear the size.
    """
    low, high, best = 1, most, 0
    for _ in range((most - 1).bit_length()):
        if low > high:
            break
        size = (low + high) // 2
        try:
            held = bool(fits(size))
        except Exception:  # noqa: BLE001  out of memory, timed out, or whatever the probe meets
            held = False
        if held:
            best, low = size, size + 1
        else:
            high = size - 1
    return best


def probe_batch_size(shards: DataFrame, probe: Callable[[int, int, int], bool], most: int = 16_384) -> DataFrame:
    """One batch size per distinct cell by trying ``probe(src_end, tgt_end, size)``, copied to all shards of the cell.

    Cells are dealt out one to a task, since a probe may take long; it runs on the executors, so it must be picklable.
    """
    cells = shards.select(*CELL).distinct().withColumn("_cell", cell_key())
    count = max(1, cells.count())  # at most num_cuts squared

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for cells_ in batches:
            sizes = [largest_batch(lambda n, s=s, t=t: probe(s, t, n), most) for s, t in zip(cells_["src_end"].tolist(), cells_["tgt_end"].tolist())]
            yield pd.DataFrame({"_cell": cells_["_cell"], "suggested_batch_size": sizes})

    dealt = cells.select("_cell", "src_end", "tgt_end").repartitionByRange(count, "_cell")
    probed = cut_lineage(dealt.mapInPandas(run, "_cell bigint, suggested_batch_size int"))  # a probe is not run twice
    rest = [c for c in shards.columns if c != "suggested_batch_size"]
    return shards.select(*rest, cell_key().alias("_cell")).join(F.broadcast(probed), "_cell").select(*rest, "suggested_batch_size")


def reset_batch_size(shards: DataFrame) -> DataFrame:
    """Forget all batch sizes."""
    return shards.withColumn("suggested_batch_size", F.lit(0))


def plan_complete(shards: DataFrame) -> DataFrame:
    """One row: does every shard have a batch size? True for an empty manifest."""
    return shards.agg(F.coalesce(F.bool_and(F.col("suggested_batch_size") > 0), F.lit(True)).alias("complete"))


def scaled_batch(batch_size: Column, safety: float) -> Column:
    """Batch size after the safety factor; an error when nothing is left of it."""
    scaled = F.floor(batch_size * F.lit(float(safety)))
    message = F.lit("a shard has no batch size; spread_batch_size sets them")
    return F.when(scaled > 0, scaled).otherwise(F.raise_error(message).cast("bigint"))


def shard_iterations(batch_size: Column, num_samples: Column, safety: float, drop_last: bool = False) -> Column:
    """Batches in one shard."""
    scaled = scaled_batch(batch_size, safety)
    batches = F.floor(num_samples / scaled) if drop_last else F.ceil(num_samples / scaled)
    return batches.cast("bigint")


def epoch_iterations(shards: DataFrame, safety: float = 0.75, drop_last: bool = False) -> DataFrame:
    """One row: batches in one pass over all shards."""
    each = shard_iterations(F.col("suggested_batch_size"), F.col("num_samples"), safety, drop_last)
    return shards.agg(F.coalesce(F.sum(each), F.lit(0)).cast("bigint").alias("iterations"))


def bucket_stats(shards: DataFrame, totals: DataFrame) -> DataFrame:
    """Per-shard details next to the run's discard and padding percentages (null when nothing was read)."""
    tokens = F.col("total_actual_tokens") + F.col("total_padding")
    rates = totals.select(
        F.lit(1).alias("_k"),
        F.try_divide(F.col("discarded_samples") * 100.0, F.col("total_original_samples")).alias("discard_pct"),
        F.coalesce(F.try_divide(F.col("total_padding") * 100.0, tokens), F.lit(0.0)).alias("padding_pct"),
    )
    detail = shards.select(
        F.lit(1).alias("_k"),
        F.concat_ws("-", "src_start", F.col("src_end") - 1).alias("src_range"),
        F.concat_ws("-", "tgt_start", F.col("tgt_end") - 1).alias("tgt_range"),
        "num_samples",
        F.concat_ws("/", F.col("shard_idx") + 1, "num_shards").alias("shard"),
        "suggested_batch_size",
    )
    return detail.join(F.broadcast(rates), "_k").drop("_k")
