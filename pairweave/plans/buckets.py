"""From tokenised pairs to stored shards and their manifest."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession

from pairweave.operators.cells import assign_cell, build_grid, grid_totals, valid_cells
from pairweave.operators.sharding import assign_shards, batch_size_for, manifest_from_counts, probe_batch_size, spread_batch_size
from pairweave.session import cut_lineage, remove
from pairweave.sources.manifest import load_manifest, manifest_exists, read_pointer, write_manifest
from pairweave.sources.shards import write_shards


class Plan(NamedTuple):
    """What shard assignment gives: rows with shard keys, manifest rows, run totals."""

    sharded: DataFrame
    shards: DataFrame
    totals: DataFrame


def plan_buckets(
    pairs: DataFrame, num_cuts: int, min_samples: int, max_samples: int, key: str = "pair_id", seed: int = 42
) -> Plan:
    """Place every pair in a cell and shard.

    ``pairs`` has ``src_len`` and ``tgt_len``. One pass builds the pair histogram; edges, cells, manifest and totals
    come from it. The rows themselves are read for slice counts (three narrow columns) and once for the shards.
    """
    grid = build_grid(pairs, num_cuts)
    cells = cut_lineage(valid_cells(grid, min_samples))
    placed = assign_cell(pairs, grid.src, grid.tgt)
    sharded = assign_shards(placed, cells, max_samples, key, seed)
    return Plan(sharded, manifest_from_counts(cells, max_samples), grid_totals(grid, num_cuts, min_samples, max_samples))


def build_buckets(
    spark: SparkSession,
    path: str,
    pairs: DataFrame | None = None,
    num_cuts: int = 16,
    min_samples: int = 1024,
    max_samples: int = 524_288,
    force_rebuild: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``(shards, totals)`` of the bucket store at ``path``.

    A complete store is loaded unless ``force_rebuild``; otherwise ``pairs`` are bucketed and written. Without pairs
    and without a store the call fails. Every build writes a data folder of its own, and the manifest names it: until the
    manifest is in place readers see the old build, data and all, or none.
    """
    if not path:
        raise ValueError("path cannot be empty")
    exists = manifest_exists(spark, f"{path}/manifest")
    if pairs is None and not exists:
        raise FileNotFoundError(f"{path} holds no shards, and no pairs were given to make them from")
    if pairs is not None and (force_rebuild or not exists):
        before = data_path(spark, path) if exists else None
        plan = plan_buckets(pairs, num_cuts, min_samples, max_samples)
        build = f"data-{uuid.uuid4().hex}"
        write_shards(plan.sharded, f"{path}/{build}")
        write_manifest(plan.shards, plan.totals, f"{path}/manifest", build)
        if before:
            remove(spark, before)
    return load_manifest(spark, f"{path}/manifest")


def data_path(spark: SparkSession, path: str) -> str:
    """The folder with the shards of the store at ``path``."""
    return f"{path}/{read_pointer(spark, f'{path}/manifest')[1]}"


def save_batch_sizes(
    spark: SparkSession, path: str, size: Callable[[Column, Column], Column] = batch_size_for, probe: Callable[[int, int, int], bool] | None = None
) -> DataFrame:
    """Work out the batch size of every shard of the store at ``path``, save them in its manifest, and return the shards.

    ``probe(src_end, tgt_end, size)``, if given, is tried for each cell instead of computing ``size``.
    """
    shards, totals = load_manifest(spark, f"{path}/manifest")
    sized = spread_batch_size(shards, size) if probe is None else probe_batch_size(shards, probe)
    write_manifest(sized, totals, f"{path}/manifest")
    return load_manifest(spark, f"{path}/manifest")[0]
