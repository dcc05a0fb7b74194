"""The order in which a training run meets its batches, with rates per step and a resume point."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairweave.functions.schedule import lr_at, teacher_ratio
from pairweave.operators.numbering import hash_key, hash_slice, number_rows, slices_for
from pairweave.operators.sharding import shard_iterations



def epoch_order(shards: DataFrame, epochs: int, seed: int = 42, safety: float = 0.75) -> DataFrame:
    """Every shard once per epoch with its ``position`` and ``steps_before`` in that epoch.

    Epoch 0 goes from short to long; each later epoch is a seeded shuffle of its own. Positions are numbered slice by
    slice: in epoch 0 a slice is one target start, later a share of the hash keys.
    """
    each = shards.withColumn("epoch", F.explode(F.lit(list(range(epochs))) if epochs > 0 else F.array().cast("array<int>")))
    mixed = hash_key(F.concat_ws(":", F.lit(seed), "epoch"), "src_start", "tgt_start", "shard_idx")
    first = F.concat_ws(":", *[F.lpad(F.col(c).cast("string"), 10, "0") for c in ("tgt_start", "src_start", "shard_idx")])
    keyed = each.withColumns(
        {
            "iterations": shard_iterations(F.col("suggested_batch_size"), F.col("num_samples"), safety),
            "_key": F.when(F.col("epoch") == 0, first).otherwise(mixed),
        }
    )
    keyed = keyed.withColumn(
        "_slice", F.when(F.col("epoch") == 0, F.col("tgt_start")).otherwise(hash_slice(mixed, slices_for(shards.count())))
    )
    numbered = number_rows(
        keyed, ["epoch"], "_slice", ["_key"], "position", running={"steps_before": "iterations"}
    )
    return numbered.drop("_slice", "_key")


def training_plan(shards: DataFrame, epochs: int = 12, seed: int = 42, safety: float = 0.75) -> DataFrame:
    """One row per batch: epoch, shard position, batch in the shard, global step, learning rate and teacher ratio.

    No epochs give no rows, and a shard without rows no batches. Every epoch has the same number of steps, so the global step is the epoch's offset plus the steps before the shard.
    """
    ordered = epoch_order(shards, epochs, seed, safety)
    total = shards.agg(
        F.sum(shard_iterations(F.col("suggested_batch_size"), F.col("num_samples"), safety)).alias("epoch_steps"),
        F.lit(1).alias("_k"),
    )
    each = ordered.withColumn("_k", F.lit(1)).join(F.broadcast(total), "_k").drop("_k")
    steps = each.withColumn("batch", F.explode(F.when(F.col("iterations") > 0, F.sequence(F.lit(0).cast("bigint"), F.col("iterations") - 1))))
    inside = F.col("steps_before") + F.col("batch")
    return steps.withColumns(
        {
            "step": F.col("epoch") * F.col("epoch_steps") + inside,
            "lr": lr_at(F.col("epoch") * F.col("epoch_steps") + inside, F.col("epoch_steps")),
            "teacher_ratio": teacher_ratio(F.col("epoch"), inside, F.col("epoch_steps")),
        }
    ).drop("epoch_steps", "steps_before", "iterations")


def resume_plan(plan: DataFrame, epoch: int, position: int) -> DataFrame:
    """What is left after ``position`` shards of ``epoch``; a finished epoch goes on with the next."""
    later = F.col("epoch") > epoch
    return plan.filter(later | ((F.col("epoch") == epoch) & (F.col("position") >= position)))
