"""Token accuracy and label-smoothed loss from tables of predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pairweave.functions.arrays import PAD

LABEL_SMOOTHING = 0.03


def row_correct(preds: Column, labels: Column, pad: int = PAD) -> Column:
    """Positions of one row that are not padding and predicted right; a missing prediction is wrong."""
    hits = F.zip_with(preds, labels, lambda p, y: F.coalesce((y != pad) & (p == y), F.lit(False)).cast("bigint"))
    return F.aggregate(hits, F.lit(0).cast("bigint"), lambda a, x: a + x)


def row_valid(labels: Column, pad: int = PAD) -> Column:
    """Positions of one row that are not padding."""
    return F.size(F.filter(labels, lambda y: y != pad)).cast("bigint")


def token_accuracy(preds: DataFrame, pad: int = PAD, by: Sequence[str] = ()) -> DataFrame:
    """Right tokens over non-padding tokens, 0 when there are none: one row, or one per value of ``by``."""
    sums = preds.groupBy(*by).agg(
        F.coalesce(F.sum(row_correct(F.col("preds"), F.col("labels"), pad)), F.lit(0)).alias("correct"),
        F.coalesce(F.sum(row_valid(F.col("labels"), pad)), F.lit(0)).alias("valid"),
    )
    return sums.withColumn("accuracy", F.coalesce(F.try_divide(F.col("correct"), F.col("valid")), F.lit(0.0)))


def smoothed_token_loss(logits: Column, label: Column, eps: float = LABEL_SMOOTHING) -> Column:
    """Cross entropy of one token with ``eps`` of the target spread over all classes."""
    top = F.array_max(logits)
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    log_sum = top + F.log(total(F.transform(logits, lambda x: F.exp(x - top))))
    picked = log_sum - F.get(logits, label)
    mean = log_sum - total(logits) / F.size(logits)
    return (1 - eps) * picked + eps * mean


def smoothed_loss(tokens: DataFrame, eps: float = LABEL_SMOOTHING, ignore: int = PAD) -> DataFrame:
    """Mean loss per batch over tokens that are not ignored: ``(batch_id, n_rows, loss)`` from (batch_id, row_id, logits, label).

    ``n_rows`` counts the sentences of the batch, ignored tokens or not. Both are partial sums before the shuffle; the
    distinct row ids are first reduced to one entry per batch and row.
    """
    kept = F.col("label") != ignore
    loss = F.when(kept, smoothed_token_loss(F.col("logits").cast("array<double>"), F.col("label"), eps))
    per_row = tokens.select("batch_id", "row_id", loss.alias("loss")).groupBy("batch_id", "row_id").agg(
        F.sum("loss").alias("s"), F.count("loss").alias("n")
    )
    return per_row.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.try_divide(F.sum("s"), F.sum("n")).alias("loss")
    )


def epoch_loss(batches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Batch losses weighted by their sentence counts, which is not the mean over tokens: one row, or one per value of ``by``.

    Batches without a loss (only padding) count neither above nor below; the loss is null where no batch has one.
    """
    weight = F.when(F.col("loss").isNotNull(), F.col("n_rows"))
    return batches.groupBy(*by).agg(F.try_divide(F.sum(F.col("loss") * weight), F.sum(weight)).alias("loss"))
