"""Choosing tokens and hypotheses from tables of scored candidates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pairweave.functions.arrays import EOS

_NEVER = float("-inf")


def length_scaled(score: Column, length: Column, alpha: float) -> Column:
    """Score over length to the power ``alpha``; the plain score when ``alpha`` is 0."""
    return score if alpha == 0 else score / F.pow(length.cast("double"), F.lit(float(alpha)))


def live_candidates(cands: DataFrame, first_step: bool = False, eos: int = EOS) -> DataFrame:
    """Candidates as the step sees them.

    A finished beam (``finished``, when the column is there) may only emit the end marker, at log-probability 0. At the
    first step all beams are equal, so only beam 0 counts.
    """
    if "finished" in cands.columns:
        only_eos = F.when(F.col("token") == eos, F.lit(0.0)).otherwise(F.lit(_NEVER))
        cands = cands.withColumn("logp", F.when(F.col("finished"), only_eos).otherwise(F.col("logp")))
    if first_step:
        cands = cands.withColumn("score", F.when(F.col("beam") == 0, F.col("score")).otherwise(F.lit(_NEVER)))
    return cands


def beam_step(
    cands: DataFrame, beam_size: int, alpha: float = 0.6, first_step: bool = False, eos: int = EOS, carry: Sequence[str] = ()
) -> DataFrame:
    """The ``beam_size`` best continuations per item, by length-scaled score, then beam, then token.

    Rows carry on the unscaled score. ``len`` counts tokens before the end marker. Filtering on the row number lets
    Spark keep only the best rows of each item before the shuffle, so an item with most of the candidates stays cheap.
    ``carry`` names further columns to keep.
    """
    scored = live_candidates(cands, first_step, eos).withColumn("new_score", F.col("score") + F.col("logp"))
    scored = scored.withColumn("scaled", length_scaled(F.col("new_score"), F.col("len") + 1, alpha))
    best = Window.partitionBy("item_id").orderBy(F.desc("scaled"), "beam", "token")
    chosen = scored.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= beam_size)
    finished = F.col("token") == eos
    if "finished" in cands.columns:
        finished = finished | F.col("finished")
    return chosen.select(
        "item_id",
        (F.col("place") - 1).alias("new_beam"),
        F.col("beam").alias("from_beam"),
        "token",
        "new_score",
        finished.alias("new_finished"),
        (F.col("len") + F.when(finished, 0).otherwise(1)).alias("new_len"),
        *carry,
    )


def repetition_penalty(logit: Column, token: Column, history: Column, penalty: float = 1.1) -> Column:
    """Divide a logit by ``penalty`` once for every earlier occurrence of its token, whatever the logit's sign.

    ``history`` holds the tokens emitted so far without the begin marker.
    """
    times = F.aggregate(history, F.lit(0), lambda n, t: n + F.when(t == token, 1).otherwise(0))
    return logit / F.pow(F.lit(float(penalty)), times)


def nbest_pick(cands: DataFrame, alpha: float = 0.6) -> DataFrame:
    """The best finished hypothesis per item; ties go to the lowest beam, then token. Partial maxima come first."""
    ranked = F.struct(
        length_scaled(F.col("score"), F.col("len"), alpha).alias("final_score"),
        (-F.col("beam")).alias("b"),
        (-F.col("token")).alias("t"),
    )
    best = cands.groupBy("item_id").agg(F.max(ranked).alias("best"))
    return best.select(
        "item_id", (-F.col("best.b")).alias("beam"), (-F.col("best.t")).alias("token"), F.col("best.final_score").alias("final_score")
    )
