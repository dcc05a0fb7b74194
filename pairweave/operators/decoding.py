"""Beam search as an iterated table: the state of all beams is written after each step."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F

from pairweave.functions.arrays import EOS
from pairweave.operators.selection import beam_step, length_scaled, repetition_penalty
from pairweave.session import remove, rewrite


def log_softmax(cands: DataFrame) -> DataFrame:
    """Add ``logp``: logits normalised over the candidates of a beam, to nine places, so that sums in another order tie alike."""
    beam = Window.partitionBy("item_id", "beam")
    top = cands.withColumn("_top", F.max("logit").over(beam))
    total = top.withColumn("_total", F.sum(F.exp(F.col("logit") - F.col("_top"))).over(beam))
    return total.withColumn("logp", F.round(F.col("logit") - F.col("_top") - F.log("_total"), 9)).drop("_top", "_total")


def beam_decode(
    items: DataFrame,
    next_tokens: Callable[[DataFrame], DataFrame],
    max_length: int,
    beam_size: int = 4,
    alpha: float = 0.6,
    penalty: float = 1.1,
    eos: int = EOS,
) -> DataFrame:
    """``(item_id, tokens, final_score)``: the best sequence of each item, its start token first, cut after the end marker.

    ``items`` has ``item_id, start``. ``next_tokens`` is given the unfinished beams (``item_id, beam, tokens, score, len``) and
    returns them with ``token, logit``, a row for each token that may follow. A logit is divided by ``penalty`` for each time
    its token was emitted, then normalised; finished beams only repeat the end marker at no cost. Each step keeps the
    ``beam_size`` best continuations by length-scaled score and writes them; the step before is removed. The search ends when
    every beam is finished or after ``max_length`` steps. An item with fewer candidates has fewer beams; one without any
    keeps its start token.
    """
    first = items.select(
        "item_id", F.lit(0).alias("beam"), F.array(F.col("start").cast("int")).alias("tokens"), F.lit(0.0).alias("score"), F.lit(1).alias("len"), F.lit(False).alias("finished")
    )
    spark = items.sparkSession
    state, path = rewrite(first, "beams")
    start_path = path
    for step in range(max_length):
        # Beams meet by item before they get their candidates, which are many times as many and then need no shuffle.
        state = state.repartition("item_id")
        going = next_tokens(state.filter(~F.col("finished")).drop("finished"))
        emitted = F.slice("tokens", F.lit(2), F.greatest(F.size("tokens") - 1, F.lit(0)))
        going = going.withColumn("logit", repetition_penalty(F.col("logit"), F.col("token"), emitted, penalty))
        live = log_softmax(going).select("item_id", "beam", "tokens", "score", "len", "token", "logp", F.lit(False).alias("finished"))
        done = state.filter("finished").select("item_id", "beam", "tokens", "score", "len", F.lit(eos).alias("token"), F.lit(0.0).alias("logp"), "finished")
        chosen = beam_step(live.unionByName(done), beam_size, alpha, eos=eos, carry=["tokens"])
        following = chosen.select(
            "item_id", F.col("new_beam").alias("beam"), F.concat("tokens", F.array(F.col("token").cast("int"))).alias("tokens"),
            F.col("new_score").alias("score"), F.col("new_len").alias("len"), F.col("new_finished").alias("finished"),
        )
        state, new = rewrite(following, "beams")
        if path != start_path:
            remove(spark, path)
        path = new
        if not state.filter(~F.col("finished")).limit(1).count():
            break
    final = F.struct(length_scaled(F.col("score"), F.col("len"), alpha).alias("final_score"), (-F.col("beam")).alias("b"), "tokens")
    best = state.groupBy("item_id").agg(F.max(final).alias("best"))
    cut = F.filter("best.tokens", lambda t, i: (F.array_position("best.tokens", eos) == 0) | (i < F.array_position("best.tokens", eos)))
    found = best.select("item_id", cut.alias("tokens"), F.col("best.final_score").alias("final_score"))
    lost = spark.read.schema(first.schema).parquet(start_path).join(best.select("item_id"), "item_id", "left_anti")
    return found.unionByName(lost.select("item_id", "tokens", F.lit(0.0).alias("final_score")))
