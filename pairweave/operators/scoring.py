"""Corpus BLEU and the evaluation summary."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

MAX_ORDER = 4
FLOOR = 0.1

# Blocks the published Chinese tokenisation takes apart character by character.
HAN_BLOCKS = [
    (0x3400, 0x4DB5), (0x4E00, 0x9FA5), (0x9FA6, 0x9FBB), (0xF900, 0xFA2D), (0xFA30, 0xFA6A), (0xFA70, 0xFAD9),
    (0x20000, 0x2A6D6), (0x2F800, 0x2FA1D), (0xFF00, 0xFFEF), (0x2E80, 0x2EFF), (0x3000, 0x303F), (0x31C0, 0x31EF),
    (0x2F00, 0x2FDF), (0x2FF0, 0x2FFF), (0x3100, 0x312F), (0x31A0, 0x31BF), (0xFE10, 0xFE1F), (0xFE30, 0xFE4F),
    (0x2600, 0x26FF), (0x2700, 0x27BF), (0x3200, 0x32FF), (0x3300, 0x33FF),
]
_HAN = "[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in HAN_BLOCKS) + "]"

# The published word and punctuation rules that follow, applied in this order.
PUNCTUATION_RULES = [
    (r"([{-~\[-` -&(-+:-@/])", " $1 "),
    (r"([^0-9])([.,])", "$1 $2 "),
    (r"([.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
]


def tokenize_zh(text: Column) -> Column:
    """Tokens of cased text: Han characters one by one, then words and punctuation."""
    spaced = F.regexp_replace(F.trim(text), f"({_HAN})", " $1 ")
    marked = reduce(lambda col, rule: F.regexp_replace(col, *rule), PUNCTUATION_RULES, spaced)
    return F.filter(F.split(marked, r"\s+"), lambda t: t != "")


def _count_grams(order: int):
    """A pandas UDF of a token array and an array of token arrays: clipped matches and totals of each order, and both lengths."""

    @F.pandas_udf("array<bigint>")
    def count(hyps: pd.Series, refs: pd.Series) -> pd.Series:
        return pd.Series([gram_counts(list(h), [list(r) for r in rs], order) for h, rs in zip(hyps, refs)])

    return count


def gram_counts(hyp: list[str], refs: list[list[str]], order: int = MAX_ORDER) -> list[int]:
    """Clipped n-gram matches for n up to ``order``, n-grams of ``hyp`` for each n, and the two lengths.

    An n-gram may match as often as in the reference that has it most. The reference length is the one closest to the
    hypothesis, the shorter of two as close; without references it is 0.
    """
    matches, totals = [], []
    for n in range(1, order + 1):
        grams = lambda tokens: Counter(zip(*(tokens[i:] for i in range(n))))  # noqa: B023, E731
        mine, most = grams(hyp), reduce(lambda a, b: a | b, map(grams, refs), Counter())
        matches.append((mine & most).total())
        totals.append(mine.total())
    closest = min((len(r) for r in refs), key=lambda size: (abs(size - len(hyp)), size), default=0)
    return [*matches, *totals, len(hyp), closest]


def _count_names(order: int) -> list[str]:
    return [f"{kind}_{n}" for kind in ("correct", "total") for n in range(1, order + 1)] + ["hyp_len", "ref_len"]


def ngram_matches(df: DataFrame, hyp: str, ref: str, key: str = "pair_id", order: int = MAX_ORDER) -> DataFrame:
    """Per pair: ``correct_n`` and ``total_n`` for each n, and token counts ``hyp_len`` and ``ref_len``.

    ``hyp`` and ``ref`` are token arrays of one row, so everything is counted where the row lies; nothing is shuffled.
    A missing side counts as no tokens.
    """
    none = F.array().cast("array<string>")
    counted = df.select(key, _count_grams(order)(F.coalesce(hyp, none), F.array(F.coalesce(ref, none))).alias("_counts"))
    return counted.select(key, *[F.col("_counts")[i].alias(name) for i, name in enumerate(_count_names(order))])


def bleu_from_sums(sums: DataFrame, order: int = MAX_ORDER, floor: float = FLOOR) -> DataFrame:
    """Add ``bp``, ``precision_n`` and ``bleu`` to one row of summed counts; orders without a match get the floor."""
    orders = range(1, order + 1)
    bp = (
        F.when(F.col("hyp_len") >= F.col("ref_len"), F.lit(1.0))
        .when(F.col("hyp_len") == 0, F.lit(0.0))
        .otherwise(F.exp(1 - F.try_divide(F.col("ref_len"), F.col("hyp_len"))))
    )
    correct, total = (lambda n: F.col(f"correct_{n}")), (lambda n: F.col(f"total_{n}"))
    precision = {
        f"precision_{n}": F.when(total(n) == 0, F.lit(0.0)).otherwise(
            100.0 * F.when(correct(n) == 0, F.lit(floor)).otherwise(correct(n)) / F.nullif(total(n), F.lit(0))
        )
        for n in orders
    }
    scored = sums.withColumn("bp", bp).withColumns(precision)
    logs = sum((F.log(F.nullif(F.col(f"precision_{n}"), F.lit(0.0))) for n in orders), F.lit(0.0))
    nothing = sum((correct(n) for n in orders), F.lit(0)) == 0
    score = F.when(nothing, F.lit(0.0)).otherwise(F.coalesce(F.col("bp") * F.exp(logs / order), F.lit(0.0)))
    return scored.withColumn("bleu", score)


def corpus_bleu(
    df: DataFrame, hyp: str = "hyp_text", ref: str = "ref_text", key: str = "pair_id", tokenize=tokenize_zh
) -> DataFrame:
    """One row of corpus BLEU with one reference per hypothesis: summed counts, precisions and score."""
    tokens = df.select(key, tokenize(F.col(hyp)).alias("_hyp"), tokenize(F.col(ref)).alias("_ref"))
    counts = ngram_matches(tokens, "_hyp", "_ref", key)
    return bleu_from_sums(counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in _count_names(MAX_ORDER)]))


def corpus_bleu_multi(
    df: DataFrame, hyp: str = "hyp_text", refs: Sequence[str] = ("ref_text",), key: str = "pair_id", tokenize=tokenize_zh
) -> DataFrame:
    """``corpus_bleu`` with several references per hypothesis, each a text column; a missing one is left out."""
    tokens = F.filter(F.array(*[tokenize(F.col(r)) for r in refs]), lambda r: r.isNotNull())
    none = F.array().cast("array<string>")
    counted = df.select(key, _count_grams(MAX_ORDER)(F.coalesce(tokenize(F.col(hyp)), none), tokens).alias("_counts"))
    sums = [F.coalesce(F.sum(F.col("_counts")[i]), F.lit(0)).cast("bigint").alias(name) for i, name in enumerate(_count_names(MAX_ORDER))]
    return bleu_from_sums(counted.agg(*sums))


def split_by_source_length(df: DataFrame, ids: str = "src_ids", max_length: int = 128) -> DataFrame:
    """Add ``kept``: is the source encoding, markers included, short enough? Missing encodings are not kept."""
    return df.withColumn("kept", F.coalesce(F.size(ids) <= max_length, F.lit(False)))


def eval_summary(flagged: DataFrame, bleu: DataFrame) -> DataFrame:
    """One row: total, valid and discarded pairs, and the score."""
    counts = flagged.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("kept")).alias("valid"),
        F.count_if(~F.col("kept")).alias("discarded"),
        F.lit(1).alias("_k"),
    )
    return counts.join(bleu.select("bleu", F.lit(1).alias("_k")), "_k").drop("_k")
