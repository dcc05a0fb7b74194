"""Translate a validation set with a supplied model, score it and write the comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairweave.operators.encoding import bpe_encode
from pairweave.operators.scoring import corpus_bleu, eval_summary, split_by_source_length
from pairweave.operators.translation import TranslatorFactory, translate_batches
from pairweave.operators.vocabulary import Bpe
from pairweave.session import cut_lineage
from pairweave.sources.tables import write_report


def evaluate(
    pairs: DataFrame,
    model: Bpe,
    translator: TranslatorFactory,
    report_path: str | None = None,
    batch_size: int = 512,
    max_length: int = 128,
) -> DataFrame:
    """One row of totals and BLEU for ``(pair_id, src_text, tgt_text)``.

    Translations are written once, since the score and the report both read them and the model is the costly part.
    """
    encoded = bpe_encode(pairs, model, {"src_ids": "src_text"})
    flagged = cut_lineage(split_by_source_length(encoded, "src_ids", max_length).drop("src_ids"))
    kept = flagged.filter("kept").select("pair_id", "src_text", F.col("tgt_text").alias("ref_text"))
    translated = cut_lineage(translate_batches(kept, translator, batch_size))
    if report_path is not None:
        write_report(translated, report_path)
    return eval_summary(flagged, corpus_bleu(translated))
