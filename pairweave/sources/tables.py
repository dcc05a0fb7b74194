"""Vocabulary tables, the comparison report and the metrics log."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from pairweave.operators.vocabulary import Bpe
from pairweave.sources.bitext import one_line

METRICS = "epoch int, bucket int, split string, loss double, acc double"


def write_vocab(model: Bpe, path: str, mode: str = "errorifexists") -> None:
    """Save a vocabulary and its merges; both are bounded by the vocabulary size."""
    model.merges.coalesce(1).write.mode(mode).parquet(f"{path}/merges")
    model.vocab.coalesce(1).write.mode(mode).parquet(f"{path}/vocab")


def read_vocab(spark: SparkSession, path: str) -> Bpe:
    """Load a saved vocabulary; ``FileNotFoundError`` when there is none."""
    try:
        return Bpe(spark.read.parquet(f"{path}/vocab"), spark.read.parquet(f"{path}/merges"))
    except AnalysisException as error:
        raise FileNotFoundError(f"no vocabulary at {path}; train one first") from error


def report_lines(df: DataFrame) -> DataFrame:
    """``(pair_id, value)``: source, reference and hypothesis under each other, then an empty line."""
    labelled = [
        F.concat(F.lit(label), one_line(F.coalesce(column, F.lit(""))))
        for label, column in (("EN: ", "src_text"), ("ZH_REF: ", "ref_text"), ("ZH_HYP: ", "hyp_text"))
    ]
    return df.select("pair_id", F.concat_ws("\n", *labelled, F.lit("")).alias("value"))


def zip_pairs(left: DataFrame, right: DataFrame, key: str = "pair_id") -> DataFrame:
    """Two parallel lists side by side, matched by key instead of by row order."""
    return left.join(right, key)


def write_report(df: DataFrame, path: str) -> None:
    """Replace the comparison report at ``path``, in pair order."""
    lines = report_lines(df).repartitionByRange("pair_id").sortWithinPartitions("pair_id")
    lines.select("value").write.mode("overwrite").text(path)


def append_metrics(df: DataFrame, path: str) -> None:
    """Add rows of loss and accuracy to the log."""
    df.select("epoch", "bucket", "split", "loss", "acc").write.mode("append").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The whole log."""
    return spark.read.schema(METRICS).parquet(path)
