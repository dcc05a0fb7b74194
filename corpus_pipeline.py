"""The corpus pipeline: documents in, packed training batches out.

Every stage takes all that its predecessor kept, and what a stage returns is written and read again. All but the last
return the columns of documents.

Defined cases, for every stage: a null or empty text is a text without words: it is not toxic, is equal to other such texts, is near
none but those, holds no benchmark item and is packed in the narrowest bucket. A null ``doc_id`` sorts after all numbers, so of equal
rows one with an id stays. Rows alike in id and text are one document to the two deduplicating stages, which keep one of them. Of
equal or near texts ties go to the longer text (exact stage), then to the smaller id. Without usable labels nothing is toxic;
without benchmark items nothing is contaminated. An empty table gives empty tables with the same columns. Other columns are kept, under
any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairweave.llm.decontamination import drop_contaminated
from pairweave.llm.exact_dedup import exact_dedup
from pairweave.llm.jaccard_join import jaccard_join
from pairweave.llm.packing import pack
from pairweave.llm.rows import keep_rows
from pairweave.llm.toxicity import drop_toxic, fit_severity
from pairweave.session import rewrite


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model does not reject."""
    return drop_toxic(docs, fit_severity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal but for blanks."""
    old = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    return keep_rows(docs, exact_dedup(docs.filter(old), docs.filter(~old)).filter("kept"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each class of near duplicates."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")).alias("first")
    return keep_rows(docs, jaccard_join(docs).groupBy("class_key").agg(first).select("first.doc_id", "first.text_hash"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A bucket, batch and slot for each document."""
    return pack(docs)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact), ("near_duplicates", near), ("decontamination", decontamination), ("packing", packing)]

#: Ordinal regression and minimum-hash banding have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over all documents that its predecessor kept; what a stage returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = rewrite(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
