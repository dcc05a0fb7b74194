"""Shard storage: zstd parquet in one folder per shard."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

SHARD_KEYS = ["src_start", "tgt_start", "shard_idx"]


def write_shards(sharded: DataFrame, path: str, mode: str = "errorifexists", level: int = 9) -> None:
    """Write rows to their shard's folder.

    Rows arrive clustered by cell and slice from shard assignment, so each task has rows of few shards and writes few
    files; nothing is shuffled again, and no shard has to fit one task. Tasks move their files into place themselves, since there may be
    too many for the driver to rename one by one; a folder counts as written once it has its ``_SUCCESS`` marker.
    """
    writer = sharded.write.mode(mode).partitionBy(*SHARD_KEYS).option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    writer.option("compression", "zstd").option("parquet.compression.codec.zstd.level", level).parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """All shards; filters on the shard keys prune folders."""
    return spark.read.parquet(path)


def read_shard(
    spark: SparkSession, path: str, src_range: tuple[int, int], tgt_range: tuple[int, int], shard_idx: int = 0
) -> DataFrame:
    """One shard. Its folder is opened directly, without listing the others; a missing one is an error."""
    folder = f"{path}/src_start={src_range[0]}/tgt_start={tgt_range[0]}/shard_idx={shard_idx}"
    try:
        rows = spark.read.option("basePath", path).parquet(folder)
    except AnalysisException as error:
        raise ValueError(f"no shard {shard_idx} for {src_range} x {tgt_range} in {path}") from error
    return rows.filter((rows.src_end == src_range[1]) & (rows.tgt_end == tgt_range[1]))


#: Most files that a scan names one by one; of more, the folder is listed in parallel instead.
NAMED_FILES = 1000

INDEX_SCHEMA = "src_start int, tgt_start int, shard_idx int, first bigint, last bigint, file string"


def shard_ordinal(max_samples: int):
    """The place of a stored row in its shard, which follows from its place in the cell."""
    return F.col("cell_rank") - F.col("shard_idx") * F.lit(max_samples).cast("bigint")


def index_shards(spark: SparkSession, path: str, index: str, max_samples: int) -> None:
    """Write which file holds which rows of each shard below ``path``: a row per unbroken range of places in a file.

    Only places and file names are read. Rows lie in files by slices of the order, so ranges are as few as slices.
    """
    rows = read_shards(spark, path).select(*SHARD_KEYS, shard_ordinal(max_samples).alias("row"), F.col("_metadata.file_path").alias("file"))
    order = Window.partitionBy("file").orderBy("row")  # one file
    islands = rows.withColumn("island", F.col("row") - F.row_number().over(order))
    ranges = islands.groupBy(*SHARD_KEYS, "file", "island").agg(F.min("row").alias("first"), F.max("row").alias("last"))
    ranges.select(*SHARD_KEYS, "first", "last", "file").write.parquet(index)


def read_rows(spark: SparkSession, path: str, index: str, wanted: DataFrame, max_samples: int) -> DataFrame:
    """The stored rows at places ``wanted`` (``src_start, tgt_start, shard_idx, row``), with ``row``.

    Only files that hold one are opened, unless they are more than ``NAMED_FILES``: then their names stay out of the driver, and the folder is
    scanned. A place that no shard has gives no row.
    """
    keys = [*SHARD_KEYS, "row"]
    ranges = spark.read.schema(INDEX_SCHEMA).parquet(index)
    held = wanted.select(*keys).distinct().join(ranges, SHARD_KEYS).filter((F.col("row") >= F.col("first")) & (F.col("row") <= F.col("last")))
    files = sorted(r.file for r in held.select("file").distinct().limit(NAMED_FILES + 1).collect())
    if not files:
        return read_shards(spark, path).withColumn("row", F.lit(None).cast("bigint")).filter("false")
    found = read_shards(spark, path) if len(files) > NAMED_FILES else spark.read.option("basePath", path).parquet(*files)
    rows = found.withColumn("row", shard_ordinal(max_samples))
    return rows.join(wanted.select(*keys).distinct(), keys, "left_semi")
