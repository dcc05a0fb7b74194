"""The shard manifest: one JSON document per shard, and one with the run's totals.

A manifest folder holds numbered versions and a pointer file. A new version is written beside the old one; then the pointer
is renamed into place, which is the only step that changes what readers see. So a manifest may be saved over the one it
was read from, and an interrupted save leaves the old one. The pointer also names the data folder a version belongs to.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairweave.operators.cells import CELL

SHARD_SCHEMA = (
    "src_range array<int>, tgt_range array<int>, shard_idx int, num_shards int, suggested_batch_size int, num_samples int"
)
TOTALS_SCHEMA = (
    "num_cuts int, min_samples int, max_samples int, total_samples bigint, total_original_samples bigint, "
    "discarded_samples bigint, total_padding bigint, total_actual_tokens bigint"
)

#: Taken when an older manifest lacks a key.
MISSING_TOTALS = {
    "num_cuts": 8, "min_samples": 1024, "max_samples": 524_288, "total_samples": 0, "total_original_samples": 0,
    "discarded_samples": 0, "total_padding": 0, "total_actual_tokens": 0,
}

_POINTER = "current"


def _location(spark: SparkSession, path: str):
    """``(file system, path)`` of the Hadoop classes."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def read_pointer(spark: SparkSession, path: str) -> tuple[str, str] | None:
    """``(version, data folder)`` of the manifest at ``path``, relative names; None where there is none.

    An older manifest, written before there were versions, is one without a pointer.
    """
    fs, location = _location(spark, f"{path}/{_POINTER}")
    if not fs.exists(location):
        return (".", "data") if fs.exists(_location(spark, f"{path}/totals")[1]) else None
    version, data = spark.read.text(f"{path}/{_POINTER}", wholetext=True).first().value.split("\n")[:2]
    return version, data


def _write_pointer(spark: SparkSession, path: str, version: str, data: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs, target = _location(spark, f"{path}/{_POINTER}")
    _, fresh = _location(spark, f"{path}/{_POINTER}-{version}")
    stream = fs.create(fresh, True)
    stream.write(f"{version}\n{data}\n".encode())
    stream.close()
    overwrite = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    overwrite[0] = hadoop.Options.Rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(fresh), fs.makeQualified(target), overwrite)


def with_ranges(shards: DataFrame) -> DataFrame:
    """Edges as two-element arrays, as they are stored."""
    return shards.select(
        F.array("src_start", "src_end").alias("src_range"),
        F.array("tgt_start", "tgt_end").alias("tgt_range"),
        "shard_idx", "num_shards", "suggested_batch_size", "num_samples",
    )


def write_manifest(shards: DataFrame, totals: DataFrame, path: str, data: str | None = None) -> None:
    """Save a manifest; ``data`` names the data folder it describes (the one of the version before, by default).

    The version before stays readable, so ``shards`` may come from it; older ones are deleted.
    """
    spark = shards.sparkSession
    before = read_pointer(spark, path)
    version = f"version-{uuid.uuid4().hex}"
    with_ranges(shards).write.json(f"{path}/{version}/shards")
    totals.coalesce(1).write.json(f"{path}/{version}/totals")
    _write_pointer(spark, path, version, data if data is not None else before[1] if before else "")
    fs, folder = _location(spark, path)
    for entry in fs.listStatus(folder):
        name = entry.getPath().getName()
        if name.startswith("version-") and name not in (version, before and before[0]):
            fs.delete(entry.getPath(), True)


def load_manifest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(shards, totals)``; keys missing from an older manifest get their defaults."""
    pointer = read_pointer(spark, path)
    if pointer is None:
        raise FileNotFoundError(f"no manifest at {path}")
    raw = spark.read.schema(SHARD_SCHEMA).json(f"{path}/{pointer[0]}/shards")
    edges = [F.col(f"{side}_range")[i].alias(name) for name, side, i in zip(CELL, ["src", "src", "tgt", "tgt"], [0, 1] * 2)]
    shards = raw.select(
        *edges, "shard_idx", "num_shards", F.coalesce("suggested_batch_size", F.lit(0)).alias("suggested_batch_size"), "num_samples"
    )
    totals = spark.read.schema(TOTALS_SCHEMA).json(f"{path}/{pointer[0]}/totals").fillna(MISSING_TOTALS)
    return shards, totals


def manifest_exists(spark: SparkSession, path: str) -> bool:
    """Has a manifest been written here? Markers of the committer do not matter."""
    return read_pointer(spark, path) is not None


def shard_at(ordered: DataFrame, position: int) -> DataFrame:
    """The manifest row at a position of the curriculum order."""
    return ordered.filter(F.col("position") == position)
