"""Reading, checking and exporting sentence pairs."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from pairweave.session import cut_lineage

PAIR_SCHEMA = "pair_id bigint, translation struct<en:string,zh:string>"
RAW_SCHEMA = "translation struct<en:string,zh:string>"


def read_bitext(spark: SparkSession, paths: str | Sequence[str], schema: str = PAIR_SCHEMA) -> DataFrame:
    """All files of one or more folders in a single scan, with a fixed schema, so no file is read to infer one."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.schema(schema).parquet(*paths)


def with_pair_id(raw: DataFrame) -> DataFrame:
    """``(pair_id, translation)`` of raw pairs, which have no ids.

    The id is a hash of both sentences and, for pairs that occur more than once, their number. It does not depend on how
    the pairs are spread over files. Equal pairs are counted before they are shuffled and numbered where they meet, so a
    pair that makes up much of the data is one row on the way.
    """
    counted = raw.groupBy(F.col("translation.en").alias("en"), F.col("translation.zh").alias("zh")).agg(F.count(F.lit(1)).alias("_n"))
    each = counted.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1)))
    part = lambda c: F.coalesce(F.concat(F.lit("+"), c), F.lit("-"))
    content = F.md5(F.concat(F.char_length(part("en")).cast("string"), part("en"), part("zh")))
    return each.select(F.concat_ws(":", content, "_copy").alias("pair_id"), F.struct("en", "zh").alias("translation"))


def require_unique_ids(df: DataFrame, key: str = "pair_id") -> None:
    """Raise ``ValueError`` if an id is missing or occurs twice."""
    bad = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col(key).isNull() | (F.col("n") > 1)).limit(5).collect()
    if bad:
        raise ValueError(f"missing or repeated ids, such as {[r[key] for r in bad]}")


#: Reader options under which a broken file gives the rows before the break, and a page with a wrong checksum is a break.
_TOLERANT = {"ignoreCorruptFiles": "true", "parquet.page.verify-checksum.enabled": "true", "recursiveFileLookup": "true"}


#: A file without rows has fewer bytes than this.
EMPTY_BYTES = 1 << 20


def file_report(spark: SparkSession, paths: str | Sequence[str], schema: str = RAW_SCHEMA) -> DataFrame:
    """``(path, bytes, stated, read, status)`` of each Parquet file below ``paths``.

    ``stated`` rows are counted by a scan without columns, which opens footers only; ``read`` ones by a scan of all
    columns that stops at the first broken page of a file. A file is ``complete`` if both agree, ``damaged`` if they do not, and
    ``unreadable`` if there is no footer to read. Listing takes no content; nothing but counts is shuffled.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    listed = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter="*.parquet").load(paths)
    files = listed.select(F.col("path"), F.col("length").alias("bytes"))
    rows = spark.read.schema(schema).options(**_TOLERANT).parquet(*paths)
    per_file = rows.groupBy(F.col("_metadata.file_path").alias("path"))
    stated = per_file.agg(F.count(F.lit(1)).alias("stated"))
    # A hash of every field that is part of the result makes the scan decode every field; a plain count would open footers.
    decoded = per_file.agg(F.count(F.lit(1)).alias("n"), F.max(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])).alias("h"))
    read = decoded.select("path", F.when(F.col("h").isNotNull(), F.col("n")).alias("read"))
    # A file without rows is in neither count. Its footer is nearly all there is of it.
    marker = F.lit(b"PAR1")
    framed = (F.substring("content", 1, 4) == marker) & (F.substring("content", -4, 4) == marker)
    small = listed.filter(F.col("length") < EMPTY_BYTES).filter(framed).select("path", F.lit(True).alias("framed"))
    known = files.join(stated, "path", "left").join(read, "path", "left").join(small, "path", "left")
    none = F.lit(0).cast("bigint")
    silent = F.col("stated").isNull()
    status = F.when(silent & F.col("framed").isNull(), "unreadable").when(~silent & (F.coalesce("read", none) < F.col("stated")), "damaged")
    return known.select(
        "path", "bytes", F.when(silent & F.col("framed"), none).otherwise(F.col("stated")).alias("stated"), F.coalesce("read", none).alias("read"),
        status.otherwise("complete").alias("status"),
    )


def read_readable(spark: SparkSession, paths: str | Sequence[str], schema: str = RAW_SCHEMA) -> tuple[DataFrame, int]:
    """The pairs of all complete files, and how many files were left out; a file that breaks off is left out whole.

    The names of broken files are a table, so any number of them can be left out.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    broken = cut_lineage(file_report(spark, paths, schema).filter("status <> 'complete'").select("path"))
    count = broken.count()
    for (path,) in broken.limit(100).collect():
        warnings.warn(f"left out: {path}", stacklevel=2)
    rows = spark.read.schema(schema).options(**_TOLERANT).parquet(*paths)
    if count:
        columns = rows.columns
        rows = rows.withColumn("_file", F.col("_metadata.file_path")).join(broken.withColumnRenamed("path", "_file"), "_file", "left_anti").select(*columns)
    return rows, count


def require_fields(df: DataFrame, fields: Sequence[str] = ("en", "zh")) -> None:
    """Raise ``ValueError`` unless ``translation`` is a struct with the given fields."""
    kind = df.schema["translation"].dataType if "translation" in df.columns else None
    missing = [f for f in fields if not isinstance(kind, StructType) or f not in kind.names]
    if missing:
        raise ValueError(f"translation lacks {missing}")


def is_complete(translation: str = "translation") -> Column:
    """Are both sentences there?"""
    return F.col(f"{translation}.en").isNotNull() & F.col(f"{translation}.zh").isNotNull()


def validate_bitext(df: DataFrame, on_error: str = "raise") -> DataFrame:
    """Complete pairs only. ``"drop"`` leaves out the others; ``"raise"`` fails the job at the first of them.

    Raising happens inside the scan that the job runs anyway, not in a pass of its own.
    """
    require_fields(df)
    if on_error == "drop":
        return df.filter(is_complete())
    if on_error != "raise":
        raise ValueError("on_error is 'raise' or 'drop'")
    stop = F.raise_error(F.lit("invalid translation: a sentence is missing")).cast("boolean")
    return df.filter(F.when(is_complete(), F.lit(True)).otherwise(stop))


def count_rejects(df: DataFrame) -> DataFrame:
    """One row: pairs read, and pairs with a sentence missing."""
    require_fields(df)
    return df.agg(F.count(F.lit(1)).alias("read"), F.count_if(~is_complete()).alias("rejected"))


def flatten_pairs(df: DataFrame) -> DataFrame:
    """``(pair_id, src_text, tgt_text)``; only the two fields are read from the files."""
    return df.select("pair_id", F.col("translation.en").alias("src_text"), F.col("translation.zh").alias("tgt_text"))


def corpus_union(splits: dict[str, DataFrame], use: Sequence[str] = ("train",)) -> DataFrame:
    """Chosen splits under each other with a ``split`` column. Validation text is left out unless asked for."""
    parts = [splits[name].withColumn("split", F.lit(name)) for name in use]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def one_line(text: Column) -> Column:
    """Backslashes and line breaks escaped, so that a sentence is always one line."""
    escaped = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(escaped, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def corpus_lines(pairs: DataFrame) -> DataFrame:
    """Pairs as they are exported: one line per sentence."""
    return pairs.select("pair_id", one_line(F.col("src_text")).alias("src_line"), one_line(F.col("tgt_text")).alias("tgt_line"))


def write_corpus(pairs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Two aligned text corpora, ``side=src`` and ``side=tgt``, in pair order.

    Each task writes both sides of its key range, so part files with the same number hold the same pairs line by line,
    and the whole export is one job with one shuffle.
    """
    lines = corpus_lines(pairs).repartitionByRange("pair_id")
    sides = lines.select("pair_id", F.expr("stack(2, 'src', src_line, 'tgt', tgt_line)").alias("side", "value"))
    ordered = sides.sortWithinPartitions("side", "pair_id").select("side", "value")
    ordered.write.mode(mode).partitionBy("side").text(path)


def restored(line: Column) -> Column:
    """The sentence that ``one_line`` made a line of."""
    breaks = lambda part: F.replace(F.replace(part, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
    return F.array_join(F.transform(F.split(line, r"\\\\"), breaks), "\\")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line_no, value)`` of all lines below ``path``, files in order of their names.

    Lines are counted per split of a file, and prefix sums over the splits say where each begins, so lines are numbered where
    they are read. Splits are the only thing that is sorted in one place.
    """
    raw = spark.read.text(path)
    placed = raw.select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"), "value"
    )
    splits = placed.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_lines"), F.min("_id").alias("_first"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut_lineage(splits.withColumn("_offset", F.coalesce(F.sum("_lines").over(before), F.lit(0)) - F.col("_first")).select("_file", "_block", "_offset"))
    joined = placed.join(offsets.hint("shuffle_hash") if offsets.count() > 100_000 else F.broadcast(offsets), ["_file", "_block"])
    return joined.select((F.col("_offset") + F.col("_id")).alias("line_no"), "value")


def zip_by_position(left: DataFrame, right: DataFrame) -> DataFrame:
    """``(line_no, left, right)`` of two numbered lists; where one ends before the other its side is null."""
    sides = [df.select("line_no", F.col("value").alias(name)) for df, name in ((left, "left"), (right, "right"))]
    return sides[0].join(sides[1], "line_no", "full_outer")


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """``(line_no, src_text, tgt_text)`` of two aligned text corpora, as ``write_corpus`` leaves them.

    Line *n* of one side belongs to line *n* of the other. A side that is shorter gives nulls, which ``ragged_lines`` counts.
    """
    zipped = zip_by_position(numbered_lines(spark, f"{path}/side=src"), numbered_lines(spark, f"{path}/side=tgt"))
    return zipped.select("line_no", restored(F.col("left")).alias("src_text"), restored(F.col("right")).alias("tgt_text"))


def ragged_lines(zipped: DataFrame, left: str = "src_text", right: str = "tgt_text") -> DataFrame:
    """One row: lines that only one of the two sides has."""
    return zipped.agg(F.count_if(F.col(right).isNull()).alias("left_only"), F.count_if(F.col(left).isNull()).alias("right_only"))
