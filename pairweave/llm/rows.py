"""Keeping some rows of a table whose ids may repeat or be null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def row_key(text_hash: Column | str = "text_hash") -> Column:
    """Names a row by its id and the ``xxhash64`` of its text; never null."""
    return F.concat_ws(":", text_hash, "doc_id")


def unused(name: str, df: DataFrame) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keep_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` named by ``kept`` (``doc_id, text_hash``), one each, with all their columns.

    Join and numbering use one key, so a document is shuffled once.
    """
    key, place = unused("_row_key", docs), unused("_row_place", docs)
    keyed = docs.withColumn(key, row_key(F.xxhash64("text")))
    named = kept.select(row_key().alias(key)).distinct().hint("merge")
    first = F.row_number().over(Window.partitionBy(key).orderBy(key))
    return keyed.join(named, key, "left_semi").withColumn(place, first).filter(F.col(place) == 1).select(*docs.columns)
