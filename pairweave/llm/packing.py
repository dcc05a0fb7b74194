"""Packing: length buckets with the least padding, and token-budget batches inside each bucket.

The histogram of token counts is counted over all documents with map-side combine. Up to 1,023 tokens it is exact;
above, lengths fall in cells of at most 0.2 % of their size, so it has at most 512 cells per power of two, whatever the
data. Dynamic programming over the cells finds the ``buckets`` boundaries that minimise padding (boundaries are cell
ends; the padding itself is counted from exact lengths). A batch of a bucket of width ``w`` holds ``budget // w``
documents, and one document where ``w`` exceeds the budget.

Documents of a bucket are ordered by a hash of the id. Positions come from counts per hash slice plus a window inside a
slice, so no task sorts a bucket. Rows alike in id and length are one entry with a multiplicity.

Defined cases: null and blank texts have no tokens and go to the bucket of width one or wider; null ids are packed like
any other; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pairweave.operators.numbering import hash_key, hash_slice, number_rows
from pairweave.session import rewrite

#: Rows that one window of the numbering spans on average.
SLICE_ROWS = 100_000


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(doc_id, text)`` to ``(doc_id, n_tokens)``."""
    for batch in batches:
        counts = [0 if t is None else len(t.encode().split()) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["doc_id", "n_tokens"])


def cell_width(n: Column) -> Column:
    """Upper end of the histogram cell of a length."""
    unit = F.pow(F.lit(2), F.greatest(F.lit(0), F.length(F.bin(n)) - 10)).cast("bigint")
    return F.greatest(F.lit(1).cast("bigint"), F.floor((n + unit - 1) / unit) * unit)


def optimal_boundaries(widths: list[int], counts: list[int], buckets: int) -> list[int]:
    """The at most ``buckets`` cell widths that end a bucket, so that the padded size of all rows is least.

    ``best[k][j]``: least size of the first ``j`` cells in ``k`` buckets. Of equal choices the bucket that starts first wins.
    """
    n, w = len(widths), np.array(widths, np.int64)
    if not n:
        return []
    below = np.concatenate(([0], np.cumsum(np.array(counts, np.int64))))
    k_max = min(buckets, n)
    best, back = np.concatenate(([0], w * below[1:])), []
    for k in range(2, k_max + 1):
        new, choice = np.full(n + 1, np.iinfo(np.int64).max), np.zeros(n + 1, np.int64)
        for low in range(k, n + 1, 256):
            ends = np.arange(low, min(n + 1, low + 256))
            starts = np.arange(k - 1, ends[-1])
            size = best[starts][None, :] + w[ends - 1][:, None] * (below[ends][:, None] - below[starts][None, :])
            size[starts[None, :] >= ends[:, None]] = np.iinfo(np.int64).max
            choice[ends] = starts[size.argmin(1)]
            new[ends] = size.min(1)
        best, back = new, [*back, choice]
    cuts, j = [], n
    for choice in reversed(back):
        cuts.append(j)
        j = int(choice[j])
    return sorted(int(w[c - 1]) for c in [*cuts, j])


def pack(docs: DataFrame, buckets: int = 16, budget: int = 8192, seed: int = 0) -> DataFrame:
    """``(doc_id, n_tokens, bucket, width, batch, slot)`` for each row of ``docs`` (columns ``doc_id, text``)."""
    counted = docs.select("doc_id", "text").mapInArrow(count_words, "doc_id bigint, n_tokens bigint")
    rows, _ = rewrite(counted.groupBy("doc_id", "n_tokens").agg(F.count(F.lit(1)).alias("copies")), "lengths")
    histogram = rows.groupBy(cell_width(F.col("n_tokens")).alias("width")).agg(F.sum("copies").alias("n")).orderBy("width").collect()
    ends = optimal_boundaries([r.width for r in histogram], [r.n for r in histogram], buckets)
    held = [sum(r.n for r in histogram if low < r.width <= high) for low, high in zip([0, *ends], ends)]
    edges = F.array(*[F.lit(e).cast("bigint") for e in ends])
    bucket = F.size(F.filter(edges, lambda e: e < cell_width(F.col("n_tokens"))))
    at = lambda values, i: F.element_at(F.array(*[F.lit(int(v)).cast("bigint") for v in values or [1]]), i + 1)
    placed = rows.withColumn("bucket", bucket).withColumns(
        {
            "width": at(ends, F.col("bucket")),
            "per_batch": at([max(1, budget // e) for e in ends], F.col("bucket")),
            "_key": hash_key(seed, F.coalesce(F.col("doc_id").cast("string"), F.lit(""))),
        }
    )
    placed = placed.withColumn("_slice", hash_slice(F.col("_key"), at([-(-n // SLICE_ROWS) for n in held], F.col("bucket")).cast("int")))
    numbered = number_rows(placed, ["bucket"], "_slice", ["_key", "doc_id", "n_tokens"], "_row", running={"_before": "copies"})
    each = numbered.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)))
    place = F.col("_before") + F.col("_copy")
    return each.select(
        "doc_id",
        "n_tokens",
        "bucket",
        "width",
        F.floor(place / F.col("per_batch")).alias("batch"),
        (place % F.col("per_batch")).alias("slot"),
    )
