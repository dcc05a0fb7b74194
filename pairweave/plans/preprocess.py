"""From raw pairs to tokenised training pairs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pairweave.functions.arrays import decoder_input, decoder_label, narrow_ids, pad_to
from pairweave.operators.encoding import bpe_encode
from pairweave.operators.segmentation import HAN_RUN, segment_runs
from pairweave.operators.vocabulary import Bpe, train_bpe, unit_counts, word_counts
from pairweave.functions.text import normalize_text, pretokenize
from pairweave.sources.bitext import corpus_lines, corpus_union, write_corpus


def filter_max_length(df: DataFrame, max_length: int = 128) -> DataFrame:
    """Pairs whose encodings, markers included, both fit; measured before the target is shifted."""
    return df.filter((F.size("src_ids") <= max_length) & (F.size("tgt_ids") <= max_length))


def shift_targets(df: DataFrame) -> DataFrame:
    """``(pair_id, src, tgt, label)``: target without its last id, label without its first."""
    return df.select(
        "pair_id",
        F.col("src_ids").alias("src"),
        decoder_input(F.col("tgt_ids")).alias("tgt"),
        decoder_label(F.col("tgt_ids")).alias("label"),
    )


def stored_pairs(shifted: DataFrame) -> DataFrame:
    """16-bit ids and the two lengths that bucketing uses."""
    return shifted.select(
        "pair_id",
        *[narrow_ids(F.col(c)).alias(c) for c in ("src", "tgt", "label")],
        F.size("src").alias("src_len"),
        F.size("tgt").alias("tgt_len"),
    )


def padded(df: DataFrame, width: str = "inclusive") -> DataFrame:
    """Pad the three arrays to their cell's width: the last length it holds, or its exclusive end."""
    if width not in ("inclusive", "exclusive_end"):
        raise ValueError("width is 'inclusive' or 'exclusive_end'")
    less = 1 if width == "inclusive" else 0
    src, tgt = F.col("src_end") - less, F.col("tgt_end") - less
    return df.withColumns(
        {"src": pad_to(F.col("src"), src), "tgt": pad_to(F.col("tgt"), tgt), "label": pad_to(F.col("label"), tgt)}
    )


def train_tokenizer(corpus: DataFrame, text: str, vocab_size: int = 16_384, min_frequency: int = 4) -> Bpe:
    """Train a subword vocabulary on one text column."""
    return train_bpe(unit_counts(corpus, text), vocab_size, min_frequency)


def tokenize_pairs(
    pairs: DataFrame, src: Bpe, tgt: Bpe, max_length: int = 128, segmenter: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Training pairs out of ``(pair_id, src_text, tgt_text)``.

    Encoding, filter and shift are one narrow stage. ``segmenter`` puts spaces into unspaced target text first. Write
    the result before bucketing it, since buckets are planned in several passes.
    """
    if segmenter is not None:
        pairs = segmenter(pairs)
    same = src is tgt
    if same:
        encoded = bpe_encode(pairs, src, {"src_ids": "src_text", "tgt_ids": "tgt_text"})
    else:
        encoded = bpe_encode(bpe_encode(pairs, src, {"src_ids": "src_text"}), tgt, {"tgt_ids": "tgt_text"})
    return stored_pairs(shift_targets(filter_max_length(encoded, max_length)))


def validation_shard(tokens: DataFrame, max_length: int = 128) -> DataFrame:
    """Tokenised validation pairs as the one shard of a single cell: they are not bucketed, and none is dropped."""
    cell = {"src_start": 0, "src_end": max_length, "tgt_start": 0, "tgt_end": max_length, "shard_idx": 0, "num_shards": 1}
    return tokens.withColumns({name: F.lit(value) for name, value in cell.items()})


def export_corpus(
    splits: dict[str, DataFrame], path: str, dictionary: DataFrame | None = None, use: Sequence[str] = ("train",), run: str = HAN_RUN
) -> DataFrame:
    """Write the chosen splits of ``(pair_id, src_text, tgt_text)`` as two aligned text corpora; returns what was written.

    Target sentences are segmented with ``dictionary`` first, if there is one, as subword training expects them.
    """
    pairs = corpus_union(splits, use)
    if dictionary is not None:
        pairs = segment_runs(pairs, "tgt_text", dictionary, "_segmented", run).withColumn("tgt_text", F.col("_segmented")).drop("_segmented")
    write_corpus(pairs, path)
    return corpus_lines(pairs)


def piece_counts(df: DataFrame, text: str) -> DataFrame:
    """Occurrences of whole pieces, the base of a word-level vocabulary."""
    return word_counts(df, pretokenize(normalize_text(F.col(text))))


def loss_report(pairs_read: DataFrame, encoded: DataFrame, totals: DataFrame, max_length: int = 128) -> DataFrame:
    """One row: pairs read, rejected, too long, and in thin cells, so that no loss goes unreported.

    ``pairs_read`` has columns read and rejected; ``encoded`` the id arrays of all valid pairs.
    """
    fits: Column = (F.size("src_ids") <= max_length) & (F.size("tgt_ids") <= max_length)
    long = encoded.agg(F.count_if(~fits).alias("too_long"), F.lit(1).alias("_k"))
    thin = totals.select(F.col("discarded_samples").alias("thin_cell"), F.lit(1).alias("_k"))
    return pairs_read.withColumn("_k", F.lit(1)).join(long, "_k").join(thin, "_k").drop("_k")
