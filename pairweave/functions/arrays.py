"""Expressions on token arrays. All of them are projections: no shuffle, and usable on streams."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

PAD, BOS, EOS, UNK = 0, 1, 2, 3
SPECIAL_TOKENS = ["[PAD]", "[BOS]", "[EOS]", "[UNK]"]


def add_specials(ids: Column, pair: Column | None = None, bos: int = BOS, eos: int = EOS) -> Column:
    """``BOS ids EOS``, or ``BOS ids EOS BOS pair EOS``."""
    first, last = F.array(F.lit(bos)), F.array(F.lit(eos))
    single = F.concat(first, ids, last)
    return single if pair is None else F.concat(single, first, pair, last)


def decoder_input(ids: Column) -> Column:
    """All ids but the last."""
    return F.slice(ids, F.lit(1), F.greatest(F.size(ids) - 1, F.lit(0)))


def decoder_label(ids: Column) -> Column:
    """All ids but the first."""
    return F.slice(ids, F.lit(2), F.greatest(F.size(ids) - 1, F.lit(0)))


def narrow_ids(ids: Column) -> Column:
    """Ids as 16-bit integers, for vocabularies of at most 32,768 entries; larger ids raise under ANSI mode."""
    return ids.cast("array<smallint>")


def widen_ids(ids: Column) -> Column:
    """Ids back as 64-bit integers."""
    return ids.cast("array<bigint>")


def without_padding(ids: Column, pad: int = PAD) -> Column:
    """Ids that are not padding."""
    return F.filter(ids, lambda x: x != pad)


def cut_at_eos(ids: Column, eos: int = EOS) -> Column:
    """Everything up to and including the first end marker; unchanged when there is none."""
    place = F.array_position(ids, F.lit(eos).cast("int")).cast("int")
    return F.when(place > 0, F.slice(ids, F.lit(1), place)).otherwise(ids)


def pad_to(ids: Column, width: Column | int, pad: int = PAD) -> Column:
    """Right-pad to ``width``; longer rows are cropped to it."""
    width = width if isinstance(width, Column) else F.lit(width)
    missing = F.greatest(width - F.size(ids), F.lit(0)).cast("int")
    return F.slice(F.concat(ids, F.array_repeat(F.lit(pad), missing)), F.lit(1), width.cast("int"))


def argmax_index(values: Column) -> Column:
    """0-based place of the largest value, the first one on ties."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def joined(ids: Column) -> Column:
    """Ids as comma-separated text, for reports and comparisons."""
    return F.array_join(ids.cast("array<string>"), ",")
