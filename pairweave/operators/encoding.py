"""Subword encoding and decoding with a trained vocabulary."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pairweave.functions.arrays import PAD, BOS, EOS, UNK, add_specials
from pairweave.functions.text import byte_level_lines, in_slices, normalize_text, unspell
from pairweave.operators.vocabulary import Bpe

#: Distinct words remembered per Python worker.
_REMEMBERED = 500_000


def bpe_encoder(model: Bpe):
    """An Arrow UDF from byte-level lines (one unit per line) to ids.

    Encoding stays where the text is: sending every word occurrence through a join with encoded distinct words would
    shuffle several times the corpus. Each worker remembers the words it has met, so merging runs once per distinct
    word and worker. The tables that travel with the tasks are bounded by the ``vocab_size`` the model was
    trained with. A filter on ids does not make Spark evaluate it twice, because it is not declared deterministic.
    """
    context = model.vocab.sparkSession.sparkContext
    ids = {r.token: r.id for r in model.vocab.collect()}
    ranks = {(r.left, r.right): r.rank for r in model.merges.collect()}
    shared = context.broadcast((ids, ranks))

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        token_ids, merge_ranks = shared.value
        seen: dict[str, list[int]] = {}

        def word_ids(word: str) -> list[int]:
            found = seen.get(word)
            if found is None:
                found = [token_ids.get(t, UNK) for t in merge_word(word, merge_ranks)]
                if len(seen) >= _REMEMBERED:
                    seen.clear()
                seen[word] = found
            return found

        def line_ids(text: str | None) -> np.ndarray | None:
            return None if text is None else np.array([i for w in text.split("\n") if w for i in word_ids(w)], np.int32)

        for lines in batches:
            yield in_slices(lines, line_ids, pa.list_(pa.int32()))

    return encode.asNondeterministic()


def merge_word(word: str, ranks: dict[tuple[str, str], int]) -> list[str]:
    """Apply merges to one word, lowest rank first, until none fits."""
    parts = list(word)
    while len(parts) > 1:
        rank, place = min((ranks.get(pair, len(ranks)), i) for i, pair in enumerate(zip(parts, parts[1:])))
        if rank == len(ranks):
            break
        parts[place : place + 2] = [parts[place] + parts[place + 1]]
    return parts


def encode_text(model: Bpe, text: Column, specials: bool = True, normalized: bool = False) -> Column:
    """Ids of a text column, with begin and end markers unless told otherwise. Nothing is truncated."""
    encode = bpe_encoder(model)
    ids = encode(byte_level_lines(text if normalized else normalize_text(text)))
    return add_specials(ids) if specials else ids


def bpe_encode(df: DataFrame, model: Bpe, columns: dict[str, str]) -> DataFrame:
    """Add id arrays: ``columns`` maps an output column to the text column it encodes."""
    encode = bpe_encoder(model)
    encoded = df.withColumns({f"_{o}": encode(byte_level_lines(normalize_text(F.col(c)))) for o, c in columns.items()})
    return encoded.withColumns({o: add_specials(F.col(f"_{o}")) for o in columns}).drop(*[f"_{o}" for o in columns])


def decode_ids(df: DataFrame, vocab: DataFrame, ids: str, out: str, spaces: bool = False) -> DataFrame:
    """Text of an id array: specials skipped, bytes joined and decoded, spaces removed unless ``spaces``.

    Ids are dense. The vocabulary is bounded by the ``vocab_size`` it was made with and travels with the tasks; ids outside
    it are skipped.
    """
    rows = sorted(vocab.collect(), key=lambda r: r.id)
    if [r.id for r in rows] != list(range(len(rows))):
        raise ValueError("token ids must be dense from 0")
    shared = df.sparkSession.sparkContext.broadcast({r.id: r.token for r in rows if r.id not in (PAD, BOS, EOS, UNK)})

    @F.arrow_udf("string")
    def spell(ids_of: pa.Array) -> pa.Array:
        tokens = shared.value
        return in_slices(ids_of, lambda found: None if found is None else "".join(tokens.get(i, "") for i in found), pa.string())

    text = unspell(spell(F.col(ids)))
    return df.withColumn(out, text if spaces else F.replace(text, F.lit(" "), F.lit("")))
