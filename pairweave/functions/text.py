"""Normalising, splitting and byte-level spelling of text, as column expressions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

_ASCII_PUNCT = r"!-/:-@\[-`{-~"
_JOINERS = r"\x{200C}\x{200D}"

#: One alternative per kind of piece: letters and marks; one number character; one punctuation character; other symbols.
PIECE = (
    rf"[[\p{{IsAlphabetic}}\p{{M}}{_JOINERS}]&&[^\p{{N}}\p{{P}}]]+"
    r"|\p{N}"
    rf"|[\p{{P}}{_ASCII_PUNCT}]"
    rf"|[^\p{{IsAlphabetic}}\p{{M}}\p{{N}}\p{{P}}{_JOINERS}{_ASCII_PUNCT}\p{{IsWhite_Space}}]+"
)

#: Splits space-prefixed pieces into runs of letters, numbers and the rest.
UNIT = r" ?\p{L}+| ?\p{N}+| ?[^\p{L}\p{N} ]+"

_NON_ASCII = re.compile(r"[^\x00-\x7f]+")


def _is_ascii(col: Column) -> Column:
    return F.octet_length(col) == F.char_length(col)


def _without_marks(match: re.Match) -> str:
    return "".join(c for c in match.group() if not unicodedata.category(c).startswith("M"))


#: Rows of an Arrow batch that are Python objects at a time.
_SLICE = 256


def in_slices(rows: pa.Array, one: Callable, kind: pa.DataType) -> pa.Array:
    """``one`` of each row. Only a few rows at a time are Python objects, which are many times as large as the Arrow array."""
    parts = [pa.array([one(row) for row in rows.slice(i, _SLICE).to_pylist()], kind) for i in range(0, len(rows), _SLICE)]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def _normalized(text: str | None) -> str | None:
    if text is None:
        return None
    plain = _NON_ASCII.sub(_without_marks, unicodedata.normalize("NFKC", text))
    # A capital sigma is lowered on its own, not by its place in the word.
    return unicodedata.normalize("NFD", plain).replace("Σ", "σ").lower()


@F.arrow_udf(StringType())
def _normalize_unicode(texts: pa.Array) -> pa.Array:
    return in_slices(texts, _normalized, pa.string())


def normalize_text(text: Column) -> Column:
    """NFKC, drop marks, NFD, lowercase, in that order.

    Spark has no normalisation function, so text outside ASCII goes to an Arrow UDF. ASCII text, for which the chain
    is ``lower``, stays in the JVM: the UDF is handed nulls for it.
    """
    ascii_only = _is_ascii(text)
    return F.coalesce(F.when(ascii_only, F.lower(text)), _normalize_unicode(F.when(~ascii_only, text)))


def pretokenize(normalized: Column) -> Column:
    """Words, single digits, single punctuation characters and symbol runs, in order, as an array."""
    return F.regexp_extract_all(normalized, F.lit(PIECE), F.lit(0))


def byte_units(normalized: Column) -> Column:
    """The units that subword merges act within: pieces with a space in front, split where letters end."""
    spaced = F.concat(F.lit(" "), F.array_join(pretokenize(normalized), " "))
    return F.regexp_extract_all(spaced, F.lit(UNIT), F.lit(0))


def _byte_alphabet() -> tuple[str, str]:
    """Bytes without a printable stand-in of their own, and the characters from U+0100 upward that replace them."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in printable]
    return "".join(map(chr, hidden)), "".join(chr(0x100 + i) for i in range(len(hidden)))


_HIDDEN, _SHOWN = _byte_alphabet()


def _replace_chars(text: Column, source: str, target: str) -> Column:
    return F.translate(text, source, target)


def byte_level(text: Column) -> Column:
    """Spell text with one printable character per UTF-8 byte. Line feeds are kept, as separators between units."""
    latin = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
    kept = _HIDDEN.index("\n")
    return _replace_chars(latin, _HIDDEN[:kept] + _HIDDEN[kept + 1 :], _SHOWN[:kept] + _SHOWN[kept + 1 :])


def byte_level_lines(normalized: Column) -> Column:
    """All units of a text, spelled byte-level, one per line. No unit contains white space, so the lines are exact."""
    return byte_level(F.array_join(byte_units(normalized), "\n"))


def unspell(spelled: Column) -> Column:
    """Back from byte-level spelling to text; bytes that are no UTF-8 become replacement characters."""
    latin = _replace_chars(spelled, _SHOWN, _HIDDEN)
    return F.make_valid_utf8(F.encode(latin, "ISO-8859-1").cast("string"))
