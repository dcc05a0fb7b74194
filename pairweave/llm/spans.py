"""Regular-expression spans with their offsets, from built-in expressions alone.

``regexp_extract_all`` gives the matches and ``split`` the text between them, so offsets are running totals of lengths
(code points). Java's engine and both functions walk through the text alike: leftmost, non-overlapping.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

SPAN = "array<struct<start:bigint,end:bigint,value:string,left:string,right:string>>"
_BLOCK = 128


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def totals_before(sizes: Column) -> Column:
    """For each element of an array the sum of those before it; by blocks, so that long arrays stay cheap."""
    add = lambda values: F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)
    blocks = lambda a: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(a) - 1) / _BLOCK).cast("int")), lambda b: add(F.slice(a, b * _BLOCK + 1, F.lit(_BLOCK)))
    )
    block_of = lambda i: F.floor(i / _BLOCK).cast("int")
    each = lambda a, before: F.transform(
        a, lambda x, i: F.element_at(before, block_of(i) + 1) + add(F.slice(a, block_of(i) * _BLOCK + 1, i % _BLOCK))
    )
    starts = lambda sums: F.transform(sums, lambda x, b: add(F.slice(sums, F.lit(1), b)))
    return let(sizes, lambda a: let(blocks(a), lambda sums: let(starts(sums), lambda before: each(a, before))))


def spans_of(text: Column, pattern: str, guard: Column | None = None) -> Column:
    """``SPAN`` of the matches of ``pattern`` (Java syntax, never empty): offsets, the match, and up to 30 characters
    before and 8 after it. Where ``guard`` is false the text cannot match and is not searched."""
    none = F.array().cast(SPAN)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(matches: Column, pieces: Column) -> Column:
        sizes = F.transform(matches, lambda m, i: (F.length(m) + F.length(F.element_at(pieces, i + 1))).cast("bigint"))

        def one(before: Column) -> Column:
            def span(m: Column, i: Column) -> Column:
                start = F.element_at(before, i + 1) + F.length(F.element_at(pieces, i + 1))
                return F.struct(
                    start.alias("start"),
                    (start + F.length(m)).alias("end"),
                    m.alias("value"),
                    F.right(F.element_at(pieces, i + 1), F.lit(30)).alias("left"),
                    F.left(F.element_at(pieces, i + 2), F.lit(8)).alias("right"),
                )

            return F.transform(matches, span)

        return let(totals_before(sizes), one)

    located = lambda matches: F.when(F.size(matches) == 0, none).otherwise(
        let(F.split(text, pattern, -1), lambda pieces: placed(matches, pieces))
    )
    every = let(found, located)
    return every if guard is None else F.when(guard, every).otherwise(none)


def tagged(spans: Column, kind: str, order: int) -> Column:
    """Spans as ``(start, order, end, kind)``, which sorts as results are listed."""
    return F.transform(spans, lambda s: F.struct(s.start.alias("start"), F.lit(order).alias("order"), s.end.alias("end"), F.lit(kind).alias("kind")))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of tagged spans, by start and then kind, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
