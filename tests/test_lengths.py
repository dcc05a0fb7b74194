from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from pairweave.operators import lengths
from pairweave.operators import lengths
from pairweave.operators.lengths import (
    LengthRange,
    assign_range,
    collect_ranges,
    length_histogram,
    optimal_cuts,
    plan_cuts,
    small_cuts,
)


def padding(lengths, counts, stops):
    """Padding when lengths are cut after the positions in ``stops``."""
    total, first = 0, 0
    for stop in stops:
        total += sum((lengths[stop - 1] - lengths[i]) * counts[i] for i in range(first, stop))
        first = stop
    return total


def brute_force(lengths, counts, cuts):
    n = len(lengths)
    return min(padding(lengths, counts, [*inner, n]) for inner in combinations(range(1, n), cuts - 1))


def layered(lengths, counts, cuts):
    """Quadratic dynamic programme that keeps the smallest cut on ties."""
    n = len(lengths)
    cost = lambda k, i: sum((lengths[i - 1] - lengths[x]) * counts[x] for x in range(k, i))
    best = {(0, 0): (0, None)}
    for j in range(1, cuts + 1):
        for i in range(j, n + 1):
            options = [(best[k, j - 1][0] + cost(k, i), k) for k in range(j - 1, i) if (k, j - 1) in best]
            best[i, j] = min(options)
    ranges, i = [], n
    for j in range(cuts, 0, -1):
        k = best[i, j][1]
        ranges.append((lengths[k], lengths[i - 1] + 1))
        i = k
    return ranges[::-1]


histograms = st.dictionaries(st.integers(1, 60), st.integers(1, 50), min_size=2, max_size=12)


@settings(max_examples=150, deadline=None)
@given(histograms, st.integers(1, 8))
def test_cuts_are_optimal_and_tie_to_the_smallest(hist, cuts):
    lengths = sorted(hist)
    counts = [hist[x] for x in lengths]
    got = plan_cuts(np.array(lengths), np.array(counts), cuts)
    if len(lengths) <= cuts:
        assert [s for s, _ in got] == lengths
        return
    assert got == layered(lengths, counts, cuts)
    stops = [sum(x < end for x in lengths) for _, end in got]
    assert padding(lengths, counts, stops) == brute_force(lengths, counts, cuts)


@settings(max_examples=50, deadline=None)
@given(histograms, st.integers(1, 8))
def test_ranges_are_disjoint_and_hold_every_length(hist, cuts):
    lengths = np.array(sorted(hist))
    got = plan_cuts(lengths, np.array([hist[x] for x in sorted(hist)]), cuts)
    assert all(a_end <= b_start for (_, a_end), (b_start, _) in zip(got, got[1:]))
    assert all(sum(s <= x < e for s, e in got) == 1 for x in lengths.tolist())


def test_many_lengths():
    rng = np.random.default_rng(3)
    lengths = np.arange(1, 3001)
    counts = rng.integers(1, 1000, 3000)
    got = plan_cuts(lengths, counts, 20)
    assert len(got) == 20 and got[0][0] == 1 and got[-1][1] == 3001


def lengths_frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "n int")


def test_few_lengths_end_at_the_next(spark):
    hist = length_histogram(lengths_frame(spark, [3, 3, 7, 12]), "n")
    expected = [LengthRange(3, 7), LengthRange(7, 12), LengthRange(12, 13)]
    assert collect_ranges(small_cuts(hist)) == expected
    assert collect_ranges(optimal_cuts(hist, 5)) == expected


def test_empty_and_single_length(spark):
    assert collect_ranges(optimal_cuts(length_histogram(lengths_frame(spark, []), "n"), 4)) == []
    assert collect_ranges(optimal_cuts(length_histogram(lengths_frame(spark, [9, 9]), "n"), 1)) == [LengthRange(9, 10)]


def test_lengths_outside_all_ranges_get_null(spark):
    ranges = [LengthRange(3, 7), LengthRange(9, 10)]
    rows = assign_range(lengths_frame(spark, [0, 2, 3, 6, 7, 9, 10, 500, None]), "n", ranges, "x").collect()
    inside = {3: (0, 3, 7), 6: (0, 3, 7), 9: (1, 9, 10)}
    assert {r.n: (r.x_bucket, r.x_start, r.x_end) for r in rows} == {
        n: inside.get(n, (None, None, None)) for n in (0, 2, 3, 6, 7, 9, 10, 500, None)
    }


def test_lengths_are_placed_alike_with_and_without_an_array(spark, monkeypatch):
    ranges = [LengthRange(0, 4), LengthRange(4, 9), LengthRange(12, 70_000)]
    lookup = assign_range(lengths_frame(spark, [0, 3, 4, 8, 9, 11, 12, 69_999, 70_000, -1, None]), "n", ranges[:2], "x").collect()
    assert lengths.LOOKUP_LENGTHS < ranges[-1].end
    compared = assign_range(lengths_frame(spark, [0, 3, 4, 8, 9, 11, 12, 69_999, 70_000, -1, None]), "n", ranges, "x").collect()
    placed = lambda rows: {r.n: (r.x_bucket, r.x_start, r.x_end) for r in rows}
    assert placed(compared) == placed(lookup) | {12: (2, 12, 70_000), 69_999: (2, 12, 70_000)}


def test_no_ranges_hold_nothing(spark):
    assert assign_range(lengths_frame(spark, [0, 4]), "n", [], "x").filter("x_start IS NOT NULL").count() == 0
