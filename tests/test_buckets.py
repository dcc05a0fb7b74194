import uuid

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pairweave.operators import cells, sharding
from pairweave.operators.batching import assign_batches
from pairweave.plans.buckets import build_buckets, plan_buckets, save_batch_sizes
from pairweave.sources import manifest, shards as shard_store

CELLS = ", ".join(f"{c} int" for c in cells.CELL) + ", n bigint"


def counted(spark, sizes):
    return spark.createDataFrame([(i, i + 1, 1, 2, n) for i, n in enumerate(sizes)], CELLS)


# Cells of the published run (max_samples 262,144): rows, shards, rows in the last shard.
PUBLISHED = [
    (1_514_283, 6, 203_563), (340_378, 1, 340_378), (873_768, 3, 349_480), (468_066, 2, 205_922), (381_643, 1, 381_643),
    (825_822, 3, 301_534), (560_968, 2, 298_824), (375_924, 1, 375_924), (769_448, 3, 245_160), (596_159, 2, 334_015),
    (262_724, 1, 262_724), (683_079, 3, 158_791), (415_992, 2, 153_848), (57_765, 1, 57_765),
]


def test_published_shard_counts(spark):
    rows = sharding.manifest_from_counts(counted(spark, [n for n, _, _ in PUBLISHED]), 262_144).collect()
    for i, (n, shards, last) in enumerate(PUBLISHED):
        mine = sorted((r for r in rows if r.src_start == i), key=lambda r: r.shard_idx)
        assert len(mine) == shards == mine[0].num_shards
        assert mine[-1].num_samples == last and sum(r.num_samples for r in mine) == n


# Rows of all kept cells of the published run, in its order.
PUBLISHED_CELLS = [
    1_514_283, 340_378, 60_712, 246_093, 873_768, 468_066, 125_173, 40_896, 381_643, 825_822, 560_968, 196_251,
    50_917, 72_695, 375_924, 769_448, 596_159, 262_724, 83_908, 78_134, 363_728, 683_079, 595_605, 304_005, 116_917,
    38_784, 95_381, 330_392, 604_465, 549_023, 323_796, 142_503, 52_991, 105_371, 313_708, 501_917, 492_113,
    320_096, 153_611, 74_537, 112_513, 265_260, 415_992, 424_493, 294_639, 184_325, 62_132, 36_826, 103_902,
    224_578, 344_236, 353_912, 319_859, 140_480, 51_709, 36_371, 93_056, 187_649, 274_758, 368_934, 240_236,
    108_486, 45_152, 34_732, 80_245, 153_742, 294_532, 284_588, 178_019, 92_992, 37_615, 81_139, 207_002, 300_853,
    285_080, 215_477, 93_366, 71_380, 147_421, 215_979, 260_457, 171_544, 62_525, 60_061, 122_161, 231_107, 260_571,
    146_568, 47_280, 37_630, 104_480, 209_505, 219_416, 120_140, 79_331, 164_553, 183_494, 81_554, 55_379, 138_294,
    150_243, 47_918, 35_458, 102_402, 99_900, 84_894, 65_260, 57_765,
]


def test_published_totals(spark):
    rows = sharding.manifest_from_counts(counted(spark, PUBLISHED_CELLS), 262_144).collect()
    assert (len(PUBLISHED_CELLS), len(rows), sum(r.num_samples for r in rows)) == (108, 131, 24_949_534)
    assert min(PUBLISHED_CELLS) >= 32_768 and max(r.num_samples for r in rows) <= 1.5 * 262_144
    for i, n in enumerate(PUBLISHED_CELLS):
        assert sum(r.num_samples for r in rows if r.src_start == i) == n


# Edges of the published run; for each target range its first source range and how many it has; batch sizes by cell.
PUBLISHED_SRC = [3, 7, 10, 13, 16, 19, 22, 25, 28, 31, 34, 38, 42, 46, 51, 57, 64, 73, 85, 102, 129]
PUBLISHED_TGT = [2, 6, 9, 12, 15, 18, 21, 24, 27, 30, 33, 36, 40, 44, 49, 55, 62, 71, 82, 99, 128]
PUBLISHED_KEPT = [
    (0, 3), (0, 4), (0, 6), (1, 6), (2, 7), (3, 7), (4, 7), (5, 7), (5, 8), (6, 8),
    (7, 7), (8, 7), (10, 6), (11, 6), (12, 5), (14, 4), (15, 4), (16, 3), (18, 2), (19, 1),
]
PUBLISHED_BATCHES = [
    10290, 9179, 8192, 7829, 7168, 6420, 5855, 6149, 5734, 5263, 5043, 4608, 4363, 4875, 4576, 4240, 4096, 3840,
    3603, 4056, 3748, 3584, 3405, 3263, 3073, 2922, 3411, 3191, 3072, 2890, 2864, 2725, 2590, 2925, 2824, 2661,
    2560, 2560, 2411, 2309, 2560, 2532, 2418, 2336, 2274, 2196, 2096, 2408, 2322, 2274, 2224, 2121, 2048, 1984,
    1876, 2178, 2082, 2048, 2007, 1897, 1859, 1801, 1703, 1981, 1912, 1861, 1832, 1739, 1706, 1635, 1792, 1720,
    1706, 1631, 1576, 1568, 1462, 1574, 1538, 1475, 1459, 1358, 1318, 1424, 1323, 1350, 1281, 1199, 1197, 1280,
    1223, 1204, 1112, 1055, 1096, 1075, 1024, 923, 930, 928, 861, 787, 787, 786, 697, 652, 603, 479,
]


def test_published_tokens_and_iterations(spark):
    """Padded tokens, and batches of an epoch with and without the last ones."""
    places = [(s, t) for t, (first, n) in enumerate(PUBLISHED_KEPT) for s in range(first, first + n)]
    edges = [(PUBLISHED_SRC[s], PUBLISHED_SRC[s + 1], PUBLISHED_TGT[t], PUBLISHED_TGT[t + 1]) for s, t in places]
    rows = [(*e, n, b) for e, n, b in zip(edges, PUBLISHED_CELLS, PUBLISHED_BATCHES, strict=True)]
    kept = spark.createDataFrame(rows, f"{CELLS}, b int")
    assert kept.selectExpr("sum(n * (src_end + tgt_end - 2)) AS t").first().t == 1_366_150_621
    shards = sharding.manifest_from_counts(kept, 262_144).drop("suggested_batch_size")
    sized = shards.join(kept.select(*cells.CELL, F.col("b").alias("suggested_batch_size")), cells.CELL)
    assert sharding.epoch_iterations(sized, 0.75).first().iterations == 14_093
    assert sharding.epoch_iterations(sized, 0.75, drop_last=True).first().iterations == 13_962
    ordered = sharding.curriculum_order(sized).filter("shard_idx = 0").orderBy("position").collect()
    assert [(r.src_start, r.tgt_start) for r in ordered] == [(e[0], e[2]) for e in edges]


@pytest.mark.parametrize("cuts", [0, -1, 1001])
def test_number_of_cuts_is_checked(spark, cuts):
    with pytest.raises(ValueError):
        cells.build_grid(skewed_pairs(spark), cuts)


def test_last_shard_of_at_most_half_is_merged(spark):
    sizes = {100: [100], 149: [149], 150: [150], 151: [100, 51], 200: [100, 100], 250: [100, 150], 251: [100, 100, 51]}
    rows = sharding.manifest_from_counts(counted(spark, list(sizes)), 100).collect()
    for i, want in enumerate(sizes.values()):
        got = sorted((r.shard_idx, r.num_samples) for r in rows if r.src_start == i)
        assert [n for _, n in got] == want


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(1, 5000), min_size=1, max_size=20), st.integers(1, 700))
def test_shards_hold_all_rows_and_stay_bounded(spark, sizes, most):
    rows = sharding.manifest_from_counts(counted(spark, sizes), most).collect()
    assert all(r.num_samples <= 1.5 * most for r in rows)
    for i, n in enumerate(sizes):
        assert sum(r.num_samples for r in rows if r.src_start == i) == n


def skewed_pairs(spark, n=4000):
    """Half of all rows in one cell."""
    src = F.when(F.col("id") % 2 == 0, 10).otherwise(3 + F.col("id") % 40).cast("int")
    return spark.range(n).select(F.col("id").alias("pair_id"), src.alias("src_len"), (src + F.col("id") % 2).cast("int").alias("tgt_len"))


def test_rows_and_counts_give_the_same_manifest(spark):
    plan = plan_buckets(skewed_pairs(spark), 6, 30, 200)
    by_rows = {tuple(r) for r in sharding.shard_manifest(plan.sharded).select(plan.shards.columns).collect()}
    assert by_rows == {tuple(r) for r in plan.shards.collect()}
    assert max(r[5] for r in by_rows) > 5
    totals = plan.totals.first()
    assert totals.total_original_samples == 4000
    assert totals.total_samples == sum(r[-1] for r in by_rows) == 4000 - totals.discarded_samples
    kept = plan.sharded.agg(F.sum(F.col("src_end") - 1 - F.col("src_len") + F.col("tgt_end") - 1 - F.col("tgt_len"))).first()[0]
    assert kept == totals.total_padding


def test_thin_cells_at_the_threshold(spark):
    frame = counted(spark, [9, 10, 11])
    assert sorted(r.n for r in cells.filter_min_samples(frame, 10).collect()) == [10, 11]


def test_kept_and_discarded_rows_are_complementary(spark):
    pairs = skewed_pairs(spark)
    grid = cells.build_grid(pairs, 6)
    valid = cells.valid_cells(grid, 400)
    placed = cells.assign_cell(pairs, grid.src, grid.tgt)
    kept, gone = cells.keep_valid(placed, valid), cells.discarded(placed, valid)
    assert kept.count() + gone.count() == 4000 and gone.count() > 0
    assert kept.join(gone, "pair_id").count() == 0


def test_grid_keeps_empty_cells(spark):
    grid = cells.build_grid(skewed_pairs(spark), 5)
    rows = cells.cell_grid(spark, grid.src, grid.tgt, cells.count_cells(grid.placed, "cnt")).collect()
    assert len(rows) == 25 and sum(r.n for r in rows) == 4000 and any(r.n == 0 for r in rows)


def test_store_is_built_loaded_and_rebuilt(spark, tmp_path):
    path = str(tmp_path / "store")
    with pytest.raises(FileNotFoundError):
        build_buckets(spark, path)
    with pytest.raises(ValueError):
        build_buckets(spark, "")
    pairs = skewed_pairs(spark)
    shards, totals = build_buckets(spark, path, pairs, 6, 30, 200)
    first = sorted(map(tuple, shards.collect()))
    # Data is ignored while a store exists, and used again on a forced rebuild.
    again, _ = build_buckets(spark, path, pairs.limit(50), 6, 30, 200)
    assert sorted(map(tuple, again.collect())) == first
    rebuilt, new_totals = build_buckets(spark, path, pairs.filter("pair_id < 1000"), 6, 30, 200, force_rebuild=True)
    assert new_totals.first().total_original_samples == 1000
    assert sorted(map(tuple, rebuilt.collect())) != first


def test_shard_read_prunes_and_fails_when_missing(spark, tmp_path):
    path = str(tmp_path / "data")
    plan = plan_buckets(skewed_pairs(spark), 6, 30, 200)
    shard_store.write_shards(plan.sharded, path)
    for row in plan.shards.orderBy(F.desc("num_shards"), "shard_idx").limit(3).collect():
        one = shard_store.read_shard(spark, path, (row.src_start, row.src_end), (row.tgt_start, row.tgt_end), row.shard_idx)
        assert one.count() == row.num_samples
        assert len(one.inputFiles()) < len(shard_store.read_shards(spark, path).inputFiles())
    with pytest.raises(ValueError):
        shard_store.read_shard(spark, path, (1, 2), (1, 2), 99)
    pruned = shard_store.read_shards(spark, path).filter("src_start = 10 and shard_idx = 0")
    plan_text = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(src_start" in plan_text and "(src_start" in plan_text


def test_single_rows_open_single_files(spark, tmp_path):
    pairs = spark.range(900).select(F.col("id").alias("pair_id"), (F.col("id") % 9 + 3).cast("int").alias("src_len"), (F.col("id") % 7 + 3).cast("int").alias("tgt_len"))
    plan = plan_buckets(pairs, 2, 1, 60)
    path, index = str(tmp_path / "s"), str(tmp_path / "i")
    shard_store.write_shards(plan.sharded.repartition(3, "cell_rank"), path)
    shard_store.index_shards(spark, path, index, 60)
    stored = shard_store.read_shards(spark, path).withColumn("row", shard_store.shard_ordinal(60))
    by_place = {(r.src_start, r.tgt_start, r.shard_idx, r.row): r.pair_id for r in stored.collect()}
    assert len(by_place) == 900
    places = sorted(by_place)[::97]
    schema = "src_start int, tgt_start int, shard_idx int, row bigint"
    found = shard_store.read_rows(spark, path, index, spark.createDataFrame([*places, places[0], (99, 99, 0, 0)], schema), 60)
    assert {(r.src_start, r.tgt_start, r.shard_idx, r.row): r.pair_id for r in found.collect()} == {p: by_place[p] for p in places}
    assert found.count() == len(places)
    one = shard_store.read_rows(spark, path, index, spark.createDataFrame(places[:1], schema), 60)
    assert len(one.inputFiles()) == 1
    assert shard_store.read_rows(spark, path, index, spark.createDataFrame([], schema), 60).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 40_000), st.integers(1, 20_000))
def test_halving_finds_what_a_probe_bears(most_that_fits, most):
    tried = []

    def fits(size):
        tried.append(size)
        if size > most_that_fits + 100:
            raise MemoryError
        return size <= most_that_fits

    found = sharding.largest_batch(fits, most)
    assert len(tried) <= (most - 1).bit_length() and all(1 <= n <= most for n in tried)
    assert found == max((n for n in tried if n <= most_that_fits), default=0)
    # One try fewer than sizes need may leave one size untried.
    assert found >= min(most, most_that_fits) - 1


def test_each_cell_is_probed_once_and_saved(spark, tmp_path):
    pairs = spark.range(400).select(F.col("id").alias("pair_id"), (F.col("id") % 9 + 3).cast("int").alias("src_len"), (F.col("id") % 7 + 3).cast("int").alias("tgt_len"))
    path = str(tmp_path / "store")
    build_buckets(spark, path, pairs, 3, 1, 30)
    log = tmp_path / "log"
    log.mkdir()

    def bears(src_end, tgt_end, size):
        (log / f"{src_end}-{tgt_end}-{size}-{uuid.uuid4()}").touch()
        return size * (src_end + tgt_end) <= 5_000

    sized = save_batch_sizes(spark, path, probe=bears).collect()
    assert len(sized) > len({(r.src_end, r.tgt_end) for r in sized})
    assert all(abs(r.suggested_batch_size - 5_000 // (r.src_end + r.tgt_end)) <= 1 for r in sized)
    tries = [f.name.split("-")[:3] for f in log.iterdir()]
    assert len(tries) == len(set(map(tuple, tries)))


def test_older_manifest_gets_defaults(spark, tmp_path):
    path = str(tmp_path)
    (tmp_path / "shards").mkdir()
    (tmp_path / "totals").mkdir()
    (tmp_path / "shards" / "a.json").write_text('{"src_range": [3, 7], "tgt_range": [2, 6], "shard_idx": 0, "num_shards": 1, "num_samples": 5}')
    (tmp_path / "totals" / "a.json").write_text('{"total_samples": 5}')
    shards, totals = manifest.load_manifest(spark, path)
    assert tuple(shards.first()) == (3, 7, 2, 6, 0, 1, 0, 5)
    assert (totals.first().num_cuts, totals.first().total_samples, totals.first().total_padding) == (8, 5, 0)


def test_batch_sizes_iterations_and_stats(spark):
    shards = sharding.manifest_from_counts(
        spark.createDataFrame([(3, 7, 2, 6, 250), (10, 129, 2, 128, 99)], CELLS), 100
    )
    assert not sharding.plan_complete(shards).first().complete
    with pytest.raises(Exception, match="no batch size"):
        sharding.epoch_iterations(shards).collect()
    sized = sharding.spread_batch_size(shards, lambda s, t: sharding.batch_size_for(s, t, 520))
    assert {(r.src_start, r.suggested_batch_size) for r in sized.collect()} == {(3, 40), (10, 2)}
    assert sharding.plan_complete(sized).first().complete
    # 0.75 of the batch sizes: 30 and 1.
    assert sharding.epoch_iterations(sized).first().iterations == 4 + 5 + 99
    assert sharding.epoch_iterations(sized, drop_last=True).first().iterations == 3 + 5 + 99
    empty = spark.createDataFrame(
        [(1, 1, 1, 0, 0, 0, 0, 0)], manifest.TOTALS_SCHEMA
    )
    stats = sharding.bucket_stats(sized, empty).first()
    assert stats.discard_pct is None and stats.padding_pct == 0.0


def test_curriculum_order(spark):
    shards = sharding.manifest_from_counts(
        spark.createDataFrame([(5, 6, 9, 12, 10), (1, 3, 9, 12, 250), (5, 6, 2, 9, 10)], CELLS), 100
    )
    rows = sorted(sharding.curriculum_order(shards).collect(), key=lambda r: r.position)
    assert [(r.tgt_start, r.src_start, r.shard_idx) for r in rows] == [(2, 5, 0), (9, 1, 0), (9, 1, 1), (9, 5, 0)]
    assert manifest.shard_at(sharding.curriculum_order(shards), 2).first().shard_idx == 1


def test_batches_keep_the_tail(spark):
    plan = plan_buckets(skewed_pairs(spark), 6, 30, 200)
    batches = assign_batches(plan.sharded, 64, 200)
    sizes = batches.groupBy(*cells.CELL, "shard_idx", "batch_id").agg(F.count(F.lit(1)).alias("n"), F.max("batch_pos").alias("p"))
    assert all(r.n == r.p + 1 <= 64 for r in sizes.collect())
    assert sizes.agg(F.sum("n")).first()[0] == plan.sharded.count()


def test_placing_rows_joins_and_shuffles_nothing(spark):
    pairs = skewed_pairs(spark)
    grid = cells.build_grid(pairs, 6)
    plan = cells.assign_cell(pairs, grid.src, grid.tgt)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    kept = cells.keep_valid(cells.assign_cell(pairs, grid.src, grid.tgt), cells.valid_cells(grid, 10))
    kept_plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in kept_plan and "NestedLoop" not in kept_plan and "SortMergeJoin" not in kept_plan


def test_placing_adds_no_filter(spark):
    """Ranges are found in projections; nothing that repeats them is pushed below the join or the scan."""
    pairs = spark.range(500).selectExpr("id AS pair_id", "cast(2 + id % 40 as int) AS src_len", "cast(2 + id % 37 as int) AS tgt_len")
    grid = cells.build_grid(pairs, 6)
    placed, valid = cells.assign_cell(pairs, grid.src, grid.tgt), cells.valid_cells(grid, 5)
    for df in (cells.keep_valid(placed, valid), cells.discarded(placed, valid), sharding.assign_shards(placed, valid, 100)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        rows = plan.splitlines()
        scan = next(i for i, line in enumerate(rows) if "Range (0, 500" in line)
        assert not any("Filter" in line for line in rows[:scan])
