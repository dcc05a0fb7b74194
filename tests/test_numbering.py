import hashlib

import pytest
from pyspark.sql import functions as F

from pairweave.operators import sharding
from pairweave.operators.batching import assign_batches_global
from pairweave.operators.cells import CELL
from pairweave.operators.numbering import hash_key, hash_slice, number_rows
from pairweave.operators.shuffle import seeded_shuffle, shuffle_rank


def expected_order(ids, seed=42):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))


def test_rank_is_the_same_for_any_partitioning_and_slicing(spark):
    want = {i: r for r, i in enumerate(expected_order(range(500)))}
    for partitions, slices in ((1, 1), (7, 16), (3, 65_536)):
        df = spark.range(500).withColumnRenamed("id", "pair_id").repartition(partitions)
        assert {r.pair_id: r.shuffle_rank for r in shuffle_rank(df, "pair_id", slices=slices).collect()} == want


def test_seeded_shuffle_sorts_by_hash(spark):
    df = spark.range(200).withColumnRenamed("id", "pair_id")
    assert [r.pair_id for r in seeded_shuffle(df, "pair_id").collect()] == expected_order(range(200))
    assert [r.pair_id for r in seeded_shuffle(df, "pair_id", 7).collect()] == expected_order(range(200), 7)


def test_a_hot_group_is_split_into_many_windows(spark):
    df = spark.range(3000).select(F.col("id"), F.when(F.col("id") < 2500, "hot").otherwise("cold").alias("g"))
    keyed = df.withColumn("k", hash_key(1, "id")).withColumn("s", hash_slice(F.col("k"), 32)).withColumn("v", F.lit(2))
    sizes = keyed.groupBy("g", "s").count().agg(F.max("count")).first()[0]
    assert sizes < 150
    rows = number_rows(keyed, ["g"], "s", ["k"], "pos", running={"before": "v"}).collect()
    for group in ("hot", "cold"):
        mine = sorted((r for r in rows if r.g == group), key=lambda r: r.k)
        assert [r.pos for r in mine] == list(range(len(mine)))
        assert [r.before for r in mine] == [2 * i for i in range(len(mine))]


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_global_batches_follow_key_order(spark, kind):
    keys = [5, 1, 9, 1000, 7, 3, 8] if kind == "bigint" else ["b", "a:10", "a:9", "é", "zz", "Z", ""]
    df = spark.createDataFrame([(k,) for k in [*keys, None]], f"pair_id {kind}")
    for slice_rows in (100, 4, 1):
        got = {r.pair_id: (r.batch_id, r.batch_pos) for r in assign_batches_global(df, 3, slice_rows=slice_rows).collect()}
        assert got == {k: divmod(i, 3) for i, k in enumerate([None, *sorted(keys)])}


def test_windows_stay_small_when_shards_are_huge(spark, monkeypatch):
    """The rows of one window do not depend on the size of a shard."""
    monkeypatch.setattr(sharding, "SLICE_ROWS", 100)
    placed = spark.range(5000).select(F.col("id").alias("pair_id"), *[F.lit(i).alias(c) for i, c in enumerate(CELL)])
    cells = spark.createDataFrame([(0, 1, 2, 3, 5000)], ", ".join(f"{c} int" for c in CELL) + ", n bigint")
    rows = sharding.assign_shards(placed, cells, 10**9)
    assert sorted(r.cell_rank for r in rows.collect()) == list(range(5000))
    key = hash_slice(hash_key(42, "pair_id"), 50)
    assert placed.groupBy(key).count().agg(F.max("count")).first()[0] < 160
