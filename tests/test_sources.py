import uuid

import pytest
from pyspark.sql import functions as F

from pairweave import session
from pairweave.operators.lengths import LengthRange
from pairweave.operators.translation import translate_batches
from pairweave.operators.vocabulary import train_bpe, unit_counts
from pairweave.plans import buckets
from pairweave.plans.buckets import build_buckets
from pairweave.plans.evaluate import evaluate
from pairweave.plans.preprocess import export_corpus, loss_report, tokenize_pairs
from pairweave.session import cut_lineage, remove, remove_scratch, rewrite, scratch_path, scratch_table, shared_dir, spread
from pairweave.sources import bitext, manifest, tables
from pairweave.streaming.rowwise import append_placed, place_stream, stream_bitext

PAIRS = [(1, "one two", "eins zwei"), (2, "a\nb", "c\\n"), (3, "x", "y\r"), (4, "", "z")]


def flat(spark, rows=PAIRS):
    return spark.createDataFrame(rows, "pair_id bigint, src_text string, tgt_text string")


def nested(spark, rows=PAIRS):
    return flat(spark, rows).select("pair_id", F.struct(F.col("src_text").alias("en"), F.col("tgt_text").alias("zh")).alias("translation"))


def test_scan_reads_all_folders_and_two_fields(spark, tmp_path):
    for i, row in enumerate(PAIRS):
        nested(spark, [row]).write.parquet(str(tmp_path / f"part{i}"))
    paths = [str(tmp_path / f"part{i}") for i in range(len(PAIRS))]
    read = bitext.flatten_pairs(bitext.read_bitext(spark, paths))
    assert sorted(map(tuple, read.collect())) == PAIRS
    only = bitext.flatten_pairs(bitext.read_bitext(spark, paths)).select("src_text")
    assert "ReadSchema: struct<translation:struct<en:string>>" in only._jdf.queryExecution().executedPlan().toString()


def test_missing_sentences_raise_or_drop(spark):
    broken = nested(spark, [*PAIRS, (5, None, "w"), (6, "v", None)])
    assert bitext.validate_bitext(broken, "drop").count() == 4
    with pytest.raises(Exception, match="a sentence is missing"):
        bitext.validate_bitext(broken).collect()
    assert bitext.validate_bitext(nested(spark)).count() == 4
    assert tuple(bitext.count_rejects(broken).first()) == (6, 2)


def test_missing_field_is_named(spark):
    with pytest.raises(ValueError, match="zh"):
        bitext.validate_bitext(nested(spark).select(F.struct("translation.en").alias("translation")))
    with pytest.raises(ValueError):
        bitext.require_fields(flat(spark))


def test_corpus_files_are_aligned_line_by_line(spark, tmp_path):
    rows = [(i, f"s{i}\n{i}", f"t{i}") for i in range(400)]
    path = tmp_path / "corpus"
    bitext.write_corpus(flat(spark, rows).repartition(7), str(path))
    sides = {s: sorted((path / f"side={s}").glob("part-*")) for s in ("src", "tgt")}
    assert len(sides["src"]) == len(sides["tgt"])
    number = 0
    for a, b in zip(sides["src"], sides["tgt"]):
        assert a.name.split("-")[1] == b.name.split("-")[1]
        left, right = a.read_text().splitlines(), b.read_text().splitlines()
        assert len(left) == len(right)
        for x, y in zip(left, right):
            assert (x, y) == (f"s{number}\\n{number}", f"t{number}")
            number += 1
    assert number == 400


def test_splits_are_chosen(spark):
    splits = {"train": flat(spark), "valid": flat(spark, PAIRS[:1])}
    assert bitext.corpus_union(splits).count() == 4
    both = bitext.corpus_union(splits, ["train", "valid"])
    assert {(r.split, r["count"]) for r in both.groupBy("split").count().collect()} == {("train", 4), ("valid", 1)}


def test_corpus_is_segmented_joined_and_exported(spark, tmp_path):
    words = spark.createDataFrame([("北京", 50), ("大学", 40), ("我", 9), ("爱", 9)], "word string, cnt bigint")
    splits = {"train": flat(spark, [(1, "i love", "我爱北京大学")]), "valid": flat(spark, [(2, "x", "北京\n大学"), (3, "y", "z")])}
    export_corpus(splits, str(tmp_path / "c"), words, ["train", "valid"])
    lines = lambda side: [line for p in sorted((tmp_path / "c" / f"side={side}").glob("part-*")) for line in p.read_text().splitlines()]
    assert lines("src") == ["i love", "x", "y"]
    assert lines("tgt") == ["我 爱 北京 大学", "北京\\n大学", "z"]


def test_vocabulary_round_trip(spark, tmp_path):
    path = str(tmp_path / "vocab")
    with pytest.raises(FileNotFoundError):
        tables.read_vocab(spark, path)
    model = train_bpe(unit_counts(flat(spark, [(i, "low lower lowest", "") for i in range(4)]), "src_text"))
    tables.write_vocab(model, path)
    loaded = tables.read_vocab(spark, path)
    for a, b in zip(model, loaded):
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_metrics_log_appends(spark, tmp_path):
    path = str(tmp_path / "log")
    row = spark.createDataFrame([(1, 2, "train", 0.5, 0.25)], tables.METRICS)
    tables.append_metrics(row, path)
    tables.append_metrics(row.withColumn("epoch", F.lit(2)), path)
    assert sorted(r.epoch for r in tables.read_metrics(spark, path).collect()) == [1, 2]


def test_report_is_replaced_and_ordered(spark, tmp_path):
    path = tmp_path / "report"
    rows = spark.createDataFrame([(2, "b", "B", None), (1, "a\nx", "A", "h")], "pair_id int, src_text string, ref_text string, hyp_text string")
    for _ in range(2):
        tables.write_report(rows, str(path))
    text = "".join(p.read_text() for p in sorted(path.glob("part-*")))
    assert text == "EN: a\\nx\nZH_REF: A\nZH_HYP: h\n\nEN: b\nZH_REF: B\nZH_HYP: \n\n"


@pytest.fixture
def shouting():
    def load():
        return lambda texts: [t.upper() for t in texts]

    return load


def test_translation_keeps_every_row(spark, shouting):
    rows = [(i, "same length" if i % 3 else "x" * i, "") for i in range(900)]
    got = translate_batches(flat(spark, rows).drop("tgt_text"), shouting, 64).collect()
    assert {r.pair_id: r.hyp_text for r in got} == {i: s.upper() for i, s, _ in rows}


def test_translation_batches_are_full_and_nulls_stay_null(spark, tmp_path):
    seen = str(tmp_path)

    def load():
        def translate(texts):
            with open(f"{seen}/{uuid.uuid4().hex}", "w") as f:
                f.write(str(len(texts)))
            return [t.upper() for t in texts]

        return translate

    rows = spark.range(25_000).select(F.col("id").alias("pair_id"), F.concat(F.lit("s"), "id").alias("src_text")).coalesce(1)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = translate_batches(rows.unionByName(rows.limit(1).select(F.lit(-1).cast("bigint").alias("pair_id"), F.lit(None).cast("string").alias("src_text"))), load, 512)
        assert got.filter("pair_id >= 0 and hyp_text <> upper(src_text)").count() == 0
        for f in tmp_path.iterdir():
            f.unlink()
        assert [r.hyp_text for r in got.filter("pair_id = -1").collect()] == [None]
        for f in tmp_path.iterdir():
            f.unlink()
        got.select(F.count("hyp_text")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    sizes = sorted(int(f.read_text()) for f in tmp_path.iterdir())
    assert sum(sizes) == 25_000 and len([s for s in sizes if s < 511]) <= 1


def test_raw_files_get_ids_that_do_not_depend_on_the_files(spark, tmp_path):
    rows = [("a", "b"), ("a", "b"), ("a", None), (None, "b"), (None, None), ("a+b", ""), ("a", "+b"), *[("same", "pair")] * 50]
    raw = spark.createDataFrame([(r,) for r in rows], bitext.RAW_SCHEMA)
    found = []
    for files in (1, 5):
        path = str(tmp_path / f"f{files}")
        raw.repartition(files).write.parquet(path)
        named = bitext.with_pair_id(bitext.read_bitext(spark, path, bitext.RAW_SCHEMA))
        bitext.require_unique_ids(named)
        found.append(sorted((r.pair_id, r.translation.en or "", r.translation.zh or "") for r in named.collect()))
    assert found[0] == found[1] and len(found[0]) == len(rows)
    for bad in (raw.withColumn("pair_id", F.lit(None).cast("string")), raw.withColumn("pair_id", F.lit("x"))):
        with pytest.raises(ValueError):
            bitext.require_unique_ids(bad)


def test_raw_files_end_to_end(spark, tmp_path):
    raw = spark.createDataFrame([((f"the cat {i} sat", f"die katze {i % 5}"),) for i in range(300)] + [((None, "x"),)], bitext.RAW_SCHEMA)
    raw.write.parquet(str(tmp_path / "raw"))
    (tmp_path / "raw/part-broken.parquet").write_bytes(b"not parquet at all")
    with pytest.warns(UserWarning):
        read, left_out = bitext.read_readable(spark, str(tmp_path / "raw"))
    assert left_out == 1
    pairs = bitext.flatten_pairs(bitext.validate_bitext(bitext.with_pair_id(read), "drop"))
    model = train_bpe(unit_counts(pairs, "src_text"), num_merges=10)
    tokens = tokenize_pairs(pairs, model, model)
    shards, totals = build_buckets(spark, str(tmp_path / "store"), cut_lineage(tokens), 3, 1, 100)
    assert totals.first().total_samples == 300 and shards.agg(F.sum("num_samples")).first()[0] == 300


def test_broken_files_are_told_by_footer_and_rows(spark, tmp_path):
    """Cut at the head, in the middle and at the tail, filled with something else, empty; the rest is read whole."""
    raw = spark.createDataFrame([((f"the cat {i} {i * 7919 % 10007}", f"die katze {i}"),) for i in range(4000)], bitext.RAW_SCHEMA)
    names = ["whole", "head", "middle", "tail", "other", "none", "noise"]
    for i, name in enumerate(names):
        rows = raw.filter("false") if name == "none" else raw.limit(1000 + i)
        rows.coalesce(1).write.parquet(str(tmp_path / name))
    files = {name: next((tmp_path / name).glob("part-*.parquet")) for name in names}
    for crc in tmp_path.glob("*/.*.crc"):
        crc.unlink()
    data = {name: f.read_bytes() for name, f in files.items()}
    half = len(data["middle"]) // 2
    changed = bytearray(data["noise"])
    changed[half : half + 30] = bytes(30)
    files["head"].write_bytes(data["head"][50:])
    files["middle"].write_bytes(data["middle"][:half] + data["middle"][half + 64 :])
    files["tail"].write_bytes(data["tail"][:-10])
    files["other"].write_bytes(b"no table at all")
    files["noise"].write_bytes(changed)
    report = {r.path.rsplit("/", 2)[1]: r for r in bitext.file_report(spark, str(tmp_path)).collect()}
    assert {name: r.status for name, r in report.items()} == {
        "whole": "complete", "head": "damaged", "middle": "damaged", "tail": "unreadable", "other": "unreadable", "none": "complete", "noise": "damaged",
    }
    assert (report["whole"].stated, report["whole"].read, report["none"].stated) == (1000, 1000, 0)
    assert (report["middle"].stated, report["tail"].stated) == (1002, None)
    with pytest.warns(UserWarning):
        rows, left_out = bitext.read_readable(spark, str(tmp_path))
    assert left_out == 5 and rows.columns == ["translation"] and rows.count() == 1000


@pytest.mark.parametrize("split", ["200b", "128m"])
def test_lines_are_numbered_where_they_are_read(spark, tmp_path, split):
    """Over several files, and files over several splits."""
    lines = [f"line {i} {'x' * (i % 50)}" for i in range(500)]
    for i, (a, b) in enumerate([(0, 120), (120, 121), (121, 400), (400, 400), (400, 500)]):
        (tmp_path / "t").mkdir(exist_ok=True)
        (tmp_path / "t" / f"part-{i:05d}.txt").write_text("".join(f"{x}\n" for x in lines[a:b]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        rows = bitext.numbered_lines(spark, str(tmp_path / "t")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.value for r in sorted(rows)] == lines and sorted(r.line_no for r in rows) == list(range(500))


def test_corpora_are_read_back_in_step(spark, tmp_path):
    texts = ["plain", "back\\slash", "\\n no break", "a\nb\rc", "\\\\n", "", "end\\", "\\\n\\r"]
    rows = [(i, t, texts[-1 - i]) for i, t in enumerate(texts)]
    path = str(tmp_path / "c")
    bitext.write_corpus(flat(spark, rows), path)
    back = bitext.read_corpus(spark, path)
    assert sorted(map(tuple, back.collect())) == rows
    assert tuple(bitext.ragged_lines(back).first()) == (0, 0)
    (tmp_path / "c/side=src/part-99999.txt").write_text("one line more\n")
    assert tuple(bitext.ragged_lines(bitext.read_corpus(spark, path)).first()) == (1, 0)


def test_saved_over_itself_and_interrupted(spark, tmp_path, monkeypatch):
    """A store is always one build: the old one until the pointer moves, then the new one."""
    pairs = spark.range(400).select(F.col("id").alias("pair_id"), (F.col("id") % 9 + 3).cast("int").alias("src_len"), (F.col("id") % 7 + 3).cast("int").alias("tgt_len"))
    path = str(tmp_path / "store")
    build_buckets(spark, path, pairs, 2, 1, 100)
    sized = buckets.save_batch_sizes(spark, path)
    assert sized.filter("suggested_batch_size > 0").count() == sized.count() > 0
    check = lambda: (manifest.load_manifest(spark, f"{path}/manifest")[0].agg(F.sum("num_samples")).first()[0], spark.read.parquet(buckets.data_path(spark, path)).count())
    for broken in ("_write_pointer", "with_ranges"):
        with monkeypatch.context() as patch:
            patch.setattr(manifest, broken, lambda *a: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                build_buckets(spark, path, pairs.limit(100), 2, 1, 100, force_rebuild=True)
            with pytest.raises(ZeroDivisionError):
                buckets.save_batch_sizes(spark, path)
        assert check() == (400, 400)
    build_buckets(spark, path, pairs.limit(100), 2, 1, 100, force_rebuild=True)
    assert check() == (100, 100)
    for marker in (tmp_path / "store").rglob("*_SUCCESS*"):
        marker.unlink()
    assert manifest.manifest_exists(spark, f"{path}/manifest")


def test_evaluation_end_to_end(spark, tmp_path, shouting):
    sentences = [(i, f"the cat number {i % 7} sat on a mat", f"THE CAT NUMBER {i % 7} SAT ON A MAT") for i in range(30)]
    pairs = flat(spark, [*sentences, (99, "word " * 200, "long")])
    model = train_bpe(unit_counts(pairs, "src_text"), num_merges=20)
    got = evaluate(pairs, model, shouting, str(tmp_path / "report"), batch_size=8).first()
    assert (got.total, got.valid, got.discarded) == (31, 30, 1) and got.bleu == pytest.approx(100.0)
    assert "ZH_HYP: THE CAT" in "".join(p.read_text() for p in (tmp_path / "report").glob("part-*"))


def test_loss_report(spark):
    encoded = spark.createDataFrame([([1] * 3, [1] * 3), ([1] * 9, [1])], "src_ids array<int>, tgt_ids array<int>")
    totals = spark.createDataFrame([(4,)], "discarded_samples bigint")
    read = spark.createDataFrame([(10, 2)], "read bigint, rejected bigint")
    assert tuple(loss_report(read, encoded, totals, 5).first()) == (10, 2, 1, 4)


def test_stream_gives_what_a_batch_gives(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(i, f"stream row {i}", f"zeile {i} hier") for i in range(60)] + [(100, None, "x")]
    nested(spark, rows[:30]).write.parquet(source)
    nested(spark, rows[30:]).write.mode("append").parquet(source)
    model = train_bpe(unit_counts(flat(spark, rows[:60]), "src_text"), num_merges=10)
    ranges = [LengthRange(1, 12), LengthRange(12, 60)]
    placed = place_stream(stream_bitext(spark, source, 1), model, model, ranges, ranges)
    assert placed.isStreaming
    for _ in range(2):  # A restart finds nothing new.
        assert append_placed(placed, sink, str(tmp_path / "state")).awaitTermination(120)
    got = {r.pair_id: (list(r.src), r.src_start) for r in spark.read.parquet(sink).collect()}
    batch = tokenize_pairs(bitext.flatten_pairs(bitext.validate_bitext(nested(spark, rows), "drop")), model, model)
    want = {r.pair_id: list(r.src) for r in batch.collect()}
    assert {k: v[0] for k, v in got.items()} == want and len(got) == 60
    assert all(start in (1, 12) for _, start in got.values())


def test_shared_folder(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    assert scratch_path(spark, "a").startswith(shared_dir(spark))


def test_rewritten_tables_are_removed(spark):
    table, path = rewrite(spark.range(5), "numbers")
    assert table.count() == 5
    remove(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_intermediate_data_can_be_removed(spark):
    df, path = rewrite(spark.range(3).toDF("x"), "left")
    table = scratch_table("left")
    df.write.saveAsTable(table)
    saved, session._PATHS[:] = session._PATHS[:-1], [path]
    tables_before, session._TABLES[:] = session._TABLES[:-1], [table]
    remove_scratch(spark)
    session._PATHS[:], session._TABLES[:] = saved, tables_before
    assert not spark.catalog.tableExists(table)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_spread_moves_only_narrow_scans(spark):
    cores = spark.sparkContext.defaultParallelism
    assert spread(spark.range(100).coalesce(1)).rdd.getNumPartitions() == cores
    wide = spark.range(0, 100, 1, cores + 3)
    assert spread(wide) is wide


def test_small_shards_are_not_split_between_files(spark, tmp_path):
    from pairweave.plans.buckets import plan_buckets
    from pairweave.sources import shards

    pairs = spark.range(6000).select(F.col("id").cast("string").alias("pair_id"), F.lit(5).alias("src_len"), F.lit(7).alias("tgt_len"))
    plan = plan_buckets(pairs, 2, 1, 100)
    shards.write_shards(plan.sharded, f"{tmp_path}/s")
    files = shards.read_shards(spark, f"{tmp_path}/s").select(F.col("_metadata.file_path").alias("f"), "shard_idx").distinct().collect()
    assert len({r.shard_idx for r in files}) == 60 == len(files)


def test_many_files_are_scanned_instead_of_named(spark, tmp_path, monkeypatch):
    from pairweave.plans.buckets import plan_buckets
    from pairweave.sources import shards

    pairs = spark.range(600).select(F.col("id").cast("string").alias("pair_id"), F.lit(5).alias("src_len"), F.lit(7).alias("tgt_len"))
    plan = plan_buckets(pairs, 2, 1, 100)
    shards.write_shards(plan.sharded, f"{tmp_path}/s")
    shards.index_shards(spark, f"{tmp_path}/s", f"{tmp_path}/i", 100)
    wanted = plan.shards.select("src_start", "tgt_start", "shard_idx", F.lit(3).cast("bigint").alias("row"))
    rows = lambda: sorted((r.shard_idx, r.pair_id) for r in shards.read_rows(spark, f"{tmp_path}/s", f"{tmp_path}/i", wanted, 100).collect())
    named = rows()
    monkeypatch.setattr(shards, "NAMED_FILES", 2)
    assert rows() == named and len(named) == 6
    assert len(shards.read_rows(spark, f"{tmp_path}/s", f"{tmp_path}/i", wanted, 100).inputFiles()) >= 6


def test_a_part_is_one_file(spark, tmp_path):
    from pairweave.catalog.fixtures import write_file_per_part

    write_file_per_part(spark.range(100, numPartitions=7).select("id", (F.col("id") % 3).alias("part")), f"{tmp_path}/p")
    back = spark.read.parquet(f"{tmp_path}/p")
    assert len(back.inputFiles()) == 3 and back.filter("id % 3 = part").count() == 100
