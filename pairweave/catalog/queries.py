"""One registered query per operator; each runs over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairweave.catalog import fixtures as fx
from pairweave.functions.arrays import BOS, add_specials, argmax_index, cut_at_eos, joined, narrow_ids, pad_to
from pairweave.functions.schedule import cosine_anneal
from pairweave.functions.text import byte_units, normalize_text, pretokenize
from pairweave.operators import cells, lengths, sharding
from pairweave.operators.batching import assign_batches, assign_batches_global, dynamic_width, stack_batches
from pairweave.operators.decoding import beam_decode
from pairweave.operators.encoding import bpe_encode, decode_ids
from pairweave.operators.metrics import epoch_loss, smoothed_loss, token_accuracy
from pairweave.operators.scoring import corpus_bleu, corpus_bleu_multi, eval_summary, ngram_matches, split_by_source_length, tokenize_zh
from pairweave.operators.segmentation import segment_runs
from pairweave.operators.selection import beam_step, nbest_pick, repetition_penalty
from pairweave.operators.shuffle import shuffle_rank
from pairweave.operators.translation import translate_batches
from pairweave.operators.vocabulary import pair_counts, unit_counts, vocab_check, word_vocabulary
from pairweave.plans.buckets import build_buckets, save_batch_sizes
from pairweave.plans.preprocess import filter_max_length, loss_report, padded, piece_counts, shift_targets, stored_pairs, validation_shard
from pairweave.plans.training import epoch_order, resume_plan, training_plan
from pairweave.session import cut_lineage
from pairweave.sources import bitext, manifest, shards as shard_store, tables

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

SHARD = [*cells.CELL, "shard_idx"]


def query(run: Query | None = None, *, key: str | None = None):
    """Register a query under its function name, or under ``key`` where an operator already has that name."""
    if run is None:
        return lambda f: query(f, key=key)
    REGISTRY[key or run.__name__] = run
    return run


def _rounded(column: str):
    return (F.round(column, 6) + 0.0).alias(column)


# --- sources and sinks


@query
def bitext_scan(spark, sf_dir):
    folders = [fx.scratch(spark, "scan") for _ in range(2)]
    nested = fx.nested_pairs(fx.line_pairs(spark, sf_dir))
    for part, folder in enumerate(folders):
        nested.filter(F.length("pair_id") % 2 == part).write.parquet(folder)
    return bitext.flatten_pairs(bitext.validate_bitext(bitext.read_bitext(spark, folders, f"pair_id string, {bitext.RAW_SCHEMA}"), "drop"))


@query
def raw_bitext(spark, sf_dir):
    """Files that hold nothing but ``translation``, in three parts of uneven size."""
    folder = fx.scratch(spark, "raw")
    nested = fx.nested_pairs(fx.line_pairs(spark, sf_dir))
    part = F.length("pair_id") % 3
    nested.select("translation", part.alias("part")).write.partitionBy("part").parquet(folder)
    paths = [f"{folder}/part={i}" for i in sorted(r.part for r in nested.select(part.alias("part")).distinct().collect())]
    named = bitext.with_pair_id(bitext.read_readable(spark, paths)[0])
    return named.select("pair_id", "translation.en", "translation.zh")


@query
def bitext_rejects(spark, sf_dir):
    return bitext.count_rejects(fx.nested_pairs(fx.line_pairs(spark, sf_dir)))


@query
def corrupt_files(spark, sf_dir):
    """Four files, of which three have lost bytes at the head, in the middle, or at the tail."""
    folder = fx.scratch(spark, "broken")
    part = F.length("pair_id") % 4
    fx.write_file_per_part(fx.nested_pairs(fx.line_pairs(spark, sf_dir)).select("translation", part.alias("part")), folder)
    fx.break_file(spark, f"{folder}/part=1", [(0.0, 40, 1.0, 0)])
    fx.break_file(spark, f"{folder}/part=2", [(0.0, 0, 0.4, 0), (0.4, 40, 1.0, 0)])
    fx.break_file(spark, f"{folder}/part=3", [(0.0, 0, 1.0, -6)])
    report = bitext.file_report(spark, folder)
    return report.select(F.regexp_extract("path", "part=([0-9])", 1).alias("part"), "status", "stated", F.when(F.col("status") == "complete", F.col("read")).alias("read"))


@query
def readable_pairs(spark, sf_dir):
    """The pairs of the files that are complete, next to one that is cut in the middle."""
    folder = fx.scratch(spark, "broken")
    part = F.length("pair_id") % 2
    fx.write_file_per_part(fx.nested_pairs(fx.line_pairs(spark, sf_dir)).select("translation", part.alias("part")), folder)
    fx.break_file(spark, f"{folder}/part=1", [(0.0, 0, 0.5, 0), (0.5, 40, 1.0, 0)])
    pairs, left_out = bitext.read_readable(spark, folder)
    return bitext.with_pair_id(pairs).select("pair_id", "translation.en", "translation.zh", F.lit(left_out).alias("left_out"))


@query
def zip_by_position(spark, sf_dir):
    """The two exported corpora read back in step, line by line."""
    folder = fx.scratch(spark, "corpus")
    bitext.write_corpus(fx.bitext(spark, sf_dir), folder)
    return bitext.read_corpus(spark, folder)


@query
def corpus_lines(spark, sf_dir):
    return bitext.corpus_lines(fx.bitext(spark, sf_dir))


@query
def corpus_export(spark, sf_dir):
    folder = fx.scratch(spark, "corpus")
    bitext.write_corpus(fx.bitext(spark, sf_dir), folder)
    return spark.read.text(folder).groupBy("side").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.char_length("value")).alias("chars")
    )


@query
def corpus_union(spark, sf_dir):
    splits = {"train": fx.bitext(spark, sf_dir), "valid": fx.line_pairs(spark, sf_dir)}
    return bitext.corpus_union(splits, ["train", "valid"])


@query
def shard_roundtrip(spark, sf_dir):
    folder = fx.scratch(spark, "shards")
    shard_store.write_shards(fx.bucket_plan(spark, sf_dir).sharded, folder)
    return shard_store.read_shards(spark, folder).select("pair_id", "src_len", "tgt_len", *SHARD, "num_shards")


@query
def shard_read(spark, sf_dir):
    folder = fx.scratch(spark, "shards")
    plan = fx.bucket_plan(spark, sf_dir)
    shard_store.write_shards(plan.sharded, folder)
    first = manifest.shard_at(sharding.curriculum_order(plan.shards), 0).first()
    rows = shard_store.read_shard(
        spark, folder, (first.src_start, first.src_end), (first.tgt_start, first.tgt_end), first.shard_idx
    )
    return rows.select("pair_id", "src_len", "tgt_len", *SHARD)


@query
def shard_rows(spark, sf_dir):
    """The first, middle and last row of every shard, by their places."""
    folder, index = fx.scratch(spark, "shards"), fx.scratch(spark, "index")
    plan = fx.bucket_plan(spark, sf_dir)
    shard_store.write_shards(plan.sharded, folder)
    shard_store.index_shards(spark, folder, index, fx.MAX_SAMPLES)
    n = F.col("num_samples")
    places = F.array_distinct(F.array(F.lit(0), F.floor(n / 2), n - 1).cast("array<bigint>"))
    wanted = plan.shards.select("src_start", "tgt_start", "shard_idx", F.explode(places).alias("row"))
    return shard_store.read_rows(spark, folder, index, wanted, fx.MAX_SAMPLES).select("pair_id", *SHARD, "row")


@query(key="validation_shard")
def single_shard(spark, sf_dir):
    folder = fx.scratch(spark, "valid")
    tokens = stored_pairs(shift_targets(filter_max_length(fx.encoded_pairs(spark, sf_dir))))
    shard_store.write_shards(validation_shard(tokens), folder)
    return shard_store.read_shard(spark, folder, (0, 128), (0, 128)).select("pair_id", "src_len", "tgt_len", *SHARD)


@query
def bucket_manifest(spark, sf_dir):
    return sharding.shard_manifest(fx.bucket_plan(spark, sf_dir).sharded)


@query
def manifest_roundtrip(spark, sf_dir):
    folder = fx.scratch(spark, "store")
    build_buckets(spark, folder, fx.length_pairs(spark, sf_dir), fx.NUM_CUTS, fx.MIN_SAMPLES, fx.MAX_SAMPLES)
    shards, _ = build_buckets(spark, folder)
    return shards


@query
def batch_size_saved(spark, sf_dir):
    folder = fx.scratch(spark, "store")
    build_buckets(spark, folder, fx.length_pairs(spark, sf_dir), fx.NUM_CUTS, fx.MIN_SAMPLES, fx.MAX_SAMPLES)
    save_batch_sizes(spark, folder, lambda s, t: sharding.batch_size_for(s, t, fx.TOKEN_BUDGET))
    return build_buckets(spark, folder)[0].select(*SHARD, "suggested_batch_size", "num_samples")


@query
def vocab_roundtrip(spark, sf_dir):
    folder = fx.scratch(spark, "vocab")
    tables.write_vocab(fx.bpe_model(spark, sf_dir), folder)
    return tables.read_vocab(spark, folder).vocab


@query
def metrics_log(spark, sf_dir):
    folder = fx.scratch(spark, "metrics")
    keys = {"split": F.when(F.col("batch_id") % 5 == 4, "valid").otherwise("train"), "bucket": (F.col("batch_id") % 4).cast("int")}
    for epoch in range(2):  # the later model is surer of what it says
        surer = F.transform("logits", lambda x: x.cast("double") * (1 + epoch))
        tokens = fx.token_logits(spark, sf_dir).withColumn("logits", surer).withColumns(keys)
        losses = epoch_loss(smoothed_loss(tokens).withColumns(keys), by=list(keys))
        guesses = tokens.select(*keys, F.array(argmax_index(F.col("logits"))).alias("preds"), F.array("label").alias("labels"))
        both = losses.join(token_accuracy(guesses, by=list(keys)), list(keys))
        tables.append_metrics(both.select(F.lit(epoch).alias("epoch"), "bucket", "split", "loss", F.col("accuracy").alias("acc")), folder)
    return tables.read_metrics(spark, folder).select("epoch", "bucket", "split", _rounded("loss"), _rounded("acc"))


@query
def comparison_report(spark, sf_dir):
    scored = fx.hypotheses(spark, sf_dir)
    left, right = scored.select("pair_id", "src_text", "ref_text"), scored.select("pair_id", "hyp_text")
    return tables.report_lines(tables.zip_pairs(left, right))


# --- text


@query
def normalized_text(spark, sf_dir):
    return fx.documents(spark, sf_dir).select("doc_id", normalize_text(F.col("text")).alias("normalized"))


@query(key="pretokenize")
def pretokenize_text(spark, sf_dir):
    pieces = pretokenize(normalize_text(F.col("text")))
    return fx.documents(spark, sf_dir).select("doc_id", F.array_join(pieces, " ").alias("pieces"))


@query
def unit_split(spark, sf_dir):
    units = byte_units(normalize_text(F.col("text")))
    return fx.documents(spark, sf_dir).select("doc_id", F.array_join(units, "|").alias("units"))


@query
def word_counts(spark, sf_dir):
    return piece_counts(fx.documents(spark, sf_dir), "text")


@query
def byte_unit_counts(spark, sf_dir):
    return unit_counts(fx.documents(spark, sf_dir), "text")


@query
def word_vocab(spark, sf_dir):
    return word_vocabulary(piece_counts(fx.documents(spark, sf_dir), "text"), fx.WORD_VOCABULARY)


@query(key="pair_counts")
def pair_frequency(spark, sf_dir):
    counts = pair_counts(unit_counts(fx.documents(spark, sf_dir), "text"))
    return counts.select(F.substring("pair", 1, 1).alias("left"), F.substring("pair", 2, 1).alias("right"), "cnt")


@query
def bpe_merges(spark, sf_dir):
    return fx.bpe_model(spark, sf_dir).merges


@query
def bpe_first_merges(spark, sf_dir):
    return fx.bpe_model(spark, sf_dir).merges.filter("rank < 8")


@query(key="bpe_encode")
def bpe_encode_turns(spark, sf_dir):
    encoded = bpe_encode(fx.turns(spark, sf_dir), fx.bpe_model(spark, sf_dir), {"ids": "text"})
    return encoded.select("pair_id", joined(F.col("ids")).alias("ids"))


@query(key="decode_ids")
def decode_text(spark, sf_dir):
    model = fx.bpe_model(spark, sf_dir)
    encoded = bpe_encode(fx.documents(spark, sf_dir), model, {"ids": "text"})
    return decode_ids(encoded, model.vocab, "ids", "decoded").select("doc_id", "decoded")


@query
def encode_words(spark, sf_dir):
    return fx.encoded_documents(spark, sf_dir).select("doc_id", joined(F.col("ids")).alias("ids"))


@query
def special_tokens(spark, sf_dir):
    encoded = fx.encoded_pairs(spark, sf_dir)
    return encoded.select(
        "pair_id",
        joined(F.col("src_ids")).alias("single"),
        joined(add_specials(_inner("src_ids"), _inner("tgt_ids"))).alias("pair"),
    )


def _inner(ids: str):
    return F.slice(ids, F.lit(2), F.size(ids) - 2)


@query(key="vocab_check")
def vocab_compatible(spark, sf_dir):
    return vocab_check(fx.word_vocab(spark, sf_dir), fx.bpe_model(spark, sf_dir).vocab)


@query(key="segment_runs")
def segment_text(spark, sf_dir):
    # With the count in it the test runs once per distinct piece; Spark would move it in front of the counting, to every piece of every text.
    of_letters = F.when(F.col("cnt") > 0, F.col("word").rlike(r"^[\p{L}\p{M}]+$"))
    words = piece_counts(fx.documents(spark, sf_dir), "text").filter(of_letters)
    unspaced = F.regexp_replace(normalize_text(F.col("text")), " ", "")
    runs = fx.turns(spark, sf_dir).select("pair_id", unspaced.alias("text"))
    return segment_runs(runs, "text", words, "segmented", r"[\p{L}\p{M}]+").select("pair_id", "segmented")


# --- filters and shaping of encoded pairs


@query
def length_filter(spark, sf_dir):
    kept = filter_max_length(fx.encoded_pairs(spark, sf_dir), 64)
    return kept.select("pair_id", F.size("src_ids").alias("src_n"), F.size("tgt_ids").alias("tgt_n"))


@query
def eval_discards(spark, sf_dir):
    whole = fx.encoded_documents(spark, sf_dir).select(add_specials(F.col("ids")).alias("src_ids"))
    flagged = split_by_source_length(whole, "src_ids", 256)
    return flagged.agg(
        F.count(F.lit(1)).alias("total"), F.count_if("kept").alias("valid"), F.count_if(~F.col("kept")).alias("discarded")
    )


@query
def shifted_pairs(spark, sf_dir):
    shifted = shift_targets(filter_max_length(fx.encoded_pairs(spark, sf_dir)))
    return shifted.select("pair_id", *[joined(F.col(c)).alias(c) for c in ("src", "tgt", "label")])


@query
def narrow_pairs(spark, sf_dir):
    return fx.encoded_documents(spark, sf_dir).select("doc_id", joined(narrow_ids(F.col("ids"))).alias("ids"))


@query(key="cut_at_eos")
def cut_sequences(spark, sf_dir):
    twice = F.concat("tgt_ids", "src_ids")
    return fx.encoded_pairs(spark, sf_dir).select("pair_id", joined(cut_at_eos(twice)).alias("ids"))


@query
def padded_batches(spark, sf_dir):
    shifted = cut_lineage(shift_targets(filter_max_length(fx.encoded_pairs(spark, sf_dir))))
    sized = shifted.withColumns({"src_len": F.size("src"), "tgt_len": F.size("tgt")})
    grid = cells.build_grid(sized, 4)
    placed = padded(cells.assign_cell(sized, grid.src, grid.tgt))
    return placed.select("pair_id", *cells.CELL, *[joined(F.col(c)).alias(c) for c in ("src", "tgt", "label")])


@query
def batch_assign_global(spark, sf_dir):
    return assign_batches_global(fx.line_pairs(spark, sf_dir).select("pair_id"), 512)


@query
def dynamic_pad(spark, sf_dir):
    wide = dynamic_width(assign_batches_global(cut_lineage(fx.encoded_documents(spark, sf_dir)), 128, "doc_id"), "ids")
    return wide.select("doc_id", "batch_id", "width", joined(pad_to(F.col("ids"), F.col("width"))).alias("ids"))


@query
def stacked_batches(spark, sf_dir):
    wide = dynamic_width(assign_batches_global(cut_lineage(fx.encoded_documents(spark, sf_dir)), 128, "doc_id"), "ids")
    flat = wide.withColumn("src", joined(pad_to(F.col("ids"), F.col("width"))))
    return stack_batches(flat, ["src"]).select("batch_id", F.array_join("src", ";").alias("src"))


@query
def loss_accounting(spark, sf_dir):
    pairs = fx.line_pairs(spark, sf_dir)
    encoded = cut_lineage(fx.encoded_pairs(spark, sf_dir))
    kept = shift_targets(filter_max_length(encoded, 64))
    sized = kept.select("pair_id", F.size("src").alias("src_len"), F.size("tgt").alias("tgt_len"))
    grid = cells.build_grid(sized, 4)
    totals = cells.grid_totals(grid, 4, 100, 1000)
    return loss_report(bitext.count_rejects(fx.nested_pairs(pairs)), encoded, totals, 64)


# --- the length grid


@query
def length_histogram(spark, sf_dir):
    pairs = fx.length_pairs(spark, sf_dir)
    sides = [lengths.length_histogram(pairs, f"{s}_len").select(F.lit(s).alias("side"), "len", "cnt") for s in ("src", "tgt")]
    return sides[0].unionByName(sides[1])


@query
def optimal_cuts(spark, sf_dir):
    pairs = lengths.pair_histogram(fx.length_pairs(spark, sf_dir))
    return lengths.optimal_cuts(lengths.side_histograms(pairs), fx.NUM_CUTS, by=["side"])


@query
def small_cuts(spark, sf_dir):
    gapped = fx.table(spark, sf_dir, "lineitem").select((F.col("l_linenumber") * F.col("l_linenumber")).alias("len"))
    return lengths.small_cuts(lengths.length_histogram(gapped, "len"))


def _grid(spark, sf_dir):
    pairs = fx.length_pairs(spark, sf_dir)
    grid = cells.build_grid(pairs, fx.NUM_CUTS)
    return pairs, grid, (fx.MIN_SAMPLES, fx.MAX_SAMPLES)


@query
def bucket_assign(spark, sf_dir):
    pairs, grid, (least, _) = _grid(spark, sf_dir)
    placed = cells.assign_cell(pairs, grid.src, grid.tgt)
    kept = cells.keep_valid(placed, cells.valid_cells(grid, least))
    return kept.select("pair_id", "src_bucket", "tgt_bucket", *cells.CELL)


@query
def cell_grid(spark, sf_dir):
    _, grid, _ = _grid(spark, sf_dir)
    return cells.cell_grid(spark, grid.src, grid.tgt, cells.count_cells(grid.placed, "cnt"))


@query
def valid_cells(spark, sf_dir):
    _, grid, (least, _) = _grid(spark, sf_dir)
    return cells.valid_cells(grid, least)


@query
def discarded_pairs(spark, sf_dir):
    pairs, grid, (least, _) = _grid(spark, sf_dir)
    placed = cells.assign_cell(pairs, grid.src, grid.tgt)
    return cells.discarded(placed, cells.valid_cells(grid, least)).select("pair_id", "src_len", "tgt_len")


@query
def padding_totals(spark, sf_dir):
    pairs, grid, (least, _) = _grid(spark, sf_dir)
    placed = cells.assign_cell(pairs, grid.src, grid.tgt)
    return cells.padding_totals(cells.keep_valid(placed, cells.valid_cells(grid, least)))


@query
def bucket_totals(spark, sf_dir):
    _, grid, (least, most) = _grid(spark, sf_dir)
    return cells.grid_totals(grid, fx.NUM_CUTS, least, most)


# --- shards


@query
def shard_assign(spark, sf_dir):
    sharded = fx.bucket_plan(spark, sf_dir).sharded
    return sharded.select("pair_id", *SHARD, "num_shards", "cell_rank")


@query
def batch_assign(spark, sf_dir):
    sharded = fx.bucket_plan(spark, sf_dir).sharded
    batches = assign_batches(sharded, 64, fx.MAX_SAMPLES)
    return batches.select("pair_id", *SHARD, "batch_id", "batch_pos")


def _sized_shards(spark, sf_dir):
    grid = cells.build_grid(fx.length_pairs(spark, sf_dir), fx.NUM_CUTS)
    shards = sharding.manifest_from_counts(cells.valid_cells(grid, fx.MIN_SAMPLES), fx.MAX_SAMPLES)
    sized = sharding.spread_batch_size(shards, lambda s, t: sharding.batch_size_for(s, t, fx.TOKEN_BUDGET))
    return cut_lineage(sized), cells.grid_totals(grid, fx.NUM_CUTS, fx.MIN_SAMPLES, fx.MAX_SAMPLES)


@query
def batch_size_plan(spark, sf_dir):
    return _sized_shards(spark, sf_dir)[0].select(*SHARD, "suggested_batch_size", "num_samples")


@query
def probed_batch_size(spark, sf_dir):
    """Sizes found by trying, saved in the manifest."""
    folder = fx.scratch(spark, "store")
    build_buckets(spark, folder, fx.length_pairs(spark, sf_dir), fx.NUM_CUTS, fx.MIN_SAMPLES, fx.MAX_SAMPLES)
    save_batch_sizes(spark, folder, probe=_budget_probe())
    return build_buckets(spark, folder)[0].select(*SHARD, "suggested_batch_size", "num_samples")


def _budget_probe():
    def bears(src_end: int, tgt_end: int, size: int) -> bool:
        if size > 9_000:
            raise MemoryError
        return size * (src_end + tgt_end) + src_end * tgt_end <= 50_000

    return bears


@query
def plan_complete(spark, sf_dir):
    shards, _ = _sized_shards(spark, sf_dir)
    done = sharding.plan_complete(shards).withColumn("plan", F.lit("sized"))
    return done.unionByName(sharding.plan_complete(sharding.reset_batch_size(shards)).withColumn("plan", F.lit("reset")))


@query
def epoch_iterations(spark, sf_dir):
    shards, _ = _sized_shards(spark, sf_dir)
    kept = sharding.epoch_iterations(shards, 0.75).withColumn("drop_last", F.lit(False))
    return kept.unionByName(sharding.epoch_iterations(shards, 0.75, True).withColumn("drop_last", F.lit(True)))


@query
def bucket_stats(spark, sf_dir):
    stats = sharding.bucket_stats(*_sized_shards(spark, sf_dir))
    return stats.select(
        "src_range", "tgt_range", "num_samples", "shard", "suggested_batch_size", _rounded("discard_pct"), _rounded("padding_pct")
    )


@query
def curriculum_order(spark, sf_dir):
    ordered = sharding.curriculum_order(_sized_shards(spark, sf_dir)[0])
    return ordered.select(*SHARD, "num_samples", "position")


# --- training plan


@query
def seeded_shuffle(spark, sf_dir):
    return shuffle_rank(fx.length_pairs(spark, sf_dir).select("pair_id"), "pair_id").select("pair_id", "shuffle_rank")


@query
def epoch_plan(spark, sf_dir):
    ordered = epoch_order(_sized_shards(spark, sf_dir)[0], fx.EPOCHS)
    return ordered.select("epoch", "position", *SHARD, "iterations", "steps_before")


@query
def step_schedule(spark, sf_dir):
    plan = training_plan(_sized_shards(spark, sf_dir)[0], fx.EPOCHS)
    exact = F.round(F.col("lr") * 1_000_000, 4).alias("lr_e6")
    return plan.select("epoch", "position", *SHARD, "batch", "step", exact, _rounded("teacher_ratio"))


@query(key="resume_plan")
def resume_point(spark, sf_dir):
    left = resume_plan(training_plan(_sized_shards(spark, sf_dir)[0], fx.EPOCHS), 1, 5)
    return left.groupBy("epoch").agg(
        F.count(F.lit(1)).alias("steps"), F.min("step").alias("first_step"), F.max("step").alias("last_step")
    )


@query
def cosine_schedule(spark, sf_dir):
    shards, _ = _sized_shards(spark, sf_dir)
    steps = sharding.epoch_iterations(shards).withColumn("step", F.explode(F.sequence(F.lit(0).cast("bigint"), 2 * F.col("iterations"))))
    return steps.select("step", cosine_anneal(F.col("step"), F.col("iterations"), 1.0, 0.5).alias("value")).select("step", _rounded("value"))


# --- predictions and scores


@query(key="token_accuracy")
def masked_accuracy(spark, sf_dir):
    return token_accuracy(fx.predictions(spark, sf_dir)).select("correct", "valid", _rounded("accuracy"))


@query
def token_accuracy_by_bucket(spark, sf_dir):
    bucket = F.floor(F.size("labels") / 16).cast("int").alias("bucket")
    rows = fx.predictions(spark, sf_dir).select(bucket, "preds", "labels")
    return token_accuracy(rows, by=["bucket"]).select("bucket", "correct", "valid", _rounded("accuracy"))


@query(key="smoothed_loss")
def batch_loss(spark, sf_dir):
    return smoothed_loss(fx.token_logits(spark, sf_dir)).select("batch_id", "n_rows", _rounded("loss"))


@query(key="epoch_loss")
def mean_epoch_loss(spark, sf_dir):
    return epoch_loss(smoothed_loss(fx.token_logits(spark, sf_dir))).select(_rounded("loss"))


@query
def argmax_tokens(spark, sf_dir):
    return fx.table(spark, sf_dir, "embeddings").select("vec_id", argmax_index(F.col("embedding")).alias("token"))


@query(key="beam_step")
def beam_select(spark, sf_dir):
    return beam_step(fx.candidates(spark, sf_dir), 4).select(
        "item_id", "new_beam", "from_beam", "token", _rounded("new_score"), "new_finished", "new_len"
    )


@query
def beam_first_step(spark, sf_dir):
    return beam_step(fx.candidates(spark, sf_dir), 2, alpha=0.0, first_step=True).select(
        "item_id", "new_beam", "from_beam", "token", _rounded("new_score"), "new_len"
    )


@query(key="beam_decode")
def beam_search(spark, sf_dir):
    """Every document continued from its last token by the tokens that follow it most often in all documents."""
    table = F.broadcast(fx.next_token_table(spark, sf_dir))  # 16 rows per token of the vocabulary at most
    last = F.coalesce(F.try_element_at("ids", F.lit(-1)), F.lit(BOS))
    items = fx.encoded_documents(spark, sf_dir).select(F.col("doc_id").alias("item_id"), last.alias("start"))
    follow = lambda beams: beams.join(table, F.element_at("tokens", -1) == F.col("prev"))
    found = beam_decode(items, follow, max_length=6)
    return found.select(F.col("item_id").alias("doc_id"), joined(F.col("tokens")).alias("tokens"), _rounded("final_score"))


@query(key="repetition_penalty")
def penalized_logits(spark, sf_dir):
    inner = fx.encoded_documents(spark, sf_dir).filter(F.size("ids") > 0)
    token, history = F.element_at("ids", -1), F.slice("ids", F.lit(1), F.size("ids") - 1)
    logit = (token % 97 - 40) / F.lit(10.0)
    return inner.select("doc_id", token.alias("token"), repetition_penalty(logit, token, history).alias("logit")).select(
        "doc_id", "token", _rounded("logit")
    )


@query(key="nbest_pick")
def nbest_choice(spark, sf_dir):
    return nbest_pick(fx.candidates(spark, sf_dir)).select("item_id", "beam", "token", _rounded("final_score"))


@query(key="ngram_matches")
def sentence_matches(spark, sf_dir):
    tokens = fx.hypotheses(spark, sf_dir).select("pair_id", tokenize_zh(F.col("hyp_text")).alias("h"), tokenize_zh(F.col("ref_text")).alias("r"))
    return ngram_matches(tokens, "h", "r")


@query(key="corpus_bleu")
def bleu_score(spark, sf_dir):
    scored = corpus_bleu(fx.hypotheses(spark, sf_dir))
    sums = [c for c in scored.columns if c.startswith(("correct_", "total_")) or c.endswith("_len")]
    return scored.select(*sums, _rounded("bp"), _rounded("bleu"))


@query(key="corpus_bleu_multi")
def bleu_of_two_references(spark, sf_dir):
    """Two references: the answer, and the answer without every seventh word."""
    words = F.split("ref_text", " ")
    shorter = F.array_join(F.filter(words, lambda w, i: (i + 1) % 7 != 0), " ")
    scored = corpus_bleu_multi(fx.hypotheses(spark, sf_dir).withColumn("second", shorter), refs=["ref_text", "second"])
    sums = [c for c in scored.columns if c.startswith(("correct_", "total_")) or c.endswith("_len")]
    return scored.select(*sums, _rounded("bp"), _rounded("bleu"))


@query(key="eval_summary")
def evaluation_summary(spark, sf_dir):
    scored = fx.hypotheses(spark, sf_dir)
    flagged = scored.withColumn("kept", F.coalesce(F.size(tokenize_zh(F.col("src_text"))) <= 64, F.lit(False)))
    flagged = cut_lineage(flagged)
    return eval_summary(flagged, corpus_bleu(flagged.filter("kept"))).select("total", "valid", "discarded", _rounded("bleu"))


def _fifth_word_dropper():
    def translate(sources: list[str]) -> list[str]:
        return [" ".join(w for i, w in enumerate(s.split(" "), 1) if i % 5) for s in sources]

    return translate


@query(key="translate_batches")
def translated_batches(spark, sf_dir):
    return translate_batches(fx.documents(spark, sf_dir), _fifth_word_dropper, 512, "doc_id", "text")
