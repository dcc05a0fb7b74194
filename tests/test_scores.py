import math
import random

import pytest
from pyspark.sql import functions as F

from pairweave.functions import arrays
from pairweave.functions.schedule import cosine_anneal, teacher_ratio
from pairweave.operators.cells import CELL
from pairweave.operators.metrics import epoch_loss, smoothed_loss, token_accuracy
from pairweave.operators.decoding import beam_decode
from pairweave.operators.scoring import corpus_bleu, corpus_bleu_multi, gram_counts, ngram_matches, split_by_source_length, tokenize_zh
from pairweave.operators.selection import beam_step, nbest_pick, repetition_penalty
from pairweave.operators.sharding import manifest_from_counts, spread_batch_size
from pairweave.plans.preprocess import filter_max_length, padded, shift_targets, stored_pairs
from pairweave.plans.training import epoch_order, resume_plan, training_plan


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first().v


def ints(*values):
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<int>")


def test_array_expressions(spark):
    assert one(spark, arrays.add_specials(ints(7, 8))) == [1, 7, 8, 2]
    assert one(spark, arrays.add_specials(ints(7), ints(9))) == [1, 7, 2, 1, 9, 2]
    assert one(spark, arrays.decoder_input(ints(1, 5, 2))) == [1, 5]
    assert one(spark, arrays.decoder_label(ints(1, 5, 2))) == [5, 2]
    assert one(spark, arrays.decoder_label(ints())) == []
    assert one(spark, arrays.cut_at_eos(ints(1, 4, 2, 7, 2))) == [1, 4, 2]
    assert one(spark, arrays.cut_at_eos(ints(2, 4))) == [2]
    assert one(spark, arrays.cut_at_eos(ints(1, 4))) == [1, 4]
    assert one(spark, arrays.pad_to(ints(1, 2), 4)) == [1, 2, 0, 0]
    assert one(spark, arrays.pad_to(ints(1, 2, 3), 2)) == [1, 2]
    assert one(spark, arrays.without_padding(ints(0, 3, 0, 4))) == [3, 4]
    assert one(spark, arrays.argmax_index(ints(3, 9, 9))) == 1
    assert one(spark, arrays.widen_ids(arrays.narrow_ids(ints(32767)))) == [32767]
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        one(spark, arrays.narrow_ids(ints(32768)))


def test_length_filter_counts_markers_on_both_sides(spark):
    rows = [(n, [1] * a, [1] * b) for n, (a, b) in enumerate([(128, 128), (129, 5), (5, 129), (3, 3)])]
    frame = spark.createDataFrame(rows, "pair_id int, src_ids array<int>, tgt_ids array<int>")
    kept = filter_max_length(frame)
    assert sorted(r.pair_id for r in kept.collect()) == [0, 3]
    assert {r.pair_id: r.tgt_len for r in stored_pairs(shift_targets(kept)).collect()} == {0: 127, 3: 2}
    assert {r.pair_id: r.kept for r in split_by_source_length(frame).collect()} == {0: True, 1: False, 2: True, 3: True}


def test_padding_widths(spark):
    frame = spark.createDataFrame(
        [([1, 2], [1], [2], 2, 4, 1, 4)],
        "src array<int>, tgt array<int>, label array<int>, src_start int, src_end int, tgt_start int, tgt_end int",
    )
    assert padded(frame).first()[:3] == ([1, 2, 0], [1, 0, 0], [2, 0, 0])
    assert padded(frame, "exclusive_end").first()[:3] == ([1, 2, 0, 0], [1, 0, 0, 0], [2, 0, 0, 0])


def test_accuracy_ignores_padding(spark):
    schema = "preds array<int>, labels array<int>"
    got = token_accuracy(spark.createDataFrame([([5, 6, 0], [5, 7, 0]), ([0, 0], [0, 0])], schema)).first()
    assert (got.correct, got.valid, got.accuracy) == (1, 2, 0.5)
    assert token_accuracy(spark.createDataFrame([([0], [0])], schema)).first().accuracy == 0.0
    assert token_accuracy(spark.createDataFrame([], schema)).first().accuracy == 0.0


def test_smoothed_loss_by_hand(spark):
    logits = [[1.0, 2.0, 0.5], [0.0, 0.0, 3.0], [9.0, 1.0, 1.0]]
    rows = [(0, 0, logits[0], 1), (0, 0, logits[1], 2), (0, 1, logits[2], 0)]
    frame = spark.createDataFrame(rows, "batch_id int, row_id int, logits array<double>, label int")

    def loss(z, y):
        lse = math.log(sum(map(math.exp, z)))
        return 0.97 * (lse - z[y]) + 0.03 * sum(lse - x for x in z) / 3

    got = smoothed_loss(frame).first()
    assert got.n_rows == 2
    assert got.loss == pytest.approx((loss(logits[0], 1) + loss(logits[1], 2)) / 2)
    batches = spark.createDataFrame([(1.0, 3), (2.0, 1)], "loss double, n_rows bigint")
    assert epoch_loss(batches).first().loss == 1.25


def pairs(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "pair_id int, hyp_text string, ref_text string")


def test_bleu_extremes(spark):
    same = [("the cat sat on the mat", "the cat sat on the mat")]
    assert corpus_bleu(pairs(spark, same)).first().bleu == pytest.approx(100.0)
    assert corpus_bleu(pairs(spark, [("x y z w", "a b c d")])).first().bleu == 0.0
    assert corpus_bleu(pairs(spark, [("", "a b c d")])).first().bleu == 0.0
    # Three tokens have no 4-gram: the score is 0.
    assert corpus_bleu(pairs(spark, [("a b c", "a b c")])).first().bleu == 0.0


def test_bleu_floor_and_brevity_by_hand(spark):
    got = corpus_bleu(pairs(spark, [("a b c x", "a b c d e")])).first()
    precisions = [3 / 4, 2 / 3, 1 / 2, 0.1 / 1]
    want = math.exp(1 - 5 / 4) * 100 * math.prod(precisions) ** 0.25
    assert got.bleu == pytest.approx(want) and got.bp == pytest.approx(math.exp(-0.25))


def test_matches_are_clipped_and_summed_over_pairs(spark):
    frame = pairs(spark, [("the the the", "the cat"), ("a b", "a b")]).select(
        "pair_id", F.split("hyp_text", " ").alias("h"), F.split("ref_text", " ").alias("r")
    )
    rows = {r.pair_id: r for r in ngram_matches(frame, "h", "r").collect()}
    assert (rows[0].correct_1, rows[0].total_1, rows[0].correct_2, rows[0].total_2, rows[0].hyp_len) == (1, 3, 0, 2, 3)
    assert (rows[1].correct_1, rows[1].correct_2, rows[1].total_3) == (2, 1, 0)


def test_only_sums_are_shuffled(spark):
    frame = pairs(spark, [("a b", "a b")])
    tokens = frame.select("pair_id", F.split("hyp_text", " ").alias("h"), F.split("ref_text", " ").alias("r"))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert plan(ngram_matches(tokens, "h", "r")).count("Exchange") == 0
    assert plan(corpus_bleu(frame)).count("Exchange") == 1


def test_a_missing_side_has_no_tokens(spark):
    tokens = spark.createDataFrame([(1, None, ["a"]), (2, ["a"], None)], "pair_id int, h array<string>, r array<string>")
    assert {r.pair_id: (r.correct_1, r.total_1, r.hyp_len, r.ref_len) for r in ngram_matches(tokens, "h", "r").collect()} == {1: (0, 0, 0, 1), 2: (0, 1, 1, 0)}


def test_metrics_by_key_ragged_rows_and_empty_batches(spark):
    rows = [("a", [5], [5, 7]), ("a", [5, 6], [5, 6]), ("b", [9], [0])]
    got = {r.k: (r.correct, r.valid, r.accuracy) for r in token_accuracy(spark.createDataFrame(rows, "k string, preds array<int>, labels array<int>"), by=["k"]).collect()}
    assert got == {"a": (3, 4, 0.75), "b": (0, 0, 0.0)}
    batches = spark.createDataFrame([("a", None, 5), ("a", 2.0, 5), ("b", None, 1)], "k string, loss double, n_rows bigint")
    assert {r.k: r.loss for r in epoch_loss(batches, by=["k"]).collect()} == {"a": 2.0, "b": None}
    assert epoch_loss(batches).first().loss == 2.0


def test_nothing_to_train_on_gives_no_steps(spark):
    shards = spark.createDataFrame([(1, 2, 1, 2, 0, 1, 20, 0), (3, 4, 1, 2, 0, 1, 20, 50)], ", ".join(f"{c} int" for c in CELL) + ", shard_idx int, num_shards int, suggested_batch_size int, num_samples int")
    assert training_plan(shards, epochs=0).count() == 0
    assert {r.src_start for r in training_plan(shards, epochs=2).collect()} == {3}


def test_chinese_tokens(spark):
    frame = spark.createDataFrame([("我爱Python3.14，真的！ It's 5-3.",)], "t string")
    assert frame.select(tokenize_zh(F.col("t")).alias("t")).first().t == [
        "我", "爱", "Python3.14", "，", "真", "的", "！", "It's", "5", "-", "3."
    ]  # a full stop after a digit at the very end is not taken off


CANDIDATES = "item_id int, beam int, token int, score double, logp double, len int, finished boolean"


def test_beam_step_scales_by_length_and_carries_the_raw_score(spark):
    rows = [
        (1, 0, 10, -1.0, -1.0, 1, False), (1, 0, 11, -1.0, -3.0, 1, False), (1, 1, 12, -1.5, -1.0, 5, False),
        (1, 2, 2, -1.9, -7.0, 4, True), (1, 2, 13, -1.9, -0.1, 4, True),
    ]
    got = beam_step(spark.createDataFrame(rows, CANDIDATES), 3).collect()
    # The finished beam may only end, at no cost: -1.9 / 5^0.6. Beam 1: -2.5 / 6^0.6. Beam 0: -2 / 2^0.6.
    assert [(r.new_beam, r.from_beam, r.token, r.new_score, r.new_finished, r.new_len) for r in sorted(got, key=lambda r: r.new_beam)] == [
        (0, 2, 2, -1.9, True, 4), (1, 1, 12, -2.5, False, 6), (2, 0, 10, -2.0, False, 2)
    ]


def test_first_step_uses_beam_zero_alone(spark):
    rows = [(1, b, t, 0.0, -float(t), 1, False) for b in range(3) for t in (4, 5, 6)]
    got = beam_step(spark.createDataFrame(rows, CANDIDATES), 3, first_step=True).collect()
    assert {(r.from_beam, r.token) for r in got} == {(0, 4), (0, 5), (0, 6)}


def test_hot_items_are_cut_before_the_shuffle(spark):
    rows = [(1, 0, t, 0.0, -float(t), 1, False) for t in range(100)]
    plan = beam_step(spark.createDataFrame(rows, CANDIDATES), 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")


def test_repetition_penalty_ignores_the_sign(spark):
    assert one(spark, repetition_penalty(F.lit(2.0), F.lit(7), ints(7, 3, 7), 2.0)) == 0.5
    assert one(spark, repetition_penalty(F.lit(-2.0), F.lit(7), ints(7), 2.0)) == -1.0
    assert one(spark, repetition_penalty(F.lit(2.0), F.lit(9), ints(), 2.0)) == 2.0


def test_nbest_pick(spark):
    rows = [(1, 0, 5, -2.0, 0.0, 2, True), (1, 1, 6, -3.0, 0.0, 9, True), (2, 1, 8, -1.0, 0.0, 1, True), (2, 0, 9, -1.0, 0.0, 1, True)]
    frame = spark.createDataFrame(rows, CANDIDATES)
    assert {(r.item_id, r.beam) for r in nbest_pick(frame).collect()} == {(1, 1), (2, 0)}
    assert {(r.item_id, r.beam) for r in nbest_pick(frame, 0.0).collect()} == {(1, 0), (2, 0)}


def plain_search(start, follow, max_length, beam_size, alpha, penalty, eos=2):
    """A beam search of one item in plain Python; ``follow`` maps a token to logits by token."""
    beams = [((start,), 0.0, 1, False)]
    for _ in range(max_length):
        options = []
        for place, (tokens, score, size, done) in enumerate(beams):
            if done:
                options.append((score / (size + 1) ** alpha, place, eos, score, tokens, size, True))
                continue
            logits = {t: z / penalty ** tokens[1:].count(t) for t, z in follow.get(tokens[-1], {}).items()}
            if logits:
                top = max(logits.values())
                total = math.log(sum(math.exp(z - top) for z in logits.values()))
            for t, z in logits.items():
                new = score + round(z - top - total, 9)
                options.append((new / (size + 1) ** alpha, place, t, new, tokens, size, False))
        best = sorted(options, key=lambda o: (-o[0], o[1], o[2]))[:beam_size]
        if not best:
            return [start], 0.0
        beams = [((*tokens, t), score, size + (t != eos and not done), done or t == eos) for _, _, t, score, tokens, size, done in best]
        if all(b[3] for b in beams):
            break
    tokens, score, size, _ = max(beams, key=lambda b: (b[1] / b[2] ** alpha, -beams.index(b)))
    return list(tokens[: tokens.index(eos) + 1] if eos in tokens else tokens), score / size**alpha


@pytest.mark.parametrize("beam_size, alpha, penalty, max_length", [(4, 0.6, 1.1, 7), (1, 0.0, 1.0, 5), (8, 0.95, 1.05, 4)])
def test_beam_search_against_plain_python(spark, beam_size, alpha, penalty, max_length):
    rng = random.Random(beam_size)
    follow = {p: {t: round(rng.uniform(-2, 3), 6) for t in rng.sample(range(2, 14), rng.randint(1, 9))} for p in [1, *range(3, 14)]}
    del follow[13]  # a token that nothing follows
    table = spark.createDataFrame([(p, t, z) for p, row in follow.items() for t, z in row.items()], "prev int, next int, logit double")
    items = spark.createDataFrame([(i, [1, 3, 4, 5, 6, 7, 8, 9, 10, 13][i]) for i in range(10)], "item_id bigint, start int")
    join = lambda beams: beams.join(table, F.element_at("tokens", -1) == F.col("prev")).withColumnRenamed("next", "token")
    found = {r.item_id: (r.tokens, r.final_score) for r in beam_decode(items, join, max_length, beam_size, alpha, penalty).collect()}
    assert len(found) == 10
    for r in items.collect():
        tokens, score = plain_search(r.start, follow, max_length, beam_size, alpha, penalty)
        assert found[r.item_id][0] == tokens, (r.item_id, found[r.item_id], score)
        assert found[r.item_id][1] == pytest.approx(score)
    assert beam_decode(items.filter("false"), join, 3).count() == 0


def test_several_references_by_hand(spark):
    """Matches are clipped by the reference that has most, and the closest length counts, the shorter of two as close."""
    assert gram_counts("a a b c".split(), ["a b".split(), "a a x".split()], 2) == [3, 2, 4, 3, 4, 3]
    assert gram_counts("a b c".split(), ["a b".split(), "a b c d".split()], 1)[-1] == 2
    assert gram_counts("a".split(), [], 1) == [0, 1, 1, 0]
    rows = [(1, "a b c d e", "a b c d", "b c d e"), (2, "x y z w", None, "x y z w"), (3, None, "q", "r")]
    df = spark.createDataFrame(rows, "pair_id int, hyp_text string, ref_text string, other string")
    both = corpus_bleu_multi(df, refs=["ref_text", "other"]).first()
    assert (both.correct_1, both.correct_4, both.total_4, both.hyp_len, both.ref_len) == (9, 3, 3, 9, 9)
    assert both.bleu == pytest.approx(100.0)
    single, same = corpus_bleu(df, ref="other").first(), corpus_bleu_multi(df, refs=["other"]).first()
    assert single == same


def test_schedules(spark):
    assert one(spark, cosine_anneal(F.lit(0), F.lit(10), 1.0, 0.5)) == 1.0
    assert one(spark, cosine_anneal(F.lit(10), F.lit(10), 1.0, 0.5)) == pytest.approx(0.5)
    ratio = lambda e, s: one(spark, teacher_ratio(F.lit(e), F.lit(s), F.lit(10)))
    assert ratio(0, 7) == ratio(3, 2) == 1.0
    assert ratio(1, 0) == 1.0 and ratio(1, 5) == pytest.approx(0.75)
    # Epochs 1 and 2 took twenty annealed steps, so epoch 4 starts at the top again.
    assert ratio(2, 0) == pytest.approx(0.5) and ratio(4, 0) == pytest.approx(1.0)


@pytest.fixture(scope="module")
def sized(spark):
    counts = spark.createDataFrame([(i, i + 2, 2 * i, 2 * i + 3, 60 + 37 * i) for i in range(1, 9)], "src_start int, src_end int, tgt_start int, tgt_end int, n bigint")
    return spread_batch_size(manifest_from_counts(counts, 100), lambda s, t: F.lit(20)).persist()


def test_each_epoch_visits_every_shard_in_its_own_order(spark, sized):
    shards = sized.count()
    rows = epoch_order(sized, 4).collect()
    orders = []
    for epoch in range(4):
        mine = sorted((r for r in rows if r.epoch == epoch), key=lambda r: r.position)
        assert [r.position for r in mine] == list(range(shards))
        steps = 0
        for r in mine:
            assert r.steps_before == steps
            steps += r.iterations
        orders.append([(r.tgt_start, r.src_start, r.shard_idx) for r in mine])
    assert orders[0] == sorted(orders[0]) and len({tuple(o) for o in orders}) == 4


def test_plan_steps_are_dense_and_resumable(spark, sized):
    plan = training_plan(sized, 3).persist()
    steps = sorted(r.step for r in plan.collect())
    assert steps == list(range(len(steps))) and len(steps) % 3 == 0
    shards = sized.count()
    left = resume_plan(plan, 1, 2)
    assert left.filter("epoch = 0").count() == 0 and left.filter("epoch = 1").agg(F.min("position")).first()[0] == 2
    assert resume_plan(plan, 0, shards).agg(F.min("step")).first()[0] == len(steps) // 3
    assert resume_plan(plan, 2, shards).count() == 0


def test_candidates_of_a_beam_step_are_not_shuffled(spark, monkeypatch):
    from pairweave.operators import decoding

    plans, rewrite = [], decoding.rewrite
    monkeypatch.setattr(decoding, "rewrite", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or rewrite(df, name))
    table = F.broadcast(spark.createDataFrame([(1, 5, 0.1), (1, 6, 0.2), (5, 6, 0.1), (5, 2, 0.3), (6, 2, 0.5)], "prev int, token int, logit double"))
    items = spark.range(10).select(F.col("id").alias("item_id"), F.lit(1).alias("start"))
    found = decoding.beam_decode(items, lambda b: b.join(table, F.element_at("tokens", -1) == F.col("prev")), 3)
    assert found.count() == 10
    assert all("Exchange hashpartitioning" not in p[: p.index("BroadcastHashJoin")] for p in plans[1:])
