"""Toxicity and the language model: held-out accuracy, brute force, and normalisation."""

import math
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hard_words import thue_morse
from pyspark.sql import functions as F

from pairweave.llm import language_model as lm, toxicity as tox
from pairweave.llm.words import words_of

DATA = "/root/testdata/sf0.01"


# --- toxicity


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")


def test_held_out_accuracy(labelled):
    """Trained on two thirds of the labels, judged on the rest (labels are partly noise)."""
    docs, labels = labelled
    part = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    model = tox.fit_severity(docs, labels.filter(~part))
    scored = {r.doc_id: r for r in tox.score_severity(docs, model).collect()}
    test = labels.filter(part).collect()
    toxic = [scored[r.doc_id].rejected for r in test if r.toxic]
    clean = [scored[r.doc_id].rejected for r in test if not r.toxic]
    assert np.mean(toxic) > 0.6 and np.mean(clean) < 0.08
    severe = lambda flag: np.mean([scored[r.doc_id].expected_severity for r in test if bool(r.toxic) == flag])
    assert severe(True) > severe(False) + 1


def plain_features(text):
    """``(word or beginning, level)`` of a text and how often each word or beginning occurs."""
    words = "".join(" " if c in string.punctuation else c for c in (text or "").lower()).split()
    counts = Counter(words)
    for word, n in Counter(words).items():
        for size in (4, 6):
            if len(word) >= size:
                counts[word[:size] + "*"] += n
    limits = ((1, 0.0), (2, 0.004), (3, 0.01))
    return {(f, k) for f, n in counts.items() for k, (least, share) in enumerate(limits) if n >= least and n >= share * len(words)}


def plain_severities(docs, labels):
    """Scores of all documents by a model fitted in dense matrices on the same sample."""
    toxic = {}
    for doc, label in labels:
        if doc is not None and label is not None:
            toxic[doc] = max(toxic.get(doc, 0), int(label > 0))
    first = {}
    for doc, text in docs:
        if doc in toxic:
            hashes = words_of([tox.plain(text)]).hashes()
            grams = tox.window_hashes(hashes, min(5, max(1, len(hashes))))
            sketch = int(grams.min()) if len(grams) else 0
            first[sketch] = min(first.get(sketch, (doc, text)), (doc, text))
    sample = [(plain_features(t), toxic[d]) for d, t in first.values()]
    size = Counter(label for _, label in sample)
    held = [Counter(f for fs, label in sample if label == k for f in fs) for k in (0, 1)]
    chosen = []
    for f in held[0].keys() | held[1].keys():
        a, b = held[1][f], held[0][f]
        ratio = math.log((a + 0.5) / (size[1] + 0.5 - a)) - math.log((b + 0.5) / (size[0] + 0.5 - b))
        z = ratio / math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
        if a + b >= max(3, int(0.01 * size[1])) and abs(z) >= 3:
            chosen.append((-abs(z), *f, ratio))
    chosen.sort()
    features = [(f, k) for _, f, k, _ in chosen][:4096]
    markers = {(f, k) for _, f, k, ratio in chosen[:4096] if ratio >= 3}
    x = np.array([[f in fs for f in features] for fs, _ in sample], float)
    marks = np.array([len(fs & markers) for fs, _ in sample])
    y = np.array([label for _, label in sample])
    cuts = np.quantile(marks[y == 1], [1 / 3, 2 / 3])
    grades = np.where(y == 1, 1 + (marks > cuts[0]) + (marks > cuts[1]), 0)
    sigmoid = lambda v: 1 / (1 + np.exp(-np.clip(v, -40, 40)))
    above = np.clip([(grades > k).mean() for k in range(3)], 1e-4, 1 - 1e-4)
    theta = np.maximum.accumulate(np.log((1 - above) / above) + 1e-2 * np.arange(3))
    p = np.concatenate([np.zeros(len(features)), [theta[0]], np.log(np.maximum(np.diff(theta), 1e-2))])
    m, v, n = 0.0, 0.0, len(features)
    for step in range(1, 401):
        steps = np.exp(p[n + 1 :])
        theta = p[n] + np.concatenate([[0.0], np.cumsum(steps)])
        tails = sigmoid((x @ p[:n])[:, None] - theta)  # P(grade > k)
        wide = np.hstack([np.ones((len(y), 1)), tails, np.zeros((len(y), 1))])
        at = np.arange(len(y))
        mass = np.maximum(wide[at, grades] - wide[at, grades + 1], 1e-12)
        slope = wide * (1 - wide)
        to_score = (slope[at, grades] - slope[at, grades + 1]) / mass
        to_theta = np.array([((grades == k) * slope[:, k + 1] / mass).sum() - ((grades == k + 1) * slope[:, k + 1] / mass).sum() for k in range(3)])
        tail = to_theta[::-1].cumsum()[::-1]
        g = np.concatenate([x.T @ to_score - 0.1 * p[:n], [tail[0]], tail[1:] * steps])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        p = p + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    theta = p[n] + np.concatenate([[0.0], np.cumsum(np.exp(p[n + 1 :]))])
    weight = dict(zip(features, p[:n]))
    return {d: sum(sigmoid(sum(weight.get(f, 0.0) for f in plain_features(t)) - theta)) for d, t in docs}


def test_scores_of_a_plain_refit(labelled):
    docs, labels = labelled
    found = {r.doc_id: r.expected_severity for r in tox.score_severity(docs, tox.fit_severity(docs, labels)).collect()}
    wanted = plain_severities([(r.doc_id, r.text) for r in docs.collect()], [(r.doc_id, r.toxic) for r in labels.collect()])
    assert found.keys() == wanted.keys()
    assert [found[d] for d in wanted] == pytest.approx(list(wanted.values()), abs=1e-3)


def test_thresholds_are_ordered_and_shared():
    rng = np.random.default_rng(5)
    rows = [np.flatnonzero(rng.random(6) < 0.5) for _ in range(3000)]
    truth = np.array([3.0, 2.0, 1.0, 0.0, -1.0, -2.0])
    score = np.array([truth[r].sum() for r in rows]) + rng.logistic(size=3000)
    grades = np.digitize(score, [0.0, 2.0, 4.0])
    weights, thresholds = tox.fit_ordinal(rows, grades, 6)
    assert (np.diff(thresholds) > 0).all()
    assert weights == pytest.approx(truth, abs=0.35)
    assert thresholds == pytest.approx([0.0, 2.0, 4.0], abs=0.45)


def test_expected_severity_is_the_sum_of_the_tails(labelled):
    docs, labels = labelled
    model = tox.fit_severity(docs, labels)
    for r in tox.score_severity(docs, model).limit(50).collect():
        assert 0 <= r.expected_severity <= tox.GRADES - 1
        assert r.rejected == (r.p_toxic > 0.5)


def test_toxicity_of_odd_rows(spark, odd, empty, labelled):
    docs, labels = labelled
    model = tox.fit_severity(docs, labels.withColumn("toxic", F.when(F.col("doc_id") % 7 > 0, F.col("toxic"))))
    assert tox.score_severity(odd, model).count() == odd.count()
    kept = tox.drop_toxic(odd, model)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    for nothing in (labels.filter("false"), labels.filter("toxic = 0"), labels.withColumn("toxic", F.lit(None).cast("int"))):
        assert tox.score_severity(docs, tox.fit_severity(docs, nothing)).filter("rejected or expected_severity > 1e-9").count() == 0
    assert tox.score_severity(empty, tox.fit_severity(empty, labels)).count() == 0


# --- language model


def brute_scores(rows, order):
    tokens = [(t or "").encode().lower().split() + ["</s>"] for _, t in rows]
    train = [not (i is not None and zlib.crc32(str(i).encode()) % 5 == 1) for i, _ in rows]
    counts, histories = [Counter() for _ in range(order + 1)], [Counter() for _ in range(order + 1)]
    for x, used in zip(tokens, train):
        seq = ["<s>"] * (order - 1) + x
        for j in range(order - 1, len(seq) if used else 0):
            for n in range(1, order + 1):
                gram = tuple(seq[j - n + 1 : j + 1])
                counts[n][gram] += 1
                histories[n][gram[:-1]] += 1
    d = [None, *[lm.good_turing([sum(v == r for v in counts[n].values()) for r in range(1, 7)]) for n in range(1, order + 1)]]
    weigh = lambda n, c: c * (d[n][c] if c <= 5 else 1.0)
    total, types = sum(counts[1].values()), len(counts[1])
    unknown = 1 - sum(weigh(1, c) for c in counts[1].values()) / (total + lm.RESERVED)
    followers = [None, None, *[defaultdict(list) for _ in range(order - 1)]]
    for n in range(2, order + 1):
        for gram in counts[n]:
            followers[n][gram[:-1]].append(gram[-1])
    known = {}

    def p(n, h, w):
        if n == 1:
            return weigh(1, counts[1][w,]) / (total + lm.RESERVED) if counts[1][w,] else unknown
        h = h[-(n - 1) :]
        if not histories[n][h]:
            return p(n - 1, h[1:], w)
        if counts[n][*h, w]:
            return weigh(n, counts[n][*h, w]) / (histories[n][h] + lm.RESERVED)
        if h not in known:
            left = 1 - sum(weigh(n, counts[n][*h, v]) for v in followers[n][h]) / (histories[n][h] + lm.RESERVED)
            known[h] = left / (1 - sum(p(n - 1, h[1:], v) for v in followers[n][h]))
        return known[h] * p(n - 1, h[1:], w)

    out = []
    for x, used in zip(tokens, train):
        seq = ["<s>"] * (order - 1) + x
        score = sum(math.log10(p(order, tuple(seq[j - order + 1 : j]), seq[j])) for j in range(order - 1, len(seq)))
        base = sum(math.log10((counts[1][w,] + 0.5) / (total + 0.5 * (types + 1))) for w in x)
        out.append((not used, len(x), sum(counts[1][w,] > 0 for w in x), total, base, score))
    words = [w for (w,) in counts[1]]
    some = list(histories[order])[:20] + [("zz",) * (order - 1)]
    sums = [sum(p(order, h, w) for w in words) + p(order, h, "never seen") for h in some]
    return out, sums


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_and_normalisation(spark, docs, order):
    rows = [(r.doc_id, r.text) for r in docs.limit(60).collect()] + [(700, None), (701, ""), (None, "the the the"), (None, None), (702, "ÀB ab AB aB")]
    expected, sums = brute_scores(rows, order)
    assert sums == pytest.approx([1.0] * len(sums))
    found = lm.score_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), order).collect()
    got = sorted((f.held_out, f.n_tokens, f.n_known, f.train_tokens, f.base_score, f.score) for f in found)
    for a, b in zip(got, sorted(expected), strict=True):
        assert a == pytest.approx(b)


def test_long_words_are_told_apart(spark):
    one, other = thue_morse(11)
    ids = [i for i in range(50) if not lm.is_held_out(i)][:3]
    rows = list(zip(ids, (f"x {one}", f"x {one}", f"x {other}")))
    found = {r.doc_id: r.score for r in lm.score_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), 2).collect()}
    expected, _ = brute_scores(rows, 2)
    assert [found[i] for i in ids] == pytest.approx([e[-1] for e in expected])
    assert found[ids[0]] > found[ids[2]]


def test_model_of_odd_rows(odd, empty):
    found = lm.score_documents(odd).collect()
    assert len(found) == odd.count()
    assert all(math.isfinite(r.score) and r.score <= 0 for r in found)
    assert lm.score_documents(empty).count() == 0


def test_no_training_documents(spark):
    held = [i for i in range(200) if lm.is_held_out(i)][:5]
    found = lm.score_documents(spark.createDataFrame([(i, "a b c") for i in held], "doc_id bigint, text string")).collect()
    assert all((r.train_tokens, r.n_known, r.score, r.base_score) == (0, 0, 0.0, 0.0) for r in found)


def test_tables_are_stored(spark, docs, tmp_path):
    lm.score_documents(docs, order=2, path=str(tmp_path / "m")).count()
    stored = spark.read.parquet(str(tmp_path / "m/counts2")).filter("kind = 'counts'").collect()
    train = [(r.text or "").encode().lower().split() for r in docs.collect() if not lm.is_held_out(r.doc_id)]
    bigrams = Counter(g for x in train for g in zip(["<s>", *x], [*x, "</s>"]))
    counts = np.concatenate([lm.unpack_counts(r.counts) for r in stored])
    assert sorted(counts.tolist()) == sorted(bigrams.values())
    assert spark.read.parquet(str(tmp_path / "m/backoff2")).filter("kind = 'backoff'").count() > 0


def test_counts_beyond_32_bits_stay():
    key = np.array([5, 9], np.uint64)
    asks = [{"bucket": 0, "block": b, "keys": lm.pack_keys(key), "counts": lm.pack_counts(np.array([2**32 - 1, n]))} for b, n in ((1, 0), (2, 3))]
    out = lm.add_counts(pa.Table.from_pylist(asks)).to_pylist()
    answers = [lm.unpack_counts(r["counts"]).tolist() for r in out if r["kind"] == "answer"]
    assert answers == [[2**33 - 2, 3]] * 2
    assert [r["stats"][0] for r in out if r["kind"] == "counts"] == [2**33 + 1]
    for counts in ([], [0], [255, 256], [2**40, 1]):
        assert lm.unpack_counts(lm.pack_counts(np.array(counts, np.int64))).tolist() == counts


def test_discounts():
    assert (lm.good_turing([1000, 400, 200, 120, 80, 55]) <= 1).all()
    assert (lm.good_turing([0] * 6) > 0).all() and (lm.good_turing([3, 0, 0, 0, 0, 0]) > 0).all()
