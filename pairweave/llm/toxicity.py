"""Toxicity: cumulative-link ordinal regression of severity grades on sparse word features.

``P(grade > k) = sigmoid(w . x - theta_k)`` with one weight vector for all thresholds and ``theta`` increasing; the score
is the expected grade. A feature is a word or a word beginning (4 or 6 characters, so that inflected and compound forms
share it) at one of three levels: present; twice or more and in 0.4 % of the words; three times or more and in 1 %. Words
are lower case with ASCII punctuation as blanks. Features are those whose document frequency differs between toxic and
other labelled documents.

The labels are binary, so the grades of training documents come from the data: 0 for a document labelled not toxic;
1 to 3 for toxic ones, by thirds of how many *markers* they hold (features whose odds are at least
``e**3`` times as high in toxic documents). A toxic label without any marker is the lowest grade: such labels are partly noise.

The model is fitted on at most ``max_labelled`` labelled documents (10,000; the ones with the least hash of the id) and
holds at most ``max_features`` words. Those two parameters bound everything that reaches the driver or is broadcast; the
sample's texts stay on the executors. Every document is scored, from its whole text, without a shuffle.

Defined cases: null and empty texts have no feature, and so the lowest score. Null labels and labels of unknown
documents are not used; of several labels of one document the most toxic counts, and of rows that share an id each is a
training row. Without any usable label no document is rejected and the expected grade is 0. Scoring keeps the other
columns of the documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Container, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairweave.llm.words import plain, window_hashes, words_of
from pairweave.session import remove, rewrite

GRADES = 4
SCORES = "doc_id bigint, expected_severity double, p_toxic double, severity int, rejected boolean"


STEMS = (4, 6)
#: Least count and least share of the words, by level.
LEVELS = ((1, 0.0), (2, 0.004), (3, 0.01))


def feature_counts(text: str | None, wanted: Container[str] | None = None) -> tuple[Counter[str], int]:
    """How often each word, and each beginning (marked by ``*``), occurs; and the number of words. Only ``wanted`` ones."""
    words = plain(text).decode().split()
    counts: Counter[str] = Counter()
    for word, n in Counter(words).items():
        if wanted is None or word in wanted:
            counts[word] += n
        for size in STEMS:
            if len(word) >= size:
                stem = word[:size] + "*"
                if wanted is None or stem in wanted:
                    counts[stem] += n
    return counts, len(words)


def active(counts: Counter[str], n_words: int) -> list[tuple[str, int]]:
    """The features of a text: ``(word or beginning, level)``."""
    return [(f, level) for f, n in counts.items() for level, (least, share) in enumerate(LEVELS) if n >= least and n >= share * n_words]


@dataclass
class SeverityModel:
    """Weights by feature, the words and beginnings in them, and the thresholds between grades."""

    weights: dict[tuple[str, int], float]
    thresholds: list[float]

    def __post_init__(self):
        self.wanted = {f for f, _ in self.weights}

    def probabilities(self, text: str | None) -> list[float]:
        """``P(grade > k)`` for each threshold."""
        score = sum(self.weights.get(f, 0.0) for f in active(*feature_counts(text, self.wanted))) if self.wanted else 0.0
        return [1 / (1 + math.exp(min(500.0, max(-500.0, t - score)))) for t in self.thresholds]


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, n_features: int, ridge: float = 0.1, steps: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds that maximise the penalised likelihood, by Adam over the whole sample.

    ``rows`` holds the features present in each document. Thresholds are a first value plus exponentials, so they stay ordered.
    """
    cols = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    above = np.array([(grades > k).mean() for k in range(GRADES - 1)]).clip(1e-4, 1 - 1e-4)
    theta = np.maximum.accumulate(np.log((1 - above) / above) + 1e-2 * np.arange(GRADES - 1))
    params = np.concatenate([np.zeros(n_features), theta[:1], np.log(np.maximum(np.diff(theta), 1e-2))])
    first, second = np.zeros_like(params), np.zeros_like(params)
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
    at = np.arange(len(rows))
    for step in range(1, steps + 1):
        w, theta = params[:n_features], np.cumsum(np.concatenate([params[n_features : n_features + 1], np.exp(params[n_features + 1 :])]))
        score = np.bincount(owner, w[cols], len(rows))
        upper = np.concatenate([np.ones((len(rows), 1)), sigmoid(score[:, None] - theta), np.zeros((len(rows), 1))], 1)
        slope = upper * (1 - upper)
        mass = np.maximum(upper[at, grades] - upper[at, grades + 1], 1e-12)
        by_score = (slope[at, grades] - slope[at, grades + 1]) / mass
        by_theta = np.zeros(GRADES - 1)
        for k in range(GRADES - 1):
            by_theta[k] = (slope[grades == k, k + 1] / mass[grades == k]).sum() - (slope[grades == k + 1, k + 1] / mass[grades == k + 1]).sum()
        gradient = np.zeros_like(params)
        gradient[:n_features] = np.bincount(cols, by_score[owner], n_features) - ridge * w
        tails = np.cumsum(by_theta[::-1])[::-1]
        gradient[n_features] = tails[0]
        gradient[n_features + 1 :] = tails[1:] * np.exp(params[n_features + 1 :])
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        params = params + 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return params[:n_features], np.cumsum(np.concatenate([params[n_features : n_features + 1], np.exp(params[n_features + 1 :])]))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(text, toxic)`` to ``(feature, level, n_toxic, n_other)``, summed over a few hundred texts at a time."""
    for batch in batches:
        texts, toxic = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for low in range(0, len(texts), 200):
            counts = (Counter(), Counter())
            for text, label in zip(texts[low : low + 200], toxic[low : low + 200]):
                counts[label].update(active(*feature_counts(text)))
            keys = list(counts[0].keys() | counts[1].keys())
            columns = {"feature": pa.array([f for f, _ in keys], pa.string()), "level": pa.array([k for _, k in keys], pa.int32())}
            columns |= {n: pa.array([counts[k][f] for f in keys], pa.int64()) for n, k in (("n_toxic", 1), ("n_other", 0))}
            yield pa.RecordBatch.from_pydict(columns)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the least hash of a text's five-word runs, which near copies mostly share; of the text itself if it is shorter."""
    for batch in batches:
        columns = dict(zip(batch.schema.names, batch.columns))
        sketches = []
        for text in columns["text"].to_pylist():
            hashes = words_of([plain(text)]).hashes()
            grams = window_hashes(hashes, min(5, max(1, len(hashes))))
            sketches.append(grams.min().astype(np.int64) if len(grams) else 0)
        yield pa.RecordBatch.from_pydict({"sketch": pa.array(sketches, pa.int64()), **{c: columns[c] for c in ("doc_id", "text", "toxic")}})


def fit_severity(docs: DataFrame, labels: DataFrame, max_labelled: int = 10_000, max_features: int = 4_096, min_z: float = 3.0, min_share: float = 0.01) -> SeverityModel:
    """Fit on the documents ``(doc_id, text)`` that ``labels`` (``doc_id, toxic``) covers.

    A feature is in at least ``min_share`` as many labelled documents as there are toxic ones.
    """
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    labelled = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # Copies share a label: one text for each sketch, or the words of a copied document would look like evidence.
    sketched = labelled.mapInArrow(_sketches, "sketch bigint, doc_id bigint, text string, toxic int")
    sample, path = rewrite(sketched.groupBy("sketch").agg(F.min(F.struct("doc_id", "text", "toxic")).alias("r")).select("r.text", "r.toxic"), "labelled")
    counted = sample.mapInArrow(_frequencies, "feature string, level int, n_toxic bigint, n_other bigint")
    counted = counted.groupBy("feature", "level").agg(F.sum("n_toxic").alias("a"), F.sum("n_other").alias("b"))
    size = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_other = size.get(1, 0), size.get(0, 0)
    if not n_toxic or not n_other:
        remove(docs.sparkSession, path)
        return SeverityModel({}, [500.0 + k for k in range(GRADES - 1)])
    odds = lambda c, n: F.log((F.col(c) + 0.5) / (F.lit(n + 0.5) - F.col(c)))
    ratio = odds("a", n_toxic) - odds("b", n_other)
    z = ratio / F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    support = max(3, int(min_share * n_toxic))
    best = counted.filter(F.col("a") + F.col("b") >= support).select("feature", "level", ratio.alias("ratio"), z.alias("z")).filter(F.abs("z") >= min_z)
    features = best.orderBy(F.abs("z").desc(), "feature", "level").limit(max_features).collect()
    index = {(r.feature, r.level): i for i, r in enumerate(features)}
    wanted = {f for f, _ in index}
    markers = {(r.feature, r.level) for r in features if r.ratio >= 3}

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[f for f in active(*feature_counts(t, wanted)) if f in index] for t in batch.column(0).to_pylist()]
            rows = [sorted(index[f] for f in fs) for fs in found]
            held = [sum(f in markers for f in fs) for fs in found]
            yield pa.RecordBatch.from_pydict({"toxic": batch.column(1), "features": pa.array(rows, pa.list_(pa.int32())), "held": pa.array(held, pa.int32())})

    rows = sample.mapInArrow(present, "toxic int, features array<int>, held int").collect()
    remove(docs.sparkSession, path)
    rows.sort(key=lambda r: (r.toxic, r.held, r.features))  # the fit does not depend on the order of the tasks
    toxic, held = np.array([r.toxic for r in rows]), np.array([r.held for r in rows])
    cuts = np.quantile(held[toxic == 1], [1 / 3, 2 / 3])
    grades = np.where(toxic == 1, 1 + (held > cuts[0]).astype(int) + (held > cuts[1]), 0)
    weights, thresholds = fit_ordinal([np.array(r.features, np.int64) for r in rows], grades, len(index))
    return SeverityModel({f: float(weights[i]) for f, i in index.items()}, [float(t) for t in thresholds])


def score_severity(docs: DataFrame, model: SeverityModel, reject_above: float = 0.5) -> DataFrame:
    """``(doc_id, expected_severity, p_toxic, severity, rejected)`` per row; rejected where ``P(grade > 0)`` exceeds the bound."""
    state = (model.weights, model.thresholds)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = SeverityModel(*state)
        for batch in batches:
            above = [fitted.probabilities(t) for t in batch.column(1).to_pylist()]
            columns = {
                "doc_id": batch.column(0),
                "expected_severity": pa.array([sum(p) for p in above], pa.float64()),
                "p_toxic": pa.array([p[0] for p in above], pa.float64()),
                "severity": pa.array([sum(x > 0.5 for x in p) for p in above], pa.int32()),
                "rejected": pa.array([p[0] > reject_above for p in above], pa.bool_()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return docs.select("doc_id", "text").mapInArrow(score, SCORES)


def drop_toxic(docs: DataFrame, model: SeverityModel, reject_above: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the model does not reject, with all their columns; decided where the row lies."""
    state = (model.weights, model.thresholds)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = SeverityModel(*state)
        for batch in batches:
            keep = [fitted.probabilities(t)[0] <= reject_above for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)
