"""Personal data: labelers vote on candidate spans, expectation-maximisation weighs them, a classifier decides.

Candidates are the spans of the base shapes (also those whose check fails), and of further shapes (national phone numbers,
social security numbers, account numbers, spelled-out mail addresses). Five labelers vote yes, no or not at all on each:
*check* (the shape's own check), *gazetteer* (known top-level domains, card issuers, calling codes, reserved networks),
*context* (words before it that announce such data), *counter-context* (words that announce versions, orders, sizes) and
*edges* (whether it stands alone). Votes are counted by pattern, in the cluster. Expectation-maximisation over those counts
(at most kinds x 3^5 rows, a fixed bound) estimates how reliable each labeler is on each kind, without labels. The posteriors then
train a logistic classifier on span features, again over counts by feature pattern, and the classifier's log-odds are an
expression that every candidate is scored with.

The base spans that pass their check always stay; the classifier adds candidates beside them. Texts are read once; no
Python runs on the executors and only counts are shuffled.

Defined cases: null texts count as empty and have no spans; repeated rows give a row each; null ids are passed on; an
empty table gives no rows. With no candidate at all nothing is added. Only the id and the text are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, functions as F

from pairweave.llm.spans import let, listed, spans_of
from pairweave.session import rewrite

BASE = ("email", "ip", "card", "phone")
# The shapes as they are specified, with possessive runs so that long texts take linear time.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:(?![\x20-](?![0-9]))[0-9\x20-]){11,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Further shapes.
MORE = {
    "phone_local": r"(?<![0-9+(.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])",
    "email_spelled": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]++\x20?(?:[(\[]dot[)\]]|\.)\x20?[A-Za-z]{2,}",
}
KINDS = (*BASE, *MORE)
DOMAINS = r"(?i)[.\x20)\]](com|org|net|edu|gov|info|biz|io|de|fr|es|it|nl|uk|us|eu|ch|at|be|pl|jp|cn|in|br|ca|au)$"
ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|6011|65|35|30[0-5]|36|38)"
CALLING_CODES = r"^(1|7|20|27|3[0-469]|4[0-13-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|2[1-69][0-9]|3[578][0-9]|42[0-3]|5[09][0-9]|6[7-9][0-9]|8[058][0-9]|9[679][0-9])"
RESERVED = r"^(0+|10|127|22[4-9]|2[3-5][0-9])\.|^192\.168\.|^169\.254\."
ANNOUNCE = r"(?i)(mail|contact|write to|tel|phone|call|fax|mobile|card|visa|master|amex|payment|account|iban|ssn|social|address|\bip\b|host)[^\n]{0,15}$"
COUNTER = r"(?i)(version|\bv|release|order|isbn|issn|invoice|article|page|size|serial|part|sku|no\.|#|\$|€)[\x20:.#]*$"
LABELERS = ("check", "gazetteer", "context", "counter", "edges")


def luhn(digits: Column) -> Column:
    """Whether the Luhn sum of a digit string is a multiple of ten."""

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, -i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, digit).otherwise(digit * 2 - F.when(digit > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _check(kind: str) -> Callable[[Column], Column]:
    part = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    size = lambda v, low, high: F.length(_digits(v)).between(low, high)
    return {
        "ip": lambda v: F.regexp_like(v, F.lit(rf"^{part}(\.{part}){{3}}$")),
        "card": lambda v: F.when(size(v, 12, 19), luhn(_digits(v))).otherwise(False),
        "phone": lambda v: size(v, 9, 15),
        "phone_local": lambda v: ~F.regexp_like(_digits(v), F.lit("^([01]|(.)\\2{5})")),
        "ssn": lambda v: ~F.regexp_like(v, F.lit("^(000|666|9)|-00-|0000$")),
    }.get(kind, lambda v: F.lit(True))


def _gazetteer(kind: str) -> Callable[[Column], Column]:
    vote = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)
    like = lambda v, p: F.regexp_like(v, F.lit(p))
    return {
        "email": lambda v: vote(like(v, DOMAINS), F.lit(False)),
        "email_spelled": lambda v: vote(like(v, DOMAINS), F.lit(False)),
        "card": lambda v: vote(like(v, ISSUERS), ~like(v, ISSUERS)),
        "phone": lambda v: vote(like(_digits(v), CALLING_CODES), ~like(_digits(v), CALLING_CODES)),
        "ip": lambda v: vote(F.lit(False), like(v, RESERVED)),
    }.get(kind, lambda v: F.lit(0))


def _candidate(kind: str, order: int) -> Callable[[Column], Column]:
    """A span with its votes and features."""

    def build(s: Column) -> Column:
        passes = _check(kind)(s.value)
        alone = ~F.regexp_like(s.left, F.lit(r"[\p{L}\p{N}_]$")) & ~F.regexp_like(s.right, F.lit(r"^[\p{L}\p{N}_]"))
        return F.struct(
            s.start.alias("start"),
            F.lit(order).alias("order"),
            s.end.alias("end"),
            F.lit(kind).alias("kind"),
            (passes if kind in BASE else F.lit(False)).alias("base"),
            F.when(passes, 1).otherwise(-1).alias("check"),
            _gazetteer(kind)(s.value).alias("gazetteer"),
            F.when(F.regexp_like(s.left, F.lit(ANNOUNCE)), 1).otherwise(0).alias("context"),
            F.when(F.regexp_like(s.left, F.lit(COUNTER)), -1).otherwise(0).alias("counter"),
            F.when(alone, 1).otherwise(-1).alias("edges"),
            F.least(F.floor(F.length(s.value) / 4), F.lit(9)).cast("int").alias("size"),
            F.regexp_like(s.value, F.lit(r"[\x20().-]")).cast("int").alias("separated"),
            F.regexp_like(s.left, F.lit(r"\n\x20*$|^$")).cast("int").alias("line_start"),
        )

    return build


def candidate_spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, spans)``: every candidate of a document, in one pass over its text."""
    text = F.col("text")
    has = lambda c: F.contains(text, F.lit(c))
    shapes = {"email": (EMAIL, has("@")), "ip": (IP, has(".")), "card": (CARD, None), "phone": (PHONE, has("+"))}
    shapes |= {k: (p, None) for k, p in MORE.items()}
    shapes["email_spelled"] = (MORE["email_spelled"], F.regexp_like(text, F.lit(r"[(\[]at[)\]]")))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = rows.select("doc_id", *[spans_of(text, *shapes[k]).alias(f"_{k}") for k in KINDS])
    return found.select("doc_id", F.concat(*[F.transform(f"_{k}", _candidate(k, i)) for i, k in enumerate(KINDS)]).alias("spans"))


#: How many spans the labelers' reliabilities over all kinds weigh against those of one kind.
SHARED_WEIGHT = 50.0
Rates = dict[str, list[dict[int, tuple[float, float]]]]


def expectation_maximisation(patterns: list[Row], rounds: int = 60) -> tuple[dict[str, float], Rates]:
    """Share of true spans by kind, and by kind for each labeler ``P(vote | false), P(vote | true)`` by vote.

    ``patterns`` has ``kind``, the votes and ``n``. Starts from votes that are right three times in four; one pseudo-count
    per vote keeps unseen votes possible, and a kind with few spans leans on what is known of all.
    """
    prior = {r.kind: 0.5 for r in patterns}
    start = {-1: (0.5, 0.2), 0: (0.3, 0.3), 1: (0.2, 0.5)}
    rates: Rates = {kind: [start for _ in LABELERS] for kind in prior}
    for _ in range(rounds):
        posteriors = [posterior(r, prior, rates) for r in patterns]
        for kind in prior:
            rows = [(r.n, p) for r, p in zip(patterns, posteriors) if r.kind == kind]
            prior[kind] = min(0.99, max(0.01, (1 + sum(n * p for n, p in rows)) / (2 + sum(n for n, _ in rows))))
        for j, name in enumerate(LABELERS):
            sums = {kind: {v: [0.0, 0.0] for v in start} for kind in prior}
            for r, p in zip(patterns, posteriors):
                sums[r.kind][r[name]][0] += r.n * (1 - p)
                sums[r.kind][r[name]][1] += r.n * p
            every = {v: [1 + sum(of[v][k] for of in sums.values()) for k in (0, 1)] for v in start}
            shared = {v: [s[k] / sum(x[k] for x in every.values()) for k in (0, 1)] for v, s in every.items()}
            for kind, of in sums.items():
                total = [SHARED_WEIGHT + sum(x[k] for x in of.values()) for k in (0, 1)]
                rates[kind][j] = {v: tuple((x[k] + SHARED_WEIGHT * shared[v][k]) / total[k] for k in (0, 1)) for v, x in of.items()}
    return prior, rates


def posterior(pattern: Row, prior: dict[str, float], rates: Rates) -> float:
    """Probability that spans with these votes are personal data."""
    odds = math.log(prior[pattern.kind] / (1 - prior[pattern.kind]))
    for name, rate in zip(LABELERS, rates[pattern.kind]):
        no, yes = rate[pattern[name]]
        odds += math.log(yes / no)
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))


#: Features of the classifier: ``(column, value)`` indicators.
FEATURES = [("kind", k) for k in KINDS] + [(c, v) for c in LABELERS for v in (-1, 1)] + [("size", v) for v in range(10)] + [("separated", 1), ("line_start", 1)]


def train_classifier(rows: list[tuple[Row, float]], rounds: int = 300, ridge: float = 1.0) -> list[float]:
    """Weights of ``FEATURES`` and a constant, by gradient steps with momentum on soft labels; ``rows`` pairs patterns and posteriors."""
    active = [[i for i, (c, v) in enumerate(FEATURES) if r[c] == v] + [len(FEATURES)] for r, _ in rows]
    total = sum(r.n for r, _ in rows) or 1
    weights, speed = [0.0] * (len(FEATURES) + 1), [0.0] * (len(FEATURES) + 1)
    for _ in range(rounds):
        gradient = [-ridge * w / total for w in weights]
        for (r, target), on in zip(rows, active):
            error = (target - 1 / (1 + math.exp(-max(-500.0, min(500.0, sum(weights[i] for i in on)))))) * r.n / total
            for i in on:
                gradient[i] += error
        speed = [0.9 * s + 0.5 * g for s, g in zip(speed, gradient)]
        weights = [w + s for w, s in zip(weights, speed)]
    return weights


def find_personal_data(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """``(doc_id, spans)`` with ``spans`` an array of ``start, order, end, kind, base, probability``: what is personal data.

    ``docs`` has ``doc_id, text``. ``base`` marks spans of the base shapes that pass their check; the others reach ``least``.
    """
    candidates, _ = rewrite(candidate_spans(docs), "candidates")
    columns = ["kind", *LABELERS, "size", "separated", "line_start"]
    counted = candidates.select(F.explode("spans").alias("s")).groupBy(*[F.col(f"s.{c}").alias(c) for c in columns]).agg(F.count(F.lit(1)).alias("n"))
    patterns = counted.orderBy(*columns).collect()
    prior, rates = expectation_maximisation(patterns)
    weights = train_classifier([(r, posterior(r, prior, rates)) for r in patterns])

    def judged(s: Column) -> Column:
        odds = F.lit(weights[-1])
        for (column, value), weight in zip(FEATURES, weights):
            odds = odds + F.when(s[column] == value, weight).otherwise(0.0)
        fields = [s[c].alias(c) for c in ("start", "order", "end", "kind", "base")]
        return F.struct(*fields, (1 / (1 + F.exp(-odds))).alias("probability"))

    scored = F.transform("spans", judged)
    overlaps = lambda s, every: F.exists(every, lambda b: b.base & (b.start < s.end) & (s.start < b.end))
    chosen = let(scored, lambda every: F.filter(every, lambda s: s.base | ((s.probability >= least) & ~overlaps(s, every))))
    return candidates.select("doc_id", chosen.alias("spans"))


def personal_data_digest(found: DataFrame) -> DataFrame:
    """Counts, the digest of the base spans, and all spans as text."""
    base = F.filter("spans", lambda s: s.base)
    of = lambda kind: F.size(F.filter(base, lambda s: s.kind == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *[of(k).alias(f"n_{k}") for k in BASE],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
