"""Secret scans: known shapes, and sliding-window entropy over candidate strings with an allow-list.

Known shapes (``BASE``) are spans of their own. Candidates for the entropy scan are runs of 20 or more characters of the
base64, URL and name alphabet. A window of 20 characters slides over each; its Shannon entropy is
``log2 20 - S / 20`` with ``S`` the sum of ``c log2 c`` over the counts ``c`` of its characters, and a step changes only the
counts of the character that leaves and the one that enters. The candidate's character class (hexadecimal, upper case and
digits, or mixed) sets the entropy that some window must reach. A candidate that the allow-list matches as a whole, or all
of whose parts are words, numbers or examples, or that lies in a span of a known shape, is not reported; one random part is
enough to report a path or a name that holds it.

Everything is a built-in expression of one row: no Python on the executors and no shuffle.

Defined cases: null texts count as empty and have no spans; repeated rows give a row each; null ids are passed on; an
empty table gives no rows. Only the id and the text are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from pairweave.llm.spans import let, listed, spans_of, tagged

# The shapes as they are specified.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
BASE = ("assign", "access", "hex")

WINDOW = 20
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"
CANDIDATE = r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{20,}+"
#: Least entropy in bits of some window, by class; a random window of the class is above it nearly always.
CLASSES = {"hex": (r"^[0-9a-f]+$|^[0-9A-F]+$", 2.8), "upper": (r"^[A-Z0-9]+$", 3.2), "mixed": (r"", 3.5)}
#: Identifiers that are no secrets as a whole.
ALLOW = (r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",)
#: Other candidates are allowed only if each part between these is plain.
BETWEEN = r"[+/=_-]+"
#: A plain part: a number, a value meant as an example, letters with up to four digits; the letters may not change case as random ones do.
PLAIN = r"^[0-9]*$|(?i)example|sample|dummy|placeholder|changeme|your|xxxx"
LETTERS = r"^([A-Z]{1,16}|[A-Z]?[a-z][A-Za-z]*)[0-9]{0,4}$"
JAGGED = r"[a-z][A-Z][a-z][A-Z]|[a-z][A-Z][a-z]?[A-Z][a-z]?[A-Z]"


def window_entropy(value: Column) -> Column:
    """The highest entropy of any window of a candidate."""
    terms = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 1)])
    term = lambda c: F.element_at(terms, c + 1)
    place = lambda i: F.instr(F.lit(ALPHABET), F.substring(value, i, F.lit(1)))
    zeros = F.array_repeat(F.lit(0), len(ALPHABET))
    start = F.struct(zeros.alias("counts"), F.lit(0.0).alias("total"), F.lit(1e9).alias("least"))

    def step(state: Column, i: Column) -> Column:
        def moved(places: Column) -> Column:
            enters, leaves = places["enters"], places["leaves"]
            held = lambda p: F.element_at(state["counts"], p)
            counts = F.transform(
                state["counts"], lambda c, k: c + F.when(k + 1 == enters, 1).otherwise(0) - F.when(k + 1 == leaves, 1).otherwise(0)
            )
            gained = term(held(enters) + 1) - term(held(enters))
            lost = F.when(leaves > 0, term(held(F.greatest(leaves, F.lit(1))) - 1) - term(held(F.greatest(leaves, F.lit(1))))).otherwise(0.0)
            total = state["total"] + F.when(enters == leaves, 0.0).otherwise(gained + lost)
            return F.struct(
                counts.alias("counts"), total.alias("total"), F.when(i >= WINDOW, F.least(state["least"], total)).otherwise(state["least"]).alias("least")
            )

        leaving = F.when(i > WINDOW, place(i - WINDOW)).otherwise(0)
        return let(F.struct(place(i).alias("enters"), leaving.alias("leaves")), moved)

    steps = F.sequence(F.lit(1), F.length(value))
    return F.aggregate(steps, start, step, lambda s: math.log2(WINDOW) - s["least"] / WINDOW)


def is_secret(value: Column, allow: tuple[str, ...] = ALLOW) -> Column:
    """Whether a candidate's entropy is that of a secret of its class and nothing allows it."""
    like = lambda text, pattern: F.regexp_like(text, F.lit(pattern))
    plain = lambda part: like(part, PLAIN) | (like(part, LETTERS) & ~like(part, JAGGED))
    allowed = F.forall(F.split(value, BETWEEN), plain)
    for pattern in allow:
        allowed = allowed | like(value, pattern)
    least = F.when(F.regexp_like(value, F.lit(CLASSES["hex"][0])), CLASSES["hex"][1])
    least = least.when(F.regexp_like(value, F.lit(CLASSES["upper"][0])), CLASSES["upper"][1]).otherwise(CLASSES["mixed"][1])
    return F.when(allowed, False).otherwise(window_entropy(value) >= least)


def find_secrets(docs: DataFrame, allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """``(doc_id, assign, access, hex, entropy)``: arrays of spans per document, with their text; ``docs`` has ``doc_id, text``."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    text = F.col("text")
    base = rows.select(
        "doc_id",
        "text",
        F.filter(
            spans_of(text, ASSIGN, F.contains(text, F.lit(":")) | F.contains(text, F.lit("="))),
            lambda s: F.length(F.regexp_extract(s.value, ASSIGN, 1)) >= 6,
        ).alias("assign"),
        F.filter(spans_of(text, ACCESS, F.contains(text, F.lit("AKIA"))), lambda s: F.length(s.value) >= 20).alias("access"),
        spans_of(text, HEX).alias("hex"),
        spans_of(text, CANDIDATE).alias("candidates"),
    )
    inside = lambda s: F.exists(F.concat("assign", "access", "hex"), lambda b: (b.start <= s.start) & (s.end <= b.end))
    entropy = F.filter("candidates", lambda s: F.when(inside(s), False).otherwise(is_secret(s.value, allow)))
    return base.select("doc_id", *BASE, entropy.alias("entropy"))


def secret_digest(found: DataFrame) -> DataFrame:
    """Counts, the digest of the known shapes, and all spans as text."""
    base = F.concat(*[tagged(F.col(k), k, i) for i, k in enumerate(BASE)])
    return found.select(
        "doc_id",
        *[F.size(k).cast("bigint").alias(f"n_{k}") for k in BASE],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.concat(base, tagged(F.col("entropy"), "entropy", len(BASE)))).alias("spans"),
    )
