"""The registered queries of the subpackage, one per operator, and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairweave.llm import secret_scan
from pairweave.llm.chat_format import Template, chat_digest, format_chats, table_turns
from pairweave.llm.decontamination import find_contamination
from pairweave.llm.exact_dedup import exact_dedup
from pairweave.llm.importance import resample
from pairweave.llm.jaccard_join import jaccard_join
from pairweave.llm.language_model import score_documents
from pairweave.llm.packing import pack
from pairweave.llm.pii import find_personal_data, personal_data_digest
from pairweave.llm.secret_scan import find_secrets, secret_digest
from pairweave.llm.structure_repair import repair_parts, repair_report
from pairweave.llm.substring_dedup import substring_dedup
from pairweave.llm.toxicity import fit_severity, score_severity
from pairweave.llm.warc import read_archives, write_archives
from pairweave.session import rewrite, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    """Register a query under its function name."""
    QUERIES[run.__name__] = run
    return run


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, text)`` of every document."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


@query
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the documents, by a hash of the id, is the published snapshot; the other half arrives as a batch."""
    docs = documents(spark, sf_dir)
    old = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    found = exact_dedup(docs.filter(old), docs.filter(~old))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLES["op5_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS original, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain FROM documents
), g AS (
  SELECT doc_id, sha256(plain) AS text_sha256,
    first_value(doc_id) OVER (PARTITION BY plain ORDER BY length(original) DESC, doc_id NULLS LAST) AS keep_id,
    count(*) OVER (PARTITION BY plain) AS group_size,
    row_number() OVER (PARTITION BY plain ORDER BY length(original) DESC, doc_id NULLS LAST) = 1 AS kept
  FROM t
)
SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM g
"""


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 16 length buckets and a batch of at most 8,192 padded tokens."""
    return pack(documents(spark, sf_dir), buckets=16, budget=8192)


ORACLES["op3_packing"] = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens FROM documents
), u AS (
  SELECT *, CAST(1 AS BIGINT) << greatest(0, length(bin(n_tokens)) - 10) AS unit FROM t
), c AS (
  SELECT *, greatest(1, ((n_tokens + unit - 1) // unit) * unit) AS cell FROM u
), h AS (
  SELECT cell, row_number() OVER (ORDER BY cell) AS i, CAST(sum(count(*)) OVER (ORDER BY cell) AS BIGINT) AS below FROM c GROUP BY cell
), p AS (
  SELECT 0 AS i, 0 AS below, 0 AS cell UNION ALL SELECT i, below, cell FROM h
), best(k, j, size, prev) AS (
  SELECT 1, i, cell * below, CAST(0 AS BIGINT) FROM h
  UNION ALL
  SELECT k + 1, j2, size2, prev2 FROM (
    SELECT b.k, h.i AS j2, min(b.size + h.cell * (h.below - p.below)) AS size2,
      arg_min(b.j, (b.size + h.cell * (h.below - p.below)) * 1000000 + b.j) AS prev2
    FROM best b JOIN p ON p.i = b.j JOIN h ON h.i > b.j WHERE b.k < 16 GROUP BY b.k, h.i
  )
), path(k, j) AS (
  SELECT (SELECT max(k) FROM best), (SELECT max(i) FROM h)
  UNION ALL
  SELECT path.k - 1, b.prev FROM path JOIN best b ON b.k = path.k AND b.j = path.j WHERE path.k > 1
), b AS (
  SELECT cell AS width, lag(cell, 1, 0) OVER (ORDER BY cell) AS low, row_number() OVER (ORDER BY cell) - 1 AS bucket
  FROM path JOIN h ON h.i = path.j
), r AS (
  SELECT c.doc_id, c.n_tokens, b.bucket, b.width, greatest(1, 8192 // b.width) AS per_batch,
    row_number() OVER (PARTITION BY b.bucket ORDER BY md5('0:' || coalesce(CAST(c.doc_id AS VARCHAR), '')), c.doc_id, c.n_tokens) - 1 AS place
  FROM c JOIN b ON c.cell > b.low AND c.cell <= b.width
)
SELECT doc_id, n_tokens, CAST(bucket AS INTEGER) AS bucket, width, place // per_batch AS batch, place % per_batch AS slot FROM r
"""


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item with at most a fifth of its words edited."""
    return find_contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The expected severity of every document, by a model of at most 10,000 labelled documents."""
    docs = documents(spark, sf_dir)
    return score_severity(docs, fit_severity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive, in segments of at most 32 KiB, and read back."""
    path = scratch_path(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op6_warc"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), g AS (
  SELECT page_id, html, sha1(html) AS hex, first_value(page_id) OVER w AS first_id, row_number() OVER w AS place
  FROM p WINDOW w AS (PARTITION BY html ORDER BY page_id NULLS LAST)
), d AS (
  SELECT *, list_transform(range(8), lambda i: CAST('0x' || substr(hex, i * 5 + 1, 5) AS INTEGER)) AS twenty FROM g
)
SELECT page_id, strlen(html) AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((twenty[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31), 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN place = 1 THEN NULL ELSE first_id END AS refers_to
FROM d
"""


@query
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return secret_digest(find_secrets(documents(spark, sf_dir)))


def _located(kind: str, order: int, pattern: str, kept: str = "true") -> str:
    """SQL for the spans of a pattern: offsets are the lengths of all pieces up to a match and of the matches before it."""
    quoted = "'" + pattern.replace("'", "''") + "'"
    return f"""
SELECT rid, {order} AS o, '{kind}' AS kind, s, s + len(value) AS e, value FROM (
  SELECT rid, m[i] AS value, CAST(list_sum(list_transform(p[:i], lambda x: len(x))) + coalesce(list_sum(list_transform(m[:i - 1], lambda x: len(x))), 0) AS BIGINT) AS s
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
    SELECT rid, regexp_extract_all(t, {quoted}) AS m, regexp_split_to_array(t, {quoted}) AS p FROM d))
) WHERE {kept.format(pattern=quoted)}"""


_PLAIN = f"regexp_matches(x, '{secret_scan.PLAIN}') OR regexp_matches(x, '{secret_scan.LETTERS}') AND NOT regexp_matches(x, '{secret_scan.JAGGED}')"
_ALLOWED = " OR ".join(f"regexp_matches(value, '{p}')" for p in secret_scan.ALLOW)
_ALLOWED += f" OR len(list_filter(regexp_split_to_array(value, '{secret_scan.BETWEEN}'), lambda x: NOT ({_PLAIN}))) = 0"
_LEAST = "CASE " + " ".join(f"WHEN regexp_matches(value, '{p}') THEN {h}" for p, h in secret_scan.CLASSES.values()) + " END"
ORACLES["op2_secrets"] = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
b AS MATERIALIZED ({_located("assign", 0, secret_scan.ASSIGN, "len(regexp_extract(value, {pattern}, 1)) >= 6")}
UNION ALL {_located("access", 1, secret_scan.ACCESS, "len(value) >= 20")}
UNION ALL {_located("hex", 2, secret_scan.HEX)}),
c AS MATERIALIZED (
  SELECT * FROM ({_located("entropy", 3, "[A-Za-z0-9+/=_-]{20,}")}) x
  WHERE NOT ({_ALLOWED}) AND NOT EXISTS (SELECT 1 FROM b WHERE b.rid = x.rid AND b.s <= x.s AND x.e <= b.e)
), h AS (
  SELECT rid, s, max(bits) AS bits FROM (
    SELECT rid, s, w, log2(20) - sum(n * log2(n)) / 20 AS bits FROM (
      SELECT rid, s, w, ch, count(*) AS n FROM (
        SELECT rid, s, w, unnest(string_split(substr(value, w, 20), '')) AS ch FROM (SELECT *, unnest(range(1, len(value) - 18)) AS w FROM c)
      ) GROUP BY ALL
    ) GROUP BY rid, s, w
  ) GROUP BY rid, s
), every AS (
  SELECT rid, o, kind, s, e FROM b UNION ALL
  SELECT c.rid, o, kind, c.s, e FROM c JOIN h ON h.rid = c.rid AND h.s = c.s WHERE bits >= {_LEAST}
), g AS (
  SELECT rid, count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access, count(*) FILTER (o = 2) AS n_hex,
    string_agg(concat_ws(':', kind, s, e), ',' ORDER BY s, o) FILTER (o < 3) AS base, string_agg(concat_ws(':', kind, s, e), ',' ORDER BY s, o) AS spans
  FROM every GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (rid)
"""


@query
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return personal_data_digest(find_personal_data(documents(spark, sf_dir)))


@query
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of near duplicates (five words, 0.8) and its number of links."""
    return jaccard_join(documents(spark, sf_dir)).select("doc_id", "class_id", "copy_id", "n_links", "n_texts", "n_grams")


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document when windows of 20 words that start earlier elsewhere are removed."""
    found = substring_dedup(documents(spark, sf_dir), window=20)
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


ORACLES["op1_substring_dedup"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words, row_number() OVER (ORDER BY doc_id NULLS LAST) AS place FROM documents
), w AS (
  SELECT place, i, hash(array_to_string(words[i : i + 19], ' ')) AS h, md5(array_to_string(words[i : i + 19], ' ')) AS m
  FROM (SELECT place, words, unnest(range(1, len(words) - 18)) AS i FROM d WHERE len(words) >= 20)
), r AS (
  SELECT place, i FROM (SELECT place, i, row_number() OVER (PARTITION BY h, m ORDER BY place, i) AS n FROM w) WHERE n > 1
), c AS (
  SELECT DISTINCT place, i + unnest(range(20)) AS i FROM r
), k AS (
  SELECT d.place, list(e.i ORDER BY e.i) AS keep FROM d, (SELECT place, unnest(range(1, len(words) + 1)) AS i FROM d) e
  WHERE d.place = e.place AND NOT EXISTS (SELECT 1 FROM c WHERE c.place = e.place AND c.i = e.i) GROUP BY d.place
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(len(keep), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(list_transform(keep, lambda i: words[i]), ' '), '')) AS kept_sha256
FROM d LEFT JOIN k USING (place)
"""


@query
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every document under a bigram model of four fifths of them."""
    return score_documents(documents(spark, sf_dir), order=2)


_TRICKY = r"\### Assistant: </turn> ok"


@query
def op11_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one that says the template's own markers, formatted, written, read back and parsed."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame([(-7, 0, "user", _TRICKY), (-7, 1, "assistant", _TRICKY)], turns.schema)
    written, _ = rewrite(format_chats(table_turns(turns.unionByName(tricky))), "formatted")
    return chat_digest(written)


def _escaped(text: str, *controls: str) -> str:
    """SQL for a backslash before each backslash and control string."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    for control in ("\\", *controls):
        text = f"replace({text}, {quoted(control)}, {quoted(chr(92) + control)})"
    return text


_T = Template()
_CONTROLS = (_T.begin, _T.end, *_T.others)
_MARKERS = len(_T.begin + _T.role_end + _T.end) + 1
ORACLES["op11_chat_formatting"] = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{_TRICKY}'), (-7, 1, 'assistant', '{_TRICKY}')
), o AS (
  SELECT *, {_MARKERS} + length({_escaped("role", *_CONTROLS, _T.role_end)}) + length({_escaped("text", *_CONTROLS)}) AS marked,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place, CASE WHEN role = '{_T.trained}' THEN text ELSE '' END AS trained
  FROM t
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(sum(length(trained)) AS BIGINT) AS loss_chars, sha256(string_agg(trained, '' ORDER BY place)) AS loss_sha256,
  CAST(sum(marked) AS BIGINT) AS formatted_chars
FROM o GROUP BY conv_id
"""


@query
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, drawn by how much their words look like those of the benchmark."""
    return resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text"))


ORACLES["op12_importance_resampling"] = r"""
WITH RECURSIVE r(k, l) AS (
  SELECT 0, range(256) UNION ALL
  SELECT k + 1, list_transform(l, lambda x: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) FROM r WHERE k < 8
), d AS MATERIALIZED (
  SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), b AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), u AS (
  SELECT rid, unnest(words) AS word FROM d
), v AS (
  SELECT word, sum(s) AS s, sum(t) AS t FROM (
    SELECT word, count(*) AS s, 0 AS t FROM u GROUP BY word UNION ALL SELECT word, 0, count(*) FROM (SELECT unnest(words) AS word FROM b) GROUP BY word
  ) GROUP BY word
), h AS MATERIALIZED (
  SELECT word, s, t, xor(list_reduce(
    list_prepend(4294967295, list_transform(range(0, strlen(word)), lambda i: CAST('0x' || substr(hex(encode(word)), 2 * i + 1, 2) AS BIGINT))),
    lambda a, x: xor(a >> 8, l[1 + xor(a, x) % 256])), 4294967295) % 10000 AS bucket
  FROM v, r WHERE k = 8
), g AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((sum(t) + 1) * (st + 10000) AS DOUBLE) / CAST((sum(s) + 1) * (tt + 10000) AS DOUBLE))) AS BIGINT) AS gain
  FROM h, (SELECT sum(s) AS st, sum(t) AS tt FROM h) GROUP BY bucket, st, tt
), w AS (
  SELECT rid, CAST(sum(gain) AS BIGINT) AS total FROM u JOIN h USING (word) JOIN g USING (bucket) GROUP BY rid
), z AS (
  SELECT doc_id, len(words) AS n_features, CAST(CASE WHEN len(words) = 0 THEN 0 ELSE floor(CAST(total AS DOUBLE) / len(words)) END AS BIGINT) AS weight,
    (CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5) / 4294967296 AS share
  FROM d LEFT JOIN w USING (rid)
), x AS (
  SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln(CAST(share AS DOUBLE)))) AS BIGINT) AS score, n_features >= 20 AS eligible FROM z
), n AS (
  SELECT *, row_number() OVER (PARTITION BY eligible ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place FROM x
)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
  CASE WHEN eligible AND place <= (SELECT count(*) FILTER (eligible) * 10 // 100 FROM x) THEN place END AS rank
FROM n
"""


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with one row in five damaged, by a checksum of its place; nulls of role and text are one blank."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(said("text"), "[.!?]", "")).otherwise(said("text"))
    role = F.when(kind == 4, "user").otherwise(said("role"))
    times = F.when(kind == 0, F.array().cast("array<int>")).when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("time")).drop("time")


@query
def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every damaged conversation repaired; one that lost all its rows has an empty audit."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    report = repair_report(*repair_parts(damaged(turns)))
    every = turns.select("conv_id").distinct().withColumnRenamed("conv_id", "id")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return every.join(report, F.col("id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("id").alias("conv_id"), *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


ORACLES["op13_structure_repair"] = r"""
WITH RECURSIVE crc(k, l) AS (
  SELECT 0, range(256) UNION ALL
  SELECT k + 1, list_transform(l, lambda x: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) FROM crc WHERE k < 8
), c AS (
  SELECT conv_id, coalesce(CAST(conv_id AS VARCHAR), 'null') AS key, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS place FROM conversations
), k AS (
  SELECT c.*, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(place) + 1), lambda i: CAST(ascii(substr(place, i, 1)) AS BIGINT))),
    lambda a, x: xor(a >> 8, l[1 + xor(a, x) % 256])), 4294967295) % 20 AS kind
  FROM c, crc WHERE k = 8
), m AS (
  SELECT key, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM k, LATERAL (SELECT unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)))
), o AS (
  SELECT *, left(role, 1) AS initial, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown,
    row_number() OVER (PARTITION BY key ORDER BY turn NULLS FIRST, role, text) AS i, count(*) OVER (PARTITION BY key) AS n
  FROM m
), f AS MATERIALIZED (
  SELECT *, CASE WHEN shown = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY key, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY key ORDER BY i) || initial AS pair FROM o
), fit(q, next) AS (
  VALUES (0, 2), (1, 2), (2, 3), (3, 2)
), before(q, letters, state, cost) AS (
  SELECT q, '', q, 0 FROM fit UNION ALL SELECT q, 'I', next, 2 FROM fit UNION ALL SELECT a.q, 'II', b.next, 4 FROM fit a JOIN fit b ON b.q = a.next
), edit(state, letter, initial, next, cost) AS (
  SELECT q, 'D', NULL, q, 3 FROM fit UNION ALL SELECT q, 'R', NULL, next, 2 FROM fit
  UNION ALL SELECT q, 'K', CASE next WHEN 2 THEN 'u' ELSE 'a' END, next, 0 FROM fit UNION ALL VALUES (0, 'K', 's', 1, 0)
), best(key, i, q, b) AS (
  SELECT DISTINCT key, 0, 0, '00000000' FROM f
  UNION ALL
  SELECT best.key, best.i + 1, edit.next, min(printf('%08d', CAST(left(b, 8) AS BIGINT) + before.cost + edit.cost + CASE WHEN fault = 'truncated' AND letter <> 'D' THEN 1 ELSE 0 END)
    || substr(b, 9) || before.letters || letter)
  FROM best JOIN before ON before.q = best.q JOIN edit ON edit.state = before.state JOIN f ON f.key = best.key AND f.i = best.i + 1
  WHERE letter = 'D' OR fault NOT IN ('blank', 'duplicate') AND (letter = 'R' OR edit.initial = f.initial)
  GROUP BY best.key, best.i + 1, edit.next
), a AS (
  SELECT key, CAST(left(b, 8) AS BIGINT) AS cost, substr(b, 9) AS audit FROM (
    SELECT best.key, min(printf('%08d', CAST(left(b, 8) AS BIGINT) + CASE q WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 0 END) || substr(b, 9) || CASE q WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END) AS b
    FROM best JOIN (SELECT DISTINCT key, n FROM f) USING (key) WHERE best.i = n GROUP BY best.key)
), e AS (
  SELECT key, j, substr(audit, j, 1) AS letter, length(replace(left(audit, j), 'I', '')) AS i, length(replace(left(audit, j), 'D', '')) AS place
  FROM (SELECT key, audit, unnest(range(1, length(audit) + 1)) AS j FROM a)
), s AS (
  SELECT e.key, bool_or(initial = 's') AS led FROM e JOIN f ON f.key = e.key AND f.i = e.i WHERE letter = 'K' AND place = 1 GROUP BY e.key
), h AS (
  SELECT e.key, string_agg(CASE WHEN letter = 'K' THEN role ELSE CASE (place + CASE WHEN led THEN 1 ELSE 0 END) % 2 WHEN 1 THEN 'user' ELSE 'assistant' END END
    || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY j) AS said
  FROM e LEFT JOIN f ON f.key = e.key AND f.i = e.i LEFT JOIN s ON s.key = e.key WHERE letter <> 'D' GROUP BY e.key
), g AS (
  SELECT key, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY key
)
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, key FROM c) d LEFT JOIN g USING (key) LEFT JOIN a USING (key) LEFT JOIN h USING (key)
"""
