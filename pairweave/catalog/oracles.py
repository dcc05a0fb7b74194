"""DuckDB SQL that gives the same rows as each registered query, built from shared common table expressions."""

from __future__ import annotations

import re

from pairweave.catalog.fixtures import EPOCHS, FOLLOWERS, MAX_SAMPLES, MIN_SAMPLES, NUM_CUTS, TOKEN_BUDGET, WORD_VOCABULARY
from pairweave.operators.scoring import HAN_BLOCKS, PUNCTUATION_RULES

_CTES: dict[str, str] = {}

#: Merges that are worth unrolling in SQL, of the thousands that training makes.
FIRST_MERGES = 8

# --- inputs

_CTES["length_pairs"] = """
SELECT concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS pair_id,
       CAST(l_quantity AS INTEGER) + 2 AS src_len,
       CAST(greatest(2, CAST(l_quantity AS INTEGER) + 2 + l_suppkey % 7 - 3) AS INTEGER) AS tgt_len
FROM lineitem"""

_CTES["cell_sizes"] = f"SELECT {MIN_SAMPLES} AS least, {MAX_SAMPLES} AS most"

_CTES["bitext"] = """
SELECT concat_ws(':', u.conv_id, u.turn) AS pair_id, u.text AS src_text, a.text AS tgt_text
FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant'"""

_CTES["doc_lines"] = "SELECT doc_id, string_split(text, chr(10)) AS l FROM documents"
_CTES["line_pairs"] = """
SELECT concat_ws(':', doc_id, i - 1) AS pair_id, l[i] AS src_text, l[i + 1] AS tgt_text
FROM (SELECT doc_id, l, unnest(range(1, len(l))) AS i FROM doc_lines)"""

_CTES["nested_pairs"] = """
SELECT pair_id, nullif(trim(src_text), '') AS en, nullif(trim(tgt_text), '') AS zh FROM line_pairs"""


def _normalized(col: str) -> str:
    """Lowercase, then composed letters of the test data taken apart."""
    text = f"lower({col})"
    marks = {768: "è", 769: "éíó", 770: "ê", 771: "ñ", 776: "äöü", 807: "ç"}
    base = str.maketrans("èéíóêñäöüç", "eeioenaouc")
    for mark, letters in marks.items():
        for letter in letters:
            text = f"replace({text}, '{letter}', '{letter.translate(base)}' || chr({mark}))"
    return text


_PUNCT = r"\p{P}!-/:-@\[-`{-~"
_PIECE = rf"[\p{{L}}\p{{M}}]+|\p{{N}}|[{_PUNCT}]|[^\p{{L}}\p{{M}}\p{{N}}{_PUNCT}\s]+"
_UNIT = r" ?\p{L}+| ?\p{N}+| ?[^\p{L}\p{N} ]+"


def _pieces(col: str) -> str:
    return f"regexp_extract_all({_normalized(col)}, '{_PIECE}')"


def _units(col: str) -> str:
    return f"regexp_extract_all(' ' || array_to_string({_pieces(col)}, ' '), '{_UNIT}')"


_CTES["piece_counts"] = f"""
SELECT word, count(*) AS cnt FROM (SELECT unnest({_pieces('text')}) AS word FROM documents) GROUP BY word"""

_CTES["word_vocab"] = f"""
SELECT * FROM (VALUES ('[PAD]', 0), ('[BOS]', 1), ('[EOS]', 2), ('[UNK]', 3)) AS s(token, id)
UNION ALL
SELECT word, CAST(3 + row_number() OVER (ORDER BY cnt DESC, word) AS INTEGER) FROM piece_counts
QUALIFY row_number() OVER (ORDER BY cnt DESC, word) <= {WORD_VOCABULARY - 4}"""

for _side in ("src", "tgt"):
    _CTES[f"{_side}_pieces"] = f"SELECT pair_id, {_pieces(_side + '_text')} AS p FROM line_pairs"
    _CTES[f"{_side}_words"] = f"""
SELECT pair_id, coalesce(list(coalesce(v.id, 3) ORDER BY i) FILTER (i IS NOT NULL), []) AS ids
FROM (SELECT pair_id, unnest(CASE WHEN len(p) = 0 THEN [NULL] ELSE p END) AS token,
             unnest(CASE WHEN len(p) = 0 THEN [NULL] ELSE range(1, len(p) + 1) END) AS i FROM {_side}_pieces)
LEFT JOIN word_vocab v USING (token) GROUP BY pair_id"""

_CTES["doc_pieces"] = f"SELECT doc_id, {_pieces('text')} AS p FROM documents"
_CTES["doc_words"] = """
SELECT doc_id, coalesce(list(coalesce(v.id, 3) ORDER BY i) FILTER (i IS NOT NULL), []) AS ids
FROM (SELECT doc_id, unnest(CASE WHEN len(p) = 0 THEN [NULL] ELSE p END) AS token,
             unnest(CASE WHEN len(p) = 0 THEN [NULL] ELSE range(1, len(p) + 1) END) AS i FROM doc_pieces)
LEFT JOIN word_vocab v USING (token) GROUP BY doc_id"""

_CTES["encoded_pairs"] = """
SELECT pair_id, [1] || s.ids || [2] AS src_ids, [1] || t.ids || [2] AS tgt_ids
FROM src_words s JOIN tgt_words t USING (pair_id)"""

_CTES["shifted"] = """
SELECT pair_id, src_ids AS src, tgt_ids[:len(tgt_ids) - 1] AS tgt, tgt_ids[2:] AS label,
       CAST(len(src_ids) AS INTEGER) AS src_len, CAST(len(tgt_ids) - 1 AS INTEGER) AS tgt_len
FROM encoded_pairs WHERE len(src_ids) <= 128 AND len(tgt_ids) <= 128"""

_CTES["shifted_short"] = """
SELECT pair_id, CAST(len(src_ids) AS INTEGER) AS src_len, CAST(len(tgt_ids) - 1 AS INTEGER) AS tgt_len
FROM encoded_pairs WHERE len(src_ids) <= 64 AND len(tgt_ids) <= 64"""


def _joined(ids: str) -> str:
    return f"array_to_string({ids}, ',')"


# --- the length grid


def _grid(base: str, cuts: int, tag: str) -> None:
    """Common table expressions ``{tag}_src_cuts``, ``{tag}_tgt_cuts`` and ``{tag}_placed`` over a table of lengths."""
    for side in ("src", "tgt"):
        name = f"{tag}_{side}"
        _CTES[f"{name}_hist"] = f"SELECT {side}_len AS len, count(*) AS cnt FROM {base} GROUP BY 1"
        _CTES[f"{name}_sums"] = f"""
SELECT row_number() OVER (ORDER BY len) AS i, len, CAST(sum(cnt) OVER (ORDER BY len) AS BIGINT) AS c,
       CAST(sum(len * cnt) OVER (ORDER BY len) AS BIGINT) AS s FROM {name}_hist
UNION ALL SELECT 0, 0, 0, 0"""
        _CTES[f"{name}_d1"] = f"SELECT i, len * c - s AS cost, CAST(0 AS BIGINT) AS k FROM {name}_sums WHERE i > 0"
        for j in range(2, cuts + 1):
            _CTES[f"{name}_d{j}"] = f"""
SELECT p.i, d.cost + p.len * (p.c - q.c) - (p.s - q.s) AS cost, d.i AS k
FROM {name}_sums p JOIN {name}_d{j - 1} d ON d.i < p.i JOIN {name}_sums q ON q.i = d.i
QUALIFY row_number() OVER (PARTITION BY p.i ORDER BY d.cost + p.len * (p.c - q.c) - (p.s - q.s), d.i) = 1"""
        _CTES[f"{name}_b{cuts}"] = f"SELECT max(i) AS i FROM {name}_sums"
        for j in range(cuts - 1, 0, -1):
            _CTES[f"{name}_b{j}"] = f"SELECT k AS i FROM {name}_d{j + 1} WHERE i = (SELECT i FROM {name}_b{j + 1})"
        stops = " UNION ALL ".join(f"SELECT {j} AS j, i FROM {name}_b{j}" for j in range(1, cuts + 1))
        _CTES[f"{name}_stops"] = f"SELECT 0 AS j, 0 AS i UNION ALL {stops}"
        _CTES[f"{name}_cuts"] = f"""
SELECT CAST(b.j - 1 AS INTEGER) AS bucket, CAST(lo.len AS INTEGER) AS "start", CAST(hi.len + 1 AS INTEGER) AS "end"
FROM {name}_stops a JOIN {name}_stops b ON b.j = a.j + 1
JOIN {name}_sums lo ON lo.i = a.i + 1 JOIN {name}_sums hi ON hi.i = b.i"""
    _CTES[f"{tag}_placed"] = f"""
SELECT p.*, s.bucket AS src_bucket, t.bucket AS tgt_bucket, s."start" AS src_start, s."end" AS src_end,
       t."start" AS tgt_start, t."end" AS tgt_end
FROM {base} p JOIN {tag}_src_cuts s ON p.src_len >= s."start" AND p.src_len < s."end"
JOIN {tag}_tgt_cuts t ON p.tgt_len >= t."start" AND p.tgt_len < t."end\""""
    _CTES[f"{tag}_counts"] = f"SELECT {_CELL}, count(*) AS n FROM {tag}_placed GROUP BY ALL"


_CELL = "src_start, src_end, tgt_start, tgt_end"
_grid("length_pairs", NUM_CUTS, "g")
_grid("shifted", 4, "t")
_grid("shifted_short", 4, "u")

_CTES["g_valid"] = f"SELECT {_CELL}, n FROM g_counts WHERE n >= (SELECT least FROM cell_sizes)"
_CTES["g_kept"] = f"SELECT * FROM g_placed SEMI JOIN g_valid USING ({_CELL})"
_CTES["g_sharded"] = f"""
SELECT pair_id, src_len, tgt_len, {_CELL}, cell_rank, CAST(shards AS INTEGER) AS num_shards,
       CAST(least(cell_rank // most, shards - 1) AS INTEGER) AS shard_idx
FROM (SELECT *, CASE WHEN base > 1 AND 2 * (CASE WHEN n % most = 0 THEN most ELSE n % most END) <= most
                     THEN base - 1 ELSE base END AS shards
      FROM (SELECT k.*, most, greatest(1, (n + most - 1) // most) AS base
            FROM (SELECT *, row_number() OVER (PARTITION BY {_CELL} ORDER BY md5('42:' || pair_id), pair_id) - 1 AS cell_rank,
                         count(*) OVER (PARTITION BY {_CELL}) AS n FROM g_kept) k, cell_sizes))"""
_CTES["g_manifest"] = f"""
SELECT {_CELL}, shard_idx, num_shards, 0 AS suggested_batch_size, CAST(count(*) AS INTEGER) AS num_samples
FROM g_sharded GROUP BY ALL"""
_CTES["g_sized"] = f"""
SELECT {_CELL}, shard_idx, num_shards, num_samples,
       CAST(greatest(1, {TOKEN_BUDGET} // (src_end + tgt_end)) AS INTEGER) AS suggested_batch_size
FROM g_manifest"""
_CTES["g_batches"] = """
SELECT *, CAST((num_samples + scaled - 1) // scaled AS BIGINT) AS iterations, CAST(num_samples // scaled AS BIGINT) AS whole
FROM (SELECT *, CAST(floor(suggested_batch_size * 0.75) AS BIGINT) AS scaled FROM g_sized)"""
_CTES["g_totals"] = """
SELECT CAST(count(*) AS BIGINT) AS total_samples,
       CAST(sum(src_end - 1 - src_len + tgt_end - 1 - tgt_len) AS BIGINT) AS total_padding,
       CAST(sum(src_len + tgt_len) AS BIGINT) AS total_actual_tokens
FROM g_kept"""
_CTES["g_first"] = "SELECT * FROM g_manifest ORDER BY tgt_start, src_start, shard_idx LIMIT 1"

_KEY = "concat_ws(':', src_start, tgt_start, shard_idx)"
_CTES["epochs"] = f"""
SELECT *, row_number() OVER (PARTITION BY epoch ORDER BY key) - 1 AS position,
       CAST(coalesce(sum(iterations) OVER (PARTITION BY epoch ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS steps_before,
       CAST(sum(iterations) OVER (PARTITION BY epoch) AS BIGINT) AS epoch_steps
FROM (SELECT g.*, CAST(e.epoch AS INTEGER) AS epoch,
             CASE WHEN e.epoch = 0 THEN printf('%010d:%010d:%010d', tgt_start, src_start, shard_idx)
                  ELSE md5('42:' || e.epoch || ':' || {_KEY}) END AS key
      FROM g_batches g, range({EPOCHS}) e(epoch))"""
_CTES["steps"] = """
SELECT *, epoch * epoch_steps + steps_before + batch AS step, steps_before + batch AS inside,
       (epoch - (epoch + 2) // 3) * epoch_steps + CASE WHEN epoch % 3 = 0 THEN 0 ELSE steps_before + batch END AS annealed
FROM (SELECT *, unnest(range(iterations)) AS batch FROM epochs)"""

# --- subword training: symbols are wrapped in two private-use characters

_OPEN, _CLOSE = "chr(57344)", "chr(57345)"
_STAND_IN = """CASE WHEN b BETWEEN 33 AND 126 OR b BETWEEN 161 AND 172 OR b BETWEEN 174 AND 255 THEN chr(b)
     WHEN b <= 32 THEN chr(256 + b) WHEN b <= 160 THEN chr(162 + b) ELSE chr(323) END"""


def _spelled(units: str, key: str) -> str:
    """Units spelled byte by byte, one row per distinct value of ``key``."""
    return f"""
SELECT {key}, string_agg({_STAND_IN}, '' ORDER BY i) AS spelled
FROM (SELECT {key}, i, CAST(('0x' || substr(h, 2 * i - 1, 2)) AS INTEGER) AS b
      FROM (SELECT {key}, h, unnest(range(1, len(h) // 2 + 1)) AS i FROM (SELECT DISTINCT {key}, hex(encode({units})) AS h FROM %s)))
GROUP BY {key}"""


_CTES["raw_units"] = f"SELECT unit, count(*) AS cnt FROM (SELECT unnest({_units('text')}) AS unit FROM documents) GROUP BY unit"
_CTES["spelled_units"] = _spelled("unit", "unit") % "raw_units"
_CTES["unit_counts"] = "SELECT spelled AS word, cnt FROM raw_units JOIN spelled_units USING (unit)"
_CTES["alphabet"] = """
SELECT c AS token, CAST(3 + row_number() OVER (ORDER BY c) AS INTEGER) AS id
FROM (SELECT DISTINCT unnest(string_split(word, '')) AS c FROM unit_counts) WHERE c <> ''"""
_CTES["v0"] = """
SELECT * FROM (VALUES ('[PAD]', 0), ('[BOS]', 1), ('[EOS]', 2), ('[UNK]', 3)) AS s(token, id)
UNION ALL SELECT token, id FROM alphabet"""


def _wrapped(word: str) -> str:
    return f"regexp_replace({word}, '(.)', {_OPEN} || '\\1' || {_CLOSE}, 'g')"


_CTES["w0"] = f"SELECT {_wrapped('word')} AS word, cnt FROM unit_counts"
for _r in range(1, FIRST_MERGES + 1):
    _CTES[f"p{_r}"] = f"""
SELECT s[i] AS l, s[i + 1] AS r, sum(cnt) AS n
FROM (SELECT s, cnt, unnest(range(1, len(s))) AS i
      FROM (SELECT string_split(substr(word, 2, len(word) - 2), {_CLOSE} || {_OPEN}) AS s, cnt FROM w{_r - 1}))
GROUP BY ALL"""
    _CTES[f"top{_r}"] = f"""
SELECT l, r FROM p{_r} JOIN v{_r - 1} a ON a.token = l JOIN v{_r - 1} b ON b.token = r
WHERE n >= 4 ORDER BY n DESC, a.id, b.id LIMIT 1"""
    _CTES[f"v{_r}"] = f"""
SELECT token, id FROM v{_r - 1} UNION ALL
SELECT l || r, (SELECT CAST(max(id) + 1 AS INTEGER) FROM v{_r - 1}) FROM top{_r} WHERE l || r NOT IN (SELECT token FROM v{_r - 1})"""
    _CTES[f"w{_r}"] = f"""
SELECT replace(word, {_OPEN} || l || {_CLOSE} || {_OPEN} || r || {_CLOSE}, {_OPEN} || l || r || {_CLOSE}) AS word, cnt
FROM w{_r - 1}, top{_r}"""

# --- segmentation

_LETTERS = r"[\p{L}\p{M}]+"
_CTES["seg_texts"] = f"""
SELECT row_number() OVER () AS seg_row, concat_ws(':', conv_id, turn) AS pair_id, replace({_normalized('text')}, ' ', '') AS t FROM conversations"""
_CTES["seg_dictionary"] = f"""
SELECT word, cnt, CAST(floor(1000000 * ln(cnt / CAST(sum(cnt) OVER () AS DOUBLE))) AS BIGINT) AS score, length(word) AS size
FROM piece_counts WHERE regexp_full_match(word, '{_LETTERS}')"""
_CTES["seg_unknown"] = "SELECT CAST(floor(1000000 * ln(1 / CAST(sum(cnt) AS DOUBLE))) AS BIGINT) AS alone, max(size) AS longest FROM seg_dictionary"
_CTES["seg_runs"] = f"SELECT DISTINCT unnest(regexp_extract_all(t, '{_LETTERS}')) AS run FROM seg_texts"
_CTES["seg_places"] = "SELECT run, unnest(range(1, length(run) + 1)) AS place FROM seg_runs"
_CTES["seg_matches"] = """
SELECT run, place, d.size, d.score FROM (
  SELECT run, place, substr(run, place, unnest(range(1, least(longest, length(run) - place + 1) + 1))) AS word FROM seg_places, seg_unknown
) JOIN seg_dictionary d USING (word)"""
_CTES["seg_options"] = """
SELECT run, place, list({'size': size, 'known': known, 'score': score}) AS options FROM (
  SELECT run, place, size, 1 AS known, score FROM seg_matches UNION ALL
  SELECT run, place, 1, 0, alone FROM seg_places p, seg_unknown WHERE NOT EXISTS (SELECT 1 FROM seg_matches m WHERE m.run = p.run AND m.place = p.place AND m.size = 1)
) GROUP BY run, place"""
# Totals and steps from a place to the end as lists; a total and the size that gives it are one number, so the longer word wins a tie.
_CTES["seg_path"] = """
SELECT run, length(run) + 1 AS place, [CAST(0 AS BIGINT)] AS totals, CAST([] AS BIGINT[]) AS sizes, CAST([] AS INTEGER[]) AS knowns FROM seg_runs
UNION ALL
SELECT run, place, list_prepend((b - (b % 8192 + 8192) % 8192) // 8192, totals), list_prepend(((b % 8192 + 8192) % 8192) // 2, sizes),
  list_prepend(CAST(((b % 8192 + 8192) % 8192) % 2 AS INTEGER), knowns)
FROM (SELECT p.run, o.place, totals, sizes, knowns, list_max(list_transform(o.options, lambda x: (x.score + totals[x.size]) * 8192 + x.size * 2 + x.known)) AS b
      FROM seg_path p JOIN seg_options o ON o.run = p.run AND o.place = p.place - 1)"""
_CTES["seg_steps"] = """
SELECT run, CAST(1 AS BIGINT) AS place, sizes[1] AS size, knowns[1] AS known, sizes, knowns FROM seg_path WHERE place = 1
UNION ALL
SELECT run, place + size, sizes[place + size], knowns[place + size], sizes, knowns FROM seg_steps WHERE place + size <= length(run)"""
_CTES["seg_stretches"] = """
SELECT run, min(place) AS place, count(*) AS n, known, CASE WHEN known = 0 THEN substr(run, min(place), count(*)) ELSE substr(run, min(place), any_value(size)) END AS piece
FROM (SELECT *, CASE WHEN known = 0 THEN place - row_number() OVER (PARTITION BY run, known ORDER BY place) ELSE -place END AS stretch FROM seg_steps)
GROUP BY run, known, stretch"""
_CTES["state_counts"] = """
SELECT s, c, CAST(sum(cnt) AS BIGINT) AS n FROM (
  SELECT 'S' AS s, word AS c, cnt FROM seg_dictionary WHERE size = 1
  UNION ALL SELECT 'B', left(word, 1), cnt FROM seg_dictionary WHERE size > 1
  UNION ALL SELECT 'E', right(word, 1), cnt FROM seg_dictionary WHERE size > 1
  UNION ALL SELECT 'M', unnest(string_split(substr(word, 2, size - 2), '')), cnt FROM seg_dictionary WHERE size > 2
) GROUP BY s, c"""
_CTES["state_sums"] = """
SELECT CAST(coalesce(sum(n) FILTER (s = 'S'), 0) AS BIGINT) AS single, CAST(coalesce(sum(n) FILTER (s = 'B'), 0) AS BIGINT) AS multi,
  CAST(coalesce(sum(n) FILTER (s = 'M'), 0) AS BIGINT) AS inside, count(DISTINCT c) + 1 AS characters,
  (SELECT CAST(coalesce(sum(cnt), 0) AS BIGINT) FROM seg_dictionary WHERE size > 2) AS longer FROM state_counts"""
_CTES["state_follows"] = """
SELECT s, t, CAST(floor(1000000 * ln(CAST(a AS DOUBLE) / b)) AS BIGINT) AS score FROM (
  SELECT unnest(['', 'E', 'S']) AS s, 'S' AS t, single + 1 AS a, multi + single + 2 AS b FROM state_sums
  UNION ALL SELECT unnest(['', 'E', 'S']), 'B', multi + 1, multi + single + 2 FROM state_sums
  UNION ALL SELECT 'B', 'E', multi - longer + 1, multi + 2 FROM state_sums UNION ALL SELECT 'B', 'M', longer + 1, multi + 2 FROM state_sums
  UNION ALL SELECT 'M', 'E', longer + 1, inside + 2 FROM state_sums UNION ALL SELECT 'M', 'M', inside - longer + 1, inside + 2 FROM state_sums)"""
_CTES["state_totals"] = """
SELECT unnest(['S', 'B', 'E', 'M']) AS s, unnest([single, multi, multi, inside]) + characters AS total FROM state_sums"""
_CTES["state_shown"] = """
SELECT piece, place, s, CAST(floor(1000000 * ln((coalesce(n, 0) + 1) / CAST(total AS DOUBLE))) AS BIGINT) AS score FROM (
  SELECT piece, place, substr(piece, place, 1) AS c FROM (SELECT piece, unnest(range(1, n + 1)) AS place FROM (SELECT DISTINCT piece, n FROM seg_stretches WHERE known = 0 AND n > 1))
) CROSS JOIN state_totals LEFT JOIN state_counts USING (s, c)"""
# Paths are spelled so that of equal ones the least is the one whose words end sooner: e and s before what goes on.
_CTES["state_path"] = """
SELECT piece, place, s, score, CASE s WHEN 'E' THEN 'e' ELSE 's' END AS path FROM state_shown WHERE place = length(piece) AND s IN ('E', 'S')
UNION ALL
SELECT piece, place, s, score, path FROM (
  SELECT h.piece, h.place, h.s, h.score + f.score + p.score AS score, CASE h.s WHEN 'E' THEN 'e' WHEN 'M' THEN 'm' WHEN 'S' THEN 's' ELSE 't' END || p.path AS path
  FROM state_path p JOIN state_shown h ON h.piece = p.piece AND h.place = p.place - 1 JOIN state_follows f ON f.s = h.s AND f.t = p.s)
QUALIFY row_number() OVER (PARTITION BY piece, s ORDER BY score DESC, path) = 1"""
_CTES["state_best"] = """
SELECT piece, path FROM state_path p JOIN state_follows f ON f.s = '' AND f.t = p.s WHERE place = 1
QUALIFY row_number() OVER (PARTITION BY piece ORDER BY p.score + f.score DESC, path) = 1"""
_CTES["state_words"] = """
SELECT piece, rtrim(string_agg(substr(piece, i, 1) || CASE WHEN substr(path, i, 1) IN ('e', 's') THEN ' ' ELSE '' END, '' ORDER BY i)) AS cut
FROM (SELECT *, unnest(range(1, length(piece) + 1)) AS i FROM state_best) GROUP BY piece"""
_CTES["seg_cut"] = """
SELECT run, string_agg(CASE WHEN known = 0 THEN coalesce(cut, piece) ELSE piece END, ' ' ORDER BY place) AS cut
FROM seg_stretches LEFT JOIN state_words USING (piece) GROUP BY run"""

# --- candidates, predictions, scores

_CTES["candidates"] = """
SELECT user_id AS item_id, CAST(event_id % 4 AS INTEGER) AS beam, CAST(event_id AS INTEGER) AS token,
       CAST(-(event_id % 11) AS DOUBLE) AS score, 0.0::DOUBLE - value / 100 AS logp,
       CAST(1 + event_id % 30 AS INTEGER) AS len, event_id % 13 = 0 AS finished
FROM events"""
_CTES["live"] = """
SELECT *, score + CASE WHEN finished THEN CASE WHEN token = 2 THEN 0.0 ELSE '-infinity'::DOUBLE END ELSE logp END AS new_score
FROM candidates"""
_CTES["predictions"] = """
SELECT CAST(doc_id AS VARCHAR) AS pair_id, list_append(ids, 2) AS labels FROM doc_words"""
_CTES["token_logits"] = """
SELECT vec_id // 64 AS batch_id, vec_id // 8 AS row_id, list_transform(embedding, lambda x: x::DOUBLE) AS z,
       CAST(CASE WHEN vec_id % 7 = 0 THEN 0 ELSE vec_id % len(embedding) END AS INTEGER) AS label
FROM embeddings"""
_CTES["token_loss"] = """
SELECT batch_id, row_id, CASE WHEN label <> 0 THEN 0.97 * (lse - z[label + 1]) + 0.03 * (lse - list_avg(z)) END AS loss
FROM (SELECT *, ln(list_sum(list_transform(z, lambda x: exp(x)))) AS lse FROM token_logits)"""
_CTES["batch_losses"] = """
SELECT batch_id, count(DISTINCT row_id) AS n_rows, avg(loss) AS loss FROM token_loss GROUP BY batch_id"""

_FIFTH = "array_to_string([w for w, i in string_split({0}, ' ') if i % 5 <> 0], ' ')"
_CTES["hypotheses"] = f"""
SELECT pair_id, src_text, tgt_text AS ref_text, {_FIFTH.format('tgt_text')} AS hyp_text FROM bitext"""


def _bleu_tokens(col: str) -> str:
    han = "[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in HAN_BLOCKS) + "]"
    text = f"regexp_replace(trim({col}), '({han})', ' \\1 ', 'g')"
    for pattern, replacement in PUNCTUATION_RULES:
        text = f"regexp_replace({text}, '{pattern}', '{replacement.replace('$', chr(92))}', 'g')"
    return f"list_filter(regexp_split_to_array({text}, '\\s+'), lambda t: t <> '')"


_CTES["bleu_tokens"] = f"SELECT pair_id, src_text, {_bleu_tokens('hyp_text')} AS h, {_bleu_tokens('ref_text')} AS r FROM hypotheses"
_CTES["scored_tokens"] = f"SELECT * FROM bleu_tokens WHERE len({_bleu_tokens('src_text')}) <= 64"


def _matches(source: str) -> str:
    """Per pair and order: clipped matches and totals, counted through grouping."""
    parts = []
    for n in range(1, 5):
        for side in ("h", "r"):
            parts.append(
                f"SELECT pair_id, {n} AS n, '{side}' AS side, array_to_string({side}[i:i + {n - 1}], ' ') AS g "
                f"FROM (SELECT pair_id, {side}, unnest(range(1, len({side}) - {n - 2})) AS i FROM {source})"
            )
    counts = " UNION ALL ".join(parts)
    grouped = f"""SELECT pair_id, n, g, count(*) FILTER (side = 'h') AS hc, count(*) FILTER (side = 'r') AS rc
FROM ({counts}) GROUP BY pair_id, n, g"""
    per = f"SELECT pair_id, n, sum(least(hc, rc)) AS correct, sum(hc) AS total FROM ({grouped}) GROUP BY pair_id, n"
    cols = ", ".join(
        f"CAST(coalesce(max({k}) FILTER (n = {n}), 0) AS BIGINT) AS {k}_{n}" for k in ("correct", "total") for n in range(1, 5)
    )
    return f"""SELECT t.pair_id, {cols}, CAST(any_value(len(h)) AS BIGINT) AS hyp_len, CAST(any_value(len(r)) AS BIGINT) AS ref_len
FROM {source} t LEFT JOIN ({per}) m USING (pair_id) GROUP BY t.pair_id"""


_SUMS = ", ".join(
    f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}"
    for c in [f"{k}_{n}" for k in ("correct", "total") for n in range(1, 5)] + ["hyp_len", "ref_len"]
)


def _bleu(source: str) -> str:
    logs = " + ".join(f"ln(CASE WHEN correct_{n} = 0 THEN 10.0 / total_{n} ELSE 100.0 * correct_{n} / total_{n} END)" for n in range(1, 5))
    return f"""SELECT *, CASE WHEN hyp_len >= ref_len THEN 1.0 ELSE exp(1 - ref_len / hyp_len) END AS bp, exp(({logs}) / 4) AS geo
FROM (SELECT {_SUMS} FROM {source})"""


_CTES["matches"] = _matches("bleu_tokens")
_CTES["scored_matches"] = _matches("scored_tokens")
_CTES["bleu"] = _bleu("matches")
_CTES["scored_bleu"] = _bleu("scored_matches")


def _with(body: str) -> str:
    """Prefix ``body`` with the common table expressions it needs, in order of dependence."""
    ordered: list[str] = []
    seen: set[str] = set()

    def visit(sql: str) -> None:
        for name in dict.fromkeys(re.findall(r"[a-z_0-9]+", sql)):
            if name in _CTES and name not in seen:
                seen.add(name)  # a recursive table names itself
                visit(_CTES[name])
                ordered.append(name)

    visit(body)
    if not ordered:
        return body
    return "WITH RECURSIVE " + ",\n".join(f"{name} AS MATERIALIZED ({_CTES[name]})" for name in ordered) + "\n" + body


def _r(col: str, digits: int = 6) -> str:
    return f"round({col}, {digits}) + 0.0 AS {col}"


_BATCHES = "SELECT doc_id, ids, (row_number() OVER (ORDER BY doc_id) - 1) AS place FROM doc_words"
_PADDED = """SELECT *, array_to_string((ids || list_transform(range(width), lambda x: 0))[:width], ',') AS padded
FROM (SELECT doc_id, place, place // 128 AS batch_id, ids, CAST(max(len(ids)) OVER (PARTITION BY place // 128) AS INTEGER) AS width
      FROM ({}))""".format(_BATCHES)


def _pad(ids: str, width: str) -> str:
    return f"array_to_string(({ids} || list_transform(range({width}), lambda x: 0))[:{width}], ',') AS {ids}"


_BODIES: dict[str, str] = {
    "bitext_scan": "SELECT pair_id, en AS src_text, zh AS tgt_text FROM nested_pairs WHERE en IS NOT NULL AND zh IS NOT NULL",
    "bitext_rejects": "SELECT count(*) AS read, count(*) FILTER (en IS NULL OR zh IS NULL) AS rejected FROM nested_pairs",
    "corpus_lines": """SELECT pair_id, replace(replace(replace(src_text, '\\', '\\\\'), chr(10), '\\n'), chr(13), '\\r') AS src_line,
replace(replace(replace(tgt_text, '\\', '\\\\'), chr(10), '\\n'), chr(13), '\\r') AS tgt_line FROM bitext""",
    "corpus_export": """SELECT side, count(*) AS lines, CAST(sum(len(replace(replace(replace(t, '\\', '\\\\'), chr(10), '\\n'), chr(13), '\\r'))) AS BIGINT) AS chars
FROM (SELECT 'src' AS side, src_text AS t FROM bitext UNION ALL SELECT 'tgt', tgt_text FROM bitext) GROUP BY side""",
    "corpus_union": """SELECT pair_id, src_text, tgt_text, 'train' AS split FROM bitext
UNION ALL SELECT pair_id, src_text, tgt_text, 'valid' FROM line_pairs""",
    "shard_roundtrip": f"SELECT pair_id, src_len, tgt_len, {_CELL}, shard_idx, num_shards FROM g_sharded",
    "validation_shard": """SELECT pair_id, src_len, tgt_len, 0 AS src_start, 128 AS src_end, 0 AS tgt_start, 128 AS tgt_end, 0 AS shard_idx FROM shifted""",
    "shard_read": f"SELECT pair_id, src_len, tgt_len, {_CELL}, shard_idx FROM g_sharded SEMI JOIN g_first USING ({_CELL}, shard_idx)",
    "bucket_manifest": "SELECT * FROM g_manifest",
    "manifest_roundtrip": "SELECT * FROM g_manifest",
    "batch_size_saved": f"SELECT {_CELL}, shard_idx, suggested_batch_size, num_samples FROM g_sized",
    "raw_bitext": """SELECT md5(len(e) || e || z) || ':' || (row_number() OVER (PARTITION BY en, zh) - 1) AS pair_id, en, zh
FROM (SELECT en, zh, coalesce('+' || en, '-') AS e, coalesce('+' || zh, '-') AS z FROM nested_pairs)""",
    "token_accuracy_by_bucket": """SELECT bucket, CAST(sum(hit) AS BIGINT) AS correct, CAST(sum(real) AS BIGINT) AS valid, round(sum(hit) / sum(real), 6) AS accuracy
FROM (SELECT CAST(len(labels) // 16 AS INTEGER) AS bucket, unnest(list_transform(labels, lambda y: CASE WHEN y <> 0 THEN 1 ELSE 0 END)) AS real,
      unnest(list_transform(labels, lambda y, i: CASE WHEN y <> 0 AND ((len(pair_id) + i - 1) % 5 <> 0 OR y = 3) THEN 1 ELSE 0 END)) AS hit FROM predictions)
GROUP BY bucket""",
    "metrics_log": """SELECT CAST(epoch AS INTEGER) AS epoch, bucket, split, round(sum(loss * n_rows) / sum(n_rows) FILTER (loss IS NOT NULL), 6) + 0.0 AS loss,
round(coalesce(sum(hits) / nullif(sum(reals), 0), 0.0), 6) + 0.0 AS acc
FROM (SELECT e AS epoch, batch_id, CAST(batch_id % 4 AS INTEGER) AS bucket, CASE WHEN batch_id % 5 = 4 THEN 'valid' ELSE 'train' END AS split,
      count(DISTINCT row_id) AS n_rows, sum(hit) AS hits, sum(real) AS reals,
      avg(CASE WHEN real = 1 THEN 0.97 * (lse - z[label + 1]) + 0.03 * (lse - list_avg(z)) END) AS loss
      FROM (SELECT e, batch_id, row_id, label, s AS z, ln(list_sum(list_transform(s, lambda x: exp(x)))) AS lse,
                   CASE WHEN label <> 0 THEN 1 ELSE 0 END AS real,
                   CASE WHEN label <> 0 AND list_position(s, list_max(s)) - 1 = label THEN 1 ELSE 0 END AS hit
            FROM (SELECT t.batch_id, t.row_id, t.label, e.e, list_transform(t.z, lambda x: x * (1 + e.e)) AS s FROM token_logits t, range(2) e(e)))
      GROUP BY e, batch_id)
GROUP BY epoch, bucket, split""",
    "comparison_report": """SELECT pair_id, concat('EN: ', replace(replace(replace(src_text, '\\', '\\\\'), chr(10), '\\n'), chr(13), '\\r'), chr(10),
'ZH_REF: ', replace(replace(replace(ref_text, '\\', '\\\\'), chr(10), '\\n'), chr(13), '\\r'), chr(10),
'ZH_HYP: ', replace(replace(replace(hyp_text, '\\', '\\\\'), chr(10), '\\n'), chr(13), '\\r'), chr(10)) AS value FROM hypotheses""",
    "normalized_text": f"SELECT doc_id, {_normalized('text')} AS normalized FROM documents",
    "pretokenize": f"SELECT doc_id, array_to_string({_pieces('text')}, ' ') AS pieces FROM documents",
    "unit_split": f"SELECT doc_id, array_to_string({_units('text')}, '|') AS units FROM documents",
    "word_counts": "SELECT word, cnt FROM piece_counts",
    "byte_unit_counts": "SELECT word, cnt FROM unit_counts",
    "word_vocab": "SELECT token, id FROM word_vocab",
    "pair_counts": 'SELECT l AS "left", r AS "right", CAST(n AS BIGINT) AS cnt FROM p1',
    "bpe_first_merges": " UNION ALL ".join(f'SELECT {i - 1} AS rank, l AS "left", r AS "right" FROM top{i}' for i in range(1, FIRST_MERGES + 1)),
    "decode_ids": "SELECT doc_id, array_to_string(p, '') AS decoded FROM doc_pieces",
    "encode_words": f"SELECT doc_id, {_joined('ids')} AS ids FROM doc_words",
    "special_tokens": f"""SELECT pair_id, {_joined('src_ids')} AS single,
{_joined('src_ids || tgt_ids')} AS pair FROM encoded_pairs""",
    "length_filter": """SELECT pair_id, CAST(len(src_ids) AS INTEGER) AS src_n, CAST(len(tgt_ids) AS INTEGER) AS tgt_n
FROM encoded_pairs WHERE len(src_ids) <= 64 AND len(tgt_ids) <= 64""",
    "eval_discards": """SELECT count(*) AS total, count(*) FILTER (len(ids) + 2 <= 256) AS valid,
count(*) FILTER (len(ids) + 2 > 256) AS discarded FROM doc_words""",
    "shifted_pairs": f"SELECT pair_id, {_joined('src')} AS src, {_joined('tgt')} AS tgt, {_joined('label')} AS label FROM shifted",
    "narrow_pairs": f"SELECT doc_id, {_joined('ids')} AS ids FROM doc_words",
    "cut_at_eos": f"SELECT pair_id, {_joined('tgt_ids')} AS ids FROM encoded_pairs",
    "padded_batches": f"""SELECT pair_id, {_CELL}, {_pad('src', 'src_end - 1')}, {_pad('tgt', 'tgt_end - 1')}, {_pad('label', 'tgt_end - 1')}
FROM t_placed""",
    "batch_assign_global": """SELECT pair_id, place // 512 AS batch_id, CAST(place % 512 AS INTEGER) AS batch_pos
FROM (SELECT pair_id, row_number() OVER (ORDER BY pair_id) - 1 AS place FROM line_pairs)""",
    "dynamic_pad": f"SELECT doc_id, batch_id, width, padded AS ids FROM ({_PADDED})",
    "stacked_batches": f"SELECT batch_id, string_agg(padded, ';' ORDER BY place) AS src FROM ({_PADDED}) GROUP BY batch_id",
    "loss_accounting": """SELECT (SELECT count(*) FROM nested_pairs) AS read,
(SELECT count(*) FROM nested_pairs WHERE en IS NULL OR zh IS NULL) AS rejected,
(SELECT count(*) FROM encoded_pairs WHERE len(src_ids) > 64 OR len(tgt_ids) > 64) AS too_long,
(SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM u_counts WHERE n < 100) AS thin_cell""",
    "length_histogram": "SELECT 'src' AS side, len, cnt FROM g_src_hist UNION ALL SELECT 'tgt', len, cnt FROM g_tgt_hist",
    "optimal_cuts": """SELECT 'src' AS side, bucket, "start", "end" FROM g_src_cuts
UNION ALL SELECT 'tgt', bucket, "start", "end" FROM g_tgt_cuts""",
    "small_cuts": """SELECT len AS "start", coalesce(lead(len) OVER (ORDER BY len), len + 1) AS "end"
FROM (SELECT DISTINCT l_linenumber * l_linenumber AS len FROM lineitem)""",
    "bucket_assign": f"SELECT pair_id, src_bucket, tgt_bucket, {_CELL} FROM g_kept",
    "cell_grid": f"""SELECT s."start" AS src_start, s."end" AS src_end, t."start" AS tgt_start, t."end" AS tgt_end, coalesce(n, 0) AS n
FROM g_src_cuts s CROSS JOIN g_tgt_cuts t LEFT JOIN g_counts c ON c.src_start = s."start" AND c.tgt_start = t."start\"""",
    "valid_cells": f"SELECT {_CELL}, n FROM g_valid",
    "discarded_pairs": f"SELECT pair_id, src_len, tgt_len FROM g_placed ANTI JOIN g_valid USING ({_CELL})",
    "padding_totals": "SELECT * FROM g_totals",
    "bucket_totals": f"""SELECT {NUM_CUTS} AS num_cuts, CAST(least AS INTEGER) AS min_samples, CAST(most AS INTEGER) AS max_samples, total_samples,
(SELECT count(*) FROM lineitem) AS total_original_samples, (SELECT count(*) FROM lineitem) - total_samples AS discarded_samples,
total_padding, total_actual_tokens FROM g_totals, cell_sizes""",
    "shard_assign": f"SELECT pair_id, {_CELL}, shard_idx, num_shards, cell_rank FROM g_sharded",
    "batch_assign": f"""SELECT pair_id, {_CELL}, shard_idx, place // 64 AS batch_id, CAST(place % 64 AS INTEGER) AS batch_pos
FROM (SELECT *, row_number() OVER (PARTITION BY {_CELL}, shard_idx ORDER BY cell_rank) - 1 AS place FROM g_sharded)""",
    "batch_size_plan": f"SELECT {_CELL}, shard_idx, suggested_batch_size, num_samples FROM g_sized",
    "plan_complete": """SELECT bool_and(suggested_batch_size > 0) AS complete, 'sized' AS plan FROM g_sized
UNION ALL SELECT bool_and(suggested_batch_size > 0), 'reset' FROM g_manifest""",
    "epoch_iterations": """SELECT CAST(sum(iterations) AS BIGINT) AS iterations, false AS drop_last FROM g_batches
UNION ALL SELECT CAST(sum(whole) AS BIGINT), true FROM g_batches""",
    "bucket_stats": """SELECT src_start || '-' || (src_end - 1) AS src_range, tgt_start || '-' || (tgt_end - 1) AS tgt_range, num_samples,
(shard_idx + 1) || '/' || num_shards AS shard, suggested_batch_size,
round(((SELECT count(*) FROM lineitem) - total_samples) * 100.0::DOUBLE / (SELECT count(*) FROM lineitem), 6) AS discard_pct,
round(total_padding * 100.0::DOUBLE / (total_padding + total_actual_tokens), 6) AS padding_pct
FROM g_sized, g_totals""",
    "curriculum_order": f"""SELECT {_CELL}, shard_idx, num_samples,
row_number() OVER (ORDER BY tgt_start, src_start, shard_idx) - 1 AS position FROM g_sized""",
    "seeded_shuffle": "SELECT pair_id, row_number() OVER (ORDER BY md5('42:' || pair_id), pair_id) - 1 AS shuffle_rank FROM length_pairs",
    "epoch_plan": f"SELECT epoch, position, {_CELL}, shard_idx, iterations, steps_before FROM epochs",
    "step_schedule": f"""SELECT epoch, position, {_CELL}, shard_idx, batch, step,
round(5.0 + 495.0 * (1 + cos(pi() * step / (2 * epoch_steps))) / 2, 4) AS lr_e6,
round(CASE WHEN epoch % 3 = 0 THEN 1.0 ELSE 0.5 + 0.5 * (1 + cos(pi() * annealed / epoch_steps)) / 2 END, 6) AS teacher_ratio
FROM steps""",
    "resume_plan": """SELECT epoch, count(*) AS steps, min(step) AS first_step, max(step) AS last_step
FROM steps WHERE epoch > 1 OR (epoch = 1 AND position >= 5) GROUP BY epoch""",
    "cosine_schedule": """SELECT step, round(0.5 + 0.5 * (1 + cos(pi() * step / t)) / 2, 6) AS value
FROM (SELECT t, unnest(range(2 * t + 1)) AS step FROM (SELECT CAST(sum(iterations) AS BIGINT) AS t FROM g_batches))""",
    "token_accuracy": """SELECT CAST(sum(CASE WHEN y <> 0 AND ((len(pair_id) + i) % 5 <> 0 OR y = 3) THEN 1 ELSE 0 END) AS BIGINT) AS correct,
CAST(sum(CASE WHEN y <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS valid,
round(sum(CASE WHEN y <> 0 AND ((len(pair_id) + i) % 5 <> 0 OR y = 3) THEN 1 ELSE 0 END) / sum(CASE WHEN y <> 0 THEN 1 ELSE 0 END), 6) AS accuracy
FROM (SELECT pair_id, unnest(labels) AS y, unnest(range(len(labels))) AS i FROM predictions)""",
    "smoothed_loss": f"SELECT batch_id, n_rows, {_r('loss')} FROM batch_losses",
    "epoch_loss": "SELECT round(sum(loss * n_rows) / sum(n_rows), 6) + 0.0 AS loss FROM batch_losses",
    "argmax_tokens": "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS token FROM embeddings",
    "beam_step": f"""SELECT item_id, CAST(rn - 1 AS INTEGER) AS new_beam, beam AS from_beam, token, {_r('new_score')},
(token = 2 OR finished) AS new_finished, CAST(CASE WHEN token = 2 OR finished THEN len ELSE len + 1 END AS INTEGER) AS new_len
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY new_score / pow(len + 1, 0.6) DESC, beam, token) AS rn FROM live)
WHERE rn <= 4""",
    "repetition_penalty": """SELECT doc_id, token, round(((token % 97 - 40) / 10.0::DOUBLE) / pow(1.1, times), 6) + 0.0 AS logit
FROM (SELECT doc_id, ids[-1] AS token, len(list_filter(ids[:len(ids) - 1], lambda x: x = ids[-1])) AS times
      FROM doc_words WHERE len(ids) > 0)""",
    "nbest_pick": """SELECT item_id, beam, token, round(score / pow(len, 0.6), 6) + 0.0 AS final_score FROM candidates
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score / pow(len, 0.6) DESC, beam, token) = 1""",
    "ngram_matches": "SELECT * FROM matches",
    "corpus_bleu": """SELECT * EXCLUDE (bp, geo), round(bp, 6) AS bp, round(bp * geo, 6) AS bleu FROM bleu""",
    "eval_summary": f"""SELECT (SELECT count(*) FROM bleu_tokens) AS total, (SELECT count(*) FROM scored_tokens) AS valid,
(SELECT count(*) FROM bleu_tokens) - (SELECT count(*) FROM scored_tokens) AS discarded, round(bp * geo, 6) AS bleu FROM scored_bleu""",
    "translate_batches": f"SELECT doc_id, text, {_FIFTH.format('text')} AS hyp_text FROM documents",
}
_RAW = """SELECT md5(len(e) || e || z) || ':' || (row_number() OVER (PARTITION BY en, zh) - 1) AS pair_id, en, zh{more}
FROM (SELECT en, zh, coalesce('+' || en, '-') AS e, coalesce('+' || zh, '-') AS z FROM nested_pairs{where})"""
_BODIES["readable_pairs"] = _RAW.format(more=", 1 AS left_out", where=" WHERE len(pair_id) % 2 = 0")
_BODIES["corrupt_files"] = """
SELECT CAST(part AS VARCHAR) AS part, ['complete', 'damaged', 'damaged', 'unreadable'][part + 1] AS status,
  CASE WHEN part < 3 THEN n END AS stated, CASE WHEN part = 0 THEN n END AS read
FROM (SELECT len(pair_id) % 4 AS part, count(*) AS n FROM nested_pairs GROUP BY ALL)"""
_BODIES["zip_by_position"] = "SELECT row_number() OVER (ORDER BY pair_id) - 1 AS line_no, src_text, tgt_text FROM bitext"
_BODIES["shard_rows"] = f"""
SELECT pair_id, {_CELL}, shard_idx, place AS row FROM (
  SELECT *, row_number() OVER (PARTITION BY {_CELL}, shard_idx ORDER BY cell_rank) - 1 AS place, count(*) OVER (PARTITION BY {_CELL}, shard_idx) AS n FROM g_sharded)
WHERE place IN (0, n // 2, n - 1)"""
_CTES["probe_cells"] = "SELECT DISTINCT src_start, src_end, tgt_start, tgt_end FROM g_manifest"
_CTES["probe_steps"] = """
SELECT src_start, tgt_start, src_end, tgt_end, 1 AS low, 16384 AS high, 0 AS best, 0 AS tries FROM probe_cells
UNION ALL
SELECT src_start, tgt_start, src_end, tgt_end, CASE WHEN held THEN size + 1 ELSE low END, CASE WHEN held THEN high ELSE size - 1 END, CASE WHEN held THEN size ELSE best END, tries + 1
FROM (SELECT *, (low + high) // 2 AS size, (low + high) // 2 <= 9000 AND (low + high) // 2 * (src_end + tgt_end) + src_end * tgt_end <= 50000 AS held FROM probe_steps)
WHERE low <= high AND tries < 14"""
_BODIES["probed_batch_size"] = f"""
SELECT {_CELL}, shard_idx, CAST(best AS INTEGER) AS suggested_batch_size, num_samples FROM g_manifest JOIN (
  SELECT src_start, tgt_start, arg_max(best, tries) AS best FROM probe_steps GROUP BY ALL) USING (src_start, tgt_start)"""
_CTES["next_pairs"] = """
SELECT e[i] AS prev, e[i + 1] AS token, count(*) AS cnt
FROM (SELECT e, unnest(range(1, len(e))) AS i FROM (SELECT [1] || ids || [2] AS e FROM doc_words)) GROUP BY ALL"""
_CTES["next_table"] = f"""
SELECT prev, token, round(ln(cnt), 9) AS logit FROM next_pairs
QUALIFY row_number() OVER (PARTITION BY prev ORDER BY cnt DESC, token) <= {FOLLOWERS}"""
_CTES["beam_states"] = """
SELECT doc_id, 0 AS step, 0 AS beam, [CAST(coalesce(ids[-1], 1) AS INTEGER)] AS tokens, 0.0::DOUBLE AS score, 1 AS len, false AS finished FROM doc_words
UNION ALL
SELECT doc_id, step + 1, CAST(row_number() OVER best - 1 AS INTEGER), list_append(tokens, CAST(token AS INTEGER)), score + logp,
  len + CASE WHEN token = 2 OR finished THEN 0 ELSE 1 END, token = 2 OR finished
FROM (
  SELECT doc_id, step, beam, tokens, score, len, finished, token, round(z - top - ln(sum(exp(z - top)) OVER (PARTITION BY doc_id, beam)), 9) AS logp FROM (
    SELECT *, max(z) OVER (PARTITION BY doc_id, beam) AS top FROM (
      SELECT b.*, n.token, n.logit / pow(1.1, len(list_filter(tokens[2:], lambda t: t = n.token))) AS z
      FROM beam_states b JOIN next_table n ON n.prev = b.tokens[-1] WHERE NOT finished AND step < 6))
  UNION ALL SELECT doc_id, step, beam, tokens, score, len, finished, 2, 0.0 FROM beam_states WHERE finished AND step < 6)
WINDOW best AS (PARTITION BY doc_id ORDER BY (score + logp) / pow(len + 1, 0.6) DESC, beam, token)
QUALIFY row_number() OVER best <= 4"""
_BODIES["beam_decode"] = """
SELECT doc_id, array_to_string(tokens[:coalesce(list_position(tokens, 2), len(tokens))], ',') AS tokens, round(score / pow(len, 0.6), 6) + 0.0 AS final_score
FROM beam_states WHERE step = 6 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score / pow(len, 0.6) DESC, beam) = 1"""
_SEVENTH = "array_to_string([w for w, i in string_split({0}, ' ') if i % 7 <> 0], ' ')"
_CTES["multi_tokens"] = f"SELECT pair_id, h, r, {_bleu_tokens(_SEVENTH.format('ref_text'))} AS q FROM bleu_tokens JOIN (SELECT pair_id, ref_text FROM hypotheses) USING (pair_id)"
_CTES["multi_grams"] = " UNION ALL ".join(
    f"SELECT pair_id, {n} AS n, '{side}' AS side, array_to_string({side}[i:i + {n - 1}], ' ') AS g "
    f"FROM (SELECT pair_id, {side}, unnest(range(1, len({side}) - {n - 2})) AS i FROM multi_tokens)"
    for n in range(1, 5) for side in "hrq"
)
_CTES["multi_counts"] = """
SELECT pair_id, n, sum(least(hc, greatest(rc, qc))) AS correct, sum(hc) AS total FROM (
  SELECT pair_id, n, g, count(*) FILTER (side = 'h') AS hc, count(*) FILTER (side = 'r') AS rc, count(*) FILTER (side = 'q') AS qc FROM multi_grams GROUP BY pair_id, n, g
) GROUP BY pair_id, n"""
_MULTI_COLUMNS = ", ".join(f"CAST(coalesce(max({k}) FILTER (n = {n}), 0) AS BIGINT) AS {k}_{n}" for k in ("correct", "total") for n in range(1, 5))
_CTES["multi_matches"] = f"""
SELECT t.pair_id, {_MULTI_COLUMNS}, CAST(any_value(len(h)) AS BIGINT) AS hyp_len,
  CAST(any_value(CASE WHEN (abs(len(r) - len(h)), len(r)) <= (abs(len(q) - len(h)), len(q)) THEN len(r) ELSE len(q) END) AS BIGINT) AS ref_len
FROM multi_tokens t LEFT JOIN multi_counts c ON c.pair_id = t.pair_id GROUP BY t.pair_id"""
_CTES["multi_bleu"] = _bleu("multi_matches")
_BODIES["corpus_bleu_multi"] = "SELECT * EXCLUDE (bp, geo), round(bp, 6) AS bp, round(bp * geo, 6) AS bleu FROM multi_bleu"
_EDGE = "chr(57344)"
_BODIES["segment_runs"] = f"""
SELECT any_value(pair_id) AS pair_id, replace(regexp_replace(regexp_replace(string_agg(around || CASE WHEN cut IS NULL THEN '' ELSE {_EDGE} || cut || {_EDGE} END, '' ORDER BY i),
  '(^|\\s)' || {_EDGE}, '\\1', 'g'), {_EDGE} || '(\\s|$)', '\\1', 'g'), {_EDGE}, ' ') AS segmented
FROM (SELECT seg_row, pair_id, i, a[i] AS around, r[i] AS run FROM (
  SELECT *, unnest(range(1, len(a) + 1)) AS i FROM (
    SELECT seg_row, pair_id, regexp_split_to_array(t, '{_LETTERS}') AS a, regexp_extract_all(t, '{_LETTERS}') AS r FROM seg_texts)))
LEFT JOIN seg_cut USING (run) GROUP BY seg_row"""
_BODIES["beam_first_step"] = f"""SELECT item_id, CAST(rn - 1 AS INTEGER) AS new_beam, beam AS from_beam, token, {_r('new_score')},
CAST(CASE WHEN token = 2 OR finished THEN len ELSE len + 1 END AS INTEGER) AS new_len
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY new_score DESC, beam, token) AS rn
      FROM (SELECT * REPLACE (CASE WHEN beam = 0 THEN new_score ELSE '-infinity'::DOUBLE END AS new_score) FROM live))
WHERE rn <= 2"""

ORACLES = {key: _with(body) for key, body in _BODIES.items()}
