"""Exact, substring and near duplicates against brute force, and the odd rows."""

import hashlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from hard_words import thue_morse
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pairweave.llm import exact_dedup as ed, jaccard_join as jj, substring_dedup as sd, words as words_module
from pairweave.llm.components import connected_components
from pairweave.llm.rows import keep_rows
from pairweave.llm.words import words_of

BLANKS = str.maketrans("", "", " \t\n\x0b\x0c\r")


# --- exact


@pytest.mark.parametrize("n", [0, 1, 2, 50, 20_000])
def test_filter_holds_its_keys_and_few_others(n):
    keys = np.random.default_rng(n).integers(0, 2**63, n, dtype=np.uint64)
    built = ed.build_filter(keys)
    assert ed.filter_holds(built, keys).all()
    others = np.random.default_rng(n + 1).integers(0, 2**63, 50_000, dtype=np.uint64)
    assert ed.filter_holds(built, others).mean() < (0.01 if n > 1000 else 0.05)
    assert len(built) < 1.6 * n + 600


@pytest.mark.parametrize("old", ["doc_id % 2 = 0", "true", "false"])
def test_exact_groups(docs, odd, old):
    both = docs.select("doc_id", "text").unionByName(odd.select((F.col("doc_id") + 100_000).alias("doc_id"), "text"))
    part = F.coalesce(F.expr(old), F.lit(False))
    found = ed.exact_dedup(both.filter(part), both.filter(~part)).collect()
    rows = both.collect()
    assert len(found) == len(rows)
    groups = defaultdict(list)
    for r in rows:
        groups[hashlib.sha256((r.text or "").translate(BLANKS).encode()).hexdigest()].append((-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
    for f in found:
        _, last, first = min(groups[f.text_sha256])
        assert f.group_size == len(groups[f.text_sha256])
        assert f.keep_id == (None if last else first)
    assert Counter(f.text_sha256 for f in found if f.kept) == Counter(groups.keys())


def test_exact_empty(empty):
    assert ed.exact_dedup(empty, empty).count() == 0


def test_bytes_decide(spark, tmp_path):
    """A digest that both sides share is only confirmed if the bytes are equal."""
    docs = spark.createDataFrame([(1, "same text"), (2, "other")], "doc_id bigint, text string")
    rows = ed.text_digests(docs).withColumn("copies", F.lit(1))
    ed.build_snapshot(docs, rows, str(tmp_path / "s"))
    exact = spark.read.parquet(str(tmp_path / "s/exact"))
    forged = exact.withColumn("plain", F.when(F.col("plain") == F.lit("other").cast("binary"), F.lit("forged").cast("binary")).otherwise(F.col("plain")))
    forged.write.parquet(str(tmp_path / "f/exact"))
    confirmed = {bytes(r.digest) for r in ed.confirm(docs, rows, rows.select("fp"), str(tmp_path / "f")).collect()}
    assert confirmed == {hashlib.sha256(b"sametext").digest()}


def test_keep_rows_keeps_one_of_rows_alike(odd):
    kept = odd.select("doc_id", F.xxhash64("text").alias("text_hash"))
    rows = keep_rows(odd, kept)
    assert rows.columns == odd.columns
    assert rows.count() == odd.select("doc_id", "text").distinct().count()
    assert {r._row_key for r in rows.collect()} == {"mine"}


def test_a_hot_text_is_compared_once(spark):
    """A text of most rows, in the snapshot and in the batch, with other blanks in some."""
    old = spark.createDataFrame([(i, "hot text") for i in range(40)], "doc_id bigint, text string")
    new = spark.createDataFrame([(100 + i, "hot text" if i % 2 else "hot  text") for i in range(40)] + [(200, "cold")], "doc_id bigint, text string")
    found = {r.doc_id: r for r in ed.exact_dedup(old, new).collect()}
    assert {(r.keep_id, r.group_size) for i, r in found.items() if i < 200} == {(100, 80)}
    assert (found[200].keep_id, found[200].group_size) == (200, 1)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab \n", max_size=300), max_size=6), st.sampled_from([64, 128, 1 << 20]))
def test_words_have_one_hash_each(texts, chunk):
    """Equal words have equal hashes wherever they stand and however they are cut, and others have others."""
    old, words_module._CHUNK = words_module._CHUNK, chunk
    try:
        blob = words_of([t.encode() for t in texts])
        for seed in (0, 1):
            found = dict(zip((blob.blob[a:b] for a, b in zip(blob.starts, blob.ends)), blob.hashes(seed).tolist()))
            assert all(words_of([w]).hashes(seed).tolist() == [h] for w, h in found.items())
            assert len(set(found.values())) == len(found)
    finally:
        words_module._CHUNK = old


@pytest.mark.parametrize("n", [6, 10, 11, 13])
def test_words_that_sums_of_powers_mix_up(n):
    one, other = (w.encode() for w in thue_morse(n))
    for seed in (0, 1):
        hashes = words_of([one, other, one + b"a", b"a" + one]).hashes(seed).tolist()
        assert len(set(hashes)) == 4


# --- substrings


def removed_words(rows, window):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    seen, out = set(), {}
    for i in order:
        words = (rows[i][1] or "").encode().split()
        gone = set()
        for p in range(len(words) - window + 1):
            key = tuple(words[p : p + window])
            if key in seen:
                gone.update(range(p, p + window))
            seen.add(key)
        out[i] = (len(words), len(gone), b" ".join(w for j, w in enumerate(words) if j not in gone).decode())
    return out


@pytest.mark.parametrize("window", [3, 8, 20])
def test_substrings(spark, docs, window):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rows += [(5_000, None), (5_001, ""), (5_002, "a b a b " * 60), (5_003, "x " * 300), (None, rows[3][1]), (5_004, " ".join(rows[5][1].split()[7:90]))]
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in sd.substring_dedup(spark.createDataFrame(rows, "doc_id bigint, text string"), window).collect()}
    expected = {rows[i][0]: v for i, v in removed_words(rows, window).items()}
    assert found == expected


def test_substrings_of_odd_rows(odd, empty):
    found = sd.substring_dedup(odd).collect()
    assert len(found) == odd.count()
    assert {r.doc_id: r.n_removed for r in found if r.doc_id in (12, 13)} == {12: 0, 13: 0}
    copies = [r for r in found if r.n_words == 40]
    assert sorted(r.n_removed for r in copies) == [0, *[40] * (len(copies) - 1)]
    assert all(r.n_removed == 0 and not r.kept_text for r in found if r.n_words == 0)
    assert sd.substring_dedup(empty).count() == 0


def test_a_later_block_answers_an_earlier_one():
    """Whichever block comes first in the file, the smaller id stays."""
    entry = lambda block, doc, pos: {"bucket": 0, "block": block, **{n: sd.planes(np.array([v], t)) for (n, t), v in zip(sd._COLUMNS, (7, 9, doc, 0, pos))}}
    out = sd.earlier_windows(pd.DataFrame([entry(1, 20, 0), entry(2, 10, 5), entry(3, 10, 4)]))
    assert [np.unpackbits(np.frombuffer(b, np.uint8))[0] for b in out["bits"]] == [1, 1, 0]


# --- near duplicates


def brute_links(rows, threshold=0.8, n=5):
    sets = []
    for _, text in rows:
        w = (text or "").encode().split()
        sets.append(frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = Counter()
    for i in range(len(rows)):
        for j in range(i):
            same = sets[i] == sets[j]
            if same or len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9 and sets[i] & sets[j]:
                links[i] += 1
                links[j] += 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [links[i] for i in range(len(rows))], [root(i) for i in range(len(rows))]


def check_join(df):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    links, roots = brute_links(rows)
    found = jj.jaccard_join(df).collect()
    assert len(found) == len(rows)
    classes = defaultdict(list)
    for (i, _), r in zip(rows, roots):
        classes[r].append(i)
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in classes.items()}
    # Rows alike in id have equal results only if they are alike in text; compare as multisets.
    expected = Counter((i, n, least[r]) for (i, _), n, r in zip(rows, links, roots))
    assert Counter((f.doc_id, f.n_links, f.class_id) for f in found) == expected


def test_join_against_all_pairs(spark, docs):
    base = docs.filter("length(text) > 600").select("text").first().text.split()
    near = [(10_000 + i, " ".join(base[: i + 1] + ["changed"] + base[i + 2 :])) for i in range(30)]
    check_join(docs.select("doc_id", "text").unionByName(spark.createDataFrame(near, "doc_id bigint, text string")))


def test_join_of_odd_rows(odd, empty):
    check_join(odd)
    assert jj.jaccard_join(empty).count() == 0


def test_join_in_blocks(spark, monkeypatch):
    """A group larger than a block is compared pair of blocks by pair of blocks, and loses no link."""
    monkeypatch.setattr(jj, "BLOCK_TEXTS", 7)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(base[:i] + [f"new{i}"] + base[i + 1 :])) for i in range(50)]
    check_join(spark.createDataFrame(rows, "doc_id bigint, text string"))


def test_join_with_empty_blocks(spark, monkeypatch):
    """Two long near copies make two blocks; where both hash to one of them, the pair with the empty block counts no link again."""
    monkeypatch.setattr(jj, "BLOCK_GRAMS", 300)
    rows = []
    for k in range(12):
        base = [f"w{k}x{i}" for i in range(200)]
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(base[:9] + ["new"] + base[10:]))]
    found = jj.jaccard_join(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert [(f.doc_id, f.class_id, f.n_links, f.n_texts) for f in sorted(found)] == [(i, i - i % 2, 1, 1) for i in range(24)]


def test_bands_are_the_stated_ones():
    """The README names these numbers."""
    assert jj.choose_bands(0.8, 0.9999) == (18, 4)
    assert "18 bands of 4 minimum hashes" in (Path(__file__).parents[2] / "README.md").read_text()


def test_bands_reach_the_recall():
    bands, rows = jj.choose_bands(0.8, 0.9999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999
    rng = np.random.default_rng(0)
    factors = rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    a = rng.integers(0, 2**64, 900, dtype=np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 2**64, 100, dtype=np.uint64)])
    agree = (jj.minimum_hashes(a, factors) == jj.minimum_hashes(b, factors)).mean()
    assert abs(agree - 0.8) < 0.08


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), min_size=1, max_size=40))
def test_components(spark, edges):
    parent = list(range(31))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert found == {x: root(x) for a, b in edges if a != b for x in (a, b)}
