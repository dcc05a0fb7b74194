"""Archives, packing, decontamination and the pipeline."""

import gzip
import itertools
import random
from collections import Counter, defaultdict

import pytest
from hard_words import thue_morse
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from pairweave.llm import decontamination as de, packing, warc
from pairweave.llm.words import by_size, plain
from pairweave.session import rewrite

DATA = "/root/testdata/sf0.001"


# --- archives


@settings(deadline=None)
@given(st.text(max_size=3000), st.integers(4, 40))
def test_chunks_and_segments_round_trip(text, size):
    payload = text.encode()
    framed = warc.chunked(payload, size)
    framed.decode()
    assert warc.unchunked(framed) == payload
    pieces = warc._cuts(framed, size)
    assert b"".join(pieces) == framed and all(len(p) <= size for p in pieces)


def test_broken_chunks_are_found():
    good = warc.chunked(b"some payload")
    for bad in (b"", good[:5], good[:-5], b"zz\r\n", b"-1\r\nx\r\n0\r\n\r\n", b"5\r\nabcdeXX0\r\n\r\n"):
        with pytest.raises(ValueError):
            warc.unchunked(bad)
    assert warc.unchunked(b"3;name=x\r\nabc\r\n0\r\nTrailer: y\r\n\r\n") == b"abc"


def test_segments_in_any_order():
    blocks = [b"aa", b"bb", b"c"]
    for order in itertools.permutations(range(3)):
        args = ([i + 1 for i in order], [5 if i == 2 else None for i in order], [blocks[i] for i in order])
        assert warc.reassemble(*args) == b"aabbc"
    assert warc.reassemble([1, 3], [None, 5], [b"aa", b"c"]) is None
    assert warc.reassemble([1, 2], [None, None], [b"aa", b"c"]) is None
    assert warc.reassemble([1, 2, 2], [None, None, 5], [b"aa", b"bb", b"c"]) is None
    assert warc.reassemble([1, 2], [None, 9], [b"aa", b"c"]) is None


PAGES = [
    (1, "http://a/x y\r\nWARC/1.1", "<p>é日本</p>" * 900), (2, None, "same"), (3, "u", "same"), (3, "u", "same"), (4, "u", None), (None, "u", ""), (None, None, "WARC/1.1\r\n\r\n"),
    (5, "u", "WARC/1.1\r\nContent-Length: 9\r\n\r\nx\r\n\r\n" * 50), (None, "u", "only null id"), (None, "u", "only null id"), (6, "u", "same"),
]


def read_back(spark, pages, tmp_path, **options):
    path = str(tmp_path / "w")
    warc.write_archives(pages, path, **options)
    return path, warc.read_archives(spark, path)


@pytest.mark.parametrize("segment_bytes", [64, 1_000, 1 << 20])
def test_pages_come_back(spark, tmp_path, segment_bytes):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").withColumn("record", F.lit(1))
    _, found = read_back(spark, pages, tmp_path, segment_bytes=segment_bytes, file_records=3)
    rows = found.collect()
    assert all(r.valid for r in rows)
    first = {}
    for i, _, html in sorted(PAGES, key=lambda p: (p[0] is None, p[0] or 0)):
        first.setdefault(html or "", i)
    expected, seen = Counter(), set()
    for i, _, html in PAGES:
        payload, is_first = html or "", first[html or ""] == i and (html or "") not in seen
        if is_first:
            seen.add(payload)
        expected[i, len(payload.encode()), warc.payload_digest(payload.encode()), "response" if is_first else "revisit", None if is_first else first[payload]] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows) == expected


def test_small_payloads_are_never_revisits(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    _, found = read_back(spark, pages, tmp_path, least_bytes=10_000)
    assert found.filter("record_type = 'revisit'").count() == 0


def test_lost_segments_are_reported(spark, tmp_path):
    pages = spark.createDataFrame(PAGES[:1] + PAGES[7:8], "page_id bigint, url string, html string").coalesce(1)
    path, _ = read_back(spark, pages, tmp_path, segment_bytes=500, file_records=10_000)
    content = b"".join(gzip.decompress(bytes(r.content)) for r in spark.read.format("binaryFile").load(path).collect())
    records = list(warc.parse_records(content))
    lost = next(i for i, (f, _) in enumerate(records) if f.get("warc-segment-number") == "3")
    other = tmp_path / "lost"
    other.mkdir()
    kept = [r for i, r in enumerate(records) if i != lost]
    body = b"\r\n\r\n".join(b"WARC/1.1\r\n" + b"\r\n".join(f"{k}: {v}".encode() for k, v in f.items()) + b"\r\n\r\n" + b for f, b in kept)
    (other / "part-0.warc").write_bytes(body + b"\r\n\r\n")
    rows = warc.read_archives(spark, str(other)).collect()
    assert sorted(r.valid for r in rows) == [False, True]
    assert [r.payload_digest for r in rows if not r.valid] == [None]


def test_no_pages(spark, tmp_path):
    assert read_back(spark, spark.createDataFrame([], "page_id bigint, url string, html string"), tmp_path)[1].count() == 0


# --- packing


@settings(deadline=None, max_examples=60)
@given(st.lists(st.tuples(st.integers(1, 60), st.integers(1, 9)), min_size=1, max_size=9, unique_by=lambda t: t[0]), st.integers(1, 5))
def test_boundaries_are_optimal(cells, buckets):
    cells = sorted(cells)
    widths, counts = [w for w, _ in cells], [n for _, n in cells]
    size = lambda ends: sum(n * min(e for e in ends if e >= w) for w, n in cells)
    found = packing.optimal_boundaries(widths, counts, buckets)
    best = min(size([*c, widths[-1]]) for k in range(buckets) for c in itertools.combinations(widths[:-1], min(k, len(widths) - 1)))
    assert len(found) <= buckets and size(found) == best


def test_batches_fit_and_are_full(spark, docs, odd, monkeypatch):
    monkeypatch.setattr(packing, "SLICE_ROWS", 10)
    both = docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    rows = packing.pack(both, buckets=5, budget=2000).collect()
    lengths = Counter((r.doc_id, len((r.text or "").encode().split())) for r in both.collect())
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == lengths
    batches = defaultdict(list)
    for r in rows:
        assert r.n_tokens <= r.width
        batches[r.bucket, r.batch].append(r)
    for members in batches.values():
        assert sorted(r.slot for r in members) == list(range(len(members)))
        assert len(members) == 1 or len(members) * members[0].width <= 2000
    for bucket in {b for b, _ in batches}:
        sizes = [len(batches[k]) for k in sorted(batches) if k[0] == bucket]
        assert sizes[:-1] == [max(1, 2000 // batches[bucket, 0][0].width)] * (len(sizes) - 1)


def test_packing_nothing(empty):
    assert packing.pack(empty).count() == 0


def test_cell_widths(spark):
    for r in spark.range(0, 200_000, 37).select("id", packing.cell_width(F.col("id")).alias("w")).collect():
        assert max(1, r.id) <= r.w <= max(1, r.id * 1.002 + 1)


# --- decontamination


def least_distance(pattern, text):
    """Edit distance of a pattern to the closest run of a text, by the full table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


@settings(deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=90), st.lists(st.integers(0, 4), max_size=120))
def test_bit_parallel_distance(pattern, text):
    assert de.best_match(pattern, text)[0] == least_distance(pattern, text)


def test_pieces_cover_the_item():
    for m in range(5, 90):
        pieces = de.split_pieces(m, de.budget_of(m, 0.8))
        assert len(pieces) == de.budget_of(m, 0.8) + 1 and pieces[0][0] == 0 and pieces[-1][1] == m
        assert all(a[1] == b[0] and a[0] < a[1] for a, b in zip(pieces, pieces[1:]))


def edited(words, k, rng):
    words = list(words)
    for _ in range(k):
        at = rng.randrange(len(words))
        kind = rng.choice("dir")
        words[at : at + (kind != "i")] = [] if kind == "d" else [f"edit{rng.random()}"]
    return words


@pytest.mark.parametrize("block_words", [1_000_000, 40])
def test_items_are_found_within_the_budget(spark, docs, monkeypatch, block_words):
    monkeypatch.setattr(de, "BLOCK_WORDS", block_words)
    rng = random.Random(3)
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()][:12]
    rows = [(r.doc_id, r.text) for r in docs.limit(30).collect()]
    for n, (_, text) in enumerate(bench):
        words = text.split()
        for k in (0, de.budget_of(len(words), 0.8), de.budget_of(len(words), 0.8) + 3):
            rows.append((10_000 + len(rows), " ".join([*rows[n][1].split()[:50], *edited(words, k, rng), *rows[n + 1][1].split()[:50]])))
    items = [*bench, (900, "too few words here"), (None, bench[0][1]), (901, None)]
    expected = set()
    for item, text in items:
        pattern = plain(text).split()
        if len(pattern) >= 5:
            for doc, body in rows:
                distance = least_distance(pattern, plain(body).split())
                if distance <= de.budget_of(len(pattern), 0.8):
                    expected.add((doc, item, distance, len(pattern)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = [(r.doc_id, r.item_id, r.distance, r.item_words) for r in de.find_contamination(df, benchmark).collect()]
    assert set(found) == expected and len(found) == len(expected)
    kept = {r.doc_id for r in de.drop_contaminated(df, benchmark).collect()}
    assert kept == {d for d, _ in rows} - {d for d, *_ in expected}


def test_short_items_match_as_a_line_or_a_document(spark):
    items = spark.createDataFrame([(1, "Yes, indeed."), (2, "two"), (3, "  "), (4, None), (5, "yes indeed")], "item_id bigint, text string")
    texts = ["yes indeed", "We said\nYES -- indeed!\nand left\nyes indeed", "we said yes indeed and left", "two", "", None, "one\ntwo\nthree", "yes\nindeed"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = sorted((r.doc_id, r.item_id, r.distance, r.item_words, r.end_word) for r in de.find_contamination(docs, items).collect())
    both = lambda doc, end: [(doc, 1, 0, 2, end), (doc, 5, 0, 2, end)]
    assert found == [*both(0, 2), *both(1, 4), (3, 2, 0, 1, 1), (6, 2, 0, 1, 2), *both(7, 2)]
    assert {r.doc_id for r in de.drop_contaminated(docs, items).collect()} == {2, 4, 5}


def test_long_words_are_told_apart(spark):
    one, other = thue_morse(11)
    head = "these are some words before it"
    docs = spark.createDataFrame([(1, f"{head} {one}"), (2, f"{head} {other}")], "doc_id bigint, text string")
    found = de.find_contamination(docs, spark.createDataFrame([(1, f"{head} {one}")], "item_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.distance) for r in found) == [(1, 0), (2, 1)]


def test_decontamination_of_odd_rows(spark, odd, empty):
    bench = spark.createDataFrame([(1, " ".join(f"copied{i}" for i in range(40)))], "item_id bigint, text string")
    found = de.find_contamination(odd, bench).collect()
    assert Counter(r.doc_id for r in found) == {1: 1, 2: 2, 3: 1, None: 2, 11: 1}
    assert de.drop_contaminated(odd, bench).columns == odd.columns
    assert de.find_contamination(empty, bench).count() == 0
    assert de.find_contamination(odd, bench.filter("false")).count() == 0


def test_pieces_of_a_batch():
    assert list(by_size([5, 5, 5], 10)) == [(0, 1), (1, 2), (2, 3)]
    assert list(by_size([100, 1, 1], 20)) == [(0, 1), (1, 3)]
    assert list(by_size([])) == []


# --- pipeline


def test_pipeline_stage_by_stage(spark, docs):
    """Each stage against a plain statement of what it keeps."""
    before, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        after, _ = rewrite(stage(spark, before, DATA), name)
        seen[name] = after
        if name != "packing":
            assert after.columns == docs.columns
            assert after.exceptAll(before).count() == 0
        before = after
    rows = lambda name: {r.doc_id: r.text for r in seen[name].collect()}
    toxic, exact, near, clean = (rows(n) for n in ("toxicity", "exact_dedup", "near_duplicates", "decontamination"))
    blank = str.maketrans("", "", " \t\n\x0b\x0c\r")
    groups = defaultdict(list)
    for i, text in toxic.items():
        groups[text.translate(blank)].append((-len(text), i))
    assert set(exact) == {min(g)[1] for g in groups.values()}
    grams = {i: {tuple(t.split()[k : k + 5]) for k in range(max(1, len(t.split()) - 4))} for i, t in exact.items()}
    parent = {i: i for i in grams}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(grams, 2):
        if len(grams[a] & grams[b]) >= 0.8 * len(grams[a] | grams[b]):
            parent[max(root(a), root(b))] = min(root(a), root(b))
    assert set(near) == {i for i in grams if root(i) == i}
    bench = [plain(r.text).split() for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    dirty = {i for i, t in near.items() if any(" ".join(m.decode() for m in b) in " ".join(w.decode() for w in plain(t).split()) for b in bench)}
    assert dirty.isdisjoint(clean) and dirty | set(clean) == set(near)
    assert {r.doc_id for r in seen["packing"].collect()} == set(clean)


def test_run_is_the_stages(spark):
    assert corpus_pipeline.run(spark, DATA).count() > 100


def test_pipeline_of_odd_rows(spark, odd, empty):
    for start in (odd, empty):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs, _ = rewrite(stage(spark, docs, DATA), name)
        assert docs.count() <= start.count()
