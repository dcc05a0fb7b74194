"""Importance resampling: the position-table CRC against zlib, and the draw against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from pairweave.llm import importance as im


def test_crc_of_spans():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 40_000, dtype=np.uint8)
    starts = rng.integers(0, 30_000, 400)
    sizes = np.concatenate([np.arange(1, 201), rng.integers(1, 9_000, 200)])
    found = im.span_crcs(data, starts, starts + sizes)
    assert found.tolist() == [zlib.crc32(data[a : a + n].tobytes()) for a, n in zip(starts.tolist(), sizes.tolist())]


def test_crc_of_spans_longer_than_a_piece(monkeypatch):
    monkeypatch.setattr(im, "PIECE_BYTES", 100)
    data = np.random.default_rng(4).integers(0, 256, 2_000, dtype=np.uint8)
    for size in (1, 99, 100, 101, 200, 777, 2_000):
        starts = np.array([0, 2_000 - size])
        assert im.span_crcs(data, starts, starts + size).tolist() == [zlib.crc32(data[a : a + size].tobytes()) for a in starts.tolist()]


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def features(text, most=1):
    words = WORD.findall(lower(text))
    return [" ".join(words[i : i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aB9é日 .\n\x80Z_", max_size=40), max_size=4), st.integers(1, 3), st.sampled_from([7, 1 << 20]))
def test_features_of_texts(texts, most, piece):
    old, im.PIECE_BYTES = im.PIECE_BYTES, piece
    try:
        found = [Counter() for _ in texts]
        words = [0] * len(texts)
        for first, group in im.hashed_features(texts, most, 10_000):
            for owner, b in zip(group.owner.tolist(), group.bucket.tolist()):
                found[first + owner][b] += 1
            for i, n in enumerate(group.n_words.tolist()):
                words[first + i] += n
    finally:
        im.PIECE_BYTES = old
    assert found == [Counter(map(bucket, features(t, most))) for t in texts]
    assert words == [len(WORD.findall(lower(t))) for t in texts]


def drawn(rows, target, most=1):
    source, wanted = Counter(), Counter()
    for _, text in rows:
        source.update(map(bucket, features(text, most)))
    for text in target:
        wanted.update(map(bucket, features(text, most)))
    s_all, t_all = sum(source.values()), sum(wanted.values())
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * (s_all + 10_000) / ((source[b] + 1) * (t_all + 10_000))))
    out = []
    for doc_id, text in rows:
        found = features(text, most)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(WORD.findall(lower(text)))))
    chosen = [r for r in out if r[4] >= 20]
    order = sorted(chosen, key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))[: len(chosen) * 10 // 100]
    ranks: dict[tuple, list[int]] = {}
    for i, r in enumerate(order, 1):
        ranks.setdefault(r, []).append(i)
    return sorted(((*r[:4], ranks[r].pop(0) if ranks.get(r) else None) for r in out), key=repr)


@pytest.mark.parametrize("most, slice_rows", [(1, 100_000), (1, 3), (2, 100_000)])
def test_draw_of_odd_documents(spark, docs, odd, most, slice_rows):
    copies = spark.createDataFrame([(None, "the same words " * 10)] * 200 + [(7_000 + i // 2, "tie " * 25) for i in range(60)], "doc_id bigint, text string")
    every = docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text")).unionByName(copies)
    target = spark.createDataFrame([("the same words",), (None,), ("",), ("Étrange 日本 words",)], "text string")
    found = im.resample(every, target, max_words=most, slice_rows=slice_rows).collect()
    wanted = drawn([(r.doc_id, r.text) for r in every.collect()], [r.text for r in target.collect()], most)
    assert sorted((tuple(r) for r in found), key=repr) == wanted
    ranks = sorted(r.rank for r in found if r.rank is not None)
    assert ranks == list(range(1, len(ranks) + 1)) and ranks


def test_empty_tables(spark, odd, empty):
    target = empty.select("text")
    assert im.resample(empty, target).collect() == []
    assert len(im.resample(odd, target).collect()) == odd.count()
    few = odd.filter("doc_id = 8")
    assert [r.rank for r in im.resample(few, target).collect()] == [None]
