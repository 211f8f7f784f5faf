"""Operators 4, 7 and 8 against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pricelake.llm import ngram_join, substring_dedup, suffix_dedup
from pricelake.llm.suffix_sort import COVER, PERIOD, equal_classes
from tests.llm.corpus import documents, rows_of, texts, words

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def sha(data):
    return hashlib.sha256(data).hexdigest()


def brute_windows(rows, width=35):
    ws = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + width]) for w in ws for i in range(len(w) - width + 1))
    out = []
    for (i, _), w in zip(rows, ws):
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if seen[tuple(w[k:k + width])] > 1:
                gone[k:k + width] = [True] * width
        out.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g).encode())))
    return sorted(out, key=repr)


@pytest.mark.parametrize("part_bytes, hot", [(2_000, substring_dedup.HOT), (4 << 20, 2), (2_000, 5)])
def test_substring_dedup(spark, part_bytes, hot):
    got = substring_dedup.remove_repeats(documents(spark), part_bytes=part_bytes, hot=hot)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept_sha256") == brute_windows(texts())


def test_substring_dedup_text_and_carried_columns(spark):
    got = substring_dedup.remove_repeats(documents(spark), with_text=True, carry=("lang", "part", "key"))
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256", "kept", "lang", "part", "key"]
    rows = {(r.doc_id, r.part): r for r in got.collect()}
    assert rows[(14, 13)].kept == texts()[13][1] or rows[(14, 13)].n_removed
    assert rows[(23, 22)].kept is not None and rows[(5, 4)].kept == "" and rows[(10, 9)].kept == "two  words"
    for r in rows.values():
        if r.n_removed:
            assert sha(r.kept.encode()) == r.kept_sha256


def lined(n):
    """A line of 20 words in every document, between words of its own; every
    tenth document has a copy, and a passage of 40 words stands in every third."""
    line, passage = [f"line{k}" for k in range(20)], [f"pass{k}" for k in range(40)]
    rows = []
    for i in range(n):
        own = [f"d{i}w{k}" for k in range(40)]
        text = " ".join(own[:30] + line + own[30:] + (passage if i % 3 == 0 else []))
        rows += [(i, text)] + [(n + i, text)] * (i % 10 == 0)
    return rows


def test_a_hot_line_between_other_words(spark):
    rows = lined(60)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring_dedup.remove_repeats(docs, part_bytes=3_000, hot=8)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept_sha256") == brute_windows(rows)


def test_windows_of_a_hot_line_travel_only_if_they_recur():
    """One part whose every gram is hot: what is sent are the windows said to recur."""
    rows = [r for r in lined(30) if r[0] < 30]
    table = pa.table({"text": pa.array([t.encode() for _, t in rows], pa.binary())})
    runs = substring_dedup._Runs(table, 35, 12)
    n = len(np.unique(runs.keys))
    ones = np.packbits(np.ones(n, bool)).tobytes()
    hot = pa.table({"shard": [0], "bits": [ones], "hot": [ones]})
    cold = pa.table({"shard": [0], "bits": [ones], "hot": [b""]})
    windows = runs.hot_windows(hot, 1)[2]
    keys, counts = np.unique(windows, return_counts=True)
    assert len(windows) == len(runs.win) and counts.max() == 10 and len(runs.hot_windows(cold, 1)[2]) == 0
    said = pa.table({"shard": [0], "bits": [np.packbits(counts > 1).tobytes()], "hot": [b""]})
    lens, _, _, pick, count, _, sent = runs.candidates(hot, said, 1)
    assert (lens == 1).all() and (count == 10).all() and len(pick) == len(np.unique(sent)) == 6
    nothing = pa.table({"shard": [0], "bits": [np.packbits(counts > 99).tobytes()], "hot": [b""]})
    assert len(runs.candidates(hot, nothing, 1)[0]) == 0
    assert len(runs.candidates(cold, said.slice(0, 0), 1)[0]) == len(runs.lens)


def test_locate_needs_two_symbols_for_many_words():
    codes = np.arange(1, 0x80000 + 200, dtype=np.uint64) << np.uint64(24)
    run = codes[-40:]
    every = np.concatenate([codes, run])
    hit = substring_dedup.locate(every, np.array([len(codes), 40]), np.array([0, 0]), 35)
    want = np.zeros(len(every), bool)
    want[len(codes) - 40:len(codes) - 34] = True
    want[len(codes):len(codes) + 6] = True
    assert (hit == want).all()


def brute_bytes(rows, width=50):
    last = 1 << 62
    bs = [(last if i is None else i, (t or "").encode()) for i, t in rows]
    least = {}
    for i, b in bs:
        for k in range(len(b) - width + 1):
            s = b[k:k + width]
            least[s] = min(least.get(s, last + 1), i)
    out = []
    for (i, _), (n, b) in zip(rows, bs):
        gone = bytearray(len(b))
        for k in range(len(b) - width + 1):
            if least[b[k:k + width]] < n:
                gone[k:k + width] = b"\1" * width
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("part_bytes", [2_000, 4 << 20])
def test_suffix_dedup(spark, part_bytes):
    got = suffix_dedup.remove_repeats(documents(spark), part_bytes=part_bytes)
    assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_bytes(texts())


def test_difference_cover_and_equal_classes():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))
    rng = np.random.default_rng(3)
    for letters, bucket in ((1, 5), (2, 100), (3, 1 << 18)):
        b = rng.integers(97, 97 + letters, size=1500).astype(np.uint8)
        starts = np.arange(0, 1450)
        got = equal_classes(b, starts, 50, bucket)
        want = {}
        for c, s in zip(got, starts):
            assert want.setdefault(b[s:s + 50].tobytes(), c) == c
        assert len(set(want.values())) == len(want)


def brute_links(rows, percent=90, shingle=3):
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets.setdefault(i, []).append({tuple(w[k:k + shingle]) for k in range(len(w) - shingle + 1)}
                                      if len(w) >= shingle else {tuple(w)} if w else set())
    nodes = [(i, s) for i, many in sets.items() for s in many if i is not None and s]
    boss = {i: i for i in sets if i is not None}

    def find(i):
        while boss[i] != i:
            i = boss[i]
        return i
    for x, (i, a) in enumerate(nodes):
        for j, b in nodes[x + 1:]:
            if 100 * len(a & b) >= percent * len(a | b):
                lo, hi = sorted((find(i), find(j)))
                boss[hi] = lo
    return sorted(((i, len(s), None if i is None else find(i)) for i, many in sets.items() for s in many), key=repr)


@pytest.mark.parametrize("part_bytes,block,shingle,percent", [(2_000, 2, 3, 90), (4 << 20, 2048, 5, 80)])
def test_ngram_join(spark, part_bytes, block, shingle, percent):
    base = [f"b{k}" for k in range(220)]
    rows = texts()
    for k in range(14):  # a chain of near copies, and near copies that the smallest of them misses
        rows.append((100 + k, " ".join(base[:k * 4] + ["edit"] * (k > 0) + base[k * 4:])))
        rows.append((200 + k, " ".join(base[4 * k:4 * k + 160])))
    rows += [(300 + k, " ".join(f"s{j}" for j in range(11 + k))) for k in range(6)]
    got = ngram_join.link_groups(documents(spark, rows), part_bytes=part_bytes, block=block, shingle=shingle, percent=percent)
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == brute_links(rows, percent, shingle)


@pytest.mark.parametrize("percent", [50, 80, 90, 97])
def test_bands_hold_every_link(percent):
    bands = ngram_join.size_bands(9000, percent)
    for n in range(1, 4000):
        largest = n * 100 // percent
        a, b = np.searchsorted(bands, [n, largest], side="right")
        assert b - a <= 1


def test_bitmap_bound_is_an_upper_bound():
    rng = np.random.default_rng(5)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 62, rng.integers(1, 200), dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 1 << 62, rng.integers(0, 20), dtype=np.uint64)]))
        if len(b):
            x, y = (np.frombuffer(ngram_join.bitmap(v), np.uint8) for v in (a, b))
            size = min(len(x), len(y))
            differ = int(np.bitwise_count(ngram_join.fold(x, size) ^ ngram_join.fold(y, size)).sum())
            assert len(np.intersect1d(a, b)) <= (len(a) + len(b) - differ) // 2


def test_empty_tables(spark):
    none = documents(spark).limit(0)
    assert substring_dedup.remove_repeats(none).count() == 0
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert ngram_join.link_groups(none).count() == 0


def test_rows_that_share_an_id_are_one_node(spark):
    a, b, c = (" ".join(words(f"shared {k}", 60)) for k in range(3))
    cases = [([(1, a), (1, b), (2, a + " x"), (3, b + " y")], {1: 1, 2: 1, 3: 1}),
             ([(0, a), (1, a), (1, b), (2, b)], {0: 0, 1: 0, 2: 0}),
             ([(5, a), (5, b), (5, c), (6, c), (4, b + " z"), (9, "alone here"), (5, None)], {4: 4, 5: 4, 6: 4, 9: 9}),
             ([(7, a), (7, a), (8, "other words")], {7: 7, 8: 8})]
    for rows, want in cases:
        got = ngram_join.link_groups(documents(spark, rows)).collect()
        assert len(got) == len(rows) and {(r.doc_id, r.component_id) for r in got} == set(want.items())
