"""Operators 1, 2, 3, 5 and 6."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest

from pricelake.llm import cotrain, decontaminate, langid, mixing, token_files
from pricelake.llm.queries import PATTERN, VOCABULARY
from tests.llm.corpus import documents, rows_of, texts, words

LOWER = {c: c + 32 for c in range(65, 91)}
NORMAL = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


# ---- 3 ------------------------------------------------------------------------------

ITEMS = [(1, " ".join(words(1, 120)[20:45])), (2, "Two Words!"), (3, None), (4, ""), (None, "ÜNÏ çödé – ﬁn"), (10, "w1 w2"),
         (2, "same same same"), (5, "日本 ünï çödé"), (5, "日本 ünï çödé")]


def items(spark):
    return spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, doc_id string")


def normal(t):
    return NORMAL.findall((t or "").translate(LOWER))


def brute_hits(rows):
    windows = defaultdict(set)
    for i, t in ITEMS:
        w = normal(t)
        k = min(10, len(w))
        for a in range(len(w) - k + 1 if w else 0):
            windows[tuple(w[a:a + k])].add(i)
    out = []
    for i, t in rows:
        w = normal(t)
        hit, found = [False] * len(w), set()
        for win, own in windows.items():
            for a in range(len(w) - len(win) + 1):
                if tuple(w[a:a + len(win)]) == win:
                    hit[a:a + len(win)] = [True] * len(win)
                    found |= own
        ids = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), sum(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), sum(hit) > 0))
    return sorted(out, key=repr)


@pytest.mark.parametrize("automaton_bytes", [150, 8 << 20])
def test_contamination(spark, automaton_bytes):
    hits = decontaminate.contamination(documents(spark), items(spark), automaton_bytes=automaton_bytes)
    got = rows_of(decontaminate.report(hits), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == brute_hits(texts())
    for r in hits.collect():
        text = next(t for i, t in texts() if i == r.doc_id)
        assert sum(len(normal(text[s.start:s.end])) for s in r.char_spans) == r.n_hit
        assert sum(s.last - s["first"] + 1 for s in r.word_spans) == r.n_hit


@pytest.mark.parametrize("automaton_bytes", [150, 8 << 20])
def test_clean_keeps_rows_as_they_are(spark, automaton_bytes):
    docs = documents(spark)
    got = decontaminate.clean(docs, items(spark), automaton_bytes=automaton_bytes)
    want = {i for i, _, h, *_ in brute_hits(texts()) if not h}
    assert got.columns == docs.columns
    assert {r.doc_id for r in got.collect()} == want


def test_contamination_of_and_by_nothing(spark):
    docs, none = documents(spark), items(spark).limit(0)
    assert decontaminate.contamination(docs, none).filter("n_hit > 0").count() == 0
    assert decontaminate.contamination(docs.limit(0), items(spark)).count() == 0
    assert decontaminate.clean(docs, none).count() == docs.count()


# ---- 6 ------------------------------------------------------------------------------

def test_targets_are_shared_by_weight_and_capped(spark):
    sizes = {"a": 1, "b": 500, "c": 2000, "d": 10, None: 30, "É": 0, "Z": 900}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, open_, want = sum(sizes.values()), set(sizes), {}
    while True:
        left = total - sum(want.values())
        w = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / w > 3 * sizes[s]]
        if not over:
            break
        for s in over:
            want[s] = 3.0 * sizes[s]
            open_.remove(s)
    want |= {s: left * weight[s] / w for s in open_}
    assert got.keys() == want.keys()
    for s in want:
        assert got[s] == pytest.approx(want[s], abs=1e-6)
    assert sum(got.values()) == pytest.approx(total)


def test_mix(spark):
    docs = documents(spark)
    runs = [rows_of(mixing.mix(docs.repartition(k), bucket_rows=b), "doc_id", "source", "size", "source_size", "target", "taken")
            for k, b in ((1, 2), (5, 5000))]
    assert runs[0] == runs[1]
    by = defaultdict(list)
    for _, source, size, source_size, target, taken in runs[0]:
        assert 0 <= taken <= 3 * size
        by[source].append((size, source_size, target, taken))
    for rows in by.values():
        assert rows[0][1] == sum(r[0] for r in rows)
        assert sum(r[3] for r in rows) == int(rows[0][2])
    wordy = {(i, len(re.findall("[^\x20\x09-\x0D]+", t or ""))) for i, t in texts()}
    assert {(r[0], r[2]) for r in runs[0]} == wordy


def test_mixed_documents_hold_the_words_they_take(spark):
    docs = documents(spark)
    mixed = mixing.mix(docs)
    out = mixing.mixed_documents(docs, mixed)
    assert out.columns == [c for c in docs.columns if c != "epoch"] + ["epoch"]
    taken, have = defaultdict(int), defaultdict(int)
    for r in mixed.collect():
        taken[r.doc_id] += r.taken
    for r in out.collect():
        have[r.doc_id] += len(r.text.split())
    assert {k: v for k, v in taken.items() if v} == dict(have)


def test_mix_of_nothing(spark):
    docs = documents(spark)
    assert mixing.mix(docs.limit(0)).count() == 0
    assert [r.taken for r in mixing.mix(docs.filter("text IS NULL")).collect()] == [0]


# ---- 2 ------------------------------------------------------------------------------

@pytest.mark.parametrize("block_bytes", [64, 1 << 20])
def test_token_counts(spark, tmpdir_path, block_bytes):
    path = f"{tmpdir_path}/tokens"
    docs = documents(spark)
    token_files.write_token_files(docs, path, VOCABULARY, PATTERN, file_rows=7)
    got = token_files.scan_token_files(spark, path, block_bytes=block_bytes)
    enc = token_files.encoder(VOCABULARY, PATTERN)
    assert rows_of(got, "doc_id", "n_tokens") == sorted(((i, len(enc.encode_ordinary(t or ""))) for i, t in texts()), key=repr)
    for r in rows_of(got.groupBy("file").agg({"ordinal": "max", "file": "count"}), "max(ordinal)", "count(file)"):
        assert r[0] + 1 == r[1]


@pytest.mark.parametrize("block_bytes", [2, 4, 6, 1 << 20])
def test_scan_of_plain_files(spark, tmpdir_path, block_bytes):
    path = f"{tmpdir_path}/plain"
    spark.createDataFrame([(b"\1\0\2\0",), (b"",), (b"",), (b"\x50\0\xc4\0\x50\0\xc4\0",), (b"\7\0",)], "value binary") \
        .coalesce(1).selectExpr("cast(value AS string) AS value").write.option("encoding", "UTF-16LE") \
        .option("lineSep", chr(token_files.END)).text(path)
    got = token_files.scan_token_files(spark, path, with_header=False, block_bytes=block_bytes)
    assert rows_of(got, "ordinal", "doc_id", "n_tokens") == [(0, None, 2), (1, None, 0), (2, None, 0), (3, None, 4), (4, None, 1)]


def test_header_round_trip():
    ids = np.array([0, 1, -1, 1 << 62, -(1 << 63), (1 << 63) - 1, 5])
    known = np.array([True] * 6 + [False])
    head = token_files.header(ids, known)
    assert (head > token_files.END).all()
    back, seen = token_files.unheader(head)
    assert (seen == known).all() and (back[known] == ids[known]).all()


def test_no_documents_no_tokens(spark):
    assert token_files.token_counts(documents(spark).limit(0), VOCABULARY, PATTERN).count() == 0


# ---- 5 ------------------------------------------------------------------------------

SYLLABLES = {"aa": "ka to mi ra ne su".split(), "bb": "zwo krz prt glu vex".split(), "cc": "éa ôu çai ñe".split()}


def speech(lang, seed, n):
    r = np.random.default_rng([seed, len(lang), ord(lang[0])])
    return " ".join("".join(r.choice(SYLLABLES[lang], r.integers(1, 4))) for _ in range(n))


def spoken(spark):
    rows = [(100 * k + i, speech(lang, i, 3 + i % 40), lang) for k, lang in enumerate(SYLLABLES) for i in range(90)]
    rows += [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 34 !?", "cc"), (1003, "Привет мир, как дела", None),
             (1004, speech("cc", 7, 9).upper(), None), (1005, speech("bb", 5, 20_000), None), (None, speech("aa", 3, 30), "aa"),
             (1, speech("aa", 1, 4), "aa")]
    return spark.createDataFrame([(i, t, x, "s", 0.0) for i, t, x in rows], "doc_id long, text string, lang string, source string, score double")


def test_language_id(spark):
    import zlib
    docs = spoken(spark)
    got = langid.predictions(docs)
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    rows = got.collect()
    assert len(rows) == docs.count()
    by = {r.doc_id: r for r in rows}
    for r in rows:
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.lang_pred in {"aa", "bb", "cc", "und"}
    true = {100 * k + i: lang for k, lang in enumerate(SYLLABLES) for i in range(90)}
    held = [by[i].lang_pred == lang for i, lang in true.items() if by[i].held_out]
    assert np.mean(held) > 0.97
    assert [by[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3 and by[1003].lang_pred != "und"
    assert by[1003].rejected and not by[1004].rejected and by[1004].lang_pred == "cc" and by[1005].lang_pred == "bb"
    assert not any(by[i].rejected for i in true)
    again = {r.doc_id: (r.lang_pred, r.score) for r in langid.predictions(docs.repartition(7)).collect()}
    assert all(again[i][0] == by[i].lang_pred and again[i][1] == pytest.approx(by[i].score, abs=1e-4) for i in by)


def test_language_id_rejects_other_languages_and_gibberish(spark):
    import base64
    r = np.random.default_rng(4)
    other = "ban del fit gor hum jis lop nuk pew qad".split()
    rows = [(100 * k + i, speech(lang, i, 30 + i), lang) for k, lang in enumerate(SYLLABLES) for i in range(90)]
    clean = [(1000 + i, speech("aa", 500 + i, 6 + 3 * i), None) for i in range(30)]
    wrong = [(2000 + i, " ".join("".join(r.choice(other, r.integers(1, 4))) for _ in range(40 + i)), None) for i in range(30)]
    wrong += [(3000 + i, "".join(r.choice(list("abcdefghijklmnopqrstuvwxyz    "), 300 + i)), None) for i in range(30)]
    wrong += [(4000 + i, base64.b64encode(r.bytes(200 + i)).decode(), None) for i in range(30)]
    wrong += [(5000 + i, r.bytes(200 + i).hex(), None) for i in range(30)]
    docs = spark.createDataFrame(rows + clean + wrong, "doc_id long, text string, lang string")
    by = {x.doc_id: x for x in langid.predictions(docs).collect()}
    assert not any(by[i].rejected for i, _, _ in clean) and sum(by[i].rejected for i, _, _ in rows) <= 5
    assert np.mean([by[i].rejected for i, _, _ in wrong]) > 0.97


def test_language_id_without_labels(spark):
    docs = spoken(spark)
    assert langid.predictions(docs.limit(0)).count() == 0
    out = langid.predictions(docs.selectExpr("doc_id", "text", "cast(null AS string) AS lang")).collect()
    assert {(r.lang_pred, r.rejected) for r in out} == {("und", True)}


# ---- 1 ------------------------------------------------------------------------------

def test_quality(spark):
    good = [(i, " ".join(words(i, 30 + i % 50)), "en", f"s{i % 3}", 100) for i in range(150)]
    bad = [(500 + i, " | ".join(w + "%%%" for w in words(i, 30 + i % 50)), "en", f"s{i % 3}", 100) for i in range(100)]
    odd = [(900, None, None, None, None), (901, "", "en", "s1", 0), (902, " ".join(words(9, 30_000)), "en", "s1", 5)]
    docs = spark.createDataFrame([(*r, 1) for r in good + bad + odd], "doc_id long, text string, lang string, source string, n_chars long, quality int")
    labels = spark.createDataFrame([(i, int(i < 500)) for i in [*range(60), *range(500, 540)]] + [(1, None), (7777, 0), (2, 1)],
                                   "doc_id long, quality int")
    out = cotrain.score(docs, labels)
    assert out.columns == ["doc_id", "content_score", "meta_score", "score", "keep"]
    rows = {r.doc_id: r for r in out.collect()}
    assert len(rows) == 253
    assert np.mean([rows[i].keep for i in range(60, 150)]) > 0.95 and np.mean([not rows[500 + i].keep for i in range(40, 100)]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows.values())
    assert rows[902].keep


def test_quality_without_both_classes(spark):
    docs = documents(spark)
    one = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    assert {r.score for r in cotrain.score(docs, one).collect()} == {1.0}
    assert {r.score for r in cotrain.score(docs, one.limit(0)).collect()} == {0.5}
    assert cotrain.score(docs.limit(0), one).count() == 0


def test_one_automaton_for_all_batches_of_a_task(spark, tmpdir_path):
    import glob
    import os
    import pyarrow as pa
    from pricelake.llm import decontaminate as D
    built, automaton = [], D.ahocorasick.Automaton

    class Counted:
        def __new__(cls, *a):
            built.append(1)
            return automaton(*a)

    D.ahocorasick.Automaton, old = Counted, D.ahocorasick.Automaton
    try:
        scan = D._scan([("one two three", "i")])
        batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([b"x one two three y"])], names=["doc_id", "text"])
        hits = list(scan(iter([batch] * 9)))
    finally:
        D.ahocorasick.Automaton = old
    assert len(hits) == 9 and len(built) == 1


def test_the_sample_as_a_set_decides(spark):
    rows = [(i, f"{'the cat and dog ' if i % 2 else 'el gato y perro '}{i} " + "abcdefghij"[i % 10] * (i % 7 + 1), "en" if i % 2 else "es")
            for i in range(300)]
    models = []
    for part in (rows, rows[::-1]):
        docs = spark.createDataFrame(part, "doc_id long, text string, lang string").coalesce(1)
        m = langid.learn(docs)
        models.append([np.asarray(x).tolist() for x in (m.idf, *m.centroids, m.limits)])
    assert models[0] == models[1]


@pytest.mark.parametrize("size", [1, 3, 100])
def test_long_texts_count_piece_by_piece(monkeypatch, size):
    rng = np.random.default_rng(3)
    rows = ["".join(rng.choice(list("ab É é×Ö\n"), n)).encode() for n in (0, 1, 2, 3, 40, 900, 0, 5000)]
    data, offsets = np.frombuffer(b"".join(rows), np.uint8), np.cumsum([0, *map(len, rows)])
    whole = langid.counts(data, offsets, 0, len(rows))
    monkeypatch.setattr(langid.T, "CHUNK_BYTES", size)
    monkeypatch.setattr(langid.T.chunks, "__defaults__", (size,))
    assert (langid.counts(data, offsets, 0, len(rows)) == whole).all()
