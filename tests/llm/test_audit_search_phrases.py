"""Operators 11 to 13 against brute force."""

import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from pricelake.llm import collocations as C, filter_audit as A, vantage_points as V
from tests.llm.corpus import SCHEMA, documents, texts, words

# ---- 11

LABELS = "doc_id long, quality int, toxic int, part string, first boolean, digest string"


def audit_rows():
    r = random.Random(3)
    rows = list(texts())
    for i in range(30, 90):
        kind = r.randrange(6)
        text = " ".join(words(i, 150 + 20 * kind, 40 if kind % 2 else 4000))
        text += [" A#", "", " $ %", "", "|", ""][kind] + "ABCDEFGHIJ" * r.choice([0, 0, 3, 9])
        rows.append((i, text))
    rows += [(90, rows[40][1]), (7, rows[40][1]), (None, rows[41][1]), (None, None), (91, "ÀÉ" * 300 + "日本🙂 " * 99 + "X"),
             (92, "long" + "x" * 100_000 + " " + "long" + "x" * 100_000 + " long" + "x" * 99_999 + "y")]
    return rows


def brute_audit(rows, langs, labels):
    fails, first = [], {}
    for i, t in rows:
        t = t or ""
        if i is not None:
            first[t] = min(first.get(t, i), i)
    for i, t in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
             "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > first[t]}
        fails.append({k for k, v in f.items() if v})
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out = {}
    for part in {p or "" for p in langs}:
        docs = [(i, f) for (i, _), f, p in zip(rows, fails, langs) if (p or "") == part]
        total = Counter()
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if letter in d[1]]
                left = [d for d in left if letter not in d[1]]
                total[letter] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(letter in f for _, f in docs) - len(gone), sum(f == {letter} for _, f in docs),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), letter]
        for key, v in out.items():
            if key[0] == part:
                v[6] = total[v[6]] if isinstance(v[6], str) else v[6]
    return {k: tuple(v) for k, v in out.items()}


def test_filter_audit(spark):
    rows = audit_rows()
    langs = [["en", "de", None][k % 3] for k in range(len(rows))]
    labels = [(i, i % 2, (i // 2) % 2) for i in range(0, 95, 3)] + [(3, None, 1), (3, 1, None), (None, 1, 1), (500, 1, 1)]
    got = A.audit(documents(spark, rows), spark.createDataFrame([(*x, "p", True, "d") for x in labels], LABELS))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                           "toxic_lost", "shapley"]
    assert dict(got.dtypes)["step"] == "int" and dict(got.dtypes)["shapley"] == "bigint"
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got.collect()}
    assert got == brute_audit(rows, langs, labels)
    assert len(got) == 3 * 600 and any(v[4] for v in got.values()) and any(v[5] for v in got.values())


def test_filter_audit_empty(spark):
    none = spark.createDataFrame([], LABELS)
    assert A.audit(documents(spark, []), none).count() == 0
    got = A.audit(documents(spark, [(1, None)]), none).filter("filter_order = 'EDCBA'").orderBy("step").collect()
    assert [(r.kept, r.removed, r.unique_fails, r.shapley) for r in got] == [(1, 0, 0, 0)] * 4 + [(0, 1, 1, 120)]


def test_span_table_verifies_equal_hashes(monkeypatch):
    data = np.frombuffer(b"aa ab aa abcdefgh1 abcdefgh2 abcdefgh1 aa", np.uint8)
    monkeypatch.setattr(A.T, "word_hashes", lambda d, s, e: np.zeros(len(s), np.uint64))
    counts, starts, ends, row = A.transduce(data, np.array([0, 18, len(data)]))
    assert (ends - starts).tolist() == [2, 2, 2, 9, 9, 9, 2]
    assert A.SpanTable(data, starts, ends, row).per_row(2).tolist() == [3, 3]


# ---- 12

VEC = "vec_id long, embedding array<float>, label int, rank int, score double, q string, leaf int"


def vector_rows():
    r = np.random.default_rng(4)
    centres = r.standard_normal((12, 16))
    x = centres[r.integers(0, 12, 900)] + 0.4 * r.standard_normal((900, 16))
    x *= r.uniform(0.3, 2.5, 900)[:, None]
    rows = [(i, x[i].astype(np.float32).tolist()) for i in range(900)]
    hot = rows[17][1]
    rows += [(i, hot) for i in range(900, 1300)]          # a third are copies
    rows += [(1300, None), (1301, [0.0] * 16), (1302, [None] + hot[1:]), (1303, [float("nan")] + hot[1:]),
             (1304, [float("inf")] + hot[1:]), (1320, []), (None, hot), (1340, [1.0, 2.0]), (1341, [2.0, 2.0]),
             (1360, [1.0, 2.0, 3.0]), rows[40], rows[900]]
    return rows


def brute_nearest(rows, k=20):
    ok = {i: np.array(v, np.float64) for i, v in rows if i is not None and v and None not in v
          and np.isfinite(np.array(v, float)).all() and np.any(v)}
    out = {}
    for i, v in ok.items():
        if i % 20 == 0:
            near = sorted((-float((v * w).sum()), j) for j, w in ok.items() if j != i and len(w) == len(v))[:k]
            out[i] = [(j, -s) for s, j in near]
    return out


def as_table(df):
    out = defaultdict(list)
    for r in df.orderBy("query_id", "rank").collect():
        assert r.rank == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return dict(out)


@pytest.mark.parametrize("shard_bytes, block", [(1 << 21, 2048), (1 << 13, 16)])
def test_factor_one_is_exact(spark, shard_bytes, block):
    rows = vector_rows()
    df = spark.createDataFrame([(i, v, 1, 2, 0.5, "q", 3) for i, v in rows], VEC)
    got = V.nearest(df, factor=1.0, shard_bytes=shard_bytes, block=block, bucket=8, sample=200)
    assert got.columns == ["query_id", "rank", "vec_id", "score"] and dict(got.dtypes)["rank"] == "int"
    want = {q: v for q, v in brute_nearest(rows).items() if v}
    got = as_table(got)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-14)


def test_recall_and_pruning(spark):
    rows = vector_rows()
    df = spark.createDataFrame([(i, v, 1, 2, 0.5, "q", 3) for i, v in rows], VEC)
    got, want = as_table(V.nearest(df, shard_bytes=1 << 13, bucket=8)), brute_nearest(rows)
    found = sum(len({i for i, _ in got[q]} & {i for i, _ in w}) for q, w in want.items() if w)
    assert found >= 0.9 * sum(map(len, want.values()))
    assert V.nearest(df.limit(0)).count() == 0


def test_recall_of_the_given_vectors(spark):
    t = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = as_table(V.nearest(t, shard_bytes=1 << 17))
    want = brute_nearest([(r.vec_id, r.embedding) for r in t.collect()])
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in w}) for q, w in want.items()) >= 0.9 * sum(map(len, want.values()))


def test_a_relaxed_tree_looks_at_less():
    r = np.random.default_rng(1)
    x = r.standard_normal((4000, 4))
    x /= np.sqrt((x * x).sum(1))[:, None]
    tree = V.Tree.build(V.augment(x, 1.0), 64)
    flat = np.concatenate((x[:50], np.zeros((50, 1))), axis=1)
    true = V.distances(flat, V.augment(x[tree.order], 1.0))
    bound = tree.bounds(flat)
    for b in range(64):
        assert (true[:, tree.cuts[b]:tree.cuts[b + 1]] >= bound[:, [b]] - 1e-9).all()
    near = np.sort(true, axis=1)[:, 20]
    assert (bound <= 0.5 * near[:, None]).sum() < (bound <= near[:, None]).sum() < bound.size // 2


# ---- 13

def brute_phrases(rows, langs, least, cover=80, top=2000):
    n, f = Counter(), defaultdict(Counter)
    for (_, t), lang in zip(rows, langs):
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, count in f.items():
        cand = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in cand.items():
            score, cut = min((2_000_000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p)))
            inside = any(len(q) > len(p) and 100 * b >= cover * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                         for q, b in cand.items())
            if not inside:
                rows.append((-score, -a, " ".join(p).encode(), count[p[:cut]], count[p[cut:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def phrase_rows():
    r = random.Random(9)
    vocabulary = [f"W{i}" for i in range(25)] + ["ça", "Été", "日本", "a|b", "x\x0by"]
    rows = list(texts())
    for i in range(100, 260):
        w = [r.choice(vocabulary) + r.choice(["", "", "", ",", ".", " \t"]) for _ in range(r.randrange(0, 90))]
        if i % 3 == 0:
            w[5:5] = "New york city hall NEW YORK".split()
        rows.append((i, " ".join(w)))
    return rows + [(300, "go go go go go go " * 40), (300, "go go go go go go " * 40), (None, "new york\tcity. hall"), (301, "!!"),
                   (302, " ".join(["stop"] * 20_000))]


@pytest.mark.parametrize("sample, top", [(8, 2000), (1, 3), (1000, 2000)])
def test_collocations(spark, sample, top):
    rows = phrase_rows()
    langs = [["en", "de", None][k % 3] for k in range(len(rows))]
    got = C.collocations(documents(spark, rows), min_count=5, sample=sample, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute_phrases(rows, langs, 5, top=top)


def test_expansion_runs_until_the_border_holds_nothing(spark, monkeypatch):
    passes, counts = [], C.counts
    monkeypatch.setattr(C, "counts", lambda *a: passes.append(len(a[1])) or counts(*a))
    rows = phrase_rows()
    langs = [["en", "de", None][k % 3] for k in range(len(rows))]
    # a sample that misses everything: length two is proposed by the full pass, three and four by expansions
    got = C.collocations(documents(spark, rows), min_count=5, sample=1 << 40)
    assert sorted(tuple(r) for r in got.collect()) == brute_phrases(rows, langs, 5)
    assert passes == [1, 2, 3]
    passes.clear()
    C.collocations(documents(spark, rows), min_count=5, sample=1)
    assert passes == [1]


def test_collocations_with_flushes_and_a_small_filter(spark, monkeypatch):
    monkeypatch.setattr(C, "FLUSH", 50)
    monkeypatch.setattr(C, "FILTER_BITS", (64, 64))
    rows = phrase_rows()
    langs = [["en", "de", None][k % 3] for k in range(len(rows))]
    got = C.collocations(documents(spark, rows), min_count=5)
    assert sorted(tuple(r) for r in got.collect()) == brute_phrases(rows, langs, 5)


def test_collocations_empty(spark):
    assert C.collocations(documents(spark, [])).count() == 0
    assert C.collocations(documents(spark, [(1, None), (2, "")])).count() == 0


def test_scores_beyond_64_bits(spark):
    big = 9_000_000_000_000
    row = spark.createDataFrame([(big, big, big)], "a long, l long, r long")
    e = "CAST(a AS DECIMAL(20, 0)) * 2000000BD div (CAST(l AS DECIMAL(20, 0)) + r)"
    assert row.selectExpr(f"{e} AS s").first().s == 1_000_000
