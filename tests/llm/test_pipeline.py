"""The corpus pipeline against its brute-force version, and the registration of all queries."""

import hashlib
import os
import re
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as E
import corpus_pipeline
from pricelake.llm import langid
from tests.llm.corpus import words
from tests.llm.test_text_dedup import brute_links
from tests.llm.test_text_scan import normal

SF = "/root/testdata/sf0.001"


def corpus():
    shared = " ".join(words("shared", 60))
    rows = []
    for i in range(60):
        text = " ".join(words(i, 40 + i))
        if i % 9 == 0:
            text += " " + shared
        rows.append([i, text, "en", f"src{i % 4}"])
    rows += [[100, rows[3][1], "en", "src1"], [101, rows[3][1] + " tail", None, "src1"], [102, shared, "en", "src2"],
             [103, None, "en", "src0"], [104, "", "en", "src0"], [105, "123 456", "en", "src3"],
             [106, rows[5][1] + " " + " ".join(words("exam", 12)) + " " + rows[6][1], "en", "src0"],
             [107, "Привет мир как дела", None, None], rows[7][:], [None, rows[8][1], "en", "src2"]]
    return [(*r, None if r[1] is None else len(r[1])) for r in rows]


BENCHMARK = " ".join(words("exam", 12))


def brute(rows, rejected):
    rows = [r for r in rows if (r[0], r[1]) not in rejected]
    # near duplicates: the smallest id of each group, repeated rows once; rows
    # without an id link by their texts, and stay only in groups that hold no id
    keys = [r[0] if r[0] is not None else 10**9 + rows.index(r) for r in rows]
    group = {i: c for i, _, c in brute_links([(k, r[1]) for k, r in zip(keys, rows)], 80, 5)}
    seen, kept = set(), []
    for k, r in zip(keys, rows):
        if group[k] == k and (k, r[1]) not in seen:
            seen.add((k, r[1]))
            kept.append(r)
    rows = kept
    # passages
    ws = [(r[1] or "").split() for r in rows]
    count = Counter(tuple(w[k:k + 35]) for w in ws for k in range(len(w) - 34))
    kept = []
    for r, w in zip(rows, ws):
        gone = [False] * len(w)
        for k in range(len(w) - 34):
            if count[tuple(w[k:k + 35])] > 1:
                gone[k:k + 35] = [True] * 35
        if any(gone) and all(gone):
            continue
        text = " ".join(x for x, g in zip(w, gone) if not g) if any(gone) else r[1] or ""
        kept.append((r[0], text, *r[2:]))
    # benchmark
    exam = normal(BENCHMARK)
    windows = {tuple(exam[k:k + 10]) for k in range(3)}
    rows = [r for r in kept if not any(tuple(normal(r[1])[k:k + 10]) in windows for k in range(len(normal(r[1]))))]
    # mix
    size = [len(r[1].split()) for r in rows]
    total, by = sum(size), defaultdict(int)
    for r, n in zip(rows, size):
        by[r[3]] += n
    order = sorted(x for x in by if x is not None) + ([None] if None in by else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    want, open_ = {}, set(by)
    while open_:
        share = (total - sum(want.values())) / sum(weight[s] for s in open_)
        over = [s for s in open_ if share * weight[s] > 3 * by[s]]
        if not over:
            break
        for s in over:
            want[s] = 3.0 * by[s]
            open_.remove(s)
    want |= {s: share * weight[s] for s in open_}
    out = []
    for s in by:
        mine = sorted((hashlib.md5(f"mix:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r, n)
                      for r, n in zip(rows, size) if r[3] == s and n)
        left = int(want[s])
        epoch = 0
        while left > 0:
            for _, r, n in mine:
                take = min(n, left)
                if take:
                    out.append((r[0], r[1] if take == n else " ".join(r[1].split()[:take]), s, epoch))
                left -= take
            epoch += 1
    return sorted(out, key=repr)


def test_pipeline_against_brute_force(spark, tmpdir_path):
    rows = corpus()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    docs.write.parquet(f"{tmpdir_path}/documents.parquet")
    spark.createDataFrame([(1, BENCHMARK)], "item_id long, text string").write.parquet(f"{tmpdir_path}/benchmark.parquet")
    rejected = {(r.doc_id, r.text) for r in langid.predictions(docs).join(docs.select("doc_id", "text"), "doc_id").collect() if r.rejected}
    assert {103, 104, 105} <= {i for i, _ in rejected}
    out = corpus_pipeline.run(spark, tmpdir_path)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "epoch"]
    got = out.collect()
    assert all(r.n_chars == len(r.text) for r in got)
    assert sorted(((r.doc_id, r.text, r.source, r.epoch) for r in got), key=repr) == brute(rows, rejected)


def test_stages_keep_columns_and_take_empty_tables(spark, tmpdir_path):
    docs = spark.createDataFrame([], "part int, doc_id long, n long, text string, lang string, source string, n_chars long, key binary")
    spark.createDataFrame([(1, BENCHMARK)], "item_id long, text string").write.parquet(f"{tmpdir_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, tmpdir_path)
        assert out.columns == docs.columns and out.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, tmpdir_path).count() == 0


def test_extra_columns_travel(spark, tmpdir_path):
    rows = [(k, *r, k * 1.5, f"k{k}") for k, r in enumerate(corpus())]
    docs = spark.createDataFrame(rows, "part int, doc_id long, text string, lang string, source string, n_chars long, n double, key string")
    spark.createDataFrame([(1, BENCHMARK)], "item_id long, text string").write.parquet(f"{tmpdir_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, tmpdir_path)
        assert docs.dtypes[0] == ("part", "int") and [c for c, _ in docs.dtypes][-1] == "key", name
    for r in docs.collect():
        assert rows[r.part][1] == r.doc_id and r.key == f"k{r.part}" and r.n == r.part * 1.5


def test_queries_are_registered():
    names = [n for n in E.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries() and len(corpus_pipeline.STAGES) == 5


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(n for n in E.oracle_sql() if re.match(r"op\d+_", n)))
def test_queries_match_their_sql(spark, name):
    from tests.oracle_harness import compare, duck
    assert compare(spark, duck(SF), SF, name, E.queries()[name], E.oracle_sql()[name])


def test_one_row_of_a_group_stays_without_ids(spark, tmpdir_path):
    a, b, c, d = (" ".join(words(200 + k, 80)) for k in range(4))
    rows = [(5, a, "src1"), (None, a, "src1"), (None, b, "src1"), (None, b, "src2"), (None, b, "src2"), (6, c, "src1"),
            (None, c + " tail", "src1"), (None, d, None), (42, None, "src1"), (7, " ".join(words(300, 80)), "src1")]
    docs = spark.createDataFrame([(i, t, "en", s, t and len(t)) for i, t, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicates(spark, docs, tmpdir_path)
    assert got.columns == docs.columns
    want = [(None, b), (None, d), (42, None), (5, a), (6, c), (7, rows[-1][1])]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(want, key=repr)
    whole = corpus_pipeline.repeated_passages(spark, got, tmpdir_path)
    assert {r.text for r in whole.collect()} >= {a, b, c, d}


def test_pipeline_keeps_a_document_with_a_nameless_copy(spark, tmpdir_path):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmpdir_path}/documents.parquet")
    spark.createDataFrame([(1, BENCHMARK)], "item_id long, text string").write.parquet(f"{tmpdir_path}/benchmark.parquet")
    rejected = {(r.doc_id, r.text) for r in langid.predictions(docs).join(docs.select("doc_id", "text"), "doc_id").collect() if r.rejected}
    got = corpus_pipeline.run(spark, tmpdir_path).collect()
    assert 8 in {r.doc_id for r in got}
    # the nameless row is a copy of document 8, so the result is that of the corpus without it
    want = brute([r for r in rows if r[0] is not None], rejected)
    assert sorted(((r.doc_id, r.text, r.source, r.epoch) for r in got), key=repr) == want
