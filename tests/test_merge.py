"""Dedup, merge, limits and target operators on small fixtures, checked
against brute-force Python versions of the stated rules."""

from pyspark.sql import functions as F

from pricelake.operators import merge as M

ROW = "target_index long, page_seq long, pos long, product string, product_url string, price string"


def rows_df(spark, rows):
    return spark.createDataFrame(rows, ROW)


def brute_first_wins(rows):
    seen, out = set(), []
    for r in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        if r[4]:
            if r[4] in seen:
                continue
            seen.add(r[4])
        out.append(r)
    return sorted(out)


def test_dedup_first_wins(spark):
    rows = [(2, 0, 1, "a", "u1", "1"), (1, 0, 5, "b", "u1", "2"), (1, 0, 6, "c", "", "3"),
            (1, 0, 7, "d", "", "4"), (3, 1, 0, "e", "u2", "5"), (3, 0, 9, "f", "u2", "6")]
    got = sorted(tuple(r) for r in M.dedup_first_wins(rows_df(spark, rows)).collect())
    assert got == brute_first_wins(rows)
    assert M.dedup_first_wins(rows_df(spark, rows), allow_duplicates=True).count() == len(rows)


def test_dedup_same_with_1_and_8_partitions(spark):
    rows = [(i % 5, i % 3, i, f"p{i}", f"u{i % 7}" if i % 4 else "", str(i)) for i in range(200)]
    a = M.dedup_first_wins(rows_df(spark, rows).repartition(1))
    b = M.dedup_first_wins(rows_df(spark, rows).repartition(8, "pos"))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())) == brute_first_wins(rows)


def brute_dia_merge(rows, trim=True):
    """The per-category dict merge, written out."""
    out = []
    for t in sorted({r[0] for r in rows}):
        by_url, by_name, first = {}, {}, {}
        for r in sorted([r for r in rows if r[0] == t], key=lambda r: (r[1], r[2])):
            url, name = r[4].strip(), r[3].strip().lower()
            if url:
                first.setdefault(("u", url), (r[1], r[2]))
                by_url[url] = r
            elif name:
                first.setdefault(("n", name), (r[1], r[2]))
                by_name[name] = r
        used = {(r[3].strip() if trim else r[3]).lower() for r in by_url.values()}
        for k, r in by_url.items():
            f = first[("u", k)]
            out.append((r[0], f[0], f[1], r[3], r[4], r[5], 0))
        for k, r in by_name.items():
            if k not in used:
                f = first[("n", k)]
                out.append((r[0], f[0], f[1], r[3], r[4], r[5], 1))
    return sorted(out)


def test_merge_last_wins(spark):
    rows = [(1, 0, 0, "Leche", "u1", "1"), (1, 0, 1, "Pan", "", "2"), (1, 1, 0, "LECHE ", "u1", "3"),
            (1, 1, 1, " pan", "", "4"), (1, 1, 2, "leche", "", "5"), (1, 2, 0, "", "", "6"),
            (2, 0, 0, "Leche", "", "7"), (2, 0, 1, "Pan", "u1", "8")]
    for trim in (True, False):
        got = M.merge_last_wins(rows_df(spark, rows), trim_used_names=trim)
        cols = ["target_index", "page_seq", "pos", "product", "product_url", "price", "merge_rank"]
        assert sorted(tuple(r) for r in got.select(*cols).collect()) == brute_dia_merge(rows, trim)


def test_first_n_values(spark):
    df = spark.createDataFrame([(0, "A"), (1, "A"), (2, ""), (3, "B"), (4, "C")], "target_index long, category string")
    keep = lambda n: [r.category for r in M.keep_first_n_values(df, "category", n).orderBy("target_index").collect()]
    assert keep(2) == ["A", "A", "B"]
    assert keep(0) == ["A", "A"]
    assert keep(-1) == ["A", "A"]
    assert keep(None) == ["A", "A", "", "B", "C"]


def test_targets_distinct_first_group(spark):
    df = spark.createDataFrame([(0, "g1", "c", "s", "u"), (1, "g2", "c", "s", "u"), (2, "g3", "c", "", "u")],
                               "target_index long, group string, category string, subcategory string, url string")
    got = M.targets_sort(M.targets_distinct(df)).collect()
    assert [(r.group, r.subcategory) for r in got] == [("g1", "s"), ("g3", "")]


def test_fallback_when_childless(spark):
    parents = spark.createDataFrame([("g", "A", "ua"), ("g", "B", "ub")], "group string, category string, url string")
    children = spark.createDataFrame([("g", "A", "a1", "ua1")],
                                     "group string, category string, subcategory string, url string")
    got = sorted(map(tuple, M.fallback_when_childless(parents, children, ["group", "category"]).collect()))
    assert got == [("g", "A", "a1", "ua1"), ("g", "B", "", "ub")]


def test_cap_and_limit(spark):
    rows = [(t, 0, p, "x", f"u{t}{p}", "") for t in (1, 2) for p in range(5)]
    df = rows_df(spark, rows)
    assert M.cap_per_group(df, 2).count() == 4
    assert [r.pos for r in M.limit_total(df, 3).collect()] == [0, 1, 2]
    assert M.limit_total(df, 0).count() == 0


def test_jsonld_gate(spark):
    rows = spark.createDataFrame([(1, 0, "jsonld", "a"), (1, 1, "card", "b"), (1, 1, "jsonld", "c"),
                                  (1, 2, "jsonld", "d"), (2, 0, "jsonld", "e")],
                                 "target_index long, page_seq long, kind string, product_url string")
    got = sorted(r.product_url for r in M.jsonld_gate(rows).collect())
    assert got == ["a", "b", "e"]


def test_jsonld_gate_stops_after_a_jsonld_url(spark):
    rows = spark.createDataFrame([(1, 0, "jsonld", ""), (1, 1, "jsonld", "old"), (1, 1, "jsonld", ""),
                                  (1, 2, "jsonld", "new"), (1, 2, "jsonld", ""), (1, 2, "card", "")],
                                 "target_index long, page_seq long, kind string, product_url string")
    got = sorted((r.page_seq, r.product_url) for r in M.jsonld_gate(rows).where("kind = 'jsonld'").collect())
    assert got == [(0, ""), (1, ""), (1, "old")]


def test_limit_total_selects_like_a_sort(spark):
    import random
    r = random.Random(2)
    rows = [(r.choice([None, 1, 1, 1, 2, 5]), 0, r.randrange(3), i) for i in range(200)]
    df = spark.createDataFrame(rows, "target_index long, merge_rank int, page_seq long, pos long").repartition(5)
    order = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2], x[3]))
    for n in (1, 7, 90, 199, 200, 500):
        assert [tuple(x) for x in M.limit_total(df, n).collect()] == order[:n]
