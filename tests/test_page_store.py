"""The page store: day replaces, the choice of snapshots, and its plan."""

import re
import uuid

import pytest

from pricelake.sources import page_store as S


@pytest.fixture()
def store(spark, tmpdir_path):
    table = f"store_{uuid.uuid4().hex[:10]}"

    def write(rows, day="2025-01-15", shop="dia"):
        df = spark.createDataFrame(rows, "url string, snapshot_seq int, status int, html string")
        S.write_day(df, table, shop, day, 4, f"{tmpdir_path}/store")
        return table

    yield write
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def chosen(spark, table, day="2025-01-15", shop="dia"):
    return sorted((r.url, r.snapshot_seq, r.html) for r in S.last_pages(spark, table, shop, day).collect())


ROWS = [("a", 0, 200, "old"), ("a", 1, 200, "new"), ("a", 2, 404, "gone"), ("a", 3, 200, "x Access Denied"),
        ("b", 0, 200, "b0"), ("c", 0, 500, "error"), ("d", 0, None, "unfinished"), (None, 0, 200, "no url"),
        ("e", 5, 200, "twin 1"), ("e", 5, 200, "twin 2"), ("f", 0, 200, ""), ("g", 1, 200, None), ("h", 0, 403, "h")]
LAST = [("a", 1, "new"), ("b", 0, "b0"), ("e", 5, "twin 1"), ("e", 5, "twin 2"), ("f", 0, "")]


def test_last_good_snapshot(spark, store):
    got = chosen(spark, store(ROWS + [("a", None, 200, "no number")]))
    assert [r for r in got if r[0] != "g"] == LAST
    assert [r for r in got if r[0] == "g"] == [("g", 1, None)]  # a page without html is an empty page


def test_a_day_is_replaced_and_others_stay(spark, store):
    store(ROWS)
    store([("z", 0, 200, "next day")], day="2025-01-16")
    store([("z", 0, 200, "other shop")], shop="alcampo")
    table = store([("b", 7, 200, "again")])
    assert chosen(spark, table) == [("b", 7, "again")]
    assert chosen(spark, table, "2025-01-16") == [("z", 0, "next day")]
    assert chosen(spark, table, shop="alcampo") == [("z", 0, "other shop")]
    assert chosen(spark, table, "2025-01-17") == []


def test_a_bucket_is_one_file(spark, store):
    table = store([(f"u{i}", s, 200, "h") for i in range(50) for s in range(3)])
    files = spark.table(table).inputFiles()
    assert len(files) == 4 and len({re.search(r"_(\d{5})\.", f).group(1) for f in files}) == 4


def test_choice_has_no_exchange(spark, store):
    """Keys are read without html, html is neither shuffled nor sorted, and
    only the day's partition is read."""
    df = S.last_pages(spark, store(ROWS), "dia", "2025-01-15")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" in plan
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert sorted("html" in s for s in scans) == [False, True]
    assert plan.count("PartitionFilters: [isnotnull(shop") == 2
