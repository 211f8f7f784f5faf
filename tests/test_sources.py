"""Targets documents (S1/S2), the daily Parquet sink (S7) and the group slice."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from pricelake.plans import daily as D
from pricelake.plans.discovery import slice_groups
from pricelake.sources import targets as TG


def _doc(targets):
    return {"generated_at_utc": "2025-01-02T03:04:05Z", "source_group_urls": ["u"], "count": 99,
            "targets": targets}


def test_read_single_document(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "t.json")
    t = [{"group": "g", "category": "c", "subcategory": "", "url": "u1", "extra": 1},
         {"group": "g", "category": "d", "subcategory": "s", "url": "u2"}]
    open(p, "w").write(json.dumps(_doc(t), ensure_ascii=False, indent=2))
    rows = TG.read_targets(spark, p).orderBy("target_index").collect()
    assert [(r.target_index, r.category, r.subcategory) for r in rows] == [(0, "c", ""), (1, "d", "s")]


@pytest.mark.parametrize("targets", [[], [{"group": "g", "category": "c", "subcategory": "s"}],
                                     [{"group": "g", "category": "c", "subcategory": "s", "url": None}],
                                     [{"group": "g", "category": "c", "subcategory": "s", "url": 5}]])
def test_invalid_documents_fail(spark, tmpdir_path, targets):
    p = os.path.join(tmpdir_path, "bad.json")
    open(p, "w").write(json.dumps(_doc(targets)))
    with pytest.raises(Exception):
        TG.read_targets(spark, p)


def test_write_then_read_in_order(spark, tmpdir_path):
    df = spark.createDataFrame([("b", "x", "", "u2"), ("a", "y", "s", "u1"), ("a", "x", "", "u3")],
                               "group string, category string, subcategory string, url string")
    path = os.path.join(tmpdir_path, "targets")
    TG.write_targets(df, path, ["g1"], dt.datetime(2025, 1, 2, 3, 4, 5))
    back = TG.read_targets(spark, path).orderBy("target_index").collect()
    assert [(r.group, r.category) for r in back] == [("a", "x"), ("a", "y"), ("b", "x")]
    env = spark.read.json(path + "/_envelope.json").first()
    assert env["count"] == 3 and env["generated_at_utc"] == "2025-01-02T03:04:05Z"
    one = os.path.join(tmpdir_path, "doc.json")
    TG.write_targets_document(df, one, ["g1"], dt.datetime(2025, 1, 2, 3, 4, 5))
    doc = json.loads(spark.read.text(one, wholetext=True).first()[0])
    assert doc["count"] == 3 and doc["targets"][0]["group"] == "a" and doc["generated_at_utc"] == "2025-01-02T03:04:05Z"
    assert [(r.group, r.category) for r in TG.read_targets(spark, one).orderBy("target_index").collect()] == [
        ("a", "x"), ("a", "y"), ("b", "x")]


def test_daily_sink(spark, tmpdir_path):
    rows = spark.createDataFrame(
        [(1, 0, 0, 2, "p2", "", "1", "", False, "c", "s", "u2"), (1, 0, 0, 1, "p1", "", "1", "", True, "c", "s", "u1")],
        "target_index long, merge_rank int, page_seq long, pos long, product string, brand string, price string, "
        "price_per_unit string, offer boolean, category string, subcategory string, product_url string")
    out = D.project(rows, "2025-01-15")
    path = D.write_daily(out, tmpdir_path, "dia", "2025-01-15")
    assert path.endswith("/dia/2025-01-15/dia_supermercado_2025-01-15.parquet")
    back = spark.read.parquet(path)
    assert back.columns == ["date", "product", "brand", "price", "price_per_unit", "offer", "category",
                            "subcategory", "product_url"]
    assert sorted(r.product for r in back.collect()) == ["p1", "p2"]
    assert back.first().date == dt.date(2025, 1, 15)


def test_slice_groups(spark):
    g = spark.createDataFrame([(i, f"u{i}") for i in range(5)], "group_index long, url string")
    assert slice_groups(g, 2).count() == 2
    assert slice_groups(g, 0).count() == 0
    assert sorted(r.url for r in slice_groups(g, -1).collect()) == ["u0", "u1", "u2", "u3"]


def test_document_by_lines_in_many_blocks(spark, tmpdir_path):
    was = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    df = spark.createDataFrame([("g", f"c{i:04d}", 'quo"te\nñ', f"https://x/{i}") for i in range(700)], TG.TARGET_SCHEMA)
    path = f"{tmpdir_path}/targets.json"
    TG.write_targets_document(df, path, ["g1", "g2"], dt.datetime(2025, 1, 2, 3, 4, 5))
    want = sorted(map(tuple, df.collect()))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        got = TG.read_targets(spark, path)
        assert spark.read.text(path).rdd.getNumPartitions() > 10
        assert [tuple(r) for r in got.orderBy("target_index").collect()] == [(i, *t) for i, t in enumerate(want)]
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    # another layout of the same document is read whole
    doc = json.loads("".join(r.value for r in spark.read.text(path, wholetext=True).collect()))
    assert doc["count"] == 700 and len(doc["targets"]) == 700
    with open(f"{tmpdir_path}/other.json", "w") as f:
        json.dump(doc, f, indent=1)
    assert TG.read_targets(spark, f"{tmpdir_path}/other.json").count() == 700
    with open(f"{tmpdir_path}/bad.json", "w") as f:
        f.write('{"count": 1, "targets": [\n{"group": "g", "category": 1}\n]}\n')
    with pytest.raises(Exception):
        TG.read_targets(spark, f"{tmpdir_path}/bad.json")
