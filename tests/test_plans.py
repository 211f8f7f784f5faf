"""Physical-plan properties that matter at scale."""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
# The training-data operators have their own tests.
NAMES = sorted(n for n in E.queries() if not re.match(r"op\d+_|pipeline$", n))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_joins(spark, name):
    p = plan(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_first_wins_combines_before_shuffle(spark):
    p = E.queries()["dedup_first_wins"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in p


def test_merge_aggregate_combines_before_shuffle(spark):
    from pyspark.sql import functions as F
    from pricelake.operators import merge as M
    from pricelake.plans.views import load_view
    rows = load_view(spark, SF, "rows_base").withColumn("_k", F.col("product_url"))
    p = plan(M._first_per_key(rows, ["target_index", "_k"], ["page_seq", "pos"], last=True,
                              first_order_name="_first"))
    assert "partial_max" in p and "partial_min" in p


def test_cap_trims_map_side(spark):
    p = plan(E.queries()["cap_per_target"](spark, SF))
    assert p.count("WindowGroupLimit") >= 2


def test_pages_scan_pruned(spark):
    p = plan(E.queries()["links_extract"](spark, SF))
    assert "ReadSchema: struct<page_id:bigint,url:string,html:string>" in p or "struct<page_id" in p


def test_html_is_never_shuffled(spark):
    """With broadcasts off, no exchange of the daily jobs' page stage carries html."""
    from pricelake.operators import cards as C
    from pricelake.plans import daily as D
    pages = spark.createDataFrame([("https://c/1", 0, 200, "<p>x</p>")], "url string, snapshot_seq int, status int, html string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = D.fetched_pages(pages)
        text = plan(D.last_snapshots(C.page_facts(p, "carrefour", anchors=True, bare=True), p))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffled = [line for line in text.splitlines() if "Exchange" in line]
    assert shuffled and not any("html" in line for line in shuffled)
    # the job's input is the only place that reads html, and it stands below no exchange of its own
    assert text.count("MapInPandas") == 1


def test_one_fact_row_per_card_node(spark):
    from pricelake.operators import cards as C
    html = '<article class="product"><div class="product-card"><a href="/p/1"><h3>A</h3></a></div></article>'
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    rows = C.card_facts(pages, "dia").collect()
    assert len({r.node_pos for r in rows}) == len(rows) == 3
