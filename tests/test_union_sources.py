"""What the union of the four shops costs: side by side runs, facts of plain types, stages computed once."""

import gc
import random
import threading

from tests.test_page_job import PARTS, tree

from pricelake.functions import constants as K
from pricelake.operators import cards as C
from pricelake.plans import daily as D
from pricelake.plans import q_more
from pricelake.sources import html_job as H

TARGETS = "target_index long, category string, subcategory string, url string"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_shops_run_side_by_side(spark, monkeypatch):
    meet = threading.Barrier(4, timeout=60)

    def shop(name):
        def run(session, sf_dir):
            meet.wait()
            return session.sql(f"""SELECT 1L AS target_index, DATE '2025-01-15' AS date, '{name} {sf_dir}' AS product, '' AS brand,
                '' AS price, '' AS price_per_unit, false AS offer, '' AS category, '' AS subcategory, '' AS product_url""")
        return run

    monkeypatch.setattr(q_more, "QUERIES", {n: shop(n) for n in q_more._SHOPS.values()})
    got = [(r.source, r.product) for r in q_more.q_union_sources(spark, "x").collect()]
    assert got == [(source, f"{name} x") for source, name in q_more._SHOPS.items()]


def test_facts_are_of_plain_types(spark):
    pages = spark.createDataFrame([("u", "<p>x</p>")], "url string, html string")
    for source in (None, "dia", "alcampo", "carrefour"):
        kinds = {f.dataType.simpleString() for f in C.page_facts(pages, source).schema.fields}
        assert kinds <= {"string", "int", "array<string>"}, source


def test_gate_reads_written_rows(spark, monkeypatch):
    plans, gate = [], D.M.jsonld_gate
    monkeypatch.setattr(D.M, "jsonld_gate", lambda rows, *a: plans.append(plan(rows)) or gate(rows, *a))
    pages = spark.createDataFrame([("https://c/1", '<li class="product-item"><a href="/p/1">A</a></li>')], "url string, html string")
    targets = spark.createDataFrame([(0, "A", "s", "https://c/1")], TARGETS)
    rows = D.daily_products(targets, pages, "dia", "2025-01-15").collect()
    assert [r.product_url for r in rows] == ["https://www.dia.es/p/1"]
    assert len(plans) == 1 and "FileScan" in plans[0] and "Window" not in plans[0] and "Join" not in plans[0]


def test_mercadona_reads_payloads_once(spark, monkeypatch):
    plans, dedup = [], D.M.dedup_first_wins
    monkeypatch.setattr(D.M, "dedup_first_wins", lambda rows, **k: plans.append(plan(rows)) or dedup(rows, **k))
    payload = '{"categories": [{"name": "l", "products": [{"id": 1, "display_name": "P", "slug": "p"}]}]}'
    pages = spark.createDataFrame([("https://c/1", payload)], "url string, payload string")
    targets = spark.createDataFrame([(0, "A", "s", "https://c/1")], TARGETS)
    assert [r.product for r in D.mercadona_products(targets, pages, "2025-01-15").collect()] == ["P"]
    assert len(plans) == 1 and "FileScan" in plans[0] and "parse_json" not in plans[0]


def test_url_rule_is_evaluated_once(spark):
    facts = D.materialize(C.card_facts(spark.createDataFrame([(1, '<a href="/p/1">A</a>')], "page_id long, html string"), "dia"))
    cards = C.product_cards(facts, "dia")
    assert [r.product_url for r in cards.collect()] == ["https://www.dia.es/p/1"]
    # once for the node's own href and once for its link's
    assert cards._jdf.queryExecution().optimizedPlan().toString().count(f", {K.DIA_PRODUCT_MARKERS[-1]})") == 2


VALUES = ["", "x", "/p/1?a=1&amp;b", "a > b", "a < b", "it's", "&euro;", "&copy=", "é", "0", "1"]


def test_new_values_of_known_tags():
    """Tags that differ from others only in their values build the parser's tree."""
    rnd, plain = random.Random(5), 0
    for _ in range(5000):
        names = [rnd.choice(["href", "class", "CLASS", "data-x", "title", "disabled"]) for _ in range(rnd.randint(0, 3))]
        html = ""
        for _ in range(3):
            html += "<" + rnd.choice(["a", "Li", "img"]) + "".join(
                f" {n}" if n == "disabled" else f' {n}="{rnd.choice(VALUES)}"' for n in names) + rnd.choice([">", "/>", " >"]) + "t</a>"
        fast, want = H._parse_plain(html), H._parse_any(html).root
        if fast is not None:
            plain += 1
            assert [c if isinstance(c, tuple) else tree(c) for c in fast.root.children] == \
                [c if isinstance(c, tuple) else tree(c) for c in want.children], html
    assert plain > 4000


def test_text_of_every_element():
    def below(node):
        for c in node.children:
            if not isinstance(c, tuple):
                yield from below(c)
            elif c[0] == "text" and c[1].strip():
                yield c[1].strip()

    rnd = random.Random(7)
    for _ in range(5000):
        html = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(1, 9)))
        for doc in (H._parse_any(html), H.parse(html)):
            for n in [doc.root, *doc.nodes]:
                assert H.get_text(n) == " ".join(below(n)), html


def test_links_are_not_kept():
    H._TAGS.clear()
    for i in range(500):
        H.parse(f'<div class="c"><a href="/p/{i}" class="x">t</a></div>')
    assert len(H._TAGS) < 10


def test_trees_go_without_the_collector():
    import pandas as pd
    pages = pd.DataFrame({"url": ["u"] * 50, "html": ['<li class="product"><a href="/p/1"><h3>A</h3></a></li>'] * 50})
    job = H.page_facts_job("dia", blocks=True)
    sum(len(x) for x in job([pages]))
    gc.collect()
    gc.disable()
    try:
        sum(len(x) for x in job([pages]))
        assert gc.collect() < 50
    finally:
        gc.enable()


def test_first_title_link_decides(spark):
    """A title link without href leaves the card without a URL, whatever stands behind it."""
    cards = ['<a class="product-card__title-link">A</a><a class="product-card__title-link" href="/x/R-1/p">A</a>',
             '<a class="product-card__media-link" href="/x/R-2/p">B</a>',
             '<a class="product-card__title-link" href="/x/R-3/p">C</a><a class="product-card__media-link" href="/x/R-4/p">C</a>']
    html = "".join(f'<div class="product-card">{c}</div>' for c in cards)
    rows = C.page_products(spark.createDataFrame([(1, html)], "page_id long, html string"), "carrefour").orderBy("node_pos").collect()
    base = "https://www.carrefour.es"
    assert [r.product_url for r in rows] == ["", f"{base}/x/R-2/p", f"{base}/x/R-3/p"]
