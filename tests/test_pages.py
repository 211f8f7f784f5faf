"""Page job, card rules, JSON-LD, links, payloads and the pagination walk."""

import json

from pyspark.sql import functions as F

from pricelake.operators import cards as C
from pricelake.operators import links as L
from pricelake.operators.pages import page_blocked, page_markers, visible_text
from pricelake.operators.walk import pagination_walk
from pricelake.sources import payloads as PL

ALCAMPO = """<div class="product-card-container"><a href="/products/alpro/123?x=1"></a>
<div class="title-container"><h3>ALPRO Bebida de avena</h3></div>
<span data-test="fop-price">1,85&nbsp;€</span>
<span data-test="fop-price-per-unit">(1,85 €/l)</span></div>"""
DIA = """<li class="product-item"><a href="/lacteos/leche/p/55?y=2"><img alt="x"></a>
<p class="product-name">Leche entera</p><span class="price">1.234,56 €</span>
<span>0,95 €/100 ml</span><em>PROMOCIÓN</em></li>"""
CARREFOUR = """<div class="product-card__parent" app_price="2,10 €" app_price_per_unit="4,20 €/kg"><div class="product-card">
<h2 class="product-card__title"><a class="product-card__title-link" href="/supermercado/arroz/R-1/p">Arroz</a></h2>
<span class="product-card__price">9,99 €</span></div></div>"""


def pages(spark, html):
    return spark.createDataFrame([(1, html)], "page_id long, html string")


def fields(spark, html, source):
    r = C.page_products(pages(spark, html), source).collect()
    return [(x.product, x.brand, x.price, x.price_per_unit, x.offer, x.product_url) for x in r]


def test_cards_per_shop(spark):
    assert fields(spark, ALCAMPO, "alcampo") == [
        ("ALPRO Bebida de avena", "ALPRO", "1,85", "1,85 € / l", False,
         "https://www.compraonline.alcampo.es/products/alpro/123?x=1")]
    assert fields(spark, DIA, "dia") == [
        ("Leche entera", "", "1.234,56", "0,95 € / 100", True, "https://www.dia.es/lacteos/leche/p/55")]
    assert fields(spark, CARREFOUR, "carrefour") == [
        ("Arroz", "", "2,10 €", "4,20 €/kg", False, "https://www.carrefour.es/supermercado/arroz/R-1/p")]


def test_first_productive_selector_and_dedup(spark):
    html = ('<article class="product-a"><h3>no link</h3></article>'
            '<div class="product-card-x"><a href="/p/1"><h3>A</h3></a></div><div class="product-card-x"><a href="/p/1?z"><h3>B</h3></a></div>'
            '<li class="product"><a href="/p/2">C</a></li>')
    got = fields(spark, html, "dia")
    assert [(g[0], g[5]) for g in got] == [("A", "https://www.dia.es/p/1")]


def test_jsonld(spark):
    blocks = [{"@graph": [{"@type": "Product", "name": "A", "url": "/p/1?q", "offers": {"price": 1.5}}]},
              {"itemListElement": [{"item": {"name": "B", "offers": [{"price": "2"}]}}, {"name": "C"}]},
              {"@type": "Organization", "name": "Shop"}]
    html = "".join(f'<script type="application/ld+json">{json.dumps(b)}</script>' for b in blocks)
    html += '<script type="application/ld+json">{bad</script>'
    html += f'<script type="application/ld+json">{json.dumps({"@type": "Product", "name": "A2", "url": "/p/1"})}</script>'
    got = C.jsonld_products(C.jsonld_objects(C.jsonld_blocks(pages(spark, html)))).orderBy("block_pos", "path").collect()
    assert [(r.product, r.price, r.product_url) for r in got] == [
        ("A", "1.5", "https://www.dia.es/p/1"), ("B", "2", ""), ("Shop", "", "")]


def test_links_and_pagination(spark):
    html = ('<a href="/s/a/c?offset=24">1</a><a href="/s/a/c">2</a><a href="/s/b/c?offset=24">3</a>'
            '<a rel="next" href="/else">4</a><A HREF=\'/p/x\'>5</A><a name="x">6</a>')
    df = spark.createDataFrame([(1, html, "https://www.carrefour.es/s/a/c")], "page_id long, html string, cat string")
    got = sorted(r.url for r in L.pagination_links(df, "cat", "https://www.carrefour.es").collect())
    assert got == ["https://www.carrefour.es/else", "https://www.carrefour.es/s/a/c?offset=24"]
    links = L.links_extract(df, "https://www.carrefour.es").orderBy("pos").collect()
    assert [r.url for r in links][-1] == "https://www.carrefour.es/p/x"
    assert len(links) == 5


def test_markers(spark):
    html = "<html><script>captcha</script><p>Introduce tu código postal</p><!-- sin resultados --></html>"
    df = spark.createDataFrame([(1, 200, html), (2, 403, "<p>ok</p>")], "page_id long, status int, html string")
    r = df.select(page_blocked("status", "html").alias("b"), visible_text("html").alias("t")).collect()
    assert [x.b for x in r] == [True, True]
    assert r[0].t == "Introduce tu código postal"
    m = df.select(visible_text("html").alias("t")).select(*[c.alias(k) for k, c in page_markers("t", "dia").items()])
    assert tuple(m.first()) == (True, False, False)


def test_payload_truthiness(spark):
    prods = []
    for i, (pup, pub) in enumerate([(0, None), ("0", None), ("", None), (None, None)]):
        prods.append({"id": i + 1, "display_name": "Refresco Coca Cola zero", "brand": "",
                      "price_instructions": {"bulk_price": 1.5, "reference_price": "1.2", "reference_format": "L",
                                             "previous_unit_price": pup}})
    doc = json.dumps({"categories": [{"name": "Entera", "products": prods}, "x"]})
    df = spark.createDataFrame([(1, doc, "Leche")], "page_id long, payload string, target string")
    flat = PL.flatten_category_payload(df, "payload", keep=("page_id", "target"))
    rows = PL.product_rows(flat, "target").orderBy("prod_pos").collect()
    assert [r.offer for r in rows] == [False, True, False, False]
    assert {(r.brand, r.price, r.price_per_unit, r.subcategory) for r in rows} == {
        ("Coca Cola", "1.5", "1.2 €/L", "Leche / Entera")}
    assert rows[0].product_url == "https://tienda.mercadona.es/product/1"


def test_group_payload_published(spark):
    doc = json.dumps({"results": [{"name": "Frescos", "categories": [
        {"id": 1, "name": "a", "published": False}, {"id": 2, "name": "b", "published": None},
        {"id": 3, "name": "c"}, {"id": 0, "name": "d"}, {"id": 4, "name": ""}]}, {"name": "", "categories": []}]})
    df = spark.createDataFrame([(doc,)], "payload string")
    got = [(r.group, r.subcategory, r.url) for r in PL.flatten_group_payload(df, "payload").collect()]
    assert got == [("frescos", "b", "https://tienda.mercadona.es/api/categories/2/"),
                   ("frescos", "c", "https://tienda.mercadona.es/api/categories/3/")]


def brute_bfs(root, edges, urls, cap=None):
    seen, queue, order = set(), [root], []
    while queue:
        if cap is not None and len(seen) >= cap:
            break
        p = queue.pop(0)
        if p in seen:
            continue
        seen.add(p)
        order.append(p)
        for n in sorted(edges.get(p, []), key=lambda x: urls[x]):
            if n not in seen and n not in queue:
                queue.append(n)
    return order


def test_walk_matches_bfs(spark):
    urls = {i: f"u{(i * 7) % 13:02d}" for i in range(13)}
    edges = {0: [1, 2, 3], 1: [4, 0, 5], 2: [5, 6], 3: [7], 5: [8, 9], 6: [2, 10], 9: [11, 12], 12: [0]}
    e = spark.createDataFrame([(s, d, urls[d]) for s, ds in edges.items() for d in ds], "src_id long, dst_id long, dst_url string")
    roots = spark.createDataFrame([(r, r, urls[r]) for r in (0, 2)], "root_id long, page_id long, url string")
    for cap in (None, 4):
        got = pagination_walk(roots, e, max_pages=cap).orderBy("root_id", "page_seq").collect()
        for r in (0, 2):
            assert [x.page_id for x in got if x.root_id == r] == brute_bfs(r, edges, urls, cap)


def test_walk_down_a_long_chain(spark):
    n = 40
    e = spark.createDataFrame([(i, i + 1, f"u{i + 1}") for i in range(n)], "src_id long, dst_id long, dst_url string")
    roots = spark.createDataFrame([(0, 0, "u0")], "root_id long, page_id long, url string")
    got = pagination_walk(roots, e).orderBy("page_seq").collect()
    assert [(r.page_id, r.depth, r.page_seq) for r in got] == [(i, i, i) for i in range(n + 1)]
    assert set(got[0].asDict()) == {"root_id", "page_id", "url", "depth", "page_seq"}  # nothing that grows with the depth


def test_group_payload_bad_id_fails(spark):
    doc = json.dumps({"results": [{"name": "Frescos", "categories": [{"id": "x1", "name": "a"}]}]})
    df = spark.createDataFrame([(doc,)], "payload string")
    import pytest
    with pytest.raises(Exception):
        PL.flatten_group_payload(df, "payload").collect()


def test_links_skip_comments_scripts(spark):
    html = ('<a title="x>y" href="/z">t</a><!-- <a href="/no"> --><script>var s="<a href=/no2>";</script>'
            '<style>a{}</style><a href=/ok>ok</a>')
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    got = [r.url for r in L.links_extract(df, "https://s.es").orderBy("pos").collect()]
    assert got == ["https://s.es/z", "https://s.es/ok"]


def chain_edges(spark, pairs):
    return spark.createDataFrame([(s, d, f"u{d}") for s, d in pairs], "src_id long, dst_id long, dst_url string")


def test_walk_of_a_long_chain_takes_logarithmic_rounds(spark, monkeypatch):
    import pricelake.operators.walk as W
    written, write = [], W.save_and_reload
    monkeypatch.setattr(W, "save_and_reload", lambda df, name="stage": written.append(name) or write(df, name))
    n = 1000
    e = chain_edges(spark, [(i, i + 1) for i in range(n)])
    roots = spark.createDataFrame([(0, 0, "u0"), (1, 990, "u990")], "root_id long, page_id long, url string")
    got = W.pagination_walk(roots, e).orderBy("root_id", "page_seq").collect()
    assert [(r.page_id, r.url, r.depth, r.page_seq) for r in got if r.root_id == 0] == [(i, f"u{i}", i, i) for i in range(n + 1)]
    assert [r.page_id for r in got if r.root_id == 1] == list(range(990, n + 1))
    assert written.count("walk-jump") <= 13 and "walk-level" not in written


def test_walk_of_chains_rings_and_branches_together(spark):
    chain = [(i, i + 1) for i in range(20)] + [(5, 5)]
    ring = [(100, 101), (101, 102), (102, 103), (103, 104), (104, 102)]
    tree = [(200, 201), (201, 202), (202, 203), (202, 204), (204, 205), (205, 206), (203, 200)]
    to_tree = [(300 + i, 301 + i) for i in range(9)] + [(309, 201)]
    pairs = chain + ring + tree + to_tree + [(0, 1)]
    edges, urls = {}, {}
    for s, d in pairs:
        edges.setdefault(s, []).append(d) if d != s and d not in edges.get(s, []) else None
        urls[s], urls[d] = f"u{s}", f"u{d}"
    starts = [0, 7, 20, 100, 103, 200, 204, 300, 999]
    roots = spark.createDataFrame([(r + 1000, r, f"u{r}") for r in starts], "root_id long, page_id long, url string")
    e = chain_edges(spark, pairs)
    for cap in (None, 1, 4, 0):
        got = pagination_walk(roots, e, max_pages=cap).orderBy("root_id", "page_seq").collect()
        for r in starts:
            mine = [x for x in got if x.root_id == r + 1000]
            assert [x.page_id for x in mine] == brute_bfs(r, edges, urls, cap), (cap, r)
            assert [x.page_seq for x in mine] == list(range(len(mine)))


def test_jsonld_parses_each_block_once(spark):
    """Every level is read from the one written above it: the objects' plan
    holds neither the page job nor the JSON parser."""
    deep = '{"@graph": [' * 6 + '{"name": "x"}' + "]}" * 6
    html = f'<script type="application/ld+json">{deep}</script>'
    objects = C.jsonld_objects(C.jsonld_blocks(pages(spark, html)))
    plan = objects._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" not in plan and "parse_json" not in plan
    assert sorted(len(r.path) for r in objects.collect()) == [0, 1, 2, 3, 4, 5, 6]
