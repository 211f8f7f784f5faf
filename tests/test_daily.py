"""The daily job's run parameters on a small Al Campo fixture."""

from pricelake.plans import daily as D


def card(slug, n):
    return (f'<div class="product-card-container"><a href="/products/{slug}/{n}"></a>'
            f'<div class="title-container"><h3>P{n}</h3></div><span data-test="fop-price">1,00 €</span></div>')


def fixture(spark):
    pages = spark.createDataFrame([
        ("https://c/1", card("a", 1) + card("a", 2) + card("a", 3)),
        ("https://c/2", card("a", 3) + card("b", 4)),
        ("https://c/3", card("c", 5)),
    ], "url string, html string")
    targets = spark.createDataFrame([
        (0, "A", "s1", "https://c/1"), (1, "A", "s2", "https://c/2"), (2, "B", "s3", "https://c/3"),
        (3, "B", "s4", "https://c/missing"),
    ], "target_index long, category string, subcategory string, url string")
    return targets, pages


def run(spark, **kw):
    t, p = fixture(spark)
    rows = D.daily_products(t, p, "alcampo", "2025-01-15", **kw).orderBy("target_index", "page_seq", "pos")
    return [(r.target_index, r.product) for r in rows.collect()]


def test_defaults_first_wins_across_targets(spark):
    # P3 appears under target 0 first; target 1 keeps only P4; the missing page gives nothing
    assert run(spark) == [(0, "P1"), (0, "P2"), (0, "P3"), (1, "P4"), (2, "P5")]


def test_allow_duplicates(spark):
    assert run(spark, allow_duplicates=True) == [(0, "P1"), (0, "P2"), (0, "P3"), (1, "P3"), (1, "P4"), (2, "P5")]


def test_category_limit(spark):
    assert run(spark, max_categories=1) == [(0, "P1"), (0, "P2"), (0, "P3"), (1, "P4")]


def test_product_cap_and_total_limit(spark):
    # at most two rows per target, then at most two rows in the run
    assert run(spark, max_products=2) == [(0, "P1"), (0, "P2")]


def test_summary(spark):
    t, p = fixture(spark)
    rows = D.daily_products(t, p, "alcampo", "2025-01-15")
    got = {r.metric: r.value for r in D.run_summary(t, p, rows).collect()}
    assert got == {"targets": 4, "targets_fetched": 3, "failed_fetches": 1, "rows": 5}


def test_dia_snapshot_feed(spark):
    ld = '<script type="application/ld+json">{json}</script>'
    dia_card = ('<li class="product-item"><a href="/p/1"><img alt="x"></a><p class="product-name">A</p>'
                '<span class="price">{price} €</span></li>')
    pages = spark.createDataFrame([
        ("https://c/1", 0, ld.format(json='{"name": "L", "url": "/p/9"}')),
        ("https://c/1", 1, dia_card.format(price="1,00") + ld.format(json='{"name": "M"}')),
        ("https://c/1", 2, dia_card.format(price="2,00")),
    ], "url string, snapshot_seq int, html string")
    targets = spark.createDataFrame([(0, "A", "s", "https://c/1")],
                                    "target_index long, category string, subcategory string, url string")
    rows = D.daily_products(targets, pages, "dia", "2025-01-15").orderBy("merge_rank", "page_seq", "pos")
    # L comes from snapshot 0 (before any card URL); M is gated out; A keeps
    # its last price at its first position.
    assert [(r.product, r.price, r.product_url) for r in rows.collect()] == [
        ("L", "", "https://www.dia.es/p/9"), ("A", "2,00", "https://www.dia.es/p/1")]


def test_failed_fetches_give_nothing(spark):
    pages = spark.createDataFrame([
        ("https://c/1", 0, 200, card("a", 1)), ("https://c/1", 1, 404, card("a", 2)),
        ("https://c/2", 0, 200, card("a", 3) + "<p>Access denied</p>"), ("https://c/3", 0, 503, card("a", 4)),
    ], "url string, snapshot_seq int, status int, html string")
    targets, _ = fixture(spark)
    rows = D.daily_products(targets, pages, "alcampo", "2025-01-15")
    assert [(r.target_index, r.product) for r in rows.collect()] == [(0, "P1")]
    got = {r.metric: r.value for r in D.run_summary(targets, pages, rows).collect()}
    assert got == {"targets": 4, "targets_fetched": 1, "failed_fetches": 3, "rows": 1}


def test_carrefour_takes_the_last_snapshot(spark):
    def page(n):
        return (f'<div class="product-card"><a class="product-card__title-link" href="/x/R-{n}/p"></a></div>'
                f'<div class="product-card"><h2 class="product-card__title"><a>no url {n}</a></h2></div>')
    pages = spark.createDataFrame([("https://c/1", 0, page(1)), ("https://c/1", 1, page(2))],
                                  "url string, snapshot_seq int, html string")
    targets = spark.createDataFrame([(0, "A", "s", "https://c/1")],
                                    "target_index long, category string, subcategory string, url string")
    rows = D.daily_products(targets, pages, "carrefour", "2025-01-15").collect()
    assert sorted((r.product, r.product_url) for r in rows) == [
        ("", "https://www.carrefour.es/x/R-2/p"), ("no url 2", "")]
