"""Driver queries for the whole daily job per shop (J1, U3, P12, W2, A2,
J4, W1, O3, P13 over the page job). Targets and pages come from ``part``:
one category page per part in the shop's markup, plus one target per part
whose page is missing (a failed fetch: no rows)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pricelake.plans import daily as D
from pricelake.plans.q_cards import _ALCAMPO_SQL, _CARREFOUR_SQL, _DIA_SQL, _LD_SQL
from pricelake.plans.q_payload import _expected_sql
from pricelake.plans.registry import query
from pricelake.plans.views import load_view, with_views
from pricelake.session import scratch_path
from pricelake.sources import page_store

RUN_DATE = "2025-01-15"
_OUT = ["target_index", "date", "product", "brand", "price", "price_per_unit", "offer", "category", "subcategory",
        "product_url"]


def _targets(spark, sf_dir, view="cards_html"):
    v = load_view(spark, sf_dir, view)
    real = v.select(F.col("pos").alias("target_index"), F.col("category_label").alias("category"),
                    F.col("leaf").alias("subcategory"),
                    F.concat(F.lit("https://shop.example/c/"), F.col("pos").cast("string")).alias("url"))
    missing = real.select((-1 - F.col("target_index")).alias("target_index"), "category", "subcategory",
                          F.concat(F.lit("https://shop.example/missing/"), F.col("target_index").cast("string"))
                          .alias("url"))
    return real.unionByName(missing)


def _pages(spark, sf_dir, html):
    """Four snapshots of every page: an older one with other prices, the page
    itself, a block page and an error page; the even missing pages have an
    error page only."""
    v = load_view(spark, sf_dir, "cards_html").select("pos", html.alias("html"))
    url = F.concat(F.lit("https://shop.example/c/"), F.col("pos").cast("string"))
    gone = F.concat(F.lit("https://shop.example/missing/"), F.col("pos").cast("string"))
    old = F.replace(F.col("html"), F.lit("€"), F.lit("EUR"))

    def snapshot(u, seq, status, h):
        return F.struct(u.alias("url"), F.lit(seq).alias("snapshot_seq"), F.lit(status).alias("status"), h.alias("html"))

    every = F.array(snapshot(url, 0, 200, old), snapshot(url, 1, 200, F.col("html")),
                    snapshot(url, 2, 200, F.concat(old, F.lit("<p>Access Denied</p>"))), snapshot(url, 3, 404, old))
    every = F.when(F.col("pos") % 2 == 0, F.concat(every, F.array(snapshot(gone, 0, 500, F.col("html"))))) \
        .otherwise(every)
    return v.select(F.explode(every).alias("s")).select("s.*")


def _wrap(sql: str, where: str = "") -> str:
    return f"""SELECT x.page_id AS target_index, DATE '{RUN_DATE}' AS date, x.product, x.brand, x.price,
  x.price_per_unit, x.offer, h.category_label AS category, h.leaf AS subcategory, x.product_url
FROM ({sql}) x JOIN ({with_views('cards_html')} SELECT * FROM cards_html) h ON h.pos = x.page_id {where}"""


# Every tenth Dia page (pos % 10 = 5) has only its ld+json block: those
# rows are used; on the other pages a card with a URL comes first, so the
# JSON-LD rows are not taken (W3). JSON-LD rows with a URL (pos % 3 = 0)
# stay those of the older snapshot, whose unit price has no euro sign.
@query("daily_run_cards_dia", _wrap(_DIA_SQL, "WHERE x.page_id % 10 <> 5") + "\nUNION ALL\n"
       + _wrap(_LD_SQL, "WHERE x.page_id % 10 = 5").replace(
           "x.price_per_unit", "CASE WHEN x.page_id % 3 = 0 THEN '' ELSE x.price_per_unit END AS price_per_unit"))
def q_daily_run_cards_dia(spark, sf_dir):
    pages = _pages(spark, sf_dir, F.when(F.col("pos") % 10 == 5, F.col("html_ld"))
                   .otherwise(F.concat(F.col("html_dia"), F.col("html_ld"))))
    return D.daily_products(_targets(spark, sf_dir), pages, "dia", RUN_DATE).select(*_OUT)


@query("daily_run_alcampo", _wrap(_ALCAMPO_SQL))
def q_daily_run_alcampo(spark, sf_dir):
    pages = _pages(spark, sf_dir, F.col("html_alcampo"))
    return D.daily_products(_targets(spark, sf_dir), pages, "alcampo", RUN_DATE).select(*_OUT)


def _carrefour_sql() -> str:
    """Pages link (rel=next) to the next one in chains of three, so target t
    reads pages t to the end of its chain, and across the run a chain's
    products go to its first page's target (first wins). Pages without cards
    give their product link (blank fields)."""
    cards = _CARREFOUR_SQL.replace("WHERE page_id % 10 NOT IN (5, 7)", "")
    return f"""WITH x AS (
  SELECT * FROM ({cards}) WHERE page_id % 10 NOT IN (5, 7)
  UNION ALL
  SELECT pos AS page_id, '' AS product, '' AS brand, '' AS price, '' AS price_per_unit, false AS offer,
         'https://www.carrefour.es/supermercado/' || slug || '/R-' || cast(pos AS VARCHAR) || '/p' AS product_url
  FROM ({with_views('cards_html')} SELECT * FROM cards_html) WHERE pos % 10 IN (5, 7))
SELECT h.pos AS target_index, DATE '{RUN_DATE}' AS date, x.product, x.brand, x.price,
  x.price_per_unit, x.offer, h.category_label AS category, h.leaf AS subcategory, x.product_url
FROM x JOIN ({with_views('cards_html')} SELECT * FROM cards_html) h ON h.pos = x.page_id - x.page_id % 3"""


@query("daily_run_carrefour", _carrefour_sql())
def q_daily_run_carrefour(spark, sf_dir):
    pages = _pages(spark, sf_dir, F.col("html_carrefour"))
    return D.daily_products(_targets(spark, sf_dir), pages, "carrefour", RUN_DATE).select(*_OUT)


@query("daily_run_carrefour_store", _carrefour_sql())
def q_daily_run_carrefour_store(spark, sf_dir):
    """The Carrefour run from the page store: an earlier day lies beside the
    run's own, which is written twice (the second write replaces the first)."""
    table = f"page_store_{uuid.uuid4().hex[:12]}"
    path = scratch_path(spark, "page-store")
    pages = _pages(spark, sf_dir, F.col("html_carrefour"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    page_store.write_day(pages.withColumn("html", F.lit("")), table, "carrefour", "2025-01-14", buckets, path)
    page_store.write_day(pages.withColumn("html", F.lit("")), table, "carrefour", RUN_DATE, buckets)
    page_store.write_day(pages, table, "carrefour", RUN_DATE, buckets)
    last = page_store.last_pages(spark, table, "carrefour", RUN_DATE)
    return D.daily_products(_targets(spark, sf_dir), last, "carrefour", RUN_DATE, chosen=True).select(*_OUT)


@query("daily_run_mercadona", f"""
SELECT e.pos AS target_index, DATE '{RUN_DATE}' AS date, e.product, e.brand, e.price, e.price_per_unit, e.offer,
       p.category_label AS category, e.subcategory, e.product_url
FROM ({_expected_sql()} SELECT * FROM expected) e
JOIN ({with_views('payload_base')} SELECT * FROM payload_base) p ON p.pos = e.pos
""")
def q_daily_run_mercadona(spark, sf_dir):
    v = load_view(spark, sf_dir, "payload_base")
    url = F.concat(F.lit("https://shop.example/api/"), F.col("pos").cast("string"))
    targets = v.select(F.col("pos").alias("target_index"), F.col("category_label").alias("category"),
                       F.col("category_label").alias("subcategory"), url.alias("url"))
    pages = v.select(url.alias("url"), "payload")
    return D.mercadona_products(targets, pages, RUN_DATE).select(*_OUT)


@query("daily_run_summary_alcampo", f"""
SELECT 'targets' AS metric, 2 * count(*) AS value FROM ({with_views('cards_html')} SELECT * FROM cards_html)
UNION ALL SELECT 'targets_fetched', count(*) FROM ({with_views('cards_html')} SELECT * FROM cards_html)
UNION ALL SELECT 'failed_fetches', count(*) FROM ({with_views('cards_html')} SELECT * FROM cards_html)
UNION ALL SELECT 'rows', count(*) FROM ({_wrap(_ALCAMPO_SQL)})
""")
def q_daily_run_summary_alcampo(spark, sf_dir):
    """A4 + A6 for a run: targets, failed fetches (missing pages), rows."""
    targets = _targets(spark, sf_dir)
    pages = _pages(spark, sf_dir, F.col("html_alcampo"))
    rows = D.daily_products(targets, pages, "alcampo", RUN_DATE)
    return D.run_summary(targets, pages, rows)
