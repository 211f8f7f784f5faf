"""More driver queries: regex product links (H3), Dia category links (H11),
counts (A4), group slice (O4), JSON-LD gate (W3), union of shops (U1), CSV
round trip (S6), text helpers (F15, F16), category ids (P10), page cap (O6)."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from pricelake.functions import constants as K
from pricelake.functions import text as T
from pricelake.functions import urls as U
from pricelake.operators import links as L
from pricelake.operators import merge as M
from pricelake.operators.walk import pagination_walk
from pricelake.plans import discovery as DS
from pricelake.plans import sqlfrag as S
from pricelake.plans.q_daily import q_daily_run_mercadona
from pricelake.plans.q_land import _WALK_SQL, _profile_sql, walk_edges
from pricelake.plans.q_merge import _run_sql
from pricelake.plans.registry import ORACLES, QUERIES, query
from pricelake.plans.views import load_view, read_table, with_views
from pricelake.session import checkpoint_dir, scratch_path
from pricelake.sources import landing as LD

CF = K.BASE_URLS["carrefour"]


# -- H3 ---------------------------------------------------------------------------

def _regex_links_sql(as_written: bool) -> str:
    pats = L.product_link_patterns(CF, as_written)
    parts = []
    for i, p in enumerate(pats):
        parts.append(f"""SELECT pos AS page_id, {i} AS pat, unnest(generate_series(0, len(l) - 1)) AS k, unnest(l) AS m
FROM (SELECT pos, regexp_extract_all(html_carrefour, {S.lit(p)}, 0) AS l FROM cards_html) WHERE len(l) > 0""")
    body = "\nUNION ALL\n".join(parts)
    return with_views("cards_html") + f"""
, found AS ({body}),
u AS (SELECT page_id, pat, k, CASE WHEN starts_with(m, '/') THEN '{CF}' || m ELSE m END AS url FROM found)
SELECT page_id, url FROM (
  SELECT *, row_number() OVER (PARTITION BY page_id, url ORDER BY pat, k) AS rn FROM u) WHERE rn = 1
"""


@query("product_links_regex", _regex_links_sql(False))
def q_product_links_regex(spark, sf_dir):
    pages = load_view(spark, sf_dir, "cards_html").select(F.col("pos").alias("page_id"),
                                                          F.col("html_carrefour").alias("html"))
    return L.product_links_regex(pages, CF).select("page_id", "url")


@query("product_links_regex_as_written", _regex_links_sql(True))
def q_product_links_regex_as_written(spark, sf_dir):
    pages = load_view(spark, sf_dir, "cards_html").select(F.col("pos").alias("page_id"),
                                                          F.col("html_carrefour").alias("html"))
    return L.product_links_regex(pages, CF, as_written=True).select("page_id", "url")


# -- H11 ------------------------------------------------------------------------------

@query("category_links_dia", with_views("nav_dia") + """
SELECT pos AS group_index, leaf AS name, 'https://www.dia.es/' || gs || '/frescos/c/L' || id AS url FROM nav_dia
UNION ALL
SELECT pos, 'L' || id || '3', 'https://www.dia.es/' || gs || '/vacio/c/L' || id || '3' FROM nav_dia
""")
def q_category_links_dia(spark, sf_dir):
    v = load_view(spark, sf_dir, "nav_dia")
    groups = v.select(F.col("pos").alias("group_index"), F.col("group_url").alias("url"), F.col("gs").alias("group"))
    pages = v.select(F.col("group_url").alias("url"), "html")
    return M.links_sort(DS.category_links_dia(groups, pages))


# -- A4 -------------------------------------------------------------------------------

@query("rows_per_category", f"SELECT category, count(*) AS n_rows FROM ({_run_sql()}) GROUP BY category")
def q_rows_per_category(spark, sf_dir):
    from pricelake.plans.q_merge import q_daily_run
    return M.count_rows(q_daily_run(spark, sf_dir), ["category"])


# -- O4 -------------------------------------------------------------------------------

SLICE_N = -7


@query("group_urls_slice", with_views("nav_alcampo") + f"""
SELECT pos AS group_index, group_url AS url FROM nav_alcampo
WHERE pos < (SELECT count(*) FROM nav_alcampo) + ({SLICE_N})
""")
def q_group_urls_slice(spark, sf_dir):
    v = load_view(spark, sf_dir, "nav_alcampo")
    groups = v.select(F.col("pos").alias("group_index"), F.col("group_url").alias("url"))
    return DS.slice_groups(groups, SLICE_N)


# -- W3 -------------------------------------------------------------------------------
# Snapshot rows of each target: status 'O' orders are JSON-LD rows, the rest
# card rows; the order year is the snapshot.

# The oracle replays the loop: a snapshot's JSON-LD rows are taken while no
# snapshot up to it has a card URL and no earlier snapshot has any URL.

@query("jsonld_gate", with_views("rows_base") + """
, r AS (SELECT *, CASE WHEN subcategory = 'O' THEN 'jsonld' ELSE 'card' END AS kind FROM rows_base)
SELECT target_index, page_seq, pos, kind, product_url FROM r
WHERE kind <> 'jsonld' OR NOT EXISTS (
  SELECT 1 FROM (SELECT DISTINCT target_index, page_seq, kind FROM r WHERE product_url <> '') u
  WHERE u.target_index = r.target_index
    AND (u.page_seq < r.page_seq OR (u.page_seq = r.page_seq AND u.kind = 'card')))
""")
def q_jsonld_gate(spark, sf_dir):
    r = load_view(spark, sf_dir, "rows_base").select(
        "target_index", "page_seq", "pos", "product_url",
        F.when(F.col("subcategory") == "O", "jsonld").otherwise("card").alias("kind"))
    return M.jsonld_gate(r).select("target_index", "page_seq", "pos", "kind", "product_url")


# -- U1 -------------------------------------------------------------------------------

_SHOPS = {"dia": "daily_run_cards_dia", "alcampo": "daily_run_alcampo", "carrefour": "daily_run_carrefour",
          "mercadona": "daily_run_mercadona"}


@query("union_sources", "\nUNION ALL\n".join(
    f"SELECT '{shop}' AS source, target_index, date, product, brand, price, price_per_unit, offer, category, "
    f"subcategory, product_url FROM ({ORACLES[name]})" for shop, name in _SHOPS.items()))
def q_union_sources(spark, sf_dir):
    """Runs of the four shops share the product schema: one bag union. A run
    writes its stages one after the other, so the four are planned side by side
    and the tasks of one fill the gaps of the others."""
    cols = ["target_index", "date", "product", "brand", "price", "price_per_unit", "offer", "category",
            "subcategory", "product_url"]
    checkpoint_dir(spark)  # set before it is asked for from several threads
    with ThreadPoolExecutor(len(_SHOPS)) as pool:
        results = pool.map(inheritable_thread_target(spark)(lambda name: QUERIES[name](spark, sf_dir)), _SHOPS.values())
        runs = [r.select(F.lit(shop).alias("source"), *cols) for shop, r in zip(_SHOPS, results)]
    out = runs[0]
    for r in runs[1:]:
        out = out.unionByName(r)
    return out


# -- S6 -------------------------------------------------------------------------------

# Product rows with a count that some rows lack and names that are NA words.

@query("csv_roundtrip", with_views("rows_base") + """
SELECT pos, CASE WHEN subcategory <> 'P' THEN cast(page_seq AS DOUBLE) END AS page_seq, strftime(date, '%Y-%m-%d') AS date,
       CASE WHEN pos % 5 = 0 THEN NULL ELSE trim(product) || ', "x"' END AS product, NULL::DOUBLE AS brand, price, offer,
       CASE WHEN product_url <> '' THEN product_url END AS product_url
FROM rows_base
""")
def q_csv_roundtrip(spark, sf_dir):
    """Rows written as CSV (header, quotes escaped by doubling) and read
    back with the inferred types, NA words and blanks as nulls."""
    path = scratch_path(spark, "csv")
    rows = load_view(spark, sf_dir, "rows_base").select(
        "pos", F.when(F.col("subcategory") != "P", F.col("page_seq")).alias("page_seq"), "date",
        F.when(F.col("pos") % 10 == 0, F.lit("NA")).when(F.col("pos") % 5 == 0, F.lit("None"))
        .otherwise(F.concat(F.trim("product"), F.lit(', "x"'))).alias("product"),
        "brand", "price", "offer", "product_url")
    LD.write_csv(rows, path)
    return LD.read_csv(spark, path)


@query("csv_blocks_roundtrip", """
SELECT cast(doc_id AS VARCHAR) AS doc_id, CASE WHEN text <> '' THEN text END AS text, lang, source FROM documents
""")
def q_csv_blocks_roundtrip(spark, sf_dir):
    """S6 on fields of many lines: documents written as CSV and read back by blocks."""
    path = scratch_path(spark, "csv")
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "source"])
    LD.write_csv(docs.withColumn("text", F.nullif("text", F.lit(""))), path)
    return LD.read_csv_text(spark, path)


# -- F15 / F16 ------------------------------------------------------------------------

@query("event_texts", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ts_iso,
       concat_ws(' ', event_type, props, CASE WHEN event_id % 3 = 0 THEN NULL ELSE cast(user_id AS VARCHAR) END)
         AS joined
FROM events
""")
def q_event_texts(spark, sf_dir):
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "event_type", "props", "user_id"])
    uid = F.when(F.col("event_id") % 3 == 0, F.lit(None)).otherwise(F.col("user_id").cast("string"))
    return e.select("event_id", T.iso_utc("ts").alias("ts_iso"), T.join_text("event_type", "props", uid).alias("joined"))


# -- P10 ------------------------------------------------------------------------------

@query("category_id_from_url", with_views("groups_base") + """
, u AS (SELECT pos, 'https://tienda.mercadona.es/api/categories/' || cid || '/' AS url FROM groups_base
        UNION ALL SELECT pos, 'https://tienda.mercadona.es/api/categories/' || cid FROM groups_base
        UNION ALL SELECT pos, 'https://tienda.mercadona.es/api/categories/x' || cid FROM groups_base)
SELECT pos, url, try_cast(nullif(regexp_extract(url, '/api/categories/([0-9]+)/?$', 1), '') AS BIGINT) AS category_id
FROM u
""")
def q_category_id_from_url(spark, sf_dir):
    g = load_view(spark, sf_dir, "groups_base")
    base = F.concat(F.lit("https://tienda.mercadona.es/api/categories/"), F.col("cid"))
    u = (g.select("pos", U.category_api_url(F.col("cid")).alias("url"))
         .unionByName(g.select("pos", base.alias("url")))
         .unionByName(g.select("pos", F.concat(F.lit("https://tienda.mercadona.es/api/categories/x"), F.col("cid"))
                               .alias("url"))))
    return u.select("pos", "url", U.category_id_from_url("url").alias("category_id"))


# -- O6 -------------------------------------------------------------------------------

PAGE_CAP = 3


@query("page_cap", f"SELECT * FROM ({_WALK_SQL}) WHERE page_seq < {PAGE_CAP}")
def q_page_cap(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages", ["page_id", "url"])
    roots = pages.select(F.col("page_id").alias("root_id"), "page_id", "url")
    out = pagination_walk(roots, walk_edges(pages), max_pages=PAGE_CAP)
    return out.select("root_id", "page_id", "url", F.col("depth").cast("bigint").alias("depth"),
                      F.col("page_seq").cast("bigint").alias("page_seq"))
