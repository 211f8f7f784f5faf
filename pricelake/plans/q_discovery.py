"""Driver queries for weekly target discovery (H10, H13, H14, J6, J7, A1,
O1) over navigation pages and menu items built from ``part``."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelake.functions import constants as K
from pricelake.operators import merge as M
from pricelake.plans import discovery as DS
from pricelake.plans import sqlfrag as S
from pricelake.plans.q_merge import _label_case_sql
from pricelake.plans.registry import query
from pricelake.plans.views import load_view, with_views

_T = '"group", category, subcategory, url'
AC = K.BASE_URLS["alcampo"]


def _label(x: str) -> str:
    return f"coalesce({_label_case_sql(x)}, {S.title(f'replace({x}, ' + chr(39) + '-' + chr(39) + ', ' + chr(39) + ' ' + chr(39) + ')')})"


@query("discover_targets_alcampo", with_views("nav_alcampo") + f"""
SELECT url_slug AS "group", {_label('url_slug')} AS category, leaf AS subcategory,
       '{AC}/categories/' || gslug || '/' || id || '/x' AS url FROM nav_alcampo WHERE pos % 5 <> 0
UNION ALL
SELECT url_slug, {_label('url_slug')}, 'Oc' || id, '{AC}/categories/' || gslug || '/OC' || id
FROM nav_alcampo WHERE pos % 5 <> 0
UNION ALL
SELECT url_slug, {_label('url_slug')}, '', group_url FROM nav_alcampo WHERE pos % 5 = 0
""")
def q_discover_targets_alcampo(spark, sf_dir):
    v = load_view(spark, sf_dir, "nav_alcampo")
    groups = v.select(F.col("pos").alias("group_index"), F.col("group_url").alias("url"))
    pages = v.select(F.col("group_url").alias("url"), "html")
    return M.targets_sort(DS.discover_alcampo(groups, pages)).select("group", "category", "subcategory", "url")


def _items(spark, sf_dir):
    v = load_view(spark, sf_dir, "items_dia")
    home = F.lit(K.BASE_URLS["dia"])

    def item(page, seq, title, href):
        return F.struct(page.alias("page_url"), seq.cast("long").alias("seq"), title.cast("string").alias("title"),
                        href.cast("string").alias("href"))

    subs = ~F.col("no_subs")
    rows = F.array(
        item(home, F.col("pos") * 10, F.col("t0"), F.col("cat_href")),
        item(home, F.col("pos") * 10 + 1, F.lit("x"), F.col("junk_href")),
        item(home, F.col("pos") * 10 + 2, F.col("t2"), F.col("cat_href")),
        item(F.col("cat_url"), F.lit(0), F.col("s0_title"), F.when(subs, F.col("s0_href"))),
        item(F.col("cat_url"), F.lit(1), F.lit(""), F.when(subs, F.col("s1_href"))),
        item(F.col("cat_url"), F.lit(2), F.lit("x"), F.when(subs, F.col("s2_href"))))
    return v.select(F.explode(rows).alias("i")).select("i.*").where(F.col("href").isNotNull())


def _dia_label(x: str) -> str:
    return S.initcap_words(S.collapse(f"translate({x}, '-_', '  ')"))


_DIA_SQL = with_views("items_dia") + f"""
, c AS (
  SELECT *, CASE WHEN pos % 6 = 0 THEN {_dia_label("category_part")} ELSE 'Dup ' || leaf END AS cat_name
  FROM (SELECT *, regexp_extract(cat_url, '^https://www.dia.es/([^/]*)/', 1) AS category_part FROM items_dia))
SELECT category_part AS "group", cat_name AS category, leaf || ' sub' AS subcategory,
       'https://www.dia.es' || s0_href AS url FROM c WHERE NOT no_subs
UNION ALL
SELECT category_part, cat_name, 'Otra ' || id, 'https://www.dia.es' || s1_href FROM c WHERE NOT no_subs
UNION ALL
SELECT category_part, cat_name, '', cat_url FROM c WHERE no_subs
"""


@query("discover_targets_dia", _DIA_SQL)
def q_discover_targets_dia(spark, sf_dir):
    return M.targets_sort(DS.discover_dia(_items(spark, sf_dir))).select("group", "category", "subcategory", "url")


CF = K.BASE_URLS["carrefour"]
_NB = "pos % 7 <> 0 AND pos % 9 <> 0"


@query("discover_targets_carrefour", with_views("nav_carrefour") + f"""
SELECT 'bebidas' AS "group", 'Bebidas' AS category, leaf AS subcategory, cat1_url AS url
FROM nav_carrefour WHERE pos % 7 = 0 AND pos % 9 <> 0
UNION ALL SELECT 'bebidas', 'Bebidas', category_label || ' ' || id, cat2_url
FROM nav_carrefour WHERE pos % 7 = 0 AND pos % 9 <> 0
UNION ALL SELECT 'bebidas', 'Bebidas', leaf, '{CF}/supermercado/bebidas/c3-' || id || '/c'
FROM nav_carrefour WHERE pos % 7 = 0 AND pos % 9 <> 0
UNION ALL SELECT gname, leaf, leaf || ' uno', '{CF}/supermercado/' || gname || '/s1-' || id || '/c'
FROM nav_carrefour WHERE {_NB} AND pos % 2 <> 0
UNION ALL SELECT gname, leaf, 'Dos ' || id, '{CF}/supermercado/' || gname || '/s2-' || id || '/c'
FROM nav_carrefour WHERE {_NB} AND pos % 2 <> 0
UNION ALL SELECT gname, leaf, '', cat1_url FROM nav_carrefour WHERE {_NB} AND pos % 2 = 0
UNION ALL SELECT gname, category_label || ' ' || id, '', cat2_url FROM nav_carrefour WHERE {_NB}
""")
def q_discover_targets_carrefour(spark, sf_dir):
    v = load_view(spark, sf_dir, "nav_carrefour")
    groups = v.select(F.col("pos").alias("group_index"), F.col("group_url").alias("url"))
    page = lambda u, h: v.select(F.col(u).alias("url"), F.col(h).alias("html"))
    pages = page("group_url", "group_html").unionByName(page("cat1_url", "cat1_html")) \
        .unionByName(page("cat2_url", "cat2_html")).where(F.col("html").isNotNull())
    return M.targets_sort(DS.discover_carrefour(groups, pages)).select("group", "category", "subcategory", "url")
