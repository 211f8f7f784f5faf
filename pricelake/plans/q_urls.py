"""Driver queries for URL functions and link extraction (P1-P8, P14, P15,
H1-H4) over the ``pages`` table."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelake.functions import constants as K
from pricelake.functions import urls as U
from pricelake.functions.text import fold_text, contains_any
from pricelake.operators import links as L
from pricelake.operators.pages import page_blocked, page_markers, visible_text
from pricelake.plans import sqlfrag as S
from pricelake.plans.registry import query
from pricelake.plans.views import load_view, with_views

N_FORMS = 16
DIA = K.BASE_URLS["dia"]


def _forms(spark, sf_dir):
    v = load_view(spark, sf_dir, "url_forms")
    return v.select("page_id", F.posexplode(F.array(*[F.col(f"f{i}") for i in range(N_FORMS)]))
                    .alias("form_idx", "href")).withColumn("form_idx", F.col("form_idx").cast("bigint"))


_FORMS_SQL = with_views("url_forms") + f"""
, forms AS (
  SELECT page_id, unnest(generate_series(0, {N_FORMS - 1})) AS form_idx,
         unnest([{', '.join(f'f{i}' for i in range(N_FORMS))}]) AS href
  FROM url_forms)
"""


def _norm_sql(h: str, base: str) -> str:
    x = S.strip(h)
    return (f"CASE WHEN starts_with({x}, '//') THEN 'https:' || {x} "
            f"WHEN starts_with({x}, '/') THEN {base} || {x} "
            f"WHEN starts_with({x}, 'http://') OR starts_with({x}, 'https://') THEN {x} END")


def _netloc_sql(u: str) -> str:
    return f"regexp_extract(coalesce({u}, ''), '{U.NETLOC_PATTERN}', 1)"


def _path_sql(u: str) -> str:
    return f"regexp_replace(regexp_extract(coalesce({u}, ''), '{U.PATH_PATTERN}', 1), ';[^/]*$', '')"


def _raw_segs_sql(u: str) -> str:
    return f"list_filter(string_split({_path_sql(u)}, '/'), lambda s: s <> '')"


def _segs_sql(u: str) -> str:
    return f"list_transform({_raw_segs_sql(u)}, lambda s: {S.unquote('s')})"


# -- P1 / P2 ----------------------------------------------------------------------

@query("url_normalize", _FORMS_SQL + f"""
SELECT page_id, form_idx, href, {_norm_sql('href', S.lit(DIA))} AS url,
       regexp_replace({_norm_sql('href', S.lit(DIA))}, '[?#].*$', '') AS clean_url
FROM forms""")
def q_url_normalize(spark, sf_dir):
    f = _forms(spark, sf_dir)
    n = U.url_normalize("href", DIA)
    return f.select("page_id", "form_idx", "href", n.alias("url"), U.url_clean(n).alias("clean_url"))


@query("url_clean", f"SELECT page_id, regexp_replace(url, '[?#].*$', '') AS clean_url FROM pages")
def q_url_clean(spark, sf_dir):
    p = load_view(spark, sf_dir, "pages_base")
    return p.select("page_id", U.url_clean("url").alias("clean_url"))


# -- P3 -------------------------------------------------------------------------

@query("url_segments", _FORMS_SQL + f"""
, n AS (SELECT page_id, form_idx, {_norm_sql('href', S.lit(DIA))} AS url FROM forms),
s AS (SELECT page_id, form_idx, {_segs_sql('url')} AS segs FROM n WHERE url IS NOT NULL)
SELECT page_id, form_idx, unnest(generate_series(0, len(segs) - 1)) AS seg_index, unnest(segs) AS segment
FROM s WHERE len(segs) > 0
""")
def q_url_segments(spark, sf_dir):
    f = _forms(spark, sf_dir).select("page_id", "form_idx", U.url_normalize("href", DIA).alias("url"))
    return (f.where(F.col("url").isNotNull())
            .select("page_id", "form_idx", F.posexplode(U.url_segments("url")).alias("seg_index", "segment"))
            .withColumn("seg_index", F.col("seg_index").cast("bigint")))


# -- P4 / P5 / P6 / P7 ------------------------------------------------------------

def _pred_sql(u: str) -> str:
    host = _netloc_sql(u)
    path = f"lower({_path_sql(u)})"
    prod_dia = (f"({u} <> '' AND ({host} = '' OR contains({host}, {S.lit(K.DIA_HOST)})) AND "
                f"{S.contains_any(path, K.DIA_PRODUCT_MARKERS)})")
    cat_dia = (f"({u} <> '' AND NOT {prod_dia} AND ({host} = '' OR contains({host}, {S.lit(K.DIA_HOST)})) AND "
               f"(contains({path}, '/compra-online') OR {S.contains_any(path, K.DIA_CATEGORY_MARKERS)}))")
    return (f"contains({u}, '/p') AS prod_carrefour, "
            f"(contains({u}, '/products/') AND ({host} = '' OR contains({host}, {S.lit(K.ALCAMPO_HOST)}))) "
            f"AS prod_alcampo, {prod_dia} AS prod_dia, contains({u}, '/c') AS cat_carrefour, {cat_dia} AS cat_dia")


def _slug_sql(u: str) -> str:
    raw = _raw_segs_sql(u)
    segs = _segs_sql(u)
    co = f"list_position({segs}, 'compra-online')"
    c = f"list_position({segs}, 'c')"
    dia = (f"CASE WHEN coalesce({co}, 0) > 0 THEN CASE WHEN {co} < len({segs}) THEN {segs}[{co} + 1] "
           f"ELSE 'compra-online' END "
           f"WHEN coalesce({c}, 0) > 1 THEN {segs}[{c} - 1] "
           f"WHEN coalesce({c}, 0) = 1 AND len({segs}) > 1 THEN {segs}[2] "
           f"WHEN len({segs}) > 0 THEN {segs}[-1] ELSE '' END")
    carrefour = f"CASE WHEN len({raw}) >= 2 AND {raw}[1] = 'supermercado' THEN {raw}[2] ELSE '' END"
    alcampo = f"CASE WHEN len({raw}) >= 2 AND {raw}[1] = 'categories' THEN {S.unquote(f'{raw}[2]')} ELSE '' END"
    return f"{carrefour} AS slug_carrefour, {alcampo} AS slug_alcampo, {dia} AS slug_dia"


def _level_sql(u: str) -> str:
    segs = _segs_sql(u)
    n = f"len({segs})"
    cat = f"({n} = 3 AND {segs}[2] = 'c' AND regexp_matches({segs}[3], '^[Ll][0-9]+$'))"
    sub = f"({n} >= 4 AND {segs}[-2] = 'c' AND regexp_matches({segs}[-1], '^[Ll][0-9]+$'))"
    return f"CASE WHEN {cat} THEN 'category' WHEN {sub} THEN 'subcategory' ELSE '' END AS menu_level"


@query("url_predicates", _FORMS_SQL + f"""
, n AS (SELECT page_id, form_idx, {_norm_sql('href', S.lit(DIA))} AS url FROM forms)
SELECT page_id, form_idx, url, {_pred_sql('url')}, {_slug_sql('url')}, {_level_sql('url')}
FROM n WHERE url IS NOT NULL
""")
def q_url_predicates(spark, sf_dir):
    f = _forms(spark, sf_dir).select("page_id", "form_idx", U.url_normalize("href", DIA).alias("url"))
    u = F.col("url")
    return f.where(u.isNotNull()).select(
        "page_id", "form_idx", "url",
        U.is_product_url(u, "carrefour").alias("prod_carrefour"),
        U.is_product_url(u, "alcampo").alias("prod_alcampo"),
        U.is_product_url(u, "dia").alias("prod_dia"),
        U.is_category_url(u, "carrefour").alias("cat_carrefour"),
        U.is_category_url(u, "dia").alias("cat_dia"),
        U.group_slug(u, "carrefour").alias("slug_carrefour"),
        U.group_slug(u, "alcampo").alias("slug_alcampo"),
        U.group_slug(u, "dia").alias("slug_dia"),
        U.dia_menu_level(u).alias("menu_level"))


# -- H1 / H2 / H4 -----------------------------------------------------------------

# The driver pages write their anchors as <a href="...">text</a>, outside of
# scripts and comments: the oracle cuts exactly that form.
_TAGS_SQL = with_views("pages_base") + f"""
, t0 AS (SELECT page_id, origin, regexp_extract_all(html, '<a href="([^"]*)">', 1) AS l FROM pages_base),
hrefs AS (SELECT page_id, origin, unnest(generate_series(0, len(l) - 1)) AS pos, unnest(l) AS href FROM t0 WHERE len(l) > 0),
links AS (SELECT page_id, pos, {_norm_sql("replace(href, '&amp;', '&')", 'origin')} AS url FROM hrefs)
"""

# Links of the Carrefour fixture pages, from the columns their markup was built of.
_CARD_LINKS_SQL = with_views("cards_html") + """
, links AS (
  SELECT pos AS page_id, 'https://shop.example/c/' || cast(pos + 1 AS VARCHAR) AS url FROM cards_html WHERE pos % 3 < 2
  UNION ALL
  SELECT pos, 'https://shop.example/c/' || cast(pos AS VARCHAR) || '?a=1&página=2' FROM cards_html)
"""


def _card_pages(spark, sf_dir):
    v = load_view(spark, sf_dir, "cards_html")
    return v.select(F.col("pos").alias("page_id"), F.col("html_carrefour").alias("html"),
                    F.concat(F.lit("https://shop.example/c/"), F.col("pos").cast("string")).alias("page_url"))


@query("links_extract", _TAGS_SQL + "SELECT page_id, pos, url FROM links WHERE url IS NOT NULL")
def q_links_extract(spark, sf_dir):
    p = load_view(spark, sf_dir, "pages_base")
    return L.links_extract(p, "origin").select("page_id", F.col("pos").cast("bigint").alias("pos"), "url")


@query("product_links", with_views("cards_html") + """
SELECT pos AS page_id, 'https://www.carrefour.es/supermercado/' || slug || '/R-' || cast(pos AS VARCHAR) || '/p' AS url
FROM cards_html WHERE pos % 10 <> 7
""")
def q_product_links(spark, sf_dir):
    links = L.links_extract(_card_pages(spark, sf_dir), K.BASE_URLS["carrefour"])
    return L.product_links(links, "carrefour").select("page_id", "url")


@query("pagination_links", _CARD_LINKS_SQL + "SELECT page_id, url FROM links")
def q_pagination_links(spark, sf_dir):
    """rel=next links (behind an attribute that holds a '>') and links under
    the category URL, whose href is written with character references."""
    return L.pagination_links(_card_pages(spark, sf_dir), "page_url", K.BASE_URLS["carrefour"])


# -- P8 -----------------------------------------------------------------------------

_ANCHORS_SQL = with_views("pages_base") + f"""
, a0 AS (SELECT page_id, origin, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS h,
                regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS t FROM pages_base),
a1 AS (SELECT page_id, origin, unnest(generate_series(0, len(h) - 1)) AS pos, unnest(h) AS href, unnest(t) AS t
       FROM a0 WHERE len(h) > 0),
atext AS (SELECT page_id, pos, {_norm_sql("replace(href, '&amp;', '&')", 'origin')} AS url,
                 {S.collapse("replace(t, '&amp;', '&')")} AS text FROM a1)
"""


@query("nav_link_denied", _ANCHORS_SQL + f"""
SELECT page_id, pos, url, text,
  ({S.contains_any(S.fold_text(S.blank('text')), K.NAV_DENY_WORDS)}
   OR {S.contains_any(S.fold_text(S.blank('url')), K.NAV_DENY_WORDS)}) AS denied
FROM atext
""")
def q_nav_link_denied(spark, sf_dir):
    p = load_view(spark, sf_dir, "pages_base")
    a = L.anchors_with_text(p, "origin")
    return a.select("page_id", F.col("pos").cast("bigint").alias("pos"), "url", "text",
                    U.nav_link_denied("text", "url").alias("denied"))


# -- P14 / P15 ----------------------------------------------------------------------

# Pages with a status, and with a marker text written in another form than the
# rules have it: named and numeric references, markup inside, a '>' in an
# attribute. The oracle reads the text the markup was built from.
_MARKERS = [("código postal", "c&oacute;digo&#32;postal"), ("Selecciona tu tienda", "<b>Selecciona</b> tu tienda"),
            ("no hay resultados", "no hay&#x20;resultados"), ("Sin resultados", '<span title="x > y">Sin resultados</span>'),
            ("élíge tu tienda", "&eacute;l&iacute;ge tu tienda"), ("", "<!-- captcha --><script>sin resultados</script>")]
_MARKER_TEXT = "CASE pos % 6 " + " ".join(
    f"WHEN {i} THEN '{t}'" for i, (t, _) in enumerate(_MARKERS)) + " END"
_MARKER_HTML = "CASE pos % 6 " + " ".join(f"WHEN {i} THEN '{h}'" for i, (_, h) in enumerate(_MARKERS)) + " END"
_C_BASE = with_views("cards_base")
_STATUS = "CASE pos % 7 WHEN 0 THEN 403 WHEN 1 THEN 404 ELSE 200 END"


@query("page_blocked", _C_BASE + f"""
SELECT pos AS page_id, (pos % 7 = 0 OR pos % 6 = 5) AS blocked FROM cards_base
""")
def q_page_blocked(spark, sf_dir):
    p = load_view(spark, sf_dir, "cards_base")
    return p.select(F.col("pos").alias("page_id"), page_blocked(F.expr(_STATUS), F.expr(_MARKER_HTML)).alias("blocked"))


@query("page_markers", _C_BASE + f"""
, v AS (SELECT pos AS page_id, trim(name || ' ' || {_MARKER_TEXT}) AS txt FROM cards_base)
SELECT page_id,
  {S.contains_any('lower(txt)', K.LOCATION_GATE_ALCAMPO)} AS location_gate_alcampo,
  {S.contains_any('lower(txt)', K.EMPTY_RESULTS)} AS empty_results_alcampo,
  {S.contains_any('lower(txt)', K.BLOCKED_TEXT)} AS blocked_alcampo,
  {S.contains_any(S.fold_text('txt'), K.LOCATION_GATE_DIA)} AS location_gate_dia,
  {S.contains_any(S.fold_text('txt'), K.EMPTY_RESULTS)} AS empty_results_dia,
  {S.contains_any(S.fold_text('txt'), K.BLOCKED_TEXT)} AS blocked_dia,
  length(txt) AS text_chars
FROM v
""")
def q_page_markers(spark, sf_dir):
    p = load_view(spark, sf_dir, "cards_base")
    html = F.concat(F.lit("<html><p>"), F.col("name"), F.lit("</p><div>"), F.expr(_MARKER_HTML), F.lit("</div></html>"))
    v = p.select(F.col("pos").alias("page_id"), visible_text(html).alias("txt"))
    a = page_markers("txt", "alcampo")
    d = page_markers("txt", "dia")
    return v.select("page_id", a["location_gate"].alias("location_gate_alcampo"),
                    a["empty_results"].alias("empty_results_alcampo"), a["blocked"].alias("blocked_alcampo"),
                    d["location_gate"].alias("location_gate_dia"), d["empty_results"].alias("empty_results_dia"),
                    d["blocked"].alias("blocked_dia"), F.length("txt").cast("bigint").alias("text_chars"))
