"""Domain inputs derived from the driver tables.

Each base view is a chain of projections written as SQL expressions that
Spark (``selectExpr``) and DuckDB (the oracle) both run unchanged, so both
sides start from identical rows. Every view reads a whole driver table and
grows with it; none filters rows away.

``{Q}`` stands for the identifier quote of the dialect (backtick in Spark,
double quote in DuckDB), needed for the column called ``group``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# Price text in euros with a decimal comma; every other status also gets a
# "." thousands separator, so both price formats occur.
_CENTS = "cast(round(o_totalprice * 100) as bigint)"
_EUROS = f"cast(floor({_CENTS} / 100) as bigint)"
_EURO_TEXT = (f"case when o_orderstatus = 'F' and {_EUROS} >= 1000 "
              f"then cast(cast(floor({_EUROS} / 1000) as bigint) as string) || '.' || "
              f"lpad(cast({_EUROS} % 1000 as string), 3, '0') "
              f"else cast({_EUROS} as string) end")
_PRICE_TEXT = f"{_EURO_TEXT} || ',' || lpad(cast({_CENTS} % 100 as string), 2, '0') || ' €'"

VIEWS: dict[str, tuple[str, list[list[str]]]] = {
    # Product rows of a daily run: one per order. The priority is the
    # category target, the order status the subcategory, the order year the
    # page of the walk, the order key the position in the page. Orders with
    # status 'P' carry no product URL (a third of all rows share the blank
    # key); status 'O' names carry extra blanks and upper case.
    "rows_base": ("orders", [[
        "cast(substr(o_orderpriority, 1, 1) as bigint) AS target_index",
        "cast(year(o_orderdate) as bigint) AS page_seq",
        "o_orderkey AS pos",
        "cast(o_orderdate as date) AS date",
        "case when o_orderstatus = 'O' then ' PRODUCTO ' || cast(o_custkey as string) || ' ' "
        "else 'Producto ' || cast(o_custkey as string) end AS product",
        "'' AS brand",
        f"{_PRICE_TEXT} AS price",
        "'' AS price_per_unit",
        "o_orderstatus = 'F' AS offer",
        "substr(o_orderpriority, 3) AS category",
        "o_orderstatus AS subcategory",
        "case when o_orderstatus = 'P' then '' "
        "else 'https://shop.example/p/' || cast(o_custkey as string) end AS product_url",
    ]]),
    # Category targets: one per part. Type is the group, brand the
    # category, name the subcategory; the URL depends on brand and name
    # only, so (category, subcategory, url) repeats across groups.
    "targets_base": ("part", [[
        "p_partkey AS target_index",
        "lower(p_type) AS {Q}group{Q}",
        "p_brand AS category",
        "p_name AS subcategory",
        "'https://shop.example/c/' || replace(lower(p_brand), '#', '') || '/' || replace(p_name, ' ', '-') AS url",
        "p_size",
    ]]),
    # Product cards as text, one per part: a display name in five shapes
    # (known brand, upper-case first token, title-case tail, digits, none),
    # an optional direct brand, a price with and without thousands
    # separator (NBSP before the euro sign on some), a unit price in four
    # shapes and an optional offer word.
    "cards_base": ("part", [[
        "p_partkey AS pos",
        "p_size",
        "p_name",
        "p_type",
        "p_brand",
        "cast(round(p_retailprice * (p_size % 13 + 1) * 100) as bigint) AS cents",
    ], [
        "pos",
        "case p_size % 5 when 0 then p_name || ' Hacendado' "
        "when 1 then upper(p_type) || ' ' || p_name "
        "when 2 then 'leche ' || p_name || ' Casa ' || upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) || ' Oro' "
        "when 3 then p_name || ' 12 ' || upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) "
        "else '(' || p_brand || '), ' || p_name end AS name",
        "case when p_size > 45 then ' ' || p_brand || ' ' else '' end AS brand_direct",
        "case when pos % 2 = 0 and cents >= 100000 "
        "then cast(cast(floor(cents / 100000) as bigint) as string) || '.' || "
        "lpad(cast(cast(floor(cents / 100) as bigint) % 1000 as string), 3, '0') "
        "else cast(cast(floor(cents / 100) as bigint) as string) end "
        "|| ',' || lpad(cast(cents % 100 as string), 2, '0') "
        "|| case when p_size % 3 = 0 then chr(160) else ' ' end || '€' AS price_text",
        "cast(floor(cents / p_size) as bigint) AS ppu_cents",
        "p_size",
        "lower(p_type) AS category",
        "upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS category_label",
        "p_name AS leaf",
        "case p_size % 7 when 0 then 'PROMOCIÓN' when 1 then '2ª unidad' when 2 then 'Pack Ahorro' "
        "when 3 then 'Oferta' else '' end AS offer_word",
    ], [
        "pos", "name", "brand_direct", "price_text", "category", "category_label", "leaf", "p_size",
        "case p_size % 4 "
        "when 0 then cast(cast(floor(ppu_cents / 100) as bigint) as string) || ',' || lpad(cast(ppu_cents % 100 as string), 2, '0') || ' €/kg' "
        "when 1 then cast(cast(floor(ppu_cents / 100) as bigint) as string) || ',' || lpad(cast(ppu_cents % 100 as string), 2, '0') || ' € por kilogramo' "
        "when 2 then '(' || cast(cast(floor(ppu_cents / 100) as bigint) as string) || ',' || lpad(cast(ppu_cents % 100 as string), 2, '0') || ' €/l)' "
        "else cast(cast(floor(ppu_cents / 100) as bigint) as string) || ',' || lpad(cast(ppu_cents % 100 as string), 2, '0') || ' €/100 ml' end AS ppu_text",
        "offer_word",
    ], [
        "pos", "name", "brand_direct", "price_text", "ppu_text", "offer_word", "category", "category_label",
        "leaf", "p_size",
        "name || ' ' || price_text || ' ' || ppu_text || ' ' || offer_word AS card_text",
    ]]),
    # URL forms seen in hrefs, built from every page's URL: absolute,
    # padded, protocol-relative, root-relative, per-shop product and
    # category shapes, and forms that do not normalise.
    "url_forms": ("pages", [[
        "page_id",
        "url",
        "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS host",
        "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path",
        "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*/([a-z]+)', 1) AS lang",
        "cast(page_id as string) AS id",
    ], [
        "page_id",
        "url AS f0",
        "'  ' || url || ' ' AS f1",
        "'//' || host || path AS f2",
        "path AS f3",
        "'https://www.dia.es/' || lang || '/c/L' || id AS f4",
        "'https://www.dia.es/' || lang || '/x-' || id || '/c/l' || id AS f5",
        "'/compra-online/' || lang || '/p/' || id AS f6",
        "'https://www.compraonline.alcampo.es/categories/' || lang || '%C3%B1/OC' || id AS f7",
        "'https://www.compraonline.alcampo.es/products/' || lang || '/' || id || '?x=1#y' AS f8",
        "'https://www.carrefour.es/supermercado/' || lang || '/cat' || id || '/c?page=2' AS f9",
        "'/c/' || lang || ';v=1' AS f10",
        "'#top' AS f11",
        "'mailto:a@' || host AS f12",
        "'HTTP://' || host AS f13",
        "'./' || lang AS f14",
        "'' AS f15",
    ]]),
    # Object-arrival events, one per event: the type picks the shop (error
    # events name a shop without a table), the event day the path day.
    # Some events carry an invalid day, a non-parquet object, an upper-case
    # path, no bucket or another bucket; half nest their fields under "data".
    "events_base": ("events", [[
        "event_id",
        "case event_type when 'view' then 'carrefour' when 'click' then 'alcampo' "
        "when 'purchase' then 'dia' when 'signup' then 'mercadona' else 'lidl' end AS src",
        "cast(cast(ts as date) as string) AS day",
        "cast(event_id as string) AS id",
    ], [
        "event_id",
        "case when event_id % 23 = 0 then 'other-bucket' when event_id % 19 = 0 then '' "
        "else 'raw-bucket' end AS bucket",
        "case when event_id % 13 = 0 then src || '/2024-13-45/part-' || id || '.parquet' "
        "when event_id % 17 = 0 then src || '/' || src || '_categories.json' "
        "when event_id % 10 = 0 then upper(src) || '/' || day || '/PART-' || id || '.PARQUET' "
        "else src || '/' || day || '/part-' || id || '.parquet' end AS name",
        "id AS generation",
        "event_id % 2 = 0 AS nested",
    ]]),
    # Category API payloads, one per card: one leaf bucket with the product,
    # sometimes followed by a non-object leaf and a leaf whose products are
    # not a list. Field types vary: ids as number, text or null; prices as
    # number, text, 0 or null; flags as bool, null, number or text; some
    # price_instructions are not objects; some payloads are not objects.
    "payload_base": ("cards_base", [[
        "pos", "name", "brand_direct", "leaf", "category_label", "p_size",
        "cast(pos as double) / 4 + 0.5 AS price_num",
        "cast(pos as string) AS id",
    ], [
        "pos", "name", "brand_direct", "leaf", "category_label", "p_size", "price_num", "id",
        "case when pos % 50 = 7 then '[1, 2]' else "
        "'{\"categories\": [{\"name\": \"' || leaf || '\", \"products\": [{\"id\": ' || "
        "case pos % 3 when 0 then id when 1 then '\"' || id || '\"' else 'null' end || "
        "', \"display_name\": \"' || name || '\", \"brand\": \"' || brand_direct || '\", \"share_url\": ' || "
        "case when pos % 5 = 0 then '\"https://tienda.mercadona.es/product/' || id || '/share\"' else '\"\"' end || "
        "', \"slug\": ' || case when pos % 2 = 0 then '\"' || replace(leaf, ' ', '-') || '\"' else 'null' end || "
        "', \"price_instructions\": ' || "
        "case when pos % 11 = 0 then '\"oops\"' else "
        "'{\"bulk_price\": ' || case p_size % 4 when 0 then cast(price_num as string) "
        "when 1 then '\"' || cast(price_num as string) || '\"' when 2 then '0' else 'null' end || "
        "case p_size % 5 when 0 then ', \"reference_price\": \"' || cast(price_num as string) || '\"' "
        "when 1 then ', \"reference_price\": ' || cast(price_num as string) "
        "when 2 then ', \"reference_price\": \"\"' when 3 then '' else ', \"reference_price\": null' end || "
        "', \"reference_format\": \"' || case p_size % 3 when 0 then 'kg' when 1 then 'L' else '' end || '\"' || "
        "', \"unit_price\": ' || cast(price_num * 2 as string) || "
        "', \"size_format\": \"' || case when p_size % 2 = 0 then 'ud' else '' end || '\"' || "
        "case p_size % 6 when 0 then ', \"price_decreased\": true' when 1 then ', \"price_decreased\": false' "
        "when 2 then ', \"price_decreased\": null' when 3 then ', \"price_decreased\": 1' "
        "when 4 then ', \"price_decreased\": \"x\"' else '' end || "
        "', \"previous_unit_price\": ' || case pos % 4 when 0 then '0' when 1 then '\"0\"' when 2 then '\"\"' "
        "else '1.25' end || '}' end || '}]}' || "
        "case when p_size % 9 = 0 then ', \"junk\", {\"name\": \"x\", \"products\": \"none\"}' else '' end "
        "|| ']}' end AS payload",
    ]]),
    # Groups API payloads, one per card: a named group with three
    # categories (published true / false / null / absent; the second with
    # id 0, the third without a name), a nameless group and a non-object.
    # Category ids repeat across cards, so targets repeat.
    "groups_base": ("cards_base", [[
        "pos", "category_label", "leaf", "p_size",
        "cast(p_size * 1000 + pos % 3 as string) AS cid",
    ], [
        "pos", "category_label", "leaf", "cid",
        "'{\"results\": [{\"name\": \"' || category_label || '\", \"categories\": [{\"id\": ' || cid || "
        "', \"name\": \"' || leaf || '\"' || "
        "case pos % 4 when 0 then ', \"published\": true' when 1 then ', \"published\": false' "
        "when 2 then ', \"published\": null' else '' end || '}, "
        "{\"id\": 0, \"name\": \"zero\"}, {\"id\": \"' || cid || '7\", \"name\": \"\"}, "
        "{\"id\": \"' || cid || '8\", \"name\": \"' || leaf || ' extra\", \"published\": \"false\"}]}, "
        "{\"name\": \"\", \"categories\": [{\"id\": 5, \"name\": \"orphan\"}]}, \"junk\"]}' AS payload",
    ]]),
    # Category pages in each shop's markup, one per card (see the card
    # rules): a first-selector card on every third Dia page, a duplicate
    # card per page (same product URL), a card without URL, promotion
    # links, price attributes on every other Carrefour wrapper, and ld+json
    # blocks of three shapes plus one that does not parse.
    "cards_html": ("cards_base", [[
        "pos", "name", "brand_direct", "price_text", "ppu_text", "offer_word", "category", "category_label", "leaf",
        "replace(leaf, ' ', '-') AS slug",
        "cast(pos as string) AS id",
    ], [
        "pos", "name", "brand_direct", "price_text", "ppu_text", "offer_word", "category", "category_label", "leaf",
        "slug",
        "'<div class=\"list\">' || "
        "case when pos % 3 = 0 then '<article class=\"product-x\"><a href=\"https://www.dia.es/x/' || slug || '/p/' || id "
        "|| 'A#f\"><h3>' || name || ' A</h3></a><strong>' || price_text || '</strong></article>' else '' end || "
        "'<li class=\"product-item\"><a href=\"/' || category || '/' || slug || '/p/' || id || '?y=2\"><img alt=\"' "
        "|| name || '\"></a><p class=\"product-name\">' || name || '</p><span class=\"price\">' || price_text || "
        "'</span><span>' || ppu_text || '</span><em>' || offer_word || '</em></li>' || "
        "'<li class=\"product-item\"><a href=\"/' || category || '/' || slug || '/p/' || id || "
        "'?z=3\"><p class=\"product-name\">dup</p></a></li>' || "
        "'<li class=\"product-note\">' || name || '</li></div>' AS html_dia",
        "'<div class=\"grid\"><div class=\"product-card-container\"><a href=\"/products/' || slug || '/' || id || "
        "'?x=1\"></a><div class=\"title-container\"><h3>' || name || '</h3></div><span data-test=\"fop-price\">' || "
        "price_text || '</span><span data-test=\"fop-price-per-unit\">' || ppu_text || '</span>' || "
        "case when pos % 4 = 0 then '<div class=\"promotion-container\"><a href=\"/offers/' || id || "
        "'\">Ver</a></div>' else '' end || '</div>' || "
        "'<div class=\"product-card-container\"><a href=\"/products/' || slug || '/' || id || "
        "'?x=1\"></a><div class=\"title-container\"><h3>dup</h3></div></div>' || "
        "'<div class=\"product-card-container\"><h3>' || name || '</h3></div></div>' AS html_alcampo",
        "case when pos % 10 = 5 then '<p><a href=\"/supermercado/' || slug || '/R-' || id || '/p\">ver</a></p>' "
        "when pos % 10 = 7 then '<div data-u=\"/supermercado/' || slug || '/R-' || id || '/p\"></div>' else "
        "'<div class=\"product-card__parent\"' || case when pos % 2 = 0 then ' app_price=\"' || price_text || "
        "'\" app_price_per_unit=\"' || ppu_text || '\"' else '' end || '><div class=\"product-card\">"
        "<h2 class=\"product-card__title\"><a class=\"product-card__title-link\" href=\"/supermercado/' || slug || "
        "'/R-' || id || '/p\">' || name || '</a></h2>' || case when brand_direct <> '' then "
        "'<span class=\"product-card__brand\">' || brand_direct || '</span>' else '' end || "
        "'<span class=\"product-card__price\">' || price_text || '</span><span class=\"product-card__price-per-unit\">' "
        "|| ppu_text || '</span><span class=\"badge\">' || offer_word || '</span></div></div>' end || "
        "case when pos % 3 < 2 then '<a title=\"a > b\" rel=\"next\" href=\"https://shop.example/c/' "
        "|| cast(pos + 1 as string) || '\">&gt;</a>' else '' end || "
        "'<a href=\"https://shop.example/c/' || cast(pos as string) || '?a=1&amp;p&aacute;gina=2\">2</a>"
        "<a href=\"https://shop.example/c/x' || cast(pos as string) || '?page=2\">3</a>' "
        "AS html_carrefour",
        "'<html><head><script type=\"application/ld+json\">' || case pos % 3 "
        "when 0 then '{\"@graph\": [{\"@type\": \"Product\", \"name\": \"' || name || '\", \"url\": \"/p/' || id "
        "|| '?q\", \"offers\": {\"price\": ' || cast(cast(pos as double) / 4 + 0.5 as string) || "
        "', \"priceSpecification\": \"' || ppu_text || '\"}}, {\"@type\": \"Product\", \"name\": \"dup\", "
        "\"url\": \"/p/' || id || '\"}]}' "
        "when 1 then '{\"itemListElement\": [{\"item\": {\"name\": \"' || name || '\", \"offers\": "
        "[{\"price\": \"' || id || '\"}]}}, {\"name\": \"C\"}]}' "
        "else '{\"@type\": \"Organization\", \"name\": \"Shop ' || id || '\"}' end || "
        "'</script><script type=\"application/ld+json\">{bad</script></head><body></body></html>' AS html_ld",
    ]]),
    # Al Campo group pages, one per card: the group slug (accented in the
    # group URL on every fourth page) and, except on every fifth page,
    # category links: a named one, an unnamed one, a duplicate, one of
    # another group and the group page itself.
    "nav_alcampo": ("cards_base", [[
        "pos", "leaf", "cast(pos as string) AS id",
        "category || '-' || cast(p_size as string) AS gslug",
    ], [
        "pos", "leaf", "id", "gslug",
        "case when pos % 4 = 0 then replace(gslug, 'o', 'ó') else gslug end AS url_slug",
    ], [
        "pos", "leaf", "id", "gslug", "url_slug",
        "'https://www.compraonline.alcampo.es/categories/' || url_slug || '/OC' || id AS group_url",
        "case when pos % 5 = 0 then '<div>no links</div>' else "
        "'<nav><a href=\"/categories/' || gslug || '/' || id || '/x?q=1\">' || leaf || '</a>' || "
        "'<a href=\"/categories/' || gslug || '/OC' || id || '\">  </a>' || "
        "'<a href=\"/categories/' || gslug || '/' || id || '/x?q=2\">dup</a>' || "
        "'<a href=\"/categories/otro/' || id || '/y\">other</a>' || "
        "'<a href=\"/categories/' || gslug || '\">group</a></nav>' end AS html",
    ]]),
    # Dia menu items collected from the home page (a category link, a
    # product link and a later duplicate of the category link with another
    # or no title) and from each category page (two subcategory links, one
    # without title, and one under another first segment; none on every
    # fourth category page).
    "items_dia": ("cards_base", [[
        "pos", "leaf", "category", "cast(pos as string) AS id",
        "replace(leaf, ' ', '-') AS slug",
    ], [
        "pos", "leaf", "id",
        "'/' || category || '-' || id || '/c/L' || id AS cat_href",
        "'https://www.dia.es/' || category || '-' || id || '/c/L' || id AS cat_url",
        "case when pos % 6 = 0 then '' else leaf end AS t0",
        "'/' || category || '/p/' || id AS junk_href",
        "case when pos % 6 = 0 then '' else 'Dup ' || leaf end AS t2",
        "leaf || ' sub' AS s0_title",
        "'/' || category || '-' || id || '/' || slug || '/c/L' || id || '01' AS s0_href",
        "'/' || category || '-' || id || '/otra-' || id || '/c/L' || id || '02' AS s1_href",
        "'/otro/' || slug || '/c/L' || id || '03' AS s2_href",
        "pos % 4 = 0 AS no_subs",
    ]]),
    # Carrefour navigation, one group per card (every seventh a one-level
    # "bebidas" group, every ninth without navigation): slides with a
    # title, with a text element, an offers slide, a second slide with the
    # same name and a non-category link; the first category page has
    # sub-navigation (missing on even cards), the second none.
    "nav_carrefour": ("cards_base", [[
        "pos", "leaf", "category_label", "cast(pos as string) AS id",
        "case when pos % 7 = 0 then 'bebidas' else category || '-' || cast(pos as string) end AS gname",
    ], [
        "pos", "leaf", "category_label", "id", "gname",
        "'https://www.carrefour.es/supermercado/' || gname || '/cat' || id || '/c' AS group_url",
        "'https://www.carrefour.es/supermercado/' || gname || '/c1-' || id || '/c' AS cat1_url",
        "'https://www.carrefour.es/supermercado/' || gname || '/c2-' || id || '/c' AS cat2_url",
        "case when pos % 9 = 0 then '<div>no nav</div>' else "
        "'<div class=\"nav-second-level-categories\">' || "
        "'<div class=\"nav-second-level-categories__slide\" title=\"' || leaf || '\"><a href=\"/supermercado/' "
        "|| gname || '/c1-' || id || '/c\">A</a><a href=\"/other/c\">B</a></div>' || "
        "'<div class=\"nav-second-level-categories__slide\"><a href=\"/supermercado/' || gname || '/c2-' || id || "
        "'/c\"><p class=\"nav-second-level-categories__text\">' || category_label || ' ' || id || '</p></a></div>' || "
        "'<div class=\"nav-second-level-categories__slide\" title=\"Ofertas\"><a href=\"/supermercado/ofertas/c\">"
        "x</a></div>' || "
        "'<div class=\"nav-second-level-categories__slide\" title=\"' || leaf || '\"><a href=\"/supermercado/' "
        "|| gname || '/c3-' || id || '/c\">dup</a></div>' || "
        "'<div class=\"nav-second-level-categories__slide\" title=\"Nada\"><a href=\"/supermercado/' || gname || "
        "'/nada-' || id || '/p\">x</a></div></div>' end AS group_html",
        "case when pos % 2 = 0 then null else "
        "'<div class=\"nav-second-level-categories\"><div class=\"nav-second-level-categories__slide\" title=\"' "
        "|| leaf || ' uno\"><a href=\"/supermercado/' || gname || '/s1-' || id || '/c\">u</a></div>' || "
        "'<a href=\"/supermercado/' || gname || '/s2-' || id || '/c\"><p class=\"nav-second-level-categories__text\">"
        "Dos ' || id || '</p></a><a href=\"/supermercado/ofertas-' || id || '/c\">Ofertas</a></div>' end AS cat1_html",
        "'<div>sin nav</div>' AS cat2_html",
    ]]),
    # Dia group pages, one per card: a category link, the group page
    # itself, an offers link, a link of another group, an unnamed link, a
    # duplicate with a query, and a product link.
    "nav_dia": ("cards_base", [[
        "pos", "leaf", "cast(pos as string) AS id", "category || '-' || cast(pos as string) AS gs",
    ], [
        "pos", "leaf", "id", "gs",
        "'https://www.dia.es/compra-online/' || gs AS group_url",
        "'<ul><li><a href=\"/' || gs || '/frescos/c/L' || id || '\">' || leaf || '</a></li>' || "
        "'<li><a href=\"/compra-online/' || gs || '\">Todo</a></li>' || "
        "'<li><a href=\"/' || gs || '/ofertas/c/L' || id || '1\">Ofertas</a></li>' || "
        "'<li><a href=\"/otro/c/L' || id || '2\">x</a></li>' || "
        "'<li><a href=\"/' || gs || '/vacio/c/L' || id || '3\"> </a></li>' || "
        "'<li><a href=\"/' || gs || '/frescos/c/L' || id || '?dup=1\">dup</a></li>' || "
        "'<li><a href=\"/' || gs || '/p/' || id || '\">p</a></li></ul>' AS html",
    ]]),
    # Pages of the snapshot table with their origin, used as URL base.
    "pages_base": ("pages", [[
        "page_id",
        "url",
        "regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) AS origin",
        "html",
    ]]),
}


def view_sql(name: str, dialect: str = "duckdb") -> str:
    """The view as a nested SELECT for DuckDB or Spark SQL."""
    table, steps = VIEWS[name]
    q = '"' if dialect == "duckdb" else "`"
    sql = view_sql(table, dialect) if table in VIEWS else table
    for step in steps:
        cols = ", ".join(e.replace("{Q}", q) for e in step)
        sql = f"(SELECT {cols} FROM {sql})"
    return sql


def with_views(*names: str) -> str:
    """``WITH`` clause defining the given base views for a DuckDB oracle."""
    parts = [f"{n} AS {view_sql(n)}" for n in names]
    return "WITH " + ",\n".join(parts) + "\n"


def read_table(spark: SparkSession, sf_dir: str, table: str, columns=None) -> DataFrame:
    from pricelake.session import spread
    df = spark.read.parquet(os.path.join(sf_dir, f"{table}.parquet"))
    return spread(df.select(*columns) if columns else df)


def load_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, steps = VIEWS[name]
    df = load_view(spark, sf_dir, table) if table in VIEWS else read_table(spark, sf_dir, table)
    for step in steps:
        df = df.selectExpr(*[e.replace("{Q}", "`") for e in step])
    return df
