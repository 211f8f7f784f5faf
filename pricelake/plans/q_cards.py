"""Driver queries for the page job: product cards per shop (H5-H7),
JSON-LD products (H8) and visible text (H9). Pages are built from ``part``
in each shop's markup; the oracle reads the columns the markup was built
from."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelake.functions import constants as K
from pricelake.functions import text as T
from pricelake.operators import cards as C
from pricelake.plans import sqlfrag as S
from pricelake.plans.registry import query
from pricelake.plans.views import load_view, with_views
from pricelake.sources import html_job as H

_V = with_views("cards_html")
_OUT = ["page_id", "product", "brand", "price", "price_per_unit", "offer", "product_url"]


def _pages(spark, sf_dir, col):
    return load_view(spark, sf_dir, "cards_html").select(F.col("pos").alias("page_id"), F.col(col).alias("html"))


def _f5(x):
    return S.strip(f"regexp_extract({x}, '{T.PRICE_PATTERN}', 1)")


def _f6a(x):
    return f"replace({S.strip(f'replace(regexp_extract({x}, {S.lit(T.PPU_DIA_PATTERN)}, 1), chr(160), chr(32))')}, '€/', '€ / ')"


def _offer_word_text():
    return "CASE WHEN offer_word <> '' THEN ' ' || offer_word ELSE '' END"


_DIA_SQL = _V + f"""
, c AS (
  SELECT pos AS page_id, price_text,
    CASE WHEN pos % 3 = 0 THEN name || ' A' ELSE name END AS product,
    CASE WHEN pos % 3 = 0 THEN 'https://www.dia.es/x/' || slug || '/p/' || cast(pos AS VARCHAR) || 'A'
         ELSE 'https://www.dia.es/' || category || '/' || slug || '/p/' || cast(pos AS VARCHAR) END AS product_url,
    CASE WHEN pos % 3 = 0 THEN name || ' A ' || price_text
         ELSE name || ' ' || price_text || ' ' || ppu_text || {_offer_word_text()} END AS card_text
  FROM cards_html)
SELECT page_id, product, {S.first_upper('product')} AS brand,
  CASE WHEN {_f5('price_text')} <> '' THEN {_f5('price_text')} ELSE {S.strip("replace(price_text, '€', '')")} END AS price,
  CASE WHEN {_f6a('price_text')} <> '' THEN {_f6a('price_text')} ELSE {_f6a('card_text')} END AS price_per_unit,
  {S.contains_any(S.fold_text('card_text'), K.OFFER_KEYWORDS_DIA)} AS offer, product_url
FROM c
"""


@query("product_cards_dia", _DIA_SQL)
def q_product_cards_dia(spark, sf_dir):
    return C.page_products(_pages(spark, sf_dir, "html_dia"), "dia").select(*_OUT)


def _tidy_alcampo(x):
    return f"replace(trim(replace({x}, chr(160), ' '), '() '), '€/', '€ / ')"


_ALCAMPO_SQL = _V + f"""
, c AS (
  SELECT pos AS page_id, name AS product, price_text, ppu_text, pos % 4 = 0 AS promo,
    'https://www.compraonline.alcampo.es/products/' || slug || '/' || cast(pos AS VARCHAR) || '?x=1' AS product_url,
    name || ' ' || price_text || ' ' || ppu_text || CASE WHEN pos % 4 = 0 THEN ' Ver' ELSE '' END AS card_text
  FROM cards_html)
SELECT page_id, product, {S.first_upper('product')} AS brand,
  {S.strip("replace(replace(price_text, chr(160), ' '), '€', '')")} AS price,
  {_tidy_alcampo('ppu_text')} AS price_per_unit,
  (promo OR {S.contains_any('lower(card_text)', [k.lower() for k in K.OFFER_KEYWORDS_ALCAMPO])}) AS offer,
  product_url
FROM c
"""


@query("product_cards_alcampo", _ALCAMPO_SQL)
def q_product_cards_alcampo(spark, sf_dir):
    return C.page_products(_pages(spark, sf_dir, "html_alcampo"), "alcampo").select(*_OUT)


_CARREFOUR_SQL = _V + f"""
, c AS (
  SELECT pos AS page_id, name AS product, {S.strip('brand_direct')} AS brand, price_text, ppu_text,
    'https://www.carrefour.es/supermercado/' || slug || '/R-' || cast(pos AS VARCHAR) || '/p' AS product_url,
    name || CASE WHEN {S.strip('brand_direct')} <> '' THEN ' ' || {S.strip('brand_direct')} ELSE '' END
      || ' ' || price_text || ' ' || ppu_text || {_offer_word_text()} AS card_text
  FROM cards_html)
SELECT page_id, product, brand, {S.strip('price_text')} AS price, {S.strip('ppu_text')} AS price_per_unit,
  {S.contains_any('lower(card_text)', [k.lower() for k in K.OFFER_KEYWORDS_CARREFOUR])} AS offer, product_url
FROM c WHERE page_id % 10 NOT IN (5, 7)
"""


@query("product_cards_carrefour", _CARREFOUR_SQL)
def q_product_cards_carrefour(spark, sf_dir):
    return C.page_products(_pages(spark, sf_dir, "html_carrefour"), "carrefour").select(*_OUT)


_LD_SQL = _V + f"""
SELECT pos AS page_id,
  CASE pos % 3 WHEN 2 THEN 'Shop ' || cast(pos AS VARCHAR) ELSE name END AS product,
  '' AS brand,
  CASE pos % 3 WHEN 0 THEN cast(cast(pos AS DOUBLE) / 4 + 0.5 AS VARCHAR) WHEN 1 THEN cast(pos AS VARCHAR)
       ELSE '' END AS price,
  CASE pos % 3 WHEN 0 THEN {_f6a('ppu_text')} ELSE '' END AS price_per_unit,
  false AS offer,
  CASE pos % 3 WHEN 0 THEN 'https://www.dia.es/p/' || cast(pos AS VARCHAR) ELSE '' END AS product_url
FROM cards_html
"""


@query("jsonld_products", _LD_SQL)
def q_jsonld_products(spark, sf_dir):
    objects = C.jsonld_objects(C.jsonld_blocks(_pages(spark, sf_dir, "html_ld")))
    return C.jsonld_products(objects).select(*_OUT)


@query("visible_text", _V + """
SELECT pos AS page_id, name || ' ' || price_text || ' ' || ppu_text || CASE WHEN pos % 4 = 0 THEN ' Ver' ELSE '' END
  || ' dup ' || name AS text FROM cards_html
""")
def q_visible_text(spark, sf_dir):
    """H9: the text of Al Campo pages; the oracle reads the columns their
    markup was built from."""
    return _pages(spark, sf_dir, "html_alcampo").mapInPandas(H.text_job(), H.schema(H.TEXT_SCHEMA))
