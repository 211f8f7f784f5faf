"""Driver queries for API payloads (S3, S4, F6c, F8, F12, F14, J2, P9-P11,
A1, O1). Spark parses the JSON text; the oracle computes the expected rows
from the columns the JSON was built from."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelake.functions import constants as K
from pricelake.operators import merge as M
from pricelake.plans import sqlfrag as S
from pricelake.plans.q_text import _brand_ladder_sql
from pricelake.plans.registry import query
from pricelake.plans.views import load_view, read_table, with_views
from pricelake.sources import payloads as PL

_BASE = "https://tienda.mercadona.es"


def _num(x: str) -> str:
    return f"cast({x} AS VARCHAR)"


def _expected_sql() -> str:
    """Expected product rows, straight from the payload_base columns."""
    pid = (f"CASE pos % 3 WHEN 0 THEN CASE WHEN pos = 0 THEN '' ELSE id END WHEN 1 THEN id ELSE '' END")
    pi_ok = "pos % 11 <> 0"
    bulk = f"CASE WHEN NOT ({pi_ok}) THEN '' WHEN p_size % 4 IN (0, 1) THEN {_num('price_num')} ELSE '' END"
    rp = f"CASE WHEN p_size % 5 IN (0, 1) THEN {_num('price_num')} ELSE '' END"
    rf = "CASE p_size % 3 WHEN 0 THEN 'kg' WHEN 1 THEN 'L' ELSE '' END"
    up = _num("price_num * 2")
    sf = "CASE WHEN p_size % 2 = 0 THEN 'ud' ELSE '' END"
    ppu = (f"CASE WHEN NOT ({pi_ok}) THEN '' WHEN {rp} <> '' AND {rf} <> '' THEN {rp} || ' €/' || {rf} "
           f"WHEN {up} <> '' AND {sf} <> '' THEN {up} || ' €/' || {sf} ELSE '' END")
    offer = f"({pi_ok} AND (p_size % 6 IN (0, 3, 4) OR pos % 4 IN (1, 3)))"
    slug = "CASE WHEN pos % 2 = 0 THEN replace(leaf, ' ', '-') ELSE '' END"
    url = (f"CASE WHEN pos % 5 = 0 THEN '{_BASE}/product/' || id || '/share' "
           f"WHEN {pid} <> '' AND {slug} <> '' THEN '{_BASE}/product/' || {pid} || '/' || {slug} "
           f"WHEN {pid} <> '' THEN '{_BASE}/product/' || {pid} ELSE '' END")
    t, lf = S.strip("category_label"), S.strip("leaf")
    sub = (f"CASE WHEN {lf} <> '' AND {t} <> '' AND lower({lf}) <> lower({t}) THEN {t} || ' / ' || {lf} "
           f"WHEN {lf} <> '' THEN {lf} ELSE {t} END")
    return with_views("payload_base") + f"""
, expected AS (
  SELECT pos, CAST(0 AS BIGINT) AS leaf_pos, CAST(0 AS BIGINT) AS prod_pos, {pid} AS product_id, {S.strip('name')} AS product,
         {_brand_ladder_sql()} AS brand, {bulk} AS price, {ppu} AS price_per_unit, {offer} AS offer,
         {sub} AS subcategory, {url} AS product_url
  FROM payload_base WHERE pos % 50 <> 7)
"""


_COLS = "pos, leaf_pos, prod_pos, product_id, product, brand, price, price_per_unit, offer, subcategory, product_url"


def _rows(spark, sf_dir):
    b = load_view(spark, sf_dir, "payload_base")
    flat = PL.flatten_category_payload(b, "payload", keep=("pos", "category_label"))
    return PL.product_rows(flat, "category_label", keep=("pos",)) \
        .withColumn("leaf_pos", F.col("leaf_pos").cast("bigint")) \
        .withColumn("prod_pos", F.col("prod_pos").cast("bigint"))


@query("payload_flatten", _expected_sql() + f"SELECT {_COLS} FROM expected")
def q_payload_flatten(spark, sf_dir):
    return _rows(spark, sf_dir)


@query("price_fields", _expected_sql() + "SELECT pos, price, price_per_unit, offer FROM expected")
def q_price_fields(spark, sf_dir):
    return _rows(spark, sf_dir).select("pos", "price", "price_per_unit", "offer")


@query("failed_payload_pages", with_views("payload_base") + """
SELECT CAST(count_if(pos % 50 = 7) AS BIGINT) AS failed_pages, count(*) AS pages FROM payload_base
""")
def q_failed_payload_pages(spark, sf_dir):
    """Pages whose payload is not an object count as failed."""
    b = load_view(spark, sf_dir, "payload_base")
    return b.agg(F.count_if(~PL.payload_ok("payload")).alias("failed_pages"), F.count(F.lit(1)).alias("pages"))


# -- J2 ---------------------------------------------------------------------------
# Product details exist for parts of size below 40.

def _details(spark, sf_dir):
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand", "p_size"])
    return p.where(F.col("p_size") < 40).select(F.col("p_partkey").cast("string").alias("id"),
                                                 F.col("p_brand").alias("brand"))


@query("brand_lookup", _expected_sql() + f"""
, details AS (SELECT cast(p_partkey AS VARCHAR) AS id, p_brand AS brand FROM part WHERE p_size < 40)
SELECT e.pos, e.product_id,
  CASE WHEN e.brand = '' AND e.product_id <> '' THEN coalesce({S.strip('d.brand')}, '') ELSE e.brand END AS brand
FROM expected e LEFT JOIN details d ON d.id = e.product_id
""")
def q_brand_lookup(spark, sf_dir):
    rows = _rows(spark, sf_dir).select("pos", "product_id", "brand")
    return PL.fill_brand_from_details(rows, _details(spark, sf_dir))


# -- S4 + P11 + A1 + O1 -------------------------------------------------------------

def _groups_sql() -> str:
    slug = (f"CASE WHEN lower(trim(regexp_replace({S.fold('category_label', ascii_only=True)}, "
            f"'[^a-zA-Z0-9]+', '-', 'g'), '-')) = '' THEN 'mercadona' ELSE "
            f"lower(trim(regexp_replace({S.fold('category_label', ascii_only=True)}, '[^a-zA-Z0-9]+', '-', 'g'), '-')) END")
    api = "'https://tienda.mercadona.es/api/categories/' || {} || '/'"
    return with_views("groups_base") + f"""
, cands AS (
  SELECT pos, 0 AS c_pos, {slug} AS "group", category_label AS category, leaf AS subcategory,
         {api.format('cid')} AS url FROM groups_base WHERE pos % 4 <> 1
  UNION ALL
  SELECT pos, 3, {slug}, category_label, leaf || ' extra', {api.format("cid || '8'")} FROM groups_base),
ranked AS (SELECT *, row_number() OVER (PARTITION BY category, subcategory, url ORDER BY pos, c_pos) AS rn FROM cands)
SELECT "group", category, subcategory, url FROM ranked WHERE rn = 1
ORDER BY "group", category, subcategory, url
"""


@query("group_payload_targets", _groups_sql())
def q_group_payload_targets(spark, sf_dir):
    g = load_view(spark, sf_dir, "groups_base")
    t = PL.flatten_group_payload(g, "payload", keep=("pos",))
    t = t.withColumn("target_index", F.struct(F.col("pos"), F.col("target_index.g_pos"), F.col("target_index.c_pos")))
    d = M.targets_distinct(t.drop("pos"))
    return M.targets_sort(d.select("group", "category", "subcategory", "url"))
