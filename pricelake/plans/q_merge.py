"""Driver queries for dedup, merge, limits and target lists (W1-W2, A1-A5,
J3, J4, J6, J7, O1, O3, P13, U1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelake.functions import constants as K
from pricelake.functions.text import title_case
from pricelake.operators import merge as M
from pricelake.plans import sqlfrag as S
from pricelake.plans.registry import query
from pricelake.plans.views import load_view, with_views

ROW_COLS = ["target_index", "page_seq", "pos", "date", "product", "brand", "price", "price_per_unit", "offer",
            "category", "subcategory", "product_url"]
_ROWS = ", ".join(ROW_COLS)

# -- W1 ---------------------------------------------------------------------

_W1_SQL = with_views("rows_base") + f"""
SELECT {_ROWS} FROM rows_base WHERE product_url = ''
UNION ALL
SELECT {_ROWS} FROM (
  SELECT *, row_number() OVER (PARTITION BY product_url ORDER BY target_index, page_seq, pos) AS rn
  FROM rows_base WHERE product_url <> '') WHERE rn = 1
"""


@query("dedup_first_wins", _W1_SQL, headline=True)
def q_dedup_first_wins(spark, sf_dir):
    return M.dedup_first_wins(load_view(spark, sf_dir, "rows_base"))


# -- A2 + J4 ----------------------------------------------------------------

def _merge_sql(trim_used: bool, where: str = "true", order: str = "pos") -> str:
    """The merge over the rows of ``rows_base`` that meet ``where``; ``order``
    places rows inside a snapshot."""
    used = S.strip("product") if trim_used else "product"
    desc = ", ".join(f"{c} DESC" for c in order.split(", "))
    return with_views("rows_base") + f"""
, t AS (
  SELECT *, {S.strip('product_url')} AS _url, lower({S.strip('product')}) AS _name FROM rows_base r WHERE {where}),
keyed AS (
  SELECT *, CASE WHEN _url <> '' THEN 0 ELSE 1 END AS merge_rank,
         CASE WHEN _url <> '' THEN _url ELSE _name END AS _k
  FROM t WHERE _url <> '' OR _name <> ''),
w AS (
  SELECT *,
    row_number() OVER (PARTITION BY target_index, merge_rank, _k ORDER BY page_seq DESC, {desc}) AS rn_last,
    first_value(page_seq) OVER (PARTITION BY target_index, merge_rank, _k ORDER BY page_seq, {order}) AS f_seq,
    first_value(pos) OVER (PARTITION BY target_index, merge_rank, _k ORDER BY page_seq, {order}) AS f_pos
  FROM keyed),
last AS (SELECT * FROM w WHERE rn_last = 1),
used AS (SELECT DISTINCT target_index, lower({used}) AS nm FROM last WHERE merge_rank = 0)
SELECT target_index, f_seq AS page_seq, f_pos AS pos, date, product, brand, price, price_per_unit, offer,
       category, subcategory, product_url, merge_rank
FROM last l
WHERE merge_rank = 0
   OR NOT EXISTS (SELECT 1 FROM used u WHERE u.target_index = l.target_index AND u.nm = l._k)
"""


@query("merge_last_wins", _merge_sql(True), headline=True)
def q_merge_last_wins(spark, sf_dir):
    return M.merge_last_wins(load_view(spark, sf_dir, "rows_base"))


@query("name_anti_merge", _merge_sql(False))
def q_name_anti_merge(spark, sf_dir):
    """The snapshot-loop variant: URL-row names compared without trimming."""
    return M.merge_last_wins(load_view(spark, sf_dir, "rows_base"), trim_used_names=False)


# -- full Dia run: merge per category, then first-wins across the run ---------

def _run_sql() -> str:
    merged = _merge_sql(True)
    body = merged[merged.index(", t AS ("):]
    final_select = body[body.index("SELECT target_index, f_seq AS page_seq"):]
    ctes = body[:body.index("SELECT target_index, f_seq AS page_seq")]
    return with_views("rows_base") + ctes + f""", merged AS ({final_select})
SELECT {_ROWS}, merge_rank FROM merged WHERE product_url = ''
UNION ALL
SELECT {_ROWS}, merge_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY product_url ORDER BY target_index, merge_rank, page_seq, pos) AS rn
  FROM merged WHERE product_url <> '') WHERE rn = 1
"""


@query("daily_run_dia", _run_sql(), headline=True)
def q_daily_run(spark, sf_dir):
    """Per-category merge (A2+J4) followed by run-wide first-wins."""
    merged = M.merge_last_wins(load_view(spark, sf_dir, "rows_base"))
    return M.dedup_first_wins(merged)


# -- W2 / O3 ------------------------------------------------------------------

CAP_N = 1000
LIMIT_N = 500

_CAP_SQL = with_views("rows_base") + f"""
SELECT {_ROWS} FROM (
  SELECT *, row_number() OVER (PARTITION BY target_index ORDER BY page_seq, pos) AS rn FROM rows_base)
WHERE rn <= {CAP_N}
"""


@query("cap_per_target", _CAP_SQL)
def q_cap_per_target(spark, sf_dir):
    return M.cap_per_group(load_view(spark, sf_dir, "rows_base"), CAP_N)


_LIMIT_SQL = with_views("rows_base") + f"""
SELECT {_ROWS} FROM rows_base ORDER BY target_index, page_seq, pos LIMIT {LIMIT_N}
"""


@query("limit_total", _LIMIT_SQL)
def q_limit_total(spark, sf_dir):
    return M.limit_total(load_view(spark, sf_dir, "rows_base"), LIMIT_N)


# -- A5 + J3 ------------------------------------------------------------------

FIRST_N = 3
_TGT = 'target_index, "group", category, subcategory, url'


def _first_n_sql(n: int) -> str:
    return with_views("targets_base") + f"""
, firsts AS (
  SELECT {S.strip('category')} AS v, min(target_index) AS o FROM targets_base
  WHERE {S.strip('category')} <> '' GROUP BY 1),
allowed AS (SELECT v FROM firsts ORDER BY o, v LIMIT {max(n, 1)})
SELECT {_TGT} FROM targets_base WHERE {S.strip('category')} IN (SELECT v FROM allowed)
"""


def _targets(spark, sf_dir):
    return load_view(spark, sf_dir, "targets_base").drop("p_size")


@query("first_n_categories", _first_n_sql(FIRST_N))
def q_first_n_categories(spark, sf_dir):
    return M.keep_first_n_values(_targets(spark, sf_dir), "category", FIRST_N)


@query("first_n_categories_zero", _first_n_sql(0))
def q_first_n_categories_zero(spark, sf_dir):
    """N = 0 still keeps one category (the limit is tested after the append)."""
    return M.keep_first_n_values(_targets(spark, sf_dir), "category", 0)


# -- A1 + O1 ------------------------------------------------------------------

_DISTINCT_SQL = with_views("targets_base") + f"""
SELECT {_TGT} FROM (
  SELECT *, row_number() OVER (PARTITION BY category, subcategory, url ORDER BY target_index) AS rn
  FROM targets_base) WHERE rn = 1
ORDER BY "group", category, subcategory, url
"""


@query("targets_distinct_sorted", _DISTINCT_SQL)
def q_targets_distinct_sorted(spark, sf_dir):
    return M.targets_sort(M.targets_distinct(_targets(spark, sf_dir)))


# -- J7 -----------------------------------------------------------------------
# Parents: one category page per (group, brand). Children: the parts of
# size below 5 under it, each its own subcategory page.

_J7_SQL = with_views("targets_base") + """
, parents AS (
  SELECT DISTINCT "group", category, 'https://shop.example/c/' || "group" || '/' || lower(category) AS url
  FROM targets_base),
children AS (
  SELECT "group", category, subcategory,
         'https://shop.example/c/' || "group" || '/' || lower(category) || '/' || cast(target_index as string) AS url
  FROM targets_base WHERE p_size < 5)
SELECT "group", category, subcategory, url FROM children
UNION ALL
SELECT "group", category, '' AS subcategory, url FROM parents p
WHERE NOT EXISTS (SELECT 1 FROM children c WHERE c."group" = p."group" AND c.category = p.category)
"""


@query("fallback_when_childless", _J7_SQL)
def q_fallback_when_childless(spark, sf_dir):
    t = load_view(spark, sf_dir, "targets_base")
    page = F.concat(F.lit("https://shop.example/c/"), F.col("group"), F.lit("/"), F.lower("category"))
    parents = t.select("group", "category", page.alias("url")).distinct()
    children = t.where(F.col("p_size") < 5).select(
        "group", "category", "subcategory",
        F.concat(page, F.lit("/"), F.col("target_index").cast("string")).alias("url"))
    return M.fallback_when_childless(parents, children, ["group", "category"])


# -- J6 -----------------------------------------------------------------------

def _label_case_sql(x: str) -> str:
    whens = " ".join(f"WHEN {S.lit(k)} THEN {S.lit(v)}" for k, v in K.ALCAMPO_GROUP_LABELS.items())
    return f"CASE {x} {whens} END"


_J6_SQL = with_views("targets_base") + f"""
, slugs AS (SELECT DISTINCT replace(subcategory, ' ', '-') AS slug FROM targets_base
            UNION SELECT DISTINCT "group" FROM targets_base)
SELECT slug, coalesce({_label_case_sql('slug')}, {S.title("replace(slug, '-', ' ')")}) AS label FROM slugs
"""


@query("group_label_lookup", _J6_SQL)
def q_group_label_lookup(spark, sf_dir):
    from pricelake.operators.targets import group_label
    t = load_view(spark, sf_dir, "targets_base")
    slugs = (t.select(F.replace("subcategory", F.lit(" "), F.lit("-")).alias("slug"))
             .union(t.select(F.col("group").alias("slug"))).distinct())
    return slugs.select("slug", group_label("slug").alias("label"))


# -- S2 + S1: targets written as a document folder and read back -------------------

_ROUNDTRIP_SQL = with_views("targets_base") + """
, d AS (SELECT *, row_number() OVER (PARTITION BY category, subcategory, url ORDER BY target_index) AS rn
        FROM targets_base)
SELECT row_number() OVER (ORDER BY "group", category, subcategory, url) - 1 AS target_index,
       "group", category, subcategory, url
FROM d WHERE rn = 1
"""


@query("targets_roundtrip", _ROUNDTRIP_SQL)
def q_targets_roundtrip(spark, sf_dir):
    import datetime as dt
    from pricelake.session import scratch_path
    from pricelake.sources.targets import read_targets, write_targets
    path = scratch_path(spark, "targets")
    write_targets(M.targets_distinct(_targets(spark, sf_dir)), path, ["https://shop.example/c/"],
                  dt.datetime(2025, 1, 2, 3, 4, 5))
    return read_targets(spark, path)


@query("targets_document", _ROUNDTRIP_SQL)
def q_targets_document(spark, sf_dir):
    """S1 + S2 in the single-document form: written as one JSON value and read back."""
    import datetime as dt
    from pricelake.session import scratch_path
    from pricelake.sources.targets import read_targets, write_targets_document
    path = scratch_path(spark, "document") + ".json"
    write_targets_document(M.targets_distinct(_targets(spark, sf_dir)), path, ["https://shop.example/c/"],
                           dt.datetime(2025, 1, 2, 3, 4, 5))
    return read_targets(spark, path)



@query("write_daily", f"""SELECT DATE '2025-01-15' AS date, product, brand, price, price_per_unit, offer, category, subcategory,
       product_url FROM ({_run_sql()})""")
def q_write_daily(spark, sf_dir):
    """The run's rows written as its day file and read back."""
    from pricelake.plans.daily import project, write_daily
    from pricelake.session import scratch_path
    return spark.read.parquet(write_daily(project(q_daily_run(spark, sf_dir), "2025-01-15"), scratch_path(spark, "daily"),
                                          "dia", "2025-01-15"))
