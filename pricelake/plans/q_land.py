"""Driver queries for landing (S6/A7, S9, S10, S11, J5) and the
pagination walk (I1)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from pricelake.functions import constants as K
from pricelake.operators.walk import pagination_walk
from pricelake.plans import sqlfrag as S
from pricelake.plans.registry import query
from pricelake.plans.views import load_view, read_table, with_views
from pricelake.session import scratch_path
from pricelake.sources import landing as LD
from pricelake.sources import versions as V

RAW_BUCKET = "raw-bucket"
PRODUCT_COLS = K.PRODUCT_COLUMNS
_P = ", ".join(PRODUCT_COLS)


# -- S10 / S11 / J5 --------------------------------------------------------------

def _events_json(spark, sf_dir):
    """Events as the JSON documents an object store would post."""
    e = load_view(spark, sf_dir, "events_base")
    flat = F.struct("bucket", "name", "generation")
    nested = F.struct(F.lit("").alias("bucket"), F.struct("bucket", "name", "generation").alias("data"))
    return e.select("event_id", F.when(F.col("nested"), F.to_json(nested)).otherwise(F.to_json(flat)).alias("body"))


def _classify_sql() -> str:
    pat = S.lit(K.OBJECT_PATH_PATTERN)
    b = "nullif(bucket, '')"
    n = "nullif(name, '')"
    matches = f"regexp_matches(coalesce({n}, ''), {pat})"
    src = f"lower(regexp_extract(coalesce({n}, ''), {pat}, 1))"
    day = f"try_strptime(regexp_extract(coalesce({n}, ''), {pat}, 2), '%Y-%m-%d')::DATE"
    table = "CASE " + " ".join(f"WHEN {src} = {S.lit(k)} THEN {S.lit(v)}" for k, v in K.SOURCE_TABLES.items()) + " END"
    outcome = (f"CASE WHEN {b} IS NULL OR {n} IS NULL THEN 'missing' "
               f"WHEN {b} <> {S.lit(RAW_BUCKET)} THEN 'bucket_mismatch' "
               f"WHEN NOT {matches} THEN 'not_day_file' WHEN ({table}) IS NULL THEN 'unknown_source' "
               f"WHEN {day} IS NULL THEN 'invalid_day' ELSE 'loaded' END")
    return with_views("events_base") + f"""
, c AS (SELECT event_id, {b} AS obj_bucket, {n} AS obj_name, {outcome} AS outcome,
               CASE WHEN {matches} THEN {src} END AS source, {day} AS d, {table} AS t FROM events_base)
SELECT event_id, obj_bucket, obj_name, outcome,
       CASE outcome WHEN 'missing' THEN 400 WHEN 'invalid_day' THEN 500 ELSE 200 END AS status,
       source, CASE WHEN outcome = 'loaded' THEN d END AS day, CASE WHEN outcome = 'loaded' THEN t END AS table_name
FROM c
"""


@query("object_event_classify", _classify_sql())
def q_object_event_classify(spark, sf_dir):
    ev = _events_json(spark, sf_dir)
    out = LD.classify_events(ev, RAW_BUCKET, json_col="body")
    return out.select("event_id", "obj_bucket", "obj_name", "outcome", F.col("status").cast("int").alias("status"),
                      "source", "day", "table_name")


@query("object_path_parse", with_views("events_base") + f"""
SELECT event_id, name,
  CASE WHEN regexp_matches(name, {S.lit(K.OBJECT_PATH_PATTERN)})
       THEN lower(regexp_extract(name, {S.lit(K.OBJECT_PATH_PATTERN)}, 1)) END AS source,
  try_strptime(regexp_extract(name, {S.lit(K.OBJECT_PATH_PATTERN)}, 2), '%Y-%m-%d')::DATE AS day
FROM events_base
""")
def q_object_path_parse(spark, sf_dir):
    e = load_view(spark, sf_dir, "events_base")
    pat = K.OBJECT_PATH_PATTERN
    return e.select("event_id", "name",
                    F.when(F.col("name").rlike(pat), F.lower(F.regexp_extract("name", pat, 1))).alias("source"),
                    F.try_to_date(F.regexp_extract("name", pat, 2), "yyyy-MM-dd").alias("day"))


# -- S9 -------------------------------------------------------------------------

REPLACE_DAY = "1995-03-15"


def _products(spark, sf_dir):
    return load_view(spark, sf_dir, "rows_base").select(*PRODUCT_COLS)


def _staged(products):
    """A re-scrape of the day: its rows re-priced, plus the next day's rows
    (a run across midnight)."""
    d = F.lit(REPLACE_DAY).cast("date")
    return (products.where((F.col("date") == d) | (F.col("date") == F.date_add(d, 1)))
            .withColumn("price", F.concat(F.col("price"), F.lit(" *"))))


_REPLACE_SQL = with_views("rows_base") + f"""
SELECT {_P} FROM rows_base WHERE coalesce(date <> DATE '{REPLACE_DAY}', true)
UNION ALL
SELECT date, product, brand, price || ' *' AS price, price_per_unit, offer, category, subcategory, product_url
FROM rows_base WHERE date = DATE '{REPLACE_DAY}' OR date = DATE '{REPLACE_DAY}' + INTERVAL 1 DAY
"""


@query("day_replace", _REPLACE_SQL)
def q_day_replace(spark, sf_dir):
    p = _products(spark, sf_dir)
    return LD.day_replace(p, _staged(p), REPLACE_DAY)


@query("day_replace_published", with_views("rows_base") + f"""
, m AS (SELECT * REPLACE (date_trunc('month', date)::DATE AS date) FROM rows_base)
SELECT {_P} FROM m WHERE date <> DATE '1995-03-01'
UNION ALL
SELECT date, product, brand, price || ' *' AS price, price_per_unit, offer, category, subcategory, product_url
FROM m WHERE date = DATE '1995-03-01' OR date = DATE '1995-04-01'
""")
def q_day_replace_published(spark, sf_dir):
    """S9 on stored tables with monthly runs: a first load, published as one
    version, then a re-scrape of one run that holds rows of the next as well."""
    root, p = scratch_path(spark, "versions"), _products(spark, sf_dir).withColumn("date", F.trunc("date", "month"))
    V.publish(spark, root, p.withColumn("table_name", F.lit("t")), [])
    staged = (p.where(F.col("date").isin(dt.date(1995, 3, 1), dt.date(1995, 4, 1)))
              .withColumn("price", F.concat(F.col("price"), F.lit(" *"))))
    V.replace_day(spark, root, "t", staged, "1995-03-01")
    return V.read_table(spark, root, "t").drop("table_name")


# -- S6 / A7 --------------------------------------------------------------------

def _profile_sql(source_sql: str, cols, group: str) -> str:
    na = "[" + ", ".join(S.lit(w) for w in K.PANDAS_NA_VALUES) + "]"
    bools = "[" + ", ".join(S.lit(w) for w in LD._BOOL) + "]"
    parts = []
    for c in cols:
        v = f"coalesce(cast({c} AS VARCHAR), '')"
        miss = f"list_contains({na}, {v})"
        parts.append(f"""SELECT {group}, '{c}' AS "column",
  count_if({miss}) AS m, count_if(NOT {miss}) AS n, count_if(NOT {miss} AND list_contains({bools}, {v})) AS nb,
  count_if(NOT {miss} AND regexp_matches({v}, {S.lit(LD._INT)})) AS ni,
  count_if(NOT {miss} AND regexp_matches({v}, {S.lit(LD._FLOAT)})) AS nf
FROM src GROUP BY {group}""")
    body = "\nUNION ALL\n".join(parts)
    return f"""{source_sql}
SELECT {group}, "column",
  CASE WHEN n = 0 THEN 'float64' WHEN nb = n THEN CASE WHEN m > 0 THEN 'object' ELSE 'bool' END
       WHEN ni = n THEN CASE WHEN m > 0 THEN 'float64' ELSE 'int64' END
       WHEN nf = n THEN 'float64' ELSE 'object' END AS dtype,
  cast(m AS BIGINT) AS n_missing
FROM ({body})
"""


@query("column_type_profile", _profile_sql(
    with_views("rows_base") + f", src AS (SELECT {_P}, date AS file_day FROM rows_base)",
    PRODUCT_COLS, "file_day"))
def q_column_type_profile(spark, sf_dir):
    """Per landed day file: the dtype each product column gets on read-back."""
    p = _products(spark, sf_dir).withColumn("file_day", F.col("date"))
    return LD.type_profile(p, PRODUCT_COLS, ["file_day"])


_EV_COLS = ["event_id", "user_id", "value", "props", "ts"]


@query("column_type_profile_events", _profile_sql(
    "WITH src AS (SELECT event_type, event_id, user_id, value, props, "
    "strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events)", _EV_COLS, "event_type"))
def q_column_type_profile_events(spark, sf_dir):
    e = read_table(spark, sf_dir, "events", ["event_type", "event_id", "user_id", "value", "props", "ts"])
    e = e.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return LD.type_profile(e, _EV_COLS, ["event_type"])


# -- I1 -------------------------------------------------------------------------
# Every page is the category page of one walk; page i links to pages 2i+1
# and 2i+2 (their pagination links), so each root walks its subtree.

_WALK_SQL = """
WITH RECURSIVE edges AS (
  SELECT p.page_id AS src_id, c.page_id AS dst_id, c.url AS dst_url
  FROM pages p JOIN pages c ON c.page_id = 2 * p.page_id + 1 OR c.page_id = 2 * p.page_id + 2),
walk(root_id, page_id, url, depth, path) AS (
  SELECT page_id, page_id, url, CAST(0 AS BIGINT), [url] FROM pages
  UNION ALL
  SELECT w.root_id, e.dst_id, e.dst_url, w.depth + 1, list_append(w.path, e.dst_url)
  FROM walk w JOIN edges e ON e.src_id = w.page_id)
SELECT root_id, page_id, url, depth,
       row_number() OVER (PARTITION BY root_id ORDER BY depth, path) - 1 AS page_seq
FROM walk
"""


def walk_edges(pages):
    kids = pages.select(F.col("page_id").alias("src_id"),
                        F.explode(F.array(F.col("page_id") * 2 + 1, F.col("page_id") * 2 + 2)).alias("dst_id"))
    return kids.join(pages.select(F.col("page_id").alias("dst_id"), F.col("url").alias("dst_url")), "dst_id")


@query("pagination_walk", _WALK_SQL)
def q_pagination_walk(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages", ["page_id", "url"])
    roots = pages.select(F.col("page_id").alias("root_id"), "page_id", "url")
    out = pagination_walk(roots, walk_edges(pages))
    return out.select("root_id", "page_id", "url", F.col("depth").cast("bigint").alias("depth"),
                      F.col("page_seq").cast("bigint").alias("page_seq"))


# Eight categories whose pages carry one "next" link each: a page links to the eighth after it.
@query("pagination_chain", """
SELECT page_id % 8 AS root_id, page_id, url, page_id // 8 AS depth, page_id // 8 AS page_seq FROM pages
""")
def q_pagination_chain(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages", ["page_id", "url"])
    first = pages.where(F.col("page_id") < 8).select(F.col("page_id").alias("root_id"), "page_id", "url")
    following = pages.select((F.col("page_id") - 8).alias("src_id"), F.col("page_id").alias("dst_id"), F.col("url").alias("dst_url"))
    return pagination_walk(first, following.where(F.col("src_id") >= 0)).withColumn("depth", F.col("depth").cast("bigint"))
