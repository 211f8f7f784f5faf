"""Driver queries for the streaming operators (T1 day load, T2 snapshot
upsert). Each lands files derived from the driver tables in a scratch
folder under the checkpoint folder, runs the stream to completion with an
``availableNow`` trigger and reads the result back. The oracle is the
batch SQL of the same operation."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pricelake.functions import constants as K
from pricelake.plans.daily import write_daily
from pricelake.plans.q_merge import _merge_sql
from pricelake.plans.registry import query
from pricelake.plans.views import load_view, with_views
from pricelake.session import materialize, scratch_path
from pricelake.sources.landing import PRODUCT_SCHEMA
from pricelake.sources.versions import read_table
from pricelake.streaming.day_load import start_day_load
from pricelake.streaming.event_load import start_event_load
from pricelake.streaming.snapshot_upsert import read_state, start_snapshot_upsert

SOURCES = ["carrefour", "alcampo", "dia", "mercadona", "lidl"]  # by target_index 1..5; the last has no table
_P = ", ".join(K.PRODUCT_COLUMNS)


def _source_col():
    expr = F.lit(None).cast("string")
    for i, s in reversed(list(enumerate(SOURCES, start=1))):
        expr = F.when(F.col("target_index") == i, F.lit(s)).otherwise(expr)
    return expr


def _land_files(spark, rows, landing_root: str) -> None:
    """One Parquet file per (source, path day) at ``<root>/<source>/<day>/``
    (Al Campo's one folder deeper). A day file is one object, so a day has one
    writer. Every year's file also carries the next 1 January's rows (a run
    across midnight). Files get modification times in (source, day) order."""
    files = (rows.withColumn("pday", F.col("date"))
             .unionByName(rows.where((F.month("orig") == 1) & (F.dayofmonth("orig") == 1))
                          .withColumn("pday", F.add_months(F.col("date"), -12)))
             .withColumn("price", F.concat(F.col("price"), F.lit(" *"))))
    staging = landing_root.rstrip("/") + "_staging"
    (files.select("source", "pday", *K.PRODUCT_COLUMNS).repartition("source", "pday")
     .write.partitionBy("source", "pday").parquet(staging))
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    Path = jvm.org.apache.hadoop.fs.Path
    fs = Path(staging).getFileSystem(conf)
    found = []
    for sd in fs.listStatus(Path(staging)):
        name = sd.getPath().getName()
        if not name.startswith("source="):
            continue
        for dd in fs.listStatus(sd.getPath()):
            found.append((name.split("=", 1)[1], dd.getPath().getName().split("=", 1)[1], dd.getPath()))
    base = 1_700_000_000_000
    for i, (src, day, p) in enumerate(sorted(found, key=lambda x: (x[0], x[1]))):
        dst = Path(f"{landing_root.rstrip('/')}/{src}/{day}{'/second run' if src == 'alcampo' else ''}")
        fs.mkdirs(dst.getParent())
        fs.rename(p, dst)
        for st in fs.listStatus(dst):
            fs.setTimes(st.getPath(), base + 1000 * i, -1)


@query("day_load_stream", with_views("rows_base") + f"""
, r AS (SELECT *, date AS orig, CASE target_index WHEN 1 THEN 'carrefour' WHEN 2 THEN 'alcampo' WHEN 3 THEN 'dia'
                    WHEN 4 THEN 'mercadona' ELSE 'lidl' END AS source FROM rows_base),
t AS (SELECT * EXCLUDE (date), date_trunc('year', orig)::DATE AS date, CASE source {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in K.SOURCE_TABLES.items())} END AS table_name
      FROM r),
fr AS (SELECT t.*, date AS pday FROM t
       UNION ALL
       SELECT t.*, (date - INTERVAL 1 YEAR)::DATE AS pday FROM t
       WHERE month(orig) = 1 AND day(orig) = 1),
files AS (SELECT DISTINCT table_name, pday FROM fr WHERE table_name IS NOT NULL)
SELECT table_name, {_P} FROM (
SELECT table_name, {_P} FROM t i
WHERE table_name IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM files f WHERE f.table_name = i.table_name AND f.pday = i.date)
UNION ALL
SELECT table_name, date, product, brand, price || ' *' AS price, price_per_unit, offer, category, subcategory,
       product_url
FROM fr x
WHERE table_name IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM files f WHERE f.table_name = x.table_name AND f.pday = x.date AND f.pday > x.pday))
WHERE NOT (table_name = '{K.SOURCE_TABLES["dia"]}' AND date = (SELECT min(date) FROM t WHERE source = 'dia'))
""")
def q_day_load_stream(spark, sf_dir):
    """T1 end to end: bronze tables hold an earlier load; the landed files
    then replace their days through the stream. Al Campo's files lie one
    folder deeper, under a name with a blank. A second stream with its own
    checkpoint lands a file without rows, which empties Dia's first day."""
    root = scratch_path(spark, "dayload")
    # One scrape day per order year: each year's file is that day's run.
    rows = (load_view(spark, sf_dir, "rows_base").withColumn("orig", F.col("date"))
            .withColumn("date", F.trunc("orig", "year")).withColumn("source", _source_col()))
    tables = F.create_map(*[x for kv in K.SOURCE_TABLES.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    initial = rows.withColumn("table_name", F.try_element_at(tables, F.col("source"))) \
        .where(F.col("table_name").isNotNull())
    initial.select("table_name", *K.PRODUCT_COLUMNS).write.partitionBy("table_name", "date").parquet(f"{root}/tables")
    _land_files(spark, rows, f"{root}/landing")
    q = start_day_load(spark, f"{root}/landing", f"{root}/tables", f"{root}/checkpoint", max_files_per_trigger=8)
    q.awaitTermination()
    first = rows.where("source = 'dia'").agg(F.min("date")).first()[0]
    if first is not None:
        (spark.createDataFrame([], PRODUCT_SCHEMA).coalesce(1).write
         .parquet(f"{root}/late/dia/{first}/empty"))
        start_day_load(spark, f"{root}/late", f"{root}/tables", f"{root}/checkpoint-late").awaitTermination()
    return spark.read.parquet(f"{root}/tables").select("table_name", *K.PRODUCT_COLUMNS)


@query("day_object_load", with_views("rows_base") + f"""
, r AS (SELECT * REPLACE (date_trunc('year', date)::DATE AS date), CASE target_index % 2 WHEN 1 THEN 'carrefour' ELSE 'dia' END AS source
        FROM rows_base)
SELECT CASE source {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in K.SOURCE_TABLES.items())} END AS table_name, {_P} FROM r
""")
def q_day_object_load(spark, sf_dir):
    """S7 into T1: each run's day is one object of several part files, and the
    stream, which takes a few files at a time, loads every row of it."""
    root = scratch_path(spark, "dayobjects")
    rows = materialize(load_view(spark, sf_dir, "rows_base").withColumn("date", F.trunc("date", "year"))
                       .withColumn("source", F.when(F.col("target_index") % 2 == 1, "carrefour").otherwise("dia")))
    for run in rows.select("source", "date").distinct().collect():  # a row per run
        write_daily(rows.where((F.col("source") == run.source) & (F.col("date") == run.date)), f"{root}/landing",
                    run.source, run.date, rows_per_file=400)
    start_day_load(spark, f"{root}/landing", f"{root}/tables", f"{root}/checkpoint", max_files_per_trigger=16).awaitTermination()
    return spark.read.parquet(f"{root}/tables").select("table_name", *K.PRODUCT_COLUMNS)


# Quarterly runs of one year. The second generation of the first and third quarter
# is written and posted; then the first one of the others, with a late event of
# generation 1 for all; then the second of the others. Every event comes twice.
@query("event_load_stream", with_views("rows_base") + f"""
, r AS (SELECT * REPLACE (date_trunc('quarter', date)::DATE AS date, CASE quarter(date) % 2 WHEN 1 THEN price ELSE price || ' *' END AS price),
               CASE target_index % 2 WHEN 1 THEN 'carrefour' ELSE 'dia' END AS source FROM rows_base WHERE year(date) = 1995)
SELECT CASE source {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in K.SOURCE_TABLES.items())} END AS table_name, {_P} FROM r
""")
def q_event_load_stream(spark, sf_dir):
    """S11 into S8 and S9: duplicated and late events; an event that is late finds
    an object that holds other rows by now and must not load it."""
    root = scratch_path(spark, "eventload")
    rows = materialize(load_view(spark, sf_dir, "rows_base").where(F.year("date") == 1995)
                       .withColumn("date", F.trunc("date", "quarter"))
                       .withColumn("source", F.when(F.col("target_index") % 2 == 1, "carrefour").otherwise("dia")))
    runs = rows.select("source", "date").distinct().collect()  # a row per run

    def deliver(generation: int, posted: list, price: str) -> None:
        """Write the quarters' objects and post their events, each twice."""
        for run in runs:
            if (run.date.month + 2) // 3 in posted:
                write_daily(rows.where((F.col("source") == run.source) & (F.col("date") == run.date)).withColumn("price", F.expr(price)),
                            f"{root}/objects/raw", run.source, run.date, rows_per_file=200)
        name = F.concat_ws("/", "source", "date", F.concat("source", F.lit("_supermercado_"), "date", F.lit(".parquet")))
        event = F.to_json(F.struct(F.lit("raw").alias("bucket"), name.alias("name"), F.lit(str(generation)).alias("generation")))
        (spark.createDataFrame(runs, "source string, date date").where(F.quarter("date").isin(posted))
         .select(F.explode(F.array(event, event)).alias("value")).coalesce(1).write.text(f"{root}/events/{uuid.uuid4().hex}"))
        start_event_load(spark, f"{root}/events", f"{root}/objects", f"{root}/tables", f"{root}/checkpoint", "raw").awaitTermination()

    deliver(2, [1, 3], "price")
    deliver(1, [1, 2, 3, 4], "concat(price, ' late')")
    deliver(2, [2, 4], "concat(price, ' *')")
    return read_table(spark, f"{root}/tables")


# Order status O rows are JSON-LD rows; the oracle takes those of a snapshot
# while no snapshot up to it has a card URL and no earlier one any URL.
_LD_TAKEN = """subcategory <> 'O' OR NOT EXISTS (
  SELECT 1 FROM (SELECT DISTINCT target_index, page_seq, subcategory = 'O' AS ld FROM rows_base WHERE product_url <> '') u
  WHERE u.target_index = r.target_index AND (u.page_seq < r.page_seq OR (u.page_seq = r.page_seq AND NOT u.ld)))"""


@query("snapshot_upsert_stream", _merge_sql(False, _LD_TAKEN, "subcategory = 'O', pos"))
def q_snapshot_upsert_stream(spark, sf_dir):
    """T2 end to end: snapshot rows (cards and JSON-LD) stream in a few
    files per batch; the keyed state is read back after the last batch."""
    root = scratch_path(spark, "snapshots")
    rows = load_view(spark, sf_dir, "rows_base").withColumn(
        "kind", F.when(F.col("subcategory") == "O", "jsonld").otherwise("card"))
    rows.write.option("maxRecordsPerFile", 20_000).parquet(f"{root}/feed")
    q = start_snapshot_upsert(spark, f"{root}/feed", f"{root}/state", f"{root}/checkpoint", max_files_per_trigger=3)
    q.awaitTermination()
    out = read_state(spark, f"{root}/state")
    return out.select("target_index", "page_seq", "pos", "date", "product", "brand", "price", "price_per_unit",
                      "offer", "category", "subcategory", "product_url", "merge_rank")
