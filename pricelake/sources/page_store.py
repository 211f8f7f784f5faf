"""The page store: fetched snapshots as a table bucketed by URL.

A shop's daily run asks for the last good snapshot of every page. On a plain
folder that either parses snapshots which are dropped afterwards, or shuffles
html. The store pays for one shuffle when a day is written: its table is
partitioned by shop and day and bucketed by url, and the block markers of a
page (P14) are looked up then and kept as a column. Later reads choose the
snapshot on keys, bucket by bucket, without an exchange, and only the chosen
html reaches the page job.

The table is a catalog table (Spark knows buckets from the catalog only): on a
cluster the catalog is its metastore.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.operators.pages import page_blocked

COLUMNS = ["url", "snapshot_seq", "status", "blocked", "html", "shop", "day"]
#: Buckets of a new store. A bucket of a shop's day is one file and one task.
BUCKETS = 256


def write_day(pages: DataFrame, table: str, shop: str, day: str, buckets: int = BUCKETS, path: str | None = None) -> None:
    """Replaces one shop's day of the store ``table`` by ``pages`` (url,
    snapshot_seq, status, html); other days stay. The first write creates the
    table, at ``path`` if given. A null status is kept (an unfinished fetch)."""
    spark = pages.sparkSession
    rows = pages.select("url", F.col("snapshot_seq").cast("long").alias("snapshot_seq"),
                        F.col("status").cast("int").alias("status"),
                        page_blocked(F.col("status"), F.col("html")).alias("blocked"), "html",
                        F.lit(shop).alias("shop"), F.lit(str(day)).alias("day"))
    if not spark.catalog.tableExists(table):
        empty = (spark.createDataFrame([], rows.schema).write.format("parquet").partitionBy("shop", "day")
                 .bucketBy(buckets, "url"))
        (empty.option("path", path) if path else empty).saveAsTable(table)
    # dealt as the buckets are, so that a bucket is one file
    dealt = rows.repartition(buckets, "url").select(*COLUMNS)
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        dealt.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def good_pages(spark: SparkSession, table: str, shop: str, day: str) -> DataFrame:
    """Snapshots of a shop's day without error statuses, unfinished fetches
    and block pages: (url, snapshot_seq, status, blocked, html)."""
    return (spark.table(table).where((F.col("shop") == shop) & (F.col("day") == str(day)))
            .where("status < 400 AND NOT blocked").drop("shop", "day"))


def last_pages(spark: SparkSession, table: str, shop: str, day: str) -> DataFrame:
    """The last good snapshot of every URL, chosen on (url, snapshot_seq).

    Both sides are read bucket by bucket and joined on the bucket key, with
    the keys as the hash side, so html is neither shuffled nor sorted. Rows
    that repeat a URL's last number all stay; rows without a URL are no pages."""
    good = good_pages(spark, table, shop, day)
    last = good.groupBy("url").agg(F.max("snapshot_seq").alias("_last"))
    # >= and not =: an equality would become a join key that the buckets don't have
    return (good.join(last.hint("shuffle_hash"), "url").where(F.col("snapshot_seq") >= F.col("_last")).drop("_last"))
