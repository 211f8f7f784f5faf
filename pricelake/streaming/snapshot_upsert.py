"""Keyed last-wins merge over a growing feed of page snapshots.

Snapshot rows (one category page re-read after every scroll) stream in;
per (category, key) the state keeps the latest row by ``(snapshot, pos)``
and the key's first position, exactly the dict-of-rows the scroll loop
keeps. URL rows are keyed by URL, the rest by lower-cased name. The
aggregate is a ``max``/``min`` over structs, so micro-batches may arrive in
any order and give the same state, and aggregates of parts of the feed
aggregate again to that of the whole, also where a part is read twice. The
state grows with the number of keys of a run (no event time, so no watermark):
run one stream per run day.

Each micro-batch aggregates its own rows into a folder of the log with the
batch's number; no batch loads or copies the state, so a late one costs what an early one does.
Every ``COMPACT_EVERY`` batches the log is folded into a *generation*, a table
of one row per key of the batches that it covers. It takes in the newest older
generations as well, while one is less than twice as large as what it is folded
with: so generations at least halve in size from the oldest on, a row is written
again a number of times that grows with the logarithm of the state, and a feed that
repeats its keys keeps one generation. A generation takes its name when it is whole, and what
it covers is deleted then. What is kept and read is at most twice the keys plus
``COMPACT_EVERY`` batches, however long the stream runs.
JSON-LD rows (``kind = 'jsonld'``; everything else is a card row) are kept
per snapshot, because which snapshots' JSON-LD counts (W3) is known only
from the whole feed. ``read_state`` folds the generations and the log per key (an
aggregate, combined map-side), gates the JSON-LD rows,
merges both kinds per key and applies the name rule (name rows whose
name a URL row already has are dropped). A replayed batch writes its folder
again; one that a generation covers is deleted with the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.functions.text import coalesce_blank, strip
from pricelake.operators.merge import jsonld_gate
from pricelake.session import materialize
from pricelake.sources.landing import _fs

#: Batches that the change log holds before they are folded into a generation.
COMPACT_EVERY = 8

SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("target_index", T.LongType()),
    T.StructField("page_seq", T.LongType()),
    T.StructField("pos", T.LongType()),
    T.StructField("date", T.DateType()),
    T.StructField("product", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("price_per_unit", T.StringType()),
    T.StructField("offer", T.BooleanType()),
    T.StructField("category", T.StringType()),
    T.StructField("subcategory", T.StringType()),
    T.StructField("product_url", T.StringType()),
    T.StructField("kind", T.StringType()),
])
_PAYLOAD = [f.name for f in SNAPSHOT_SCHEMA.fields if f.name not in ("target_index", "page_seq", "pos", "kind")]
_KEYS = ["target_index", "is_ld", "ld_seq", "merge_rank", "_k"]


def keyed_state(rows: DataFrame) -> DataFrame:
    """The state aggregate of some of the feed's rows."""
    url = strip(coalesce_blank(F.col("product_url")))
    name = F.lower(strip(coalesce_blank(F.col("product"))))
    ld = F.coalesce(F.col("kind") == "jsonld", F.lit(False))
    k = rows.select("*", F.when(url != "", F.lit(0)).when(name != "", F.lit(1)).alias("merge_rank"),
                    F.when(url != "", url).otherwise(name).alias("_k"), ld.alias("is_ld"),
                    F.when(ld, F.col("page_seq")).alias("ld_seq")).where(F.col("merge_rank").isNotNull())
    # within a snapshot, JSON-LD rows come after the cards
    place = ["page_seq", "is_ld", "pos"]
    return k.groupBy(*_KEYS).agg(F.max(F.struct(*place, *_PAYLOAD)).alias("_last"),
                                 F.min(F.struct(*place)).alias("_first"))


def start_snapshot_upsert(spark: SparkSession, snapshots_root: str, state_root: str, checkpoint: str,
                          max_files_per_trigger: int = 4, available_now: bool = True, compact_every: int = COMPACT_EVERY):
    stream = (spark.readStream.schema(SNAPSHOT_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(snapshots_root))

    def batch(df: DataFrame, batch_id: int) -> None:
        keyed_state(df).write.mode("overwrite").parquet(f"{state_root.rstrip('/')}/log/{batch_id}")
        if (batch_id + 1) % compact_every == 0:
            fold_log(spark, state_root)

    w = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    fs, p = _fs(spark, folder)
    names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n) for n in names if n.isdigit())


def live_folders(spark: SparkSession, state_root: str) -> tuple[list[int], list[int]]:
    """The generations (the batch that each reaches up to) and the batches of the log after the newest."""
    root = state_root.rstrip("/")
    generations = _numbers(spark, f"{root}/generation")
    return generations, [n for n in _numbers(spark, f"{root}/log") if not generations or n > generations[-1]]


def _paths(state_root: str, generations: list[int], batches: list[int]) -> list[str]:
    root = state_root.rstrip("/")
    return [f"{root}/log/{n}" for n in batches] + [f"{root}/generation/{n}" for n in generations]


def state_log(spark: SparkSession, state_root: str) -> DataFrame:
    """The rows of the generations and of the log after them."""
    return spark.read.schema(_state_schema(spark)).parquet(*_paths(state_root, *live_folders(spark, state_root)))


def _state_schema(spark: SparkSession) -> T.StructType:
    return keyed_state(spark.createDataFrame([], SNAPSHOT_SCHEMA)).schema


def _size(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def fold_log(spark: SparkSession, state_root: str) -> None:
    """Write the next generation; then delete what it covers."""
    root = state_root.rstrip("/")
    generations, batches = live_folders(spark, state_root)
    if not batches:
        return
    size, covered = sum(_size(spark, p) for p in _paths(root, [], batches)), []
    for n in reversed(generations):
        older = _size(spark, f"{root}/generation/{n}")
        if older >= 2 * size:
            break
        size, covered = size + older, [*covered, n]
    staging, path = f"{root}/generation/_{batches[-1]}", f"{root}/generation/{batches[-1]}"
    compact(spark.read.schema(_state_schema(spark)).parquet(*_paths(root, covered, batches))).write.mode("overwrite").parquet(staging)
    fs, done = _fs(spark, path)
    if not fs.rename(_fs(spark, staging)[1], done):
        raise OSError(f"{staging} could not be renamed to {path}")
    for n in _numbers(spark, f"{root}/log"):
        if n <= batches[-1]:
            fs.delete(_fs(spark, f"{root}/log/{n}")[1], True)
    for n in covered:
        fs.delete(_fs(spark, f"{root}/generation/{n}")[1], True)


def compact(log: DataFrame) -> DataFrame:
    """Per key, the state of the whole from those of its parts."""
    return log.groupBy(*_KEYS).agg(F.max("_last").alias("_last"), F.min("_first").alias("_first"))


def gated(state: DataFrame) -> DataFrame:
    """W3 on state rows, then both kinds merged per key."""
    kind = F.when(F.col("is_ld"), F.lit("jsonld")).otherwise(F.lit("card"))
    rows = state.select("*", kind.alias("kind"), F.col("_first.page_seq").alias("page_seq"),
                        F.when(F.col("merge_rank") == 0, F.col("_k")).otherwise(F.lit("")).alias("url"))
    rows = jsonld_gate(rows, url_col="url")
    return rows.groupBy("target_index", "merge_rank", "_k").agg(F.max("_last").alias("_last"), F.min("_first").alias("_first"))


def merged_rows(state: DataFrame) -> DataFrame:
    """State rows -> product rows at the key's first position, plus the
    name rule on the surviving URL rows (``product.lower()``, no trim)."""
    rows = gated(state).select("target_index", "merge_rank", "_k", F.col("_first.page_seq").alias("page_seq"),
                               F.col("_first.pos").alias("pos"), *[F.col("_last." + c).alias(c) for c in _PAYLOAD])
    rows = materialize(rows)  # read three times below
    used = rows.where(F.col("merge_rank") == 0).select(
        "target_index", F.lower(coalesce_blank(F.col("product"))).alias("_k")).distinct()
    names = rows.where(F.col("merge_rank") == 1).join(used, ["target_index", "_k"], "left_anti")
    return rows.where(F.col("merge_rank") == 0).unionByName(names).drop("_k")


def read_state(spark: SparkSession, state_root: str) -> DataFrame:
    return merged_rows(compact(state_log(spark, state_root)))
