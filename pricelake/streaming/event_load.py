"""T1 by events: object-arrival events (S11) load day objects (S8) into versioned tables.

Events are JSON lines that land under ``events_root``. Each micro-batch is
classified as in S11; events to load replace their object's day in the order
of their generations, and the whole batch is published as one version.

An object store may deliver an event twice or late. The published version
holds the generation that each object was last loaded at, so an event whose
generation is not newer is dropped, however late it comes and whichever batch
it is in: no watermark, which would drop a late first delivery with its day. That state
is a number per object, and it is published with the rows, so a batch that is
run again after a failure finds its own loads. Events without a generation
can't be told apart and each replaces its day; batches hold them apart by their number.

An object is a file or a Parquet folder (``write_daily``). Events of objects
that aren't there (any more) are reported like the ignored ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.sources import versions as V
from pricelake.sources.landing import _fs, classify_events
from pricelake.streaming.day_load import read_files, surviving_rows


def event_stream(spark: SparkSession, events_root: str, max_files_per_trigger: int = 64) -> DataFrame:
    return (spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).option("recursiveFileLookup", True)
            .text(events_root).select(F.col("value").alias("body")))


def ordered_events(events: DataFrame, raw_bucket: str | None = None) -> DataFrame:
    """S11's outcome per event, with the generation as a number, in the order of loading."""
    out = classify_events(events, raw_bucket, json_col="body")
    text = F.coalesce(F.when(F.col("generation") != "", F.col("generation")), F.col("data.generation"))
    return (out.select("obj_bucket", "obj_name", "outcome", "status", "day", "table_name",
                       text.try_cast("long").alias("gen"))
            .distinct().orderBy(F.col("gen").asc_nulls_first(), "obj_name", "obj_bucket"))


def object_files(spark: SparkSession, path: str) -> list:
    """The Parquet files of an object, a file or a folder of them; [] if it isn't there."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    if not fs.getFileStatus(p).isDirectory():
        return [p.toString()]
    return sorted(st.getPath().toString() for st in fs.listStatus(p) if st.getPath().getName().startswith("part-"))


def apply_events(spark: SparkSession, found: list, objects_root: str, tables_root: str, batch: tuple) -> list:
    """Publish one batch of ordered events; returns (object, reason) of those not loaded."""
    version = V.current(spark, tables_root)
    if version["batches"].get(batch[0], -1) >= batch[1]:
        return []
    loads, skipped, files, days = {}, [], [], []
    for e in found:
        key = f"{e['obj_bucket']}/{e['obj_name']}"
        if e["outcome"] != "loaded":
            skipped.append((key, e["outcome"]))
            continue
        if e["gen"] is not None and e["gen"] <= max(version["loads"].get(key, -1), loads.get(key, -1)):
            skipped.append((key, "not_newer"))
            continue
        # the object's newest content is what a load reads, so an earlier event of this batch has nothing of its own
        paths = object_files(spark, f"{objects_root.rstrip('/')}/{key}")
        if not paths:
            skipped.append((key, "no_object"))
            continue
        if e["gen"] is not None:
            loads[key] = e["gen"]
        files = [f for f in files if f[0] != key] + [(key, e["table_name"], e["day"], paths)]
        days.append((e["table_name"], e["day"]))
    if files:
        meta = [(i, p, t, d) for i, (_, t, d, paths) in enumerate(files) for p in paths]
        rows = surviving_rows(spark, read_files(spark, [m[1] for m in meta]), meta)
        V.publish(spark, tables_root, rows, days, loads, batch)
    return skipped


def start_event_load(spark: SparkSession, events_root: str, objects_root: str, tables_root: str, checkpoint: str,
                     raw_bucket: str | None = None, max_files_per_trigger: int = 64, available_now: bool = True):
    """Start the stream; objects lie at ``<objects_root>/<bucket>/<name>``."""
    tables = tables_root.rstrip("/")

    def run(df: DataFrame, batch_id: int) -> None:
        query_id = spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]
        # the metadata of one batch of events, bounded by maxFilesPerTrigger
        found = ordered_events(df, raw_bucket).collect()
        skipped = apply_events(spark, found, objects_root, tables, (query_id, batch_id))
        if skipped:
            (spark.createDataFrame(skipped, "object string, reason string").coalesce(1).write.mode("overwrite")
             .json(f"{tables}/_skipped/{query_id}/{batch_id}"))

    w = event_stream(spark, events_root, max_files_per_trigger).writeStream.foreachBatch(run) \
        .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def skipped_events(spark: SparkSession, tables_root: str) -> DataFrame:
    """(object, reason) of the events that loaded nothing."""
    fs, p = _fs(spark, f"{tables_root.rstrip('/')}/_skipped")
    schema = "object string, reason string"
    if not fs.exists(p):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", True).json(p.toString())
