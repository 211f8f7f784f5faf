"""Landed day files replace their day, as a Structured Streaming job.

Files arrive under ``<root>/<source>/<YYYY-MM-DD>/<name>.parquet``. The
file source picks them up oldest first; every micro-batch is applied with
``foreachBatch``. What replaces a day is an *object*: a file, or all part files
that one Spark job wrote into one folder (their names carry the job's id).
The first batch that sees a part file loads its whole object, however the
parts are spread over batches; a folder still being written is waited for.
So the number of files in a batch counts objects: a batch takes as many landed files as
that number of objects has on average, and the number of batches grows with the
objects, not with the parts that they are written in.
Inside a batch the objects are ordered by (modification time, path) and
applied as one set-based step that equals replacing their days one after the
other:

* a table row of date ``x`` survives unless some object of the batch has
  path day ``x`` (null dates always survive);
* a row of object ``i`` with date ``x`` survives unless a *later* object of the
  batch has path day ``x``.

All bronze tables share one folder partitioned by ``(table_name, date)``.
The surviving rows of path days overwrite those partitions (dynamic
partition overwrite, one write for every table of the batch); path days
left without rows are deleted; surviving rows of other dates are appended.

The stream reads file *metadata* (the binary-file source without its content),
at any depth below the landing root, so a file without rows still replaces
its day. Only that metadata, one row per object, reaches the driver; the rows
are read from the batch's files and from the folders of its part files. Files that the
object-path rule or the table map does not know are appended to
``_ignored_files`` next to the tables, with the reason. Progress lives in the
stream checkpoint under the shared checkpoint folder; batch markers
carry the id of that checkpoint's query, so another stream's batches on the
same tables are never taken for replays.
"""

from __future__ import annotations

import hashlib
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.functions import constants as K
from pricelake.sources.landing import PRODUCT_SCHEMA, _fs

#: Name of a part file: folder, then the id of the job that wrote it.
_PART = r"^(.*)/part-[0-9]+-([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})[^/]*$"
_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
#: Seconds to wait for a folder that a job is still writing.
WRITER_PATIENCE = 600


def landed_stream(spark: SparkSession, landing_root: str, max_files_per_trigger: int = 8) -> DataFrame:
    """One row (path, modificationTime) per landed file, at any depth; a part file is its share of an object."""
    return (spark.readStream.format("binaryFile").schema(_FILE_SCHEMA).option("recursiveFileLookup", True)
            .option("maxFilesPerTrigger", max_files_per_trigger * files_per_object(spark, landing_root)).load(landing_root)
            .select("path", "modificationTime"))


def files_per_object(spark: SparkSession, landing_root: str) -> int:
    """Landed files per object, on average and rounded up (1 if nothing has landed)."""
    fs, p = _fs(spark, landing_root)
    if not fs.exists(p):
        return 1
    files = spark.read.format("binaryFile").schema(_FILE_SCHEMA).option("recursiveFileLookup", True).load(landing_root)
    return files.select(_object_key().alias("key")).groupBy("key").count() \
        .agg(F.ceil(F.avg("count")).cast("int")).first()[0] or 1


def _object_key():
    """The id of a landed file's object: folder and job of a part file, else the path."""
    part = F.regexp_extract("path", _PART, 2)
    return F.when(part != "", F.concat(F.regexp_extract("path", _PART, 1), F.lit("#"), part)).otherwise(F.col("path"))


def landed_files(found: DataFrame, landing_root: str) -> DataFrame:
    """(path, modificationTime, table_name, pday, reason, folder, job) of landed
    files; ``reason`` tells why a file is not a day file of a known table.
    ``folder`` and ``job`` are empty for what is no part file."""
    root = landing_root.rstrip("/").split("://", 1)[-1].removeprefix("file:").rstrip("/")
    tables = F.create_map(*[x for kv in K.SOURCE_TABLES.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    name = F.regexp_extract("path", "^.*?\\Q" + root + "\\E/(.*)$", 1)
    source = F.lower(F.regexp_extract(name, K.OBJECT_PATH_PATTERN, 1))
    day = F.try_to_date(F.regexp_extract(name, K.OBJECT_PATH_PATTERN, 2), "yyyy-MM-dd")
    table = F.try_element_at(tables, source)
    reason = (F.when(~name.rlike(K.OBJECT_PATH_PATTERN), "not_day_file").when(table.isNull(), "unknown_source")
              .when(day.isNull(), "invalid_day"))
    return found.select("path", "modificationTime", table.alias("table_name"), day.alias("pday"), reason.alias("reason"),
                        F.regexp_extract("path", _PART, 1).alias("folder"), F.regexp_extract("path", _PART, 2).alias("job"))


def landed_objects(files: DataFrame) -> list:
    """A row per object among the known files and per unknown file (rows of ``landed_files``), in the order of
    their first files by (modification time, path)."""
    known = F.col("reason").isNull()
    firsts = (files.withColumn("key", F.when(known, _object_key()).otherwise(F.col("path")))
              .withColumn("at", F.unix_micros("modificationTime"))
              .groupBy("key").agg(F.min(F.struct("at", "path", "table_name", "pday", "reason", "folder", "job")).alias("f")))
    return sorted(firsts.select("key", "f.*").collect(), key=lambda r: (r["at"], r["path"]))


def is_there(spark: SparkSession, folder: str, job: str) -> bool:
    """Whether the folder has part files of the job; waits for a writer. A folder that vanished
    has no object any more: a later one took its name."""
    fs, p = _fs(spark, folder)
    Path, until = spark._jvm.org.apache.hadoop.fs.Path, time.time() + WRITER_PATIENCE
    while fs.exists(Path(p, "_temporary")):
        if time.time() > until:
            raise TimeoutError(f"{folder} is still being written")
        time.sleep(1)
    return bool(len(fs.globStatus(Path(f"{_escaped(folder)}/*{job}*.parquet")) or []))


def surviving_rows(spark: SparkSession, rows: DataFrame, files: list) -> DataFrame:
    """(table_name, product columns): the rows of a batch's objects that no later
    object of the batch replaces. ``files`` = [(seq, path or object id, table, day)] in order,
    files of one object with one number; ``rows`` as of ``read_files`` or ``read_objects``."""
    uri = spark._jvm.org.apache.hadoop.fs.Path
    meta = spark.createDataFrame([(i, uri(p).toUri().toString(), t, d) for i, p, t, d in files],
                                 "_seq int, _path string, table_name string, _pday date")
    # a row per file or object of the batch
    tagged = rows.join(F.broadcast(meta), "_path")
    last_for_day = meta.groupBy(F.col("table_name").alias("_t"), F.col("_pday").alias("_d")) \
        .agg(F.max("_seq").alias("_last"))
    j = tagged.join(F.broadcast(last_for_day), (F.col("table_name") == F.col("_t")) & (F.col("date") == F.col("_d")),
                    "left")
    survivors = j.where(F.col("_last").isNull() | (F.col("_last") <= F.col("_seq")))
    return survivors.select("table_name", *[F.col(c).cast(f.dataType).alias(c)
                                            for c, f in zip(K.PRODUCT_COLUMNS, PRODUCT_SCHEMA.fields)])


def apply_files(spark: SparkSession, rows: DataFrame, files: list, tables_root: str) -> None:
    """Apply one batch: ``files`` = [(seq, path or object id, table, day)] in order,
    files of one object with one number.

    All bronze tables live under ``tables_root`` partitioned by
    ``(table_name, date)``, so a batch is one dynamic-overwrite write for
    the replaced days of every table plus one append."""
    # the files are opened once; a day's rows lie together, a large day's in several tasks
    survivors = surviving_rows(spark, rows, files).hint("rebalance", "table_name", "date").persist()
    try:
        _write_days(spark, survivors, sorted({(f[2], str(f[3])) for f in files}), tables_root)
    finally:  # a later batch may find other rows at the same paths
        survivors.unpersist()


def _write_days(spark: SparkSession, survivors: DataFrame, days: list, tables_root: str) -> None:
    """Replace the (table, day) partitions of ``days`` and append the rows of other dates."""
    replaced = F.lit(False)
    for t, d in days:
        replaced = replaced | ((F.col("table_name") == t) & (F.col("date") == F.lit(d).cast("date")))
    replaced = F.coalesce(replaced, F.lit(False))
    same = survivors.where(replaced)
    kept = {(r[0], str(r[1])) for r in same.select("table_name", "date").distinct().collect()}
    if kept:
        (same.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("table_name", "date").parquet(tables_root))
    for t, d in days:
        if (t, d) not in kept:
            fs, p = _fs(spark, f"{tables_root.rstrip('/')}/table_name={t}/date={d}")
            if fs.exists(p):
                fs.delete(p, True)
    survivors.where(~replaced).write.mode("append").partitionBy("table_name", "date").parquet(tables_root)


def read_table(spark: SparkSession, tables_root: str, table: str) -> DataFrame:
    """One bronze table (partition pruning on ``table_name``)."""
    return spark.read.parquet(tables_root).where(F.col("table_name") == table)


def read_files(spark: SparkSession, paths: list) -> DataFrame:
    """Rows of the given day files with the ``_path`` (percent-encoded) each came from."""
    return (spark.read.schema(PRODUCT_SCHEMA).option("recursiveFileLookup", True).parquet(*map(_escaped, paths))
            .select("*", F.col("_metadata.file_path").alias("_path")))


def read_objects(spark: SparkSession, objects: list) -> DataFrame:
    """Rows of the given objects with the (percent-encoded) id of the object each came from. Folders of
    part files are listed by Spark, as they are now."""
    files = [o["path"] for o in objects if not o["job"]]
    folders = sorted({o["folder"] for o in objects if o["job"]})
    found = [read_files(spark, files)] if files else []
    if folders:
        rows = (spark.read.schema(PRODUCT_SCHEMA).option("recursiveFileLookup", True).option("pathGlobFilter", "part-*.parquet")
                .parquet(*map(_escaped, folders)).withColumn("path", F.col("_metadata.file_path")))
        # "#" of the id, encoded like the rest
        found.append(rows.select(*K.PRODUCT_COLUMNS, F.regexp_replace(_object_key(), "#", "%23").alias("_path")))
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def _escaped(path: str) -> str:
    return "".join("\\" + c if c in "*?[]{}\\" else c for c in path)


def start_day_load(spark: SparkSession, landing_root: str, tables_root: str, checkpoint: str,
                   max_files_per_trigger: int = 8, available_now: bool = True):
    """Start T1; returns the ``StreamingQuery``. ``max_files_per_trigger`` counts a day's part files as one file."""
    stream = landed_stream(spark, landing_root, max_files_per_trigger)
    tables, ids = tables_root.rstrip("/"), {}

    def batch(df: DataFrame, batch_id: int) -> None:
        # foreachBatch is at-least-once: a batch re-run after a failure must
        # not append its other-date rows twice. A marker per applied batch of
        # this checkpoint's query (written after both writes) makes the replay a no-op.
        if not ids:
            ids["query"] = spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]
        query_id = ids["query"]
        fs, marker = _fs(spark, f"{tables}/_committed_batches/{query_id}/{batch_id}")
        if fs.exists(marker):
            return
        found = landed_objects(landed_files(df, landing_root))
        ignored = [(f["path"], f["reason"]) for f in found if f["reason"] is not None]
        if ignored:
            spark.createDataFrame(ignored, "path string, reason string").write.mode("append").json(f"{tables}/_ignored_files")
        known = [f for f in found if f["reason"] is None]
        # an object whose other part files came in an earlier batch is loaded already
        seen = {o["key"]: _fs(spark, f"{tables}/_committed_objects/{query_id}/{hashlib.sha256(o['key'].encode()).hexdigest()}")[1]
                for o in known if o["job"]}
        objects = [o for o in known if not o["job"] or not fs.exists(seen[o["key"]]) and is_there(spark, o["folder"], o["job"])]
        if objects:
            meta = [(i, o["key"], o["table_name"], o["pday"]) for i, o in enumerate(objects)]
            apply_files(spark, read_objects(spark, objects), meta, tables)
        for o in objects:
            if o["job"]:
                fs.create(seen[o["key"]], True).close()
        fs.create(marker, True).close()

    w = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def ignored_files(spark: SparkSession, tables_root: str) -> DataFrame:
    """(path, reason) of the files no table took."""
    fs, p = _fs(spark, f"{tables_root.rstrip('/')}/_ignored_files")
    schema = "path string, reason string"
    return spark.read.schema(schema).json(p.toString()) if fs.exists(p) else spark.createDataFrame([], schema)
