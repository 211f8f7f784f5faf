"""Category-target documents (S1 read + validate, S2 write).

On disk a target list is a folder of JSON lines, one target per line with
its ``target_index``, written in target order by range partitions, next to
an ``_envelope.json`` holding ``generated_at_utc``, ``source_group_urls``
and ``count``. Nothing is gathered into one task to write it. The
single-document form (``{"generated_at_utc", "source_group_urls",
"count", "targets": [...]}``) is read as well.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.sources.csv_blocks import numbered_lines

#: End of the line that opens the list of targets.
_OPENING = r'"targets": \[$'
TARGET_FIELDS = ["group", "category", "subcategory", "url"]
TARGET_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in TARGET_FIELDS])
TARGETS_DOC_SCHEMA = T.StructType([
    T.StructField("generated_at_utc", T.StringType()),
    T.StructField("source_group_urls", T.ArrayType(T.StringType())),
    T.StructField("count", T.LongType()),
    T.StructField("targets", T.ArrayType(TARGET_SCHEMA)),
])
LINE_SCHEMA = T.StructType([T.StructField("target_index", T.LongType())] + TARGET_SCHEMA.fields)


def validate_targets(targets: DataFrame, type_cols: bool = False) -> DataFrame:
    """Fail the job unless there is at least one target and every target
    has its four fields as JSON text (``""`` passes; null, a missing field
    or a number fails). The check is one aggregate; rows pass unchanged.
    With ``type_cols`` the frame carries ``<field>__t`` JSON type columns."""
    if type_cols:
        bad_row = F.greatest(*[F.col(f + "__t") != "STRING" for f in TARGET_FIELDS])
    else:
        bad_row = F.greatest(*[F.col(f).isNull() for f in TARGET_FIELDS])
    bad = F.count_if(bad_row)
    n = F.count(F.lit(1))
    check = targets.agg(F.when(n == 0, F.raise_error(F.lit("targets: at least one target required")))
                        .when(bad > 0, F.raise_error(F.concat(F.lit("targets: fields missing in "),
                                                              bad.cast("string"), F.lit(" targets"))))
                        .otherwise(n).alias("n"))
    check.collect()  # one row
    return targets.drop(*[f + "__t" for f in TARGET_FIELDS]) if type_cols else targets


def read_targets(spark: SparkSession, path: str, validate: bool = True) -> DataFrame:
    """Targets with their list position as ``target_index``. A ``.json``
    path is the single-document form (one JSON value); any other path is the
    JSON-lines folder. A document with a target per line, as ``write_targets_document``
    lays it out, is read by lines, in as many tasks as its file has blocks; only another
    layout is read whole."""
    if not path.endswith(".json"):
        t = spark.read.schema(LINE_SCHEMA).json(path.rstrip("/") + "/targets")
        return validate_targets(t) if validate else t
    # the head line alone ends with the opening of the list
    if spark.read.text(path).limit(1).where(F.col("value").rlike(_OPENING)).count():
        # line 0 is the head; what is not a target fails the validation like a bad target
        rows = (numbered_lines(spark, path).where((F.col("line") > 0) & (F.col("value") != "]}"))
                .select((F.col("line") - 1).alias("target_index"), F.try_parse_json(F.regexp_replace("value", r"^,|,$", "")).alias("t")))
        return _fields(rows, validate)
    doc = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
    items = doc.select(F.posexplode(F.coalesce(F.try_variant_get("v", "$.targets", "array<variant>"),
                                               F.array().cast("array<variant>"))).alias("target_index", "t"))
    return _fields(items, validate)


def _fields(items: DataFrame, validate: bool) -> DataFrame:
    """(target_index, fields) of targets as VARIANT values t."""
    cols = [F.col("target_index").cast("long").alias("target_index")]
    for f in TARGET_FIELDS:
        x = F.try_variant_get("t", f"$.{f}", "variant")
        cols += [F.try_variant_get(x, "$", "string").alias(f),
                 F.coalesce(F.schema_of_variant(x), F.lit("VOID")).alias(f + "__t")]
    t = items.select(*cols)
    return validate_targets(t, type_cols=True) if validate else t.drop(*[f + "__t" for f in TARGET_FIELDS])


def write_targets(targets: DataFrame, path: str, source_group_urls, generated_at: dt.datetime | None = None,
                  order=("group", "category", "subcategory", "url")) -> None:
    """Targets sorted (O1) as JSON lines plus the envelope."""
    ts = (generated_at or dt.datetime.now(dt.timezone.utc)).replace(microsecond=0)
    ordered = targets.select(*TARGET_FIELDS).orderBy(*order)
    # A global position without a single-partition window: rank within each
    # range partition plus the sizes of the partitions before it.
    indexed = _global_index(ordered)
    indexed.select("target_index", *TARGET_FIELDS).write.mode("overwrite").json(path.rstrip("/") + "/targets")
    count = indexed.count()
    spark = targets.sparkSession
    env = spark.createDataFrame([(ts.strftime("%Y-%m-%dT%H:%M:%SZ"), list(source_group_urls), count)],
                                "generated_at_utc string, source_group_urls array<string>, count long")
    env.coalesce(1).write.mode("overwrite").json(path.rstrip("/") + "/_envelope.json")


def _global_index(ordered: DataFrame) -> DataFrame:
    """0-based position of every row of a sorted DataFrame without a
    single-partition window: the row's number inside its range partition
    plus the sizes of all partitions before it (one small row per
    partition). The sorted rows are checkpointed so both passes see the
    same partitions."""
    from pyspark.sql import Window
    from pricelake.session import checkpoint_dir
    checkpoint_dir(ordered.sparkSession)
    df = (ordered.withColumn("_pid", F.spark_partition_id())
          .withColumn("_in", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))).checkpoint()
    sizes = df.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    return (df.join(F.broadcast(offsets), "_pid")
            .withColumn("target_index", F.col("_off") + F.col("_in")).drop("_pid", "_in", "_off"))


def write_targets_document(targets: DataFrame, path: str, source_group_urls, generated_at: dt.datetime,
                           order=("group", "category", "subcategory", "url")) -> None:
    """S2, single-document form: ``{"generated_at_utc", "source_group_urls",
    "count", "targets": [...]}`` as one JSON file below ``path``, one target
    per line. One file has one writer; the sorted rows stream through it, and
    none is held or sent to the driver."""
    ordered = _global_index(targets.select(*TARGET_FIELDS).orderBy(*order))
    spark = targets.sparkSession
    head = {"generated_at_utc": generated_at.replace(microsecond=0).strftime("%Y-%m-%dT%H:%M:%SZ"),
            "source_group_urls": list(source_group_urls), "count": targets.count()}
    first = json.dumps(head, ensure_ascii=False)[:-1] + ', "targets": ['
    row = F.to_json(F.struct(*TARGET_FIELDS), {"ignoreNullFields": "false"})
    lines = ordered.select("target_index", F.concat(F.when(F.col("target_index") > 0, ",").otherwise(""), row)
                           .alias("value"))
    ends = spark.createDataFrame([(-1, first), (head["count"], "]}")], "target_index long, value string")
    (lines.unionByName(ends).repartitionByRange("target_index").sortWithinPartitions("target_index").select("value")
     .coalesce(1).write.mode("overwrite").text(path))
