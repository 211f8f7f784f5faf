"""Landing daily product files: object events, day replace, type profile.

S8/S9: a landed file replaces one day of a date-partitioned table. The
logical result is ``table minus rows of that day, plus every row of the
file`` (rows of other dates are appended, null dates survive the delete,
columns align by position). ``replace_day`` writes that to a
``date``-partitioned Parquet table.

S10/S11/J5: object-arrival events are classified in one projection.

S6/A7: the per-column type a pandas CSV read would infer, as one aggregate.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.functions import constants as K
from pricelake.functions.text import _col

PRODUCT_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("product", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("price_per_unit", T.StringType()),
    T.StructField("offer", T.BooleanType()),
    T.StructField("category", T.StringType()),
    T.StructField("subcategory", T.StringType()),
    T.StructField("product_url", T.StringType()),
])

EVENT_SCHEMA = T.StructType([
    T.StructField("bucket", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("generation", T.StringType()),
    T.StructField("data", T.StructType([
        T.StructField("bucket", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("generation", T.StringType()),
    ])),
])


# ---- S9 ----------------------------------------------------------------------

def align_by_position(staged: DataFrame, table_schema: T.StructType) -> DataFrame:
    """``INSERT … SELECT *``: columns taken by position, cast to the table."""
    cols = staged.columns
    if len(cols) != len(table_schema.fields):
        raise ValueError(f"staged file has {len(cols)} columns, table has {len(table_schema.fields)}")
    return staged.select(*[F.col(f"`{c}`").cast(f.dataType).alias(f.name)
                           for c, f in zip(cols, table_schema.fields)])


def day_replace(table: DataFrame, staged: DataFrame, day, date_col: str = "date") -> DataFrame:
    """S9 as a plan: delete the path day (null dates survive), insert the
    whole staged file by position."""
    d = F.lit(day).cast("date") if not isinstance(day, Column) else day
    kept = table.where(~F.coalesce(F.col(date_col) == d, F.lit(False)))
    return kept.unionByName(align_by_position(staged, T.StructType(table.schema.fields)))


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def replace_day(spark: SparkSession, table_path: str, staged: DataFrame, day: str | dt.date,
                date_col: str = "date", schema: T.StructType = PRODUCT_SCHEMA) -> None:
    """Physical S9 on a ``date``-partitioned Parquet table.

    Rows of ``day`` overwrite partition ``date=day`` (dynamic partition
    overwrite touches only the partitions present in the data); when the
    file holds none, that partition is deleted, so the day becomes empty.
    Rows of other dates are appended. Plain Parquet has no multi-statement
    transaction: a table format would do both steps atomically.
    """
    day = str(day)
    rows = align_by_position(staged, schema)
    d = F.lit(day).cast("date")
    same = rows.where(F.col(date_col) == d)
    other = rows.where(~F.coalesce(F.col(date_col) == d, F.lit(False)))
    if same.isEmpty():
        fs, p = _fs(spark, f"{table_path.rstrip('/')}/{date_col}={day}")
        if fs.exists(p):
            fs.delete(p, True)
    else:
        (same.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(date_col).parquet(table_path))
    if not other.isEmpty():
        other.write.mode("append").partitionBy(date_col).parquet(table_path)


# ---- S10 / S11 / J5 -----------------------------------------------------------

def classify_events(events: DataFrame, raw_bucket: str | None = None, json_col: str | None = None) -> DataFrame:
    """Outcome of each object-arrival event, checks in the loader's order:
    missing bucket/name (400), bucket mismatch, not a day-file path, unknown
    source (all 200, ignored), invalid day (error), else loaded."""
    ev = events
    if json_col:
        ev = ev.withColumn("_ev", F.from_json(F.col(json_col), EVENT_SCHEMA)).select("*", "_ev.*").drop("_ev")

    def top_or_data(name):
        top = F.col(name)
        nested = F.col("data").getField(name)
        return F.coalesce(F.when(top != "", top), F.when(nested != "", nested))

    bucket = top_or_data("bucket")
    name = top_or_data("name")
    source = F.lower(F.regexp_extract(F.coalesce(name, F.lit("")), K.OBJECT_PATH_PATTERN, 1))
    day_txt = F.regexp_extract(F.coalesce(name, F.lit("")), K.OBJECT_PATH_PATTERN, 2)
    day = F.try_to_date(day_txt, "yyyy-MM-dd")
    tables = F.create_map(*[x for kv in K.SOURCE_TABLES.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    table = F.try_element_at(tables, source)
    matches = F.coalesce(name, F.lit("")).rlike(K.OBJECT_PATH_PATTERN)
    mismatch = F.lit(False) if not raw_bucket else (bucket != F.lit(raw_bucket))
    outcome = (F.when(bucket.isNull() | name.isNull(), "missing")
               .when(mismatch, "bucket_mismatch")
               .when(~matches, "not_day_file")
               .when(table.isNull(), "unknown_source")
               .when(day.isNull(), "invalid_day")
               .otherwise("loaded"))
    status = (F.when(outcome == "missing", 400).when(outcome == "invalid_day", 500).otherwise(200))
    ok = outcome == "loaded"
    return ev.select("*", bucket.alias("obj_bucket"), name.alias("obj_name"), outcome.alias("outcome"),
                     status.alias("status"),
                     F.when(matches, source).alias("source"), F.when(ok, day).alias("day"),
                     F.when(ok, table).alias("table_name"))


# ---- S6 / A7 ------------------------------------------------------------------

def write_csv(rows: DataFrame, path: str) -> None:
    """S6 write: header, minimal quoting, quotes escaped by doubling (the
    CSV module's dialect; Spark's default escape is a backslash)."""
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """S6 read: every column as text (types are inferred by ``type_profile``,
    not by ``inferSchema``, whose rules differ), from all blocks of a file at once."""
    from pricelake.sources.csv_blocks import read_csv_text as read
    return read(spark, path)


_DTYPES = {"float64": "double", "int64": "bigint", "bool": "boolean"}


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """The CSV read back as the landing job does: every column has the
    type its values infer to, and blanks and NA words are null."""
    text = read_csv_text(spark, path)
    dtypes = {r["column"]: r["dtype"] for r in type_profile(text, text.columns).collect()}  # a row per column
    na = list(K.PANDAS_NA_VALUES)
    return text.select(*[F.when(~F.coalesce(F.col(c), F.lit("")).isin(na), F.col(c))
                         .cast(_DTYPES.get(dtypes[c], "string")).alias(c) for c in text.columns])



_INT = r"^[+-]?[0-9]+$"
_FLOAT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(inf|Inf|INF|infinity|Infinity)$"
_BOOL = ["True", "TRUE", "true", "False", "FALSE", "false"]


def csv_text(c) -> Column:
    """A value as the CSV writer puts it (bool as true/false, null as '')."""
    x = _col(c)
    return F.coalesce(x.cast("string"), F.lit(""))


def type_profile(df: DataFrame, cols, group_cols=()) -> DataFrame:
    """Per group and column, the dtype pandas infers when reading the
    column back from CSV: all missing -> float64; bool words only -> bool
    (object if any missing); integers -> int64 (float64 if any missing);
    numbers -> float64; else object. Missing = empty or a default NA word."""
    na = F.array(*[F.lit(w) for w in K.PANDAS_NA_VALUES])
    aggs = []
    for c in cols:
        v = csv_text(c)
        miss = F.array_contains(na, v)
        aggs += [
            F.count_if(miss).alias(f"{c}__miss"),
            F.count_if(~miss).alias(f"{c}__n"),
            F.count_if(~miss & v.isin(*_BOOL)).alias(f"{c}__bool"),
            F.count_if(~miss & v.rlike(_INT)).alias(f"{c}__int"),
            F.count_if(~miss & v.rlike(_FLOAT)).alias(f"{c}__float"),
        ]
    prof = df.groupBy(*group_cols).agg(*aggs)

    def dtype(c):
        n, miss = F.col(f"{c}__n"), F.col(f"{c}__miss")
        return (F.when(n == 0, "float64")
                .when(F.col(f"{c}__bool") == n, F.when(miss > 0, "object").otherwise("bool"))
                .when(F.col(f"{c}__int") == n, F.when(miss > 0, "float64").otherwise("int64"))
                .when(F.col(f"{c}__float") == n, "float64")
                .otherwise("object"))

    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), dtype(c).alias("dtype"),
                                           F.col(f"{c}__miss").alias("n_missing")) for c in cols]))
    return prof.select(*group_cols, stacked.alias("_p")).select(*group_cols, "_p.*")
