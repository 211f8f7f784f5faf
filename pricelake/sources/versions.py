"""S9 as one step: day folders that are published by one atomic pointer.

A day replace deletes a day's rows and appends a file's rows, of that day and
of others. Here both become visible together. Rows are written to folders of
their own, one per (table, date); then a *version*, the list of live folders,
is written, and last the version's number is taken by creating a file that must
not exist yet. Readers follow the highest number. What fails before leaves
folders that nobody reads; of two writers one gets the number, the other an error.

The version is one JSON document: a row per live (table, date) folder, and
per loaded object its generation, so it grows with the days kept, not with the rows.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.sources.landing import PRODUCT_SCHEMA, _fs, align_by_position

TABLE_SCHEMA = T.StructType([T.StructField("table_name", T.StringType()), *PRODUCT_SCHEMA.fields])
_NULL_DAY = "__HIVE_DEFAULT_PARTITION__"


class PublishConflict(RuntimeError):
    """Another writer published a version meanwhile."""


def _text(spark: SparkSession, path: str) -> str:
    return "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())


def _put(spark: SparkSession, path: str, text: str) -> None:
    """Create a file that must not exist."""
    fs, p = _fs(spark, path)
    out = fs.create(p, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def current(spark: SparkSession, root: str) -> dict:
    """The newest version: number, folders [table, day, path], loads {object: generation}, batches {query: id}."""
    fs, log = _fs(spark, f"{root.rstrip('/')}/_versions")
    names = sorted((st.getPath().getName() for st in fs.listStatus(log)), reverse=True) if fs.exists(log) else []
    for name in names:
        body = _text(spark, f"{log.toString()}/{name}") if name.isdigit() else ""
        if body.endswith("."):  # else its writer died while taking the number
            return {"number": int(name), **json.loads(_text(spark, f"{root.rstrip('/')}/_bodies/{body[:-1]}"))}
    return {"number": int(next((n for n in names if n.isdigit()), 0)), "folders": [], "loads": {}, "batches": {}}


def read_table(spark: SparkSession, root: str, table: str | None = None, days: list | None = None,
               version: dict | None = None) -> DataFrame:
    """(table_name, product columns) of the newest version; only the folders of the asked table and days are opened."""
    live = (version or current(spark, root))["folders"]
    wanted = None if days is None else {str(d) for d in days}
    paths = [f"{root.rstrip('/')}/{p}" for t, d, p in live if table in (None, t) and (wanted is None or d in wanted)]
    if not paths:
        return spark.createDataFrame([], TABLE_SCHEMA)
    return spark.read.schema(TABLE_SCHEMA).option("recursiveFileLookup", True).parquet(*paths)


def publish(spark: SparkSession, root: str, rows: DataFrame, replaced: list, loads: dict | None = None,
            batch: tuple | None = None) -> int:
    """One new version: the live folders without those of the ``replaced``
    [(table, day)], plus ``rows`` (table_name, product columns). Returns its number."""
    root, base = root.rstrip("/"), current(spark, root)
    data = f"data/{uuid.uuid4().hex[:12]}"
    names = [f.name for f in TABLE_SCHEMA.fields]
    # the partition columns stay in the files as well: folders are read one by one
    (rows.select(*[F.col(f.name).cast(f.dataType) for f in TABLE_SCHEMA.fields])
     .withColumn("_table", F.col("table_name")).withColumn("_day", F.col("date")).select(*names, "_table", "_day")
     .hint("rebalance", "_table", "_day")  # a day in few files, a large one in several tasks
     .write.partitionBy("_table", "_day").parquet(f"{root}/{data}"))
    gone = {(t, str(d)) for t, d in replaced}
    folders = [f for f in base["folders"] if (f[0], f[1]) not in gone]
    fs, top = _fs(spark, f"{root}/{data}")
    for t in fs.listStatus(top):
        if t.getPath().getName().startswith("_table="):
            for d in fs.listStatus(t.getPath()):
                table, day = (x.getPath().getName().split("=", 1)[1] for x in (t, d))
                folders.append([table, None if day == _NULL_DAY else day, f"{data}/_table={table}/_day={day}"])
    body = {"folders": folders, "loads": {**base["loads"], **(loads or {})}, "batches": {**base["batches"], **dict([batch] if batch else [])}}
    name = f"{uuid.uuid4().hex[:12]}.json"
    _put(spark, f"{root}/_bodies/{name}", json.dumps(body))
    _point(spark, root, base["number"] + 1, name)
    return base["number"] + 1


def _point(spark: SparkSession, root: str, number: int, name: str) -> None:
    try:
        _put(spark, f"{root}/_versions/{number:012d}", name + ".")
    except Exception as e:
        if "AlreadyExists" in str(e):
            raise PublishConflict(f"version {number} of {root} was taken") from e
        raise


def replace_day(spark: SparkSession, root: str, table: str, staged: DataFrame, day) -> int:
    """Delete the day (null dates survive), insert the whole staged file by position, seen together."""
    rows = align_by_position(staged, PRODUCT_SCHEMA).withColumn("table_name", F.lit(table))
    return publish(spark, root, rows, [(table, day)])


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete data folders that none of the newest ``keep`` versions reads; returns how many. Not for
    use while a writer is at work."""
    root, newest = root.rstrip("/"), current(spark, root)["number"]
    fs, p = _fs(spark, f"{root}/data")
    used = set()
    for n in range(max(1, newest - keep + 1), newest + 1):
        pointer = _text(spark, f"{root}/_versions/{n:012d}")
        if pointer.endswith("."):
            used |= {f[2].split("/")[1] for f in json.loads(_text(spark, f"{root}/_bodies/{pointer[:-1]}"))["folders"]}
    unused = [st.getPath() for st in fs.listStatus(p) if st.getPath().getName() not in used] if fs.exists(p) else []
    for x in unused:
        fs.delete(x, True)
    return len(unused)
