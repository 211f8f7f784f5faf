"""CSV files read block by block, with line ends inside quotes.

Quoted fields may hold line ends, so a block of a file does not tell by itself
where its records start. But quotes are doubled inside quoted fields, and so a
line begins inside one exactly if an odd number of quotes stands before it. Tasks
scan the lines of their blocks and count from the block's start; a prefix scan over one
row per block carries parity and record numbers from block to block; with these
each line knows whether it starts a record, and which. Only the lines of records of
several lines meet in a shuffle. One file is thus read by as many tasks as it
has blocks.

As with the writer of ``write_csv``, quotes stand only in quoted fields (a field that
holds one is quoted). An unclosed quote makes the rest of its file one record.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricelake.session import save_and_reload

_LINES = "value string, path string, block long, at long, before int, odd int, even_starts long, odd_starts long"


def _scan(batches):
    """Number the lines of each block and count quotes and starts from the block's
    start: ``before`` is the parity of the quotes before a line, ``even_starts`` and
    ``odd_starts`` the lines so far that start a record if the block starts outside or inside quotes."""
    key, at, parity, even, odd_ = None, 0, 0, 0, 0
    for batch in batches:
        value, path, block = (batch.column(i) for i in range(3))
        odd = pc.count_substring(value, '"').to_numpy(zero_copy_only=False).astype(np.int64) % 2
        paths, blocks = path.dictionary_encode(), block.to_numpy()
        change = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(paths.indices.to_numpy()) != 0)) + 1
        cuts = np.concatenate(([0], change, [len(odd)]))
        cols = [np.empty(len(odd), np.int64) for _ in range(4)]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if lo == hi:
                continue
            here = (path[lo].as_py(), int(blocks[lo]))
            if here != key:
                key, at, parity, even, odd_ = here, 0, 0, 0, 0
            q = odd[lo:hi]
            before = (np.cumsum(q) - q + parity) % 2
            for c, v in zip(cols, (at + np.arange(hi - lo), before, even + np.cumsum(before == 0), odd_ + np.cumsum(before == 1))):
                c[lo:hi] = v
            at, parity = at + hi - lo, int((before[-1] + q[-1]) % 2)
            even, odd_ = int(cols[2][hi - 1]), int(cols[3][hi - 1])
        yield pa.RecordBatch.from_arrays(
            [value, path, block, pa.array(cols[0]), pa.array(cols[1].astype(np.int32)), pa.array(odd.astype(np.int32)),
             pa.array(cols[2]), pa.array(cols[3])],
            names=["value", "path", "block", "at", "before", "odd", "even_starts", "odd_starts"])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.option("lineSep", "\n").text(path)
            .select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))
            .mapInArrow(_scan, _LINES))


def _ahead():
    return Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line, value): the lines of all files at ``path``, numbered from 0 in each, read by blocks."""
    lines = _lines(spark, path)
    blocks = (lines.groupBy("path", "block").agg(F.count(F.lit(1)).alias("n"))
              .select("path", "block", F.coalesce(F.sum("n").over(_ahead()), F.lit(0)).alias("earlier")))
    return (lines.join(save_and_reload(blocks, "line-blocks"), ["path", "block"])
            .select("path", (F.col("earlier") + F.col("at")).alias("line"), "value"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """(path, record, text): the records of all files at ``path``, numbered from 1 in each."""
    lines, ahead = _lines(spark, path), _ahead()
    blocks = (lines.groupBy("path", "block").agg((F.sum("odd") % 2).alias("odd"), F.max("even_starts").alias("even_starts"),
                                                 F.max("odd_starts").alias("odd_starts"))
              .withColumn("inside", F.coalesce(F.sum("odd").over(ahead), F.lit(0)) % 2)
              .withColumn("starts", F.when(F.col("inside") == 0, F.col("even_starts")).otherwise(F.col("odd_starts")))
              .select("path", "block", "inside", F.coalesce(F.sum("starts").over(ahead), F.lit(0)).alias("earlier")))
    blocks = save_and_reload(blocks, "csv-blocks")  # a row per block, scanned once
    placed = lines.join(blocks, ["path", "block"]).select(
        "path", "block", "at", "value",
        (F.col("earlier") + F.when(F.col("inside") == 0, F.col("even_starts")).otherwise(F.col("odd_starts"))).alias("record"),
        ((F.col("before") == F.col("inside")) & (F.col("odd") == 0)).alias("whole"))
    # a record of one line is whole; the lines of others are put together
    several = (placed.where(~F.col("whole")).groupBy("path", "record")
               .agg(F.array_sort(F.collect_list(F.struct("block", "at", "value"))).alias("l"))
               .select("path", "record", F.array_join(F.col("l.value"), "\n").alias("text")))
    return placed.where("whole").select("path", "record", F.col("value").alias("text")).unionByName(several) \
        .withColumn("text", F.regexp_replace("text", "\r$", ""))


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """Every column of the CSV files at ``path`` as text; each file has a header,
    and all the same. The parsed rows are written once, as columns."""
    # the reader looks at the head of a file only
    names = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path).columns
    if not names:
        raise ValueError(f"no header at {path}")
    schema = ", ".join("`" + n.replace("`", "``") + "` STRING" for n in names)
    parsed = F.from_csv("text", schema, {"escape": '"', "multiLine": "true"})
    rows = records(spark, path).where((F.col("record") > 1) & (F.col("text") != "")).select(parsed.alias("r"))
    return save_and_reload(rows.select("r.*"), "csv-rows")
