"""Stage tables in the shared checkpoint folder, and their removal."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pricelake.session import scratch_path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back:
    cuts the lineage, and a lost executor re-reads instead of recomputing.
    The table is deleted when the driver process ends, or by ``drop``."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stage_path = path
    return out


def drop(df: DataFrame) -> None:
    """Delete a stage table that nothing reads any more."""
    spark, path = df.sparkSession, getattr(df, "_stage_path", None)
    if path:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
