"""Corpus pipeline: documents in, a cleaned and mixed corpus out.

Each stage works on all that its predecessor kept, and its decisions take
effect. Between stages the corpus is written as Parquet to the shared folder
and read again. No stage can be stated in SQL as a whole (the first one learns
a model), so the result is tested against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pricelake.llm import decontaminate, langid, mixing, ngram_join, substring_dedup
from pricelake.llm.scratch import stage


def language(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language is not recognised (null texts and texts
    without letters among them)."""
    return langid.accepted(docs, langid.learn(docs))


def near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of linked documents (five-word shingles, Jaccard
    similarity of 0.8 or more) the one of the smallest doc_id, and of repeated
    rows one. Rows without a doc_id link by their texts like all others; one of
    them stays in a group that holds no doc_id."""
    key, mark = "_pipeline_key", "_pipeline_mark"
    # a digest of the row stands for the doc_id of a row that has none
    digest = F.xxhash64(F.lit("no id"), *[F.isnull(c) for c in docs.columns], *docs.columns)
    keyed = docs.withColumn(key, F.coalesce("doc_id", digest))
    groups = ngram_join.link_groups(keyed.select(key, "text"), id_col=key, shingle=5, percent=80).select("doc_id", "component_id")
    nameless = keyed.filter("doc_id IS NULL").select(F.col(key).alias("doc_id")).distinct().withColumn("nameless", F.lit(True))
    named = F.when(F.col("nameless").isNull(), F.col("doc_id"))
    kept = (groups.distinct().join(nameless, "doc_id", "left").groupBy(F.coalesce("component_id", "doc_id"))
            .agg(F.coalesce(F.min(named), F.min("doc_id")).alias(key)).select(key))
    one = keyed.join(kept, key, "left_semi").withColumn(mark, F.xxhash64("text"))
    return one.dropDuplicates([key, mark]).select(*docs.columns)


def repeated_passages(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes recurring passages from the texts; a document that consists
    of them altogether goes."""
    carry = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    out = substring_dedup.remove_repeats(docs, with_text=True, carry=carry)
    out = out.filter("n_removed = 0 OR n_removed < n_words").withColumnRenamed("kept", "text")
    text = {"n_chars": F.length("text").cast("long").alias("n_chars")}
    return out.select(*[text.get(c, F.col(c)) for c in docs.columns])


def benchmark_passages(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of the benchmark."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The final corpus: sources at their target weights, with the epoch of each copy."""
    mixed = mixing.mixed_documents(docs, mixing.mix(docs))
    text = {"n_chars": F.length("text").cast("long").alias("n_chars")}
    return mixed.select(*[text.get(c, F.col(c)) for c in docs.columns], "epoch")


STAGES = [("language ID", language), ("n-gram Jaccard join", near_duplicates), ("substring dedup", repeated_passages),
          ("benchmark decontamination", benchmark_passages), ("mixing sources", source_mix)]

ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs, name.replace(" ", "-"))
    return docs
