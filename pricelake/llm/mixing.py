"""Mixing sources to target weights (operator 6), native Spark only.

Sources share the size of the whole corpus by weight; a source gives at most
``epochs`` times its size, and what it cannot give is shared again among the
others. Within a source documents stand in the order of a hash-random key.
Buckets of the key's leading digits are ranges of that order: the sizes of a
source's buckets give each bucket's offset by a prefix sum, a window inside
the bucket gives each document's, and the source is cut at its exact budget;
whole epochs come before the cut. A source of any size is spread over its
buckets, so no task holds a source.

Null texts have size 0; null sources are one source, the last; a null doc_id
is keyed as the empty string, and rows that share a doc_id are ordered by
a digest of the row. Sources without words have target 0. Further columns are
ignored (``mixed_documents`` keeps them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from pricelake.llm.scratch import stage

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (5, 2, 1)
EPOCHS = 3
SEED = "mix"
#: Documents of a bucket, on average; a source has as many buckets as it needs.
BUCKET_ROWS = 5_000


def source_targets(sizes: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, source_size): targets
    proportional to weights, none above ``epochs`` times its source's size."""
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))  # one row a source
    at = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (at + 1).cast("int"))
    table = stage(sizes.select("source", "source_size", weight.alias("weight")), "weights")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    full = F.col("source_size") * F.lit(float(epochs))
    rate, capped = None, -1
    while True:
        # a source whose share passes its limit is fixed there; the rest share what remains
        over = F.lit(False) if rate is None else full < F.col("weight") * F.lit(rate)
        fixed, n, free = table.agg(F.coalesce(F.sum(F.when(over, full)), F.lit(0.0)), F.count(F.when(over, 1)),
                                   F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0))).first()
        if n == capped or not free:
            break
        capped, rate = n, (total - fixed) / free
    share = F.col("weight") * F.lit(rate or 0.0)
    return table.select("source", "source_size", F.when(full < share, full).otherwise(share).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, epochs: int = EPOCHS, seed: str = SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, source, size, source_size, target, key, row, taken) of every
    document; ``taken`` counts the words the mix takes of it, repeats included."""
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    key = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"),
                       key.alias("key"), row_digest(id_col, text_col, source_col).alias("row"))
    base = stage(base, "mix")  # slim rows: the texts are read once
    sources = stage(base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")),
                    "sources")
    number = F.conv(F.substring("key", 1, 12), 16, 10).cast("long")  # uniform below 2**48
    dealt = sources.select(F.col("source").alias("d_source"), F.ceil(F.col("rows") / bucket_rows).alias("buckets"))
    base = (base.join(dealt, F.col("source").eqNullSafe(F.col("d_source")))
            .withColumn("bucket", F.floor(number / F.lit(float(1 << 48)) * F.col("buckets")).cast("long"))
            .drop("d_source", "buckets"))
    parts = base.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    targets = source_targets(sources.drop("rows"), weights, epochs)
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("source", "bucket", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("offset"))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    plan = offsets.join(targets, same(offsets, targets)).select(
        offsets["source"].alias("p_source"), F.col("bucket").alias("p_bucket"), "offset", "source_size", "target")
    inside = (Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "row")
              .rowsBetween(Window.unboundedPreceding, -1))
    ranked = base.withColumn("local", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    full = F.least(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(epochs)).cast("long")
    rest = F.floor(F.col("target")).cast("long") - full * F.col("source_size")
    start = F.col("offset") + F.col("local")
    taken = full * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - start))
    return (ranked.join(plan, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("bucket") == F.col("p_bucket")))
            .select("doc_id", "source", "size", "source_size", "target", "key", "row",
                    F.when(F.col("source_size") > 0, taken).otherwise(0).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source") -> DataFrame:
    """The mix itself, with the columns of ``docs`` and ``epoch``: each
    document once per epoch it is taken in, cut to its first words where the
    budget ends inside it. Rows that are alike share their digest; each of
    them gets one of their shares."""
    shares = mixed.filter("taken > 0").groupBy(F.col("row").alias("_mix_row")).agg(
        F.first("size").alias("_mix_size"), F.sort_array(F.collect_list("taken"), False).alias("_mix_taken"))
    keep = [c for c in docs.columns if c != "epoch"]
    joined = docs.select(*keep, row_digest(id_col, text_col, source_col).alias("_mix_row")).join(shares, "_mix_row")
    nth = F.row_number().over(Window.partitionBy("_mix_row").orderBy(F.lit(0)))
    joined = joined.withColumn("_mix_taken", F.get("_mix_taken", nth - 1)).filter("_mix_taken IS NOT NULL")
    size, taken = F.col("_mix_size"), F.col("_mix_taken")
    joined = joined.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.ceil(taken / size).cast("int") - 1)))
    left = F.least(size, taken - F.col("epoch") * size)
    words = F.regexp_extract_all(F.col(text_col), F.lit(f"({WORD})"), F.lit(1))
    cut = F.array_join(F.slice(words, 1, left.cast("int")), " ")
    text = F.when(left < size, cut).otherwise(F.col(text_col))
    return joined.withColumn(text_col, text).select(*keep, "epoch")


def row_digest(id_col: str, text_col: str, source_col: str):
    """A digest of a row's id, text and source; nulls differ from every value."""
    def of(c):
        return F.coalesce(F.md5(F.col(c).cast("string")), F.lit("-"))
    return F.md5(F.concat_ws("/", of(id_col), of(text_col), of(source_col)))
