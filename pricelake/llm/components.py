"""Connected components by alternating stars, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pricelake.llm.scratch import drop, stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component): for every node of ``edges`` (a, b), the smallest
    node that it reaches. Rounds of large and small stars; each round is two
    minimum aggregates and joins, so a node with any number of neighbours is
    combined map-side and split by the skew join. Rounds are written to the
    shared folder, and the loop ends when a round changes nothing."""
    now = stage(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
                 .union(low.select("a", F.col("m").alias("b"))).distinct())
        new = stage(small, "edges")
        drop(now)
        now, was = new, mark
        mark = _mark(now)
        if mark == was:
            break
    out = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return out.union(roots)


def _mark(edges: DataFrame) -> tuple:
    """A fingerprint of the edge set: two aggregates, no rows to the driver."""
    h = F.xxhash64("a", "b")
    r = edges.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(h), F.lit(0)),
                  F.coalesce(F.sum(F.pmod(h, F.lit(1 << 30))), F.lit(0))).first()
    return tuple(r)
