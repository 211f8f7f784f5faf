"""Breadth-first walk over pagination links, each page once per root.

The frontier is a DataFrame; every round joins it to the link edges,
drops pages the root has already seen (left-anti join) and keeps, per
(root, page), the least (visit number of the parent, URL). Ranking a level by
that, behind the visits of earlier levels, is exactly breadth-first order
with children taken in sorted-URL order. A row holds its visit number and no
path, so its size does not depend on the depth. The walk ends when a round
finds nothing new, and only then. Each level is written once to the shared
checkpoint folder, which cuts the lineage; the seen set is the union of
the levels, rewritten as one table every few rounds.

Where pages do not branch there is nothing to order: the walk is a chain of
``next`` links, and its visits are found by pointer doubling in rounds that grow with
the logarithm of its length (``chain_walk``). Only roots that reach a page with several
successors are walked level by level.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.operators.merge import group_rank
from pricelake.session import save_and_reload

#: Rounds after which the seen levels are rewritten as one table.
COMPACT_EVERY = 16


def pagination_walk(roots: DataFrame, edges: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Walk from every root.

    ``roots``: (root_id, page_id, url). ``edges``: (src_id, dst_id, dst_url),
    or a function from the frontier (root_id, page_id, url) to its next
    candidates (root_id, src_id, page_id, url) when links depend on the root.
    Returns (root_id, page_id, url, depth, page_seq) where ``page_seq`` is
    the 0-based visit order within the root. ``max_pages`` keeps the first
    N visits per root (a page that fails still counts).
    """
    if callable(edges):
        return level_walk(roots, edges, max_pages)
    if max_pages is not None and max_pages <= 0:
        return level_walk(roots.limit(0), edges, max_pages)
    links = save_and_reload(edges.where("src_id <> dst_id").groupBy("src_id", "dst_id").agg(F.min("dst_url").alias("dst_url")),
                            "walk-links")
    chains, branching = chain_walk(roots, links, max_pages)
    if branching.isEmpty():
        return chains
    return chains.unionByName(level_walk(branching, links, max_pages))


def chain_walk(roots: DataFrame, links: DataFrame, max_pages: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(visits of the roots whose walk meets no page with two successors, the other roots).

    ``links``: distinct (src_id, dst_id, dst_url) without loops. Round k knows the
    page 2^k steps behind each page, and the first 2^k visits of each root; visits
    and steps joined give the first 2^(k+1). A chain that closes to a ring comes
    back to pages with a smaller depth, which stays. The rounds end when no root
    has a visit that can go on."""
    out = links.groupBy("src_id").agg(F.count(F.lit(1)).alias("n"), F.min("dst_id").alias("to"), F.min("dst_url").alias("_url"))
    jump = save_and_reload(out, "walk-jump")
    branches = jump.where("n > 1").select(F.col("src_id").alias("page_id"))
    jump = jump.where("n = 1").select("src_id", "to", "_url")  # a page that branches ends a chain
    visits = roots.select("root_id", "page_id", "url", F.lit(0).cast("long").alias("depth"))
    known, step = -1, 1
    while max_pages is None or step < 2 * max_pages:
        ahead = (visits.join(jump, F.col("page_id") == F.col("src_id"))
                 .select("root_id", F.col("to").alias("page_id"), F.col("_url").alias("url"), (F.col("depth") + step).alias("depth")))
        visits = save_and_reload(visits.unionByName(ahead).groupBy("root_id", "page_id")
                                 .agg(F.min(F.struct("depth", "url")).alias("m")).select("root_id", "page_id", "m.url", "m.depth"),
                                 "walk-visits")
        n = visits.count()
        if n == known:
            break
        known, step = n, 2 * step
        jump = save_and_reload(jump.alias("a").join(jump.alias("b"), F.col("a.to") == F.col("b.src_id"))
                               .select("a.src_id", "b.to", "b._url"), "walk-jump")
    if max_pages is not None:
        visits = visits.where(F.col("depth") < max_pages)
    lost = save_and_reload(visits.join(branches, "page_id", "left_semi").select("root_id").distinct(), "walk-lost")
    done = visits.join(lost, "root_id", "left_anti").select(
        "root_id", "page_id", "url", F.col("depth").cast("int").alias("depth"), F.col("depth").alias("page_seq"))
    return done, roots.join(lost, "root_id", "left_semi")


def level_walk(roots: DataFrame, edges, max_pages: int | None = None) -> DataFrame:
    """The walk level by level, for any links."""
    level = roots.select("root_id", "page_id", "url", F.lit(0).alias("depth"), F.lit(0).cast("long").alias("page_seq"))
    if max_pages is not None:
        level = level.where(F.lit(max_pages) > 0)
    level = save_and_reload(level, "walk-level")
    seen, levels, depth = level, 1, 0
    visits = level.groupBy("root_id").agg(F.count(F.lit(1)).alias("_visits"))
    while not level.isEmpty():
        depth += 1
        if callable(edges):
            cand = edges(level.select("root_id", "page_id", "url")).withColumnRenamed("src_id", "_src")
            parent = level.select("root_id", F.col("page_id").alias("_src"), F.col("page_seq").alias("_parent"))
            nxt = parent.join(cand, ["root_id", "_src"])
        else:
            e = edges.select(F.col("src_id").alias("_src"), F.col("dst_id").alias("_dst"), F.col("dst_url").alias("_url"))
            nxt = (level.join(e, F.col("page_id") == F.col("_src"))
                   .select("root_id", F.col("page_seq").alias("_parent"), F.col("_dst").alias("page_id"),
                           F.col("_url").alias("url")))
        nxt = nxt.join(seen.select("root_id", "page_id"), ["root_id", "page_id"], "left_anti")
        nxt = (nxt.groupBy("root_id", "page_id").agg(F.min(F.struct("_parent", "url")).alias("m"))
               .select("root_id", "page_id", "m._parent", "m.url"))
        ranked = group_rank(nxt, "root_id", ["_parent", "url", "page_id"], "_rank").join(visits, "root_id")
        ranked = ranked.select("root_id", "page_id", "url", F.lit(depth).alias("depth"),
                               (F.col("_visits") + F.col("_rank")).alias("page_seq"))
        if max_pages is not None:
            ranked = ranked.where(F.col("page_seq") < max_pages)
        level = save_and_reload(ranked, "walk-level")
        seen, levels = seen.unionByName(level), levels + 1
        if levels % COMPACT_EVERY == 0:
            seen = save_and_reload(seen, "walk-seen")
        visits = seen.groupBy("root_id").agg(F.count(F.lit(1)).alias("_visits"))
    return seen
