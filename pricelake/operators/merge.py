"""Deduplication, merging, limits and ordering of product and target rows.

The order-sensitive rules ("first wins", "last wins", "first N") all use
explicit order columns carried from the input: ``target_index`` (position
of the category target), ``page_seq`` (position of the page / snapshot in
the walk) and ``pos`` (position inside the page). Nothing here depends on
partitioning or on ``monotonically_increasing_id``.

Skew: first/last-wins keep one row per key with ``min``/``max`` over a
struct whose leading fields are the order columns. That is an aggregate, so
Spark combines rows map-side before the shuffle; a key that holds a third
of all rows collapses to one row per input partition instead of landing in
one task. Rows with a blank key are never shuffled at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.functions.text import strip, coalesce_blank
from pricelake.session import materialize

ORDER_COLS = ["target_index", "merge_rank", "page_seq", "pos"]


def _order(df: DataFrame, order) -> list[str]:
    return [c for c in (order or ORDER_COLS) if c in df.columns]


def _first_per_key(df: DataFrame, keys: list[str], order: list[str], last: bool = False,
                   first_order_name: str | None = None) -> DataFrame:
    """One row per key: the first (or last) by ``order``. Optionally also
    the key's first order position (``first_order_name`` struct)."""
    order = [c for c in order if c not in keys]
    payload = [c for c in df.columns if c not in keys and c not in order]
    row = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in payload]).alias("_r")
    aggs = [(F.max(row) if last else F.min(row)).alias("_r")]
    if first_order_name:
        aggs.append(F.min(F.struct(*[F.col(c) for c in order])).alias(first_order_name))
    out = df.groupBy(*keys).agg(*aggs)
    cols = [F.col(k) for k in keys] + [F.col("_r." + c).alias(c) for c in order + payload]
    if first_order_name:
        cols.append(F.col(first_order_name))
    return out.select(*cols)


def dedup_first_wins(rows: DataFrame, key: str = "product_url", order=None,
                     allow_duplicates: bool = False) -> DataFrame:
    """Across the run keep the first row per non-empty key; rows with a
    blank key are all kept. ``allow_duplicates`` keeps everything."""
    if allow_duplicates:
        return rows
    order = _order(rows, order)
    k = coalesce_blank(F.col(key))
    blank = rows.where(k == "")
    keyed = _first_per_key(rows.where(k != ""), [key], order)
    return blank.unionByName(keyed.select(*rows.columns))


def merge_last_wins(rows: DataFrame, group_cols=("target_index",), order=None,
                    url_col: str = "product_url", name_col: str = "product",
                    trim_used_names: bool = True) -> DataFrame:
    """A2 + J4: per group, rows keyed by URL (else by lower name) keep the
    *last* row of the key, placed at the key's *first* position. Rows with
    neither are dropped. Name-keyed rows survive only when no URL row of the
    group has the same lower name (compared on the surviving URL rows), and
    they come after all URL rows: ``merge_rank`` is 0 for URL rows, 1 for
    name rows, and sorts before the other order columns.

    ``trim_used_names=False`` is the snapshot-loop variant, which compares
    ``product.lower()`` without trimming.
    """
    order = [c for c in _order(rows, order) if c != "merge_rank"]
    group_cols = list(group_cols)
    url = strip(coalesce_blank(F.col(url_col)))
    name = F.lower(strip(coalesce_blank(F.col(name_col))))
    base_cols = [c for c in rows.columns if c != "merge_rank"]
    keyed = (rows.select(*base_cols)
             .withColumn("merge_rank", F.when(url != "", F.lit(0)).when(name != "", F.lit(1)))
             .withColumn("_k", F.when(url != "", url).otherwise(name))
             .where(F.col("merge_rank").isNotNull()))
    # One aggregate for URL and name keys: a single shuffle. It is read
    # three times below, so it is checkpointed once (the merged rows, much
    # fewer than the input) instead of being planned and computed thrice.
    last = _first_per_key(keyed, group_cols + ["merge_rank", "_k"], order, last=True, first_order_name="_first")
    last = materialize(last)
    used_name = coalesce_blank(F.col(name_col))
    used_name = F.lower(strip(used_name) if trim_used_names else used_name)
    used = last.where(F.col("merge_rank") == 0).select(*group_cols, used_name.alias("_k")).distinct()
    kept_names = last.where(F.col("merge_rank") == 1).join(used, group_cols + ["_k"], "left_anti")
    merged = last.where(F.col("merge_rank") == 0).unionByName(kept_names)
    # The merged row sits at the key's first position.
    first_cols = [c for c in order if c not in group_cols]
    out = [F.col("_first." + c).alias(c) if c in first_cols else F.col(c) for c in base_cols]
    return merged.select(*out, "merge_rank")


def cap_per_group(rows: DataFrame, n: int | None, group_cols=("target_index",), order=None) -> DataFrame:
    """At most ``n`` rows per group, in order. Catalyst plans this as a
    ``WindowGroupLimit`` that also trims map-side before the shuffle."""
    if n is None:
        return rows
    from pyspark.sql import Window
    order = [c for c in _order(rows, order) if c not in group_cols]
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def limit_total(rows: DataFrame, n: int | None, order=None) -> DataFrame:
    """O3: the first ``n`` rows of the run in target order, by selection: the rows
    per value of the first order column tell at which value the limit falls.
    Rows before it stay, rows behind it go, and only those at it are ranked
    (distributed), so the run as a whole is never sorted."""
    if n is None:
        return rows
    from pyspark.sql import Window
    if n <= 0:
        return rows.where(F.lit(False))
    order = _order(rows, order)
    rows = materialize(rows)
    # a row per value of the column
    key = F.struct(F.col(order[0]).isNotNull().alias("set"), F.col(order[0]).alias("value"))  # nulls first, as in a sort
    sizes = rows.groupBy(key.alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    upto = sizes.withColumn("_upto", F.sum("_n").over(Window.orderBy("_k")))
    edge = upto.where(F.col("_upto") >= n).orderBy("_k").select("_k.value", (F.col("_upto") - F.col("_n")).alias("before")).first()
    if edge is None:
        return rows.orderBy(*order)
    at = F.col(order[0]).eqNullSafe(F.lit(edge["value"]))
    before = F.lit(False) if edge["value"] is None else F.coalesce(F.col(order[0]) < F.lit(edge["value"]), F.lit(True))
    ranked = group_rank(rows.where(at).withColumn("_run", F.lit(0)), "_run", order, "_rank")
    last = ranked.where(F.col("_rank") < n - edge["before"]).select(*rows.columns)
    return rows.where(before).unionByName(last).orderBy(*order)


def first_n_values(df: DataFrame, col: str, n: int | None, order_col: str = "target_index") -> DataFrame:
    """A5: the first ``n`` distinct non-blank trimmed values by first
    appearance. The limit is tested after the append, so ``n <= 0`` keeps
    one. Result has at most ``max(n, 1)`` rows."""
    v = strip(coalesce_blank(F.col(col)))
    firsts = (df.select(v.alias("_v"), F.col(order_col).alias("_o")).where(F.col("_v") != "")
              .groupBy("_v").agg(F.min("_o").alias("_o")))
    return firsts.orderBy("_o", "_v").limit(max(n, 1)).select("_v")


def keep_first_n_values(df: DataFrame, col: str, n: int | None, order_col: str = "target_index") -> DataFrame:
    """A5 + J3: keep rows whose trimmed value is among the first ``n``.
    The allowed set has at most ``max(n, 1)`` rows; its measured size decides
    whether Spark broadcasts it."""
    if n is None:
        return df
    allowed = first_n_values(df, col, n, order_col)
    return (df.withColumn("_v", strip(coalesce_blank(F.col(col))))
            .join(allowed, "_v", "left_semi").drop("_v"))


def targets_distinct(targets: DataFrame, keys=("category", "subcategory", "url"),
                     order_col: str = "target_index") -> DataFrame:
    """A1: one target per ``(category, subcategory, url)``, the first wins
    (so the first ``group`` is kept)."""
    return _first_per_key(targets, list(keys), [order_col]).select(*targets.columns)


def targets_sort(targets: DataFrame) -> DataFrame:
    """O1: by ``(group, category, subcategory, url)`` in code-point order."""
    return targets.orderBy("group", "category", "subcategory", "url")


def links_sort(links: DataFrame, name: str = "name", url: str = "url") -> DataFrame:
    """O2: by ``(lower(name), url)``."""
    return links.orderBy(F.lower(F.col(name)), F.col(url))


def first_url_per_name(links: DataFrame, name: str = "name", url: str = "url", order_col: str = "pos",
                       group_cols=()) -> DataFrame:
    """The first URL for every name (stable first order)."""
    return _first_per_key(links.select(*group_cols, name, order_col, url), list(group_cols) + [name],
                          [order_col])


def stable_distinct(df: DataFrame, key_cols, order_col: str = "pos", group_cols=()) -> DataFrame:
    """Dedup keeping the first occurrence; ``order_col`` is the first
    position, so ordering by it restores the input order."""
    return _first_per_key(df, list(group_cols) + list(key_cols), [order_col]).select(*df.columns)


def fallback_when_childless(parents: DataFrame, children: DataFrame, key_cols,
                            child_col: str = "subcategory") -> DataFrame:
    """Children, plus every parent without children as itself with
    ``subcategory = ""``."""
    key_cols = list(key_cols)
    lonely = parents.join(children.select(*key_cols).distinct(), key_cols, "left_anti")
    lonely = lonely.withColumn(child_col, F.lit(""))
    return children.unionByName(lonely.select(*children.columns))


def jsonld_gate(rows: DataFrame, group_col: str = "target_index", seq_col: str = "page_seq",
                kind_col: str = "kind", url_col: str = "product_url") -> DataFrame:
    """In the snapshot loop the JSON-LD rows of snapshot k are used only
    while no row with a URL has been seen, and the test runs after snapshot
    k's cards. JSON-LD rows with a URL count as seen from the next snapshot
    on. So keep JSON-LD rows with ``k < k_card`` and ``k <= k_ld``: the first
    snapshots that hold a card URL and a JSON-LD URL (none = no bound)."""
    has_url = strip(coalesce_blank(F.col(url_col))) != ""
    first = (rows.where(has_url).groupBy(group_col)
             .agg(F.min(F.when(F.col(kind_col) == "card", F.col(seq_col))).alias("_k_card"),
                  F.min(F.when(F.col(kind_col) == "jsonld", F.col(seq_col))).alias("_k_ld")))
    keep = ((F.col(kind_col) != "jsonld")
            | (F.col("_k_card").isNull() | (F.col(seq_col) < F.col("_k_card")))
            & (F.col("_k_ld").isNull() | (F.col(seq_col) <= F.col("_k_ld"))))
    return rows.join(first, group_col, "left").where(keep).drop("_k_card", "_k_ld")


def count_rows(df: DataFrame, group_cols=(), name: str = "n_rows") -> DataFrame:
    """A4."""
    return df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias(name))


def group_rank(df: DataFrame, group_col: str, order_cols, name: str = "rank") -> DataFrame:
    """0-based rank of each row inside its group by ``order_cols``, without
    putting a whole group in one task: rows are range-sorted by
    ``(group, order...)`` (a hot group spans many partitions), numbered
    inside each (partition, group), and shifted by the sizes of the same
    group in earlier partitions (a small table: one row per partition and
    group present in it). Ties must not occur in ``order_cols``."""
    from pyspark.sql import Window
    order_cols = list(order_cols)
    srt = materialize(df.sort(group_col, *order_cols).withColumn("_pid", F.spark_partition_id()))
    local = Window.partitionBy("_pid", group_col).orderBy(*order_cols)
    numbered = srt.withColumn("_in", F.row_number().over(local) - 1)
    sizes = srt.groupBy(group_col, "_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group_col).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(group_col, "_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (numbered.join(offsets, [group_col, "_pid"])
            .withColumn(name, F.col("_off") + F.col("_in")).drop("_pid", "_in", "_off"))
