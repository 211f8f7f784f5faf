"""Embedding near-dedup by p-stable hashing (operator 9).

Vectors are scaled to length 1 and hashed in ``TABLES`` tables; a table's key
joins ``PROJECTIONS`` Gaussian projections, each shifted and quantised to
cells of ``WIDTH``. At cosine 0.95 a pair shares at least one of the default
tables' keys with probability 0.95, at 0.98 with 0.999. Members of
a bucket are compared exactly, in double precision, block against block of
bounded size, so a bucket of any size is spread over tasks. A pair
counts in the first table where it meets, so links are counted once; a block
emits counts and a spanning forest, never its pairs. Equal vectors are one
member with a count.

Null and zero vectors and those with a null or non-finite component link
with nothing; so do vectors of different lengths. Rows without a vec_id have
no component. Repeated rows count as vectors of their own. Further input
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, functions as F

from pricelake.llm.components import components
from pricelake.llm.scratch import stage

THRESHOLD = 0.95
TABLES, PROJECTIONS, WIDTH = 24, 16, 2.0
SEED = 20
#: Members of a block of a bucket that are compared at once.
BLOCK = 1024


def unit_rows(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lengths, flat values scaled to unit length, valid) of a list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lists = column.cast(pa.list_(pa.float64()))
    off = lists.offsets.to_numpy().astype(np.int64)
    n = np.where(lists.is_valid().to_numpy(zero_copy_only=False), np.diff(off), 0)
    values = lists.values.fill_null(np.nan).to_numpy(zero_copy_only=False)[off[0]:off[-1]].copy()
    full = np.diff(off)
    row = np.repeat(np.arange(len(full)), full)
    bad = np.bincount(row[~np.isfinite(values)], minlength=len(full)) > 0
    values[~np.isfinite(values)] = 0
    top = np.zeros(len(full))
    np.maximum.at(top, row, np.abs(values))
    values /= np.where(top > 0, top, 1)[row]
    norm = np.sqrt(np.bincount(row, weights=values * values, minlength=len(full)))
    values /= np.where(norm > 0, norm, 1)[row]
    return np.where((n > 0) & ~bad & (norm > 0), n, 0), values, full


def _hasher(dim: int, tables: int, projections: int, width: float, seed: int):
    rng = np.random.default_rng([seed, dim])
    a = rng.standard_normal((dim, tables * projections))
    b = rng.uniform(0, width, tables * projections)
    odd = rng.integers(1, 1 << 62, (tables, projections), dtype=np.int64) * 2 + 1

    def keys(x: np.ndarray) -> np.ndarray:
        cell = np.floor((x @ a + b) / width).astype(np.int64).reshape(len(x), tables, projections)
        with np.errstate(over="ignore"):
            return (cell * odd).sum(axis=2) + dim
    return keys


def hashed(vectors: DataFrame, tables: int, projections: int, width: float, seed: int) -> DataFrame:
    """(vec_id, v, codes): unit vectors as bytes with their bucket keys; both null if invalid."""

    def run(batches):
        made = {}
        for batch in batches:
            n, values, full = unit_rows(batch.column("embedding"))
            at = np.concatenate(([0], np.cumsum(full)))
            v, codes = [None] * len(n), [None] * len(n)
            for d in np.unique(n[n > 0]).tolist():
                rows = np.flatnonzero(n == d)
                x = values[at[rows][:, None] + np.arange(d)]
                if d not in made:
                    made[d] = _hasher(d, tables, projections, width, seed)
                for i, vec, code in zip(rows.tolist(), x, made[d](x)):
                    v[i], codes[i] = vec.tobytes(), code
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(v, pa.binary()),
                                              pa.array(codes, pa.list_(pa.int64()))], names=["vec_id", "v", "codes"])

    return vectors.mapInArrow(run, "vec_id long, v binary, codes array<long>")


def compare(table: pa.Table, threshold: float) -> pa.Table:
    """Links inside a block pair: (a, b) of a spanning forest, and for every
    member the number of vectors it links to here for the first time."""
    t = table.column("t")[0].as_py()
    ids, mult, side = (table.column(c).to_numpy() for c in ("rep", "mult", "side"))
    vs = table.column("v").to_pylist()
    codes = np.stack([np.asarray(c.values) for c in table.column("codes").combine_chunks()])
    degree, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
    a_all, b_all = [], []
    for d in {len(v) for v in vs}:
        rows = np.flatnonzero(np.array([len(v) == d for v in vs]))
        x = np.stack([np.frombuffer(vs[i], np.float64) for i in rows])
        left = rows if side[0] == 2 else rows[side[rows] == 0]
        right = rows if side[0] == 2 else rows[side[rows] == 1]
        if not len(left) or not len(right):
            continue
        place = np.empty(len(ids), np.int64)
        place[rows] = np.arange(len(rows))
        i, j = np.nonzero(x[place[left]] @ x[place[right]].T >= threshold)
        i, j = left[i], right[j]
        if side[0] == 2:
            i, j = i[i < j], j[i < j]
        keep = ids[i] != ids[j]
        if t:
            for lo in range(0, len(i), 1 << 16):
                s = slice(lo, lo + (1 << 16))
                keep[s] &= ~(codes[i[s], :t] == codes[j[s], :t]).any(axis=1)
        i, j = i[keep], j[keep]
        np.add.at(degree, i, mult[j])
        np.add.at(degree, j, mult[i])
        a_all.append(i)
        b_all.append(j)
    i, j = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a_all, b_all))
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            break
    hit = np.flatnonzero((degree > 0) | (label != np.arange(len(ids))))
    return pa.table({"a": pa.array(ids[hit]), "b": pa.array(ids[label[hit]]), "links": pa.array(degree[hit])})


def near_groups(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
                tables: int = TABLES, projections: int = PROJECTIONS, width: float = WIDTH, seed: int = SEED,
                block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector."""
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"))
    every = stage(hashed(src, tables, projections, width, seed), "vectors")
    live = every.filter("v IS NOT NULL AND vec_id IS NOT NULL")
    # equal vectors have equal codes, so any of them will do
    reps = stage(live.groupBy("v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("mult"),
                                       F.first("codes").alias("codes")), "reps")
    keys = reps.select("rep", "v", F.posexplode("codes").alias("t", "code"))
    sizes = keys.groupBy("t", "code").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    sizes = sizes.select("t", "code", F.ceil(F.col("members") / block).cast("int").alias("blocks"))
    member = (keys.join(sizes, ["t", "code"])
              .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")))
    placed = member.select("t", "code", "rep", "v", "own",
                           F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    placed = placed.select("t", "code", "rep", "v", F.least("own", "other").alias("x"),
                           F.greatest("own", "other").alias("y"),
                           F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0)
                           .otherwise(1).alias("side"))
    # in a pair of different blocks both sides stand; a block's pair with itself holds it once
    found = stage(placed.join(reps.select("v", "mult", "codes"), "v").groupBy("t", "code", "x", "y")
                  .applyInArrow(lambda tb: compare(tb, threshold), "a long, b long, links long"), "links")
    joined = components(found.select("a", "b").filter("a <> b"))
    degree = found.groupBy("a").agg(F.sum("links").alias("links"))
    classes = (reps.select("v", "rep", "mult").join(degree, F.col("rep") == F.col("a"), "left")
               .join(joined, F.col("rep") == F.col("node"), "left")
               .select("v", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"),
                       F.coalesce("component", "rep").alias("component_id")))
    out = every.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("v")).alias("v")).join(classes, "v", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                     F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
