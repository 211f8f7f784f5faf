"""Approximate nearest neighbours with vantage-point trees (operator 12).

Nearness is the inner product. An extra coordinate sqrt(M^2 - |x|^2), M the
greatest length of a vector, 0 for queries, turns it into a distance:
d(q, x)^2 = |q|^2 + M^2 - 2 q.x, so the triangle inequality holds.

1. *Classes.* Equal vectors are one member of the index, with their k + 1
   smallest ids; no query can need more of them. Equal queries are searched once.
2. *Shards.* A vantage-point tree fitted on a bounded sample (``SAMPLE`` rows, at
   most ``SAMPLE_BYTES``) deals all vectors into at most ``LEAVES`` leaves; a leaf
   is cut by a hash into shards of about ``SHARD_BYTES``. Each shard builds a
   vantage-point tree of its own, a written row of the index.
3. *Home.* A query searches one shard of the leaf that it falls into itself,
   which bounds the distance of its k-th neighbour.
4. *Search.* The query goes to all other shards of the leaves that may hold
   something nearer, and inside a shard to such buckets of the tree.

A region whose least possible distance by the triangle inequality is ``b``
is passed over if b > factor * (distance of the k-th best so far). With
factor 1 the search is exact; smaller factors look at less. How small a factor keeps
the recall depends on how the vectors lie, so by default it is fitted, by vector
length, on the sample of the top tree: the least of ``FACTORS`` with which ``TRIALS``
queries find ``RECALL`` of their neighbours in the sample, and for safety the
next larger one. Lengths that are not in the sample are searched exactly.

Scores are inner products of the original vectors in double precision,
summed in one fixed way, so equal vectors score the same; ties go to the
smaller vec_id.

Vectors that are null, zero or hold null or non-finite components take no part,
nor do rows without a vec_id; vectors of different lengths never meet.
Of valid rows that share a vec_id one counts, that of the smallest vector as
bytes. Further input columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, Window, functions as F

from pricelake.llm.scratch import drop, stage

NEIGHBOURS = 20
#: Factors to choose from, the recall that one must reach on the sample, and by how many queries.
FACTORS = (1.0, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1)
RECALL, TRIALS = 0.99, 64
#: Rows and bytes of the sample that the top tree is fitted on, and its leaves.
SAMPLE, SAMPLE_BYTES, LEAVES = 8192, 16 << 20, 1024
#: Bytes of a shard, vectors of a bucket of its tree, queries that search a shard at once.
SHARD_BYTES, BUCKET, QUERIES = 2 << 20, 64, 2048


def augment(x: np.ndarray, top: float) -> np.ndarray:
    """Members with the coordinate that makes all of length ``top``."""
    rest = np.sqrt(np.maximum(top * top - np.einsum("ij,ij->i", x, x), 0))
    return np.concatenate((x, rest[:, None]), axis=1)


def distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Euclidean distances of points (n x d) to (m x d), as n x m."""
    square = (points * points).sum(1)[:, None] + (to * to).sum(1)[None, :] - 2 * (points @ to.T)
    return np.sqrt(np.maximum(square, 0))


class Tree:
    """A vantage-point tree over points: node j has the children 2j + 1 (the
    nearer half of its members) and 2j + 2. Members of the leaves stand in ``order``
    between ``cuts``; ``low`` and ``high`` bound the distance of a child's members
    to its parent's vantage point."""

    def __init__(self, order, cuts, vantage, low, high):
        self.order, self.cuts, self.vantage, self.low, self.high = order, cuts, vantage, low, high
        self.inner = len(vantage)
        self.leaves = len(cuts) - 1
        self.depth = int(self.leaves).bit_length() - 1

    @classmethod
    def build(cls, points: np.ndarray, leaves: int) -> "Tree":
        """``leaves`` is a power of two; vantage points are members far from the others."""
        nodes = 2 * leaves - 1
        vantage = np.zeros((leaves - 1, points.shape[1]))
        low, high = np.full(nodes, np.inf), np.full(nodes, -np.inf)
        members, centre = [np.arange(len(points))], points.mean(axis=0) if len(points) else None
        for first in (2 ** level - 1 for level in range(leaves.bit_length() - 1)):
            halves = []
            for j, m in enumerate(members, first):
                if len(m):
                    vantage[j] = points[m[np.argmax(distances(points[m], centre[None])[:, 0])]]
                    d = distances(points[m], vantage[j][None])[:, 0]
                    by = np.argsort(d, kind="stable")
                    m, d = m[by], d[by]
                for child, s in ((2 * j + 1, slice(0, len(m) // 2)), (2 * j + 2, slice(len(m) // 2, None))):
                    halves.append(m[s])
                    if len(m[s]):
                        low[child], high[child] = d[s][0], d[s][-1]
            members = halves
        cuts = np.concatenate(([0], np.cumsum([len(m) for m in members]))).astype(np.int64)
        return cls(np.concatenate(members), cuts, vantage, low, high)

    def bounds(self, points: np.ndarray) -> np.ndarray:
        """Least possible distance of each point to the members of each leaf."""
        out = np.zeros((len(points), 1))
        for level in range(self.depth):
            first = 2 ** level - 1
            d = distances(points, self.vantage[first:2 * first + 1])
            child = np.repeat(d, 2, axis=1)
            gap = np.maximum(self.low[2 * first + 1:4 * first + 3] - child, child - self.high[2 * first + 1:4 * first + 3])
            out = np.maximum(np.repeat(out, 2, axis=1), gap)
        return out

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        """The leaf that each point falls into, by the halves' middle distances."""
        node = np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            d = np.sqrt(((points - self.vantage[node]) ** 2).sum(axis=1))
            middle = (np.minimum(self.high[2 * node + 1], 1e300) + self.low[2 * node + 2]) / 2
            node = 2 * node + 1 + (d > middle)
        return node - (self.leaves - 1)

    def ancestors(self, leaf: int):
        """(node, its parent) from a leaf up to below the root."""
        node = leaf + self.leaves - 1
        while node:
            yield node, (node - 1) // 2
            node = (node - 1) // 2


def reach(kth: np.ndarray, square: np.ndarray, top: float) -> np.ndarray:
    """The distance of members whose inner product with the query is ``kth``."""
    with np.errstate(invalid="ignore"):
        return np.where(np.isneginf(kth), np.inf, np.sqrt(np.maximum(square + top * top - 2 * kth, 0)))


def search(tree: Tree, points: np.ndarray, rank: np.ndarray, queries: np.ndarray, kth: np.ndarray, k: int,
           factor: float, top: float):
    """(query, member, score) of up to k best members for each query, of equal
    ones those of least ``rank``; only scores from the query's ``kth`` on matter.

    Buckets are taken one after the other, each against all queries that may find
    something in it. First every query's nearest bucket, so that the rest is bounded."""
    n, d = queries.shape
    square = np.einsum("ij,ij->i", queries, queries)
    flat = np.concatenate((queries, np.zeros((n, 1))), axis=1)
    bound = tree.bounds(flat)
    # rounding of the bounds and products; only ever lets more pass
    slack, loose = 1e-6 * max(top, float(np.sqrt(square.max(initial=0)))), 1e-9 * top * np.sqrt(square)
    score, who = np.full((n, k), -np.inf), np.full((n, k), -1)
    best = kth.copy()
    home = bound.argmin(axis=1)
    for nearest in (True, False):
        for b in range(tree.leaves):
            lo, hi = tree.cuts[b], tree.cuts[b + 1]
            if lo == hi:
                continue
            ask = np.flatnonzero(((home == b) == nearest) & (bound[:, b] <= factor * reach(best, square, top) + slack))
            if not len(ask):
                continue
            block = points[lo:hi, :d]
            i, j = np.nonzero(queries[ask] @ block.T >= (best[ask] - loose[ask])[:, None])
            if not len(i):
                continue
            exact = (queries[ask[i]] * block[j]).sum(axis=1)
            for q in np.split(np.arange(len(i)), np.flatnonzero(np.diff(i)) + 1):
                a = ask[i[q[0]]]
                s = np.concatenate((score[a], exact[q]))
                w = np.concatenate((who[a], lo + j[q]))
                pick = np.lexsort((rank[w], -s))[:k]
                score[a], who[a] = s[pick], w[pick]
                best[a] = max(best[a], score[a, -1])
    q, at = np.nonzero(who >= 0)
    return q, who[q, at], score[q, at]


def fitted_factor(x: np.ndarray, top: float, k: int, bucket: int) -> float:
    """The least of FACTORS, but one, that reaches RECALL on a sample."""
    leaves = 1 << int(max(1, len(x) // bucket)).bit_length() - 1
    if leaves < 4 or len(x) <= 2 * k:
        return FACTORS[0]
    tree = Tree.build(augment(x, top), leaves)
    points = x[tree.order]
    queries = points[np.unique(np.linspace(0, len(x) - 1, TRIALS).astype(int))]
    kth = np.partition(queries @ points.T, -k, axis=1)[:, -k]
    nothing = np.full(len(queries), -np.inf)
    for larger, factor in zip(FACTORS, FACTORS[1:]):
        q, _, score = search(tree, points, np.arange(len(x)), queries, nothing, k, factor, top)
        if (score >= kth[q] - 1e-9 * top * top).sum() < RECALL * k * len(queries):
            break
    else:
        return FACTORS[-2]
    return FACTORS[max(0, FACTORS.index(larger) - 1)]


def _vectors(column: pa.Array) -> np.ndarray:
    """Binary vectors of one length as a matrix."""
    if not len(column):
        return np.zeros((0, 0))
    return np.stack([np.frombuffer(b.as_buffer(), np.float64) for b in column])


def valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v, square): vectors that take part, as the bytes of their doubles."""
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("e"))

    def run(batches):
        for batch in batches:
            rows = [np.zeros(0) if x is None else x.to_numpy(zero_copy_only=False).astype(np.float64)
                    for x in (e.values for e in batch.column("e"))]
            with np.errstate(over="ignore", invalid="ignore"):
                square = np.array([float(x @ x) for x in rows])
            ok = np.isfinite(square) & (square > 0)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([x.tobytes() for x in rows], pa.binary()),
                                              pa.array(square)], names=["vec_id", "v", "square"]).filter(pa.array(ok))

    return src.filter("vec_id IS NOT NULL").mapInArrow(run, "vec_id long, v binary, square double")


def top_trees(members: DataFrame, top: float, k: int, factor: float | None, sample: int, sample_bytes: int, leaves: int,
              shard_bytes: int, bucket: int) -> dict[int, Tree]:
    """By vector length, the tree that deals vectors into leaves and the factor
    to search with, fitted on a bounded sample chosen by hash."""
    n, widest = members.agg(F.sum(F.octet_length("v")), F.max(F.octet_length("v"))).first()
    if not n:
        return {}
    rows = max(64, min(sample, sample_bytes // widest))
    picked = members.select("v").orderBy(F.xxhash64("v"), "v").limit(rows).toArrow().column("v").combine_chunks()
    length, out = np.array([len(b.as_buffer()) for b in picked]), {}
    wanted = min(leaves, n / shard_bytes)
    for size in np.unique(length).tolist():
        rows = np.flatnonzero(length == size)
        share = max(1, int(wanted * len(rows) / len(length)))
        x = _vectors(picked.take(pa.array(rows)))
        tree = out[size // 8] = Tree.build(augment(x, top), 1 << (share - 1).bit_length())
        tree.order, tree.factor = None, fitted_factor(x, top, k, bucket) if factor is None else factor
    return out


def _by_length(batch, column: str = "v"):
    """(length, row numbers, matrix) of the vectors of a batch."""
    length = np.array([len(b.as_buffer()) // 8 for b in batch.column(column)], np.int64)
    for d in np.unique(length).tolist():
        rows = np.flatnonzero(length == d)
        yield d, rows, _vectors(batch.column(column).take(pa.array(rows)))


def leaves_of(rows: DataFrame, trees, top: float, member: bool) -> DataFrame:
    """``rows`` with the length of the vector v and the leaf it falls into."""

    def run(batches):
        for batch in batches:
            dim, leaf = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int32)
            for d, at, x in _by_length(batch):
                dim[at] = d
                if d in trees.value:
                    x = augment(x, top) if member else np.concatenate((x, np.zeros((len(x), 1))), axis=1)
                    leaf[at] = trees.value[d].leaf_of(x)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(dim), pa.array(leaf)],
                                             names=[*batch.schema.names, "dim", "leaf"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, schema + ", dim int, leaf int")


_SHARD = ("dim int, leaf int, salt int, x binary, ids array<array<bigint>>, cuts array<bigint>, vantage binary, "
          "low array<double>, high array<double>, near array<double>, far array<double>")


def build_shard(table: pa.Table, trees, top: float, bucket: int) -> pa.Table:
    """The row of the index for the members of one shard: its tree, and how far
    the members are from the vantage points above its leaf."""
    table = table.combine_chunks()
    dim, leaf, salt = (table.column(c)[0].as_py() for c in ("dim", "leaf", "salt"))
    x = _vectors(table.column("v").combine_chunks())
    points = augment(x, top)
    tree = Tree.build(points, 1 << int(max(1, -(-len(x) // bucket)) - 1).bit_length())
    near, far, above = [], [], trees.value.get(dim)
    for _, parent in above.ancestors(leaf) if above else ():
        d = distances(points, above.vantage[parent][None])
        near.append(float(d.min()))
        far.append(float(d.max()))
    ids = table.column("ids").combine_chunks().take(pa.array(tree.order))
    return pa.table([pa.array([v], t) for v, t in (
        (dim, pa.int32()), (leaf, pa.int32()), (salt, pa.int32()), (x[tree.order].tobytes(), pa.binary()),
        (ids.to_pylist(), pa.list_(pa.list_(pa.int64()))), (tree.cuts.tolist(), pa.list_(pa.int64())),
        (tree.vantage.tobytes(), pa.binary()), (tree.low.tolist(), pa.list_(pa.float64())),
        (tree.high.tolist(), pa.list_(pa.float64())), (near, pa.list_(pa.float64())), (far, pa.list_(pa.float64())))],
        names=["dim", "leaf", "salt", "x", "ids", "cuts", "vantage", "low", "high", "near", "far"])


_FOUND = "q binary, score double, vec_id long"


def search_shard(shard: pa.Table, asked: pa.Table, k: int, trees, top: float) -> pa.Table:
    """Up to k (q, score, vec_id) for each query of a shard."""
    schema = pa.schema([("q", pa.binary()), ("score", pa.float64()), ("vec_id", pa.int64())])
    if not shard.num_rows or not asked.num_rows:
        return schema.empty_table()
    row = {c: shard.column(c)[0] for c in ("dim", "x", "ids", "cuts", "vantage", "low", "high")}
    d = row["dim"].as_py()
    x = np.frombuffer(row["x"].as_buffer(), np.float64).reshape(-1, d)
    tree = Tree(None, *(np.asarray(row[c].values) if c != "vantage" else
                        np.frombuffer(row[c].as_buffer(), np.float64).reshape(-1, d + 1)
                        for c in ("cuts", "vantage", "low", "high")))
    ids, factor = row["ids"].as_py(), trees.value[d].factor if d in trees.value else 1.0
    kth = np.array([-np.inf if s is None else s for s in asked.column("kth").to_pylist()])
    queries = _vectors(asked.column("v").combine_chunks())
    q, who, score = search(tree, x, np.array([i[0] for i in ids]), queries, kth, k, factor, top)
    size = np.array([len(i) for i in ids], np.int64)
    q, score, vec = np.repeat(q, size[who]), np.repeat(score, size[who]), np.array([v for w in who.tolist() for v in ids[w]], np.int64)
    by = np.lexsort((vec, -score, q))
    q, score, vec = q[by], score[by], vec[by]
    keep = np.arange(len(q)) - np.searchsorted(q, q) < k
    return pa.table([asked.column("q").combine_chunks().take(pa.array(q[keep])), pa.array(score[keep]), pa.array(vec[keep])],
                    schema=schema)


def ask(index: DataFrame, routed: DataFrame, k: int, trees, top: float, queries: int) -> DataFrame:
    """(q, score, vec_id) that the shards find for the queries (q, v, kth) sent to
    them; the queries of a shard are cut into blocks of bounded size."""
    shard = ["dim", "leaf", "salt"]
    blocks = routed.groupBy(*shard).agg(F.ceil(F.count(F.lit(1)) / queries).cast("int").alias("blocks"))
    left = index.join(blocks, shard).withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
    right = routed.join(blocks, shard).withColumn("block", F.pmod(F.xxhash64("q"), F.col("blocks")).cast("int"))
    key = [*shard, "block"]
    return (left.select(*key, "x", "ids", "cuts", "vantage", "low", "high").groupBy(*key)
            .cogroup(right.select(*key, "q", "v", "kth").groupBy(*key))
            .applyInArrow(lambda s, a: search_shard(s, a, k, trees, top), _FOUND))


def routes(queries: DataFrame, trees, spans, top: float) -> DataFrame:
    """(q, v, kth, dim, leaf): the leaves that may hold something nearer than a query's kth.
    ``spans``: by length and leaf, how far its members are from the vantage points above."""

    def run(batches):
        for batch in batches:
            for d, at, x in _by_length(batch):
                tree = trees.value.get(d)
                part = batch.take(pa.array(at))
                square = np.einsum("ij,ij->i", x, x)
                kth = np.array([-np.inf if s is None else s for s in part.column("kth").to_pylist()])
                limit = (tree.factor if tree else 1.0) * reach(kth, square, top) + 1e-6 * max(top, float(np.sqrt(square.max())))
                if tree is None:
                    pairs = [(np.arange(len(x)), 0)]
                else:
                    far = distances(np.concatenate((x, np.zeros((len(x), 1))), axis=1), tree.vantage)
                    pairs = []
                    for leaf, (near_to, far_to) in spans.value.get(d, {}).items():
                        bound = np.zeros(len(x))
                        for i, (_, parent) in enumerate(tree.ancestors(leaf)):
                            bound = np.maximum(bound, np.maximum(near_to[i] - far[:, parent], far[:, parent] - far_to[i]))
                        pairs.append((np.flatnonzero(bound <= limit), leaf))
                for rows, leaf in pairs:
                    if len(rows):
                        sent = part.take(pa.array(rows))
                        yield pa.RecordBatch.from_arrays(
                            [*sent.columns, pa.array(np.full(len(rows), d, np.int32)), pa.array(np.full(len(rows), leaf, np.int32))],
                            names=[*sent.schema.names, "dim", "leaf"])

    return queries.select("q", "v", "kth").mapInArrow(run, "q binary, v binary, kth double, dim int, leaf int")


def nearest(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", query: str = "vec_id % 20 = 0",
            k: int = NEIGHBOURS, factor: float | None = None, sample: int = SAMPLE, leaves: int = LEAVES,
            shard_bytes: int = SHARD_BYTES, bucket: int = BUCKET, block: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each row that
    ``query`` (on vec_id) picks. ``factor`` is fitted unless given."""
    spark = vectors.sparkSession
    live = stage(valid(vectors, id_col, vector_col).groupBy("vec_id").agg(F.min(F.struct("v", "square")).alias("m"))
                 .select("vec_id", "m.v", "m.square"), "vectors")
    top = float(np.sqrt(live.agg(F.max("square")).first()[0] or 0.0))
    by_id = Window.partitionBy("v").orderBy("vec_id")
    members = stage(live.select("v", "vec_id", F.row_number().over(by_id).alias("place")).filter(F.col("place") <= k + 1)
                    .groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "members")  # at most k + 1 ids
    trees = spark.sparkContext.broadcast(top_trees(members, top, k + 1, factor, sample, SAMPLE_BYTES, leaves, shard_bytes, bucket))
    dealt = leaves_of(members, trees, top, True)
    sizes = stage(dealt.groupBy("dim", "leaf").agg(
        F.ceil(F.sum(F.octet_length("v")) / shard_bytes).cast("int").alias("salts")), "sizes")
    salt = F.pmod(F.xxhash64("v"), F.col("salts")).cast("int")
    index = stage(dealt.join(sizes, ["dim", "leaf"]).withColumn("salt", salt).select("dim", "leaf", "salt", "v", "ids")
                  .groupBy("dim", "leaf", "salt").applyInArrow(lambda t: build_shard(t, trees, top, bucket), _SHARD), "index")

    # at most a row per leaf of the trees, the distances to the vantage points above it
    spans = {}
    for r in (index.filter("size(near) > 0").select("dim", "leaf", F.posexplode(F.arrays_zip("near", "far")).alias("i", "z"))
              .groupBy("dim", "leaf", "i").agg(F.min("z.near").alias("near"), F.max("z.far").alias("far"))
              .groupBy("dim", "leaf").agg(F.array_sort(F.collect_list(F.struct("i", "near", "far"))).alias("z")).collect()):
        spans.setdefault(r.dim, {})[r.leaf] = ([z.near for z in r.z], [z.far for z in r.z])
    for d, tree in trees.value.items():
        if tree.leaves == 1:
            spans[d] = {0: ([], [])}
    spans = spark.sparkContext.broadcast(spans)

    asking = live.filter(query).select("vec_id", "v", F.unhex(F.md5("v")).alias("q"))
    queries = stage(leaves_of(asking.groupBy("q").agg(F.first("v").alias("v")), trees, top, False)
                    .join(sizes, ["dim", "leaf"], "left").withColumn("salt", salt), "queries")
    none = F.lit(None).cast("double").alias("kth")
    home = stage(ask(index, queries.filter("salts IS NOT NULL").select("q", "v", none, "dim", "leaf", "salt"),
                     k + 1, trees, top, block), "home")
    kth = home.groupBy("q").agg(F.when(F.count(F.lit(1)) > k, F.min("score")).alias("kth"))
    there = queries.select("q", F.col("leaf").alias("home_leaf"), F.col("salt").alias("home_salt"))
    routed = (routes(queries.join(kth, "q", "left"), trees, spans, top).join(sizes, ["dim", "leaf"])
              .withColumn("salt", F.explode(F.expr("sequence(0, salts - 1)"))).join(there, "q")
              .filter("NOT (leaf <=> home_leaf AND salt <=> home_salt)")
              .select("q", "v", "kth", "dim", "leaf", "salt"))
    routed = stage(routed, "routed")
    rest = ask(index, routed, k + 1, trees, top, block)

    best = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")
    results = (home.union(rest).withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)
               .groupBy("q").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("found")))
    out = (asking.select(F.col("vec_id").alias("query_id"), "q").join(results, "q")
           .select("query_id", F.expr(f"slice(filter(found, f -> f.vec_id <> query_id), 1, {int(k)})").alias("found"))
           .select("query_id", F.posexplode("found").alias("rank", "f"))
           .select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), "f.vec_id", "f.score"))
    out = stage(out, "nearest")
    for t in (live, members, index, queries, home, routed):
        drop(t)
    return out
