"""N-gram Jaccard join with size-banded tiles and bitmap signatures (operator 4).

Documents link when the Jaccard similarity of their distinct word 3-shingles
reaches a percentage (0.9 here; any from 50 on). Exact, up to 64-bit hashes:

1. *Tiles.* Sizes fall in bands no narrower than the largest size ratio of a
   link, so a link joins documents of one band or of neighbouring bands. For a
   band whose smaller documents differ from a partner in at most H
   shingles, the hash space is cut in H + 1 + E segments: linked documents
   agree on more than E of them, so on one that is not empty unless both have
   more than E empty ones (E makes that rare; such documents use empty
   segments too). The hash of a segment's content is a key; documents with a
   common key form a tile. ``exchange.seen_elsewhere`` finds the keys that
   other documents have, and a document with fewer of them than any link
   agrees on is out.
2. *Copies.* Documents with equal sets are one class; from here on a document is
   a class, known by a hash of its set.
3. *Stars.* In each tile every document is compared with the tile's hub, the class of the smallest id; that links the bulk of any group of near copies, in linear work.
4. *Rest.* Tiles of the same hub are one bundle, in which a document stands
   once however many tiles it shares. Only bundles that then still hold
   several components are compared member against member, across
   components, in blocks of bounded size; where that places
   fewer members, a bundle's largest component meets the others only, so a large
   group costs its size, not the square.

Each comparison first bounds the overlap by the bit counts of hashed bitmaps,
``overlap <= (n_a + n_b - popcount(a xor b)) / 2``, and what passes is decided
by intersecting the sorted shingle arrays.

A document without words or text has an empty set and no link. Rows without a
doc_id link with nothing and have no component; rows that share a
doc_id are one node. Further input columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, functions as F

from pricelake.llm import arrowtext as T, exchange as X
from pricelake.llm.components import components
from pricelake.llm.scratch import drop, stage

SHINGLE = 3
PERCENT = 90
#: Members of a block of a bundle that is compared member against member.
BLOCK = 2048

_U = np.uint64
_DOC = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("sig_a", pa.int64()), ("sig_b", pa.int64()),
                  ("keys", pa.list_(pa.int64())), ("bits", pa.binary()), ("grams", pa.binary())])
_DOC_SQL = "doc_id long, n long, sig_a long, sig_b long, keys array<long>, bits binary, grams binary"


def max_difference(size, percent: int):
    """Most shingles in which a set of ``size`` and a linked one, no smaller, differ."""
    return size * (100 - percent) // percent


def size_bands(largest: int, percent: int) -> np.ndarray:
    """First sizes of the bands, up to beyond ``largest``."""
    equal_only = next(n for n in range(1, 102) if max_difference(n, percent) > 0)
    out = [1, equal_only]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, -(-out[-1] * 100 // percent)))
    out.append(max(out[-1] + 1, -(-out[-1] * 100 // percent)))
    return np.array(out)


def spare_segments(differ: np.ndarray, smallest: np.ndarray) -> np.ndarray:
    """E of a band: more empty segments than a set of its smallest size
    is likely to have (Poisson mean plus five deviations), at least two."""
    cuts = differ + 1.0
    for _ in range(3):
        empty = cuts * np.exp(-smallest / cuts)
        cuts = differ + 1 + np.ceil(empty + 5 * np.sqrt(empty) + 2)
    return (cuts - differ - 1).astype(np.int64)


class _Sets:
    """Distinct shingle hashes of a part's rows, sorted, and their tile keys."""

    def __init__(self, table: pa.Table, shingle: int, percent: int):
        data, off = T.flat(table.column("text"))
        words, first, _, _ = T.words_of(data, off, lower=True)
        prefix = T.prefix(words)
        win = T.window_starts(first, shingle)
        grams = T.span_hash(prefix, win, win + shingle)
        at = np.searchsorted(win, first)
        count = np.diff(first)
        sets = [np.unique(grams[a:z]) for a, z in zip(at[:-1].tolist(), at[1:].tolist())]
        for r in np.flatnonzero((count > 0) & (count < shingle)):
            sets[r] = T.span_hash(prefix, first[r:r + 1], first[r + 1:r + 2])
        self.sets = sets
        self.n = np.array([len(s) for s in sets], np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.n)))
        self.grams = np.concatenate(sets) if sets else np.zeros(0, _U)
        self.known = table.column("doc_id").is_valid().to_numpy()
        self._keys(percent)

    def _keys(self, percent: int) -> None:
        """key[i] belongs to row key_row[i]."""
        rows = np.flatnonzero((self.n > 0) & self.known)
        bands = size_bands(int(self.n.max()) if len(self.n) else 1, percent)
        band = np.searchsorted(bands, self.n, side="right") - 1
        values = np.concatenate((np.zeros(1, _U), np.cumsum(T.mix(self.grams))))
        of_row = np.repeat(np.arange(len(self.n)), self.n)
        keys, owner, need, role = [], [], [], []
        # own band, where a partner may be smaller or larger; and the band below, as the larger partner
        for b in (band, band - 1):
            use = rows[b[rows] >= 0]
            h = max_difference(bands[b[use] + 1] - 1, percent)
            e = np.where(h > 0, spare_segments(h, bands[b[use]]), 0)
            segments, spare = np.zeros(len(self.n), np.int64), np.zeros(len(self.n), np.int64)
            segments[use], spare[use] = h + 1 + e, e
            base = np.concatenate(([0], np.cumsum(segments)))
            inside = segments[of_row] > 0
            seg = ((self.grams >> _U(32)) * segments[of_row].astype(_U)) >> _U(32)
            place = np.flatnonzero(inside)
            where = base[of_row[place]] + seg[place].astype(np.int64)
            edge = np.searchsorted(where, np.arange(base[-1] + 1))
            lo, hi = (np.append(place, len(self.grams))[edge[:-1]], np.append(place, len(self.grams))[edge[1:]])
            empty = edge[:-1] == edge[1:]
            hi = np.where(empty, lo, np.where(edge[1:] > 0, place[np.maximum(edge[1:] - 1, 0)] + 1, 0)) \
                if len(place) else lo
            row = np.repeat(np.arange(len(self.n)), segments)
            number = np.arange(base[-1]) - base[row]
            hollow = np.bincount(row[empty], minlength=len(self.n))
            total = values[hi] - values[lo]
            tag = T.mix((b[row] + 1).astype(_U) * _U(1 << 32) + number.astype(_U))
            keep = ~empty | (hollow[row] > spare[row])
            keys.append(T.mix(total ^ tag)[keep])
            owner.append(row[keep])
            role.append(np.full(int(keep.sum()), len(role)))
            # a link agrees on more than E segments, and at most these are empty
            need.append(np.maximum(1, 1 + spare - hollow))
        key, row, part = np.concatenate(keys), np.concatenate(owner), np.concatenate(role)
        order = np.argsort(row, kind="stable")
        self.key, self.key_row, self.key_role, self.need = key[order], row[order], part[order], np.stack(need)

    def enough(self, seen: np.ndarray) -> np.ndarray:
        """The seen keys of rows that have as many as a link needs, by role."""
        place = self.key_role * len(self.n) + self.key_row
        have = np.bincount(place[seen], minlength=2 * len(self.n))
        return seen & (have >= self.need.ravel())[place]


def bitmap(grams: np.ndarray) -> bytes:
    """One hashed bit a shingle, in the least power of two of at least four bits a shingle."""
    size = max(64, 1 << int(4 * len(grams) - 1).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[(grams & _U(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def fold(bits: np.ndarray, size: int) -> np.ndarray:
    """The same bitmap at a smaller power of two of bytes."""
    return np.bitwise_or.reduce(bits.reshape(-1, size)) if len(bits) > size else bits


def may_link(n_a, n_b, differing, percent: int):
    """Whether the bit counts allow a link: overlap <= (n_a + n_b - differing) / 2."""
    return (100 + percent) * ((n_a + n_b - differing) // 2) >= percent * (n_a + n_b)


def _documents(docs, id_col, text_col, shingle, percent, part_bytes) -> DataFrame:
    """Sizes of all documents; set, bitmap and shared keys of those that share a key."""
    total = X.text_bytes(docs, text_col)
    parts = X.deal(docs, id_col, text_col, total, part_bytes)
    shards = X.shard_count(total / 6 * 3 * (100 - percent) / 100)
    answers = X.seen_elsewhere(parts, lambda t: _Sets(t, shingle, percent).key, shards)

    def rows(table: pa.Table, seen: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _DOC.empty_table()
        s = _Sets(table, shingle, percent)
        distinct, where = np.unique(s.key, return_inverse=True)
        live = s.enough(X.answered(seen, distinct, shards)[where]) if len(distinct) else np.zeros(0, bool)
        key, row = s.key[live].view(np.int64), s.key_row[live]
        at = np.searchsorted(row, np.arange(table.num_rows + 1))
        shared = np.diff(at) > 0
        a = [int(x.sum(dtype=_U).view(np.int64)) if len(x) else 0 for x in s.sets]
        b = [int(T.mix(x + _U(0x2545F4914F6CDD1D)).sum(dtype=_U).view(np.int64)) if len(x) else 0 for x in s.sets]
        return pa.table([table.column("doc_id"), pa.array(s.n), pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                         pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(key)),
                         pa.array([bitmap(x) if k else None for x, k in zip(s.sets, shared)], pa.binary()),
                         pa.array([x.tobytes() if k else None for x, k in zip(s.sets, shared)], pa.binary())],
                        schema=_DOC)

    return X.with_answers(parts, answers, rows, _DOC_SQL)


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _bounded(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose bitmaps allow a link."""
    side = sets.select("doc_id", "n", "bits")
    both = (pairs.join(side.toDF("a", "n_a", "bits_a"), "a").join(side.toDF("b", "n_b", "bits_b"), "b"))

    def bound(batches):
        for batch in batches:
            n_a, n_b = (batch.column(x).to_numpy() for x in ("n_a", "n_b"))
            differ = np.zeros(batch.num_rows, np.int64)
            for i, (x, y) in enumerate(zip(batch.column("bits_a"), batch.column("bits_b"))):
                x, y = (np.frombuffer(v.as_buffer(), np.uint8) for v in (x, y))
                size = min(len(x), len(y))
                differ[i] = int(np.bitwise_count((fold(x, size) ^ fold(y, size)).view(_U)).sum())
            ok = pa.array(may_link(n_a, n_b, differ, percent))
            yield batch.select(["a", "b"]).filter(ok)

    return both.mapInArrow(bound, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that link: bounded by bit counts, then decided by their sorted arrays."""
    side = sets.select("doc_id", "grams")
    both = (_bounded(pairs, sets, percent).join(side.toDF("a", "grams_a"), "a")
            .join(side.toDF("b", "grams_b"), "b"))

    def exact(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("grams_a"), batch.column("grams_b")):
                x, y = (np.frombuffer(v.as_buffer(), _U) for v in (x, y))
                at = np.searchsorted(x, y)
                common = int(np.count_nonzero(x[np.minimum(at, len(x) - 1)] == y))
                ok.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return both.mapInArrow(exact, "a long, b long")


def _across(table: pa.Table, percent: int) -> pa.Table:
    """Pairs of a block of a bundle, in different components, that the bitmaps allow."""
    table = table.sort_by([("n", "ascending"), ("doc_id", "ascending")])
    ids, comp, n = (table.column(x).to_numpy() for x in ("doc_id", "component", "n"))
    side = table.column("side").to_numpy()
    bits = [np.frombuffer(b, np.uint8) for b in table.column("bits").to_pylist()]
    size = min(len(b) for b in bits)
    bits = np.stack([fold(b, size) for b in bits]).view(_U)
    out_a, out_b = [], []
    for i in range(len(ids) - 1):
        # sorted by size: partners of i end where they are too large to link
        end = int(np.searchsorted(n, n[i] * 100 // percent, side="right"))
        j = np.arange(i + 1, end)
        j = j[(comp[j] != comp[i]) & ((side[j] != side[i]) | (side[i] == 2))]
        if len(j):
            differ = np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1, dtype=np.int64)
            j = j[may_link(n[i], n[j], differ, percent)]
            out_a.append(np.minimum(ids[i], ids[j]))
            out_b.append(np.maximum(ids[i], ids[j]))
    empty = [np.zeros(0, np.int64)]
    return pa.table([np.concatenate(out_a or empty), np.concatenate(out_b or empty)], schema=_PAIR)


def link_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                percent: int = PERCENT, part_bytes: int = X.PART_BYTES, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    found = stage(_documents(docs, id_col, text_col, shingle, percent, part_bytes), "sets")
    every = stage(found.select("doc_id", "n", "sig_a", "sig_b", (F.size("keys") > 0).alias("live")), "documents")
    live = every.filter("live")
    held = stage(live.groupBy("n", "sig_a", "sig_b").agg(F.min("doc_id").alias("rep"))
                 .withColumn("node", F.xxhash64("n", "sig_a", "sig_b")), "classes")
    copies = live.join(held, ["n", "sig_a", "sig_b"]).select("doc_id", "node")
    # one row a class, known by its node: a doc_id may stand in several
    sets = (found.filter("size(keys) > 0").join(held.withColumnRenamed("rep", "doc_id"), ["doc_id", "n", "sig_a", "sig_b"])
            .dropDuplicates(["node"]).drop("sig_a", "sig_b").withColumnsRenamed({"doc_id": "rep", "node": "doc_id"}))
    sets = stage(sets, "reps")
    # rows that share a doc_id are one node: their classes belong together
    several = (copies.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a < z")
               .select("doc_id", "a"))
    same = copies.join(several, "doc_id").filter("node <> a").select("a", F.col("node").alias("b")).distinct()
    drop(found)
    tiles = sets.select("doc_id", "rep", F.explode("keys").alias("key")).distinct()
    # the class of the smallest doc_id: copies are mostly made of earlier documents
    hubs = (tiles.groupBy("key").agg(F.min(F.struct("rep", "doc_id")).alias("hub"), F.min("doc_id").alias("lo"),
                                     F.max("doc_id").alias("hi"))
            .filter("lo < hi").select("key", F.col("hub.doc_id").alias("hub")))
    bundles = stage(tiles.join(hubs, "key").select("hub", "doc_id").distinct(), "bundles")
    stars = bundles.filter("doc_id <> hub").select(F.col("hub").alias("a"), F.col("doc_id").alias("b"))
    links = stage(_verified(stars, sets, percent).union(same), "links")
    joined = components(links)

    # bundles that hold several components, member against member in blocks
    named = (bundles.join(joined.withColumnRenamed("node", "doc_id"), "doc_id", "left")
             .withColumn("component", F.coalesce("component", "doc_id")))
    parts = (named.groupBy("hub", "component").agg(F.count(F.lit(1)).alias("members")).groupBy("hub")
             .agg(F.max(F.struct("members", "component")).alias("main"), F.sum("members").alias("members"),
                  F.count(F.lit(1)).alias("several")).filter("several > 1"))
    in_blocks = "cast(ceil({} / %d) AS int)" % block
    cost = (parts.selectExpr("hub", "main.component AS main", "members", "main.members AS core", "members - main.members AS others")
            .selectExpr("*", in_blocks.format("members") + " AS all_blocks", in_blocks.format("others") + " AS other_blocks",
                        in_blocks.format("core") + " AS core_blocks"))
    # setting the largest component apart pays if it places fewer members than all blocks against all
    apart = F.expr("others * (other_blocks + core_blocks) + core * other_blocks < members * all_blocks")
    open_ = cost.select("hub", F.when(apart, F.col("main")).alias("main"),
                        F.when(apart, F.col("other_blocks")).otherwise(F.col("all_blocks")).alias("rest_blocks"),
                        F.when(apart, F.col("core_blocks")).otherwise(0).alias("main_blocks"))
    open_ = stage(open_, "open")  # a row per open bundle, measured before it meets the members
    in_main = F.col("component").eqNullSafe(F.col("main"))
    # blocks of the other components come first, those of the largest one after them
    member = (named.join(open_, "hub")
              .withColumn("own", F.when(in_main, F.col("rest_blocks") + F.pmod(F.xxhash64("doc_id"), F.col("main_blocks")))
                          .otherwise(F.pmod(F.xxhash64("doc_id"), F.col("rest_blocks"))).cast("int"))
              .withColumn("last", F.when(in_main, F.col("rest_blocks")).otherwise(F.col("rest_blocks") + F.col("main_blocks")) - 1))
    # block pairs (x <= y): a member of block o stands in (o, y) and (x, o); the largest
    # component is linked within, so its blocks meet those of the others alone
    placed = member.select("hub", "doc_id", "component", "own", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other"))
    placed = placed.select("doc_id", "component", "hub", F.least("own", "other").alias("x"),
                           F.greatest("own", "other").alias("y"),
                           F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0)
                           .otherwise(1).alias("side"))
    rest = (placed.join(sets.select("doc_id", "n", "bits"), "doc_id").groupBy("hub", "x", "y")
            .applyInArrow(lambda t: _across(t, percent), "a long, b long").distinct()
            .join(stars, ["a", "b"], "left_anti"))
    more = stage(_verified(rest, sets, percent), "links")
    if not more.isEmpty():
        joined = components(links.union(more))
    classes = held.select("node", "rep").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = classes.groupBy("component").agg(F.min("rep").alias("least"))
    nodes = (copies.join(classes.join(least, "component").select("node", "least"), "node")
             .groupBy("doc_id").agg(F.min("least").alias("found")))
    for t in (bundles, open_, sets):
        drop(t)
    return (every.select("doc_id", F.col("n").alias("n_shingles")).join(nodes, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("found", "doc_id").alias("component_id")))
