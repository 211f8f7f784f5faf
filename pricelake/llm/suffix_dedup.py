"""Suffix-array dedup with difference-cover blocks (operator 8).

Every byte covered by a 50-byte string that also starts in a document with a
smaller doc_id is removed. Steps, exact but for 64-bit hashes of equal texts:

1. *Candidates.* Each 50-byte string owns the smallest hash among its inner
   16-byte grams; equal strings own equal grams. Only strings whose gram
   is seen elsewhere (``exchange.seen_elsewhere``) can match. Neighbouring
   strings of one gram travel together as a *run* of bytes, each distinct run
   once per part, with the smallest doc_id that has it there.
2. *Suffix buckets.* The shard that owns a gram's hash range orders the
   suffixes that start its runs' strings (``suffix_sort``: one bucket at a
   time, long ties resolved by the ranks of a difference-cover sample), finds
   equal strings side by side and takes the smallest doc_id of each class.
   Each part gets one bit per string back.
3. Every part drops the covered bytes of its documents.

Nulls and empty texts have no bytes. A null doc_id counts as larger than
every other. Documents that share a doc_id don't match each other. Further
input columns are ignored. A string that a third of all documents share is
one run per part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, functions as F

from pricelake.llm import arrowtext as T, exchange as X
from pricelake.llm.suffix_sort import equal_classes

WIDTH = 50
GRAM = 16
#: Runs of a shard on average if every string were a candidate.
SHARD_RUNS = 60_000

_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
_RUNS = pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("lens", pa.binary()), ("docs", pa.binary()),
                   ("content", pa.binary())])
_LAST = np.iinfo(np.int64).max


class _Runs:
    """Runs of neighbouring strings that own the same gram, for all rows of a part."""

    def __init__(self, table: pa.Table, width: int, gram: int):
        self.data, self.off = T.flat(table.column("text"))
        at, lens, keys, content = [], [], [], []
        for lo, hi in T.chunks(self.off):
            base = self.off[lo]
            sub, off = self.data[base:self.off[hi]], self.off[lo:hi + 1] - base
            if len(sub) < width:
                continue
            prefix = T.prefix(T.byte_values(sub))
            i = np.arange(len(sub) - gram + 1)
            own = T.sliding_min(T.span_hash(prefix, i, i + gram), width - gram + 1)
            win = T.window_starts(off, width)
            own = own[win]
            new = np.ones(len(win), bool)
            new[1:] = (own[1:] != own[:-1]) | (win[1:] != win[:-1] + 1)
            first = np.flatnonzero(new)
            size = np.diff(np.append(first, len(win)))
            at.append(win[first] + base)
            lens.append(size)
            keys.append(T.mix(own[first]))  # minima crowd near 0; mixed they fill all shards alike
            content.append(T.span_hash(prefix, win[first], win[first] + size + width - 1))
        z = np.zeros(0, np.int64)
        u = np.zeros(0, np.uint64)
        self.at, self.lens = (np.concatenate(x) if x else z for x in (at, lens))
        self.keys, self.content = (np.concatenate(x) if x else u for x in (keys, content))

    def candidates(self, table: pa.Table, answers: pa.Table, shards: int):
        """Runs whose gram is seen elsewhere; of each distinct content one run
        of the smallest doc_id, in an order that depends on the rows as a set."""
        distinct, where = np.unique(self.keys, return_inverse=True)
        seen = X.answered(answers, distinct, shards)
        live = np.flatnonzero(seen[where]) if len(distinct) else np.zeros(0, np.int64)
        ids = _ids(table)[T.rows_of(self.at[live], self.off)]
        content, keys = self.content[live], self.keys[live]
        order = np.lexsort((ids, content, keys))
        new = np.ones(len(order), bool)
        new[1:] = content[order][1:] != content[order][:-1]
        back = np.empty(len(order), np.int64)
        back[order] = np.cumsum(new) - 1
        return live, ids, order[new], back, keys[order[new]]


def _ids(table: pa.Table) -> np.ndarray:
    return table.column("doc_id").combine_chunks().cast(pa.int64()).fill_null(_LAST).to_numpy(zero_copy_only=False)


def earlier(content: np.ndarray, lens: np.ndarray, docs: np.ndarray, width: int) -> np.ndarray:
    """For the runs of a shard: for each string, whether a run of a smaller doc has it."""
    size = lens + width - 1
    at = np.concatenate(([0], np.cumsum(size)))
    prefix = T.prefix(T.byte_values(content))
    whole = T.span_hash(prefix, at[:-1], at[1:])
    del prefix
    # equal runs are one: the suffixes of the smallest doc's copy are sorted
    order = np.lexsort((docs, whole))
    new = np.ones(len(order), bool)
    new[1:] = whole[order][1:] != whole[order][:-1]
    back = np.empty(len(order), np.int64)
    back[order] = np.cumsum(new) - 1
    pick = order[new]
    text = content[T.ranges(at[pick], size[pick])]
    first = np.concatenate(([0], np.cumsum(size[pick])))[:-1]
    starts = T.ranges(first, lens[pick])
    classes = equal_classes(text, starts, width)
    least = np.full(int(classes.max()) + 1 if len(classes) else 0, _LAST)
    np.minimum.at(least, classes, np.repeat(docs[pick], lens[pick]))
    offset = np.concatenate(([0], np.cumsum(lens[pick])))[:-1]
    return least[classes[T.ranges(offset[back], lens)]] < np.repeat(docs, lens)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                   gram: int = GRAM, part_bytes: int = X.PART_BYTES, with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept): every document
    without the bytes that repeat an earlier document; ``kept`` only if ``with_text``."""
    total = X.text_bytes(docs, text_col)
    parts = X.deal(docs, id_col, text_col, total, part_bytes)
    density = 2 / (width - gram + 2)
    shards = X.shard_count(total * density)
    run_shards = X.shard_count(total * density, SHARD_RUNS)

    answers = X.seen_elsewhere(parts, lambda t: _Runs(t, width, gram).keys, shards)

    def send(table: pa.Table, seen: pa.Table) -> pa.Table:
        if not table.num_rows:
            return X.make_table([], _RUNS)
        r = _Runs(table, width, gram)
        live, ids, pick, _, keys = r.candidates(table, seen, shards)
        at, part, out = X.shard_bounds(keys, run_shards), table.column("part")[0].as_py(), []
        for s in np.flatnonzero(np.diff(at)):
            p = pick[at[s]:at[s + 1]]
            n = r.lens[live[p]]
            out.append((int(s), part, n.astype(np.uint32).tobytes(), ids[p].tobytes(),
                        r.data[T.ranges(r.at[live[p]], n + width - 1)].tobytes()))
        return X.make_table(out, _RUNS)

    def bucket(table: pa.Table) -> pa.Table:
        lens = [np.frombuffer(b, np.uint32).astype(np.int64) for b in table.column("lens").to_pylist()]
        ids = np.frombuffer(b"".join(table.column("docs").to_pylist()), np.int64)
        content = np.frombuffer(b"".join(table.column("content").to_pylist()), np.uint8)
        bits = earlier(content, np.concatenate(lens), ids, width)
        cuts = np.cumsum([int(k.sum()) for k in lens])[:-1]
        shard = table.column("shard")[0].as_py()
        out = [(p, shard, np.packbits(b).tobytes())
               for p, b in zip(table.column("part").to_pylist(), np.split(bits, cuts))]
        return X.make_table(out, pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("bits", pa.binary())]))

    runs = X.with_answers(parts, answers, send, "shard int, part int, lens binary, docs binary, content binary")
    found = runs.groupBy("shard").applyInArrow(bucket, "part int, shard int, bits binary")
    both = (answers.select("part", F.lit(0).alias("kind"), "shard", "bits")
            .union(found.select("part", F.lit(1).alias("kind"), "shard", "bits")))

    def finish(table: pa.Table, said: pa.Table) -> pa.Table:
        removed, runs_, sums, texts = [], [], [], []
        n_bytes = np.zeros(0, np.int64)
        if table.num_rows:
            r = _Runs(table, width, gram)
            kind = said.column("kind").to_numpy()
            live, ids, pick, back, keys = r.candidates(table, said.filter(pa.array(kind == 0)), shards)
            sizes = r.lens[live[pick]]
            flags = np.zeros(int(sizes.sum()), bool)
            ends = np.concatenate(([0], np.cumsum(sizes)))
            at = X.shard_bounds(keys, run_shards)
            mine = said.filter(pa.array(kind == 1))
            for s, b in zip(mine.column("shard").to_pylist(), mine.column("bits").to_pylist()):
                lo, hi = ends[at[s]], ends[at[s + 1]]
                flags[lo:hi] = np.unpackbits(np.frombuffer(b, np.uint8), count=hi - lo).astype(bool)
            lens = r.lens[live]
            # a copy in a larger doc of this part repeats the picked run; the picked run goes by the shard's bits
            later = np.repeat(ids > ids[pick][back], lens) if len(live) else np.zeros(0, bool)
            starts = T.ranges(r.at[live], lens)[flags[T.ranges(ends[back], lens)] | later]
            gone = T.cover(starts, width, len(r.data))
            n_bytes = np.diff(r.off)
            for lo, hi in zip(r.off[:-1], r.off[1:]):
                g = gone[lo:hi]
                kept = r.data[lo:hi]
                if g.any():
                    kept = kept[~g]
                    runs_.append(int(g[0]) + int(np.count_nonzero(g[1:] & ~g[:-1])))
                else:
                    runs_.append(0)
                removed.append(int(hi - lo) - len(kept))
                kept = kept.tobytes()
                sums.append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    texts.append(kept)
        n = len(sums)
        schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                            ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])
        return pa.table([table.column("doc_id") if n else [], pa.array(n_bytes, pa.int64()),
                         pa.array(removed, pa.int64()), pa.array(runs_, pa.int64()), pa.array(sums, pa.string()),
                         pa.array(texts, pa.binary()) if with_text else pa.nulls(n, pa.binary())], schema=schema)

    out = X.with_answers(parts, both, finish, _RESULT)
    return out if with_text else out.drop("kept")
