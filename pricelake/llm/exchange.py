"""Ask-and-answer rounds between groups of documents and shards of keys.

Operators that must know which keys of a document occur elsewhere (shingle
segments, word or byte windows) all follow one shape. Documents are dealt
into *parts* by a hash of their id and text. A part sends each of its
distinct keys once to the *shard* that owns the key's hash range, packed as
one binary message per (part, shard); the shard answers with one bit per key.
The part is then read again, next to its answers. A key that holds a third
of all rows is one entry per part, because equal keys meet inside the part
before anything is sent. The exchange of the documents is the same subplan
in every round, so Spark shuffles the texts once.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame, functions as F

#: Text bytes of a part, and keys of a shard, on average.
PART_BYTES = 4 << 20
SHARD_KEYS = 400_000


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """All bytes of the texts: sizes the number of parts and shards."""
    return docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0


def deal(docs: DataFrame, id_col: str, text_col: str, total: int, part_bytes: int = PART_BYTES,
         carry: tuple = ()) -> DataFrame:
    """(part, doc_id, text): documents dealt by a hash of id and text, so that
    neither copies nor repeated ids meet in one part. Columns to ``carry``
    along follow as _0, _1, ..."""
    n = max(1, math.ceil(total / part_bytes))
    h = F.xxhash64(F.col(id_col), F.xxhash64(F.col(text_col)))
    return docs.select(F.pmod(h, F.lit(n)).cast("int").alias("part"),
                       F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"),
                       *[F.col(c).alias(f"_{i}") for i, c in enumerate(carry)])


def shard_count(keys: float, shard_keys: int = SHARD_KEYS) -> int:
    return max(1, math.ceil(keys / shard_keys))


def shard_bounds(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's keys begin in sorted uint64 keys; ranges of equal width."""
    cuts = (np.arange(1, shards, dtype=np.float64) * (2.0 ** 64 / shards)).astype(np.uint64)
    return np.concatenate(([0], np.searchsorted(keys, cuts), [len(keys)]))


def narrow(values: np.ndarray) -> bytes:
    """The low 40 bits of each value, packed."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def wide(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(packed, np.uint8).reshape(-1, 5)
    return out.reshape(-1).view(np.uint64)


_ASK = "shard int, part int, twice binary, more binary, keys binary"
_ASKED = pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("twice", pa.binary()), ("more", pa.binary()),
                    ("keys", pa.binary())])
_ANSWER = "part int, shard int, bits binary, hot binary"


def seen_elsewhere(parts: DataFrame, keys_of, shards: int, hot: int = 0, told: DataFrame | None = None) -> DataFrame:
    """(part, shard, bits, hot): for each distinct key of a part, in sorted
    order, whether any other row of the corpus has it, and whether the key
    occurs ``hot`` times or more (0: not asked; an empty mask means none).

    ``keys_of(table)`` gives the keys of a part's rows as uint64, repeats
    included; with ``told``, answers of an earlier round, it is
    ``keys_of(table, answers)``. Keys travel as their low 40 bits inside a
    shard, so a set bit may rarely be wrong and a clear bit never is; callers
    compare exactly. Repeats inside a part are counted up to the next power of
    two, so a key may be called hot at half that number; all parts are told the same.
    """

    def ask_of(table: pa.Table, found) -> pa.Table:
        part = table.column("part")[0].as_py()
        keys, counts = np.unique(found, return_counts=True)
        at, out = shard_bounds(keys, shards), []
        for s in np.flatnonzero(np.diff(at)):
            lo, hi = at[s], at[s + 1]
            n = counts[lo:hi]
            more = np.ceil(np.log2(n[n > 1])).astype(np.uint8).tobytes() if hot else b""
            out.append((int(s), part, np.packbits(n > 1).tobytes(), more, narrow(keys[lo:hi])))
        return _table(out, _ASKED)

    def ask(table: pa.Table) -> pa.Table:
        return ask_of(table, keys_of(table))

    def ask_again(table: pa.Table, said: pa.Table) -> pa.Table:
        return ask_of(table, keys_of(table, said)) if table.num_rows else _table([], _ASKED)

    def answer(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        keys = [wide(b) for b in table.column("keys").to_pylist()]
        ends = np.cumsum([len(k) for k in keys])
        twice = [np.unpackbits(np.frombuffer(b, np.uint8), count=len(k)).astype(bool)
                 for b, k in zip(table.column("twice").to_pylist(), keys)]
        every, often = np.concatenate(keys), np.concatenate(twice)
        times = 1.0 + often
        if hot:
            times[often] = 2.0 ** np.frombuffer(b"".join(table.column("more").to_pylist()), np.uint8)
        order = np.argsort(every, kind="stable")
        ordered = every[order]
        new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
        group = np.cumsum(new) - 1
        total = np.bincount(group, weights=times[order])
        bits, heat = np.empty(len(every), bool), np.zeros(len(every), bool)
        bits[order] = (total > 1)[group]
        if hot:
            heat[order] = (total >= hot)[group]
        out = [(p, shard, np.packbits(x).tobytes(), np.packbits(y).tobytes() if y.any() else b"")
               for p, x, y in zip(table.column("part").to_pylist(), np.split(bits, ends[:-1]), np.split(heat, ends[:-1]))]
        return _table(out, pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("bits", pa.binary()),
                                      ("hot", pa.binary())]))

    asked = (parts.groupBy("part").applyInArrow(ask, _ASK) if told is None
             else with_answers(parts, told, ask_again, _ASK))
    return asked.groupBy("shard").applyInArrow(answer, _ANSWER)


def answered(answers: pa.Table, keys: np.ndarray, shards: int, of: str = "bits") -> np.ndarray:
    """The answers to a part's sorted distinct keys as one mask."""
    out = np.zeros(len(keys), bool)
    if len(keys):
        at = shard_bounds(keys, shards)
        for s, b in zip(answers.column("shard").to_pylist(), answers.column(of).to_pylist()):
            lo, hi = at[s], at[s + 1]
            if b:
                out[lo:hi] = np.unpackbits(np.frombuffer(b, np.uint8), count=hi - lo).astype(bool)
    return out


def with_answers(parts: DataFrame, answers: DataFrame, fn, schema: str) -> DataFrame:
    """``fn(rows, answers)`` for each part, both as Arrow tables; a part
    without answers gets an empty table."""
    return parts.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(fn, schema)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    cols = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


make_table = _table
