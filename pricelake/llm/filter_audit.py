"""Filter interaction audit (operator 11).

Five filters judge every whole text:

* A: fewer than 200 words
* B: fewer than half of its words are distinct
* C: more than 3 % of its code points are capitals A-Z
* D: it holds a symbol of ``#$%&*|``
* E: a smaller doc_id has the same text

The counts of A to D come from one run of a table-driven byte transducer
over the UTF-8 bytes. Its states are *gap* and *word*; every byte leads from
either state to the same next one, so the state before a byte is read off the
byte before it and the whole run over a buffer is two table look-ups. What it
puts out for a (state, byte) pair says whether a word begins, a word has
ended, a code point begins, the byte is a capital, the byte is a symbol. The word
spans it emits go into an open-addressing hash table, in which equal hashes
are verified by row, length and bytes.

What Spark moves is a row of four bits and a digest (SHA-256) per document,
never its text. The first doc_id of each text is an aggregate, and is met again
on (doc_id, digest), so copies of one text are spread over tasks. The report
is made of at most 32 counts a part: which filters fail.

Null texts are empty texts; a null language is the part ''. Rows without
a doc_id count, never fail E, make no other row fail it, and have no label. Rows
that share a doc_id are documents of their own; rows equal in id and text are all
first. A document is good (toxic) if any of its label rows says so. An empty
table has no parts and gives no rows. Further input columns are ignored.
"""

from __future__ import annotations

import itertools
import json

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, functions as F

from pricelake.llm import arrowtext as T
from pricelake.llm.scratch import stage

FILTERS = "ABCDE"
MIN_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 3
SYMBOLS = b"#$%&*|"

GAP, WORD = 0, 1
#: What the transducer puts out, as bits.
BEGIN, ENDED, POINT, CAPITAL, SYMBOL = 1, 2, 4, 8, 16
ACTIONS = 32


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(state after a byte, output for state * 256 + byte)."""
    byte = np.arange(256)
    after = np.where(T.WORD_BYTES, WORD, GAP).astype(np.uint8)
    fixed = (np.where((byte & 0xC0) != 0x80, POINT, 0) | np.where((byte >= 65) & (byte <= 90), CAPITAL, 0)
             | np.where(T.byte_table(SYMBOLS), SYMBOL, 0))
    out = np.stack([fixed | np.where(after == WORD, BEGIN, 0), fixed | np.where(after == GAP, ENDED, 0)])
    return after, out.astype(np.uint8).ravel()


AFTER, OUTPUT = _tables()


def transduce(data: np.ndarray, offsets: np.ndarray):
    """(counts, starts, ends, row) of the rows ``data[offsets[r]:offsets[r + 1]]``:
    how often each of the 32 outputs was put out per row, and the word spans."""
    rows = len(offsets) - 1
    if not len(data):
        z = np.zeros(0, np.int64)
        return np.zeros((rows, ACTIONS), np.int64), z, z, z
    after = AFTER[data]
    before = np.empty(len(data), np.uint8)
    before[1:] = after[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[first] = GAP
    out = OUTPUT[before.astype(np.uint16) * 256 + data]
    row = np.repeat(np.arange(rows), np.diff(offsets))
    counts = np.bincount(row * ACTIONS + out, minlength=rows * ACTIONS).reshape(rows, ACTIONS)
    starts = np.flatnonzero(out & BEGIN)
    # a row that ends inside a word ends that word
    last = offsets[1:][offsets[:-1] < offsets[1:]]
    ends = np.union1d(np.flatnonzero(out & ENDED), last[after[last - 1] == WORD])
    return counts, starts, ends, row[starts]


def _of(counts: np.ndarray, bit: int) -> np.ndarray:
    return counts[:, (np.arange(ACTIONS) & bit) > 0].sum(axis=1)


class SpanTable:
    """An open-addressing hash table of word spans, filled for all spans at
    once: each round writes the spans that found a free slot and compares the
    others with what stands in theirs; only unequal ones go on to the next slot."""

    LONG = 64

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray):
        self.padded = np.concatenate((data, np.zeros(8, np.uint8)))
        self.eights = np.ndarray((len(data) + 1,), "<u8", self.padded, strides=(1,))
        self.starts, self.size, self.row = starts, ends - starts, row
        self.hash = T.word_hashes(data, starts, ends) ^ T.mix(row.astype(np.uint64) + np.uint64(1))
        n = len(starts)
        self.slots = np.full(max(4, 1 << int(2 * n).bit_length()), -1, np.int64)
        mask = np.uint64(len(self.slots) - 1)
        place, left = (self.hash & mask).astype(np.int64), np.arange(n)
        while len(left):
            at = place[left]
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]
            there = self.slots[at]
            other = there != left
            other[other] = ~self.equal(left[other], there[other])
            left = left[other]
            place[left] = (place[left] + 1) & int(mask)

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether spans a[i] and b[i] are of one row and hold the same bytes."""
        same = (self.hash[a] == self.hash[b]) & (self.row[a] == self.row[b]) & (self.size[a] == self.size[b])
        left, done = np.flatnonzero(same), 0
        while len(left) and done < self.LONG:
            x, y = a[left], b[left]
            rest = np.minimum(self.size[x] - done, 8)
            # bytes behind the span are masked off
            keep = np.uint64(0xFFFFFFFFFFFFFFFF) >> ((8 - rest) * 8).astype(np.uint64)
            ok = ((self.eights[self.starts[x] + done] ^ self.eights[self.starts[y] + done]) & keep) == 0
            same[left[~ok]] = False
            done += 8
            left = left[ok & (self.size[x] > done)]
        for i in left.tolist():
            s, t, n = self.starts[a[i]], self.starts[b[i]], self.size[a[i]]
            same[i] = self.padded[s:s + n].tobytes() == self.padded[t:t + n].tobytes()
        return same

    def per_row(self, rows: int) -> np.ndarray:
        """Number of different spans of each row."""
        return np.bincount(self.row[self.slots[self.slots >= 0]], minlength=rows)


def failures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of the filters A to D that each row fails."""
    counts, starts, ends, row = transduce(data, offsets)
    n = _of(counts, BEGIN)
    distinct = SpanTable(data, starts, ends, row).per_row(len(n))
    tests = [n < MIN_WORDS, 100 * distinct < DISTINCT_PERCENT * n,
             100 * _of(counts, CAPITAL) > CAPITAL_PERCENT * _of(counts, POINT), _of(counts, SYMBOL) > 0]
    return sum(t.astype(np.int32) << i for i, t in enumerate(tests))


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, part, digest, fails): the filters A to D that a document fails, as bits, and its text's digest."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(lang_col), F.lit("")).alias("part"),
                      F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"))

    def run(batches):
        for batch in batches:
            data, off = T.flat(batch.column("text"))
            bits = [failures(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]) for lo, hi in T.chunks(off)]
            bits = np.concatenate(bits or [np.zeros(0, np.int32)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("doc_id", "part", "digest")], pa.array(bits)],
                                             names=["doc_id", "part", "digest", "fails"])

    return src.mapInArrow(run, "doc_id long, part string, digest binary, fails int")


def tallies(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, n, good, toxic): documents by the set of filters that they fail, E included."""
    of_label = (labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
                .agg(F.max(F.expr("CASE WHEN quality = 1 THEN 1L ELSE 0L END")).alias("good"),
                     F.max(F.expr("CASE WHEN toxic = 1 THEN 1L ELSE 0L END")).alias("toxic")))
    firsts = (rows.filter("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
              .withColumn("first", F.lit(True)))
    named = (rows.filter("doc_id IS NOT NULL").join(firsts, ["doc_id", "digest"], "left").join(of_label, "doc_id", "left")
             .select("part", (F.col("fails") + F.when(F.col("first").isNull(), 16).otherwise(0)).alias("fails"),
                     F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")))
    nameless = rows.filter("doc_id IS NULL").select("part", "fails", F.lit(0).cast("long").alias("good"),
                                                    F.lit(0).cast("long").alias("toxic"))
    return (named.unionByName(nameless).groupBy("part", "fails")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")))


def _steps() -> str:
    """All orders of the filters, step by step, as JSON: order, step, the filter's bit, the bits before it."""
    out = []
    for order in itertools.permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            out.append({"o": "".join(order), "s": step, "f": bit, "b": before})
            before |= bit
    return json.dumps(out)


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step: how many documents the
    step keeps and removes, how many of its failures were gone already, how many fail
    it alone, the good and toxic documents it removes, and its filter's removals
    summed over all orders (Shapley value times the number of orders)."""
    rows = stage(judged(docs, id_col, text_col, lang_col), "judged")
    parts = (tallies(rows, labels).groupBy("part")
             .agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("t")))  # at most 32 a part
    steps = F.from_json(F.lit(_steps()), "array<struct<o string, s int, f int, b int>>")
    each = parts.select("part", "t", F.explode(steps).alias("x")).select("part", "t", "x.*")

    def total(condition: str, value: str = "t.n"):
        return f"aggregate(filter(t, t -> {condition}), 0L, (s, t) -> s + {value})"

    here = "t.fails & f > 0 AND t.fails & b = 0"
    # of the orders of all filters, a document's k failing ones are led by each of them equally often
    share = f"t.n * ({len(list(itertools.permutations(FILTERS)))} div bit_count(t.fails))"
    return each.select("part", F.col("o").alias("filter_order"), F.col("s").alias("step"),
                       F.expr(total("t.fails & (b | f) = 0")).alias("kept"), F.expr(total(here)).alias("removed"),
                       F.expr(total("t.fails & f > 0 AND t.fails & b > 0")).alias("redundant"),
                       F.expr(total("t.fails = f")).alias("unique_fails"),
                       F.expr(total(here, "t.good")).alias("good_lost"), F.expr(total(here, "t.toxic")).alias("toxic_lost"),
                       F.expr(total("t.fails & f > 0", share)).alias("shapley"))
