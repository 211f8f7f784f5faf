"""Phrase collocation mining by Toivonen's method (operator 13).

Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and
pieces into words ``[^\\x20\\x09]+``. A phrase is frequent in a language if it
occurs ``min_count`` times or more inside pieces, overlaps included.

1. *Sample.* One pass counts all words, and on a hash share of the documents the
   phrases below the longest length. What reaches the lowered support there is
   proposed, beside the frequent words.
2. *Full pass.* It counts the proposed phrases and their negative border
   exactly. Both are the phrases whose first and last words-but-one are
   proposed, so the border needs no list: a phrase is counted where
   both of these pass the filter of the proposals.
3. *Expansion.* Frequent phrases of the border are failures: the sample missed
   them, and with them longer phrases. Failures join the proposals, and a
   further pass counts what this makes countable and no pass has counted, until
   no border phrase is frequent.
4. *Names.* A last pass counts the frequent phrases by their text.

Tasks know phrases by 61-bit hashes. The proposals reach them as a bitmap of
bounded size (``FILTER_BITS``); a bit set by chance only makes a pass count more
than it must, and the last pass counts by text, so no result rests on a hash
being unique. Each task adds up equal phrases before Spark shuffles them, so a
phrase that a third of all documents hold is an entry per few million words.

Null texts are empty; a null language is ``und``, and the same as a language of that
name. Rows without an id, repeated rows and rows that share an id are
documents of their own. An empty table has no phrases. Further input columns
are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, Window, functions as F

from pricelake.llm import arrowtext as T
from pricelake.llm.scratch import drop, stage

MIN_COUNT = 30
LONGEST = 4
COVER_PERCENT = 80
TOP = 2000
#: The sample is one in so many documents.
SAMPLE = 8
#: Least and most bits of the filter of proposals (16 a phrase within these): at most 16 MB a task.
FILTER_BITS = (1 << 16, 1 << 27)
#: Phrases that a task adds up before it hands them on.
FLUSH = 3_000_000

_U = np.uint64
_SPLIT = T.byte_table(b".,;:!?\n\x0b\x0c\r")
_WORD = ~(_SPLIT | T.byte_table(b" \t"))
UNKNOWN = "und"


class Chunk:
    """The words of some texts: where they stand, in which piece, and their hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lang: np.ndarray):
        self.data = T.LOWER[data]
        self.starts, self.ends, first = T.spans(self.data, offsets, _WORD)
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        n = len(self.starts)
        splits = np.cumsum(_SPLIT[self.data], dtype=np.int64)
        new = np.ones(n, bool)
        new[1:] = (splits[self.starts[1:]] != splits[self.starts[:-1]]) | (self.row[1:] != self.row[:-1])
        self.piece = np.cumsum(new)
        self.sums = T.prefix(T.word_hashes(self.data, self.starts, self.ends))
        self.lang = lang

    def keys(self, at: np.ndarray, k: int) -> np.ndarray:
        """Hashes of the phrases of k words that start at these words; the low three bits are free."""
        return T.mix(T.span_hash(self.sums, at, at + k) ^ self.lang[self.row[at]]) & ~_U(7)

    def inside(self, at: np.ndarray, k: int) -> np.ndarray:
        """Those starts whose k words are in one piece."""
        at = at[at + k <= len(self.starts)]
        return at[self.piece[at] == self.piece[at + k - 1]]

    def phrases(self, at: np.ndarray, k: np.ndarray) -> pa.Array:
        """The phrases as text, joined by one space."""
        word = T.ranges(at, k)
        last = np.cumsum(k) - 1
        begin, size = np.empty(2 * len(word), np.int64), np.ones(2 * len(word), np.int64)
        begin[0::2], size[0::2] = self.starts[word], self.ends[word] - self.starts[word]
        begin[1::2] = len(self.data)
        size[2 * last + 1] = 0
        ends = np.cumsum(size)[2 * last + 1]
        bytes_ = np.append(self.data, np.uint8(32))[T.ranges(begin, size)]
        offsets = np.concatenate(([0], ends)).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(bytes_)).cast(pa.string())


def _chunks(batch):
    data, off = T.flat(batch.column("text"))
    names, cut = T.flat(batch.column("lang"))
    lang = T.span_hash(T.prefix(T.byte_values(names)), cut[:-1], cut[1:])
    for lo, hi in T.chunks(off):
        if off[hi] > off[lo]:
            yield lo, Chunk(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], lang[lo:hi])


class Filter:
    """A bitmap of phrase hashes, by their leading bits."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.shift = bits, _U(64 - int(len(bits) * 64 - 1).bit_length())

    def __contains__(self, key):
        return bool(self.has(np.array([key], _U))[0])

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = keys >> self.shift
        return (self.bits[(at >> _U(6)).astype(np.int64)] >> (at & _U(63))) & _U(1) > 0


def _filter(keys: DataFrame):
    """A broadcast of the Filter of column ``key``; its size is bounded by FILTER_BITS."""
    spark = keys.sparkSession
    n = keys.count()
    size = min(max(FILTER_BITS[0], 1 << int(16 * n).bit_length()), FILTER_BITS[1])
    at = F.shiftrightunsigned("key", 64 - int(size - 1).bit_length())
    words = (keys.select(at.alias("at")).groupBy(F.shiftright("at", 6).cast("int").alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, CAST(at & 63 AS INT))")).alias("bits")).toArrow())
    bits = np.zeros(size // 64, np.int64)
    bits[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return spark.sparkContext.broadcast(bits.view(_U))


def reached(chunk: Chunk, filters: list[Filter], longest: int):
    """For each length from 2 on, (k, starts, keys) of the phrases whose two
    parts of k - 1 words pass the last filter, but not, all the way up, one of the earlier."""
    at = np.arange(len(chunk.starts))
    keys = chunk.keys(at, 1)
    alive = [f.has(keys) for f in filters]
    for k in range(2, longest + 1):
        # of starts 0..n-1 those from where the last filter lets two neighbours pass
        both = [a[:-1] & a[1:] for a in alive]
        at = chunk.inside(np.flatnonzero(both[-1]), k)
        keys = chunk.keys(at, k)
        counted = np.zeros(len(at), bool)
        for b in both[:-1]:
            counted |= b[at]
        yield k, at[~counted], keys[~counted]
        for i, f in enumerate(filters):
            a = np.zeros(len(alive[i]), bool)
            a[at] = both[i][at] & f.has(keys)
            alive[i] = a


_COUNT = "key long, c long"


class _Sums:
    """Adds up equal keys until there are many."""

    def __init__(self):
        self.keys, self.n = [], 0

    def add(self, keys: np.ndarray):
        if len(keys):
            self.keys.append(keys)
            self.n += len(keys)

    def flush(self, least: int):
        if self.n and self.n >= least:
            key, c = np.unique(np.concatenate(self.keys), return_counts=True)
            self.keys, self.n = [], 0
            for lo in range(0, len(key), 1 << 17):
                s = slice(lo, lo + (1 << 17))
                yield pa.RecordBatch.from_arrays([pa.array(key[s].view(np.int64)), pa.array(c[s])], names=["key", "c"])


def _tagged(keys: np.ndarray, k: int, border) -> np.ndarray:
    """The key with its length (less one) and whether it is of the border in the free bits."""
    return keys | _U((k - 1) << 1) | np.asarray(border).astype(_U)


def _added(rows: DataFrame, least: int, where: str = "true") -> DataFrame:
    return rows.groupBy("key").agg(F.sum("c").alias("a")).filter((F.col("a") >= least) & F.expr(where)).select("key")


def first_counts(src: DataFrame, longest: int) -> DataFrame:
    """(key, c) of all words, and of the shorter phrases in the sample."""

    def run(batches):
        sums = _Sums()
        for batch in batches:
            chosen = batch.column("sampled").to_numpy(zero_copy_only=False)
            for lo, chunk in _chunks(batch):
                at = np.arange(len(chunk.starts))
                sums.add(_tagged(chunk.keys(at, 1), 1, False))
                at = at[chosen[lo:][chunk.row]]
                for k in range(2, longest):
                    at = chunk.inside(at, k)
                    sums.add(_tagged(chunk.keys(at, k), k, False))
                yield from sums.flush(FLUSH)
        yield from sums.flush(1)

    return src.mapInArrow(run, _COUNT)


def counts(src: DataFrame, filters: list, longest: int) -> DataFrame:
    """(key, c) of the phrases that the last of the broadcast filters makes countable and no earlier one did."""

    def run(batches):
        sums, tests = _Sums(), [Filter(b.value) for b in filters]
        for batch in batches:
            for _, chunk in _chunks(batch):
                for k, _, keys in reached(chunk, tests, longest):
                    sums.add(_tagged(keys, k, ~tests[-1].has(keys)))
                yield from sums.flush(FLUSH)
        yield from sums.flush(1)

    return src.mapInArrow(run, _COUNT)


def named(src: DataFrame, wanted, longest: int) -> DataFrame:
    """(lang, k, phrase, c): phrases that pass the filter, by text; k = 0 counts all words."""

    def run(batches):
        frequent = Filter(wanted.value)
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for lo, chunk in _chunks(batch):
                at, size, key = [], [], []
                alive = None
                for k in range(1, longest + 1):
                    here = np.arange(len(chunk.starts)) if alive is None else \
                        chunk.inside(np.flatnonzero(alive[:-1] & alive[1:]), k)
                    keys = chunk.keys(here, k)
                    ok = frequent.has(keys)
                    here, keys = here[ok], keys[ok]
                    alive = np.zeros(len(chunk.starts), bool)
                    alive[here] = True
                    at.append(here)
                    size.append(np.full(len(here), k))
                    key.append(_tagged(keys, k, False))
                at, size, key = (np.concatenate(x) for x in (at, size, key))
                _, pick, c = np.unique(key, return_index=True, return_counts=True)
                n = np.bincount(chunk.row)
                rows = np.flatnonzero(n)
                of = np.concatenate((chunk.row[at[pick]], rows))
                phrase = pa.concat_arrays([chunk.phrases(at[pick], size[pick]), pa.array([""] * len(rows), pa.string())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([langs[lo + r] for r in of.tolist()], pa.string()),
                     pa.array(np.concatenate((size[pick], np.zeros(len(rows), np.int64))).astype(np.int32)), phrase,
                     pa.array(np.concatenate((c, n[rows])))], names=["lang", "k", "phrase", "c"])

    return src.mapInArrow(run, "lang string, k int, phrase string, c long")


def frequent_phrases(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                     min_count: int = MIN_COUNT, longest: int = LONGEST, sample: int = SAMPLE) -> DataFrame:
    """(lang, k, phrase, a): every phrase of up to ``longest`` words with a >=
    min_count occurrences; k = 0 holds the language's number of words."""
    if not 2 <= longest <= 4:
        raise ValueError("longest is 2, 3 or 4")
    text = F.col(text_col)
    src = docs.filter(text.isNotNull()).select(
        F.coalesce(F.col(lang_col), F.lit(UNKNOWN)).alias("lang"), text.alias("text"),
        (F.pmod(F.xxhash64(F.col(id_col), text), F.lit(sample)) == 0).alias("sampled"))
    # the support expected in the sample, less a deviation, so that it misses few
    expected = min_count / sample
    lowered = max(1, math.ceil(expected - math.sqrt(expected)))
    first = (first_counts(src, longest).groupBy("key").agg(F.sum("c").alias("a"))
             .filter(F.expr(f"CASE WHEN key & 7 = 0 THEN a >= {int(min_count)} ELSE a >= {int(lowered)} END")))
    proposed = stage(first.select("key"), "proposals")
    known = proposed.filter("key & 7 = 0")  # words: counted exactly
    filters = [_filter(proposed)]
    found, failed = [known], proposed
    while True:
        counted = stage(_added(counts(src, filters, longest), min_count), "counted")
        found.append(counted)
        failures = counted.filter(f"key & 1 = 1 AND (key & 7) div 2 < {longest - 1}")
        if failures.isEmpty():
            break
        failed = failed.union(failures)
        filters.append(_filter(failed))
    every = found[0]
    for f in found[1:]:
        every = every.union(f)
    out = (named(src, _filter(every), longest).groupBy("lang", "k", "phrase").agg(F.sum("c").alias("a"))
           .filter((F.col("a") >= min_count) | (F.col("k") == 0)))
    out = stage(out, "phrases")
    for t in (proposed, *found[1:]):
        drop(t)
    return out


def collocations(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                 min_count: int = MIN_COUNT, longest: int = LONGEST, cover_percent: int = COVER_PERCENT, top: int = TOP,
                 sample: int = SAMPLE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of two words or more.

    Cutting a phrase after its first words gives l and r, the frequencies of
    the two parts, and floor(2,000,000 a / (l + r)); the lowest such score
    counts. A phrase within a longer frequent one that has ``cover_percent``
    of its occurrences is left out."""
    every = frequent_phrases(docs, id_col, text_col, lang_col, min_count, longest, sample)
    phrases = every.filter("k >= 2")
    parts = every.filter("k >= 1").select("lang", "phrase", "a")
    words = F.split("phrase", " ")
    # all parts of a frequent phrase are frequent, so each cut finds both
    cuts = (phrases.select("lang", "phrase", "a", words.alias("w"), F.explode(F.expr("sequence(1, k - 1)")).alias("cut"))
            .select("lang", "phrase", "a", "cut", F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("left_part"),
                    F.array_join(F.expr("slice(w, cut + 1, size(w))"), " ").alias("right_part")))
    scored = (cuts.join(parts.select("lang", F.col("phrase").alias("left_part"), F.col("a").alias("l")), ["lang", "left_part"])
              .join(parts.select("lang", F.col("phrase").alias("right_part"), F.col("a").alias("r")), ["lang", "right_part"])
              .withColumn("score", F.expr("CAST(a AS DECIMAL(20, 0)) * 2000000BD div (CAST(l AS DECIMAL(20, 0)) + r)")))
    best = (scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
            .select("lang", "phrase", "a", "best.l", "best.r", "best.score"))
    inner = (phrases.filter("k > 2").select("lang", F.col("a").alias("longer"), words.alias("w"), "k")
             .withColumn("size", F.explode(F.expr("sequence(2, k - 1)")))
             .withColumn("at", F.explode(F.expr("sequence(1, k - size + 1)")))
             .select("lang", "longer", F.expr("array_join(slice(w, at, size), ' ')").alias("phrase"))
             .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    kept = (best.join(inner, ["lang", "phrase"], "left")
            .filter(F.expr(f"longer IS NULL OR CAST(longer AS DECIMAL(20, 0)) * 100 < CAST(a AS DECIMAL(20, 0)) * {int(cover_percent)}")))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    total = every.filter("k = 0").select("lang", F.col("a").alias("n"))
    return (ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
