"""Benchmark decontamination with one Aho-Corasick automaton (operator 3).

The benchmark's normalised windows (10 consecutive words; a shorter item is
one window) are compiled into an automaton, and every document's normalised
text streams through it once. Matches are word-aligned, mapped back to word
numbers and to character offsets of the original text.

The automaton holds at most ``AUTOMATON_BYTES`` of windows; that bounds what
the driver ships. A larger benchmark is split by a hash of the window into as
many automata as needed, the documents are scanned once for each, and
the hits are merged per document, so nothing is left out.

Null or wordless texts have no words and no hit. Null or wordless items have
no window. Items that share an item_id are one item; windows of items without
an id mark words but name no item. Further input columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, functions as F

from pricelake.llm import arrowtext as T

WINDOW = 10
#: Text of the windows that one automaton may hold.
AUTOMATON_BYTES = 8 << 20

#: Word bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z are lower case:
#: digits, a-z and every byte of a character beyond ASCII.
_WORD = T.byte_table(b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256)))
_NORMAL = np.where(_WORD[T.LOWER], T.LOWER, 32).astype(np.uint8).tobytes()
#: The same words in the original text, for offsets.
_ORIGINAL = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

_HITS = ("doc_id long, n_words long, n_hit long, word_spans array<struct<first:int,last:int>>, "
         "char_spans array<struct<start:int,end:int>>, items array<string>")
_SPAN_W = pa.struct([("first", pa.int32()), ("last", pa.int32())])
_SPAN_C = pa.struct([("start", pa.int32()), ("end", pa.int32())])


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


def benchmark_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                      window: int = WINDOW) -> DataFrame:
    """Distinct (phrase, item) of all items; a phrase is a window's words joined by one space."""

    def windows(batches):
        for batch in batches:
            phrase, item = [], []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                w = normal_words(t or b"")
                for k in range(max(1, len(w) - window + 1) if w else 0):
                    phrase.append(b" ".join(w[k:k + window]).decode("utf-8"))
                    item.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(phrase, pa.string()), pa.array(item, pa.string())],
                                             names=["phrase", "item"])

    src = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("binary").alias("text"))
    return src.mapInArrow(windows, "phrase string, item string").distinct()


def _scan(phrases: list[tuple[str, str | None]]):
    """A task function that streams documents through the automaton of ``phrases``."""

    def scan(batches):
        named: dict[str, set] = {}
        for phrase, item in phrases:
            named.setdefault(phrase, set()).add(item)
        automaton = ahocorasick.Automaton()
        for phrase, own in named.items():
            automaton.add_word(f" {phrase} ", (phrase.count(" ") + 1, len(phrase) + 2, frozenset(own)))
        if named:
            automaton.make_automaton()
        for batch in batches:
            data, off = T.flat(batch.column("text"))
            n_words, n_hit, words, chars, items = [], [], [], [], []
            for lo, hi in zip(off[:-1].tolist(), off[1:].tolist()):
                raw = data[lo:hi].tobytes()
                w = normal_words(raw)
                n_words.append(len(w))
                found, spans = set(), []
                if w and named:
                    text = f" {b' '.join(w).decode('utf-8', 'replace')} "
                    spans = [(end - size + 1, k, own) for end, (k, size, own) in automaton.iter(text)]
                if not spans:
                    n_hit.append(0)
                    words.append([])
                    chars.append([])
                    items.append([])
                    continue
                gaps = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), np.uint32) == 32)
                mask = np.zeros(len(w), bool)
                for (_, k, own), first in zip(spans, np.searchsorted(gaps, [s for s, _, _ in spans]).tolist()):
                    mask[first:first + k] = True
                    found |= own
                edge = np.flatnonzero(np.diff(np.concatenate(([0], mask, [0])))).tolist()
                places = [m.span() for m in _ORIGINAL.finditer(raw.decode("utf-8", "replace"))]
                n_hit.append(int(mask.sum()))
                words.append([{"first": a, "last": z - 1} for a, z in zip(edge[::2], edge[1::2])])
                chars.append([{"start": places[a][0], "end": places[z - 1][1]} for a, z in zip(edge[::2], edge[1::2])])
                items.append(sorted(x for x in found if x is not None))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                 pa.array(words, pa.list_(_SPAN_W)), pa.array(chars, pa.list_(_SPAN_C)),
                 pa.array(items, pa.list_(pa.string()))],
                names=["doc_id", "n_words", "n_hit", "word_spans", "char_spans", "items"])

    return scan


def _merge(batches):
    """Hits of the same document from several automata as one."""
    for batch in batches:
        out = []
        for doc, n, words, chars, items in zip(*(batch.column(c).to_pylist() for c in
                                                 ("doc_id", "n_words", "word_spans", "char_spans", "items"))):
            mask = np.zeros(n, bool)
            starts, ends = {}, {}
            for w, c in zip([x for y in words for x in y], [x for y in chars for x in y]):
                mask[w["first"]:w["last"] + 1] = True
                starts[w["first"]], ends[w["last"]] = c["start"], c["end"]
            edge = np.flatnonzero(np.diff(np.concatenate(([0], mask, [0])))).tolist()
            spans = list(zip(edge[::2], edge[1::2]))
            out.append((doc, n, int(mask.sum()), [{"first": a, "last": z - 1} for a, z in spans],
                        [{"start": starts[a], "end": ends[z - 1]} for a, z in spans],
                        sorted({x for y in items for x in y})))
        cols = list(zip(*out)) or [()] * 6
        types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(_SPAN_W), pa.list_(_SPAN_C), pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)],
                                         names=["doc_id", "n_words", "n_hit", "word_spans", "char_spans", "items"])


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  window: int = WINDOW, automaton_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, word_spans, char_spans, items) of every
    document; ``char_spans`` are half-open offsets in the original text."""
    windows = benchmark_windows(items, window=window)
    size = windows.agg(F.sum(F.octet_length("phrase"))).first()[0] or 0
    shards = max(1, -(-size // automaton_bytes))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    if shards == 1:
        phrases = [tuple(r) for r in windows.collect()]  # bounded by automaton_bytes
        return src.mapInArrow(_scan(phrases), _HITS)
    # a row is known by its id and text; rows that share both have the same hits
    found = None
    for s in range(shards):
        phrases = [tuple(r) for r in windows.filter(F.pmod(F.xxhash64("phrase"), F.lit(shards)) == s).collect()]
        one = _with_mark(src, _scan(phrases)).filter("n_hit > 0")
        found = one if found is None else found.union(one)
    merged = (found.distinct().groupBy("doc_id", "mark")
              .agg(F.first("n_words").alias("n_words"), F.collect_list("word_spans").alias("word_spans"),
                   F.collect_list("char_spans").alias("char_spans"), F.collect_list("items").alias("items")))
    hits = _with_mark(merged, _merge).drop("n_words")
    every = _with_mark(src, _scan([])).select("doc_id", "mark", "n_words")
    out = every.join(hits.withColumnRenamed("doc_id", "d").withColumnRenamed("mark", "m"),
                     F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m")), "left")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                      F.coalesce("word_spans", F.array().cast("array<struct<first:int,last:int>>")).alias("word_spans"),
                      F.coalesce("char_spans", F.array().cast("array<struct<start:int,end:int>>")).alias("char_spans"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
          automaton_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """The rows of ``docs`` without any hit, unchanged."""
    windows = benchmark_windows(items, window=window)
    size = windows.agg(F.sum(F.octet_length("phrase"))).first()[0] or 0
    shards = max(1, -(-size // automaton_bytes))

    def keep(scan):
        def run(batches):
            at_hand = []

            def slim():
                for batch in batches:
                    at_hand.append(batch)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(batch.schema.get_field_index(id_col)).cast(pa.int64()),
                         batch.column(batch.schema.get_field_index(text_col))], names=["doc_id", "text"])

            for hits in scan(slim()):  # one automaton for all batches of the task
                yield at_hand.pop().filter(pa.array(hits.column("n_hit").to_numpy() == 0))
        return run

    for s in range(shards):  # each automaton drops what it hits
        phrases = [tuple(r) for r in windows.filter(F.pmod(F.xxhash64("phrase"), F.lit(shards)) == s).collect()]
        docs = docs.mapInArrow(keep(_scan(phrases)), docs.schema)
    return docs


def _with_mark(df: DataFrame, fn) -> DataFrame:
    """``fn`` over ``df`` with a row mark (hash of the text) carried along."""

    def run(batches):
        marks = []

        def rest():
            for batch in batches:
                marks.append(batch.column("mark"))
                yield batch.drop_columns(["mark"])

        for out in fn(rest()):
            yield pa.RecordBatch.from_arrays([*out.columns, marks.pop()], names=[*out.schema.names, "mark"])

    if "mark" not in df.columns:
        df = df.withColumn("mark", F.coalesce(F.xxhash64("text"), F.lit(0)))
    return df.mapInArrow(run, _HITS + ", mark long")


def report(hits: DataFrame) -> DataFrame:
    """The digest columns of ``contamination``'s rows."""
    return hits.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                       (F.col("n_hit") > 0).alias("contaminated"))
