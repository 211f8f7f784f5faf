"""Substring dedup by repeated-phrase automata (operator 7).

A word window that stands in more than one place is removed wherever it
stands. Steps, all exact up to 40-bit word codes:

1. *Candidates.* Each window owns the smallest hash among its inner word
   12-grams. Equal windows own equal grams, so only windows whose gram is
   seen elsewhere (``exchange.seen_elsewhere``) can recur. Windows of one gram
   occurrence stand side by side and travel together, as a *run* of words.
2. *Confirm and compile.* The shard that owns a gram's hash range counts the
   windows of its runs, takes the maximal stretches of windows that occur at
   least twice as passages, and compiles them into an Aho-Corasick automaton
   over word codes (one symbol a word).
3. *Stream.* All runs of the shard go through its automaton, which locates
   every occurrence of every passage; each part gets one bit per window back.
4. Every part drops the covered words of its documents, whole texts included.

A document without a run is ruled out by step 1, not by a cap.

*Hot grams.* A line shorter than a window may stand in a third of all
documents, each time between other words: one run per document, all of one
gram. So step 1 also tells which grams occur ``hot`` times or more. For windows
of those, the parts ask once more with the hash of the whole window; windows
that don't recur go no further, and the others travel as runs of one window to
the shard of their own hash. Equal windows meet in the part before they are
sent, so a window that a third of all documents share is one entry per part,
and no shard gathers more of one gram than ``hot`` runs. Equal windows own equal grams,
so all copies take the same way, and the rows don't depend on ``hot``.

Nulls and texts without words keep nothing and remove nothing (0 words, the
hash of an empty text). Repeated rows are documents of their own, so their
passages recur. Further input columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import chain, compress

import ahocorasick
import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, functions as F

from pricelake.llm import arrowtext as T, exchange as X

WINDOW = 35
#: Words of the inner grams; a window of 35 words has 24 of them.
GRAM = 12
#: Runs an automaton's shard holds on average if every window were a candidate.
SHARD_RUNS = 16_000
#: Occurrences from which a gram is hot. Its windows then go by their own hashes,
#: each to its own shard, and only those that recur.
HOT = 4_000

_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
_RUNS = pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("lens", pa.binary()), ("twice", pa.binary()),
                   ("codes", pa.binary())])


class _Runs:
    """The windows of a part, grouped by the gram occurrence they own."""

    def __init__(self, table: pa.Table, window: int, gram: int):
        self.data, self.off = T.flat(table.column("text"))
        self.words, self.first, self.starts, self.ends = T.words_of(self.data, self.off)
        self.prefix = T.prefix(self.words)
        n, self.window = len(self.words), window
        at = np.arange(max(0, n - gram + 1))
        grams = T.span_hash(self.prefix, at, at + gram)
        owner = T.sliding_argmin(grams, window - gram + 1)
        self.win = T.window_starts(self.first, window)
        own = owner[self.win]
        new = np.ones(len(own), bool)
        new[1:] = own[1:] != own[:-1]
        self.run_at = np.flatnonzero(new)
        self.keys = T.mix(grams[own[self.run_at]])  # minima crowd near 0; mixed they fill all shards alike
        self.lens = np.diff(np.append(self.run_at, len(own)))

    def hot_windows(self, answers: pa.Table, shards: int):
        """Which runs have a gram seen elsewhere, which of them a hot one, and
        the hot runs' windows: their places and their own keys."""
        distinct, where = np.unique(self.keys, return_inverse=True)
        seen = X.answered(answers, distinct, shards)[where]
        hot = seen & X.answered(answers, distinct, shards, "hot")[where]
        at = self.win[T.ranges(self.run_at[hot], self.lens[hot])]
        return seen & ~hot, at, T.mix(T.span_hash(self.prefix, at, at + self.window))

    def candidates(self, answers: pa.Table, again: pa.Table, shards: int):
        """Runs whose gram is seen elsewhere, windows of hot grams that are
        themselves seen elsewhere as runs of one, and their distinct contents
        in an order that depends on the part's rows as a set only."""
        cold, at, keys = self.hot_windows(answers, shards)
        distinct, where = np.unique(keys, return_inverse=True)
        recurs = X.answered(again, distinct, shards)[where]
        a = np.concatenate((self.win[self.run_at[cold]], at[recurs]))
        lens = np.concatenate((self.lens[cold], np.ones(int(recurs.sum()), np.int64)))
        keys = np.concatenate((self.keys[cold], keys[recurs]))
        z = a + lens + self.window - 1
        content = T.span_hash(self.prefix, a, z)
        _, pick, back, count = np.unique(content, return_index=True, return_inverse=True, return_counts=True)
        order = np.lexsort((content[pick], keys[pick]))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        pick = pick[order]
        return lens, a, z, pick, count[order], rank[back], keys[pick]


def locate(codes: np.ndarray, sizes: np.ndarray, twice: np.ndarray, window: int) -> np.ndarray:
    """For the runs of a shard (``sizes`` words each, concatenated in
    ``codes``): a mask of the words at which a recurring window starts.

    Confirms the windows that occur at least twice, compiles their maximal
    stretches into one automaton and streams every run through it.
    """
    n = len(codes)
    at = np.concatenate(([0], np.cumsum(sizes)))
    win = T.window_starts(at, window)
    hashes = T.span_hash(T.prefix(codes), win, win + window)
    _, group = np.unique(hashes, return_inverse=True)
    weight = 1 + twice[T.rows_of(win, at)]
    confirmed = np.bincount(group, weights=weight)[group] > 1
    hit = np.zeros(n + 1, np.int32)
    good = win[confirmed]
    if not len(good):
        return hit[:n] > 0
    # one symbol a word; a separator between runs, so no passage crosses them
    _, symbol = np.unique(codes, return_inverse=True)
    wide = 1 + int(symbol.max()) // 0x80000
    shift = np.repeat(np.arange(len(sizes)), sizes)
    text = np.full((n + len(sizes), wide), 1, np.uint32)
    place = np.arange(n) + shift
    text[place, 0] = 0x10000 + symbol % 0x80000
    if wide > 1:
        text[place, 1:] = (0x10000 + symbol // 0x80000)[:, None]
    text = text.tobytes().decode("utf-32-le")
    # maximal stretches of confirmed windows
    run = T.rows_of(good, at)
    new = np.ones(len(good), bool)
    new[1:] = (good[1:] != good[:-1] + 1) | (run[1:] != run[:-1])
    begin = good[new]
    last = good[np.append(np.flatnonzero(new)[1:] - 1, len(good) - 1)]
    lo = (begin + run[new]) * wide
    hi = (last + window + run[new]) * wide
    automaton = ahocorasick.Automaton()
    for a, z in zip(lo.tolist(), hi.tolist()):
        automaton.add_word(text[a:z], z - a)
    automaton.make_automaton()
    found = np.fromiter(chain.from_iterable(automaton.iter(text)), np.int64).reshape(-1, 2)
    found = found[(found[:, 0] + 1) % wide == 0] if wide > 1 else found
    back = np.empty(n + len(sizes), np.int64)
    back[place] = np.arange(n)
    end = back[(found[:, 0] + 1) // wide - 1] + 1
    start = end - found[:, 1] // wide
    np.add.at(hit, start, 1)
    np.add.at(hit, end - window + 1, -1)
    return np.cumsum(hit[:n]) > 0


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   gram: int = GRAM, part_bytes: int = X.PART_BYTES, with_text: bool = False, carry: tuple = (),
                   hot: int = HOT) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept, *carry): every document
    without the words of its recurring windows. ``kept`` (only if
    ``with_text``) is the text itself where nothing was removed, else the kept
    words joined by one space; ``carry`` names columns of ``docs`` to take along."""
    total = X.text_bytes(docs, text_col)
    parts = X.deal(docs, id_col, text_col, total, part_bytes, carry)
    density = 2 / (window - gram + 2) / 6  # grams owned a byte, at six bytes a word
    shards = X.shard_count(total * density)
    run_shards = X.shard_count(total * density, SHARD_RUNS)

    answers = X.seen_elsewhere(parts, lambda t: _Runs(t, window, gram).keys, shards, hot)
    again = X.seen_elsewhere(parts, lambda t, said: _Runs(t, window, gram).hot_windows(said, shards)[2], shards, told=answers)

    def kinds(said: pa.Table):
        kind = said.column("kind").to_numpy()
        return [said.filter(pa.array(kind == k)) for k in range(3)]

    asked = [x.select("part", F.lit(k).alias("kind"), "shard", "bits", "hot") for k, x in enumerate((answers, again))]
    asked = asked[0].union(asked[1])

    def send(table: pa.Table, said: pa.Table) -> pa.Table:
        if not table.num_rows:
            return X.make_table([], _RUNS)
        r = _Runs(table, window, gram)
        lens, a, z, pick, count, _, keys = r.candidates(*kinds(said)[:2], shards)
        at, part, out = X.shard_bounds(keys, run_shards), table.column("part")[0].as_py(), []
        for s in np.flatnonzero(np.diff(at)):
            p = pick[at[s]:at[s + 1]]
            words = r.words[T.ranges(a[p], z[p] - a[p])]
            out.append((int(s), part, lens[p].astype(np.uint16).tobytes(),
                        np.packbits(count[at[s]:at[s + 1]] > 1).tobytes(), X.narrow(words)))
        return X.make_table(out, _RUNS)

    def automaton(table: pa.Table) -> pa.Table:
        lens = [np.frombuffer(b, np.uint16).astype(np.int64) for b in table.column("lens").to_pylist()]
        twice = [np.unpackbits(np.frombuffer(b, np.uint8), count=len(k)).astype(np.int64)
                 for b, k in zip(table.column("twice").to_pylist(), lens)]
        codes = X.wide(b"".join(table.column("codes").to_pylist()))
        every = np.concatenate(lens)
        hit = locate(codes, every + window - 1, np.concatenate(twice), window)
        starts = np.concatenate(([0], np.cumsum(every + window - 1)))[:-1]
        bits = hit[T.ranges(starts, every)]
        cuts = np.cumsum([int(k.sum()) for k in lens])[:-1]
        shard = table.column("shard")[0].as_py()
        out = [(p, shard, np.packbits(b).tobytes())
               for p, b in zip(table.column("part").to_pylist(), np.split(bits, cuts))]
        return X.make_table(out, pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("bits", pa.binary())]))

    runs = X.with_answers(parts, asked, send,
                          "shard int, part int, lens binary, twice binary, codes binary")
    located = runs.groupBy("shard").applyInArrow(automaton, "part int, shard int, bits binary")
    both = asked.union(located.select("part", F.lit(2).alias("kind"), "shard", "bits", F.lit(b"").alias("hot")))

    def finish(table: pa.Table, said: pa.Table) -> pa.Table:
        ids, sums, removed, words, texts = pa.array([], pa.int64()), [], [], [], []
        if table.num_rows:
            r = _Runs(table, window, gram)
            first, second, mine = kinds(said)
            lens, a, _, pick, _, back, keys = r.candidates(first, second, shards)
            sizes = lens[pick]
            flags = np.zeros(int(sizes.sum()), bool)
            ends = np.concatenate(([0], np.cumsum(sizes)))
            at = X.shard_bounds(keys, run_shards)
            for s, b in zip(mine.column("shard").to_pylist(), mine.column("bits").to_pylist()):
                lo, hi = ends[at[s]], ends[at[s + 1]]
                flags[lo:hi] = np.unpackbits(np.frombuffer(b, np.uint8), count=hi - lo).astype(bool)
            starts = T.ranges(a, lens)[flags[T.ranges(ends[back], lens)]]
            gone = T.cover(starts, window, len(r.words))
            lost = np.concatenate(([0], np.cumsum(gone)))
            blob = r.data.tobytes()
            ids = table.column("doc_id")
            words = np.diff(r.first)
            removed = lost[r.first[1:]] - lost[r.first[:-1]]
            for i in range(table.num_rows):
                whole = blob[r.off[i]:r.off[i + 1]]
                kept = whole.split()
                if removed[i]:
                    kept = compress(kept, ~gone[r.first[i]:r.first[i + 1]])
                text = b" ".join(kept)
                sums.append(hashlib.sha256(text).hexdigest())
                if with_text:
                    texts.append(text if removed[i] else whole)
        n = len(sums)
        columns = {"doc_id": ids, "n_words": pa.array(words, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                   "kept_sha256": pa.array(sums, pa.string()),
                   "kept": pa.array(texts, pa.binary()).cast(pa.string()) if with_text else pa.nulls(n, pa.string())}
        for i in range(len(carry)):
            columns[f"_{i}"] = table.column(f"_{i}")
        return pa.table(columns)

    extra = "".join(f", _{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(carry))
    out = X.with_answers(parts, both, finish, _RESULT + extra)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256", *(["kept"] if with_text else []),
                     *[F.col(f"_{i}").alias(c) for i, c in enumerate(carry)])
