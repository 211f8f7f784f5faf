"""Suffix order of a buffer, one bucket at a time, with a difference cover.

Suffixes are compared to a bounded depth. A difference cover of period 21
holds, for any two residues, a distance after which both land on sample
positions. The samples (5 of 21 positions) are ranked once by their next 48
bytes. Then one bucket of suffixes after the other is sorted by its first 24
bytes, and what still ties is ordered by comparing sample ranks at the pair's
distance: 24 tied bytes reach past the distance, so rank and prefix together
cover 50 bytes and more. Only the samples' ranks and one bucket are in
memory besides the text.
"""

from __future__ import annotations

import numpy as np

PERIOD = 21
#: A perfect difference set mod 21: every residue is a difference of two members.
COVER = (0, 1, 4, 14, 16)
#: Bytes sorted directly, and bytes behind a sample's rank.
PREFIX, DEPTH = 24, 48
#: Longest width the order decides: least distance + DEPTH.
MAX_WIDTH = 50
BUCKET = 1 << 18


def _distances() -> np.ndarray:
    """Least d >= 2 such that i + d and j + d are both sample positions, by
    the residues of i and j; at most 22, so inside the sorted prefix."""
    d = np.zeros((PERIOD, PERIOD), np.int64)
    for i in range(PERIOD):
        for j in range(PERIOD):
            d[i, j] = next(k for k in range(2, PERIOD + 2)
                           if (i + k) % PERIOD in COVER and (j + k) % PERIOD in COVER)
    return d


_DISTANCE = _distances()


def big_endian(buffer: np.ndarray) -> np.ndarray:
    """The next eight bytes at every position as one integer that sorts like them."""
    x = np.concatenate((buffer, np.zeros(8, np.uint8))).astype(np.uint64)
    x = (x[:-1] << np.uint64(8)) | x[1:]
    x = (x[:-2] << np.uint64(16)) | x[2:]
    x = (x[:-4] << np.uint64(32)) | x[4:]
    return x[:len(buffer)]


def dense(values: np.ndarray) -> np.ndarray:
    """0-based rank of each value; equal values share a rank."""
    order = np.argsort(values)
    ordered = values[order]
    rank = np.empty(len(values), np.uint64)
    step = np.ones(len(values), np.uint64)
    if len(values):
        step[0] = 0
        step[1:] = ordered[1:] != ordered[:-1]
    rank[order] = np.cumsum(step)
    return rank


def rank_of(words: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Rank of the ``length`` bytes at each position, eight bytes a step."""
    rank = dense(words[at])
    for k in range(8, length, 8):
        rank = dense((rank << np.uint64(32)) | dense(words[at + k]))
    return rank


def equal_classes(buffer: np.ndarray, starts: np.ndarray, width: int, bucket: int = BUCKET) -> np.ndarray:
    """A class number for each start; two starts share it if and only if their
    next ``width`` bytes are equal. ``PREFIX`` <= width <= ``MAX_WIDTH``."""
    if not PREFIX <= width <= MAX_WIDTH:
        raise ValueError(f"width must be in [{PREFIX}, {MAX_WIDTH}]")
    out = np.zeros(len(starts), np.int64)
    if not len(starts):
        return out
    buffer = np.concatenate((buffer, np.zeros(PREFIX + DEPTH + PERIOD, np.uint8)))
    words = big_endian(buffer)
    residue = np.arange(len(buffer)) % PERIOD
    is_sample = np.isin(residue, COVER)
    is_sample[len(buffer) - DEPTH:] = False
    sample = np.flatnonzero(is_sample)
    ranks = np.zeros(len(buffer), np.int64)
    ranks[sample] = rank_of(words, sample, DEPTH).astype(np.int64)

    # buckets: ranges of the first eight bytes that hold about `bucket` suffixes
    lead = words[starts]
    cuts = np.unique(np.sort(lead)[::bucket]) if len(lead) > bucket else lead[:0]
    of = np.searchsorted(cuts, lead, side="right")
    order = np.argsort(of, kind="stable")
    edges = np.searchsorted(of[order], np.arange(len(cuts) + 2))
    base = 0
    for lo, hi in zip(edges[:-1], edges[1:]):
        if lo < hi:
            mine = order[lo:hi]
            got = _bucket(words, ranks, starts[mine], width)
            out[mine] = got + base
            base += int(got.max()) + 1
    return out


def _bucket(words, ranks, at, width) -> np.ndarray:
    group = rank_of(words, at, PREFIX).astype(np.int64)
    order = _resolve(ranks, at, group)
    s = at[order]
    same = group[order][1:] == group[order][:-1]
    pair = np.flatnonzero(same)
    for k in [*range(PREFIX, width - 7, 8), width - 8]:
        pair = pair[words[s[pair] + k] == words[s[pair + 1] + k]]
    new = np.ones(len(s), np.int64)
    new[0] = 0
    new[pair + 1] = 0
    out = np.empty(len(s), np.int64)
    out[order] = np.cumsum(new)
    return out


def _resolve(ranks, at, group) -> np.ndarray:
    """The suffixes' order: by group, then by the cover samples' ranks. Each
    round splits every tied group in three around one of its members."""
    count = np.bincount(group)
    level = np.zeros(len(at), np.int64)  # of a member among those of its first group
    live = np.flatnonzero(count[group] > 1)
    live = live[np.argsort(group[live], kind="stable")]
    tied = group[live]
    while len(live):
        first = np.flatnonzero(np.concatenate(([True], tied[1:] != tied[:-1])))
        size = np.diff(np.append(first, len(live)))
        pivot = np.repeat(live[first + size // 2], size)
        i, p = at[live], at[pivot]
        d = _DISTANCE[i % PERIOD, p % PERIOD]
        sign = np.sign(ranks[i + d] - ranks[p + d])
        # members before the pivot, those that equal it, those behind it
        local = np.argsort(np.repeat(np.arange(len(first)), size) * 3 + sign + 1, kind="stable")
        live, sign, tied = live[local], sign[local], np.repeat(np.arange(len(first)), size)
        below = np.add.reduceat((sign < 0).astype(np.int64), first)
        equal = np.add.reduceat((sign == 0).astype(np.int64), first)
        shift = np.where(sign < 0, 0, np.where(sign == 0, np.repeat(below, size), np.repeat(below + equal, size)))
        level[live] += shift
        keep = sign != 0
        live, tied = live[keep], (tied * 2 + (sign > 0))[keep]
        if len(live):
            step = np.concatenate(([True], tied[1:] != tied[:-1]))
            tied = np.cumsum(step) - 1
            single = np.bincount(tied)[tied] == 1
            live, tied = live[~single], tied[~single]
    return np.lexsort((level, group))
