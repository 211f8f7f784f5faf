"""Language ID by nearest TF-IDF n-gram centroids (operator 5).

A text is the normalised TF-IDF vector of its hashed letters, bigrams
and trigrams (lower case, anything but letters is a gap). Document frequencies
count every learning document. Each language is clustered (spherical k-means)
on a bounded sample, about ``SAMPLE`` documents picked by their id hashes, into a
few centroids. A text gets the language of the centroid with the highest cosine,
and is rejected when that cosine is below the ``REJECT`` percentile of what the
language's own sample reaches with as many letters, as are texts without
letters. Cosines grow with length, so the sample is cut to each of ``CUTS``
letters, scored by centroids of the other folds, and a text goes by the
longest cut it reaches; a text shorter than the first is not rejected.

Null texts and texts without a letter get ``und`` and score 0. Without any
labelled learning document every text gets ``und``. Null languages aren't
learned; a null id hashes as the empty string. Ties go to the language that
comes first in code point order. Further input columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from pricelake.llm import arrowtext as T
from pricelake.llm.scratch import stage

#: Hashed n-gram dimensions.
DIMS = 4096
#: Learning documents per language that the clustering uses, on average; all of a rarer language.
SAMPLE = 400
CENTROIDS = 4
#: Percentile of the sample's cosines below which a text is rejected.
REJECT = 0.5
#: Letter bytes the sample is cut to; a cut that fewer than ``ENOUGH`` texts reach takes the limit of the one before.
CUTS = np.array([4, 8, 16, 32, 64, 128, 256, 512, 1024])
ENOUGH = 50
FOLDS = 5
#: Rows whose dense vectors are held at a time.
ROWS = 256

_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_ASCII = np.zeros(256, bool)
_ASCII[65:91] = _ASCII[97:123] = True


def _folded(sub: np.ndarray) -> np.ndarray:
    x = _FOLD[sub]
    # upper-case Latin-1 letters: second byte 80-9E behind C3, but for the multiplication sign
    up = np.flatnonzero((x[1:] >= 0x80) & (x[1:] <= 0x9E) & (x[1:] != 0x97) & (x[:-1] == 0xC3)) + 1
    x[up] += 32
    return x


def counts(data: np.ndarray, offsets: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """(hi - lo, DIMS) n-gram counts of rows lo..hi. A row longer than a chunk is
    counted piece by piece, each n-gram in the piece that holds its first byte."""
    out = np.zeros((hi - lo, DIMS), np.float32)
    for a, z in T.chunks(offsets[lo:hi + 1]):
        a, z = a + lo, z + lo
        for begin in range(int(offsets[a]), int(offsets[z]), T.CHUNK_BYTES):
            first = max(int(offsets[a]), begin - 1)
            end = min(int(offsets[z]), begin + T.CHUNK_BYTES + 2)
            x = _folded(data[first:end])[begin - first:].astype(np.uint32)
            own = np.diff(offsets[a:z + 1]) if z - a > 1 else len(x)
            row = np.repeat(np.arange(z - a, dtype=np.int64), own) * DIMS
            n = min(len(x), T.CHUNK_BYTES)
            two = x[:-1] << 8 | x[1:]
            same = row[:-1] == row[1:]
            one = x[:n] != 32
            cells = [(row[:n] + ((x[:n] * np.uint32(0xC2B2AE3D)) >> 20).astype(np.int64))[one],
                     (row[:-1] + ((two * np.uint32(0x9E3779B1)) >> 20).astype(np.int64))[:n][(same & ((two & 0xFF) != 32))[:n]]]
            if len(x) > 2:
                three = x[:-2] << 16 | two[1:]
                ok = (row[:-2] == row[2:]) & ((three >> 8 & 0xFF) != 32)
                cells.append((row[:-2] + ((three * np.uint32(0x85EBCA77)) >> 20).astype(np.int64))[:n][ok[:n]])
            got = np.bincount(np.concatenate(cells), minlength=(z - a) * DIMS)
            out[a - lo:z - lo] += got.reshape(z - a, DIMS)
    return out


def vectors(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(count) * idf
    norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return v / np.maximum(norm, 1e-12)


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    out = marked(_ASCII, data, offsets) > 0
    for i in np.flatnonzero(~out & (np.diff(offsets) > 1)):
        out[i] = any(c.isalpha() for c in data[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    return out


def marked(mask: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes of each row are in ``mask``, a slice of rows at a time."""
    out = np.zeros(len(offsets) - 1, np.int64)
    for a, z in T.chunks(offsets):
        base = offsets[a]
        seen = np.concatenate(([0], np.cumsum(mask[data[base:offsets[z]]], dtype=np.int32)))
        out[a:z] = np.diff(seen[offsets[a:z + 1] - base])
    return out


def letters_to(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Letter bytes before each byte of the rows, and before their end."""
    return np.concatenate(([0], np.cumsum(_folded(data[offsets[0]:offsets[-1]]) != 32)))


def limits_of(data: np.ndarray, off: np.ndarray, x: np.ndarray, idf: np.ndarray, k: int, percentile: float) -> np.ndarray:
    """The cosine below which a text is rejected, by the number of ``CUTS`` it
    reaches. ``x`` holds the vectors of the rows; each is scored by the others' centroids."""
    out = np.zeros(len(CUTS) + 1)
    if len(x) < 2:
        return out
    fold = np.arange(len(x)) % FOLDS
    models = [cluster(x[fold != f], k) if (fold == f).any() else None for f in range(FOLDS)]
    seen = letters_to(data, off)
    start = off - off[0]
    for j, cut in enumerate(CUTS):
        rows = np.flatnonzero(seen[start[1:]] - seen[start[:-1]] >= cut)
        if len(rows) < (ENOUGH if j else 1):
            out[j + 1] = out[j]
            continue
        ends = np.searchsorted(seen, seen[start[rows]] + cut)
        parts = [data[off[r]:off[0] + e] for r, e in zip(rows, ends)]
        heads = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        flat, near = np.concatenate(parts), []
        for lo in range(0, len(rows), ROWS):
            hi = min(len(rows), lo + ROWS)
            v = vectors(counts(flat, heads, lo, hi), idf)
            near += [float((models[fold[r]] @ v[i]).max()) for i, r in enumerate(rows[lo:hi])]
        out[j + 1] = np.percentile(near, percentile, method="lower")
    return out


def cluster(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts from the mean's nearest row and goes on to the farthest."""
    start = [int(np.argmax(x @ x.mean(axis=0)))]
    near = x @ x[start[0]]
    while len(start) < min(k, len(x)):
        start.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[start[-1]])
    c = x[start]
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        c = np.stack([x[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c.astype(np.float32)


class Model:
    """Languages, their centroids and rejection limits by length, and the IDF weights."""

    def __init__(self, idf, langs, centroids, limits):
        self.idf, self.langs, self.centroids, self.limits = idf, langs, centroids, limits

    def predict(self, data, offsets):
        """(language number or -1, cosine, rejected) of each row."""
        n = len(offsets) - 1
        lang, score, reject = np.full(n, -1), np.zeros(n), np.ones(n, bool)
        letters = np.zeros(n, bool)
        if self.langs:
            for lo in range(0, n, ROWS):
                hi = min(n, lo + ROWS)
                letters[lo:hi] = has_letter(data, offsets[lo:hi + 1])
                cos = vectors(counts(data, offsets, lo, hi), self.idf) @ self.centroids[0].T
                best = np.argmax(cos, axis=1)
                lang[lo:hi] = self.centroids[1][best]
                score[lo:hi] = np.clip(cos[np.arange(hi - lo), best], 0, 1)
            own = marked(_FOLD != 32, data, offsets)
            reject = score < self.limits[lang, np.searchsorted(CUTS, own, side="right")]
            lang[~letters], score[~letters], reject[~letters] = -1, 0, True
        return lang, score, reject


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample: int = SAMPLE, centroids: int = CENTROIDS, reject: float = REJECT) -> Model:
    """A model from the documents with a language whose id's CRC-32 mod 3 is not 1."""
    known = (docs.filter(F.col(lang_col).isNotNull() & ~held_out(id_col))
             .select(F.col(lang_col).alias("lang"), F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
                     .alias("h"), F.col(text_col).alias("text")))

    def frequencies(batches):
        df, total = np.zeros(DIMS, np.int64), 0
        for batch in batches:
            data, off = T.flat(batch.column("text"))
            for lo in range(0, len(off) - 1, ROWS):
                hi = min(len(off) - 1, lo + ROWS)
                df += (counts(data, off, lo, hi) > 0).sum(axis=0)
            total += len(off) - 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMS + 1)), pa.array(np.append(df, total))],
                                         names=["dim", "df"])

    df = np.zeros(DIMS + 1)
    for r in known.select("text").mapInArrow(frequencies, "dim long, df long").groupBy("dim").agg(F.sum("df")).collect():
        df[r[0]] = r[1]
    idf = (np.log((df[-1] + 1) / (df[:-1] + 1)) + 1).astype(np.float32)

    # a share of each language's id hashes, by its number of documents: no
    # language is gathered to pick it, and the small table keeps the texts where they are
    share = stage(known.groupBy("lang").agg(F.least(F.lit(sample) / F.count(F.lit(1)), F.lit(1.0)).alias("share")), "langs")
    place = F.pmod(F.col("h"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    chosen = known.join(share, "lang").filter(place < F.col("share")).select("lang", "text")

    def fit(table: pa.Table) -> pa.Table:
        data, off = T.flat(table.column("text"))
        x = np.concatenate([vectors(counts(data, off, lo, min(len(off) - 1, lo + ROWS)), idf)
                            for lo in range(0, len(off) - 1, ROWS)])
        # the sample as a set decides, not its order; equal texts have equal vectors
        digest = [hashlib.blake2b(data[a:z].tobytes(), digest_size=16).digest() for a, z in zip(off[:-1], off[1:])]
        order = np.array(sorted(range(len(digest)), key=digest.__getitem__), np.int64)
        c = cluster(x[order], centroids)
        data, off = T.flat(table.column("text").take(pa.array(order)))
        limits = limits_of(data, off, x[order], idf, centroids, reject).tolist()
        return pa.table({"lang": [table.column("lang")[0].as_py()] * len(c), "centroid": [r.tobytes() for r in c],
                         "limits": [limits] * len(c)})

    rows = (chosen.groupBy("lang").applyInArrow(fit, "lang string, centroid binary, limits array<double>")
            .collect())  # languages x centroids
    langs = sorted({r.lang for r in rows})
    rows.sort(key=lambda r: (r.lang, r.centroid))
    mat = np.stack([np.frombuffer(r.centroid, np.float32) for r in rows]) if rows else np.zeros((0, DIMS), np.float32)
    own = np.array([langs.index(r.lang) for r in rows], np.int64)
    limits = {r.lang: r.limits for r in rows}
    return Model(idf, langs, (mat, own), np.array([limits[x] for x in langs]))


def held_out(id_col: str):
    """Whether the CRC-32 of the id as text leaves 1 modulo 3."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _slices(batches):
    """The rows of Arrow batches, ``ROWS`` at a time: a batch isn't held twice."""
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            yield batch.slice(lo, ROWS)


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and rejected (columns of these names are replaced)."""
    docs = docs.drop("lang_pred", "score", "rejected")
    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()),
                         StructField("score", DoubleType()), StructField("rejected", BooleanType())])

    def run(batches):
        names = np.array([*model.langs, "und"], object)
        for batch in _slices(batches):
            data, off = T.flat(batch.column(batch.schema.get_field_index(text_col)))
            lang, score, reject = model.predict(data, off)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names[lang], pa.string()), pa.array(score), pa.array(reject)],
                names=schema.names)

    return docs.mapInArrow(run, schema)


def accepted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language the model accepts, unchanged."""

    def run(batches):
        for batch in _slices(batches):
            data, off = T.flat(batch.column(batch.schema.get_field_index(text_col)))
            yield batch.filter(pa.array(~model.predict(data, off)[2]))

    return docs.mapInArrow(run, docs.schema)


def predictions(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of every document."""
    model = learn(docs)
    slim = docs.select("doc_id", held_out("doc_id").alias("held_out"), "text")
    return identify(slim, model).drop("text")
