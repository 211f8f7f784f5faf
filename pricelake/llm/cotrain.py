"""Quality classifier by co-training (operator 1).

Two logistic models see different views of a document: *content* (shape of
its text) and *metadata* (source, language, length). Both learn from the
labelled documents; then, for a few rounds, each takes as further targets the
unlabelled documents about which the other one is confident. At the end each
view is calibrated on labelled documents kept apart, and a last model
combines the calibrated views into a score for every document.

All training is distributed: a pass over the feature table sums each
partition's gradient and Hessian, Spark adds them cell by cell, and the
driver solves a system as large as a view (Newton's method). No document,
labelled or not, is left out, and pseudo-labels come from the whole table.

Null and empty texts have zero content features and are scored like the rest.
A document with several label rows counts once per row; labels that are
null, or of unknown documents, are ignored. Without labels of both
classes the score is the share of good labels (0.5 without any). Null source,
language or length are values of their own. Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, functions as F

from pricelake.llm import arrowtext as T
from pricelake.llm.scratch import stage

ROUNDS, STEPS = 3, 4
#: Calibrated probability beyond which a view teaches the other, and the weight of what it teaches.
CONFIDENT, PSEUDO_WEIGHT = 0.97, 0.3
#: One labelled document in so many is kept apart for calibration.
CALIBRATION = 5
RIDGE = 1.0

#: Classes of bytes whose shares describe a text.
_CLASSES = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n\r", b".", b",", b"!?",
            b"|", b"#$%&*", b"<>{}[]=/\\", b"\"'()-:;", b"_@^~`+"]
_CLASS_OF = np.full(256, len(_CLASSES) + 1, np.uint8)
_CLASS_OF[:128] = len(_CLASSES)
for _i, _chars in enumerate(_CLASSES):
    _CLASS_OF[list(_chars)] = _i
_N = len(_CLASSES) + 2
CONTENT = 2 * _N + 9
SOURCES, LANGS = 64, 16
META = SOURCES + LANGS + 4


def content_features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Shares of byte classes, word and line shape; every value in about [0, 2]."""
    n = len(off) - 1
    out = np.zeros((n, CONTENT), np.float32)
    for lo, hi in T.chunks(off):
        base = off[lo]
        sub, o = data[base:off[hi]], off[lo:hi + 1] - base
        size = np.maximum(np.diff(o), 1)
        row = np.repeat(np.arange(hi - lo), np.diff(o))
        share = np.bincount(row * _N + _CLASS_OF[sub], minlength=(hi - lo) * _N).reshape(-1, _N) / size[:, None]
        s, e, first = T.spans(sub, o, T.WORD_BYTES)
        words = np.diff(first)
        some = np.maximum(words, 1)
        of = np.repeat(np.arange(hi - lo), words)
        length = e - s

        def mean(x):
            return np.bincount(of, weights=x, minlength=hi - lo) / some
        last = _CLASS_OF[sub[e - 1]] if len(e) else np.zeros(0, np.uint8)
        hashes = T.word_hashes(sub, s, e)
        _, once = np.unique(T.mix(hashes + T.mix(of.astype(np.uint64))), return_index=True)
        distinct = np.bincount(of[once], minlength=hi - lo) / some
        lines = np.bincount(row[sub == 10], minlength=hi - lo) + 1
        block = out[lo:hi]
        block[:, :_N] = share
        block[:, _N:2 * _N] = np.sqrt(share)
        block[:, 2 * _N:] = np.stack([
            mean(length) / 10, mean(length <= 3), mean(length >= 10), mean(last == 9), mean(last == 8), mean(last == 7),
            distinct, np.log1p(words) / 10, np.log1p(words / lines) / 5], axis=1)
    return out


def meta_features(source, lang, chars) -> np.ndarray:
    """Hashed one-hot source and language, and the length."""
    n = len(chars)
    out = np.zeros((n, META), np.float32)
    rows = np.arange(n)
    out[rows, source] = 1
    out[rows, SOURCES + lang] = 1
    z = np.log1p(np.maximum(np.nan_to_num(chars, nan=0.0), 0)) / 10
    out[:, -4:] = np.stack([z, z * z, z ** 3, np.isnan(chars)], axis=1)
    return out


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, content, meta): both views as float32 bytes."""

    def run(batches):
        for batch in batches:
            data, off = T.flat(batch.column("text"))
            content = content_features(data, off)
            meta = meta_features(*(batch.column(c).to_numpy(zero_copy_only=False) for c in ("source", "lang")),
                                 batch.column("chars").to_numpy(zero_copy_only=False).astype(float))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([r.tobytes() for r in content], pa.binary()),
                 pa.array([r.tobytes() for r in meta], pa.binary())], names=["doc_id", "content", "meta"])

    def place(c, n):
        return F.pmod(F.xxhash64(F.coalesce(F.col(c), F.lit("\u0000"))), F.lit(n)).cast("int").alias(c)

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), place("source", SOURCES),
                      place("lang", LANGS), F.col("n_chars").cast("double").alias("chars"))
    return src.mapInArrow(run, "doc_id long, content binary, meta binary")


def _matrix(column, width: int) -> np.ndarray:
    data, _ = T.flat(column)
    x = np.frombuffer(data.tobytes(), np.float32).reshape(-1, width).astype(np.float64)
    return np.hstack([x, np.ones((len(x), 1))])


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _views(batch):
    return [_matrix(batch.column("content"), CONTENT), _matrix(batch.column("meta"), META)]


def _newton(table: DataFrame, start: list[np.ndarray], rows_of, steps: int) -> list[np.ndarray]:
    """Fits several logistic models at once. ``rows_of(batch)`` gives (x, y,
    weight) for each; one pass over the table per step."""
    theta = [t.copy() for t in start]
    for _ in range(steps):
        now = [t.copy() for t in theta]

        def sums(batches):
            total = [np.zeros((len(t) + 1, len(t))) for t in now]
            for batch in batches:
                for m, (x, y, w) in enumerate(rows_of(batch)):
                    if len(y):
                        p = sigmoid(x @ now[m])
                        total[m][:-1] += (x * (w * p * (1 - p))[:, None]).T @ x
                        total[m][-1] += x.T @ (w * (y - p))
            cells = [s.ravel() for s in total]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(cells)), [len(c) for c in cells]), pa.int32()),
                 pa.array(np.concatenate([np.arange(len(c)) for c in cells]), pa.int32()),
                 pa.array(np.concatenate(cells))], names=["model", "cell", "value"])

        rows = (table.mapInArrow(sums, "model int, cell int, value double").groupBy("model", "cell")
                .agg(F.sum("value").alias("value")).toArrow())  # a number per pair of features
        model, cell, value = (rows.column(c).to_numpy() for c in ("model", "cell", "value"))
        for m, t in enumerate(theta):
            s = np.zeros((len(t) + 1) * len(t))
            s[cell[model == m]] = value[model == m]
            s = s.reshape(len(t) + 1, len(t))
            move = np.linalg.solve(s[:-1] + RIDGE * np.eye(len(t)), s[-1] - RIDGE * t)
            theta[m] = t + move / max(1.0, np.abs(move).max() / 5)
    return theta


class Model:
    """Weights of both views, their calibration (slope, offset) and the combination."""

    def __init__(self, views, calibration, combine):
        self.views, self.calibration, self.combine = views, calibration, combine

    def calibrated(self, xs):
        return [sigmoid(a * (x @ t) + b) for x, t, (a, b) in zip(xs, self.views, self.calibration)]

    def score(self, batch):
        ps = self.calibrated(_views(batch))
        z = np.stack([_logit(ps[0]), _logit(ps[1]), np.ones(len(ps[0]))], axis=1)
        return ps[0], ps[1], sigmoid(z @ self.combine)


def train(table: DataFrame, rounds: int = ROUNDS, steps: int = STEPS, confident: float = CONFIDENT,
          weight: float = PSEUDO_WEIGHT) -> Model | None:
    """A model from (content, meta, quality, apart); None without labels of both classes."""
    label = table.filter("quality IS NOT NULL").agg(F.count(F.when(F.col("quality") > 0, 1)),
                                                    F.count(F.when(F.col("quality") <= 0, 1))).first()
    if not label[0] or not label[1]:
        return None
    known = table.filter("quality IS NOT NULL")

    def target(batch):
        y = batch.column("quality").to_numpy(zero_copy_only=False).astype(float)
        return y, batch.column("apart").to_numpy(zero_copy_only=False).astype(bool)

    def labelled(batch):
        y, apart = target(batch)
        return [(x[~apart], (y[~apart] > 0).astype(float), np.ones((~apart).sum())) for x in _views(batch)]

    def calibrate(views):
        def rows(batch):
            y, apart = target(batch)
            return [(np.stack([x[apart] @ t, np.ones(apart.sum())], axis=1), (y[apart] > 0).astype(float),
                     np.ones(apart.sum())) for x, t in zip(_views(batch), views)]
        return _newton(known, [np.array([1.0, 0.0])] * 2, rows, steps)

    views = _newton(known, [np.zeros(CONTENT + 1), np.zeros(META + 1)], labelled, steps + 2)
    for _ in range(rounds):
        teacher = Model(views, calibrate(views), None)

        def taught(batch):
            y, apart = target(batch)
            xs = _views(batch)
            ps = teacher.calibrated(xs)
            free, out = np.isnan(y), []
            for x, p in zip(xs, ps[::-1]):  # each view learns from the other one's confidence
                sure = free & ((p >= confident) | (p <= 1 - confident))
                use = sure | (~free & ~apart)
                out.append((x[use], np.where(free, p > 0.5, y > 0)[use].astype(float), np.where(free, weight, 1.0)[use]))
            return out

        views = _newton(table, views, taught, steps)
    calibration = calibrate(views)
    halfway = Model(views, calibration, None)

    def both(batch):
        y, apart = target(batch)
        ps = halfway.calibrated([x[apart] for x in _views(batch)])
        z = np.stack([_logit(ps[0]), _logit(ps[1]), np.ones(len(ps[0]))], axis=1)
        return [(z, (y[apart] > 0).astype(float), np.ones(len(z)))]

    combine = _newton(known, [np.array([1.0, 0.0, 0.0])], both, steps)[0]
    return Model(views, calibration, combine)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> DataFrame:
    """(doc_id, content_score, meta_score, score, keep) of every document; the
    scores are probabilities of good quality, ``keep`` a score of at least 0.5."""
    seen = features(docs, id_col, text_col)
    known = labels.filter(F.col(label_col).isNotNull()).select(F.col("doc_id").alias("l_id"),
                                                               F.col(label_col).cast("double").alias("quality"))
    every = stage(seen, "features")
    apart = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(CALIBRATION)) == 0
    table = stage(every.join(known, F.col("doc_id") == F.col("l_id"), "left")
                  .select("content", "meta", "quality", apart.alias("apart")), "labelled")
    model = train(table)
    if model is None:
        share = table.agg(F.coalesce(F.avg(F.when(F.col("quality") > 0, 1.0).when(F.col("quality") <= 0, 0.0)),
                                     F.lit(0.5))).first()[0]
        flat = F.lit(float(share))
        return every.select("doc_id", flat.alias("content_score"), flat.alias("meta_score"), flat.alias("score"),
                            (flat >= 0.5).alias("keep"))

    def run(batches):
        for batch in batches:
            a, b, s = model.score(batch)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(a), pa.array(b), pa.array(s),
                                              pa.array(s >= 0.5)],
                                             names=["doc_id", "content_score", "meta_score", "score", "keep"])

    return every.mapInArrow(run, "doc_id long, content_score double, meta_score double, score double, keep boolean")
