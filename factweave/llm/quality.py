"""Quality classifier: nearest-neighbour voting among labelled latent-semantic vectors.

A text becomes hashed counts of what it is made of (byte trigrams, shapes of characters, repeats of words and lines),
weighted by rarity and projected on the leading singular vectors of a labelled sample.  The sample's
vectors are broadcast; every document gets its exact cosines with all of them, block by block, and the nearest
neighbours' labels are averaged with weights that grow with similarity.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import IS_SPACE, give_back, runs, small_batches, spans_hash, text_blocks

#: Labelled documents of each class that the classifier is fitted on (smallest hashes of doc_id): the documented bound.
PER_CLASS = 1500
THRESHOLD = 0.7
NEIGHBOURS, RANK = 24, 64
GRAMS, SHAPES, WORDS, LINES = 3072, 900, 64, 60
WIDTH = GRAMS + SHAPES + WORDS + LINES
#: Sharpness of the vote: a neighbour weighs exp(SHARP * (its cosine - the best cosine)).
SHARP = 12.0

_b = np.arange(256)
#: lower, upper, digit, space, line end, full stop and comma, other ASCII, other bytes
_shape = np.select([(_b >= 97) & (_b <= 122), (_b >= 65) & (_b <= 90), (_b >= 48) & (_b <= 57), _b == 32, (_b == 10) | (_b == 13), (_b == 44) | (_b == 46), _b < 128], [0, 1, 2, 3, 4, 5, 6], 7).astype(np.int64)
IN_WORD = ~IS_SPACE
IN_LINE = (_b != 10) & (_b != 13)


@dataclass
class Voter:
    idf: np.ndarray
    axes: np.ndarray  # WIDTH x rank
    points: np.ndarray  # labelled documents x rank, unit length
    labels: np.ndarray
    slope: float
    shift: float
    prior: float


def features(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Counts (documents x WIDTH) of a block of whole texts."""
    n = len(offs) - 1
    out = np.zeros((n, WIDTH), np.float32)
    if not len(buf):
        return out
    doc = np.repeat(np.arange(n), np.diff(offs))

    def add(doc, at, base, width):
        out[:, base : base + width] += np.bincount(doc * width + at, minlength=n * width).reshape(n, width)

    if len(buf) >= 3:
        b = buf.astype(np.int64)
        same = doc[:-2] == doc[2:]
        h = (b[:-2] * 1009 + b[1:-1] * 65_537 + b[2:] * 7_340_033) * 2_654_435_761
        add(doc[:-2][same], ((h >> 9) % GRAMS)[same], 0, GRAMS)
        s = _shape[buf]
        h = (s[:-2] * 8 + s[1:-1]) * 8 + s[2:]
        same &= ~((s[:-2] == 0) & (s[1:-1] == 0) & (s[2:] == 0))  # plain letters are no shape
        add(doc[:-2][same], h[same], GRAMS, SHAPES)
    for inside, base, width, far in ((IN_WORD, GRAMS + SHAPES, WORDS, 8), (IN_LINE, GRAMS + SHAPES + WORDS, LINES, 4)):
        starts, ends, first = runs(inside[buf], offs)
        if not len(starts):
            continue
        h, owner = spans_hash(buf, starts, ends), np.repeat(np.arange(n), np.diff(first))
        for k in range(1, far + 1):  # equal to what stands k before it
            if len(h) > k:
                hit = (h[k:] == h[:-k]) & (owner[k:] == owner[:-k])
                add(owner[k:][hit], np.full(hit.sum(), k - 1), base, width)
        size = np.minimum(np.log2(ends - starts).astype(np.int64), 15)
        add(owner, 8 + size, base, width)
        # how much of a document is a word or line that it has already had
        order = np.lexsort((h, owner))
        again = np.zeros(len(h), bool)
        again[1:] = (h[order][1:] == h[order][:-1]) & (owner[order][1:] == owner[order][:-1])
        seen, had = np.bincount(owner, minlength=n), np.bincount(owner[order][again], minlength=n)
        tenth = (10 * had // np.maximum(seen, 1)).astype(np.int64)
        out[np.arange(n), base + 30 + tenth] += 3.0
    return out


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def unit(x: np.ndarray) -> np.ndarray:
    return (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def vote(points: np.ndarray, voter_points: np.ndarray, weights: np.ndarray, labels: np.ndarray, k: int, own: bool = False) -> np.ndarray:
    """Weighted share of label 1 among each point's k nearest; ``own`` leaves a point itself out."""
    out = np.empty(len(points), np.float64)
    k = min(k, len(voter_points) - own)
    for i in range(0, len(points), 256):
        c = points[i : i + 256] @ voter_points.T
        if own:
            c[np.arange(len(c)), np.arange(i, i + len(c))] = -2
        near = np.argpartition(-c, k - 1, axis=1)[:, :k] if k < c.shape[1] else np.tile(np.arange(c.shape[1]), (len(c), 1))
        s = np.take_along_axis(c, near, 1)
        w = np.exp(SHARP * (s - s.max(axis=1, keepdims=True))) * weights[near]
        out[i : i + 256] = (w * labels[near]).sum(axis=1) / w.sum(axis=1)
    return out


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-3, 1 - 1e-3)
    return np.log(p / (1 - p))


def fit(counts: np.ndarray, labels: np.ndarray, prior: float) -> Voter:
    """Projection, labelled points, and the calibration of the vote by leaving each point out."""
    n = len(labels)
    if not n:
        return Voter(np.ones(WIDTH, np.float32), np.zeros((WIDTH, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), 1.0, 0.0, 0.5)
    idf = (np.log((1 + n) / (1 + (counts > 0).sum(axis=0))) + 0.1).astype(np.float32)
    x = weighted(counts, idf)
    rng = np.random.default_rng(5)
    r = min(RANK, n, WIDTH)
    y = x @ rng.standard_normal((WIDTH, min(r + 16, n))).astype(np.float32)
    for _ in range(4):
        y, _ = np.linalg.qr(x @ (x.T @ y))
    _, _, vt = np.linalg.svd(y.T @ x, full_matrices=False)
    axes = np.ascontiguousarray(vt[:r].T)
    points = unit(x @ axes)
    if n < 3 or labels.min() == labels.max():
        return Voter(idf, axes, points, labels, 1.0, 0.0, prior)
    weights = np.where(labels == 1, prior / labels.mean(), (1 - prior) / (1 - labels.mean()))
    t = logit(vote(points, points, weights, labels, NEIGHBOURS, own=True))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * t + b, -40, 40)))
        g = np.array([(weights * (labels - p) * t).sum() - 1e-2 * a, (weights * (labels - p)).sum() - 1e-2 * b])
        w = weights * p * (1 - p)
        h = np.array([[(w * t * t).sum() + 1e-2, (w * t).sum()], [(w * t).sum(), w.sum() + 1e-2]])
        step = np.linalg.solve(h, g)
        a, b = a + np.clip(step[0], -1, 1), b + np.clip(step[1], -2, 2)
        if np.abs(step).max() < 1e-7:
            break
    return Voter(idf, axes, points, labels, float(np.clip(a, 0.3, 10)), float(b), prior)


def score_counts(v: Voter, counts: np.ndarray) -> np.ndarray:
    if not len(v.labels):
        return np.full(len(counts), 0.5)
    share = v.labels.mean()
    weights = np.where(v.labels == 1, v.prior / max(share, 1e-6), (1 - v.prior) / max(1 - share, 1e-6))
    if share in (0.0, 1.0):
        weights = np.ones(len(v.labels))
    points = unit(weighted(counts, v.idf) @ v.axes)
    t = logit(vote(points, v.points, weights, v.labels, NEIGHBOURS))
    # a text without features is equally far from all: nothing but the prior speaks
    return np.where(points.any(axis=1), 1 / (1 + np.exp(-np.clip(v.slope * t + v.shift, -40, 40))), v.prior)


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[DataFrame, float]:
    """At most ``per_class`` labelled rows of each class, and the share of label 1 among all labelled rows."""
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    known = known.join(docs.select("doc_id").where("doc_id is not null").distinct(), "doc_id")
    shares = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    picked = [known.where(F.col("quality") == q).orderBy(F.xxhash64(F.lit(3), "doc_id"), "doc_id").limit(per_class) for q in (0, 1)]
    return picked[0].unionByName(picked[1]), (shares.get(1, 0) + 1) / (sum(shares.values()) + 2)


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Voter:
    rows, prior = training_rows(docs, labels, per_class)

    def counts(batches):
        for b in batches:
            ids, quality, got = b.column(0), b.column(2), []
            for _, buf, offs in text_blocks(b.column(1)):
                for x in features(buf, offs):
                    at = np.flatnonzero(x)
                    got.append(zlib.compress(at.astype(np.uint16).tobytes() + x[at].tobytes(), 1))
            yield pa.RecordBatch.from_arrays([ids, quality, pa.array(got, pa.binary())], ["doc_id", "quality", "x"])
        give_back()

    some = docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id")  # 2 * per_class ids at most
    got = some.select("doc_id", "text", "quality").mapInArrow(counts, "doc_id long, quality int, x binary").toPandas()
    got = got.drop_duplicates("doc_id").sort_values("doc_id")
    x = np.zeros((len(got), WIDTH), np.float32)
    for i, z in enumerate(got["x"]):
        raw = zlib.decompress(z)
        k = len(raw) // 6
        x[i, np.frombuffer(raw[: 2 * k], np.uint16)] = np.frombuffer(raw[2 * k :], np.float32)
    return fit(x, got["quality"].to_numpy(np.float64), prior)


def score(docs: DataFrame, voter: Voter, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score and predicted of every row; only the text is an input of the score.

    Null and empty texts have no features and get the share of label 1 among all labelled rows.  Without
    any labelled row every score is 0.5.  Repeated rows get equal scores; texts of any length are read whole;
    other columns, whatever their names, are ignored.
    """
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(voter)

    def judge(batches):
        for b in batches:
            p = _scores(held.value, b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])
        give_back()

    return docs.select("doc_id", "text").mapInArrow(judge, "doc_id long, score double, predicted int")


def keep(docs: DataFrame, voter: Voter, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that ``score`` would predict 1, with all their columns."""
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(voter)
    at = docs.columns.index("text")

    def judge(batches):
        for b in batches:
            yield b.filter(pa.array(_scores(held.value, b.column(at)) >= threshold))
        give_back()

    return docs.mapInArrow(judge, docs.schema)


def _scores(voter: Voter, texts: pa.Array) -> np.ndarray:
    parts = [score_counts(voter, features(buf, offs)) for _, buf, offs in text_blocks(texts, 1 << 19, 512)]
    return np.concatenate(parts) if parts else np.zeros(0)


def frame_of(texts: list[str | None]) -> pd.DataFrame:
    """Features of a few texts on the driver (for tests)."""
    return pd.DataFrame(np.concatenate([features(b, o) for _, b, o in text_blocks(pa.array(texts, pa.string()))]))
