"""Quality classifier by positive-unlabelled learning.

A small network minimises the non-negative unbiased PU risk

    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))

with the sigmoid loss, from trusted positives (label 1), unlabelled web text
and a class prior estimated from the two alone (``estimate_prior``). Its raw
score is then turned into a probability by a one variable logistic fit that
minimises the unbiased PU risk, which is convex there (``calibrate``). Label 0
is never learnt from: such rows count as neither trusted nor unlabelled.

The fit uses bounded samples (``MAX_LABELLED`` labelled and ``MAX_UNLABELLED``
other rows, those of the smallest id hash); scoring reads every whole text.
Inputs of a score are taken from the text alone.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .words import NON_SPACE, Block, blocks, words

MAX_LABELLED, MAX_UNLABELLED = 8000, 8000
THRESHOLD = 0.7
DELTA = 0.1  # chance of error behind the margin of the prior
HIDDEN, EPOCHS, BATCH, RATE, DECAY, SEED = 16, 60, 512, 0.01, 0.03, 7

#: Byte classes whose share of a text is a feature.
_CLASSES = [range(0x61, 0x7B), range(0x41, 0x5B), range(0x30, 0x3A), range(0x80, 0x100), [0x20], [0x0A], [0x09, 0x0D]]
_CLASSES += [[b] for b in range(0x21, 0x7F) if not chr(b).isalnum()]
_CLASS = np.full(256, len(_CLASSES), np.int32)
for _i, _c in enumerate(_CLASSES):
    _CLASS[list(_c)] = _i
N_BYTE = len(_CLASSES) + 1
N_FEATURES = 2 * N_BYTE + 12


def features(block: Block) -> np.ndarray:
    """One row per text: byte class shares, shares of words that end in a
    byte class, and shape figures of words and lines."""
    n = len(block)
    size = np.diff(block.offs)
    doc = np.repeat(np.arange(n, dtype=np.int32), size)
    kind = _CLASS[block.data]
    share = np.bincount(doc * N_BYTE + kind, minlength=n * N_BYTE).reshape(n, N_BYTE)
    share = share / np.maximum(size, 1)[:, None]
    w = words(block, NON_SPACE)
    many = np.maximum(w.count, 1)
    last = np.bincount(w.doc * N_BYTE + kind[w.end - 1], minlength=n * N_BYTE).reshape(n, N_BYTE) / many[:, None]
    length = w.end - w.start
    mean = np.bincount(w.doc, length, n) / many
    var = np.maximum(np.bincount(w.doc, length * length, n) / many - mean * mean, 0)

    def distinct(h: np.ndarray, d: np.ndarray) -> np.ndarray:
        order = np.lexsort((h, d))
        h, d = h[order], d[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        return np.bincount(d[new], minlength=n)

    same_next = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    pair = w.hash[:-1] * np.uint64(3) + w.hash[1:]
    inside = w.doc[1:] == w.doc[:-1]
    pairs = np.maximum(np.bincount(w.doc[1:][inside], minlength=n), 1)
    lines = np.bincount(doc[block.data == 0x0A], minlength=n) + 1
    upper_first = np.bincount(w.doc[(block.data[w.start] >= 0x41) & (block.data[w.start] <= 0x5A)], minlength=n)
    shape = [
        np.log1p(w.count),
        np.log1p(size),
        mean,
        np.sqrt(var),
        distinct(w.hash, w.doc) / many,
        distinct(pair[inside], w.doc[1:][inside]) / pairs,
        np.bincount(w.doc[1:][same_next], minlength=n) / many,
        upper_first / many,
        np.bincount(w.doc[length >= 20], minlength=n) / many,
        np.bincount(w.doc[length <= 2], minlength=n) / many,
        np.log1p(w.count / lines),
        (w.count == 0).astype(float),
    ]
    return np.column_stack([share, last, *shape])


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(x) + self.shift, -40, 40)))


def fit_pu(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Model:
    """Minimise the non-negative PU risk (Adam, fixed seed)."""
    rng = np.random.default_rng(SEED)
    mean, scale = unlabelled.mean(0), unlabelled.std(0) + 1e-3
    d = unlabelled.shape[1]
    m = Model(mean, scale, rng.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), 0.0)
    p = np.clip((positive - mean) / scale, -8, 8)
    u = np.clip((unlabelled - mean) / scale, -8, 8)
    params = [m.w1, m.b1, m.w2, np.zeros(1)]
    first, second, t = [np.zeros_like(x) for x in params], [np.zeros_like(x) for x in params], 0
    half = BATCH // 2
    for _ in range(EPOCHS):
        for _ in range(-(-len(u) // half)):
            x = np.concatenate([p[rng.integers(0, len(p), half)], u[rng.integers(0, len(u), half)]])
            h = np.tanh(x @ params[0] + params[1])
            g = h @ params[2] + params[3]
            s = 1 / (1 + np.exp(-np.clip(g, -40, 40)))  # sigmoid loss: R- is mean s, R+ is mean 1 - s
            slope = s * (1 - s) / half
            negative = s[half:].mean() - prior * s[:half].mean()
            if negative >= 0:
                dg = np.concatenate([-2 * prior * slope[:half], slope[half:]])
            else:  # the risk of negatives went below zero: step back along it
                dg = np.concatenate([prior * slope[:half], -slope[half:]])
            back = np.outer(dg, params[2]) * (1 - h * h)
            grads = [x.T @ back + DECAY * params[0], back.sum(0), h.T @ dg + DECAY * params[2], dg.sum(keepdims=True)]
            t += 1
            for i, grad in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * grad
                second[i] = 0.999 * second[i] + 0.001 * grad * grad
                params[i] -= RATE * (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.999**t)) + 1e-8)
    m.w1, m.b1, m.w2, m.b2 = params[0], params[1], params[2], float(params[3][0])
    return m


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives among unlabelled rows.

    Two halves of the rows each fit a classifier of positives against
    unlabelled rows and judge the other half: there the share of unlabelled
    rows above a cut over that of positives bounds the prior from above,
    closely where what lies above the cut is nearly all positive. The cut of
    the least such ratio, with a margin for the number of rows behind it,
    gives the estimate; the larger one of both halves and one standard error
    more is returned, so that doubt keeps a text rather than rejects it.
    """
    if min(len(positive), len(unlabelled)) < 4:
        return 0.5
    found = []
    for half in (0, 1):
        m = fit_pu(positive[half::2], unlabelled[half::2], 0.5)
        p, u = np.sort(m.raw(positive[1 - half :: 2])), np.sort(m.raw(unlabelled[1 - half :: 2]))
        cut = np.unique(p)
        above_p = 1 - np.searchsorted(p, cut) / len(p)
        above_u = 1 - np.searchsorted(u, cut) / len(u)
        margin = sum(math.sqrt(math.log(4 / DELTA) / (2 * n)) for n in (len(p), len(u)))
        best = int(np.argmin((above_u + margin) / above_p))
        found.append(min(1.0, above_u[best] / above_p[best]))
    prior = max(found)
    error = math.sqrt(prior * (1 - prior) * (1 / len(positive) + 1 / len(unlabelled)))
    return float(np.clip(prior + error, 0.05, 0.95))


def calibrate(m: Model, positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> None:
    """Logistic fit of the class on the raw score (Newton steps), from the PU
    risk ``mean log(1 + exp(s)) over unlabelled - prior * mean s over
    positives``: at its minimum the mean probability of unlabelled rows is
    the prior."""
    g = m.raw(unlabelled)
    centre, spread = g.mean(), g.std() + 1e-9
    z = np.column_stack([(g - centre) / spread, np.ones(len(g))])
    goal = prior * np.array([((m.raw(positive) - centre) / spread).mean(), 1.0])
    ridge = np.diag([1e-3, 1e-6])
    w = np.zeros(2)
    for _ in range(100):
        q = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hess = (z * (q * (1 - q))[:, None]).T @ z / len(z) + ridge
        step = np.linalg.solve(hess, z.T @ q / len(z) - goal + ridge @ w)
        w -= np.clip(step, -2, 2)
        if abs(step).max() < 1e-8:
            break
    m.slope, m.shift = w[0] / spread, w[1] - w[0] * centre / spread


def held_out(doc_id: Column) -> Column:
    """Rows whose labels must not be learnt: crc32 of the id's text mod 4 is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _extract(batches):
    for block in blocks(batches, "text"):
        x = features(block).astype(np.float32)
        at = np.arange(len(block) + 1, dtype=np.int32) * x.shape[1]
        yield pa.RecordBatch.from_arrays(
            [block.batch.column(0), block.batch.column(2), pa.ListArray.from_arrays(pa.array(at), pa.array(x.reshape(-1)))],
            ["doc_id", "quality", "x"],
        )


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, max_unlabelled: int = MAX_UNLABELLED) -> Model | None:
    """Fit on bounded samples; None if there is no trusted positive or no
    unlabelled text. Contradicting labels of one id: the smaller one holds."""
    known = (
        labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int"))
        .where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    known = stage(known, "labels")
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    ids = docs.select(F.col("doc_id").cast("long")).where("doc_id is not null").distinct()
    some = known.join(ids, "doc_id", "left_semi").orderBy(*order).limit(max_labelled)
    rest = ids.join(labels.select(F.col("doc_id").cast("long")), "doc_id", "left_anti").orderBy(*order).limit(max_unlabelled)
    sample = stage(some.unionByName(rest.withColumn("quality", F.lit(-1))), "sample")  # bounded: max_labelled + max_unlabelled ids
    flat = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = (
        flat.join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id", "quality")
        .agg(F.min("text").alias("text"))  # one text of a repeated id
        .select("doc_id", "text", "quality")
        .mapInArrow(_extract, "doc_id long, quality int, x array<float>")
        .toPandas()
        .sort_values("doc_id")
    )
    if not len(rows):
        return None
    x, y = np.stack(rows["x"].to_numpy()).astype(float), rows["quality"].to_numpy()
    if not (y == 1).any():
        return None
    positive = x[y == 1]
    web = x[y < 0] if (y < 0).sum() >= 50 else x  # too little unlabelled text: all sampled rows, labels unseen
    prior = estimate_prior(positive, web)
    model = fit_pu(positive, web, prior)
    calibrate(model, positive, web, prior)
    return model


def _score(model: Model | None):
    def run(batches):
        for block in blocks(batches, "text"):
            score = np.ones(len(block)) if model is None else model.score(features(block))
            yield pa.RecordBatch.from_arrays([block.batch.column(0), pa.array(score)], ["doc_id", "score"])

    return run


def score_quality(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    A null or empty text is scored like any other (its shares are zero);
    repeated rows give repeated result rows; a null doc_id stays null (not
    held out); other columns are ignored; without a model every score is 1
    (nothing speaks against a text); an empty table gives no rows.
    """
    flat = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = flat.mapInArrow(_score(model), "doc_id long, score double")
    return out.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def _keep(model: Model | None, column: str):
    def run(batches):
        for block in blocks(batches, column):
            if model is None:
                yield block.batch
            else:
                yield block.batch.filter(pa.array(model.score(features(block)) >= THRESHOLD))

    return run


def keep_quality(docs: DataFrame, model: Model | None, column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is predicted to be of quality 1."""
    return docs.mapInArrow(_keep(model, column), docs.schema)
