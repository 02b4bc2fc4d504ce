"""Quality classifier: Bradley-Terry pairwise ranking of documents.

Numeric features of the text give each document a latent quality w.x.  The
weights maximise the likelihood of all preference pairs of the sample (every good
with every bad labelled document): logistic loss on feature differences, with a
ridge, minimised by Newton steps until its gradient vanishes.  The cut is a
quantile of the sample's own scores: the one that separates the sample's labels
best.  A score maps the latent quality to 0..1 so that the cut is exactly `at`.

Labels are learnt from a sample of at most `max_examples` labelled documents,
the ones with the smallest hash of their id.  Features are of whole texts.

Odd inputs: a null text is empty; empty texts have a score like any other;
without a good and a bad example every score is 0.5; repeated rows each get a
score, and a repeated document is one example for each label that it has; an
empty table gives no rows; the result column has a name of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import labelled_examples, text_batches
from .words import SPACED, Slice, grams, slices

MAX_EXAMPLES = 8192
RIDGE = 1e-3
#: Good examples whose pairs are worked on at a time.
ROWS = 256

_CLASSES = np.zeros(256, dtype=np.int64)
for _name, _chars in (("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)), ("space", b" \t\n\r\x0b\x0c"), ("bang", b"!?"), ("stop", b".,;:'\"()"), ("pipe", b"|<>{}[]\\/"), ("symbol", b"#*$%&@^~_=+`"), ("high", range(128, 256))):
    _CLASSES[list(_chars)] = {"lower": 1, "upper": 2, "digit": 3, "space": 4, "bang": 5, "stop": 6, "pipe": 7, "symbol": 8, "high": 9}[_name]
N_CLASSES = 10
FEATURES = [*(f"class_{i}" for i in range(N_CLASSES)), "log_words", "word_bytes", "distinct", "repeat2", "top_word", "dup_lines", "line_words", "ends_with_symbol", "all_upper"]


def features(s: Slice) -> np.ndarray:
    """One row of FEATURES for each document of a slice; all within 0..1 or so."""
    n = s.n_docs
    out = np.zeros((n, len(FEATURES)))
    bytes_ = np.maximum(s.doc_end - s.doc_start, 1)
    kind = _CLASSES[s.buf]
    # empty documents share a start with the next one's separator: count them all
    doc_of = np.cumsum(np.bincount(s.doc_start[1:], minlength=len(s.buf))[: len(s.buf)]) if n > 1 else np.zeros(len(s.buf), dtype=np.int64)
    inside = np.ones(len(s.buf), dtype=bool)
    inside[s.doc_end[s.doc_end < len(s.buf)]] = False
    table = np.bincount(doc_of[inside] * N_CLASSES + kind[inside], minlength=n * N_CLASSES).reshape(n, N_CLASSES)
    out[:, :N_CLASSES] = table / bytes_[:, None]
    words = np.diff(s.bounds)
    some = np.maximum(words, 1)
    h = s.hashes(fold_case=True)
    two = grams(h, 2)
    width = s.end - s.start
    out[:, 10] = np.log1p(words) / 10
    out[:, 11] = np.minimum(np.bincount(s.doc, weights=width, minlength=n) / some, 30) / 30
    last = _CLASSES[s.buf[s.end - 1]] if len(s.end) else np.zeros(0, np.int64)
    out[:, 17] = np.bincount(s.doc, weights=np.isin(last, (5, 7, 8)), minlength=n) / some
    upper = np.concatenate(([0], np.cumsum(kind == 2)))
    lower = np.concatenate(([0], np.cumsum(kind == 1)))
    shout = (upper[s.end] - upper[s.start] > 1) & (lower[s.end] == lower[s.start])
    out[:, 18] = np.bincount(s.doc, weights=shout, minlength=n) / some
    for i in range(n):
        a, b = int(s.bounds[i]), int(s.bounds[i + 1])
        if b == a:
            continue
        _, count = np.unique(h[a:b], return_counts=True)
        out[i, 12] = len(count) / (b - a)
        out[i, 14] = count.max() / (b - a)
        if b - a > 1:
            out[i, 13] = 1 - len(np.unique(two[a : b - 1])) / (b - a - 1)
        lines = [x for x in s.buf[s.doc_start[i] : s.doc_end[i]].tobytes().split(b"\n") if x.strip()]
        out[i, 15] = 1 - len(set(lines)) / max(len(lines), 1)
        out[i, 16] = min((b - a) / max(len(lines), 1), 100) / 100
    return out


@dataclass
class Ranker:
    """Weights on standardised features, and the map to 0..1."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    width: float
    at: float

    @property
    def learnt(self) -> bool:
        """False where the sample lacked good or bad examples."""
        return bool(self.weights.any())

    def latent(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale).clip(-8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.learnt:
            return np.full(len(x), 0.5)
        z = (self.latent(x) - self.cut) / self.width + np.log(self.at / (1 - self.at))
        return 1 / (1 + np.exp(-z.clip(-40, 40)))


def pair_loss(good: np.ndarray, bad: np.ndarray, w: np.ndarray, ridge: float = RIDGE) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean logistic loss over every (good, bad) pair with its gradient and Hessian."""
    pairs, up, down = len(good) * len(bad), good @ w, bad @ w
    loss, of_bad, bend_bad = 0.0, np.zeros(len(bad)), np.zeros(len(bad))
    grad, bend = np.zeros(len(w)), np.zeros((len(w), len(w)))
    for a in range(0, len(good), ROWS):
        g = good[a : a + ROWS]
        ahead = up[a : a + ROWS, None] - down
        loss += float(np.logaddexp(0, -ahead).sum())
        p = np.exp(-np.logaddexp(0, ahead))  # chance that the bad one wins
        v = p * (1 - p)
        grad -= g.T @ p.sum(axis=1)
        of_bad += p.sum(axis=0)
        bend_bad += v.sum(axis=0)
        cross = g.T @ (v @ bad)
        bend += (g.T * v.sum(axis=1)) @ g - cross - cross.T
    grad += bad.T @ of_bad
    bend += (bad.T * bend_bad) @ bad
    return loss / pairs + ridge / 2 * float(w @ w), grad / pairs + ridge * w, bend / pairs + ridge * np.eye(len(w))


def fit_pairs(x: np.ndarray, y: np.ndarray, at: float, ridge: float = RIDGE, rounds: int = 50) -> Ranker:
    """Bradley-Terry weights from all (good, bad) pairs, and the cut."""
    mean, scale = (x.mean(axis=0), x.std(axis=0) + 1e-6) if len(x) else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
    z = ((x - mean) / scale).clip(-8, 8)
    good, bad = z[y == 1], z[y == 0]
    w = np.zeros(x.shape[1])
    if not len(good) or not len(bad):
        return Ranker(mean, scale, w, 0.0, 1.0, at)
    loss, grad, bend = pair_loss(good, bad, w, ridge)
    for _ in range(rounds):
        if np.abs(grad).max() < 1e-9:
            break
        step, size = np.linalg.solve(bend, grad), 1.0
        while size > 1e-6 and (new := pair_loss(good, bad, w - size * step, ridge))[0] > loss:
            size /= 2
        if size <= 1e-6:
            break
        w = w - size * step
        loss, grad, bend = new
    latent = z @ w
    # the quantile of the sample's scores that separates its labels with least error
    order = np.argsort(latent, kind="stable")
    wrong = np.concatenate(([0], np.cumsum(y[order] == 1))) + (len(bad) - np.concatenate(([0], np.cumsum(y[order] == 0))))
    best = np.flatnonzero(wrong == wrong.min())
    k = int(best[len(best) // 2])
    v = latent[order]
    cut = (v[max(k - 1, 0)] + v[min(k, len(v) - 1)]) / 2
    width = max(float(np.median(np.abs(latent - cut))) / 3, 1e-6)
    return Ranker(mean, scale, w, float(cut), width, at)


def fit(docs: DataFrame, labels: DataFrame, label: str, learn: F.Column, at: float = 0.7, max_examples: int = MAX_EXAMPLES) -> Ranker:
    """Learn a ranker; executors compute features, the driver gets the sample's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in slices(b.column(0), SPACED):
                x = features(s)
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), b.column(1).slice(s.first, s.n_docs).cast(pa.int32())], names=["x", "y"])

    sample = labelled_examples(docs, labels, label, learn, max_examples)
    rows = sample.select("text", "y").mapInArrow(run, "x binary, y int").collect()
    rows.sort(key=lambda r: (r["x"], r["y"]))
    x = np.array([np.frombuffer(r["x"]) for r in rows]).reshape(len(rows), len(FEATURES))
    return fit_pairs(x, np.array([r["y"] for r in rows]), at)


def classify(docs: DataFrame, ranker: Ranker, columns: list[str]) -> DataFrame:
    """The given columns of each row, with `_swident_score` added."""
    text_batches(docs.sparkSession)
    kept = docs.select(*columns) if "text" in columns else docs.select(*columns, F.col("text").alias("_swident_text"))
    text_at, n = (columns.index("text") if "text" in columns else len(columns)), len(columns)
    schema = docs.select(*columns).schema.add("_swident_score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in slices(b.column(text_at), SPACED):
                part = [b.column(i).slice(s.first, s.n_docs) for i in range(n)]
                yield pa.RecordBatch.from_arrays([*part, pa.array(ranker.score(features(s)))], names=schema.names)

    return kept.mapInArrow(run, schema)

