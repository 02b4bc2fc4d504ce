"""Toxicity: votes of the nearest labelled examples by exact TF-IDF cosine.

Examples and documents are TF-IDF vectors over all their words; a document's
words that no example has count in its length.  Document frequencies are those
of the sampled examples.  Telling words weigh 1 + evidence times as much: words
most of whose contexts (previous and next word) are in toxic examples, beyond
what chance would give; counting distinct contexts keeps copies of one example
from making its words look typical.  All other words weigh once.

The index is inverted: each word's postings are (example, weight).  Examples are
numbered so that similar ones are neighbours, in blocks of `BLOCK`.  The postings
of the `DENSE` most frequent words, by far the longest, are laid out by block, and
their largest weight in each block is kept.  A search adds up the short lists,
bounds each block by its best sum so far plus what its maxima allow, works out the
most promising blocks, and then only those blocks whose bound reaches the k-th
best cosine found.  Sums are in single precision; the examples that could be
among the k nearest are compared again in double precision, so the k nearest are
exact, and every document meets every example that shares a word with it.

Votes weigh by squared cosine (that is 1 - squared distance of unit vectors / 2,
squared) and are shrunk to the prior.  A score is the vote on a logistic scale
that is fitted to votes on examples by the others (Platt's method).

Examples are the at most `max_examples` labelled rows with the smallest hash of
their id, and the scale is fitted on `CALIBRATED` of them (bounds of the
classifier's sample); every document is scored over its whole text.  A text that
shares no word with an example has no neighbours and gets the share of toxic
examples among those without words.

Odd inputs: null texts are empty; without examples every score is 0.0; equal
cosines prefer the example that comes first by id; repeated rows each get a
score, and a repeated document is one example for each label that it has; an
empty table gives no rows; result columns have names of their own.
"""

from __future__ import annotations

import math
import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import stored
from .common import labelled_examples, lower_ascii, text_batches
from .decontaminate import words_of
from .words import ALNUM, Slice, joined, lean_memory, planes, slices

MAX_EXAMPLES = 16_384
CALIBRATED = 2048
SLACK = 2.0
DENSE = 512
BLOCK = 16
BATCH = 64
#: Blocks without use that are worked out rather than left out in a run.
GAP = 3
#: Blocks that a search works out first.
FIRST = 4
#: More than single precision can be off in a sum of products that make 1 at most.
MARGIN = 1e-4
K = 15
SHRINK = 1.0


def telling(examples: DataFrame, slack: float = SLACK) -> dict[str, float]:
    """The words most of whose distinct contexts are toxic, and the evidence for each."""
    words = examples.select("y", words_of(lower_ascii(F.col("text"))).alias("w")).select("y", "w", F.posexplode("w").alias("i", "term"))
    contexts = words.select("y", "term", F.xxhash64(F.expr("get(w, i - 1)"), F.expr("get(w, i + 1)"), F.size("w") == 1).alias("c")).distinct()
    by_term = stored(contexts.groupBy("term").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b")), "terms")
    total = by_term.agg(F.sum("a").alias("ta"), F.sum("b").alias("tb"), F.count("*").alias("n")).first()
    if not total.ta or not total.tb:
        return {}
    # evidence: n * KL(a / n || share of toxic contexts), in nats; chance gives
    # a word of n terms evidence over log(n) about once
    share = total.ta / (total.ta + total.tb)
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    plus = a * F.log(a / ((a + b) * F.lit(share)))
    minus = F.when(b > 0, b * F.log(b / ((a + b) * F.lit(1 - share)))).otherwise(0.0)
    chosen = by_term.where("a >= b and a > 0").withColumn("evidence", plus + minus).where(F.col("evidence") >= math.log(total.n) - slack)
    return {r.term: r.evidence for r in chosen.collect()}


def _cells(s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, word hash, count) of the distinct words of each document of a slice."""
    h, at = np.unique(s.hashes(True), return_inverse=True)
    cell, count = np.unique(s.doc * max(len(h), 1) + at, return_counts=True)
    doc, at = np.divmod(cell, max(len(h), 1))
    return doc, h[at], count


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0] .. start[0] + size[0] - 1, start[1] .. and so on."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - size), size)


def _similar_first(rows: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """An order of the rows in which similar ones are neighbours: halves along the main direction, again and again."""
    order, parts = np.arange(len(rows)), [(0, len(rows))]
    rng = np.random.Generator(np.random.PCG64(3))
    while parts:
        a, z = parts.pop()
        if z - a <= block:
            continue
        x = rows[order[a:z]]
        x -= x.mean(axis=0)
        v = rng.normal(size=x.shape[1]).astype(np.float32)
        for _ in range(6):
            v = x.T @ (x @ v)
            v /= np.linalg.norm(v) + 1e-9
        order[a:z] = order[a:z][np.argsort(x @ v, kind="stable")]
        middle = a + max(block, (z - a) // 2 // block * block)
        parts += [(a, middle), (middle, z)]
    return order


@dataclass
class Index:
    """The examples' unit vectors over all their words, forwards and inverted by blocks.

    A pickle of it holds terms and counts, compressed; what follows from them is
    worked out again where it is read, and counts are no longer needed there.
    """

    hashes: np.ndarray  # sorted, of each term
    idf: np.ndarray  # with the weight of telling words
    first: np.ndarray  # terms of example i: first[i] .. first[i + 1], rising
    term: np.ndarray
    count: np.ndarray
    label: np.ndarray
    ids: list
    by_id: np.ndarray  # rank of each example's id
    prior: float
    without: float
    scale: tuple[float, float] = (1.0, 0.0)

    def __post_init__(self) -> None:
        self._weigh()
        self._invert()

    def _weigh(self) -> None:
        n, size = self.n, np.diff(self.first)
        self.unseen = math.log(2 + n)  # idf of words that no example has
        self.weight = np.empty(len(self.term), dtype=np.float32)
        for a in range(0, n, 1024):
            z = min(a + 1024, n)
            lo, hi = int(self.first[a]), int(self.first[z])
            weight = (1 + np.log(self.count[lo:hi])) * self.idf[self.term[lo:hi]]
            norm = np.sqrt(np.add.reduceat(weight * weight, self.first[a:z] - lo))
            self.weight[lo:hi] = weight / np.repeat(norm, size[a:z])

    def _invert(self) -> None:
        n, size = self.n, np.diff(self.first)
        frequency = np.bincount(self.term, minlength=len(self.hashes))
        top = np.argsort(-frequency, kind="stable")[:DENSE]
        self.place = np.full(len(self.hashes), -1, dtype=np.int16)  # of a dense term
        self.place[top] = np.arange(len(top))
        owner = np.repeat(np.arange(n, dtype=np.uint16 if n <= 1 << 16 else np.int32), size)
        at = self.place[self.term]
        common = at >= 0
        self.dense = np.zeros((len(top), n), dtype=np.float32)  # place x example
        self.dense[at[common], owner[common]] = self.weight[common]
        # the largest weight of each dense term in each block
        self.most = np.maximum.reduceat(self.dense, np.arange(0, n, BLOCK), axis=1) if n else np.zeros((len(top), 0), np.float32)
        # postings of the other terms t: start[t] .. start[t + 1]
        self.start = np.concatenate(([0], np.cumsum(np.where(self.place < 0, frequency, 0)))).astype(np.int64)
        np.logical_not(common, out=common)
        del at
        term, owner, impact = self.term[common], owner[common], self.weight[common]
        order = np.argsort(term, kind="stable").astype(np.int32)
        del term
        self.example, self.impact = owner[order], impact[order]

    def __getstate__(self) -> dict:
        state = {k: getattr(self, k) for k in ("hashes", "idf", "first", "label", "ids", "by_id", "prior", "without", "scale")}
        steps = np.diff(self.term, prepend=np.int32(0))
        return state | {"term": zlib.compress(planes(steps), 1), "count": zlib.compress(planes(self.count), 1)}

    def __setstate__(self, state: dict) -> None:
        lean_memory()
        self.__dict__.update(state)
        self.term = np.cumsum(joined(zlib.decompress(state["term"]), np.int32), dtype=np.int32)
        self.count = joined(zlib.decompress(state["count"]), np.uint32)
        self._weigh()
        del self.count
        self._invert()

    @property
    def n(self) -> int:
        return len(self.label)

    def vectors(self, s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(documents, bounds, terms, weights) of the unit vectors of a slice, less the terms that no example has."""
        if not len(self.hashes) or not len(s.start):
            e = np.zeros(0, dtype=np.int64)
            return e, np.zeros(1, dtype=np.int64), e, e.astype(float)
        doc, h, count = _cells(s)
        term = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        hit = self.hashes[term] == h
        w = (1 + np.log(count)) * np.where(hit, self.idf[term], self.unseen)
        norm = np.sqrt(np.bincount(doc, weights=w * w, minlength=s.n_docs))
        doc, term, w = doc[hit], term[hit], (w / norm[doc])[hit]
        who, first = np.unique(doc, return_index=True)
        return who, np.concatenate((first, [len(w)])), term, w

    def cosines(self, examples: np.ndarray, terms: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """In double precision, each example's terms in the same order."""
        q = self._query
        q[terms] = weight
        size = self.first[examples + 1] - self.first[examples]
        at = _ranges(self.first[examples], size)
        out = np.add.reduceat(q[self.term[at]] * self.weight[at], np.cumsum(size) - size) if len(at) else np.zeros(0)
        q[terms] = 0
        return out

    @cached_property
    def _query(self) -> np.ndarray:
        return np.zeros(len(self.hashes))

    def _short_lists(self, terms: np.ndarray, weight: np.ndarray) -> np.ndarray:
        start = self.start[terms]
        size = self.start[terms + 1] - start
        at = _ranges(start, size)
        return np.bincount(self.example[at], weights=np.repeat(weight, size) * self.impact[at], minlength=self.n)

    def nearest(self, bounds: np.ndarray, term: np.ndarray, weight: np.ndarray, k: int = K) -> list[tuple[np.ndarray, np.ndarray]]:
        """Exact k nearest examples (numbers, cosines > 0), best first, of each vector bounds[i] .. bounds[i + 1].

        Vectors that look alike are searched together, as they need the same blocks.
        """
        out: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0))] * (len(bounds) - 1)
        if not self.n:
            return out
        cells = list(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
        likely = [(self._common(cells[a : a + BATCH], term, weight) @ self.most).argmax(axis=1) for a in range(0, len(cells), BATCH)]
        order = np.argsort(np.concatenate(likely), kind="stable").tolist() if likely else []
        for a in range(0, len(order), BATCH):
            some = order[a : a + BATCH]
            for i, found in zip(some, self._batch([cells[i] for i in some], term, weight, k), strict=True):
                out[i] = found
        return out

    def _common(self, cells: list[tuple[int, int]], term: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Weights of the dense terms, a row for each vector."""
        q = np.zeros((len(cells), len(self.dense)), dtype=np.float32)
        for i, (lo, hi) in enumerate(cells):
            place = self.place[term[lo:hi]]
            q[i, place[place >= 0]] = weight[lo:hi][place >= 0]
        return q

    def _batch(self, cells: list[tuple[int, int]], term: np.ndarray, weight: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        m, blocks = len(cells), self.most.shape[1]
        q = self._common(cells, term, weight)
        near = np.empty((m, self.n), dtype=np.float32)
        for i, (lo, hi) in enumerate(cells):
            near[i] = self._short_lists(term[lo:hi], weight[lo:hi])
        bound = np.maximum.reduceat(near, np.arange(0, self.n, BLOCK), axis=1) + q @ self.most
        done = np.zeros(blocks, dtype=bool)

        def work_out(which: np.ndarray) -> None:
            # runs of blocks, as views; a gap of a few blocks costs less than a new run
            todo = np.flatnonzero(which & ~done)
            breaks = np.flatnonzero(np.diff(todo) > GAP) + 1
            for run in np.split(todo, breaks) if len(todo) else []:
                a = run[0]
                while a <= run[-1]:
                    z = a + 1
                    while z <= run[-1] and not done[z]:
                        z += 1
                    near[:, a * BLOCK : z * BLOCK] += q @ self.dense[:, a * BLOCK : z * BLOCK]
                    done[a:z] = True
                    while z <= run[-1] and done[z]:
                        z += 1
                    a = z

        few = min(max(FIRST, -(-k // BLOCK)), blocks)
        best = np.argpartition(-bound, few - 1, axis=1)[:, :few]
        which = np.zeros(blocks, dtype=bool)
        which[best.ravel()] = True
        work_out(which)
        at = (best[:, :, None] * BLOCK + np.arange(BLOCK)).reshape(m, -1)
        found = np.where(at < self.n, np.take_along_axis(near, np.minimum(at, self.n - 1), axis=1), -1.0)
        kth = min(k, found.shape[1])
        floor = -np.partition(-found, kth - 1, axis=1)[:, kth - 1] - MARGIN
        live = bound >= floor[:, None] - MARGIN
        work_out(live.any(axis=0))
        for i, (lo, hi) in enumerate(cells):
            # what reaches the floor was worked out, as its block's bound reaches it too
            ids = np.flatnonzero(near[i] >= floor[i])
            if len(ids) > k:
                sums = near[i, ids]
                ids = ids[sums >= np.partition(sums, len(ids) - k)[len(ids) - k] - MARGIN]
            cosine = self.cosines(ids, term[lo:hi], weight[lo:hi])
            ids, cosine = ids[cosine > 0], cosine[cosine > 0]
            # rounding keeps equal vectors equal whatever the order of summation
            keep = np.lexsort((self.by_id[ids], -np.round(cosine, 12)))[:k]
            yield ids[keep], cosine[keep]

    def vote(self, ids: np.ndarray, cosine: np.ndarray) -> float:
        w = np.minimum(cosine, 1.0) ** 2
        return float((w @ self.label[ids] + SHRINK * self.prior) / (w.sum() + SHRINK))

    def calibrated(self, vote: float) -> float:
        a, b = self.scale
        vote = min(max(vote, 1e-9), 1 - 1e-9)
        return 1 / (1 + math.exp(-min(max(a * math.log(vote / (1 - vote)) + b, -40.0), 40.0)))


def fit_scale(vote: np.ndarray, y: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Slope and offset on the votes' log odds by logistic loss with Platt's targets."""
    good, bad = int(y.sum()), int(len(y) - y.sum())
    if not good or not bad:
        return 1.0, 0.0
    z = np.log(vote.clip(1e-9, 1 - 1e-9) / (1 - vote.clip(1e-9, 1 - 1e-9)))
    x = np.stack((z, np.ones(len(z))), axis=1)
    target = np.where(y == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    w = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ w).clip(-40, 40)))
        step = np.linalg.solve((x.T * (p * (1 - p) + 1e-12)) @ x + 1e-6 * np.eye(2), x.T @ (p - target))
        w = w - step * min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-10:
            break
    return (float(w[0]), float(w[1])) if w[0] > 0 else (1.0, 0.0)


def _numbered(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct hashes, the number of each hash in them), one range of hashes at a time."""
    part = (h >> np.uint64(60)).astype(np.uint8)
    number, distinct, known = np.empty(len(h), dtype=np.int32), [np.zeros(0, np.uint64)], 0
    for r in range(16):
        at = np.flatnonzero(part == r)
        own, back = np.unique(h[at], return_inverse=True)
        number[at] = known + back
        distinct.append(own)
        known += len(own)
    return np.concatenate(distinct), number


def build(texts: list[tuple[object, int, np.ndarray, np.ndarray]], evidence: dict[str, float], calibrate: int = CALIBRATED) -> Index:
    """The index of examples (id, label, word hashes, counts), whatever their order; takes the list apart."""
    prior = sum(t[1] for t in texts) / len(texts) if texts else 0.0
    empty = [t[1] for t in texts if not len(t[2])]
    without = sum(empty) / len(empty) if empty else prior
    rows = sorted((t for t in texts if len(t[2])), key=lambda t: t[:2])
    texts.clear()
    n, size = len(rows), np.array([len(t[2]) for t in rows], dtype=np.int64)
    label, ids = np.array([t[1] for t in rows], dtype=float), [t[0] for t in rows]
    count = np.concatenate([t[3] for t in rows] or [np.zeros(0)]).astype(np.uint32)
    h = np.concatenate([t[2] for t in rows] or [np.zeros(0, np.uint64)])
    del rows
    hashes, term = _numbered(h)
    del h
    idf = np.log((2 + n) / (1 + np.bincount(term, minlength=len(hashes))))
    for s in slices(pa.array(list(evidence), pa.string()), ALNUM):
        idf[np.searchsorted(hashes, s.hashes(True))] *= 1 + np.array(list(evidence.values()))[s.first : s.first + s.n_docs]
    first = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
    index = Index(hashes, idf, first, term, count, label, ids, np.arange(n), prior, without)
    # number the examples anew, similar ones together
    order = _similar_first(index.dense.T)
    at = _ranges(first[order], size[order])
    first = np.concatenate(([0], np.cumsum(size[order]))).astype(np.int64)
    del index
    term, count = term[at], count[at]
    del at
    index = Index(hashes, idf, first, term, count, label[order], [ids[i] for i in order], order, prior, without)
    # votes on some examples, each by the others
    some = np.sort(np.argsort(order)[:: max(1, -(-n // max(calibrate, 1)))]) if n > 1 else np.zeros(0, np.int64)
    bounds = np.concatenate(([0], np.cumsum(index.first[some + 1] - index.first[some])))
    at = _ranges(index.first[some], index.first[some + 1] - index.first[some])
    votes = []
    for i, (ids, cosine) in zip(some.tolist(), index.nearest(bounds, index.term[at], index.weight[at].astype(float), K + 1), strict=True):
        others = ids != i
        votes.append(index.vote(ids[others][:K], cosine[others][:K]))
    index.scale = fit_scale(np.array(votes), index.label[some])
    index.__dict__.pop("_query", None)
    return index


@dataclass
class Fitted:
    """An index as the task that built it sent it; unpacked once in each process that uses it."""

    data: bytes

    @cached_property
    def index(self) -> Index:
        return pickle.loads(self.data)

    def __getstate__(self) -> dict:
        return {"data": self.data}


def fit(docs: DataFrame, labels: DataFrame, label: str, learn: Column, max_examples: int = MAX_EXAMPLES) -> Fitted:
    """Choose examples and build their index in one task.

    It holds the distinct words of at most max_examples texts; the driver gets
    the packed index only.
    """
    chosen = stored(labelled_examples(docs, labels, label, learn, max_examples), "examples")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in slices(b.column(1), ALNUM):
                doc, h, count = _cells(s)
                cut = np.searchsorted(doc, np.arange(s.n_docs + 1)).tolist()
                cells = [[x[a:z].tobytes() for a, z in zip(cut[:-1], cut[1:], strict=True)] for x in (h, count.astype(np.uint32))]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(s.first, s.n_docs), b.column(2).slice(s.first, s.n_docs).cast(pa.int32()), *[pa.array(c, pa.binary()) for c in cells]], names=["doc_id", "y", "h", "c"])

    evidence = telling(chosen)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_memory()
        texts: list[tuple] = []
        for b in batches:
            texts += [(i, y, np.frombuffer(h, np.uint64), np.frombuffer(c, np.uint32)) for i, y, h, c in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(build(texts, evidence))], pa.binary())], names=["data"])

    words = stored(chosen.mapInArrow(run, f"doc_id {kind}, y int, h binary, c binary"), "example-words")
    return Fitted(bytes(words.coalesce(1).mapInArrow(make, "data binary").first()["data"]))


EVIDENCE = T.ArrayType(T.StructType().add("example", "string").add("cosine", "double").add("label", "integer"))


def score(docs: DataFrame, fitted: Fitted, columns: list[str], k: int = K, evidence: bool = False) -> DataFrame:
    """The given columns with `_swident_score`, and with `_swident_evidence` if asked for.

    Evidence lists the neighbours: example id as text, cosine and label.
    """
    text_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(fitted)  # bounded by max_examples
    kept = docs.select(*columns) if "text" in columns else docs.select(*columns, F.col("text").alias("_swident_text"))
    text_at, n = (columns.index("text") if "text" in columns else len(columns)), len(columns)
    schema = docs.select(*columns).schema.add("_swident_score", "double")
    if evidence:
        schema = schema.add("_swident_evidence", EVIDENCE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = sent.value.index
        names = pa.array([str(i) for i in ix.ids], pa.string()) if evidence else None
        for b in batches:
            for s in slices(b.column(text_at), ALNUM):
                out = np.full(s.n_docs, ix.without)
                count, which, cosines = np.zeros(s.n_docs, dtype=np.int64), [np.zeros(0, np.int64)], [np.zeros(0)]
                who, bounds, term, weight = ix.vectors(s)
                for d, (ids, cosine) in zip(who.tolist(), ix.nearest(bounds, term, weight, k), strict=True):
                    if len(ids):
                        out[d] = ix.calibrated(ix.vote(ids, cosine))
                        count[d] = len(ids)
                        which.append(ids)
                        cosines.append(cosine)
                made = [b.column(i).slice(s.first, s.n_docs) for i in range(n)] + [pa.array(out)]
                if evidence:
                    ids = np.concatenate(which)
                    cells = [names.take(pa.array(ids)), pa.array(np.concatenate(cosines)), pa.array(ix.label[ids].astype(np.int32))]
                    offsets = pa.array(np.concatenate(([0], np.cumsum(count))).astype(np.int32))
                    made.append(pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(cells, names=["example", "cosine", "label"])))
                yield pa.RecordBatch.from_arrays(made, names=schema.names)

    return kept.mapInArrow(run, schema)
