"""Quality rules: text counts and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed word uni- and bigrams are counted, one over the
trusted target and one over the whole raw corpus.  A document's score is the
sum of log(p_target / p_raw) over its n-grams divided by their number, with the
document's own n-grams left out of both counts, so that trusted documents and
others are measured alike and rare n-grams don't speak for themselves.  It is
kept if the score reaches a fixed threshold and the base rules pass.

Results for odd inputs: a null or empty text has no words, all counts 0, score
0.0, base_failed true and kept false.  Repeated rows give one result each.  An
empty corpus gives an empty result; without trusted documents every ratio is 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import small_side
from .words import SPACED, Slice, batch_of, grams, slices

BUCKETS = 1 << 16
PRIOR = 4.0
#: Rows that one partition sends for its counts: each holds a part of the buckets.
PARTS = 64
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", dtype=np.uint8))


def _features(s: Slice, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and document of each uni- and bigram of a slice."""
    h = s.hashes(fold_case=False)
    pair = grams(h, 2)
    same = s.doc[1:] == s.doc[:-1]
    mask = np.uint64(buckets - 1)
    bucket = np.concatenate((h & mask, pair[same] & mask)).astype(np.int64)
    return bucket, np.concatenate((s.doc, s.doc[1:][same]))


def ngram_counts(docs: DataFrame, trusted: str, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(target, raw) counts per bucket over all documents.

    docs has `text` and the boolean column named by `trusted`.  Each partition
    sends one fixed-size array of counts, cut in PARTS rows, which are added up
    by part; the driver gets 2 * buckets numbers whatever the corpus.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, buckets), dtype=np.int64)
        for b in batches:
            good = np.asarray(b.column(1).fill_null(False))
            for s in slices(b.column(0), SPACED):
                bucket, doc = _features(s, buckets)
                total[1] += np.bincount(bucket, minlength=buckets)
                total[0] += np.bincount(bucket[good[s.first + doc]], minlength=buckets)
        if total[1].any():
            rows = total.reshape(2, PARTS, -1).transpose(1, 0, 2)
            yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array([r.tobytes() for r in rows], pa.binary())], names=["part", "counts"])

    def add(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in parts:
            for x in b.column(1):
                a = np.frombuffer(x.as_buffer(), dtype=np.int64)
                total = a.copy() if total is None else total + a
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "counts"])

    rows = docs.select("text", trusted).mapInArrow(count, "part int, counts binary").groupBy("part").applyInArrow(add, "part int, counts binary").collect()
    out = np.zeros((2, buckets), dtype=np.int64)
    for r in rows:
        width = buckets // PARTS
        out[:, r["part"] * width : (r["part"] + 1) * width] = np.frombuffer(r["counts"], dtype=np.int64).reshape(2, -1)
    return out[0], out[1]


def ratios(bucket: np.ndarray, doc: np.ndarray, trusted: np.ndarray, target: np.ndarray, raw: np.ndarray, prior: float = PRIOR) -> np.ndarray:
    """Mean log(p_target / p_raw) of each document's n-grams, itself left out.

    bucket and doc list the n-grams; trusted tells which documents the target
    counts hold.  p_target has `prior` pseudo-counts per bucket at the raw rate,
    so buckets with few counts lean to a ratio of 1.
    """
    size = np.bincount(doc, minlength=len(trusted)).astype(float)
    if not target.sum():
        return np.zeros(len(trusted))
    cell, own = np.unique(doc * len(raw) + bucket, return_counts=True)
    d, k = np.divmod(cell, len(raw))
    mine = np.where(trusted, size, 0.0)
    share = (target.sum() - mine) / np.maximum(raw.sum() - size, 1)
    expected = (raw[k] - own) * share[d]
    log = np.log((target[k] - np.where(trusted[d], own, 0) + prior) / (expected + prior))
    return np.bincount(d, weights=own * log, minlength=len(trusted)) / np.maximum(size, 1)


def _base_counts(s: Slice) -> dict[str, np.ndarray]:
    n = s.n_docs
    words = np.diff(s.bounds)
    chars = ~((s.buf & 0xC0) == 0x80)  # first byte of each code point
    inside = np.zeros(len(s.buf) + 1, dtype=np.int8)
    np.add.at(inside, s.start, 1)
    np.add.at(inside, s.end, -1)
    in_word = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    h = s.hashes(fold_case=False)
    # windows of three words within a document, found twice or more in it
    repeat = np.zeros(n, dtype=np.int64)
    three = grams(h, 3)
    dup_lines = np.zeros(n, dtype=np.int64)
    for i in range(n):
        a, b = int(s.bounds[i]), int(s.bounds[i + 1])
        if b - a >= 4:
            _, inverse, count = np.unique(three[a : b - 2], return_inverse=True, return_counts=True)
            hit = np.flatnonzero(count[inverse] > 1)
            if len(hit):
                cover = np.zeros(b - a, dtype=bool)
                for j in range(3):
                    cover[hit + j] = True
                repeat[i] = cover.sum()
        if b > a:
            lines = s.buf[s.doc_start[i] : s.doc_end[i]].tobytes().split(b"\n")
            if len(lines) > 1:
                kept = [x for x in lines if x.strip(b" \t\r\x0b\x0c")]
                dup_lines[i] = len(kept) - len(set(kept))
    return {"n_words": words, "word_chars": s.cuts(chars & in_word), "n_symbols": s.cuts(SYMBOLS[s.buf]), "n_dup_lines": dup_lines, "n_repeat_words": repeat}


SCHEMA = pa.schema([("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("llr", pa.float64())])


def apply_rules(docs: DataFrame, trusted: str, target: np.ndarray, raw: np.ndarray, min_llr: float, key: str = "doc_id", min_words: int = 50, max_repeat_percent: int = 50) -> DataFrame:
    """One row per row of docs: key, counts, base_failed, kept and llr."""
    kind = docs.schema[key].dataType.simpleString()

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = np.asarray(b.column(2).fill_null(False))
            for s in slices(b.column(1), SPACED):
                c: dict[str, object] = dict(_base_counts(s))
                llr = ratios(*_features(s, len(raw)), good[s.first : s.first + s.n_docs], target, raw)
                failed = (c["n_words"] < min_words) | (100 * c["n_repeat_words"] > max_repeat_percent * c["n_words"])
                c |= {"base_failed": failed, "kept": ~failed & (llr >= min_llr), "llr": llr}
                made = batch_of(c, SCHEMA)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(s.first, s.n_docs), *made.columns], names=[key, *SCHEMA.names])

    return docs.select(key, "text", trusted).mapInArrow(rate, f"{key} {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, llr double")


def quality_rules(docs: DataFrame, trusted_ids: DataFrame, min_llr: float = -0.1, buckets: int = BUCKETS) -> DataFrame:
    """Score and threshold every row of docs(doc_id, text).

    trusted_ids(doc_id): the documents of the trusted target; repeated ids count
    once and ids that no document has are ignored.
    """
    ids = trusted_ids.select(F.col("doc_id").alias("_trusted_id")).where("_trusted_id is not null").distinct()
    marked = docs.select("doc_id", "text").join(small_side(ids), F.col("doc_id") == F.col("_trusted_id"), "left").select("doc_id", "text", F.col("_trusted_id").isNotNull().alias("_trusted"))
    target, raw = ngram_counts(marked, "_trusted", buckets)
    return apply_rules(marked, "_trusted", target, raw, min_llr)
