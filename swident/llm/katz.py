"""Katz backoff bigram model over words, counted and scored block by block.

Tokens are a text's words (A-Z lowered) and one end; the end is also the context
of the first token.  Every learnt word is a word of its own, as context and as
predicted word; all unseen words are one open class.  A token's probability is
evaluated from the longest n-gram down:

* P(v | u) = d(c) * c / (c(u) + 1) for a bigram counted c times, else
  alpha(u) * P(v).
* P(v) = d'(c) * c / N for a word counted c times, else what is left of 1, which
  is the open class.

d and d' are Good-Turing's discounts of counts up to 5, of bigrams and of words.
alpha(u) is exactly what the bigrams of u leave divided by P of the words not seen
after u, so every context's probabilities sum to 1.  c(u) + 1 counts one event
more than was seen: every context leaves some mass, though none of its counts be
discounted; where no word count is discounted, the open class has one event too.

Every token of every learning text is counted.  Words and bigrams are known by
64-bit hashes.  A block of texts sends each of its distinct words and bigrams
once, with its count in the block, to the task that owns the hash range, so no
frequent one gathers in a task.  The owner adds the counts up, answers each
block in the order of its hashes, and names one block per bigram that stands for
it.  The blocks then add up what their bigrams take from each context and send
it to the context's owner, who answers with backoff weights to the blocks that
have unseen bigrams.  The driver gets the counts of counts and the totals only.
Counts and weights are tables partitioned by kind, in rows of a hash range.

Odd inputs: a null or empty text is one end token; without learning texts the
counts are 0, base_score is -n_tokens * log10(N + V + 1) = 0.0 and the score
gives the end and the open class one half each; repeated rows are scored each,
and count as often as they occur; an empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import new_path, stored
from .words import SPACED, grams, joined, lean_memory, planes, slices

CUT = 5  # counts above it are not discounted
END = np.uint64(0x9D39247E33776D41)  # in place of a word hash
BLOCK_TOKENS, BLOCK_DOCS = 1_000_000, 32_768
PART_TOKENS = 2_000_000
TOKEN_BYTES = 6  # of text or so, for the number of parts
U = np.uint64
_NAMES = ["p", "kind", "block", "x", "y", "z", "s", "ids"]
# kinds of rows: a block's texts; uses of words and of bigrams; a part's totals;
# what a block's bigrams take from contexts; contexts of unseen bigrams
TEXTS, WORDS, PAIRS, TOTALS, TAKEN, ASKED = range(6)


def _steps(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=x.dtype.type(0))


def _rows(docs: DataFrame) -> str:
    return f"p int, kind int, block long, x binary, y binary, z binary, s array<double>, ids array<{docs.schema['doc_id'].dataType.simpleString()}>"


def _batches(rows: list[tuple], ids: pa.DataType, size: int = 32) -> Iterator[pa.RecordBatch]:
    """Rows (p, kind, block, x, y, z, s) without ids."""
    for i in range(0, len(rows), size):
        p, kind, block, x, y, z, s = zip(*rows[i : i + size], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(kind, pa.int32()), pa.array(block, pa.int64()), pa.array(x, pa.binary()), pa.array(y, pa.binary()), pa.array(z, pa.binary()), pa.array(s, pa.list_(pa.float64())), pa.nulls(len(p), ids)], names=_NAMES)


def _cut(h: np.ndarray, log_parts: int) -> list[tuple[int, int, int]]:
    """(part, from, to) of the parts that sorted hashes fall into."""
    at = np.searchsorted(h, np.arange(1 << log_parts, dtype=U) << U(64 - log_parts)).tolist() + [len(h)]
    return [(p, at[p], at[p + 1]) for p in range(1 << log_parts) if at[p + 1] > at[p]]


@dataclass
class Totals:
    """The figures of the whole learning corpus."""

    ends: int
    n: int  # learning tokens
    v: int  # distinct learning tokens
    discount: np.ndarray  # of bigrams counted 1 .. CUT times
    own: np.ndarray  # of words counted 1 .. CUT times
    unseen: float  # probability of the open class
    full: bool = False  # no word count is discounted

    @property
    def base_log(self) -> float:
        return math.log10(self.n + self.v + 1)

    def word(self, count: np.ndarray, is_end: np.ndarray) -> np.ndarray:
        """P of words by their counts; an end that was never met counts once."""
        ratio = np.concatenate(([1.0], self.own, [1.0]))
        c = np.where(is_end, np.maximum(count, 1), count)
        return np.where(c > 0, ratio[np.minimum(c, CUT + 1).astype(np.int64)] * c / max(self.n, 1) * self.kept, self.unseen)

    @property
    def kept(self) -> float:
        """What the open class leaves to words beyond their discounts."""
        return self.n / (self.n + 1) if self.full else 1.0


def totals_of(pairs: np.ndarray, words: np.ndarray, ends: int, n: int, v: int) -> Totals:
    """Totals from the counts of counts (1 .. CUT + 1) of bigrams and of words."""
    if not n:  # the end alone, counted once
        words = np.eye(CUT + 1)[0]
    own = discounts(words)
    left = float((words[:CUT] * np.arange(1, CUT + 1) * (1 - own)).sum()) / max(n, 1)
    return Totals(ends, n, v, discounts(pairs), own, left or 1 / (n + 1), full=not left)


def _pairs(hashes: np.ndarray, stream: np.ndarray) -> np.ndarray:
    """The bigram hash of each token of a block; the block begins after an end."""
    return grams(np.concatenate(([END], hashes[stream])), 2)


def _texts(docs: DataFrame, learn: Column) -> DataFrame:
    """Blocks of texts as numbers of the block's words, the most frequent first."""

    def block_rows(number: int, ids: list, trained: list, sizes: list, tokens: list) -> Iterator[pa.RecordBatch]:
        size, own = np.concatenate(sizes), np.concatenate(trained)
        h, stream = np.unique(np.concatenate(tokens), return_inverse=True)
        whole = pa.concat_arrays(ids)
        texts = [pa.array([0], pa.int32()), pa.array([TEXTS], pa.int32()), pa.array([number], pa.int64())]
        # small numbers for frequent words compress well
        order = np.argsort(-np.bincount(stream), kind="stable")
        rank = np.empty(len(order), dtype=np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        texts += [pa.array([zlib.compress(b, 1)], pa.binary()) for b in (planes(rank[stream]), size.astype(np.uint32).tobytes() + own.astype(np.uint8).tobytes(), planes(_steps(h)) + rank.tobytes())]
        yield pa.RecordBatch.from_arrays([*texts, pa.nulls(1, pa.list_(pa.float64())), pa.array([whole.to_pylist()], pa.list_(whole.type))], names=_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        held: tuple[list, list, list, list] = ([], [], [], [])
        n_docs = n_tokens = 0
        for b in batches:
            learnt = np.asarray(b.column(2).fill_null(False))
            for s in slices(b.column(1), SPACED):
                h = s.hashes(True)
                for a in range(0, s.n_docs, BLOCK_DOCS):
                    z = min(a + BLOCK_DOCS, s.n_docs)
                    if n_docs and (n_docs + z - a > BLOCK_DOCS or n_tokens > BLOCK_TOKENS):
                        yield from block_rows(number, *held)
                        number += 1
                        held, n_docs, n_tokens = ([], [], [], []), 0, 0
                    size = np.diff(s.bounds[a : z + 1]) + 1
                    # words and ends in one row of tokens, document after document
                    ends = np.cumsum(size) - 1
                    token = np.full(int(ends[-1]) + 1, END)
                    is_word = np.ones(len(token), dtype=bool)
                    is_word[ends] = False
                    token[is_word] = h[int(s.bounds[a]) : int(s.bounds[z])]
                    for out, x in zip(held, (b.column(0).slice(s.first + a, z - a), learnt[s.first + a : s.first + z], size, token), strict=True):
                        out.append(x)
                    n_docs += z - a
                    n_tokens += len(token)
        if n_docs:
            yield from block_rows(number, *held)

    return docs.select("doc_id", "text", learn.alias("_learn")).mapInArrow(run, _rows(docs))


def _block(b: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(sorted word hashes, tokens as their places, tokens of each text, whether it is learnt) of a stored block."""
    x, y, z = (zlib.decompress(b.column(k)[i].as_py()) for k in (3, 4, 5))
    m, n = len(z) // 12, len(y) // 5
    place = np.empty(m, dtype=np.int64)
    place[np.frombuffer(z, np.uint32, m, 8 * m)] = np.arange(m)
    return np.cumsum(joined(z[: 8 * m], U), dtype=U), place[joined(x, np.uint32)], np.frombuffer(y, np.uint32, n).astype(np.int64), np.frombuffer(y, np.uint8, n, 4 * n)


def _uses(texts: DataFrame, log_parts: int, schema: str) -> DataFrame:
    """Each block's distinct words and bigrams with their counts in its learning texts, for their owners."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_memory()
        for b in batches:
            for i, block in enumerate(b.column(2).to_pylist()):
                h, stream, size, own = _block(b, i)
                learnt = np.repeat(own, size).astype(float)
                pair, at = np.unique(_pairs(h, stream), return_inverse=True)
                for kind, key, which in ((WORDS, h, stream), (PAIRS, pair, at)):
                    count = np.bincount(which, weights=learnt, minlength=len(key)).astype(np.uint32)
                    made = [(p, kind, block, planes(_steps(key[a:z])), planes(count[a:z]), b"", None) for p, a, z in _cut(key, log_parts)]
                    yield from _batches(made, b.column(7).type)

    return texts.mapInArrow(run, schema)


def _counts(uses: DataFrame, schema: str) -> DataFrame:
    """Owners of hash ranges: the whole count of each use, in the order asked, and the part's totals.

    Of the blocks that use a bigram, one has its bit set: it stands for the bigram.
    """

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_memory()
        part, made, ids = key[0].as_py(), [], pa.list_(pa.int64())
        held: dict[int, list[tuple]] = {WORDS: [], PAIRS: []}
        for b in batches:
            ids = b.column(7).type
            for kind, block, x, y in zip(*(b.column(k).to_pylist() for k in (1, 2, 3, 4)), strict=True):
                held[kind].append((block, np.cumsum(joined(x, U), dtype=U), joined(y, np.uint32)))
        for kind, uses_ in held.items():
            if not uses_:
                continue
            h = np.concatenate([r[1] for r in uses_])
            order = np.argsort(h, kind="stable")
            first = np.flatnonzero(np.concatenate(([True], np.diff(h[order]) != 0)))
            c = np.add.reduceat(np.concatenate([r[2] for r in uses_]).astype(U)[order], first)
            at = np.empty(len(h), dtype=np.int64)  # use -> its distinct hash
            at[order] = np.repeat(np.arange(len(first)), np.diff(np.concatenate((first, [len(h)]))))
            stands = np.zeros(len(h), dtype=bool)
            stands[order[first]] = True
            of_counts = [int((c == r).sum()) for r in range(1, CUT + 2)]
            if kind == WORDS:
                sums = [0] * (CUT + 1) + of_counts + [int(c[h[order[first]] == END].sum()), int(c.sum()), int((c > 0).sum())]
            else:
                sums = of_counts + [0] * (CUT + 4)
            made.append((part, TOTALS, -1, b"", b"", b"", [float(x) for x in sums]))
            a = 0
            for block, x, _ in uses_:
                made.append((part, kind, block, planes(c[at[a : a + len(x)]]), np.packbits(stands[a : a + len(x)]).tobytes() if kind == PAIRS else b"", b"", None))
                a += len(x)
        yield from _batches(made, ids)

    return uses.groupBy("p").applyInArrow(run, schema)


def _blocks(rows: DataFrame, told: object, log_parts: int, schema: str) -> DataFrame:
    """Each block's sums per document but for backoff weights, what its bigrams take from contexts, and the contexts it asks for."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_memory()
        t, block = told.value, key[0].as_py()
        counts: dict[int, list[tuple]] = {WORDS: [], PAIRS: []}
        for b in batches:
            for i, kind in enumerate(b.column(1).to_pylist()):
                if kind == TEXTS:
                    h, stream, size, _ = _block(b, i)
                    ids = b.column(7).slice(i, 1)
                else:
                    c = joined(b.column(3)[i].as_py(), U)
                    counts[kind].append((b.column(0)[i].as_py(), c, np.unpackbits(np.frombuffer(b.column(4)[i].as_py(), np.uint8), count=len(c)) if kind == PAIRS else None))
        c = np.concatenate([r[1] for r in sorted(counts[WORDS], key=lambda r: r[0])]).astype(float)
        counts[PAIRS].sort(key=lambda r: r[0])
        pair_c = np.concatenate([r[1] for r in counts[PAIRS]]).astype(np.int64)
        stands = np.concatenate([r[2] for r in counts[PAIRS]]) > 0
        p = t.word(c, h == END)
        log_p, log_c = np.log10(p), np.log10(c + 1)
        before = np.concatenate(([np.searchsorted(h, END)], stream[:-1]))
        _, first, at = np.unique(_pairs(h, stream), return_index=True, return_inverse=True)
        seen = pair_c > 0
        ratio = np.concatenate(([1.0], t.discount, [1.0]))
        log_pair = np.log10(np.maximum(pair_c, 1) * ratio[np.minimum(pair_c, CUT + 1)])
        new = ~seen[at]
        value = np.where(new, log_p[stream], log_pair[at] - log_c[before])
        doc = np.repeat(np.arange(len(size)), size)
        add = lambda w: np.bincount(doc, weights=w, minlength=len(size))
        info = np.stack((size, add((c > 0)[stream]), add(log_c[stream]) - size * t.base_log, add(value))).astype(float)
        # a context that is not learnt has the backoff weight 1
        asks = np.flatnonzero(new & (c > 0)[before])
        asked, number = np.unique(h[before[asks]], return_inverse=True)
        texts = [pa.array([0], pa.int32()), pa.array([TEXTS], pa.int32()), pa.array([block], pa.int64())]
        texts += [pa.array([x], pa.binary()) for x in (info.tobytes(), planes(number.astype(np.uint32)), planes(doc[asks].astype(np.uint16)))]
        yield pa.RecordBatch.from_arrays([*texts, pa.nulls(1, pa.list_(pa.float64())), ids], names=_NAMES)
        made = [(part, ASKED, block, planes(_steps(asked[a:z])), b"", b"", None) for part, a, z in _cut(asked, log_parts)]
        one = np.flatnonzero(seen & stands)
        u, v, k = before[first[one]], stream[first[one]], pair_c[one]
        context, where, ui = np.unique(h[u], return_index=True, return_inverse=True)
        few = np.stack([np.bincount(ui, weights=k == r, minlength=len(context)) for r in range(1, CUT + 1)]).astype(np.uint32)
        used, mass = (np.bincount(ui, weights=w, minlength=len(context)) for w in (k, p[v]))
        for part, a, z in _cut(context, log_parts):
            rest = np.stack((used[a:z], c[u[where[a:z]]], mass[a:z]))
            made.append((part, TAKEN, block, planes(_steps(context[a:z])), planes(few[:, a:z].ravel()), planes(rest.ravel()), None))
        yield from _batches(made, ids.type)

    return rows.groupBy("block").applyInArrow(run, schema)


def _weights(rows: DataFrame, told: object, schema: str) -> DataFrame:
    """Owners of contexts: log backoff weights in the order asked."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_memory()
        part, ids = key[0].as_py(), pa.list_(pa.int64())
        taken, asked = [], []
        for b in batches:
            ids = b.column(7).type
            for kind, block, x, y, z in zip(*(b.column(k).to_pylist() for k in (1, 2, 3, 4, 5)), strict=True):
                h = np.cumsum(joined(x, U), dtype=U)
                if kind == ASKED:
                    asked.append((block, h))
                else:
                    taken.append((h, joined(y, np.uint32).reshape(CUT, -1), joined(z, np.float64).reshape(3, -1)))
        h, log_alpha = np.zeros(1, U), np.zeros(1)
        if taken:
            h, at = np.unique(np.concatenate([r[0] for r in taken]), return_inverse=True)
            add = lambda w: np.bincount(at, weights=w, minlength=len(h))
            few = np.concatenate([r[1] for r in taken], axis=1)
            used, weight, mass = np.concatenate([r[2] for r in taken], axis=1)
            count = np.zeros(len(h))
            count[at] = weight
            off = sum(add(few[r - 1]) * r * (1 - told.value.discount[r - 1]) for r in range(1, CUT + 1))
            left = 1 - (add(used) - off) / (count + 1)
            # both are positive: c(u) + 1 exceeds what is used, and the open class is never seen
            log_alpha = np.log10(left / (1 - add(mass)))
        made = []
        for block, x in asked:
            i = np.minimum(np.searchsorted(h, x), len(h) - 1)
            made.append((part, ASKED, block, np.where(h[i] == x, log_alpha[i], 0.0).tobytes(), b"", b"", None))
        yield from _batches(made, ids)

    return rows.groupBy("p").applyInArrow(run, schema)


def discounts(n: np.ndarray) -> np.ndarray:
    """Good-Turing discount ratios for counts 1..CUT from counts of counts 1..CUT + 1.

    Where a ratio can't be formed or leaves (0, 1], half a count is taken off.
    """
    r = np.arange(1, CUT + 1)
    half = (r - 0.5) / r
    if not n[0]:
        return half
    with np.errstate(divide="ignore", invalid="ignore"):
        star = (r + 1) * n[1:] / n[:-1]
        tail = (CUT + 1) * n[CUT] / n[0]
        d = (star / r - tail) / (1 - tail)
    return np.where((d > 0) & (d <= 1) & np.isfinite(d), d, half)


def score(docs: DataFrame, learn: Column) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score per row of docs.

    learn is a condition on doc_id that picks the learning rows.
    """
    spark = docs.sparkSession
    learn = F.coalesce(learn, F.lit(False))
    # parts grow with the corpus: a power of two with PART_TOKENS tokens each or so
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    log_parts = max(6, min(18, math.ceil(math.log2(max(size, 1) / TOKEN_BYTES / PART_TOKENS))))
    schema = _rows(docs)

    def kept(df: DataFrame, name: str) -> DataFrame:
        path = new_path(spark, name)
        df.write.partitionBy("kind").parquet(path)
        columns = schema.replace(" kind int,", "") + ", kind int"
        return spark.read.schema(columns).parquet(path).select(*_NAMES)

    stored_texts = stored(_texts(docs, learn), "katz-texts")
    counts = kept(_counts(_uses(stored_texts, log_parts, schema), schema), "katz-counts")
    found = counts.where(F.col("kind") == TOTALS).agg(*[F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(2 * CUT + 5)]).first()
    sums = np.array([x or 0.0 for x in found])
    totals = totals_of(sums[: CUT + 1], sums[CUT + 1 : 2 * CUT + 2], *(int(x) for x in sums[2 * CUT + 2 :]))
    told = spark.sparkContext.broadcast(totals)
    texts = stored_texts.unionByName(counts.where(F.col("kind").isin(WORDS, PAIRS)))
    blocks = kept(_blocks(texts, told, log_parts, schema), "katz-blocks")
    weights = _weights(blocks.where(F.col("kind").isin(TAKEN, ASKED)), told, schema)
    n = totals.n

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers: list[tuple[int, np.ndarray]] = []
        for b in batches:
            for i, kind in enumerate(b.column(1).to_pylist()):
                if kind == TEXTS:
                    x, y, z = (b.column(k)[i].as_py() for k in (3, 4, 5))
                    ids, info = b.column(7)[i].values, np.frombuffer(x).reshape(4, -1)
                    number, doc = joined(y, np.uint32), joined(z, np.uint16)
                else:
                    answers.append((b.column(0)[i].as_py(), np.frombuffer(b.column(3)[i].as_py())))
        size, known, base, logs = info
        if answers:
            log_alpha = np.concatenate([a for _, a in sorted(answers, key=lambda r: r[0])])
            logs = logs + np.bincount(doc, weights=log_alpha[number], minlength=len(size))
        yield pa.RecordBatch.from_arrays([ids, pa.array(size.astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(np.full(len(size), n)), pa.array(base), pa.array(logs)], names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    id_kind = docs.schema["doc_id"].dataType.simpleString()
    answered = blocks.where(F.col("kind") == TEXTS).unionByName(weights)
    return answered.groupBy("block").applyInArrow(run, f"doc_id {id_kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double")
