"""N-gram Jaccard join by parity sketches.

A document's set holds its distinct word shingles.  For Jaccard >= t two sets of
sizes a and b differ in at most d = (1 - t) / (1 + t) * (a + b) shingles.

Sketches: hash space is cut in m equal parts and the shingles of a part are
XORed together, so that a part's word is equal in two sketches if the part holds
the same shingles, and at most d parts can differ.  A second sketch sets one bit
per shingle by XOR: its Hamming distance never exceeds the symmetric difference.

Size bands: a band covers sizes hi / 2 < n <= hi and has its own m > d.  A
document emits keys in its own band and, if a partner 1 / t times as large would
lie in the next band, there too.  Of its m parts it emits only the d + 1 first in
an order set by the parts' content (most shingles first): the first part of that
order on which a pair agrees has at most d differing parts before it, so both
emit it, and no linking pair is missed.

Candidates: in a group of equal keys every member is compared with the group's
smallest member, its pivot.  After those links are contracted, members that met
at one pivot but are still in different components are compared by their bit
sketches within the task that holds them, in blocks of bounded bytes, and only
pairs within the Hamming bound leave it.  Every pair that may link is thus tested
or already connected.  Surviving pairs are verified on the full shingle sets.

Hot groups: a task gives a set's sketch and keys once, however many copies it
meets.  Keys that a sample of the texts shows to be frequent are dealt out over
as many tasks as they need (the sample steers where rows go, never which), and
joins on nodes or pivots with many rows broadcast the few rows of the other side.

Odd inputs: a text with fewer words than a shingle is one shingle, a text
without words has the empty set and links with nothing; equal sets are one node,
so repeated rows and copies share a component; a null doc_id is given
component_id like any other row, but never names a component unless all its
documents have null ids; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..storage import small_side, stored
from .common import text_batches
from .words import SPACED, grams, mix, slices

U = np.uint64
BLOCK_BYTES = 4 << 20  # of sketches of a pivot's members that meet at a time
HOT = 1000  # rows of a key from which on its join is a broadcast
MOST_HOT = 2000  # keys that can be hot at most
PART_ROWS = 2_500_000  # shingles whose keys go to a task
SALTED_ROWS = 250_000  # members of a hot key in a task
SAMPLE = 64  # one text in so many is looked at for hot keys
MOST_BITS = 1 << 17  # of a Hamming sketch


def _sets(column: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text."""
    for s in slices(column, SPACED):
        h = s.hashes(fold_case=True)
        g = grams(h, n)
        for i in range(s.n_docs):
            a, b = int(s.bounds[i]), int(s.bounds[i + 1])
            if b - a >= n:
                yield s.first + i, np.unique(g[a : b - n + 1])
            elif b > a:
                # a short text is one shingle, told apart by its number of words
                one = U(b - a)
                for x in h[a:b]:
                    one = mix(np.array([one], dtype=U) * U(0x9E3779B97F4A7C15) + x)[0]
                yield s.first + i, np.array([one], dtype=U)
            else:
                yield s.first + i, np.zeros(0, dtype=U)


def _fingerprint(x: np.ndarray) -> int:
    """One 64-bit value for a set of hashes."""
    if not len(x):
        return 0
    with np.errstate(over="ignore"):
        total = np.add.reduce(mix(x ^ U(0xA5A5A5A5A5A5A5A5))) + U(len(x)) * U(0xD1B54A32D192ED03)
    return int((mix(np.array([total], dtype=U)) ^ np.bitwise_xor.reduce(mix(x))).view(np.int64)[0])


def _hamming_sketch(x: np.ndarray) -> bytes:
    """Parity of the shingles at each of 4 to 8 bits per shingle, a power of two."""
    bits = min(MOST_BITS, 1 << max(7, (4 * len(x) - 1).bit_length()))
    odd = np.bincount((x & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _folded(sketches: np.ndarray, size: int) -> np.ndarray:
    """Sketches (rows of bytes) of fewer bits: halves are XORed together."""
    while sketches.shape[1] > size:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of two arrays of sketch rows of one width."""
    return np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)).sum(axis=-1, dtype=np.int64)


def _bands(n: int, t: Fraction) -> list[tuple[int, int]]:
    """(hi of the band, keys to emit) for a set of n shingles."""
    hi = 4
    while hi < n:
        hi *= 2
    largest = n * t.denominator // t.numerator  # size of the largest partner
    out = []
    for top in (hi, 2 * hi):
        if top == hi or largest > hi:
            d = (t.denominator - t.numerator) * (n + min(largest, top)) // (t.denominator + t.numerator)
            out.append((top, d + 1))
    return out


def _parts(hi: int, t: Fraction) -> int:
    """Parts of a band: more than its largest difference, with some to spare."""
    d = (t.denominator - t.numerator) * 2 * hi // (t.denominator + t.numerator)
    return d + 1 + max(d // 8, 4)


def _keys(x: np.ndarray, t: Fraction) -> np.ndarray:
    """The keys a sorted set emits; a pair with Jaccard >= t shares one."""
    out = []
    for hi, n_keys in _bands(len(x), t):
        m = _parts(hi, t)
        part = ((x >> U(32)) * U(m)) >> U(32)  # rises with x, so parts are runs
        first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        content = np.bitwise_xor.reduceat(mix(x), first)
        size = np.diff(np.concatenate((first, [len(x)])))
        key = mix(content ^ mix(part[first] * U(0x9E3779B97F4A7C15) + U(hi)))
        if len(key) > n_keys:
            order = np.lexsort((key, -size))[:n_keys]
            key = key[order]
        elif len(key) < n_keys and len(key) < m:
            # empty parts come last in the order: one key stands for each
            absent = np.setdiff1d(np.arange(m, dtype=U), part[first])[: n_keys - len(key)]
            key = np.concatenate((key, mix(absent * U(0x9E3779B97F4A7C15) + U(hi) + U(1 << 60))))
        out.append(key)
    return np.concatenate(out).view(np.int64)


class _Once:
    """True the first time a task meets a set, as far as its memory goes."""

    def __init__(self, most: int = 1_000_000) -> None:
        self.seen: set[int] = set()
        self.most = most

    def __call__(self, f: int) -> bool:
        if f in self.seen:
            return False
        if len(self.seen) < self.most:
            self.seen.add(f)
        return True


def node_table(docs: DataFrame, n: int = 5) -> DataFrame:
    """doc_id, text_key, node (the set's fingerprint; null if empty), n_shingles, sketch.

    sketch is null where the task has given it with an earlier row of the node.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = _Once()
        for b in batches:
            node, size, sketch = [None] * b.num_rows, [0] * b.num_rows, [None] * b.num_rows
            for i, x in _sets(b.column(2), n):
                if len(x):
                    node[i], size[i] = _fingerprint(x), len(x)
                    sketch[i] = _hamming_sketch(x) if once(node[i]) else None
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(node, pa.int64()), pa.array(size, pa.int64()), pa.array(sketch, pa.binary())], names=["doc_id", "text_key", "node", "n_shingles", "sketch"])

    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(run, f"doc_id {kind}, text_key long, node long, n_shingles long, sketch binary")


def hot_bar(total: int) -> int:
    """Rows from which on a key of `total` rows in all is hot: MOST_HOT keys can be at most."""
    return max(HOT, total // MOST_HOT + 1)


def hot_keys(rows: DataFrame, key: str) -> DataFrame:
    """The hot keys of a stored table, to be broadcast."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_rows"))
    return F.broadcast(counts.where(F.col("n_rows") >= hot_bar(rows.count())).select(key))


def spread_join(rows: DataFrame, table: DataFrame, key: str, hot: DataFrame, how: str = "inner") -> DataFrame:
    """rows joined with table, which has one row for each key: hot keys by broadcast, all others by shuffle."""
    few = F.broadcast(table.join(hot, key, "left_semi"))
    return rows.join(hot, key, "left_semi").join(few, key, how).unionByName(rows.join(hot, key, "left_anti").join(table, key, how))


def key_table(docs: DataFrame, threshold: Fraction, n: int = 5, tasks: dict[int, int] | None = None) -> DataFrame:
    """(key, node, salt): the keys of every distinct set, about once per task.

    Keys in `tasks` are salted by node, that is dealt out over so many tasks;
    others have the salt -1.
    """
    sent = docs.sparkSession.sparkContext.broadcast(np.array(sorted((tasks or {}).items()), dtype=np.int64).reshape(-1, 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, often = np.ascontiguousarray(sent.value.T)
        once, keys, nodes, held = _Once(), [], [], 0

        def out() -> pa.RecordBatch:
            key, node = np.concatenate(keys), np.repeat(np.array(nodes, dtype=np.int64), [len(k) for k in keys])
            salt = np.full(len(key), -1, dtype=np.int64)
            if len(hot):
                at = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
                salt = np.where(hot[at] == key, (mix(node.view(U)) % often[at].astype(U)).astype(np.int64), -1)
            return pa.RecordBatch.from_arrays([pa.array(key), pa.array(node), pa.array(salt, pa.int32())], names=["key", "node", "salt"])

        for b in batches:
            for _, x in _sets(b.column(0), n):
                if len(x) and once(f := _fingerprint(x)):
                    keys.append(_keys(x, threshold))
                    nodes.append(f)
                    held += len(keys[-1])
                    if held > 50_000:
                        yield out()
                        keys, nodes, held = [], [], 0
        if keys:
            yield out()

    return docs.select("text").mapInArrow(run, "key long, node long, salt int")


def frequent_keys(docs: DataFrame, threshold: Fraction, n: int = 5, shingles: int = 0) -> dict[int, int]:
    """Keys that are frequent in a sample of the texts, and the tasks that each needs.

    At most 100,000 keys or so: the bar rises with the shingles of all texts.
    """
    some = docs.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0)
    counts = key_table(some, threshold, n).select("key", "node").distinct().groupBy("key").agg(F.count("*").alias("n"))
    found = counts.where(F.col("n") >= max(SALTED_ROWS // SAMPLE // 16, shingles // SAMPLE // 100_000, 2)).collect()
    return {r["key"]: -(-r["n"] * SAMPLE // SALTED_ROWS) + 1 for r in found}


def _pivot_pairs(keys: DataFrame, partitions: int, salted: bool) -> DataFrame:
    """(a, b, many): each member b of a key's group with its smallest member a.

    Rows are dealt out by key and salt and sorted in each task as plain pairs; a
    task gives a pair once.  many: some group of the pair has further members.
    Salted groups, if there are any, come out as they are and get their pivots by
    a broadcast.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[b.column(i).to_numpy(zero_copy_only=False) for i in range(3)] for b in batches]
        if not held:
            return
        key, node, salt = (np.concatenate(x) for x in zip(*held, strict=True))
        del held
        hot = np.flatnonzero(salt >= 0)
        if len(hot):
            rows = np.unique(np.stack((key[hot], node[hot]), axis=1), axis=0)
            for i in range(0, len(rows), 100_000):
                part = np.ascontiguousarray(rows[i : i + 100_000].T)
                yield pa.RecordBatch.from_arrays([pa.array(part[0]), pa.nulls(part.shape[1], pa.int64()), pa.array(part[1]), pa.array(np.ones(part.shape[1], dtype=bool))], names=["key", "a", "b", "many"])
            key, node = key[salt < 0], node[salt < 0]
            if not len(key):
                return
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])))
        key, node = key[new], node[new]
        start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        size = np.diff(np.concatenate((start, [len(key)])))
        least, width = np.repeat(node[start], size), np.repeat(size, size)
        other = least != node
        if not other.any():
            return
        pair, at = np.unique(np.stack((least[other], node[other]), axis=1), axis=0, return_inverse=True)
        many = np.bincount(at.ravel(), weights=width[other] > 2) > 0
        for i in range(0, len(pair), 100_000):
            part = np.ascontiguousarray(pair[i : i + 100_000].T)
            yield pa.RecordBatch.from_arrays([pa.nulls(part.shape[1], pa.int64()), pa.array(part[0]), pa.array(part[1]), pa.array(many[i : i + 100_000])], names=["key", "a", "b", "many"])

    found = keys.repartition(partitions, "key", "salt").mapInArrow(run, "key long, a long, b long, many boolean")
    if salted:
        found = stored(found, "met")
        hot = found.where("key is not null").select("key", "b")
        pivots = hot.groupBy("key").agg(F.min("b").alias("a"))  # no more rows than there are hot keys
        stars = hot.join(F.broadcast(pivots), "key").where("a <> b").select("a", "b", F.lit(True).alias("many"))
        found = found.where("key is null").select("a", "b", "many").unionByName(stars)
    return found.groupBy("a", "b").agg(F.max("many").alias("many"))


def _rows_of(column: pa.Array, rows: np.ndarray, width: int) -> np.ndarray:
    """The given rows of a binary column, all `width` bytes long, as a matrix."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int32)[column.offset : column.offset + len(column)][rows].astype(np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[:, None] + np.arange(width)]


def _near_pairs(pairs: DataFrame, sketches: DataFrame, t: Fraction) -> DataFrame:
    """The pairs(a, b) whose sizes and Hamming distance allow a link."""
    p, q = t.numerator, t.denominator
    left, right = (sketches.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}")) for x in "ab")
    both = spread_join(pairs.select("a", "b"), left, "a", hot_keys(pairs, "a")).join(right, "b").where((F.col("na") * q >= F.col("nb") * p) & (F.col("nb") * q >= F.col("na") * p))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            na, nb = (b.column(i).to_numpy() for i in (4, 5))
            widths = np.stack([pc.binary_length(b.column(i)).to_numpy() for i in (2, 3)], axis=1)
            keep = np.zeros(b.num_rows, dtype=bool)
            # pairs of sketches of the same widths are compared together
            for wa, wb in np.unique(widths, axis=0).tolist():
                rows = np.flatnonzero((widths == (wa, wb)).all(axis=1))
                for some in np.array_split(rows, -(-len(rows) * (wa + wb) // BLOCK_BYTES)):
                    x, y = (_folded(_rows_of(b.column(i), some, w), min(wa, wb)) for i, w in ((2, wa), (3, wb)))
                    keep[some] = _apart(x, y) * (q + p) <= (na[some] + nb[some]) * (q - p)
            yield b.select([0, 1]).filter(pa.array(keep))

    return both.select("a", "b", "sa", "sb", "na", "nb").mapInArrow(run, "a long, b long")


def _cross_pairs(stars: DataFrame, labels: DataFrame, sketches: DataFrame, t: Fraction) -> DataFrame:
    """(a, b): members of one pivot in different components, within the Hamming bound.

    stars(a, b) have been compared with the pivot a.  The members of a pivot are
    cut in blocks of about BLOCK_BYTES of sketches by hash; each pair of blocks
    goes to one task.
    """
    p, q = t.numerator, t.denominator
    widths = sketches.select("node", F.octet_length("sketch").alias("width"))
    rows = stars.select("a", F.col("b").alias("node")).join(labels, "node", "left").join(widths, "node").select("a", "node", F.coalesce("component", "node").alias("component"), "width")
    rows = stored(rows, "members")
    open_ = rows.groupBy("a").agg(F.sum("width").alias("bytes"), F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("a", F.ceil(F.col("bytes") / BLOCK_BYTES).cast("int").alias("blocks"))
    rows = spread_join(rows.drop("width"), open_, "a", hot_keys(rows, "a")).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # a block meets itself and every other block of its pivot once
    rows = rows.select("a", "node", "component", "own", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other")).join(sketches, "node")
    cell = [F.col("a"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")]

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        i, j = key[1].as_py(), key[2].as_py()
        held: list[tuple] = []
        for b in batches:
            held += zip(b.column("node").to_pylist(), b.column("component").to_pylist(), b.column("n").to_pylist(), b.column("sketch").to_pylist(), b.column("own").to_pylist(), strict=True)
        held.sort(key=lambda r: r[:3])
        node, comp, n, own = (np.array([r[k] for r in held], dtype=np.int64) for k in (0, 1, 2, 4))
        by_width: dict[int, np.ndarray] = {}
        width = np.array([len(r[3]) for r in held])
        a_out, b_out = [], []
        for w in sorted(set(width.tolist())):
            by_width[w] = np.zeros((len(held), w), dtype=np.uint8)
            for k in np.flatnonzero(width >= w).tolist():
                by_width[w][k] = _folded(np.frombuffer(held[k][3], dtype=np.uint8)[None, :], w)[0]
        for k in range(len(held)):
            # the smaller sketch of a pair sets the width it is compared at
            fits = (comp != comp[k]) & (n >= n[k]) & (n[k] * q >= n * p) & ((own != own[k]) if i != j else (own == own[k]))
            fits &= (n > n[k]) | (np.arange(len(held)) > k)
            at = np.flatnonzero(fits)
            if len(at):
                table = by_width[int(width[k])]
                at = at[_apart(table[at], table[k][None, :]) * (q + p) <= (n[at] + n[k]) * (q - p)]
                a_out.append(np.minimum(node[at], node[k]))
                b_out.append(np.maximum(node[at], node[k]))
        if a_out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a_out)), pa.array(np.concatenate(b_out))], names=["a", "b"])

    return rows.groupBy(*cell).applyInArrow(run, "a long, b long").distinct()


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, t: Fraction, n: int) -> DataFrame:
    """The pairs(a, b) with Jaccard >= t, on sets read again from one text each."""
    p, q = t.numerator, t.denominator
    pairs = stored(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    keys = nodes.where("sketch is not null").join(wanted, "node").groupBy("node").agg(F.min("text_key").alias("k")).select(F.col("k").alias("text_key")).distinct()
    texts = docs.select(F.xxhash64("text").alias("text_key"), "text").join(small_side(stored(keys, "texts")), "text_key", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = _Once()
        for b in batches:
            rows = [(f, x.view(np.int64)) for _, x in _sets(b.column(0), n) if len(x) and once(f := _fingerprint(x))]
            for i in range(0, len(rows), 256):
                node, shingles = zip(*rows[i : i + 256], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(shingles, pa.list_(pa.int64()))], names=["node", "shingles"])

    sets = stored(texts.select("text").mapInArrow(run, "node long, shingles array<long>").dropDuplicates(["node"]), "sets")
    left, right = (sets.select(F.col("node").alias(x), F.col("shingles").alias(f"x{x}")) for x in "ab")
    both = pairs.join(right, "b").join(left, "a").select("a", "b", F.size("xa").alias("na"), F.size("xb").alias("nb"), F.size(F.array_intersect("xa", "xb")).alias("common"))
    return stored(both.where(F.col("common") * q >= (F.col("na") + F.col("nb") - F.col("common")) * p).select("a", "b"), "links")


def jaccard_classes(docs: DataFrame, threshold: Fraction = Fraction(4, 5), n: int = 5) -> tuple[DataFrame, DataFrame]:
    """(nodes, labels): every row's node, and labels(node, component) of linked nodes."""
    spark = docs.sparkSession
    text_batches(spark)
    nodes = stored(node_table(docs, n), "nodes")
    total = nodes.agg(F.sum("n_shingles")).first()[0] or 0
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(total / PART_ROWS) + 1)
    hot = frequent_keys(docs, threshold, n, total)
    pairs = stored(_pivot_pairs(key_table(docs, threshold, n, hot), partitions, bool(hot)), "pairs")
    met = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    firsts = nodes.where("sketch is not null").join(met, "node")  # at most one row of a node from each task
    sketches = stored(firsts.groupBy("node").agg(F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")), "sketches")
    links = _verified(_near_pairs(pairs, sketches, threshold), docs, nodes, threshold, n)
    labels = connected_components(links)
    crossing = stored(_cross_pairs(pairs.where("many"), labels, sketches, threshold), "crossing")
    if not crossing.isEmpty():
        more = _verified(crossing, docs, nodes, threshold, n)
        labels = connected_components(links.unionByName(more))
    return nodes, labels


def _first_of_class(nodes: DataFrame, labels: DataFrame, order: F.Column) -> tuple[DataFrame, DataFrame]:
    """(first of `order` in the class by node, hot nodes), for nodes of more than one row or with links."""
    least = nodes.where("node is not null").groupBy("node").agg(F.min(order).alias("least"), F.count("*").alias("n_rows"))
    named = stored(least.join(labels, "node", "left").where("n_rows > 1 or component is not null").withColumn("component", F.coalesce("component", "node")), "classes")
    first = named.groupBy("component").agg(F.min("least").alias("first"))
    total = named.agg(F.sum("n_rows")).first()[0] or 0
    hot = F.broadcast(named.where(F.col("n_rows") >= hot_bar(total)).select("node"))
    return stored(named.join(first, "component").select("node", "first"), "firsts"), hot


def near_duplicates(docs: DataFrame, threshold: Fraction = Fraction(4, 5), n: int = 5) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id (smallest doc_id linked)."""
    nodes, labels = jaccard_classes(docs, threshold, n)
    first, hot = _first_of_class(nodes, labels, F.col("doc_id"))
    rows = nodes.select("doc_id", "n_shingles", "node")
    found = spread_join(rows.where("node is not null"), first, "node", hot, "left").select("doc_id", "n_shingles", F.coalesce("first", "doc_id").alias("component_id"))
    return found.unionByName(rows.where("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def keep_one(docs: DataFrame, threshold: Fraction = Fraction(4, 5), n: int = 5) -> DataFrame:
    """docs with one row of each component, that of the smallest doc_id; same columns.

    Of repeated rows of that doc_id and text one stays.  Rows without words all
    stay.  Rows to drop are the smaller side and are taken away by an anti join,
    so the texts themselves need no shuffle while those fit a broadcast.
    """
    nodes, labels = jaccard_classes(docs, threshold, n)
    first, hot = _first_of_class(nodes, labels, F.struct("doc_id", "text_key"))
    marked = spread_join(nodes.where("node is not null").select("doc_id", "text_key", "node"), first, "node", hot)
    marked = marked.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key")))
    pairs = stored(marked.groupBy("doc_id", "text_key").agg(F.max("kept").alias("kept"), F.count("*").alias("n")).where("not kept or n > 1").select(F.col("doc_id").alias("_swident_id"), F.col("text_key").alias("_swident_key"), "kept"), "dropped")
    at = F.col("doc_id").eqNullSafe(F.col("_swident_id")) & (F.xxhash64("text") == F.col("_swident_key"))
    out = docs.join(small_side(pairs.drop("kept")), at, "left_anti")
    again = pairs.where("kept").drop("kept")
    if not again.isEmpty():
        same = docs.join(small_side(again), at, "left_semi").withColumn("_swident_key", F.xxhash64("text")).dropDuplicates(["doc_id", "_swident_key"]).drop("_swident_key")
        out = out.unionByName(same)
    return out
