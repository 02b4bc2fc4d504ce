"""SentencePiece (BPE) encoding with seeded merge dropout, and decoding.

Merges are taken from an agenda by rank, leftmost first, as the model's own
encoder does.  A merge is skipped if a keyed hash falls below the dropout rate;
its key is the seed, the document's id, the place in the document of the unit (a
run of spaces and the letters after it), the place in the unit and the merged
piece.  So every occurrence of a word is cut on its own, any run repeats itself,
and every cut decodes to the same text.  With rate 0 the ids equal the model's
own.

What an agenda does depends on the unit and on which of its merges were skipped
only.  A task therefore keeps the agendas that it has met as nodes: a node lists
the merges that follow if none is skipped, and what they end in.  The hashes of
all occurrences of a batch are worked out at once; an occurrence whose first
skipped merge is the j-th goes on from the node's j-th child.  Nodes are made when
they are wanted for the second time; before that the agenda itself is run.

Characters that the model lacks, and the space mark itself where a text holds
it, are written as byte pieces, so decoding gives back every text exactly.

Odd inputs: a null text has null ids and 0 pieces; the empty text has no ids;
rows that repeat an id and its text get the same ids; rows without an id are cut
as one document; an empty table gives no rows; result columns have names of their
own.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_batches
from .words import lean_memory, mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
UNITS = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")
#: Units that also end where letters meet other characters, for models without mixed pieces.
_L = r"[^\W\d_]"
_REST = rf"(?:(?!{_L})[^{SPACE}\n])"
FINE_UNITS = re.compile(rf"{SPACE}+(?:{_L}+|{_REST}*)|{_L}+|{_REST}+|\n")
MIXED = re.compile(rf"{_L}{_REST}|{_REST}{_L}|[^{SPACE}]{SPACE}|\n")
RATE = 0.1
#: Nodes that a task keeps before it begins anew.
NODES = 700_000
#: Units up to this many characters have nodes.
SHORT = 48
#: Characters of text that are worked on at a time.
BATCH = 1_000_000
_NONE = (1 << 31) - 1
_BITS = 20
_MASK = (1 << 64) - 1
_STEP, _MIX, _SALT = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F
_PLACES = np.arange(1 << 10, dtype=np.uint64) * np.uint64(_STEP)


def load_model(path: str = MODEL) -> bytes:
    """The model file's bytes, read by the driver and sent with the tasks."""
    with open(path, "rb") as f:
        return f.read()


class Vocabulary:
    """Pieces of a BPE model with byte pieces, by number, and what merges to what."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        lean_memory()
        m = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.id: dict[str, int] = {}
        self.byte = [b""] * 256
        self.out: list[bytes] = []
        rank: dict[int, int] = {}
        for i in range(m.get_piece_size()):
            piece = m.id_to_piece(i)
            if m.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i.to_bytes(4, "little")
                self.out.append(bytes([int(piece[3:5], 16)]))
            elif m.is_control(i) or m.is_unknown(i):
                self.out.append(b"")
            else:
                self.out.append(piece.replace(SPACE, " ").encode())
                self.id[piece] = i
                rank[i] = round(-m.get_score(i))
        # (left, right) -> place of the merged piece in the order of merges
        self.piece = np.array(sorted(self.id.values(), key=lambda i: (rank[i], i)), dtype=np.int32)
        order = {i: k for k, i in enumerate(self.piece.tolist())}
        self.merge: dict[int, int] = {}
        for piece, i in self.id.items():
            for k in range(1, len(piece)):
                x, y = self.id.get(piece[:k]), self.id.get(piece[k:])
                if x is not None and y is not None:
                    self.merge[x << _BITS | y] = order[i]
        self._hash_merges()
        self.of_char = np.full(0x110000, -1, dtype=np.int32)
        for piece, i in self.id.items():
            if len(piece) == 1:
                self.of_char[ord(piece)] = i
        self.units = UNITS if any(MIXED.search(p) for p in self.id) else FINE_UNITS
        self.salts = np.arange(len(self.out), dtype=np.uint64) * np.uint64(_SALT)
        size = np.array([len(x) for x in self.out])
        self.sizes, self.starts = size, np.cumsum(size) - size
        self.table = np.frombuffer(b"".join(self.out), dtype=np.uint8)

    def _hash_merges(self) -> None:
        """The merges in a table of open addresses."""
        key = np.fromiter(self.merge, dtype=np.int64, count=len(self.merge))
        value = np.fromiter(self.merge.values(), dtype=np.int32, count=len(self.merge))
        self.shift = np.uint64(64 - max(4 * len(key), 16).bit_length())
        self.slot_key = np.full(1 << int(64 - self.shift), -2, dtype=np.int64)
        self.slot_value = np.full(len(self.slot_key), _NONE, dtype=np.int32)
        self.probes = 0
        while len(key):
            at = self._slots(key)
            free = np.flatnonzero(self.slot_key[at] == -2)
            _, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.slot_key[at[put]], self.slot_value[at[put]] = key[put], value[put]
            left = np.ones(len(key), dtype=bool)
            left[put] = False
            key, value = key[left], value[left]
            self.probes += 1

    def _slots(self, key: np.ndarray, probe: int | None = None) -> np.ndarray:
        at = ((key.view(np.uint64) * np.uint64(_STEP)) >> self.shift).astype(np.int64)
        return (at + (self.probes if probe is None else probe)) & (len(self.slot_key) - 1)

    def merges(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The place in the order of merges of each pair's merged piece, _NONE where there is none."""
        key = np.where((a | b) < 0, -1, a.astype(np.int64) << _BITS | b)
        at = self._slots(key, 0)
        have = self.slot_key[at]
        out = np.where(have == key, self.slot_value[at], np.int32(_NONE))
        more = np.flatnonzero((have != key) & (have != -2) & (key >= 0))
        flat, keys = out.reshape(-1), key.reshape(-1)
        for probe in range(1, self.probes):
            if not len(more):
                break
            at = self._slots(keys[more], probe)
            have = self.slot_key[at]
            hit = have == keys[more]
            flat[more[hit]] = self.slot_value[at[hit]]
            more = more[~hit & (have != -2)]
        return out


@lru_cache(maxsize=2)
def vocabulary(model: bytes) -> Vocabulary:
    """The tables of a model, made once per process."""
    return Vocabulary(model)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0] .. start[0] + size[0] - 1, start[1] .. and so on."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - size), size)


def occurrence_keys(seed: int, document: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The key of each unit of a batch: its document's key, mixed with seed and place."""
    return mix(mix(document ^ np.uint64(seed * _STEP & _MASK)) + place.astype(np.uint64) * np.uint64(_SALT))


def draws(key: np.ndarray, at: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """64 random bits for a merge at a place (as in _PLACES) to a piece (as in salts)."""
    h = (key ^ at ^ salt) * np.uint64(_MIX)
    return (h ^ (h >> np.uint64(32))) * np.uint64(_MIX)


class Pieces:
    """Encoder with one seed and rate; the nodes that it has met live with it."""

    def __init__(self, model: bytes, seed: int = 0, rate: float = RATE, nodes: int | None = None) -> None:
        self.v = vocabulary(model)
        self.most = NODES if nodes is None else nodes
        self.units = self.v.units
        self.seed = seed
        self.limit = np.uint64(min(int(rate * (1 << 64)), _MASK))
        self._begin()

    def _begin(self) -> None:
        """Forget all nodes but that of the space mark."""
        self.root: dict[str | None, int] = {None: 0}
        self.child: dict[int, int] = {}
        self.once: set[str | int] = set()  # units and edges that were met and have no node yet
        self.unit: list[str] = [SPACE]
        self.path: list[tuple[int, ...]] = [()]  # the steps of the agenda that were skipped
        self.ids: list[bytes] = [b"".join(self.v.byte[b] for b in SPACE.encode())]
        self.start = np.zeros(1 << 16, dtype=np.int64)  # where a node's merges begin
        self.size = np.zeros(1 << 16, dtype=np.int64)
        self.at = np.zeros(1 << 19, dtype=np.uint8)
        self.new = np.zeros(1 << 19, dtype=np.int32)
        self.used = 0

    def _grow(self, units: list[str], paths: list[tuple[int, ...]]) -> range:
        """New nodes for units and the steps that are skipped."""
        first = len(self.unit)
        self.unit += units
        self.path += paths
        self.ids += [b""] * len(units)
        if len(self.unit) > len(self.start):
            more = np.zeros(len(self.unit) * 2 - len(self.start), dtype=np.int64)
            self.start, self.size = np.concatenate((self.start, more)), np.concatenate((self.size, more))
        for rows, some in self._by_width(units):
            nodes = rows + first
            ids, owner, at, new = self._agendas(some, [paths[r] for r in rows.tolist()], None)
            for node, x in zip(nodes.tolist(), ids, strict=True):
                self.ids[node] = x
            size = np.bincount(owner, minlength=len(nodes))
            end = self.used + len(owner)
            if end > len(self.at):
                self.at = np.concatenate((self.at[: self.used], np.zeros(end, dtype=np.uint8)))
                self.new = np.concatenate((self.new[: self.used], np.zeros(end, dtype=np.int32)))
            self.at[self.used : end], self.new[self.used : end] = at, new
            self.start[nodes], self.size[nodes] = self.used + np.cumsum(size) - size, size
            self.used = end
        return range(first, len(self.unit))

    def _by_width(self, units: list[str]) -> Iterator[tuple[np.ndarray, list[str]]]:
        """(rows, units) of about the same length, some at a time."""
        length = np.fromiter(map(len, units), dtype=np.int64, count=len(units))
        low = 0
        for high in (4, 6, 8, 10, 12, 16, 24, SHORT):
            rows = np.flatnonzero((length > low) & (length <= high))
            low = high
            for k in range(0, len(rows), 10_000):
                yield rows[k : k + 10_000], [units[r] for r in rows[k : k + 10_000].tolist()]

    def _agendas(self, units: list[str], paths: list[tuple[int, ...]] | None, keys: np.ndarray | None) -> tuple:
        """Run the agendas of units in step: the packed ids of each, and (unit, place, piece) of merges.

        Skipped are the steps in paths, or, given keys, what their hashes say.
        Merges are those after a path's last step; there are none with keys.
        """
        v, n = self.v, len(units)
        length = np.fromiter(map(len, units), dtype=np.int64, count=n)
        width = int(length.max())
        if keys is None:
            skips = np.full((n, max(map(len, paths)) + 1), -1, dtype=np.int64)
            for r, p in enumerate(paths):
                skips[r, : len(p)] = p
            last = np.array([p[-1] if p else -1 for p in paths])
            done = np.zeros(n, dtype=np.int64)  # skips of the path that were met
        inside = np.arange(width + 1) < length[:, None]
        ids = np.full((n, width + 1), -1, dtype=np.int32)
        ids[inside] = v.of_char[np.frombuffer("".join(units).encode("utf-32-le"), dtype=np.uint32)]
        absent = inside & (ids < 0)
        lacking = absent.any(axis=1)
        if lacking.any():
            ids = np.where(absent, -1 - np.arange(width + 1, dtype=np.int32), ids)
        rank = np.full((n, width + 1), _NONE, dtype=np.int32)
        rank[:, :-1] = v.merges(ids[:, :-1], ids[:, 1:])
        after = np.broadcast_to(np.minimum(np.arange(1, width + 2), width), (n, width + 1)).copy()
        before = np.broadcast_to(np.arange(-1, width), (n, width + 1)).copy()
        live = inside
        row = np.arange(n)
        step = 0
        listed: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(row):
            at = rank[row].argmin(axis=1)  # of equal ranks the leftmost
            best = rank[row, at]
            go = np.flatnonzero(best != _NONE)
            if len(go) < len(row):
                row, at, best = row[go], at[go], best[go]
            new = v.piece[best]
            if keys is not None:
                skip = draws(keys[row], _PLACES[at], v.salts[new]) < self.limit
            else:
                skip = skips[row, done[row]] == step
                done[row[skip]] += 1
                fresh = last[row] < step
                listed.append((row[fresh], at[fresh], new[fresh]))
            rank[row[skip], at[skip]] = _NONE
            r, i, new = row[~skip], at[~skip], new[~skip]
            j = after[r, i]
            k = after[r, j]
            ids[r, i] = new
            live[r, j] = False
            rank[r, j] = _NONE
            after[r, i] = k
            before[r, k] = i
            rank[r, i] = v.merges(new, np.where(k < length[r], ids[r, k], np.int32(-1)))
            h = before[r, i]
            left = h >= 0
            r, h, new = r[left], h[left], new[left]
            rank[r, h] = v.merges(ids[r, h], new)
            step += 1
        ends = np.cumsum(live.sum(axis=1)).tolist()
        packed = ids[live]
        data = packed.tobytes()
        out = [data[4 * a : 4 * z] for a, z in zip([0, *ends[:-1]], ends, strict=True)]
        for r in np.flatnonzero(lacking).tolist():
            out[r] = self._in_bytes(packed[ends[r - 1] if r else 0 : ends[r]].tolist(), units[r])
        if keys is not None:
            return out, *(np.zeros(0, np.int64),) * 3
        owner, at, new = (np.concatenate(x) for x in zip(*listed, strict=True))
        order = np.argsort(owner, kind="stable")
        return out, owner[order], at[order], new[order]

    def _in_bytes(self, ids: list[int], unit: str) -> bytes:
        """Packed ids; a character that the model lacks (-1 - its place) as bytes of its UTF-8."""
        return b"".join(x.to_bytes(4, "little") if x >= 0 else b"".join(self.v.byte[c] for c in unit[-1 - x].encode()) for x in ids)

    def _long(self, unit: str, key: int) -> bytes:
        """The agenda of one occurrence of a long unit, as a heap over linked symbols."""
        n, get, limit = len(unit), self.v.merge.get, int(self.limit)
        ids = [self.v.id.get(c, -1 - i) for i, c in enumerate(unit)]
        live = [True] * n
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(r, i) for i in range(n - 1) if ids[i] >= 0 and ids[i + 1] >= 0 and (r := get(ids[i] << _BITS | ids[i + 1])) is not None]
        heapq.heapify(agenda)
        while agenda:
            r, i = heapq.heappop(agenda)
            j = after[i] if live[i] else n
            if j >= n or ids[i] < 0 or ids[j] < 0 or get(ids[i] << _BITS | ids[j]) != r:
                continue
            new = int(self.v.piece[r])
            if limit:
                h = (key ^ (i * _STEP & _MASK) ^ (new * _SALT & _MASK)) * _MIX & _MASK
                if (h ^ (h >> 32)) * _MIX & _MASK < limit:
                    continue
            ids[i], live[j] = new, False
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if ids[k] >= 0 and (r := get(new << _BITS | ids[k])) is not None:
                    heapq.heappush(agenda, (r, i))
            if (h := before[i]) >= 0 and ids[h] >= 0 and (r := get(ids[h] << _BITS | new)) is not None:
                heapq.heappush(agenda, (r, h))
        return self._in_bytes([x for x, ok in zip(ids, live, strict=True) if ok], unit)

    def units_of(self, text: str) -> list[str | None]:
        """The units of a text; None stands for a space mark of its own."""
        if not text:
            return []
        if SPACE not in text:
            return self.units.findall(SPACE + text.replace(" ", SPACE))
        first, *rest = text.split(SPACE)
        out: list[str | None] = self.units.findall(SPACE + first.replace(" ", SPACE))
        for x in rest:
            out += [None, *self.units.findall(x.replace(" ", SPACE))]
        return out

    def encode_many(self, texts: list[str], documents: np.ndarray) -> list[bytes]:
        """The ids of each text as packed 32-bit integers; documents are 64-bit keys."""
        if len(self.unit) + len(self.once) // 2 > self.most:
            self._begin()
        units: list[str | None] = []
        count = np.zeros(len(texts), dtype=np.int64)
        for i, t in enumerate(texts):
            before = len(units)
            units += self.units_of(t)
            count[i] = len(units) - before
        get = self.root.get
        # the mark is node 0; a unit has a node from the second time on
        node = np.fromiter(map(get, units, repeat(-1)), dtype=np.int64, count=len(units))
        missing = np.flatnonzero(node < 0).tolist()
        lacking = [u for u in self._again([units[i] for i in missing], self.once) if len(u) <= SHORT]
        self.root.update(zip(lacking, self._grow(lacking, [()] * len(lacking)), strict=True))
        node[missing] = [get(units[i], -1) for i in missing]
        place = np.arange(len(units)) - np.repeat(np.cumsum(count) - count, count)
        key = occurrence_keys(self.seed, np.repeat(documents, count), place)
        if self.limit:
            self._descend(node, key)
        made = list(map(self.ids.__getitem__, node.tolist()))
        alone = np.flatnonzero(node < 0)
        short: list[int] = []
        for i in alone.tolist():
            if len(units[i]) <= SHORT:
                short.append(i)
            else:
                made[i] = self._long(units[i], int(key[i]))
        for rows, some in self._by_width([units[i] for i in short]):
            which = [short[r] for r in rows.tolist()]
            for i, ids in zip(which, self._agendas(some, None, key[which])[0], strict=True):
                made[i] = ids
        ends = np.cumsum(count).tolist()
        return [b"".join(made[a:z]) for a, z in zip([0, *ends[:-1]], ends, strict=True)]

    @staticmethod
    def _again(keys: list, once: set) -> list:
        """Those of the keys that are met for the second time, now or since `once` began."""
        counts = Counter(keys)
        out = [k for k, n in counts.items() if n > 1 or k in once]
        once.update(counts)
        return out

    def _descend(self, node: np.ndarray, key: np.ndarray) -> None:
        """Move each occurrence from its unit's node to the node of the merges that it skips.

        An occurrence whose node would be used for the first time gets -1.
        """
        open_ = np.flatnonzero(node > 0)
        while len(open_):
            at = node[open_]
            size = self.size[at]
            open_, at, size = open_[size > 0], at[size > 0], size[size > 0]
            skipped: list[np.ndarray] = []
            steps: list[np.ndarray] = []
            for a in range(0, len(open_), 20_000):
                n = size[a : a + 20_000]
                ends = np.cumsum(n)
                cell = _ranges(self.start[at[a : a + 20_000]], n)
                low = draws(np.repeat(key[open_[a : a + 20_000]], n), _PLACES[self.at[cell]], self.v.salts[self.new[cell]]) < self.limit
                hit = np.flatnonzero(low)
                owner = np.searchsorted(ends, hit, side="right")
                first = np.flatnonzero(np.diff(owner, prepend=-1))
                owner, hit = owner[first], hit[first]
                skipped.append(owner + a)
                steps.append(hit - (ends - n)[owner])
            if not skipped:
                return
            which, step = np.concatenate(skipped), np.concatenate(steps)
            open_ = open_[which]
            edge = (at[which] << 6 | step).tolist()
            get = self.child.get
            to = np.fromiter(map(get, edge, repeat(-1)), dtype=np.int64, count=len(edge))
            missing = np.flatnonzero(to < 0).tolist()
            new = self._again([edge[i] for i in missing], self.once)
            paths = [(*self.path[e >> 6], (self.path[e >> 6][-1] + 1 if self.path[e >> 6] else 0) + (e & 63)) for e in new]
            self.child.update(zip(new, self._grow([self.unit[e >> 6] for e in new], paths), strict=True))
            to[missing] = [get(edge[i], -1) for i in missing]
            node[open_] = to
            open_ = open_[to > 0]

    def decode_many(self, ids: np.ndarray, count: np.ndarray) -> list[bytes]:
        """The UTF-8 of each run of `count` ids; the space put before a text is dropped."""
        size = self.v.sizes[ids]
        data = self.v.table[_ranges(self.v.starts[ids], size)].tobytes()
        ends = np.concatenate(([0], np.cumsum(size)))[np.cumsum(count)].tolist() if len(count) else []
        return [data[a:z][1:] for a, z in zip([0, *ends[:-1]], ends, strict=True)]


def encode(docs: DataFrame, columns: list[str], model: bytes, seed: int = 0, rate: float = RATE, check: bool = False, nodes: int = NODES) -> DataFrame:
    """The given columns, then _swident_ids and _swident_n_pieces.

    docs has doc_id and text; nodes bounds what a task keeps, not what it gives
    (700,000 take about 200 MB).  With check, _swident_lossless tells whether the
    ids decode to the text again (true for a null text).
    """
    text_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a model file has a fixed size
    kept = docs.select(*columns, F.xxhash64(F.col("doc_id").cast("string")).alias("_swident_key"), F.col("text").alias("_swident_text"))
    schema = docs.select(*columns).schema.add("_swident_ids", T.ArrayType(T.IntegerType())).add("_swident_n_pieces", "long")
    if check:
        schema = schema.add("_swident_lossless", "boolean")
    n = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_memory()
        pieces = Pieces(sent.value, seed, rate, nodes)
        for b in batches:
            texts, keys = b.column(n + 1), b.column(n).to_numpy().view(np.uint64)
            a = 0
            while a < b.num_rows:
                some: list[str] = []
                null: list[bool] = []
                size = 0
                while a + len(some) < b.num_rows and size < BATCH:
                    t = texts[a + len(some)].as_py()
                    null.append(t is None)
                    some.append(t or "")
                    size += len(some[-1])
                parts = pieces.encode_many(some, keys[a : a + len(some)])
                count = np.array([len(p) // 4 for p in parts], dtype=np.int64)
                offsets = pa.array(np.concatenate(([0], np.cumsum(count))).astype(np.int32))
                values = np.frombuffer(b"".join(parts), dtype=np.int32)
                made = [pa.ListArray.from_arrays(offsets, pa.array(values), mask=pa.array(null)), pa.array(count)]
                if check:
                    made.append(pa.array([x == t.encode() for x, t in zip(pieces.decode_many(values, count), some, strict=True)]))
                yield pa.RecordBatch.from_arrays([*(b.column(i).slice(a, len(parts)) for i in range(n)), *made], names=schema.names)
                a += len(parts)

    return kept.mapInArrow(run, schema)


def decode(encoded: DataFrame, columns: list[str], model: bytes, ids: str = "_swident_ids") -> DataFrame:
    """The given columns, then _swident_text: the decoded ids (null for null ids)."""
    sent = encoded.sparkSession.sparkContext.broadcast(model)
    schema = encoded.select(*columns).schema.add("_swident_text", "string")
    n = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(sent.value)
        for b in batches:
            for a in range(0, b.num_rows, 256):
                part = b.slice(a, 256)
                lists = part.column(n)
                count = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
                text = pieces.decode_many(lists.flatten().to_numpy(), count)
                null = np.asarray(lists.is_null())
                out = pa.array([None if no else t.decode(errors="replace") for t, no in zip(text, null, strict=True)], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns[:n], out], names=schema.names)

    return encoded.select(*columns, F.col(ids).alias("_swident_given")).mapInArrow(run, schema)


def round_trip(docs: DataFrame, columns: list[str], model: bytes, seed: int = 0, rate: float = RATE, nodes: int = NODES) -> DataFrame:
    """encode() with the ids decoded again by the task that made them."""
    return encode(docs, columns, model, seed, rate, check=True, nodes=nodes)
