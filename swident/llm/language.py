"""Language identification by compression.

Texts are lower-cased and reduced to their letters, words apart by one space.
Each language has one raw-content zstandard dictionary, cut from a bounded sample
of its texts.  A text is compressed with every dictionary in chunks (so that a
long text can't live off its own repetitions) and the language with the smallest
total wins.  The margin between the two best sizes decides whether the answer is
accepted or rejected.

The sample: per language the `DOCS` learning documents with the smallest hash of
their id, `MAX_EXAMPLES` in all, every language's first ones before any second
ones; each gives an equal share of a dictionary of at most `DICTIONARY_BYTES`.
Prediction reads the whole text, whatever its length.

Odd inputs: null texts and texts without a letter are `und` with score 0.0; ties
go to the language that comes first; repeated rows each get a result, and an id
that is repeated in the sample counts once; without learning documents every text
is `und`; an empty table gives no rows; result columns have names of their own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import stored

DOCS = 96
MAX_EXAMPLES = 24_576
DICTIONARY_BYTES = 98_304
CHUNK_BYTES = 8_192
LEVEL = 9
LETTER = regex.compile(r"\p{L}")
GAP = re.compile(r"[\W\d_]+")


def letters_only(text: str) -> bytes:
    """Lower-cased, each run of other characters than letters as one space."""
    return GAP.sub(" ", text.lower()).encode()


def dictionary_of(texts: list[bytes]) -> bytes:
    """Equal shares of the texts; what short ones leave goes to the later ones."""
    out, left = [], DICTIONARY_BYTES
    for i, t in enumerate(texts):
        out.append(t[: max(left // (len(texts) - i), 1)])
        left -= len(out[-1])
    return b" ".join(out)[:DICTIONARY_BYTES]


def _sample(docs: DataFrame, learn: Column) -> DataFrame:
    """(lang, place, _id) of the sampled documents."""
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").alias("_id"), "lang", F.xxhash64("doc_id").alias("h"))
    # a threshold that lets about 16 * DOCS ids of each language pass spares the window the rest
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("_id").alias("ids")).select(F.col("lang").alias("_lang"), F.least(F.lit(1.0), 16.0 * DOCS / F.col("ids")).alias("share"))
    few = rows.join(F.broadcast(stored(sizes.orderBy("_lang").limit(MAX_EXAMPLES), "languages")), F.col("lang") == F.col("_lang"))
    few = few.where(F.col("h").cast("double") / float(1 << 64) + 0.5 <= F.col("share")).select("lang", "_id", "h").distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "_id"))
    return few.withColumn("place", place).where(F.col("place") <= DOCS).orderBy("place", "lang").limit(MAX_EXAMPLES).select(F.col("lang").alias("_lang"), "place", "_id")


def sample_dictionaries(docs: DataFrame, learn: Column) -> dict[str, bytes]:
    """Language -> raw dictionary content, made by executors.

    learn is a condition on doc_id; text, lang and doc_id are read.
    """
    chosen = stored(_sample(docs, learn), "language-sample")
    texts = docs.select("doc_id", "lang", "text").join(F.broadcast(chosen), (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang")))
    one = texts.groupBy("lang", "place").agg(F.min("text").alias("text"))

    def make(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((p, letters_only(t)) for b in batches for p, t in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True))
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.string()), pa.array([dictionary_of([t for _, t in rows])], pa.binary())], names=["lang", "content"])

    made = one.groupBy("lang").applyInArrow(make, "lang string, content binary").collect()
    return {r["lang"]: bytes(r["content"]) for r in sorted(made, key=lambda r: r["lang"]) if r["content"]}


class Compressors:
    """Ready compressors, one for each language; made once per Python worker task."""

    def __init__(self, content: dict[str, bytes]) -> None:
        self.languages = sorted(content)
        self.each = []
        for lang in self.languages:
            d = zstandard.ZstdCompressionDict(content[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.each.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))

    def sizes(self, data: bytes) -> np.ndarray:
        """Compressed bytes of a text per language."""
        view = memoryview(data)
        chunks = [view[a : a + CHUNK_BYTES] for a in range(0, len(data), CHUNK_BYTES)]
        return np.array([sum(len(c.compress(x)) for x in chunks) for c in self.each], dtype=np.int64)


def judge(size: np.ndarray, min_margin: float) -> tuple[int, float, float, bool]:
    """Place of the smallest size, its score, its margin and whether that is too narrow.

    The score is the share of 2 ** -bytes; the margin is the second size's excess
    as a share of the best.
    """
    order = np.argsort(size, kind="stable")
    best = size[order[0]]
    second = size[order[1]] if len(order) > 1 else 2 * best
    bits = np.exp2(-(size - best).astype(float).clip(0, 200))
    margin = float((second - best) / max(best, 1))
    return int(order[0]), float(1 / bits.sum()), margin, margin < min_margin


def identify(docs: DataFrame, content: dict[str, bytes], columns: list[str], min_margin: float = 0.005) -> DataFrame:
    """The given columns, then _swident_lang, _swident_score, _swident_margin, _swident_rejected.

    lang is the best language or und; rejected is true for und and for margins
    below min_margin.
    """
    sent = docs.sparkSession.sparkContext.broadcast(content)  # bounded: languages of the sample x DICTIONARY_BYTES
    kept = docs.select(*columns, F.col("text").alias("_swident_text"))
    schema = docs.select(*columns).schema
    for name, kind in (("lang", "string"), ("score", "double"), ("margin", "double"), ("rejected", "boolean")):
        schema = schema.add(f"_swident_{name}", kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Compressors(sent.value)
        for b in batches:
            rows: list[tuple] = []
            for text in b.column(b.num_columns - 1):
                t = text.as_py()
                if t is None or not made.languages or not LETTER.search(t):
                    rows.append(("und", 0.0, 0.0, True))
                    continue
                at, score, margin, rejected = judge(made.sizes(letters_only(t)), min_margin)
                rows.append((made.languages[at], score, margin, rejected))
            lang, score, margin, rejected = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(b.num_columns - 1)), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(margin, pa.float64()), pa.array(rejected, pa.bool_())], names=schema.names)

    return kept.mapInArrow(run, schema)
