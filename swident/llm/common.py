"""Shared pieces: learning folds, ASCII lower case, samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's text modulo `modulus`; a null id has no fold (null)."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus)).cast("int")


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True where the id's fold is `remainder`; a null id is never held out."""
    return F.coalesce(fold(doc_id, modulus) == remainder, F.lit(False))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, all other characters unchanged."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower_for_ascii(text: Column) -> Column:
    """Lower case by which a word of ASCII letters and digits equals what A-Z lowering gives.

    Of all other characters only the Kelvin sign lowers to an ASCII one; it goes
    first.  Faster than lower_ascii, but other letters are lowered too.
    """
    return F.lower(F.replace(text, F.lit("\u212a"), F.lit("\u0138")))


def labelled_examples(docs: DataFrame, labels: DataFrame, label: str, learn: Column, max_examples: int) -> DataFrame:
    """doc_id, text and y of at most max_examples labelled rows that `learn` admits.

    learn is a condition on doc_id.  Labels other than 0 and 1 don't count.  The
    bound is on label rows, taken in order of a hash of their id, so that the
    sample is a random one and repeats itself; however often a document's row or
    label is repeated, it is one example for each label and of its texts the
    smallest one counts.
    """
    chosen = labels.select(F.col("doc_id").alias("_id"), F.col("doc_id"), F.col(label).alias("y")).where(learn & F.col(label).isin(0, 1)).distinct()
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(max_examples).select("_id", "y")
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    return found.groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("doc_id", "text", "y")


def text_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Send whole texts to workers in Arrow batches of fewer rows than Spark's default of 10,000.

    A batch is held several times over on its way.  A session's own setting stays.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(rows))
