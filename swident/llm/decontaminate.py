"""Benchmark decontamination over a distributed positional index, natively.

1. The index stores the postings of all training tokens, a document's in a row:
   its terms by position.  Terms and documents are 64-bit hashes (of the
   lower-cased word; of doc_id and text).  It does not depend on the benchmark.
2. Every window of `width` consecutive item words (an item of fewer words is one
   window) takes its two rarest words by the index's own counts.  A window with a
   word that the index lacks can't occur.
3. The rarest word's list (documents and positions), shifted by its place in the
   window, gives candidate places; it is intersected with the second rarest
   word's list at the shifted place.
4. What is left must have every word's posting in its place: an exact phrase.
   Places where both rare words stand within `width` words outside of exact phrases
   are proximity matches.

Every occurrence of a window holds its rarest words at the right places, so none
is missed.  As a document's postings are in one row, lists are intersected where
they are stored; only tables that follow from the benchmark move, by broadcast if
their bytes allow it.  Beyond that the rarest words' postings are shuffled by term
and candidate places by document, each without the document's other postings.

Odd inputs: null or empty texts have no words and no hits; items without words
are ignored; rows with a null item_id count hits under the id ""; repeated rows
of a document each get its result; empty tables give no hits or no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import fits, small_side, stored
from .common import lower_ascii

#: Delimiters of the word class `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` before A-Z is lower-cased.
DELIMITERS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WIDTH = 10


def words_of(text: Column) -> Column:
    """The words in their own case; none for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), DELIMITERS), "")


def lower_words(text: Column) -> Column:
    """The words with A-Z lowered; ASCII texts take the faster way."""
    t = F.coalesce(text, F.lit(""))
    return words_of(F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(lower_ascii(t)))


def _row_key(df: DataFrame) -> DataFrame:
    """A document is a doc_id with its text; repeated rows share the key."""
    return df.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("_text_hash"), "text")


def document_key() -> Column:
    """One number for a doc_id with its text; repeated rows share it."""
    return F.xxhash64("doc_id", F.coalesce("text", F.lit("")))


def item_words(benchmark: DataFrame) -> DataFrame:
    """One row per distinct item text: item, words (A-Z lowered), n."""
    return (
        benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of(lower_ascii(F.col("text"))).alias("words"))
        .distinct()
        .withColumn("n", F.size("words"))
        .where("n > 0")
    )


def build_index(docs: DataFrame) -> DataFrame:
    """Store the postings of all tokens by document: doc, and terms by position (from 0)."""
    return stored(docs.select(document_key().alias("doc"), F.transform(lower_words(F.col("text")), lambda w: F.xxhash64(w)).alias("terms")), "postings")


def rare_windows(items: DataFrame, index: DataFrame, width: int = WIDTH) -> DataFrame:
    """The windows whose words the index has: window, item, terms, span, and place and term of the two rarest.

    second is null for windows of one word.
    """
    hashed = items.select("item", "n", F.transform("words", lambda w: F.xxhash64(w)).alias("all"))
    spans = hashed.select("item", F.least("n", F.lit(width)).alias("span"), "all", F.explode(F.expr(f"sequence(0, greatest(n - {width}, 0))")).alias("w"))
    windows = spans.select("item", "span", F.expr("slice(all, w + 1, span)").alias("terms")).distinct().withColumn("window", F.xxhash64("item", "terms"))
    windows = stored(windows, "windows")
    vocabulary = windows.select(F.explode("terms").alias("term")).distinct()
    lists = index.select(F.explode("terms").alias("term")).join(small_side(vocabulary), "term", "left_semi")
    counts = stored(lists.groupBy("term").agg(F.count("*").alias("cf")), "counts")
    cells = windows.select("window", F.posexplode("terms").alias("at", "term")).join(small_side(counts), "term")
    ranked = cells.groupBy("window").agg(F.array_sort(F.collect_list(F.struct("cf", "term", "at"))).alias("c"))
    rarest = ranked.select("window", F.size("c").alias("known"), F.get("c", F.lit(0)).alias("first"), F.get("c", F.lit(1)).alias("second"))
    joined = windows.join(rarest, "window").where("known = span")
    return stored(joined.select("window", "item", "terms", "span", *[F.col(f"{r}.{c}").alias(f"{r}_{c}") for r in ("first", "second") for c in ("term", "at")]), "rare-windows")


def _lists(index: DataFrame, windows: DataFrame) -> DataFrame:
    """The rarest words' postings with their documents' terms: doc, terms, pos and the window's columns."""
    windows = windows.withColumnRenamed("terms", "phrase")
    if fits(windows):
        posted = index.select("doc", "terms", F.posexplode("terms").alias("pos", "term"))
        return posted.join(F.broadcast(windows), F.col("term") == F.col("first_term"))
    rare = windows.select("window", F.col("first_term").alias("term"))
    places = index.select("doc", F.posexplode("terms").alias("pos", "term")).join(rare, "term").select("doc", "pos", "window")
    return places.distinct().join(index.dropDuplicates(["doc"]), "doc").join(windows, "window")


def phrases(index: DataFrame, windows: DataFrame) -> DataFrame:
    """Exact occurrences of windows: doc, item, start, end (the last word)."""
    found = _lists(index, windows).withColumn("start", F.col("pos") - F.col("first_at"))
    both = found.where("start >= 0 and (second_term is null or get(terms, start + second_at) = second_term)")
    whole = both.where("slice(terms, start + 1, span) = phrase")
    return stored(whole.select("doc", "item", "start", (F.col("start") + F.col("span") - 1).alias("end")).distinct(), "phrases")


def proximities(index: DataFrame, windows: DataFrame, exact: DataFrame, width: int = WIDTH) -> DataFrame:
    """Places of a window's two rarest words less than `width` words apart, outside of exact phrases of the item."""
    found = _lists(index, windows.where("second_term is not null"))
    around = found.withColumn("low", F.greatest(F.col("pos") - (width - 1), F.lit(0))).withColumn("other", F.expr(f"low + array_position(slice(terms, low + 1, pos - low + {width}), second_term) - 1"))
    near = around.where("other >= low and other <> pos").select("doc", "item", F.least("pos", "other").cast("int").alias("start"), F.greatest("pos", "other").cast("int").alias("end")).distinct()
    inside = exact.select("doc", "item", F.col("start").alias("_s"), F.col("end").alias("_e"))
    same = (near.doc == inside.doc) & (near.item == inside.item) & (near.start >= inside._s) & (near.end <= inside._e)
    return near.join(inside, same, "left_anti")


def find_matches(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, index: DataFrame | None = None) -> DataFrame:
    """All matches of the benchmark's windows: doc_id, item, kind (phrase or proximity), start, end.

    index is that of docs, if it was built before.  Positions count words from 0,
    end is the last word.
    """
    index = build_index(docs) if index is None else index
    windows = rare_windows(item_words(benchmark), index, width)
    exact = phrases(index, windows)
    both = exact.withColumn("kind", F.lit("phrase")).unionByName(proximities(index, windows, exact, width).withColumn("kind", F.lit("proximity")))
    ids = docs.select("doc_id", document_key().alias("doc")).distinct()
    return ids.join(both, "doc").select("doc_id", "item", "kind", "start", "end")


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_hit, n_items, items, contaminated."""
    index = build_index(docs)
    exact = phrases(index, rare_windows(item_words(benchmark), index, width))
    found = exact.groupBy("doc").agg(
        F.expr("size(array_distinct(flatten(transform(collect_set(struct(start, end)), x -> sequence(x.start, x.end)))))").cast("long").alias("n_hit"),
        F.array_sort(F.collect_set("item")).alias("items"),
    )
    sizes = index.groupBy("doc").agg(F.max(F.size("terms")).cast("long").alias("n_words"))
    rows = docs.select("doc_id", document_key().alias("doc"))
    joined = rows.join(sizes, "doc", "left").join(found, "doc", "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    zero = F.lit(0).cast("long")
    return joined.select("doc_id", F.coalesce("n_words", zero).alias("n_words"), F.coalesce("n_hit", zero).alias("n_hit"), F.size(items).cast("long").alias("n_items"), items.alias("items"), F.col("n_hit").isNotNull().alias("contaminated"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """docs without the rows that hold an exact benchmark window; same columns."""
    index = build_index(docs)
    exact = phrases(index, rare_windows(item_words(benchmark), index, width))
    bad = stored(exact.select(F.col("doc").alias("_swident_doc")).distinct(), "contaminated")
    return docs.join(small_side(bad), document_key() == F.col("_swident_doc"), "left_anti")
