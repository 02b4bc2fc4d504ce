"""Edit similarity, token overlap and entity comparison."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import col_of


def similarity(a: Column | str, b: Column | str) -> Column:
    """1 - edit distance / longer length; 1.0 for two empty strings."""
    a, b = col_of(a), col_of(b)
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, F.lit(1.0)).otherwise(1.0 - F.levenshtein(a, b) / longer)


def tokens(product: Column) -> Column:
    """The distinct words of a product name between `_`, `-` and `.`."""
    return F.array_distinct(F.array_remove(F.split(product, r"[_\-.]"), ""))


def products_share_tokens(products: Column) -> Column:
    """True if every two of the (distinct) products have a word in common."""
    words = F.transform(F.array_distinct(products), tokens)
    return F.forall(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.forall(F.slice(words, i + 2, F.greatest(F.size(words) - i - 1, F.lit(0))), lambda w: F.arrays_overlap(F.get(words, i), w)))


def compare_entity(gold: Column | str, pred: Column | str) -> Column:
    """COR, PAR, INC, MIS or SPU of two normalised values, null if both are absent."""
    g, p = col_of(gold), col_of(pred)
    overlap = g.contains(p) | p.contains(g) | F.arrays_overlap(F.split(g, "_"), F.split(p, "_"))
    return F.when(g.isNull() & p.isNull(), F.lit(None).cast("string")).when(p.isNull(), "MIS").when(g.isNull(), "SPU").when(g == p, "COR").when(overlap, "PAR").otherwise("INC")
