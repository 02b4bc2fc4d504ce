"""Two-model cascade, reclassification and resume."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import build_name
from .classify import HIGH, classify
from .inventory import last_of


def needs_escalation(error: Column, valid: Column, rule: Column) -> Column:
    """An error, an invalid name or a rule below M1C."""
    return error.isNotNull() | ~F.coalesce(valid, F.lit(False)) | ~F.coalesce(rule.isin(*HIGH), F.lit(False))


def is_resolved(rule: Column | str) -> Column:
    r = F.col(rule) if isinstance(rule, str) else rule
    return F.coalesce(r.isin(*HIGH), F.lit(False))


def tail(fast: DataFrame) -> DataFrame:
    return fast.where(~is_resolved("rule"))


def merge(fast: DataFrame, escalated: DataFrame, model: str) -> DataFrame:
    """fast rows, unresolved ones replaced by their escalated row (last of a title).

    Adds fast_rule and escalated_by; columns besides title, pos are replaced.
    """
    swap = [c for c in fast.columns if c not in ("title", "pos", "fast_rule")]
    last = last_of(escalated.select("title", *swap, "pos"), ["title"]).drop("pos")
    last = last.select("title", *[F.col(c).alias(f"e_{c}") for c in swap], F.lit(True).alias("found"))
    joined = fast.join(last, "title", "left")
    use = ~is_resolved("rule") & F.coalesce("found", F.lit(False))
    old_rule = F.when(use, F.col("rule")).otherwise(F.col("fast_rule") if "fast_rule" in fast.columns else F.lit("")).alias("fast_rule")
    return joined.select("title", "pos", *[F.when(use, F.col(f"e_{c}")).otherwise(F.col(c)).alias(c) for c in swap], old_rule, F.when(use, model).otherwise("").alias("escalated_by"))


def escalate(fast: DataFrame, run: Callable[[DataFrame], DataFrame], model: str) -> DataFrame:
    """Run a larger model over the tail and merge what it gives: merge() of both passes.

    run maps the tail's rows to results with the same columns; titles that it
    doesn't give back keep their fast row.
    """
    return merge(fast, run(tail(fast)), model)


def counters(fast: DataFrame, merged: DataFrame) -> DataFrame:
    """rows, tail, escalated_done, m1x_before, m1x_after.

    A tail row counts as m1x_after only if it was escalated and resolved.
    """
    before = fast.agg(F.count("*").alias("rows"), F.count_if(~is_resolved("rule")).alias("tail"), F.count_if(is_resolved("rule")).alias("m1x_before"))
    after = merged.agg(F.count_if(F.col("escalated_by") != "").alias("escalated_done"), F.count_if(is_resolved("rule")).alias("m1x_after"))
    return before.crossJoin(after)  # one row each


def transition(old: Column, new: Column, arrow: str = " -> ", none: str = "(none)") -> Column:
    blank = lambda c: F.when(c.isNull() | (c == ""), F.lit(none)).otherwise(c)
    return F.concat(blank(old), F.lit(arrow), blank(new))


def transition_counts(changes: DataFrame) -> DataFrame:
    """transition and n of the rows whose rule changed."""
    changed = changes.where(~F.col("old_rule").eqNullSafe(F.col("new_rule")))
    return changed.groupBy(transition(F.col("old_rule"), F.col("new_rule")).alias("transition")).agg(F.count("*").alias("n"))


def top_transitions(counts: DataFrame, k: int = 8) -> DataFrame:
    return counts.orderBy(F.desc("n"), "transition").limit(k)


def reclassify(results: DataFrame, dictionary: DataFrame, key: str = "pos") -> DataFrame:
    """results with rule, similarity and match found anew where the stored name stands.

    Invalid rows and rows whose rebuilt name differs pass unchanged; status tells
    which: reclassified, unchanged_invalid or cpe_mismatch.  Extra columns stay.
    """
    from ..functions.names import bind_raw, normalize_raw

    raw = lambda c: F.coalesce(normalize_raw(c), F.lit(""))
    rebuilt = build_name(F.col("vendor"), F.col("product"), F.col("version"), F.col("update"), F.col("target_sw"))
    usable = F.col("valid") & F.coalesce(F.col("cpe") != "", F.lit(False))
    status = F.when(~F.coalesce(usable, F.lit(False)), "unchanged_invalid").when(~rebuilt.eqNullSafe(F.col("cpe")), "cpe_mismatch").otherwise("reclassified")
    marked = results.withColumn("status", status)
    queries = marked.where("status = 'reclassified'").select(key, F.col("cpe").alias("name"), *[raw(c).alias(c) for c in ("vendor", "product", "version")], bind_raw("vendor").alias("b_vendor"), bind_raw("product").alias("b_product"))
    new = classify(queries, dictionary, key).select(key, F.col("rule").alias("new_rule"), F.col("rule_name").alias("new_name"), F.col("similarity").alias("new_similarity"), F.col("matched_name").alias("new_match"))
    joined = marked.join(new, key, "left")
    done = F.col("status") == "reclassified"
    out = joined.withColumn("old_rule", F.col("rule")).withColumn("rule", F.when(done, F.col("new_rule")).otherwise(F.col("rule")))
    return out.withColumn("matched_cpe", F.when(done, F.coalesce("new_match", F.lit(""))).otherwise(F.col("matched_cpe"))).withColumn("match_similarity", F.when(done, F.col("new_similarity")).otherwise(F.col("match_similarity"))).drop("new_rule", "new_name", "new_similarity", "new_match")


def reclassify_counters(out: DataFrame) -> DataFrame:
    """rows, reclassified, unchanged_invalid, cpe_mismatch and changed (another rule than before)."""
    kinds = ["reclassified", "unchanged_invalid", "cpe_mismatch"]
    changed = (F.col("status") == "reclassified") & ~F.col("old_rule").eqNullSafe(F.col("rule"))
    return out.agg(F.count("*").alias("rows"), *[F.count_if(F.col("status") == k).alias(k) for k in kinds], F.count_if(changed).alias("changed"))


def remaining(titles: DataFrame, done: DataFrame) -> DataFrame:
    """Titles that a former run has not written yet."""
    return titles.join(done.select("title").distinct(), "title", "left_anti")
