"""Vulnerability join: eligibility, cache lookup, projection and rollup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import is_valid_name

DEFAULT_RULES = ["M1", "M1A"]
SCORE_VERSIONS = ["cvssMetricV40", "cvssMetricV31", "cvssMetricV30", "cvssMetricV2"]
METRIC = "array<struct<baseSeverity:string,cvssData:struct<baseScore:double,baseSeverity:string>>>"
ITEM = "struct<id:string,descriptions:array<struct<lang:string,value:string>>,metrics:struct<" + ",".join(f"{v}:{METRIC}" for v in SCORE_VERSIONS) + ">>"


def project_item(item: Column) -> Column:
    """cve_id, severity, score and short description of one item struct.

    The newest score version with entries counts, whether or not it has a score.
    """
    first = None
    for v in SCORE_VERSIONS:
        entries = item.getField("metrics").getField(v)
        has = F.coalesce(F.size(entries) > 0, F.lit(False))
        first = F.when(has, F.get(entries, F.lit(0))) if first is None else first.when(has, F.get(entries, F.lit(0)))
    data = first.getField("cvssData")
    severity = F.coalesce(F.nullif(data.getField("baseSeverity"), F.lit("")), first.getField("baseSeverity"), F.lit(""))
    english = F.get(F.filter(item.getField("descriptions"), lambda d: d.lang == "en"), F.lit(0)).value
    return F.struct(F.coalesce(item.getField("id"), F.lit("")).alias("cve_id"), severity.alias("severity"), data.getField("baseScore").alias("score"), F.coalesce(F.substring(english, 1, 200), F.lit("")).alias("description"))


def eligible(results: DataFrame, rules: list[str] | None = None) -> DataFrame:
    """Rows of the given rules whose name still follows the grammar."""
    named = F.coalesce(F.col("cpe") != "", F.lit(False))
    return results.where(named & F.col("rule").isin(*(rules or DEFAULT_RULES)) & is_valid_name(F.col("cpe")))


def effective_name(matched: Column | str, own: Column | str) -> Column:
    col = lambda x: F.col(x) if isinstance(x, str) else x
    return F.coalesce(F.nullif(col(matched), F.lit("")), col(own))


def wanted(results: DataFrame, known: DataFrame, rules: list[str] | None = None) -> DataFrame:
    """The distinct effective names (cpe) of eligible rows that known(cpe, ...) lacks."""
    names = eligible(results, rules).select(effective_name("matched_cpe", "cpe").alias("cpe")).distinct()
    return names.join(known.select("cpe"), "cpe", "left_anti")


def check(results: DataFrame, cache: DataFrame, rules: list[str] | None = None) -> DataFrame:
    """title, cpe, rule, vulnerable, cves and error of the eligible rows.

    cache(cpe, items) holds the known answers, and in `error`, if it has that, why
    a name has none; a name that it lacks is an offline miss.
    """
    rows = eligible(results, rules).select("title", effective_name("matched_cpe", "cpe").alias("cpe"), "rule")
    failed = F.col("error") if "error" in cache.columns else F.lit(None).cast("string")
    joined = rows.join(cache.select("cpe", F.transform("items", project_item).alias("cves"), failed.alias("failed")), "cpe", "left")
    return joined.select("title", "cpe", "rule", F.coalesce(F.size("cves") > 0, F.lit(False)).alias("vulnerable"), "cves", F.when(F.col("cves").isNull(), F.coalesce("failed", F.lit("offline cache miss"))).alias("error"))


def rollup(checked: DataFrame) -> DataFrame:
    """n_cves, max_score (without nulls) and the ids joined by `;`."""
    none = F.array().cast("array<string>")
    return checked.select("title", "cpe", "rule", "vulnerable", F.coalesce(F.size("cves"), F.lit(0)).cast("long").alias("n_cves"), F.array_max(F.transform("cves", lambda c: c.score)).alias("max_score"), F.array_join(F.coalesce(F.transform("cves", lambda c: c.cve_id), none), ";").alias("cve_ids"), F.coalesce("error", F.lit("")).alias("error"))
