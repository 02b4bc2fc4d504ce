"""Catalog curation: keys, aliases, validation and salvage, keyed dedupe.

Aliases stay arrays and are worked on by higher-order functions; the only
shuffle is the window that finds the first keepable row of a key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import canonicalize_alias, is_valid_name, surrogate_key, validation_errors
from ..functions.text import split_aliases, strip

REQUIRED = ["CPE", "Edition", "Title", "Product", "Product Version", "Vendor", "Vuln DB ID", "Created By"]


def override_flag(columns: list[str]) -> F.Column:
    """True if any column whose name begins with Override is not blank."""
    marks = [strip(F.coalesce(F.col(f"`{c}`"), F.lit(""))) != "" for c in columns if c.startswith("Override")]
    return reduce(lambda a, b: a | b, marks, F.lit(False))


def judged_rows(export: DataFrame) -> DataFrame:
    """Every export row with key, aliases and outcome (kept or a reject reason).

    export has line (its place), malformed and the required columns.  Per key,
    rows before the first keepable one fail for their own reason and every later
    row is a duplicate.
    """
    missing = [c for c in REQUIRED if c not in export.columns]
    if missing:
        raise ValueError(f"input is missing expected columns: {missing}")
    cell = lambda c: strip(F.coalesce(F.col(f"`{c}`"), F.lit("")))
    rows = export.select(
        "line",
        "malformed",
        cell("CPE").alias("cell"),
        cell("Title").alias("title"),
        cell("Vuln DB ID").alias("given"),
        *[cell(c).alias(a) for c, a in (("Product", "product"), ("Product Version", "version"), ("Vendor", "vendor"), ("Edition", "edition"), ("Created By", "created_by"))],
        override_flag(export.columns).alias("has_override"),
    )
    rows = rows.withColumns({"key": F.when(F.col("given") != "", F.col("given")).otherwise(surrogate_key("title", "cell")), "key_source": F.when(F.col("given") != "", "vulndb").otherwise("derived"), "aliases": split_aliases("cell"), "raw_count": F.size(F.split("cell", r"(?<!\\),"))})
    tried = F.transform("aliases", lambda a: F.struct(a.alias("alias"), is_valid_name(a).alias("ok"), canonicalize_alias(a).alias("canonical")))
    rows = rows.withColumn("tried", tried)
    salvaged = lambda t: ~t.ok & F.coalesce(is_valid_name(t.canonical), F.lit(False))
    rows = rows.withColumns(
        {
            "valid": F.array_distinct(F.transform(F.filter("tried", lambda t: t.ok | salvaged(t)), lambda t: F.when(t.ok, t["alias"]).otherwise(t.canonical))),
            "normalized": F.transform(F.filter("tried", salvaged), lambda t: F.struct(t["alias"].alias("alias"), t.canonical.alias("canonical"))),
            "dropped": F.transform(F.filter("tried", lambda t: ~t.ok & ~salvaged(t)), lambda t: t["alias"]),
        }
    ).drop("tried", "given")
    keepable = ~F.col("malformed") & (F.size("valid") > 0)
    first = F.min(F.when(keepable, F.col("line"))).over(Window.partitionBy(F.when(~F.col("malformed"), F.col("key"))))
    outcome = (
        F.when(F.col("malformed"), "malformed_row")
        .when(F.col("line") > first, "duplicate_key")
        .when(F.col("cell") == "", "no_cpe")
        .when(F.size("valid") == 0, "all_aliases_invalid")
        .otherwise("kept")
    )
    return rows.withColumn("outcome", outcome)


def catalog(judged: DataFrame) -> DataFrame:
    """The kept rows with their valid aliases."""
    return judged.where("outcome = 'kept'").select("key", "key_source", "title", "product", "version", "vendor", "edition", F.size("valid").cast("long").alias("n_aliases"), F.col("valid").alias("cpes"), "created_by", "has_override", F.size("normalized").cast("long").alias("n_normalized_aliases"), F.size("dropped").cast("long").alias("n_dropped_aliases"), "line")


def rejects(judged: DataFrame) -> DataFrame:
    """step, reason, key, line and detail of rejected rows and dropped aliases."""
    detail = F.when(F.col("outcome") == "all_aliases_invalid", F.col("cell")).otherwise(F.col("title"))
    step = F.when(F.col("outcome") == "all_aliases_invalid", "validate").otherwise("parse")
    rows = judged.where("outcome <> 'kept'").select(step.alias("step"), F.col("outcome").alias("reason"), F.when(F.col("outcome") == "malformed_row", "").otherwise(F.col("key")).alias("key"), "line", detail.alias("detail"))
    aliases = judged.where("outcome in ('kept', 'all_aliases_invalid')").select("key", "line", F.explode("dropped").alias("detail"))
    bad = aliases.select(F.lit("validate").alias("step"), F.concat(F.lit("abnf:"), F.get(validation_errors("detail"), F.lit(0))).alias("reason"), "key", "line", "detail")
    return rows.unionByName(bad)


def normalizations(judged: DataFrame) -> DataFrame:
    """alias, canonical, key and line of the salvaged aliases."""
    return judged.where("outcome in ('kept', 'all_aliases_invalid')").select(F.explode("normalized").alias("n"), "key", "line").select(F.col("n")["alias"].alias("alias"), "n.canonical", "key", "line")


def counters(judged: DataFrame) -> DataFrame:
    """The twelve counters of a curation run in one row."""
    is_ = lambda x: F.col("outcome") == x
    worked = is_("kept") | is_("all_aliases_invalid")
    total = lambda c: F.coalesce(F.sum(F.when(worked, c)), F.lit(0)).cast("long")
    return judged.agg(
        F.count("*").alias("rows_read"),
        F.count_if(is_("malformed_row")).alias("rows_malformed"),
        F.count_if(~is_("malformed_row") & (F.col("key_source") == "derived")).alias("keys_derived"),
        F.count_if(is_("duplicate_key")).alias("keys_duplicated"),
        F.count_if(is_("no_cpe")).alias("rows_rejected_no_cpe"),
        F.count_if(is_("all_aliases_invalid")).alias("rows_rejected_all_aliases_invalid"),
        F.count_if(is_("kept")).alias("rows_kept"),
        total(F.size("aliases")).alias("aliases_seen"),
        total(F.col("raw_count") - F.size("aliases")).alias("aliases_deduped"),
        total(F.size("valid")).alias("aliases_valid"),
        total(F.size("normalized")).alias("aliases_normalized"),
        total(F.size("dropped")).alias("aliases_dropped"),
    )
