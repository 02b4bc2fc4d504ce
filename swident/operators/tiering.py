"""Dictionary contrast of alias sets, quarantine and tiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import vendor_product
from ..functions.similarity import products_share_tokens
from ..functions.text import creator


def contrast(rows: DataFrame, dictionary: DataFrame, key: str = "key") -> DataFrame:
    """rows(key, cpes) with n_in_dict, n_deprecated, n_pairs_known and unknown_pairs.

    Aliases are exploded once, met by pair and by name, and folded back by key;
    unknown pairs come one per alias, in the aliases' order.
    """
    aliases = rows.select(key, F.posexplode("cpes").alias("i", "alias")).withColumn("pair", vendor_product("alias"))
    pairs = dictionary.select(F.struct(F.col("d_vendor").alias("vendor"), F.col("d_product").alias("product")).alias("pair")).distinct().withColumn("pair_known", F.lit(True))
    names = dictionary.groupBy(F.col("d_name").alias("alias")).agg(F.min_by("deprecated", "ord").alias("is_deprecated"))
    met = aliases.join(pairs, "pair", "left").join(names, "alias", "left")
    unknown = F.array_sort(F.collect_list(F.when(F.col("pair_known").isNull(), F.struct("i", "pair"))))
    facts = met.groupBy(key).agg(F.count("is_deprecated").alias("n_in_dict"), F.count_if("is_deprecated").alias("n_deprecated"), F.count("pair_known").alias("n_pairs_known"), F.transform(unknown, lambda u: u.pair).alias("unknown_pairs"))
    none = F.array().cast("array<struct<vendor:string,product:string>>")
    return rows.join(facts, key, "left").na.fill(0, ["n_in_dict", "n_deprecated", "n_pairs_known"]).withColumn("unknown_pairs", F.coalesce("unknown_pairs", none))


def quarantine_reason(with_dictionary: bool = True) -> F.Column:
    """Reason for an alias set of several vendors with unrelated products, else null."""
    pairs = F.transform("cpes", vendor_product)
    vendors = F.array_distinct(F.transform(pairs, lambda p: p.vendor))
    products = F.transform(pairs, lambda p: p["product"])
    odd = (F.size("cpes") >= 2) & (F.size(vendors) >= 2) & ~products_share_tokens(products)
    if not with_dictionary:
        return F.when(odd, F.lit("incompatible_vendors:no_dictionary"))
    listed = F.array_join(F.transform("unknown_pairs", lambda p: F.concat(p.vendor, F.lit(":"), p["product"])), ",")
    return F.when(odd & (F.size("unknown_pairs") > 0), F.concat(F.lit("incompatible_vendors:"), listed))


def route(rows: DataFrame, with_dictionary: bool = True) -> DataFrame:
    """rows with creator, reason and route: quarantine, else A (override), else B."""
    out = rows.withColumn("creator", creator("created_by")).withColumn("reason", quarantine_reason(with_dictionary))
    return out.withColumn("route", F.when(F.col("reason").isNotNull(), "quarantine").when(F.col("has_override"), "A").otherwise("B"))


def counters(routed: DataFrame) -> DataFrame:
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return routed.agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col("route") == r).alias(f"n_{r.lower()}") for r in ("A", "B", "quarantine")],
        total(F.size("cpes")).alias("aliases_contrasted"),
        total("n_in_dict").alias("aliases_in_dict"),
        total("n_deprecated").alias("aliases_deprecated"),
        total("n_pairs_known").alias("pairs_known"),
    )
