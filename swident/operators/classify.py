"""The rule cascade: exact, new version, new product, new vendor, no match.

Queries have a key, raw vendor/product/version ('' for none), their bound text
b_vendor/b_product and the bound name; candidates come from joins and meet what
is asked as a few conditional aggregates, never as arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import similarity
from .dictionary import CANDIDATE_CAP, candidate_union, capped, pair_lookup, pair_misses, representatives

THRESHOLD = 0.8
# Rules and their names, in order.
RULES = {
    "M1": "exact match",
    "M1A": "vendor, product and version match",
    "M1B": "new version",
    "M1C": "new vendor and product pair",
    "M2": "new product",
    "M3": "similar vendor",
    "M2B": "new vendor",
    "M4": "no match",
}
HIGH = ["M1", "M1A", "M1B", "M1C"]
#: Shares of the rules in the 2023 baseline, in per cent (fixed values).
BASELINE = {"M1": 1.18, "M1A": 1.91, "M1B": 0.76, "M1C": 1.04, "M2": 53.28, "M2B": 3.52, "M3": 38.31, "M4": None}


def _best(sim: Column, where: Column) -> Column:
    """(sim, name) of the most similar candidate; of equals the first."""
    return F.max_by(F.struct(sim.alias("sim"), F.col("d_name").alias("name")), F.when(where, F.struct(sim, -F.col("place"))))


ASK = ["name", "vendor", "product", "version", "b_vendor", "b_product"]
PAIR = ["vendor", "product", "b_vendor", "b_product"]


def _place() -> Column:
    """Order of candidates: by rank, then as in the dictionary."""
    return F.col("rank") * F.lit(1 << 40) + F.col("ord")


def _facts(cands: DataFrame, keys: list[str], exact: bool, loose: bool) -> DataFrame:
    """Per key the facts that the cascade asks for; deprecated and malformed entries don't count.

    exact: facts of entries with the same pair, which look at name and version;
    loose: facts of the vendor or the product alone.
    """
    rows = cands.withColumn("place", _place())
    live = ~F.col("deprecated") & F.col("parsed")
    same_v = live & (F.col("vendor") != "") & (F.col("raw_vendor") == F.col("vendor"))
    same_p = live & (F.col("product") != "") & (F.col("raw_product") == F.col("product"))
    pair = live & (F.col("raw_vendor") == F.col("vendor")) & (F.col("raw_product") == F.col("product"))
    first = lambda where: F.min_by("d_name", F.when(where, F.col("place")))
    facts = []
    if exact:
        same_version = pair & (F.col("version") != "") & (F.col("raw_version") == F.col("version"))
        facts += [first(live & (F.col("d_name") == F.col("name"))).alias("m1"), first(same_version).alias("m1a"), _best(similarity("version", "raw_version"), pair).alias("m1b"), F.bool_or(pair).alias("has_pair")]
    if loose:
        facts += [F.bool_or(same_v).alias("has_v"), F.bool_or(same_p).alias("has_p"), _best(similarity("product", "raw_product"), same_v).alias("m2"), _best(similarity("vendor", "raw_vendor"), same_p).alias("m3"), first(same_p).alias("m2b")]
    return rows.groupBy(*keys).agg(*facts, F.max("place").alias("last"))


def match_facts(asks: DataFrame, dictionary: DataFrame, cap: int | None = CANDIDATE_CAP) -> DataFrame:
    """ASK with the facts of its candidates.

    Asks whose pair is known meet its entries.  The others fall back to entries
    of the vendor and of the product; what is asked of those depends on the pair
    alone, so each distinct pair meets them once.  Only entries that have the same
    pair as raw text (bound in another way) are met by each ask.
    """
    known = _facts(pair_lookup(asks, dictionary, cap), ASK, exact=True, loose=True).drop("last")
    misses, reps = pair_misses(asks, dictionary), representatives(dictionary)
    pairs = misses.select(*PAIR).distinct()
    loose = _facts(capped(candidate_union(pairs, reps, PAIR, cap), PAIR, cap), PAIR, exact=False, loose=True)
    by_vendor, by_product = F.col("b_vendor") == F.col("d_vendor"), F.col("b_product") == F.col("d_product")
    alike = misses.join(reps, (F.col("raw_vendor") == F.col("vendor")) & (F.col("raw_product") == F.col("product")) & (by_vendor | by_product)).withColumn("rank", F.when(by_vendor, 1).otherwise(2))
    other = misses.join(loose, PAIR)
    exact = _facts(alike.join(loose.select(*PAIR, "last"), PAIR).where(_place() <= F.col("last")).drop("last"), ASK, exact=True, loose=False).drop("last")
    return known.unionByName(other.join(exact, ASK, "left").select(*known.columns))


def decide(facts: DataFrame) -> DataFrame:
    """rule, rule_name, similarity, matched_name from the facts (null facts: M4)."""
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    rule = (
        F.when(F.col("m1").isNotNull(), "M1")
        .when(F.col("m1a").isNotNull(), "M1A")
        .when(yes("has_pair"), "M1B")
        .when(yes("has_v") & yes("has_p"), "M1C")
        .when(yes("has_v"), "M2")
        .when(yes("has_p") & (F.col("m3.sim") > THRESHOLD), "M3")
        .when(yes("has_p"), "M2B")
        .otherwise("M4")
    )
    out = facts.withColumn("rule", rule)
    r = F.col("rule")
    sim = F.when(r == "M1B", F.col("m1b.sim")).when(r == "M2", F.col("m2.sim")).when(r == "M3", F.col("m3.sim")).when(r == "M4", 0.0).otherwise(1.0)
    matched = F.when(r == "M1", F.col("m1")).when(r == "M1A", F.col("m1a")).when(r == "M1B", F.col("m1b.name")).when((r == "M2") & (F.col("m2.sim") > THRESHOLD), F.col("m2.name")).when(r == "M3", F.col("m3.name")).when(r == "M2B", F.col("m2b"))
    names = F.create_map(*[F.lit(x) for kv in RULES.items() for x in kv])
    facts_only = ("m1", "m1a", "m1b", "has_pair", "has_v", "has_p", "m2", "m3", "m2b")
    return out.withColumns({"rule_name": F.element_at(names, r), "similarity": sim, "matched_name": matched}).drop(*facts_only)


def classify(queries: DataFrame, dictionary: DataFrame, key: str, cap: int | None = CANDIDATE_CAP) -> DataFrame:
    """Every query with its rule.  dictionary is prepared(); cap bounds candidates.

    Equal queries are classified once and joined back by what they ask.
    """
    facts = match_facts(queries.select(*ASK).distinct(), dictionary, cap)
    return decide(queries.join(facts, ASK, "left").select(*queries.columns, *[c for c in facts.columns if c not in ASK]))


def rule_distribution(classified: DataFrame) -> DataFrame:
    """rule, n, percent and the baseline's percent for all eight rules."""
    spark = classified.sparkSession
    rules = spark.createDataFrame([(k, float(v) if v is not None else None) for k, v in BASELINE.items()], "rule string, baseline_percent double")
    # the total is the sum of the counts, over at most nine rows
    counts = classified.groupBy("rule").agg(F.count("*").alias("n")).withColumn("total", F.sum("n").over(Window.partitionBy(F.lit(0))))
    counts = rules.join(F.broadcast(counts), "rule", "left")
    total = F.max("total").over(Window.partitionBy(F.lit(0)))
    percent = F.when(F.col("total") > 0, 100.0 * F.col("n") / F.col("total")).otherwise(0.0)
    return counts.select("rule", F.coalesce("n", F.lit(0).cast("long")).alias("n"), F.coalesce(total, F.lit(0)).alias("total"), "baseline_percent").select("rule", "n", percent.alias("percent"), "baseline_percent")
