"""Extraction scores, exact names, benchmark summaries and percentiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import compare_entity
from ..functions.text import ENTITIES
from .classify import HIGH

CATEGORIES = ["COR", "INC", "PAR", "MIS", "SPU"]
# The columns of a benchmark summary, in order.
SUMMARY = ["model", "mode", "n", "extraction_errors", *(f"{e}_f1_{kind}" for kind in ("strict", "partial") for e in ENTITIES), "cpe_valid", "cpe_exact", "m1x", "latency_ms_p50", "latency_ms_p95", "tokens_in", "tokens_out", "wall_s"]


def gold_join(results: DataFrame, gold: DataFrame) -> DataFrame:
    """results with g_<entity>: inner on title, the last gold row of a title wins."""
    last = gold.groupBy("title").agg(F.max_by(F.struct(*ENTITIES), "pos").alias("g"))
    return results.join(last.select("title", *[F.col(f"g.{e}").alias(f"g_{e}") for e in ENTITIES]), "title")


def entity_categories(joined: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per title (and run) and entity with its category (null: both absent)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(e).alias("entity"), F.col(f"g_{e}").alias("gold"), F.col(e).alias("pred")) for e in ENTITIES]))
    return joined.select(*by, "title", pairs.alias("x")).select(*by, "title", "x.entity", compare_entity(F.col("x.gold"), F.col("x.pred")).alias("category"))


def entity_counts(categories: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return categories.groupBy(*by, "entity").agg(*[F.count_if(F.coalesce(F.col("category") == c, F.lit(False))).alias(c.lower()) for c in CATEGORIES])


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def entity_scores(counts: DataFrame) -> DataFrame:
    """possible, actual and strict and partial precision, recall and F1."""
    c = {k: F.col(k.lower()) for k in CATEGORIES}
    out = counts.withColumns({"possible": c["COR"] + c["INC"] + c["PAR"] + c["MIS"], "actual": c["COR"] + c["INC"] + c["PAR"] + c["SPU"]})
    for kind, hit in (("strict", c["COR"].cast("double")), ("partial", c["COR"] + 0.5 * c["PAR"])):
        out = out.withColumns({f"{kind}_precision": _ratio(hit, F.col("actual")), f"{kind}_recall": _ratio(hit, F.col("possible"))})
        p, r = F.col(f"{kind}_precision"), F.col(f"{kind}_recall")
        out = out.withColumn(f"{kind}_f1", _ratio(2 * p * r, p + r))
    return out


def exact_counts(joined: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """n, exact (four entities equal), valid and errors over joined rows (of each run)."""
    same = [F.coalesce(F.col(f"g_{e}"), F.lit("")) == F.coalesce(F.col(e), F.lit("")) for e in ENTITIES]
    exact = same[0] & same[1] & same[2] & same[3]
    return joined.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(exact & F.col("valid")).alias("cpe_exact"), F.count_if("valid").alias("cpe_valid"), F.count_if(F.col("error").isNotNull()).alias("extraction_errors"))


def percentiles(rows: DataFrame, keys: list[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """keys and, for each name: quantile, the value of rank round-half-even(q * (n - 1)); 0 for no values.

    Values are counted first, so that a key's window holds its distinct values only.
    """
    counts = rows.groupBy(*keys, value).agg(F.count(value).alias("_n"))
    whole = Window.partitionBy(*keys)
    before = F.sum("_n").over(whole.orderBy(F.col(value).asc_nulls_first()))
    ranked = counts.withColumns({"_upto": before, "_all": F.sum("_n").over(whole)})
    pick = {n: F.min(F.when((F.col("_n") > 0) & (F.col("_upto") > F.bround(F.lit(q) * (F.col("_all") - 1))), F.col(value))) for n, q in quantiles.items()}
    return ranked.groupBy(*keys).agg(*[F.coalesce(c, F.lit(0).cast(rows.schema[value].dataType)).alias(n) for n, c in pick.items()])


def benchmark_summary(rows: DataFrame, scores: DataFrame | None = None, exact: DataFrame | None = None, wall: DataFrame | None = None) -> DataFrame:
    """Per model and mode: n, errors, F1s, valid and exact names, M1x, latency percentiles, tokens, seconds.

    scores are entity_scores(by=model, mode) and exact is exact_counts(by=model,
    mode) of the runs that have a gold set, wall(model, mode, wall_s) the time of
    each; what is not given is 0, as it is for runs without gold.
    """
    combo = ["model", "mode"]
    out = rows.groupBy(*combo).agg(F.count("*").alias("n"), F.count_if(F.col("rule").isin(*HIGH)).alias("m1x"), F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"))
    out = out.join(percentiles(rows, combo, "latency_ms", {"latency_ms_p50": 0.5, "latency_ms_p95": 0.95}), combo)
    f1s = [f"{e}_f1_{kind}" for kind in ("strict", "partial") for e in ENTITIES]
    if scores is not None:
        wide = scores.groupBy(*combo).agg(*[F.round(F.max(F.when(F.col("entity") == e, F.col(f"{kind}_f1"))), 4).alias(f"{e}_f1_{kind}") for kind in ("strict", "partial") for e in ENTITIES])
        out = out.join(wide, combo, "left")
    if exact is not None:
        out = out.join(exact.select(*combo, "cpe_valid", "cpe_exact", "extraction_errors"), combo, "left")
    if wall is not None:
        out = out.join(wall.select(*combo, "wall_s"), combo, "left")
    missing = {c: F.lit(0.0) for c in [*f1s, "wall_s"] if c not in out.columns} | {c: F.lit(0).cast("long") for c in ("cpe_valid", "cpe_exact", "extraction_errors") if c not in out.columns}
    return out.withColumns(missing).na.fill(0).select(*SUMMARY)


def benchmark_rank(summary: DataFrame) -> DataFrame:
    """Best strict product F1, then vendor F1, first, with its rank."""
    order = [F.desc("product_f1_strict"), F.desc("vendor_f1_strict"), "model", "mode"]
    return summary.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order))).orderBy("rank")


def pending_combos(models: DataFrame, modes: DataFrame, finished: DataFrame) -> DataFrame:
    """Every model with every mode that is not finished (both lists are a user's)."""
    return models.crossJoin(F.broadcast(modes)).join(finished, ["model", "mode"], "left_anti")
