"""Sinks: Parquet for tables, CSV and Markdown at the edges."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import ENTITIES
from ..storage import replace, write_text
from .files import file_digests


def write_results(results: DataFrame, path: str) -> None:
    """Append results; each write commits whole or not at all."""
    results.write.mode("append").parquet(path)


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """CSV with doubled quotes; arrays are joined by commas, booleans are 0 or 1."""
    edge: list[Column] = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        edge.append((F.array_join(c, ",") if kind == "array<string>" else F.when(c, "1").otherwise("0") if kind == "boolean" else c).alias(name))
    df.select(*edge).write.mode("overwrite").option("header", header).option("escape", '"').csv(path)


def write_metrics(spark: SparkSession, path: str, **metrics: object) -> None:
    """A run's figures as one JSON file; one-row frames give their columns."""
    plain = {k: v.first().asDict() if isinstance(v, DataFrame) else v for k, v in metrics.items()}
    write_text(spark, path, json.dumps(plain, indent=2, default=str) + "\n")


def digests(spark: SparkSession, *paths: str) -> dict[str, str]:
    """SHA-256 of the files below each path."""
    return {r.path: r.sha256 for p in paths for r in file_digests(spark, p).orderBy("path").collect()}


def write_cache(cache: DataFrame, path: str) -> None:
    """query and payload as a table that takes the old one's place when it is whole."""
    replace(cache.select("query", "payload"), path)


def write_titles(titles: DataFrame, path: str) -> None:
    """One headerless column, in input order."""
    titles.orderBy("pos").select("title").write.mode("overwrite").option("escape", '"').csv(path)


def write_curation(catalog: DataFrame, rejects: DataFrame, normalized: DataFrame, path: str) -> None:
    write_csv(catalog.drop("line"), f"{path}/catalog")
    rejects.write.mode("overwrite").json(f"{path}/rejects")
    normalized.write.mode("overwrite").json(f"{path}/normalized")


def write_routes(routed: DataFrame, path: str) -> None:
    """One folder for each route."""
    routed.write.mode("overwrite").partitionBy("route").parquet(path)


def write_splits(dealt: DataFrame, path: str) -> None:
    dealt.drop("pairs").write.mode("overwrite").partitionBy("split").parquet(path)


def split_sizes(dealt: DataFrame) -> DataFrame:
    """rows and families of each split."""
    return dealt.groupBy("split").agg(F.count("*").alias("rows"), F.count_distinct("family").alias("families"))


def manifest(sizes: DataFrame, sources: dict[str, str], seed: int) -> str:
    """Markdown of split_sizes() and the digests of the source files."""
    lines = [f"# Splits (seed {seed})", "", "| split | rows | families |", "|---|---|---|", *[f"| {r.split} | {r.rows} | {r.families} |" for r in sizes.orderBy("split").collect()]]
    return "\n".join([*lines, "", "| file | sha256 |", "|---|---|", *[f"| {p} | {d} |" for p, d in sources.items()]]) + "\n"


def evaluation_report(scores: DataFrame, rules: DataFrame, exact: DataFrame) -> str:
    """Markdown of entity scores, rule shares and exact names."""
    by = {r.entity: r for r in scores.collect()}
    e = exact.first()
    lines = ["# Evaluation", "", f"{e.n} titles, {e.cpe_exact} exact, {e.cpe_valid} valid, {e.extraction_errors} errors", "", "| entity | strict F1 | partial F1 |", "|---|---|---|"]
    lines += [f"| {k} | {by[k].strict_f1:.4f} | {by[k].partial_f1:.4f} |" for k in ENTITIES if k in by]
    lines += ["", "| rule | n | % | 2023 % |", "|---|---|---|---|"]
    lines += [f"| {r.rule} | {r.n} | {r.percent:.2f} | {'' if r.baseline_percent is None else r.baseline_percent} |" for r in rules.orderBy("rule").collect()]
    return "\n".join(lines) + "\n"


def ranking_report(ranked: DataFrame) -> str:
    """Markdown of benchmark_rank()."""
    rows = ranked.orderBy("rank").collect()
    lines = ["# Benchmark", "", *([f"{rows[0].n} titles in the first combination; latency in ms."] if rows else []), ""]
    lines += ["| # | model | mode | F1 vendor | F1 product | F1 version | partial F1 v/p/v | valid | exact | M1x | p50 | p95 | tokens in/out |", "|" + "---|" * 13]
    for r in rows:
        partial = "/".join(f"{r[f'{e}_f1_partial']:.2f}" for e in ENTITIES[:3])
        strict = " | ".join(f"{r[f'{e}_f1_strict']:.3f}" for e in ENTITIES[:3])
        lines.append(f"| {r['rank']} | {r.model} | {r['mode']} | {strict} | {partial} | {r.cpe_valid}/{r.n} | {r.cpe_exact}/{r.n} | {r.m1x} | {r.latency_ms_p50} | {r.latency_ms_p95} | {r.tokens_in}/{r.tokens_out} |")
    return "\n".join(lines) + "\n"


def write_vulns(rolled: DataFrame, path: str) -> None:
    rolled.select("title", "cpe", "rule", "vulnerable", "n_cves", "max_score", "cve_ids", "error").write.mode("overwrite").option("header", True).csv(path)
