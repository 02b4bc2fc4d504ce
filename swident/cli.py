"""Command line: python -m swident.cli VERB ..."""

from __future__ import annotations

import argparse
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.names import bind_raw, build_name, is_valid_name, normalize_raw, validation_errors
from .functions.text import parse_annotation, slug
from .operators import agent, cascade, classify, curation, dictionary, evaluate, extract, families, inventory, tiering, vulns
from .sources import files, rest, sinks
from .storage import exists, release, stored, write_text

FRACTIONS = {"benchmark_gold": 0.1, "test": 0.1, "train": 0.8}
#: The public services.
NAMES_URL = "https://services.nvd.nist.gov/rest/json/cpes/2.0"
CVES_URL = "https://services.nvd.nist.gov/rest/json/cves/2.0"
ENTITIES = ["vendor", "product", "version", "target_sw"]


def run_titles(titles: DataFrame, entries: DataFrame, **extraction: object) -> DataFrame:
    """Titles to results: extract (as extract.extracted), build, validate, classify."""
    e = stored(extract.extracted(titles, **extraction), "extracted")
    named = e.withColumn("built", F.when(F.col("error").isNull(), build_name(F.col("vendor"), F.col("product"), F.col("version"), F.col("update"), F.col("target_sw"))))
    named = named.withColumn("valid", F.coalesce(is_valid_name("built"), F.lit(False)))
    wrong = F.when(F.col("built").isNotNull() & ~F.col("valid"), F.array_join(validation_errors("built"), "; ")).otherwise("")
    nothing = F.when(F.col("error").isNull() & F.col("built").isNull(), "no vendor/product extracted").otherwise(F.col("error"))
    named = named.withColumns({"validation_errors": wrong, "error": nothing, "cpe": F.when(F.col("valid"), F.col("built"))}).drop("built")
    raw = lambda c: F.coalesce(normalize_raw(c), F.lit(""))
    q = named.where("valid").select("pos", F.col("cpe").alias("name"), *[raw(c).alias(c) for c in ("vendor", "product", "version")], bind_raw("vendor").alias("b_vendor"), bind_raw("product").alias("b_product"))
    ruled = classify.classify(stored(q), stored(dictionary.prepared(entries)), "pos")
    out = named.join(ruled.select("pos", "rule", "rule_name", F.col("similarity").alias("match_similarity"), F.col("matched_name").alias("matched_cpe")), "pos", "left")
    return out.withColumn("stage", F.lit("fast"))


def with_agent(results: DataFrame, entries: DataFrame) -> DataFrame:
    """results with the rows that need it resolved by the agent, which keep what the fast pass said as fast_rule."""
    hard = cascade.needs_escalation(F.col("error"), F.col("valid"), F.col("rule"))
    tail = results.where(hard)
    done = agent.resolve_with_agent(tail, stored(dictionary.prepared(entries)), "pos").select("pos", *extract.FIELDS, "confidence", F.col("name").alias("cpe"), "valid", "validation_errors", "rule", "rule_name", F.col("similarity").alias("match_similarity"), F.col("matched_name").alias("matched_cpe"), "error", "stage", "agent_turns", "note")
    kept = tail.select("pos", "title", F.col("rule").alias("fast_rule"), "latency_ms", "tokens_in", "tokens_out")
    return results.where(~hard).unionByName(kept.join(done, "pos"), allowMissingColumns=True)


def extraction(spark: SparkSession, a: argparse.Namespace, model: str | None = None) -> dict:
    """The arguments of extract.extracted that the command line asks for."""
    out: dict = {"provider": a.provider, "mode": a.mode}
    if a.provider == "replay":
        out["answers"] = files.read_replay(spark, a.answers or model or a.model)
    elif a.provider in extract.REMOTE:
        out["ask"] = extract.REMOTE[a.provider](a.url, model or a.model, os.environ.get("SWIDENT_API_KEY", ""))
    return out


def _gold(titles: DataFrame) -> DataFrame:
    """pos, title and normalised entities of the annotated titles."""
    e = titles.where("annotated is not null").select("pos", "title", parse_annotation("title", "annotated").alias("e"))
    return e.select("pos", "title", *[F.when(F.col(f"e.{k}").isNotNull(), normalize_raw(F.col(f"e.{k}"))).alias(k) for k in ENTITIES])


def _judged(results: DataFrame, gold: DataFrame) -> DataFrame:
    return evaluate.gold_join(results.withColumns({k: normalize_raw(k) for k in ENTITIES}), gold)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="swident")
    sub = p.add_subparsers(dest="verb", required=True)
    verb = lambda name, *args: [sub.add_parser(name)] and [sub.choices[name].add_argument(*a[0], **a[1]) for a in args]
    arg = lambda *n, **k: (n, k)
    model = [arg("--provider", choices=extract.PROVIDERS, default="positional"), arg("--mode", choices=extract.MODES, default="single"), arg("--model", default=""), arg("--url", default=""), arg("--answers")]
    verb("validate", arg("names", nargs="+"))
    for name in ("run", "agent"):
        verb(name, arg("titles"), arg("--dictionary", required=True), arg("--out", required=True), arg("--limit", type=int), *model)
    verb("inventory", arg("--source", choices=["dpkg", "rpm", "registry"], default="dpkg"), arg("--path"), arg("--out", required=True), arg("--keep-noise", action="store_true"))
    verb("curate", arg("export"), arg("--out", required=True))
    verb("dict", arg("snapshot", nargs="?"), arg("--build"), arg("--url", default=NAMES_URL), arg("--apikey", default=""), arg("--graph"), arg("--user", default="neo4j"), arg("--fetch"), arg("--pagesize", default="2000"))
    verb("tier", arg("catalog"), arg("--dictionary"), arg("--out", required=True))
    verb("split", arg("routed"), arg("--out", required=True), arg("--seed", type=int, default=20260804))
    verb("bench", arg("titles"), arg("--dictionary", required=True), arg("--models", nargs="+", required=True), arg("--modes", nargs="+", choices=extract.MODES, default=extract.MODES), arg("--out", required=True), arg("--limit", type=int), *[m for m in model if m[0][0] not in ("--mode", "--model")])
    verb("titles", arg("export"), arg("--columns", nargs="+", required=True), arg("--version"), arg("--sep", default=","), arg("--out", required=True), arg("--keep-noise", action="store_true"))
    verb("escalate", arg("fast"), arg("escalated", nargs="?"), arg("--dictionary"), arg("--out", required=True), *model)
    verb("reclassify", arg("results"), arg("--dictionary", required=True), arg("--out", required=True))
    verb("vulns", arg("results"), arg("--cache", required=True), arg("--rules", nargs="+", default=vulns.DEFAULT_RULES), arg("--out", required=True), arg("--url"), arg("--apikey", default=""))
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("swident").getOrCreate()
    try:
        return _run(a, spark)
    finally:
        release(spark)


def _titles(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    titles = files.read_titles(spark, a.titles)
    return stored(titles.orderBy("pos").limit(a.limit) if a.limit else titles, "titles")


def _bench(a: argparse.Namespace, spark: SparkSession) -> None:
    """Every model in every mode that is not finished yet, then the summary and the ranking of all."""
    titles, entries, summary = _titles(spark, a), files.read_snapshot(spark, a.dictionary), None
    gold = _gold(titles)
    for model in a.models:
        for mode in a.modes:
            name = spark.range(1).select(slug(F.lit(model)).alias("s")).first().s
            path = f"{a.out}/{name}__{mode}"
            if not exists(spark, f"{path}/summary"):
                a.mode, began = mode, time.monotonic()
                combo = {"model": F.lit(model), "mode": F.lit(mode)}
                results = run_titles(titles.select("pos", "title"), entries, **extraction(spark, a, model)).withColumns(combo)
                results.write.mode("overwrite").parquet(f"{path}/results")
                results, wall = spark.read.parquet(f"{path}/results"), round(time.monotonic() - began, 1)
                joined, by = stored(_judged(results, gold)), ("model", "mode")
                scores = evaluate.entity_scores(evaluate.entity_counts(evaluate.entity_categories(joined, by), by))
                took = spark.range(1).select(combo["model"].alias("model"), combo["mode"].alias("mode"), F.lit(wall).alias("wall_s"))
                evaluate.benchmark_summary(results, scores, evaluate.exact_counts(joined, by), took).write.parquet(f"{path}/summary")
            one = spark.read.parquet(f"{path}/summary")
            summary = one if summary is None else summary.unionByName(one)
    summary = stored(summary)
    sinks.write_csv(summary, f"{a.out}/bench_summary")
    report = sinks.ranking_report(evaluate.benchmark_rank(summary))
    write_text(spark, f"{a.out}/bench_report.md", report)
    print(report)


def _run(a: argparse.Namespace, spark: SparkSession) -> int:
    if a.verb == "validate":
        df = spark.createDataFrame([(i, n) for i, n in enumerate(a.names)], "pos long, name string")
        rows = df.select("pos", "name", is_valid_name("name").alias("ok"), validation_errors("name").alias("errors")).orderBy("pos").collect()
        for r in rows:
            print(f"{'VALID' if r.ok else 'INVALID'}  {r.name}" + "".join(f"\n  {e}" for e in r.errors))
        return 0 if all(r.ok for r in rows) else 1
    if a.verb in ("run", "agent"):
        titles, entries = _titles(spark, a), files.read_snapshot(spark, a.dictionary)
        results = stored(run_titles(titles.select("pos", "title"), entries, **extraction(spark, a)))
        if a.verb == "agent":
            results = stored(with_agent(results, entries))
        sinks.write_results(results, a.out)
        gold = _gold(titles)
        if not gold.isEmpty():
            joined = stored(_judged(results, gold))
            counts = evaluate.entity_counts(evaluate.entity_categories(joined))
            print(sinks.evaluation_report(evaluate.entity_scores(counts), classify.rule_distribution(results), evaluate.exact_counts(joined)))
    elif a.verb == "inventory":
        items = files.registry_items(spark) if a.source == "registry" else files.read_packages(spark, a.path, a.source)
        sinks.write_csv(inventory.curate_inventory(items, a.keep_noise).select("title", "name", "version", "vendor", "source"), a.out)
    elif a.verb == "curate":
        judged = stored(curation.judged_rows(files.read_catalog(spark, a.export, curation.REQUIRED)))
        sinks.write_curation(curation.catalog(judged), curation.rejects(judged), curation.normalizations(judged), a.out)
        counters = curation.counters(judged).first().asDict()
        sinks.write_metrics(spark, f"{a.out}/metrics.json", stats=counters, sources=sinks.digests(spark, a.export), outputs=sinks.digests(spark, f"{a.out}/*/part-*"))
        print(counters)
    elif a.verb == "dict":
        if a.build:
            more = {k: v for k, v in (("apikey", a.apikey), ("graph", a.graph), ("user", a.user), ("password", os.environ.get("SWIDENT_GRAPH_PASSWORD")), ("fetch", a.fetch)) if v}
            rest.build_snapshot(spark, a.build, f"{a.build}.checkpoint", url=a.url, pagesize=a.pagesize, **more)
            entries = files.read_snapshot(spark, a.build)
            sinks.write_metrics(spark, f"{a.build}.meta.json", snapshot=dictionary.snapshot_metrics(entries, is_valid_name("name")), page_size=int(a.pagesize), source="graph" if a.graph else "service")
        else:
            print(dictionary.statistics(dictionary.prepared(files.read_snapshot(spark, a.snapshot))).first().asDict())
    elif a.verb == "tier":
        rows = spark.read.option("header", True).option("escape", '"').csv(a.catalog).withColumns({"cpes": F.split("cpes", r"(?<!\\),"), "has_override": F.col("has_override") == "1", "created_by": F.coalesce("created_by", F.lit(""))})
        if a.dictionary:
            rows = tiering.contrast(rows, dictionary.prepared(files.read_snapshot(spark, a.dictionary)))
        routed = stored(tiering.route(rows, bool(a.dictionary)))
        sinks.write_routes(routed, f"{a.out}/routes")
        sinks.write_metrics(spark, f"{a.out}/metrics.json", stats=tiering.counters(routed) if a.dictionary else routed.groupBy("route").count().select(F.map_from_entries(F.collect_list(F.struct("route", "count"))).alias("routes")), sources=sinks.digests(spark, a.catalog))
    elif a.verb == "split":
        rows = spark.read.parquet(a.routed).where("route <> 'quarantine'").withColumnRenamed("route", "tier")
        dealt = stored(families.deal(families.families(rows), FRACTIONS, a.seed))
        if not families.leaks(dealt).isEmpty():
            raise RuntimeError("a pair is in more than one split")
        sinks.write_splits(dealt, f"{a.out}/splits")
        sizes, sources = stored(sinks.split_sizes(dealt)), sinks.digests(spark, f"{a.routed}/*/*.parquet")
        text = sinks.manifest(sizes, sources, a.seed)
        write_text(spark, f"{a.out}/MANIFEST.md", text)
        counts = {r.split: {"rows": r.rows, "families": r.families} for r in sizes.collect()}
        sinks.write_metrics(spark, f"{a.out}/split_metrics.json", seed=a.seed, fractions=FRACTIONS, counts=counts, rows=sum(c["rows"] for c in counts.values()), families=sum(c["families"] for c in counts.values()), sources=sources)
        print(text)
    elif a.verb == "bench":
        _bench(a, spark)
    elif a.verb == "titles":
        rows = files.read_export(spark, a.export, [*a.columns, *([a.version] if a.version else [])], a.sep)
        outcome = stored(inventory.title_outcome(rows, a.columns, a.version, keep_noise=a.keep_noise))
        sinks.write_titles(outcome.where("outcome = 'written'"), a.out)
        stats = inventory.title_counters(outcome).first().asDict()
        sinks.write_metrics(spark, f"{a.out}.metrics.json", source=a.export, cols=a.columns, version_col=a.version, keep_noise=a.keep_noise, stats=stats)
        print(stats)
    elif a.verb == "escalate":
        fast = stored(files.read_results(spark, a.fast))
        tail = cascade.tail(fast)
        sinks.write_titles(tail, f"{a.out}/escalate_titles")
        if a.escalated:
            rerun = lambda rows: files.read_results(spark, a.escalated)
        else:

            def rerun(rows: DataFrame) -> DataFrame:
                """The tail through a larger model; titles that a former run has written stay."""
                path = f"{a.out}/escalated"
                done = spark.read.parquet(path) if exists(spark, path) else None
                todo = cascade.remaining(rows.select("pos", "title"), done) if done is not None else rows.select("pos", "title")
                sinks.write_results(run_titles(todo, files.read_snapshot(spark, a.dictionary), **extraction(spark, a)), path)
                new = spark.read.parquet(path)
                return new.withColumns({c: F.lit(None).cast(fast.schema[c].dataType) for c in fast.columns if c not in new.columns})

        merged = stored(cascade.escalate(fast, rerun, a.model or "escalated"))
        sinks.write_csv(merged.orderBy("pos"), f"{a.out}/results_merged")
        stats = cascade.counters(fast, merged).first().asDict()
        changed = merged.where("escalated_by <> ''").select(F.col("fast_rule").alias("old_rule"), F.col("rule").alias("new_rule"))
        stats["transitions"] = {r.transition: r.n for r in cascade.top_transitions(cascade.transition_counts(changed), 100).collect()}
        sinks.write_metrics(spark, f"{a.out}/metrics.json", stats=stats)
        print(stats)
    elif a.verb == "reclassify":
        out = stored(cascade.reclassify(files.read_results(spark, a.results), stored(dictionary.prepared(files.read_snapshot(spark, a.dictionary)))))
        sinks.write_csv(out.drop("old_rule", "status", "pos"), a.out)
        changed = cascade.transition_counts(out.where("status = 'reclassified'").select("old_rule", F.col("rule").alias("new_rule")))
        print(cascade.reclassify_counters(out).first().asDict() | {"transitions": {r.transition: r.n for r in cascade.top_transitions(changed, 12).collect()}})
    elif a.verb == "vulns":
        results = stored(files.read_results(spark, a.results))
        cache = files.read_cache(spark, a.cache)
        known = cache.select(F.col("query").alias("cpe"), "payload", F.lit(None).cast("string").alias("error"))
        if a.url:
            pause = rest.default_pause(a.apikey)
            known = stored(known.unionByName(rest.cve_items(vulns.wanted(results, known, a.rules), rest.cve_service(a.url, a.apikey), pause)))
            if not a.cache.endswith(".json"):
                sinks.write_cache(known.where("payload is not null").select(F.col("cpe").alias("query"), "payload"), a.cache)
        items = known.select("cpe", F.from_json("payload", f"array<{vulns.ITEM}>").alias("items"), "error")
        sinks.write_vulns(vulns.rollup(vulns.check(results, items, a.rules)), a.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
