"""Queries of sources and sinks: tables written to files in the shared folder and read again."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names as n
from ..operators import curation, families, inventory, tiering, vulns
from ..sources import files, rest, sinks
from ..storage import new_path, stored, write_text
from ..streaming.resume import resumable_run
from .base import D_SQL, P_SQL, alias_sets, dictionary, entries, name_of, parts, query, table

FILES = 3  # that the rows of a source are dealt over, in order


def _in_files(df: DataFrame) -> DataFrame:
    """df in order of k over a few files."""
    return df.repartitionByRange(FILES, "k").sortWithinPartitions("k")


@query("titles_scan", f"WITH {P_SQL} SELECT row_number() OVER (ORDER BY k) - 1 AS pos, p_name || ' \"' || ver0 || '\"' AS title, CASE WHEN k % 3 = 0 THEN '[' || v0 || '](cpe_vendor)' END AS annotated FROM p")
def titles_scan(spark: SparkSession, d: str) -> DataFrame:
    path = new_path(spark, "titles")
    rows = parts(spark, d).select("k", F.concat(F.lit(" "), F.col("p_name"), F.lit(' "'), F.col("ver0"), F.lit('" ')).alias("title"), F.when(F.col("k") % 3 == 0, F.concat(F.lit("["), F.col("v0"), F.lit("](cpe_vendor)"))).alias("annotated"))
    _in_files(rows).drop("k").write.option("escape", '"').csv(path)
    return files.read_titles(spark, path).select("pos", "title", "annotated")


@query("titles_limit", f"WITH {P_SQL} SELECT row_number() OVER (ORDER BY k) - 1 AS pos, p_name AS title FROM p ORDER BY k LIMIT 10")
def titles_limit(spark: SparkSession, d: str) -> DataFrame:
    path = new_path(spark, "titles")
    _in_files(parts(spark, d).select("k", "p_name")).drop("k").write.csv(path)
    return files.read_titles(spark, path).orderBy("pos").limit(10).select("pos", "title")


@query("export_scan", f"WITH {P_SQL} SELECT row_number() OVER (ORDER BY k) - 1 AS pos, p_name AS name, ver0 AS version FROM p")
def export_scan(spark: SparkSession, d: str) -> DataFrame:
    path = new_path(spark, "export")
    _in_files(parts(spark, d).select("k", F.col("p_name").alias("name"), F.col("ver0").alias("version"), F.lit("x;y").alias("other"))).drop("k").write.option("header", True).option("sep", ";").csv(path)
    return files.read_export(spark, path, ["name", "version"], ";").select("pos", "name", "version")


@query("catalog_scan", f"WITH {P_SQL} SELECT row_number() OVER (ORDER BY k) + 1 AS line, k % 10 = 3 AS malformed, CASE WHEN k % 10 <> 3 THEN p_name END AS title FROM p")
def catalog_scan(spark: SparkSession, d: str) -> DataFrame:
    """Rows of too few fields are malformed; their cells don't count."""
    path = new_path(spark, "catalog")
    cells = {"Title": F.col("p_name"), "Vuln DB ID": F.col("k").cast("string")}
    row = F.concat_ws(";", *[cells.get(c, F.lit("x")) for c in curation.REQUIRED], F.when(F.col("k") % 10 != 3, F.lit("y")))
    head = spark.range(1).select(F.lit(-1).cast("long").alias("k"), F.lit(";".join([*curation.REQUIRED, "Override Title"])).alias("value"))
    lines = head.unionByName(parts(spark, d).select(F.col("k").cast("long").alias("k"), row.alias("value")))
    lines.coalesce(1).sortWithinPartitions("k").select("value").write.text(path)  # one file with one header
    found = files.read_catalog(spark, path, curation.REQUIRED)
    return found.select("line", "malformed", F.when(~F.col("malformed"), F.col("Title")).alias("title"))


@query("snapshot_scan", f"WITH {P_SQL}, {D_SQL} SELECT d_name AS name, d_title AS title, deprecated, row_number() OVER (ORDER BY ord) - 1 AS ord FROM d")
def snapshot_scan(spark: SparkSession, d: str) -> DataFrame:
    path = new_path(spark, "snapshot")
    _in_files(entries(spark, d).select(F.col("ord").alias("k"), F.col("name").alias("cpeName"), "title", "deprecated")).drop("k").write.option("compression", "gzip").json(path)
    return files.read_snapshot(spark, path)


def numbered_pages(start: int, size: int) -> dict:
    """A service of 1,000 names."""
    rows = range(start, min(start + size, 1000))
    return {"totalResults": 1000, "resultsPerPage": len(rows), "products": [{"cpe": {"cpeName": f"cpe:2.3:a:v{i % 7}:p{i}:1:*:*:*:*:*:*:*", "cpeNameId": str(i), "titles": [{"title": "de", "lang": "de"}, {"title": f"t{i}", "lang": "en"}][: i % 3], "deprecated": i % 5 == 0}} for i in rows]}


@query("dictionary_pages", "SELECT 'cpe:2.3:a:v' || (i % 7) || ':p' || i || ':1:*:*:*:*:*:*:*' AS cpeName, CAST(i AS VARCHAR) AS cpeNameId, CASE i % 3 WHEN 0 THEN '' WHEN 1 THEN 'de' ELSE 't' || i END AS title, i % 5 = 0 AS deprecated, i AS ord FROM range(1000) t(i)")
def dictionary_pages(spark: SparkSession, d: str) -> DataFrame:
    rest.register(spark)
    return spark.read.format("cpe_dictionary").option("fetch", f"{__name__}.numbered_pages").option("pagesize", "300").load()


@query("graph_pages", f"WITH {P_SQL} SELECT 'cpe:2.3:a:' || r_name AS name, CASE WHEN r_regionkey % 2 = 0 THEN r_name || ' 1' ELSE '1' END AS title, r_regionkey = 1 AS deprecated FROM region")
def graph_pages(spark: SparkSession, d: str) -> DataFrame:
    """The regions as platforms of a graph that gives two a page; this source is as small as the table."""
    rows = [[f"cpe:2.3:a:{r.r_name}", str(r.r_regionkey), r.r_regionkey == 1, r.r_name if r.r_regionkey % 2 == 0 else "*", None, "1"] for r in table(spark, d, "region").orderBy("r_regionkey").collect()]

    def post(statement: str, parameters: dict) -> dict:
        found = [[len(rows)]] if "count" in statement else rows[parameters["skip"] : parameters["skip"] + parameters["limit"]]
        return {"results": [{"data": [{"row": r} for r in found]}]}

    got = [p for _, page in rest.pages(rest.graph_fetch(post), 2) for p in rest.products(page)]
    return spark.createDataFrame([(name, title, dead) for name, _, title, dead in got], "name string, title string, deprecated boolean")


@query("cve_service", f"WITH {P_SQL}, c AS (SELECT DISTINCT v0 FROM p) SELECT v0 AS cpe, CASE WHEN length(v0) % 2 = 1 AND v0 LIKE '%3' THEN NULL ELSE length(v0) * 10 END::BIGINT AS n, CASE WHEN length(v0) % 2 = 1 AND v0 LIKE '%3' THEN 'api error: down' END AS error FROM c")
def cve_service(spark: SparkSession, d: str) -> DataFrame:
    def fetch_of(cpe: str):  # noqa: ANN202
        def get(start: int, size: int) -> dict:
            if len(cpe) % 2 and cpe.endswith("3"):
                raise OSError("down")
            total = len(cpe) * 10
            return {"totalResults": total, "resultsPerPage": min(size, total - start), "vulnerabilities": [{"cve": {"id": f"CVE-{i}"}} for i in range(start, min(total, start + size))]}

        return get

    asked = parts(spark, d).select(F.col("v0").alias("cpe"))
    found = rest.cve_items(asked, fetch_of, size=7)
    return found.select("cpe", F.size(F.from_json("payload", "array<struct<id:string>>")).cast("long").alias("n"), "error")


@query("results_scan", f"WITH {P_SQL} SELECT 't' || k AS title, k % 3 = 0 AS valid, CASE WHEN k % 7 <> 0 THEN k / 4.0::DOUBLE END AS confidence, CASE WHEN k % 5 <> 0 THEN k END::BIGINT AS tokens_in, 'x;' || k AS extra FROM p")
def results_scan(spark: SparkSession, d: str) -> DataFrame:
    """A results CSV as the reference's tools write it; figures that are none are null."""
    path, k = new_path(spark, "results"), F.col("k")
    rows = parts(spark, d).select(F.concat(F.lit("t"), k.cast("string")).alias("title"), F.when(k % 3 == 0, "True").otherwise("False").alias("valid"), F.when(k % 7 != 0, (k / 4).cast("string")).otherwise("none").alias("confidence"), F.when(k % 5 != 0, k.cast("string")).otherwise("").alias("tokens_in"), F.concat(F.lit("x;"), k.cast("string")).alias("extra"))
    rows.write.option("header", True).option("escape", '"').csv(path)
    return files.read_results(spark, path).select("title", "valid", "confidence", "tokens_in", "extra")


@query("results_appended", f"WITH {P_SQL} SELECT 't' || k AS title, k % 2 = 0 AS valid FROM p")
def results_appended(spark: SparkSession, d: str) -> DataFrame:
    path, k = new_path(spark, "appended"), F.col("k")
    rows = parts(spark, d).select(F.concat(F.lit("t"), k.cast("string")).alias("title"), (k % 2 == 0).alias("valid"))
    for part in (rows.where("valid"), rows.where("not valid")):
        sinks.write_results(part, path)
    return spark.read.parquet(path)


@query("results_resumed", "SELECT DISTINCT p_name AS title, length(p_name)::INT AS n FROM part")
def results_resumed(spark: SparkSession, d: str) -> DataFrame:
    """Two runs over a growing folder of titles; no title is worked on twice."""
    source, sink, mark = (new_path(spark, x) for x in ("stream", "sink", "mark"))
    titles = table(spark, d, "part").select(F.col("p_name").alias("title"), "p_partkey")
    for left in (0, 1):
        titles.where(F.col("p_partkey") % 2 == left).select("title").write.mode("append").parquet(source)
        resumable_run(spark, source, titles.select("title").schema, lambda df: df.withColumn("n", F.length("title")), sink, mark).awaitTermination()
    return spark.read.parquet(sink)


@query("tier_scan", f"WITH {P_SQL} SELECT CASE WHEN k % 2 = 0 THEN 'A' ELSE 'B' END AS tier, 'key' || k AS key, v0 || ',' || p0 AS cpes, CAST(k % 2 = 0 AS INT)::VARCHAR AS has_override FROM p")
def tier_scan(spark: SparkSession, d: str) -> DataFrame:
    k, paths = F.col("k"), {t: new_path(spark, f"tier-{t}") for t in "AB"}
    rows = parts(spark, d).select("k", F.concat(F.lit("key"), k.cast("string")).alias("key"), F.array("v0", "p0").alias("cpes"), (k % 2 == 0).alias("has_override"))
    for i, path in enumerate(paths.values()):
        sinks.write_csv(rows.where(k % 2 == i).drop("k"), path)
    return files.read_tiers(spark, paths).select("tier", "key", "cpes", "has_override")


@query("replay_scan", "SELECT n_name AS title, n_regionkey AS region FROM nation")
def replay_scan(spark: SparkSession, d: str) -> DataFrame:
    """A replay file is one JSON object: the nations, made on the driver."""
    path = f"{new_path(spark, 'replay')}.json"
    write_text(spark, path, json.dumps({r.n_name: {"region": r.n_regionkey, "é": ["ü"]} for r in table(spark, d, "nation").collect()}))
    return files.read_replay(spark, path).select("title", F.get_json_object("answer", "$.region").cast("long").alias("region"))


@query("cache_written", f"WITH {P_SQL} SELECT v0 AS query, '[' || max(k) || ']' AS payload FROM p GROUP BY v0")
def cache_written(spark: SparkSession, d: str) -> DataFrame:
    """A cache that is read, added to and replaced whole, from an empty one on."""
    path = new_path(spark, "cache")
    new = parts(spark, d).groupBy(F.col("v0").alias("query")).agg(F.concat(F.lit("["), F.max("k").cast("string"), F.lit("]")).alias("payload"))
    for left in (0, 1):
        sinks.write_cache(files.read_cache(spark, path).unionByName(new.where(F.pmod(F.xxhash64("query"), F.lit(2)) == left)), path)
    return files.read_cache(spark, path)


_PACKAGE_SQL = "SELECT row_number() OVER (ORDER BY k) - 1 AS pos, v0 AS name, ver0 AS version, CASE WHEN k % 2 = 0 THEN p_type ELSE '' END AS vendor, '{0}' AS source FROM p"


def _packages(spark: SparkSession, d: str, source: str) -> DataFrame:
    path, k = new_path(spark, source), F.col("k")
    name = F.concat("v0", F.lit(":amd64")) if source == "dpkg" else F.col("v0")
    rows = parts(spark, d).select("k", F.concat_ws("\t", name, "ver0", F.when(k % 2 == 0, F.col("p_type"))).alias("value"))
    _in_files(rows).select("value").write.text(path)
    return files.read_packages(spark, path, source)


@query("dpkg_scan", f"WITH {P_SQL} {_PACKAGE_SQL.format('dpkg')}")
def dpkg_scan(spark: SparkSession, d: str) -> DataFrame:
    return _packages(spark, d, "dpkg")


@query("rpm_scan", f"WITH {P_SQL} {_PACKAGE_SQL.format('rpm')}")
def rpm_scan(spark: SparkSession, d: str) -> DataFrame:
    return _packages(spark, d, "rpm")


@query("titles_written", "SELECT min(p_partkey) AS least, p_name AS title FROM part GROUP BY lower(p_name), p_name")
def titles_written(spark: SparkSession, d: str) -> DataFrame:
    """Distinct titles through the titles sink and back, with the first part of each."""
    path = new_path(spark, "titles")
    sinks.write_titles(inventory.titles(parts(spark, d).select(F.col("k").alias("pos"), "p_name"), ["p_name"]), path)
    found = spark.read.schema("title string").option("escape", '"').csv(path)
    return found.join(parts(spark, d).groupBy(F.col("p_name").alias("title")).agg(F.min("k").alias("least")), "title").select("least", "title")


@query("curation_written", f"WITH {P_SQL} SELECT 'key' || k AS key, {name_of('v0', 'p0', 'ver0')} AS cpes, '1' AS n_aliases FROM p")
def curation_written(spark: SparkSession, d: str) -> DataFrame:
    path, k = new_path(spark, "curation"), F.col("k")
    cells = {"CPE": n.build_name(F.col("v0"), F.col("p0"), F.col("ver0")), "Vuln DB ID": F.concat(F.lit("key"), k.cast("string"))}
    judged = stored(curation.judged_rows(parts(spark, d).select((k + 1).alias("line"), F.lit(False).alias("malformed"), *[cells.get(c, F.lit("x")).alias(c) for c in curation.REQUIRED])))
    sinks.write_curation(curation.catalog(judged), curation.rejects(judged), curation.normalizations(judged), path)
    return spark.read.option("header", True).csv(f"{path}/catalog").select("key", "cpes", "n_aliases")


@query("routes_written", f"WITH {P_SQL} SELECT 'key' || k AS key, CASE WHEN k % 5 = 0 THEN 'A' ELSE 'B' END AS route FROM p WHERE k % 4 <> 1 AND k % 40 <> 7")
def routes_written(spark: SparkSession, d: str) -> DataFrame:
    """Routes as folders; rows with aliases of one part only are never quarantined."""
    path = new_path(spark, "routes")
    sinks.write_routes(tiering.route(alias_sets(spark, d), with_dictionary=False), path)
    return spark.read.parquet(path).where("k % 4 <> 1 and k % 40 <> 7").select("key", "route")


@query("splits_written", f"WITH {P_SQL} SELECT 'key' || k AS key, 1::BIGINT AS splits FROM p")
def splits_written(spark: SparkSession, d: str) -> DataFrame:
    path = new_path(spark, "splits")
    sinks.write_splits(families.deal(families.families(alias_sets(spark, d)), {"benchmark_gold": 0.1, "test": 0.1, "train": 0.8}), path)
    return spark.read.parquet(path).groupBy("key").agg(F.count_distinct("split").alias("splits"))


@query("vulns_written", f"WITH {P_SQL} SELECT 't' || k AS title, CASE WHEN k % 2 = 0 THEN '1' ELSE '0' END AS n_cves, CASE WHEN k % 2 = 0 THEN 'CVE-' || k END AS cve_ids, CASE WHEN k % 3 = 0 AND k % 2 = 1 THEN 'offline cache miss' END AS error FROM p")
def vulns_written(spark: SparkSession, d: str) -> DataFrame:
    path, k = new_path(spark, "vulns"), F.col("k")
    name = n.build_name(F.concat(F.lit("v"), k.cast("string")), F.lit("p"), F.lit("1"))
    results = parts(spark, d).select(F.concat(F.lit("t"), k.cast("string")).alias("title"), name.alias("cpe"), F.lit("M1").alias("rule"), F.lit("").alias("matched_cpe"))
    one = F.concat(F.lit('[{"id":"CVE-'), k.cast("string"), F.lit('"}]'))
    cache = parts(spark, d).where("k % 2 = 0 or k % 3 <> 0").select(name.alias("cpe"), F.from_json(F.when(k % 2 == 0, one).otherwise("[]"), f"array<{vulns.ITEM}>").alias("items"))
    sinks.write_vulns(vulns.rollup(vulns.check(results, cache)), path)
    return spark.read.option("header", True).csv(path).select("title", "n_cves", "cve_ids", "error")


@query("file_digests", "SELECT r_name AS name, sha256(r_name || chr(10) || r_regionkey) AS sha256 FROM region")
def file_digests(spark: SparkSession, d: str) -> DataFrame:
    """A file for each region."""
    path = new_path(spark, "digests")
    for r in table(spark, d, "region").collect():
        write_text(spark, f"{path}/{r.r_name.replace(' ', '_')}.txt", f"{r.r_name}\n{r.r_regionkey}")
    found = files.file_digests(spark, f"{path}/*.txt")
    return found.select(F.replace(F.regexp_extract("path", r"([^/]+)\.txt$", 1), F.lit("_"), F.lit(" ")).alias("name"), "sha256")


@query("components_map", f"WITH {P_SQL}, {D_SQL} SELECT ord, CASE WHEN ord % 6 <> 0 THEN d_vendor END AS vendor, CASE WHEN ord % 6 <> 0 THEN '*' END AS edition FROM d")
def components_map(spark: SparkSession, d: str) -> DataFrame:
    """Valid names as maps; a name with a blank is none."""
    name = F.when(F.col("ord") % 6 == 0, F.concat("d_name", F.lit(" "))).otherwise(F.col("d_name"))
    return dictionary(spark, d).select("ord", n.components_map(name).alias("m")).select("ord", F.col("m")["vendor"].alias("vendor"), F.col("m")["edition"].alias("edition"))


@query("names_from_maps", f"WITH {P_SQL} SELECT k, CASE WHEN k % 7 = 0 THEN NULL ELSE {name_of('CASE WHEN k % 3 = 0 THEN NULL ELSE v0 END', 'p0', 'ver0')} END AS name FROM p")
def names_from_maps(spark: SparkSession, d: str) -> DataFrame:
    """Tool arguments as maps, with blanks and missing keys."""
    k, text = F.col("k"), lambda c: F.concat(F.lit(" "), F.col(c))
    args = F.when(k % 7 == 0, F.create_map(F.lit("vendor"), F.lit("  "), F.lit("version"), F.lit("1"))).when(k % 3 == 0, F.create_map(F.lit("product"), text("p0"), F.lit("version"), F.col("ver0"))).otherwise(F.create_map(F.lit("vendor"), text("v0"), F.lit("product"), F.col("p0"), F.lit("version"), F.col("ver0"), F.lit("update"), F.lit(" ")))
    return parts(spark, d).select("k", n.build_name_from_map(args).alias("name"))
