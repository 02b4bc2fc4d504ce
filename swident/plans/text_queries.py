"""Queries of the scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names as n
from ..functions import text as t
from ..functions.similarity import products_share_tokens, similarity
from ..operators import curation, inventory
from .base import GRAMMAR_SQL, P_SQL, any_or_bind, bind, name_of, norm, parts, query, sim, table


@query("normalize_text", f"WITH {P_SQL} SELECT k, {norm('''('  ' || p_name || chr(9) || ' ' || p_brand || ' ')''')} AS norm FROM p")
def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    return parts(spark, d).select("k", n.normalize_raw(F.concat(F.lit("  "), F.col("p_name"), F.lit("\t "), F.col("p_brand"), F.lit(" "))).alias("norm"))


@query("bind_names", f"WITH {P_SQL} SELECT k, {name_of('p_brand', 'p_name', 'ver0', 'CASE WHEN k % 2 = 0 THEN p_type END')} AS name FROM p")
def bind_names(spark: SparkSession, d: str) -> DataFrame:
    name = n.build_name(F.col("p_brand"), F.col("p_name"), F.col("ver0"), None, F.when(F.col("k") % 2 == 0, F.col("p_type")))
    return parts(spark, d).select("k", name.alias("name"))


@query("unbind_roundtrip", f"WITH {P_SQL} SELECT k, {norm('p_brand')} AS vendor, {norm('p_name')} AS product, ver0 AS version, CASE WHEN k % 2 = 0 THEN {norm('p_type')} END AS target_sw, {name_of('p_brand', 'p_name', 'ver0', 'CASE WHEN k % 2 = 0 THEN p_type END')} AS again FROM p")
def unbind_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    w = n.unbind_name("name")
    cells = {a: F.col("w").getField(a) for a in n.ATTRIBUTES}
    return bind_names(spark, d).withColumn("w", w).select("k", *[n.unbind_component(cells[a]).alias(a) for a in ("vendor", "product", "version", "target_sw")], n.bind_name(**cells).alias("again"))


_Q = r"""regexp_replace({}, '([^a-z0-9_])', '\\\1', 'g')"""


@query("wfn_text", f"WITH {P_SQL} SELECT k, 'wfn:[part=\"a\", vendor=\"' || {_Q.format(norm('p_brand'))} || '\", product=\"' || {_Q.format(norm('p_name'))} || '\", version=\"' || ver0 || '\"' || CASE WHEN k % 2 = 0 THEN ', target_sw=\"' || {_Q.format(norm('p_type'))} || '\"' ELSE '' END || ']' AS wfn FROM p")
def wfn_text(spark: SparkSession, d: str) -> DataFrame:
    return bind_names(spark, d).select("k", n.wfn_text(n.unbind_name("name")).alias("wfn"))


# a defect for each residue of k, and the error kinds that it must give
_DEFECTS = [
    ("sound", "{name}", ""),
    ("no prefix", "cpe:2.2:{rest}", "prefix"),
    ("short", "cpe:2.3:a:{vendor}", "component_count"),
    ("part", "cpe:2.3:x:{rest}", "part:invalid"),
    ("upper", "cpe:2.3:a:Q{rest}", "vendor:uppercase"),
    ("space", "cpe:2.3:a:q q{rest}", "whitespace,vendor:whitespace"),
    ("special", "cpe:2.3:a:q+{rest}", "vendor:special"),
    ("escape", r"cpe:2.3:a:\q{rest}", "vendor:illegal_escape"),
    ("middle", "cpe:2.3:a:q*{rest}", "vendor:wildcard_middle"),
    ("stars", "cpe:2.3:a:**{rest}", "vendor:wildcard_run"),
    ("empty", "cpe:2.3:a::{rest}", "vendor:empty"),
]


def _defect_sql() -> str:
    rest = f"({any_or_bind('v0')}) || ':' || ({any_or_bind('p0')}) || ':*:*:*:*:*:*:*:*'"
    cases = []
    for i, (_, shape, _) in enumerate(_DEFECTS):
        body = {1: f"'cpe:2.2:a:' || {rest}", 0: f"'cpe:2.3:a:' || {rest}", 2: f"'cpe:2.3:a:' || ({any_or_bind('v0')})", 3: f"'cpe:2.3:x:' || {rest}"}.get(i)
        if body is None:
            head = shape.replace("{rest}", "")
            tail = rest if i != 10 else f"({any_or_bind('v0')}) || ':*:*:*:*:*:*:*:*'"
            body = f"'{head}' || {tail}"
        cases.append(f"WHEN {i} THEN {body}")
    return f"bad AS (SELECT k, CASE k % {len(_DEFECTS)} {' '.join(cases)} END AS name FROM p)"


def defective(spark: SparkSession, d: str) -> DataFrame:
    v, p = n.bind_raw("v0"), n.bind_raw("p0")
    rest = F.concat(v, F.lit(":"), p, F.lit(":*:*:*:*:*:*:*:*"))
    heads = ["cpe:2.3:a:", "cpe:2.2:a:", None, "cpe:2.3:x:", *[s.replace("{rest}", "") for _, s, _ in _DEFECTS[4:]]]
    k = F.col("k") % len(_DEFECTS)
    name = F.when(k == 2, F.concat(F.lit("cpe:2.3:a:"), v)).when(k == 10, F.concat(F.lit("cpe:2.3:a::"), v, F.lit(":*:*:*:*:*:*:*:*")))
    for i, h in enumerate(heads):
        if h is not None and i != 10:
            name = name.when(k == i, F.concat(F.lit(h), rest))
    return parts(spark, d).select("k", name.alias("name"))


@query("validate_names", f"WITH {P_SQL}, {_defect_sql()} SELECT k, name, regexp_matches(name, '{GRAMMAR_SQL}') AS valid FROM bad")
def validate_names(spark: SparkSession, d: str) -> DataFrame:
    return defective(spark, d).select("k", "name", n.is_valid_name("name").alias("valid"))


@query("validation_error_kinds", f"WITH {P_SQL} SELECT k, CASE k % {len(_DEFECTS)} " + " ".join(f"WHEN {i} THEN '{e}'" for i, (_, _, e) in enumerate(_DEFECTS)) + " END AS kinds FROM p")
def validation_error_kinds(spark: SparkSession, d: str) -> DataFrame:
    return defective(spark, d).select("k", F.array_join(n.validation_errors("name"), ",").alias("kinds"))


@query("edit_similarity", f"WITH {P_SQL} SELECT k, levenshtein(p_name, p_type)::BIGINT AS distance, {sim('p_name', 'p_type')} AS similarity FROM p")
def edit_similarity(spark: SparkSession, d: str) -> DataFrame:
    return parts(spark, d).select("k", F.levenshtein("p_name", "p_type").cast("long").alias("distance"), similarity("p_name", "p_type").alias("similarity"))


@query("canonicalize_names", f"WITH {P_SQL} SELECT k, CASE WHEN k % 5 = 4 THEN NULL ELSE 'cpe:2.3:a:' || {bind(norm('p_brand'))} || ':' || {bind(norm('p_name'))} || ':' || ver0 || ':*:-:*:*:*:*:*' END AS canonical FROM p")
def canonicalize_names(spark: SparkSession, d: str) -> DataFrame:
    near = F.concat(F.lit(" CPE:2.3:a:"), F.col("p_brand"), F.lit(":"), F.col("p_name"), F.lit(":"), F.col("ver0"), F.when(F.col("k") % 5 == 4, ":*:-").otherwise(":*:-:*:*:*:*:*"))
    return parts(spark, d).select("k", n.canonicalize_alias(near).alias("canonical"))


@query("surrogate_keys", "SELECT s_suppkey AS k, 'd_' || substr(sha1(s_name || chr(31) || CAST(s_nationkey AS VARCHAR)), 1, 32) AS key FROM supplier")
def surrogate_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), n.surrogate_key("s_name", F.col("s_nationkey").cast("string")).alias("key"))


@query("annotation_parse", f"WITH {P_SQL} SELECT k, v0 AS vendor, lower(p_name) AS product, CASE WHEN k % 3 = 0 THEN ver0 END AS version, CASE WHEN k % 2 = 0 THEN 'x' || ver0 || '.js' END AS target_sw FROM p")
def annotation_parse(spark: SparkSession, d: str) -> DataFrame:
    span = lambda c, kind: F.concat(F.lit("["), c, F.lit(f"](cpe_{kind}) "))
    text = F.concat(span(F.col("p_brand"), "vendor"), span(F.col("p_name"), "product"), span(F.lit("other"), "product"), F.when(F.col("k") % 3 == 0, span(F.col("ver0"), "version")).otherwise(""))
    title = F.concat(F.col("p_name"), F.when(F.col("k") % 2 == 0, F.concat(F.lit(" For X"), F.col("ver0"), F.lit(".js "))).otherwise(F.lit("")))
    return parts(spark, d).select("k", t.parse_annotation(title, text).alias("e")).select("k", "e.*")


@query("positional_extract", f"WITH {P_SQL} SELECT k, v0 AS vendor, CASE WHEN k % 4 = 3 THEN lower(p_name) || ' edition' ELSE lower(p_name) END AS product, CASE WHEN k % 4 = 3 THEN NULL ELSE ver0 || '.0' END AS version, CASE WHEN k % 4 = 1 THEN 'beta2' END AS update, CASE WHEN k % 2 = 0 THEN 'typo' || ver0 END AS target_sw, 0.5::DOUBLE AS confidence FROM p")
def positional_extract(spark: SparkSession, d: str) -> DataFrame:
    tail = F.when(F.col("k") % 4 == 3, F.lit(" Edition")).otherwise(F.concat(F.lit(" "), F.col("ver0"), F.lit(".0"), F.when(F.col("k") % 4 == 1, " Beta2").when(F.col("k") % 4 == 2, " 64-bit").otherwise("")))
    title = F.concat(F.lit(" "), F.col("p_brand"), F.lit("  "), F.col("p_name"), tail, F.when(F.col("k") % 2 == 0, F.concat(F.lit(" for typo"), F.col("ver0"))).otherwise(F.lit("")))
    return parts(spark, d).select("k", t.positional_extract(title).alias("e")).select("k", "e.*")


@query("response_parse", f"WITH {P_SQL} SELECT k, CASE WHEN k % 6 IN (0, 3, 4) THEN v0 END AS vendor, CASE WHEN k % 6 = 0 THEN lower(p_name) END AS product, CASE WHEN k % 6 = 0 THEN 0.75::DOUBLE WHEN k % 6 = 3 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS confidence, CASE WHEN k % 6 = 1 THEN 'no_json' WHEN k % 6 = 2 THEN 'bad_json' END AS error FROM p")
def response_parse(spark: SparkSession, d: str) -> DataFrame:
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    k = F.col("k") % 6
    brand = F.concat(F.lit('{"vendor": '), quoted(F.col("p_brand")))
    answer = (
        F.when(k == 0, F.concat(F.lit("Sure:\n"), brand, F.lit(', "product": '), quoted(F.concat(F.lit(" "), F.col("p_name"), F.lit(" "))), F.lit(', "confidence": 0.75}\nDone')))
        .when(k == 1, F.lit("I do not know"))
        .when(k == 2, F.lit('{"vendor": "a",,}'))
        .when(k == 3, F.concat(brand, F.lit(', "product": 5, "confidence": 7}')))
        .when(k == 4, F.concat(brand, F.lit(', "product": {"a": "b"}, "confidence": -3}')))
        .otherwise(F.lit('{"vendor": null, "product": "  ", "confidence": "high"}'))
    )
    return parts(spark, d).select("k", t.parse_response(answer).alias("e")).select("k", "e.vendor", "e.product", "e.confidence", "e.error")


@query("field_answer_clean", f"WITH {P_SQL} SELECT k, CASE WHEN k % 4 = 0 THEN NULL WHEN k % 4 = 1 THEN NULL ELSE lower(p_name) END AS answer FROM p")
def field_answer_clean(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("k") % 4
    raw = F.when(k == 0, F.lit(" N/A \nbecause")).when(k == 1, F.lit("  ")).when(k == 2, F.concat(F.lit(' "'), F.col("p_name"), F.lit('"\nmore'))).otherwise(F.concat(F.lit("`"), F.col("p_name"), F.lit("' ")))
    return parts(spark, d).select("k", t.clean_field_answer(raw).alias("answer"))


_EXPORT_SQL = """e AS (SELECT k AS pos, CASE WHEN k % 13 = 0 THEN '-' WHEN k % 13 = 1 THEN 'KB' WHEN k % 13 = 2 THEN 'Hotfix for' ELSE p_brand END AS a,
  CASE WHEN k % 13 = 0 THEN 'unknown' WHEN k % 13 = 1 THEN CAST(100000 + k AS VARCHAR) ELSE p_name END AS b,
  CASE WHEN k % 11 = 0 THEN 'n/a' ELSE CAST(p_size AS VARCHAR) END AS v FROM p
  UNION ALL SELECT 1000000 + k, 'a', '--', '' FROM p WHERE k % 17 = 0
  UNION ALL SELECT 2000000 + k, upper(p_brand), p_name, CAST(p_size AS VARCHAR) FROM p WHERE k % 3 = 0)"""
_TITLE_SQL = f"""{_EXPORT_SQL}, c AS (SELECT pos, CASE WHEN lower(a) IN ('', '-', '--', 'n/a', 'unknown', 'null', '---') THEN '' ELSE a END AS a, CASE WHEN lower(b) IN ('', '-', '--', 'n/a', 'unknown', 'null', '---') THEN '' ELSE b END AS b, CASE WHEN lower(v) IN ('', '-', '--', 'n/a', 'unknown', 'null', '---') THEN '' ELSE v END AS v FROM e),
  j AS (SELECT pos, v, trim(a || ' ' || b) AS t FROM c), m AS (SELECT pos, CASE WHEN t <> '' AND v <> '' AND NOT contains(lower(t), lower(v)) THEN t || ' ' || v ELSE t END AS title FROM j),
  o AS (SELECT pos, title, CASE WHEN title = '' THEN 'garbage' WHEN length(title) < 3 THEN 'too_short' WHEN regexp_matches(lower(title), '\\bkb\\s?[0-9]{{6,}}\\b|\\bhotfix\\b') THEN 'noise' END AS why FROM m),
  r AS (SELECT pos, title, coalesce(why, CASE WHEN row_number() OVER (PARTITION BY lower(title), why ORDER BY pos) = 1 THEN 'written' ELSE 'duplicate' END) AS outcome FROM o)""".replace("\\\\", "\\")


def export(spark: SparkSession, d: str) -> DataFrame:
    p = parts(spark, d)
    k = F.col("k") % 13
    main = p.select(
        F.col("k").alias("pos"),
        F.when(k == 0, "-").when(k == 1, "KB").when(k == 2, "Hotfix for").otherwise(F.col("p_brand")).alias("a"),
        F.when(k == 0, "unknown").when(k == 1, (F.col("k") + 100000).cast("string")).otherwise(F.col("p_name")).alias("b"),
        F.when(F.col("k") % 11 == 0, "n/a").otherwise(F.col("ver0")).alias("v"),
    )
    short = p.where("k % 17 = 0").select((F.col("k") + 1000000).alias("pos"), F.lit("a").alias("a"), F.lit("--").alias("b"), F.lit("").alias("v"))
    again = p.where("k % 3 = 0").select((F.col("k") + 2000000).alias("pos"), F.upper("p_brand").alias("a"), F.col("p_name").alias("b"), F.col("ver0").alias("v"))
    return main.unionByName(short).unionByName(again)


@query("title_prep", f"WITH {P_SQL}, {_TITLE_SQL} SELECT pos, title FROM r WHERE outcome = 'written'")
def title_prep(spark: SparkSession, d: str) -> DataFrame:
    return inventory.titles(export(spark, d), ["a", "b"], "v")


@query("title_prep_counters", f"WITH {P_SQL}, {_TITLE_SQL} SELECT count(*) AS rows_read, count(*) FILTER (outcome = 'garbage') AS garbage, count(*) FILTER (outcome = 'too_short') AS too_short, count(*) FILTER (outcome = 'noise') AS noise, count(*) FILTER (outcome = 'duplicate') AS duplicates, count(*) FILTER (outcome = 'written') AS written FROM r")
def title_prep_counters(spark: SparkSession, d: str) -> DataFrame:
    return inventory.title_counters(inventory.title_outcome(export(spark, d), ["a", "b"], "v"))


@query("inventory_curate", f"""WITH {P_SQL}, i AS (SELECT k AS pos, CASE WHEN k % 10 = 0 THEN '' WHEN k % 10 = 1 THEN 'Security Update for ' || p_name ELSE p_name END AS name, CASE WHEN k % 2 = 0 THEN ver0 ELSE '' END AS version, p_brand AS vendor FROM p),
 f AS (SELECT *, row_number() OVER (PARTITION BY lower(name), lower(version) ORDER BY pos) AS n FROM i WHERE name <> '')
 SELECT pos, name, version, vendor, 'dpkg' AS source, CASE WHEN version <> '' AND NOT contains(name, version) THEN name || ' ' || version ELSE name END AS title FROM f WHERE n = 1 AND NOT starts_with(lower(name), 'security update for')""")
def inventory_curate(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("k") % 10
    items = parts(spark, d).select(F.col("k").alias("pos"), F.when(k == 0, " ").when(k == 1, F.concat(F.lit("Security Update for "), F.col("p_name"))).otherwise(F.col("p_name")).alias("name"), F.when(F.col("k") % 2 == 0, F.col("ver0")).alias("version"), F.concat(F.col("p_brand"), F.lit(" ")).alias("vendor"), F.lit("dpkg").alias("source"))
    return inventory.curate_inventory(items)


@query("alias_explode", f"WITH {P_SQL} SELECT k, unnest([v0, p0 || '\\,x']) AS alias FROM p")
def alias_explode(spark: SparkSession, d: str) -> DataFrame:
    """Empty and repeated aliases go, an escaped comma parts nothing."""
    cell = F.concat(F.lit(" "), F.col("v0"), F.lit(" ,,"), F.col("p0"), F.lit("\\,x, "), F.col("v0"))
    return parts(spark, d).select("k", F.explode(t.split_aliases(cell)).alias("alias"))


def catalog_export(spark: SparkSession, d: str) -> DataFrame:
    """Export rows with repeated keys, bad and near-miss aliases and empty cells."""
    k = F.col("k")
    good = n.build_name(F.col("v0"), F.col("p0"), F.col("ver0"))
    near = F.concat(F.lit("cpe:2.3:a:"), F.col("p_brand"), F.lit(":"), F.col("p0"), F.lit(":*:*:*:*:*:*:*:*"))
    cell = F.when(k % 8 == 0, F.lit("")).when(k % 8 == 1, F.lit("cpe:2.3:a:broken")).when(k % 8 == 2, F.concat(good, F.lit(","), good)).when(k % 8 == 3, F.concat(good, F.lit(",cpe:2.3:a:broken,"), near)).otherwise(good)
    return parts(spark, d).select(k.alias("line"), (k % 29 == 0).alias("malformed"), cell.alias("CPE"), F.lit("").alias("Edition"), F.col("p_name").alias("Title"), F.col("p0").alias("Product"), F.col("ver0").alias("Product Version"), F.col("v0").alias("Vendor"), F.when(k % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("V"), (k % 700).cast("string"))).alias("Vuln DB ID"), F.lit("system").alias("Created By"), F.when(k % 4 == 0, "x").otherwise(" ").alias("Override Title"), F.lit("").alias("Override Vendor"))


_G = name_of("v0", "p0", "ver0")
_NEAR = f"'cpe:2.3:a:' || {bind(norm('p_brand'))} || ':' || p0 || ':*:*:*:*:*:*:*:*'"
_NEAR_RAW = "'cpe:2.3:a:' || p_brand || ':' || p0 || ':*:*:*:*:*:*:*:*'"
_CURATE_SQL = f"""x AS (SELECT k AS line, k % 29 = 0 AS malformed, p_name AS title, k % 4 = 0 AS has_override, k % 8 AS r,
  CASE WHEN k % 8 = 0 THEN '' WHEN k % 8 = 1 THEN 'cpe:2.3:a:broken' WHEN k % 8 = 2 THEN {_G} || ',' || {_G} WHEN k % 8 = 3 THEN {_G} || ',cpe:2.3:a:broken,' || {_NEAR_RAW} ELSE {_G} END AS cell,
  CASE WHEN k % 8 = 3 THEN [{_G}, {_NEAR}] WHEN k % 8 < 2 THEN [] ELSE [{_G}] END AS valid, k, v0, p0, ver0 FROM p),
 y AS (SELECT *, CASE WHEN k % 5 = 0 THEN 'd_' || substr(sha1(title || chr(31) || cell), 1, 32) ELSE 'V' || CAST(k % 700 AS VARCHAR) END AS key, CASE WHEN k % 5 = 0 THEN 'derived' ELSE 'vulndb' END AS key_source FROM x),
 z AS (SELECT *, min(line) FILTER (NOT malformed AND len(valid) > 0) OVER (PARTITION BY CASE WHEN NOT malformed THEN key END) AS first FROM y),
 w AS (SELECT *, CASE WHEN malformed THEN 'malformed_row' WHEN line > first THEN 'duplicate_key' WHEN cell = '' THEN 'no_cpe' WHEN len(valid) = 0 THEN 'all_aliases_invalid' ELSE 'kept' END AS outcome FROM z)"""


@query("curate_rows", f"WITH {P_SQL}, {_CURATE_SQL} SELECT line, key, key_source, title, array_to_string(valid, ',') AS cpes, len(valid)::BIGINT AS n_aliases, has_override, (r = 3)::INT::BIGINT AS n_normalized_aliases, (r = 3)::INT::BIGINT AS n_dropped_aliases FROM w WHERE outcome = 'kept'")
def curate_rows(spark: SparkSession, d: str) -> DataFrame:
    kept = curation.catalog(curation.judged_rows(catalog_export(spark, d)))
    return kept.select("line", "key", "key_source", "title", F.array_join("cpes", ",").alias("cpes"), "n_aliases", "has_override", "n_normalized_aliases", "n_dropped_aliases")


@query("curate_rejects", f"""WITH {P_SQL}, {_CURATE_SQL} SELECT CASE WHEN outcome = 'all_aliases_invalid' THEN 'validate' ELSE 'parse' END AS step, outcome AS reason, CASE WHEN malformed THEN '' ELSE key END AS key, line, CASE WHEN outcome = 'all_aliases_invalid' THEN cell ELSE title END AS detail FROM w WHERE outcome <> 'kept'
 UNION ALL SELECT 'validate', 'abnf:component_count', key, line, 'cpe:2.3:a:broken' FROM w WHERE outcome IN ('kept', 'all_aliases_invalid') AND r IN (1, 3)""")
def curate_rejects(spark: SparkSession, d: str) -> DataFrame:
    return curation.rejects(curation.judged_rows(catalog_export(spark, d)))


@query("curate_counters", f"""WITH {P_SQL}, {_CURATE_SQL} SELECT count(*) AS rows_read, count(*) FILTER (malformed) AS rows_malformed, count(*) FILTER (NOT malformed AND key_source = 'derived') AS keys_derived,
 count(*) FILTER (outcome = 'duplicate_key') AS keys_duplicated, count(*) FILTER (outcome = 'no_cpe') AS rows_rejected_no_cpe, count(*) FILTER (outcome = 'all_aliases_invalid') AS rows_rejected_all_aliases_invalid, count(*) FILTER (outcome = 'kept') AS rows_kept,
 sum(CASE r WHEN 3 THEN 3 ELSE 1 END) FILTER (outcome IN ('kept', 'all_aliases_invalid'))::BIGINT AS aliases_seen, sum((r = 2)::INT) FILTER (outcome IN ('kept', 'all_aliases_invalid'))::BIGINT AS aliases_deduped,
 sum(len(valid)) FILTER (outcome IN ('kept', 'all_aliases_invalid'))::BIGINT AS aliases_valid, sum((r = 3)::INT) FILTER (outcome IN ('kept', 'all_aliases_invalid'))::BIGINT AS aliases_normalized, sum((r IN (1, 3))::INT) FILTER (outcome IN ('kept', 'all_aliases_invalid'))::BIGINT AS aliases_dropped FROM w""")
def curate_counters(spark: SparkSession, d: str) -> DataFrame:
    return curation.counters(curation.judged_rows(catalog_export(spark, d)))


@query("token_overlap", f"WITH {P_SQL} SELECT k, (len(list_intersect(string_split(p0, '_'), string_split(replace(t0, ' ', '_'), '_'))) > 0) AS share FROM p")
def token_overlap(spark: SparkSession, d: str) -> DataFrame:
    return parts(spark, d).select("k", products_share_tokens(F.array(F.col("p0"), F.replace(F.col("t0"), F.lit(" "), F.lit("_")))).alias("share"))


@query("slugs", "SELECT page_id, regexp_replace(regexp_replace(lower(url), '[^a-z0-9._-]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug FROM pages")
def slugs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", t.slug("url").alias("slug"))
