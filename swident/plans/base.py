"""Registry of queries, the frames that they share and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import bind_raw, build_name
from ..operators.dictionary import prepared
from ..storage import stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("k"), F.lower("p_brand").alias("v0"), F.replace(F.lower("p_name"), F.lit(" "), F.lit("_")).alias("p0"), F.col("p_size").cast("string").alias("ver0"), F.lower("p_type").alias("t0"), "p_name", "p_brand", "p_type", "p_size", "p_retailprice")


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dictionary: every part, one in ten deprecated, a few without a vendor or a product."""
    p, k = parts(spark, sf_dir), F.col("k")
    name = build_name(F.when(k % 17 != 3, F.col("v0")), F.when(k % 17 != 4, F.col("p0")), F.col("ver0"), None, F.col("t0"))
    return p.select(name.alias("name"), F.concat_ws(" ", "p_brand", "p_name", "ver0").alias("title"), (k % 10 == 0).alias("deprecated"), k.alias("ord"))


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prepared dictionary as a table of its own, built once per query.

    Entries are dealt out first: names are costly to split, and their file may be a single split.
    """
    return stored(prepared(entries(spark, sf_dir).repartition("ord")))


def _perturbed(name: str) -> Column:
    k, blank = F.col("k") % 7, F.col("k") % 11
    if name == "vendor":
        return F.when(blank == 5, "").when(k == 2, F.concat("v0", F.lit("x"))).when(k.isin(3, 4), F.concat(F.lit("zz_"), F.reverse("v0"), F.lit("_labs"))).otherwise(F.col("v0"))
    return F.when(blank == 6, "").when(k == 1, F.concat("p0", F.lit("s"))).when(k == 4, F.concat(F.lit("qq"), F.col("k").cast("string"))).otherwise(F.col("p0"))


def names_to_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as extracted entities, some of them misspelt, unknown or missing."""
    p = parts(spark, sf_dir).select("k", _perturbed("vendor").alias("vendor"), _perturbed("product").alias("product"), F.when(F.col("k") % 5 == 0, F.concat("ver0", F.lit(".1"))).otherwise(F.col("ver0")).alias("version"), F.when(F.col("k") % 2 == 0, F.col("t0")).alias("target_sw"))
    name = build_name(F.col("vendor"), F.col("product"), F.col("version"), None, F.col("target_sw"))
    return p.select("k", "vendor", "product", "version", "target_sw", bind_raw("vendor").alias("b_vendor"), bind_raw("product").alias("b_product"), name.alias("name"))


def alias_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a parsed catalog: a part, its neighbour and now and then a stranger."""
    p = parts(spark, sf_dir).select("k", "v0", "p0", "ver0")
    one = lambda a, v: build_name(F.col(f"{a}v0"), F.col(f"{a}p0"), v)
    near = p.select(*[F.col(c).alias(f"n_{c}") for c in p.columns])
    both = p.join(near, F.col("n_k") == F.col("k") + 1, "left").join(p.select(*[F.col(c).alias(f"s_{c}") for c in p.columns]), (F.col("s_k") == F.col("k") + 50) & (F.col("k") % 40 == 7), "left")
    cpes = F.array_compact(F.array(one("", F.col("ver0")), F.when(F.col("k") % 9 == 0, F.concat(one("", F.col("ver0")), F.lit("x"))), F.when(F.col("k") % 4 == 1, one("n_", F.col("n_ver0"))), F.when(F.col("s_k").isNotNull(), one("s_", F.col("s_ver0")))))
    return both.select("k", F.concat(F.lit("key"), F.col("k").cast("string")).alias("key"), F.array_distinct(cpes).alias("cpes"), F.when(F.col("k") % 6 == 0, "system").when(F.col("k") % 6 == 1, "").otherwise("ann").alias("created_by"), (F.col("k") % 5 == 0).alias("has_override"))


# --- the same in SQL -------------------------------------------------------


def norm(x: str) -> str:
    return rf"regexp_replace(regexp_replace(lower({x}), '^\s+|\s+$', '', 'g'), '\s+', '_', 'g')"


def bind(x: str) -> str:
    return rf"regexp_replace({x}, '([^a-z0-9._-])', '\\\1', 'g')"


def any_or_bind(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN '*' ELSE {bind(norm(x))} END"


def name_of(vendor: str, product: str, version: str, target: str = "NULL") -> str:
    return f"'cpe:2.3:a:' || ({any_or_bind(vendor)}) || ':' || ({any_or_bind(product)}) || ':' || ({any_or_bind(version)}) || ':*:*:*:*:' || ({any_or_bind(f'CAST({target} AS VARCHAR)')}) || ':*:*'"


def sim(a: str, b: str) -> str:
    return f"CASE WHEN greatest(length({a}), length({b})) = 0 THEN 1.0::DOUBLE ELSE 1.0::DOUBLE - levenshtein({a}, {b})::DOUBLE / greatest(length({a}), length({b}))::DOUBLE END"


GRAMMAR_SQL = r"^cpe:2\.3:[aoh*-](?::(?:\*|-|(?:\*|\?+)?(?:[a-z0-9._-]|\\[!-/:-@\[-\^`{-~])+(?:\*|\?+)?)){10}$"

P_SQL = "p AS (SELECT p_partkey AS k, lower(p_brand) AS v0, replace(lower(p_name), ' ', '_') AS p0, CAST(p_size AS VARCHAR) AS ver0, lower(p_type) AS t0, p_name, p_brand, p_type, p_size, p_retailprice FROM part)"
_ANY = lambda x: f"CASE WHEN {x} = '' THEN '*' ELSE {bind(x)} END"
D_SQL = f"""d0 AS (SELECT *, CASE WHEN k % 17 = 3 THEN '' ELSE v0 END AS dv, CASE WHEN k % 17 = 4 THEN '' ELSE p0 END AS dp FROM p),
d AS (SELECT k AS ord, dv AS raw_vendor, dp AS raw_product, ver0 AS raw_version, {_ANY('dv')} AS d_vendor, {_ANY('dp')} AS d_product, {name_of('dv', 'dp', 'ver0', 't0')} AS d_name, p_brand || ' ' || p_name || ' ' || ver0 AS d_title, k % 10 = 0 AS deprecated FROM d0)"""
Q0_SQL = """q0 AS (SELECT k,
  CASE WHEN k % 11 = 5 THEN '' WHEN k % 7 = 2 THEN v0 || 'x' WHEN k % 7 IN (3, 4) THEN 'zz_' || reverse(v0) || '_labs' ELSE v0 END AS vendor,
  CASE WHEN k % 11 = 6 THEN '' WHEN k % 7 = 1 THEN p0 || 's' WHEN k % 7 = 4 THEN 'qq' || CAST(k AS VARCHAR) ELSE p0 END AS product,
  CASE WHEN k % 5 = 0 THEN ver0 || '.1' ELSE ver0 END AS version,
  CASE WHEN k % 2 = 0 THEN t0 END AS target_sw FROM p)"""
Q_SQL = f"{Q0_SQL}, q AS (SELECT *, {_ANY('vendor')} AS b_vendor, {_ANY('product')} AS b_product, {name_of('vendor', 'product', 'version', 'target_sw')} AS name FROM q0)"
CAND_SQL = """reps AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY d_vendor, d_product ORDER BY ord) AS rn FROM d) WHERE rn = 1),
hits AS (SELECT q.*, d.*, 0 AS rank FROM q JOIN d ON b_vendor = d_vendor AND b_product = d_product WHERE b_vendor <> '*' AND b_product <> '*'),
miss AS (SELECT * FROM q WHERE b_vendor = '*' OR b_product = '*' OR NOT EXISTS (SELECT 1 FROM d WHERE b_vendor = d_vendor AND b_product = d_product)),
vfall AS (SELECT miss.*, reps.*, 1 AS rank FROM miss JOIN reps ON b_vendor = d_vendor WHERE b_vendor <> '*'),
pfall AS (SELECT miss.*, reps.*, 2 AS rank FROM miss JOIN reps ON b_product = d_product WHERE b_product <> '*'),
uni AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY k, d_name ORDER BY rank, ord) AS rn FROM (SELECT * FROM vfall UNION ALL SELECT * FROM pfall)) WHERE rn = 1),
cand AS (SELECT * EXCLUDE (cn) FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY rank, ord) AS cn FROM (SELECT * FROM hits UNION ALL SELECT * FROM uni)) WHERE cn <= 2000)"""
_SAME_V = "(vendor <> '' AND raw_vendor = vendor)"
_SAME_P = "(product <> '' AND raw_product = product)"
_PAIR = "(raw_vendor = vendor AND raw_product = product)"


def _best_sql(a: str, b: str, where: str) -> str:
    return f"arg_max(struct_pack(sim := {sim(a, b)}, name := d_name), struct_pack(s := {sim(a, b)}, o := -place)) FILTER (WHERE {where})"


CLASSIFY_SQL = f"""{CAND_SQL},
live AS (SELECT *, rank * 1099511627776 + ord AS place FROM cand WHERE NOT deprecated),
facts AS (SELECT k,
  arg_min(d_name, place) FILTER (WHERE d_name = name) AS m1,
  arg_min(d_name, place) FILTER (WHERE {_PAIR} AND version <> '' AND raw_version = version) AS m1a,
  {_best_sql('version', 'raw_version', _PAIR)} AS m1b,
  bool_or({_PAIR}) AS has_pair, bool_or({_SAME_V}) AS has_v, bool_or({_SAME_P}) AS has_p,
  {_best_sql('product', 'raw_product', _SAME_V)} AS m2,
  {_best_sql('vendor', 'raw_vendor', _SAME_P)} AS m3,
  arg_min(d_name, place) FILTER (WHERE {_SAME_P}) AS m2b FROM live GROUP BY k),
ruled AS (SELECT q.k AS k, q.name AS name, f.* EXCLUDE (k), CASE WHEN m1 IS NOT NULL THEN 'M1' WHEN m1a IS NOT NULL THEN 'M1A' WHEN has_pair THEN 'M1B'
  WHEN has_v AND has_p THEN 'M1C' WHEN has_v THEN 'M2' WHEN has_p AND m3.sim > 0.8 THEN 'M3' WHEN has_p THEN 'M2B' ELSE 'M4' END AS rule
  FROM q LEFT JOIN facts f ON q.k = f.k),
classified AS (SELECT k, name, rule,
  CASE rule WHEN 'M1B' THEN m1b.sim WHEN 'M2' THEN m2.sim WHEN 'M3' THEN m3.sim WHEN 'M4' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS similarity,
  CASE rule WHEN 'M1' THEN m1 WHEN 'M1A' THEN m1a WHEN 'M1B' THEN m1b.name WHEN 'M2' THEN CASE WHEN m2.sim > 0.8 THEN m2.name END WHEN 'M3' THEN m3.name WHEN 'M2B' THEN m2b END AS matched_name
  FROM ruled)"""

ALIAS_SQL = f"""al AS (SELECT a.k, 'key' || CAST(a.k AS VARCHAR) AS key, list_distinct_in_order AS cpes, created_by, has_override FROM (
  SELECT a.k, CASE WHEN a.k % 6 = 0 THEN 'system' WHEN a.k % 6 = 1 THEN '' ELSE 'ann' END AS created_by, a.k % 5 = 0 AS has_override,
  list_filter([{name_of('a.v0', 'a.p0', 'a.ver0')}, CASE WHEN a.k % 9 = 0 THEN {name_of('a.v0', 'a.p0', 'a.ver0')} || 'x' END,
    CASE WHEN a.k % 4 = 1 AND n.k IS NOT NULL THEN {name_of('n.v0', 'n.p0', 'n.ver0')} END,
    CASE WHEN s.k IS NOT NULL THEN {name_of('s.v0', 's.p0', 's.ver0')} END], lambda x: x IS NOT NULL) AS raw,
  list_filter(raw, lambda x, i: list_position(raw, x) = i) AS list_distinct_in_order
  FROM p a LEFT JOIN p n ON n.k = a.k + 1 LEFT JOIN p s ON s.k = a.k + 50 AND a.k % 40 = 7) a)"""


def pair_sql(alias: str) -> str:
    """`vendor:product` of a bound name without escaped colons."""
    return f"split_part({alias}, ':', 4) || ':' || split_part({alias}, ':', 5)"
