"""Lookups by lists: the same candidates as row by row, in tables that don't grow with queries times entries."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from swident.functions.names import bind_raw
from swident.operators import dictionary as dic
from swident.plans.catalogue import ORACLE_SQL, QUERIES

NAME = "cpe:2.3:a:{}:{}:{}:*:*:*:*:*:*:*"
PART = "/root/testdata/sf0.001/part.parquet"


@pytest.fixture(scope="module")
def book(spark):
    """Forty products of one vendor, each thrice; six vendors of one product; a few without a vendor or a product."""
    rows = [("anvil", f"p{i % 40}", i) for i in range(120)] + [(f"v{i}", "kiln", i) for i in range(6)] + [("*", "kiln", 1), ("lone", "*", 2)]
    titles = [f"{v} {p} Edition {'Blue' if i % 3 else 'BLUEISH'} blue".title() for i, (v, p, _) in enumerate(rows)]
    made = [(NAME.format(v, p, n), t, False, i) for i, ((v, p, n), t) in enumerate(zip(rows, titles))]
    return dic.prepared(spark.createDataFrame([*made, ("junk", "anvil", False, 900)], "name string, title string, deprecated boolean, ord long")).cache()


@pytest.fixture(scope="module")
def asked(spark):
    pairs = [("anvil", "p1"), ("anvil", "kiln"), ("anvil", "none"), ("zz", "kiln"), ("", "kiln"), ("anvil", ""), ("zz", "none"), ("", "blue_edition"), ("zz", "blue"), ("", "blue_p1"), ("", "_"), ("", "")]
    q = spark.createDataFrame([(i, *pairs[i % len(pairs)]) for i in range(3 * len(pairs))], "k long, vendor string, product string")
    return q.select("*", *[F.when(F.col(c) == "", "*").otherwise(bind_raw(c)).alias(f"b_{c}") for c in ("vendor", "product")]).cache()


def found(df):
    return sorted((r.k, r["rank"], r.ord) for r in df.collect())


@pytest.mark.parametrize("cap", [None, 1, 4, 42, 2000])
def test_lists_expand_to_candidates(spark, book, asked, cap):
    of, lists = dic.candidate_lists(asked, book, "k", cap)
    assert found(dic.expanded(asked, of, lists, "k")) == found(dic.candidates(asked, book, "k", cap))
    assert not cap or max(r.n for r in of.groupBy("k").agg(F.sum("most").alias("n")).collect()) <= cap


@pytest.mark.parametrize("cap", [None, 1, 4, 2000])
def test_ladder_is_what_a_plain_search_finds(spark, book, asked, cap):
    entries = book.orderBy("ord").collect()
    want = []
    for q in asked.collect():
        both = q.vendor != "" and q.product != ""
        pair = [e for e in entries if both and (e.d_vendor, e.d_product) == (q.b_vendor, q.b_product)]
        vendor = [e for e in entries if q.vendor != "" and e.d_vendor == q.b_vendor]
        words = set(f"{q.vendor} {q.product}".replace("_", " ").split())
        titled = [e for e in entries if q.product != "" and words and all(w in e.d_title.lower() for w in words)]
        rank, hits = next(((r, h) for r, h in enumerate((pair, vendor, titled)) if h), (0, []))
        want += [(q.k, rank, e.ord) for e in hits[:cap]]
    assert found(dic.ladder(asked, book, "k", cap)) == sorted(want)


def test_lists_do_not_grow_with_queries(spark, book, asked):
    """Queries that ask alike share a list: a hundred times the queries meet the same lists."""
    many = asked.crossJoin(spark.range(100).withColumnRenamed("id", "copy")).withColumn("k", F.col("k") * 100 + F.col("copy")).drop("copy")
    for lists_of in (dic.candidate_lists, dic.ladder_lists):
        of, lists = lists_of(many, book, "k")
        assert lists.count() == lists_of(asked, book, "k")[1].count() <= 4 * 130
        assert of.count() <= 2 * many.count()


def test_hybrid_rows_and_lists_agree(spark, book, asked):
    half = book.where("ord % 2 = 1 and d_vendor <> 'lone'")
    rows = dic.hybrid_candidates(asked, half, lambda left: dic.ladder(left, book, "k", 4), "k", 4)
    of, lists = dic.hybrid_lists(asked, half, lambda left: dic.ladder_lists(left, book, "k", 4), "k", 4)
    assert found(dic.expanded(asked, of, lists, "k")) == found(rows)
    assert {r.from_remote for r in rows.collect()} == {False, True}


@pytest.mark.skipif(not os.path.exists(PART), reason="no test tables")
@pytest.mark.parametrize("name", ["hybrid_candidates", "hybrid_counters", "candidate_ladder", "cve_rollup"])
def test_query_equals_sql_on_copies(spark, tmp_path, name):
    """Six copies of the parts with shifted keys, so that each name of the dictionary is there six times."""
    c = duckdb.connect()
    c.execute(f"COPY (SELECT p.* REPLACE (p_partkey + i * (SELECT max(p_partkey) + 1 FROM '{PART}') AS p_partkey) FROM '{PART}' p, range(6) t(i)) TO '{tmp_path}/part.parquet'")
    c.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet'")
    df = QUERIES[name](spark, str(tmp_path))
    cells = lambda rows: sorted(tuple(str(v) for v in r) for r in rows)
    assert cells(df.collect()) == cells(c.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLE_SQL[name]})").fetchall())


@pytest.mark.skipif(not os.path.exists(PART), reason="no test tables")
def test_ladder_query_counts_lists_and_not_rows(spark):
    """Nothing is aggregated per query, as each would have up to 2,000 rows then."""
    plan = QUERIES["candidate_ladder"](spark, os.path.dirname(PART))._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [rank#" in plan and "Aggregate [k#" not in plan


def test_keywords_meet_equal_titles_once(spark):
    titles = ["Blue Ring 1", "blue ring 12", "Blue Bolt 1", None, "", "RING  blues\t1"]
    book = spark.createDataFrame([(f"n{i}", i, titles[i % 6]) for i in range(60)], "d_name string, ord long, d_title string")
    asks = {1: ["blue", "ring"], 2: ["blue", "1"], 3: ["ring", "zz"], 4: [], 5: ["12"], 6: ["e"]}
    asked = spark.createDataFrame(list(asks.items()), "k int, keywords array<string>")
    for cap in (None, 3):
        want = [(k, i) for k, w in asks.items() if w for i in [j for j in range(60) if titles[j % 6] and all(x in titles[j % 6].lower() for x in w)][:cap]]
        assert sorted((r.k, r.ord) for r in dic.keyword_matches(asked, book, "k", cap).collect()) == want
