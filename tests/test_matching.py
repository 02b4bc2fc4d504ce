import pytest
from pyspark.sql import functions as F

from swident.functions.names import bind_raw, build_name
from swident.operators import agent, cascade, curation, dictionary, evaluate, families, tiering, vulns
from swident.operators.classify import classify
from swident.operators.components import connected_components

NAME = "cpe:2.3:a:{}:{}:{}:*:*:*:*:{}:*:*"


def entry(v, p, ver="4.2.7", sw="*", dead=False):
    return (NAME.format(v, p, ver, sw), f"{v} {p}", dead)


def run(spark, entries, vendor="northwind", product="ledgerly", version="4.2.7", sw=None, cap=None):
    d = dictionary.prepared(spark.createDataFrame([(*e, i) for i, e in enumerate(entries)], "name string, title string, deprecated boolean, ord long"))
    q = spark.createDataFrame([(1, vendor, product, version, sw)], "k long, vendor string, product string, version string, sw string")
    q = q.select("k", "vendor", "product", "version", bind_raw("vendor").alias("b_vendor"), bind_raw("product").alias("b_product"), build_name(F.col("vendor"), F.col("product"), F.col("version"), None, F.col("sw")).alias("name"))
    r = classify(q, d, "k", cap).first()
    return r.rule, r.similarity, r.matched_name


CASES = [
    (dict(sw="harborcms"), [entry("northwind", "ledgerly", sw="harborcms")], "M1", 1.0, True),
    (dict(), [entry("northwind", "ledgerly", sw="harborcms")], "M1A", 1.0, True),
    (dict(version="9.9.9"), [entry("northwind", "ledgerly")], "M1B", None, True),
    (dict(vendor="lumen", version="1.0"), [entry("lumen", "wirefmt"), entry("northwind", "ledgerly")], "M1C", 1.0, False),
    (dict(product="ledgerlys"), [entry("northwind", "ledgerly")], "M2", None, True),
    (dict(vendor="qx", product="cloudsyncpane"), [entry("qx", "printdock_addpanel", "60")], "M2", None, False),
    (dict(vendor="northwindd"), [entry("northwind", "ledgerly")], "M3", None, True),
    (dict(vendor="utterly_other_maker"), [entry("northwind", "ledgerly")], "M2B", 1.0, True),
    (dict(), [], "M4", 0.0, False),
    (dict(), [entry("northwind", "ledgerly", dead=True)], "M4", 0.0, False),
    # the pair shadows all else, even if its entries are all deprecated
    (dict(), [entry("northwind", "ledgerly", dead=True), entry("northwind", "other")], "M4", 0.0, False),
    # a deprecated representative hides its pair from the fallbacks
    (dict(product="nothing"), [entry("northwind", "other", dead=True), entry("northwind", "other", "2")], "M4", 0.0, False),
    (dict(version=""), [entry("northwind", "ledgerly", "*")], "M1", 1.0, True),
    (dict(version="", sw="x"), [entry("northwind", "ledgerly", "*")], "M1B", 1.0, True),
]


@pytest.mark.parametrize(("change", "entries", "rule", "sim", "cited"), CASES)
def test_rules(spark, change, entries, rule, sim, cited):
    got, s, matched = run(spark, entries, **change)
    assert got == rule and (matched is not None) == cited
    assert sim is None or s == sim


def test_first_of_equals_and_cap(spark):
    same = [entry("northwind", "ledgerly", "4.2.8"), entry("northwind", "ledgerly", "4.2.9")]
    assert run(spark, same)[2] == same[0][0]
    assert run(spark, [*same, entry("northwind", "ledgerly")], cap=2)[0] == "M1B"
    assert run(spark, [(NAME.format("a", "b", "1", "*") + ":x", "", False), ("junk", "", False)])[0] == "M4"


def test_curation_precedence(spark):
    good = NAME.format("a", "b", "1", "*")
    rows = [(2, False, "", "K1"), (3, False, "bad", "K1"), (4, False, f"{good},{good}", "K1"), (5, False, good, "K1"), (6, True, good, "K2"), (7, False, "cpe:2.3:a:A:b:1:*:*:*:*:*:*:*," + good, "K3"), (8, False, good, "")]
    df = spark.createDataFrame([(*r, "T", "e", "p", "1", "v", "system", "o") for r in rows], "line long, malformed boolean, CPE string, `Vuln DB ID` string, Title string, Edition string, Product string, `Product Version` string, Vendor string, `Created By` string, `Override Title` string")
    j = curation.judged_rows(df).cache()
    assert [r.outcome for r in j.orderBy("line").collect()] == ["no_cpe", "all_aliases_invalid", "kept", "duplicate_key", "malformed_row", "kept", "kept"]
    c = curation.counters(j).first()
    assert (c.rows_read, c.rows_kept, c.keys_duplicated, c.keys_derived, c.aliases_deduped, c.aliases_normalized, c.aliases_valid, c.aliases_dropped) == (7, 3, 1, 1, 1, 1, 3, 1)
    assert [(r["alias"], r.key) for r in curation.normalizations(j).collect()] == [("cpe:2.3:a:A:b:1:*:*:*:*:*:*:*", "K3")]
    assert curation.rejects(j).where("reason like 'abnf:%'").first().detail == "bad"
    with pytest.raises(ValueError, match="missing"):
        curation.judged_rows(df.drop("CPE"))


def test_tiers(spark):
    d = dictionary.prepared(spark.createDataFrame([(*entry("sieve", "sieve", "0.31.4"), 0), (*entry("relay", "rx-os", "13.2"), 1), (*entry("relay", "fab_7000", "13.2"), 2)], "name string, title string, deprecated boolean, ord long"))
    n = lambda v, p: NAME.format(v, p, "1", "*")
    rows = [("a", [n("sieve", "sieve"), n("metricly", "steward")], "", True), ("b", [n("relay", "rx-os"), n("relay", "fab_7000")], "ann", False), ("c", [NAME.format("sieve", "sieve", "0.31.4", "*")], "system", True), ("d", [], "x", False)]
    c = tiering.contrast(spark.createDataFrame(rows, "key string, cpes array<string>, created_by string, has_override boolean"), d)
    r = {x.key: x for x in tiering.route(c).collect()}
    assert (r["a"].route, r["a"].reason) == ("quarantine", "incompatible_vendors:metricly:steward")
    assert (r["b"].route, r["c"].route, r["d"].route, r["c"].n_in_dict, r["b"].n_pairs_known) == ("B", "A", "B", 1, 2)
    assert {x.key: x.reason for x in tiering.route(c, with_dictionary=False).collect()}["a"] == "incompatible_vendors:no_dictionary"


def test_families_and_splits(spark):
    n = lambda v, p, ver: NAME.format(v, p, ver, "*")
    rows = [(f"k{i}.{j}", [n("v", f"p{i}", str(j))]) for i in range(40) for j in range(4)]
    rows += [("x1", [n("v", "q1", "1"), n("v", "q2", "1")]), ("x2", [n("v", "q2", "2"), n("w", "q3", "1")]), ("x3", [n("w", "q3", "2"), n("w", "q4", "2")]), ("lone", ["nonsense"])]
    df = spark.createDataFrame(rows, "key string, cpes array<string>")
    f = families.families(df).cache()
    assert len({r.family for r in f.where("key like 'x%'").collect()}) == 1
    assert f.where("key = 'lone'").first().family == "__row__:lone"
    share = {"benchmark_gold": 0.1, "test": 0.1, "train": 0.8}
    a, b = (sorted((r.key, r.split) for r in families.deal(f, share).collect()) for _ in range(2))
    assert a == b and len(a) == len(rows)
    sizes = {s: sum(x == s for _, x in a) for s in families.SPLITS}
    assert 12 <= sizes["benchmark_gold"] <= 20 and 12 <= sizes["test"] <= 20
    assert families.leaks(families.deal(f, share)).count() == 0


def test_scores(spark):
    counts = spark.createDataFrame([("vendor", 3, 2, 2, 1, 1), ("product", 0, 0, 0, 0, 0)], "entity string, cor long, inc long, par long, mis long, spu long")
    s = {r.entity: r for r in evaluate.entity_scores(counts).collect()}
    assert (s["vendor"].possible, s["vendor"].actual, s["vendor"].strict_f1, s["vendor"].partial_f1, s["product"].strict_f1) == (8, 8, 3 / 8, 4 / 8, 0.0)
    df = spark.createDataFrame([("a", v) for v in (10, 30, 20, 40, None)] + [("b", None), ("c", 7), ("c", 7), ("c", 9)], "k string, v int")
    got = {r.k: (r.half, r.most) for r in evaluate.percentiles(df, ["k"], "v", {"half": 0.5, "most": 0.95}).collect()}
    assert got == {"a": (30, 40), "b": (0, 0), "c": (7, 9)}  # 1.5 rounds to 2


def test_cascade_merge(spark):
    fast = spark.createDataFrame([(1, "a", "M4", ""), (2, "b", "M1", "x"), (3, "c", "M2", "")], "pos long, title string, rule string, matched_cpe string")
    esc = spark.createDataFrame([(9, "a", "M2", "o"), (10, "a", "M1A", "n"), (11, "b", "M4", "bad")], "pos long, title string, rule string, matched_cpe string")
    m = cascade.merge(fast, esc, "big")
    assert sorted(tuple(r[c] for c in ("title", "rule", "matched_cpe", "fast_rule", "escalated_by")) for r in m.collect()) == [("a", "M1A", "n", "M4", "big"), ("b", "M1", "x", "", ""), ("c", "M2", "", "", "")]
    c = cascade.counters(fast, m).first()
    assert (c.rows, c.tail, c.escalated_done, c.m1x_before, c.m1x_after) == (3, 2, 1, 1, 2)


def test_vulns(spark):
    name = NAME.format("a", "b", "1", "*")
    item = '{"id":"CVE-1","descriptions":[{"lang":"en","value":"' + "x" * 300 + '"}],"metrics":{"cvssMetricV31":[{"cvssData":{"baseScore":9.8,"baseSeverity":"CRITICAL"}}],"cvssMetricV2":[{"baseSeverity":"LOW","cvssData":{"baseScore":1.0}}]}}'
    cache = spark.createDataFrame([(name, f"[{item}]")], "cpe string, j string").select("cpe", F.from_json("j", f"array<{vulns.ITEM}>").alias("items"))
    res = spark.createDataFrame([("t1", name, "M1", ""), ("t2", NAME.format("z", "z", "1", "*"), "M1A", name), ("t3", NAME.format("q", "q", "1", "*"), "M1", None), ("t4", name, "M2", ""), ("t5", "junk", "M1", "")], "title string, cpe string, rule string, matched_cpe string")
    r = {x.title: x for x in vulns.rollup(vulns.check(res, cache)).collect()}
    assert set(r) == {"t1", "t2", "t3"} and r["t1"].vulnerable and r["t1"].max_score == 9.8 and r["t2"].cpe == name
    assert r["t3"].error == "offline cache miss" and r["t3"].n_cves == 0


def titles(spark, rows):
    return spark.createDataFrame(rows, "k long, title string, vendor string, product string, version string, update string, target_sw string, rule string")


def test_agent(spark):
    d = dictionary.prepared(spark.createDataFrame([(*entry("anvil", "kiln", "2.0"), 0), (*entry("anvil", "bellows", "1.0"), 1)], "name string, title string, deprecated boolean, ord long"))
    rows = titles(spark, [(1, "Anvil Kiln 2.0", "anvil", "kiln", "2.0", None, None, "M1"), (2, "?", None, None, None, None, None, None), (3, "kilm", "anvil", "kilm", "", None, None, "M2")])
    out = {r.k: r for r in agent.resolve_with_agent(rows, d, "k").collect()}
    assert (out[1].rule, out[1].agent_turns, out[1].confidence, out[1].matched_name, out[1].error) == ("M1", 3, 0.85, NAME.format("anvil", "kiln", "2.0", "*"), None)
    assert (out[2].rule, out[2].error, out[2].name) == (None, "agent submitted no vendor/product", None)
    assert (out[3].rule, out[3].valid, out[3].stage) == ("M2", True, "agent")


def follows():
    class Follows:
        """Searches by keyword, then submits the first entry that it was shown."""

        def __init__(self, given):
            self.given = given

        def chat(self, messages):
            import json

            if self.given["vendor"] == "down":
                raise OSError("no service")
            if self.given["vendor"] == "silent":
                return agent.Reply(text="hm")
            answers = [json.loads(m["content"]) for m in messages if m["role"] == "tool"]
            if not answers:
                assert messages[0]["content"].startswith("Title: ")
                return agent.Reply(calls=[("search_dictionary", {"keyword": "KIL anv"}), ("bind_and_validate", {"vendor": " A\u00e9 ", "product": "b"}), ("nonsense", {}), ("classify_match", {"vendor": "anvil", "product": "kiln", "version": "2.0", "confidence": 7}), ("search_dictionary", {})])
            assert len(answers) == 5 and answers[0]["total"] == 1 and answers[1]["valid"] is False and answers[1]["errors"]
            assert "unknown tool" in answers[2]["error"] and answers[4] == {"error": "provide vendor, product or keyword"}
            assert answers[3] == {"rule": "M1", "rule_name": "exact match", "high_confidence": True, "similarity": 1.0, "confidence_reported": 1.0, "matched_cpe": answers[0]["entries"][0]["cpe"]}
            _, _, _, vendor, product, version, *_ = answers[0]["entries"][0]["cpe"].split(":")
            return agent.Reply(calls=[("submit", {"vendor": vendor, "product": product, "version": version, "confidence": "high", "note": "n"})])

    return Follows


def test_agent_uses_the_dictionary(spark):
    d = dictionary.prepared(spark.createDataFrame([(*entry("anvil", "kiln", "2.0"), 0), (*entry("anvil", "kilns", "1.0", dead=True), 1)], "name string, title string, deprecated boolean, ord long"))
    rows = titles(spark, [(i, "t", v, None, None, None, None, None) for i, v in enumerate(["x", "down", "silent"])])
    out = {r.k: r for r in agent.resolve_with_agent(rows, d, "k", follows(), max_turns=3).collect()}
    assert (out[0].rule, out[0].agent_turns, out[0].confidence, out[0].note) == ("M1", 2, 0.0, "n")
    assert out[1].error == "provider error: no service" and out[1].rule is None
    assert (out[2].error, out[2].agent_turns) == ("agent did not submit within 3 turns", 3)


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (7, 7), (None, 3), (205, 101), (300, 300)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(31)} | {100: 100, 101: 100, 205: 100, 300: 300}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
