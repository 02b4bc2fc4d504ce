from pyspark.sql import functions as F

from swident.functions import text as t
from swident.functions.similarity import compare_entity, products_share_tokens, similarity
from swident.operators import inventory


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first().x


def test_annotations(spark):
    e = one(spark, t.parse_annotation(F.lit("in2code femanager 5.5.1 for typo3"), F.lit("[in2code](cpe_vendor) [femanager](cpe_product) [5.5.1](cpe_version) [x](cpe_version)")))
    assert tuple(e) == ("in2code", "femanager", "5.5.1", "typo3")
    assert tuple(one(spark, t.parse_annotation(F.lit("a"), F.lit(None).cast("string")))) == (None, None, None, None)


def test_positional(spark):
    got = lambda s: tuple(one(spark, t.positional_extract(F.lit(s))))[:5]
    assert got("gecad axigen mail server 3.0 beta") == ("gecad", "axigen mail server", "3.0", "beta", None)
    assert got(" Riot.js compiler v3.1.2 RC2 x for node.js ") == ("riot.js", "compiler", "v3.1.2", "rc2", "node.js")
    assert got("solo") == ("solo", None, None, None, None)
    assert got("") == (None, None, None, None, None)
    assert got("7.1 thing") == (None, None, "7.1", None, None)


def test_answers(spark):
    r = one(spark, t.parse_response(F.lit('x {"vendor": " MS ", "product": 5, "version": "", "confidence": "7"} y')))
    assert (r.vendor, r.product, r.version, r.confidence, r.error) == ("ms", None, None, 1.0, None)
    assert one(spark, t.parse_response(F.lit("none"))).error == "no_json"
    assert one(spark, t.parse_response(F.lit("{a}"))).error == "bad_json"
    clean = lambda s: one(spark, t.clean_field_answer(F.lit(s)))
    assert [clean(s) for s in ('"Microsoft"\nmore', "None", "N/A", "-", None, " ")] == ["microsoft", None, None, None, None, None]


def test_titles_in_order(spark):
    rows = [(0, "Acme", "Tool", "1.0"), (1, "-", "unknown", "2"), (2, "ACME", "tool", "1.0"), (3, "a", None, None), (4, "Security Update for Office", "(KB2837593)", ""), (5, "Acme", "Tool 1.0", "1.0"), (6, "Acme", " Tool ", "2, 0")]
    df = spark.createDataFrame(rows, "pos long, company string, product string, version string")
    out = inventory.title_outcome(df, ["company", "product"], "version")
    assert [(r.pos, r.title, r.outcome) for r in out.orderBy("pos").collect()] == [(0, "Acme Tool 1.0", "written"), (1, "", "garbage"), (2, "ACME tool 1.0", "duplicate"), (3, "a", "too_short"), (4, "Security Update for Office (KB2837593)", "noise"), (5, "Acme Tool 1.0", "duplicate"), (6, "Acme Tool 2, 0", "written")]
    c = inventory.title_counters(out).first()
    assert (c.rows_read, c.garbage, c.too_short, c.noise, c.duplicates, c.written) == (7, 1, 1, 1, 2, 2)
    assert inventory.titles(df.limit(0), ["company"]).count() == 0


def test_inventory(spark):
    rows = [(0, " Zip ", "1", "V", "dpkg"), (1, "zip", "1 ", "W", "rpm"), (2, "", "1", "", "rpm"), (3, "Language Pack x", None, None, "rpm"), (4, "abc 2", "2", "", "rpm")]
    out = inventory.curate_inventory(spark.createDataFrame(rows, "pos long, name string, version string, vendor string, source string")).collect()
    assert [(r.name, r.version, r.vendor, r.title) for r in out] == [("abc 2", "2", "", "abc 2"), ("Zip", "1", "V", "Zip 1")]


def test_similarity_and_overlap(spark):
    assert one(spark, similarity(F.lit(""), F.lit(""))) == 1.0
    assert abs(one(spark, similarity(F.lit("kitten"), F.lit("sitting"))) - (1 - 3 / 7)) < 1e-12
    share = lambda *p: one(spark, products_share_tokens(F.array(*[F.lit(x) for x in p])))
    assert [share("a_b", "b-c", "c.b"), share("a_b", "c"), share("a")] == [True, False, True]
    pairs = [("axigen_mail_server", "axigen_mail"), ("protobuf", "protobufs"), ("in2code", "google"), ("5.5.1", "5.5"), ("a", "a"), ("a", None), (None, "a"), (None, None)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, g string, p string")
    assert [r.c for r in df.select("i", compare_entity("g", "p").alias("c")).orderBy("i").collect()] == ["PAR", "PAR", "INC", "PAR", "COR", "MIS", "SPU", None]


def test_aliases_and_slug(spark):
    assert one(spark, t.split_aliases(F.lit(r" a , b\,c,,a"))) == ["a", r"b\,c"]
    assert one(spark, t.slug(F.lit("Qwen/3 8B!"))) == "qwen_3_8b"
