import random
import re

import pytest
from pyspark.sql import functions as F

from swident.functions import names as n

T = "cpe:2.3:a:vendor:{}:1.0:*:*:*:*:*:*:*"
CASES = [
    (r"pen\:nib", True), ("d++", False), (r"d\+\+", True), (r"ink\well", False), (r"50\%_grey", True), ("*quill", True),
    ("qu*ill", False), ("qu?ill", False), ("???quill", True), (r"qu\*ill", True), ("-quill", True), ("**", False), ("???", False), ("?*", False), ("", False), ("Ink", False), ("in k", False), ("ö", False),
]


def column(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r.x for r in df.select("i", expr(F.col("s")).alias("x")).orderBy("i").collect()]


def test_grammar_cases(spark):
    assert column(spark, [T.format(c) for c, _ in CASES], n.is_valid_name) == [ok for _, ok in CASES]
    whole = ["cpe:2.3:" + ":".join(["*"] * 11), "cpe:2.3:" + ":".join(["-"] * 11), T.format("p").replace(":a:", ":x:"), T.format("p") + ":x", T.format("p")[:-2], T.format("p") + "\n", "cpe:2.2" + T.format("p")[7:]]
    assert column(spark, whole, n.is_valid_name) == [True, True, False, False, False, False, False]


def recognise(s):
    """The grammar, character by character."""
    cells, cell, i = [], "", 0
    while i < len(s):
        if s[i] == "\\" and i + 1 < len(s):
            cell, i = cell + s[i : i + 2], i + 2
        elif s[i] == ":":
            cells, cell, i = [*cells, cell], "", i + 1
        else:
            cell, i = cell + s[i], i + 1
    cells.append(cell)
    if cells[:2] != ["cpe", "2.3"] or len(cells) != 13 or cells[2] not in ("a", "o", "h", "*", "-"):
        return False
    for c in cells[3:]:
        if c in ("*", "-"):
            continue
        m = re.fullmatch(r"(\*|\?*)(.*?)(\*|\?*)", c, re.S)
        if m is None:
            return False
        body, j, count = m[2], 0, 0
        while j < len(body):
            if body[j] == "\\":
                if j + 1 >= len(body) or not re.fullmatch(r"[!-~]", body[j + 1]) or re.fullmatch(r"[A-Za-z0-9_]", body[j + 1]):
                    return False
                j += 2
            elif re.fullmatch(r"[a-z0-9._-]", body[j]):
                j += 1
            else:
                return False
            count += 1
        if not count:
            return False
    return True


def test_validator_against_a_plain_recogniser(spark):
    rng = random.Random(3)
    alphabet = ["a", "b", "1", "_", ".", "-", "*", "?", "\\", "\\+", "\\a", "A", " ", ":", "é", "+"]
    values = []
    for _ in range(3000):
        cells = ["".join(rng.choices(alphabet, weights=[9, 9, 5, 3, 3, 3, 2, 2, 1, 4, 1, 1, 1, 1, 1, 1], k=rng.randint(0, 4))) if rng.random() < 0.3 else "x" for _ in range(10)]
        values.append("cpe:2.3:a:" + ":".join(cells))
    got = column(spark, values, n.is_valid_name)
    assert got == [recognise(v) for v in values] and 100 < sum(got) < 2900
    errors = column(spark, values, n.validation_errors)
    assert [not e for e in errors] == got


@pytest.mark.parametrize(("raw", "bound"), [("c++", r"c\+\+"), ("100% cpu", r"100\%_cpu"), ("a:b", r"a\:b"), ("tilde~name", r"tilde\~name"), ("back\\slash", r"back\\slash"), ("(x64)", r"\(x64\)"), ("  Zoho Corp ", "zoho_corp"), ("a\t  b", "a_b"), ("\u00a0x\u00a0", "x"), ("v1.*", r"v1.\*")])
def test_bind_and_back(spark, raw, bound):
    assert column(spark, [raw], lambda s: n.bind_raw(s)) == [bound]
    assert column(spark, [bound], n.unbind_component) == column(spark, [raw], n.normalize_raw)
    assert column(spark, [T.format(bound)], n.is_valid_name) == [True]


def test_split_pairs_escapes_from_the_left(spark):
    values = ["a:b", r"a\:b:c", "a\\\\:b", "", "a:", ":a", "a\\", "x:\n"]
    assert column(spark, values, n.split_name) == [["a", "b"], [r"a\:b", "c"], ["a\\\\", "b"], [""], ["a", ""], ["", "a"], ["a\\"], ["x", "\n"]]


def test_logical_values_and_empty_ones(spark):
    assert column(spark, [None, "", " ", "-", "*"], n.bind_raw) == ["*", "*", "", "-", r"\*"]
    assert column(spark, ["*", "-", r"a\+", "a\\"], n.unbind_component) == [None, None, "a+", None]


def test_wfn_text_and_round_trip(spark):
    name = r"cpe:2.3:a:7-zip:7-zip:26.01:-:*:*:*:*:*:*"
    assert column(spark, [name], lambda s: n.wfn_text(n.unbind_name(s))) == [r'wfn:[part="a", vendor="7\-zip", product="7\-zip", version="26\.01", update=NA]']
    assert column(spark, ["cpe:2.3:q:a"], lambda s: n.wfn_text(n.unbind_name(s))) == [None]
    assert column(spark, [name], lambda s: n.components_map(s)["version"]) == ["26.01"]


def test_salvage(spark):
    near = ["cpe:2.3:a:Acme:ProLiant:2.69 (Gen9 Server):*:*:*:*:*:*:*", "cpe:2.3:a:b", r" CPE:2.3:a:a:b\+:1:*:*:*:*:*:*:* ", "cpe:2.3:a: :b:1:*:*:*:*:*:*:*"]
    assert column(spark, near, n.canonicalize_alias) == [r"cpe:2.3:a:acme:proliant:2.69_\(gen9_server\):*:*:*:*:*:*:*", None, r"cpe:2.3:a:a:b\+:1:*:*:*:*:*:*:*", None]


def test_error_kinds_and_sql_functions(spark):
    kinds = column(spark, [T.format("a*b C"), T.format("a\\"), T.format(r"\é")], n.validation_errors)
    assert kinds == [["whitespace", "product:uppercase", "product:whitespace", "product:wildcard_middle"], ["component_count"], ["product:nonprintable_escape"]]
    n.register_sql(spark)
    r = spark.sql("select cpe_bind(cpe_normalize(' C++ ')) b, cpe_unbind('c\\\\+') u, cpe_is_valid('cpe:2.3:a:a:b:1:*:*:*:*:*:*:*') v").first()
    assert (r.b, r.u, r.v) == (r"c\+\+", "c+", True)


def test_names_stay_native(spark):
    df = spark.range(1).select(n.build_name(F.lit("A b"), F.lit("c"), F.lit("1")).alias("x")).select(n.is_valid_name("x"), n.validation_errors("x"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
