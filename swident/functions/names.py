"""CPE 2.3 names as column expressions.

Components travel bound: `*` is ANY, `-` is NA, anything else an escaped value.
All functions are native expressions, so they stay in generated code.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed values of the name format.
PREFIX = "cpe:2.3"
ATTRIBUTES = ["part", "vendor", "product", "version", "update", "edition", "language", "sw_edition", "target_sw", "target_hw", "other"]
PARTS = ["a", "o", "h", "*", "-"]

_VALUE = r"(?:\*|-|(?:\*|\?+)?(?:[a-z0-9._-]|\\[!-/:-@\[-\^`{-~])+(?:\*|\?+)?)"
GRAMMAR = r"\Acpe:2\.3:[aoh*-](?::" + _VALUE + r"){10}\z"


def col_of(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value worked out once and its text not repeated in the plan."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def normalize_raw(s: Column | str) -> Column:
    """Strip, lower-case and turn each run of Unicode white space into `_`."""
    trimmed = F.regexp_replace(F.lower(col_of(s)), r"(?U)^\s+|\s+$", "")
    return F.regexp_replace(trimmed, r"(?U)\s+", "_")


def bind_component(value: Column | str) -> Column:
    """Escape all but `a-z 0-9 . _ -`; null (no value) binds to ANY."""
    return F.coalesce(F.regexp_replace(col_of(value), r"([^a-z0-9._-])", r"\\$1"), F.lit("*"))


def bind_raw(value: Column | str) -> Column:
    """Normalise and bind; null and the empty string are ANY."""
    v = col_of(value)
    return F.when(v.isNull() | (v == ""), F.lit("*")).otherwise(bind_component(normalize_raw(v)))


def unbind_component(c: Column | str) -> Column:
    """The raw value, null for ANY and NA, and for a dangling escape."""
    c = col_of(c)
    dangling = F.regexp_replace(c, r"(?s)\\.", "").endswith("\\")
    return F.when(c.isin("*", "-") | dangling, F.lit(None).cast("string")).otherwise(F.regexp_replace(c, r"(?s)\\(.)", "$1"))


def split_name(s: Column | str) -> Column:
    """Components between unescaped colons, escapes paired from the left.

    A lone backslash at the very end belongs to the last component.
    """
    s = col_of(s)
    cells = F.regexp_extract_all(s, F.lit(r"(?s)((?:\\.|[^:\\]|\\\z)*)(?::|\z)"), F.lit(1))
    # the pattern also matches the empty rest after a last component without colon
    return F.when(s == "", F.array(F.lit(""))).otherwise(F.slice(cells, F.lit(1), F.size(cells) - F.when(s.rlike(r"(?s)\A(?:\\.|[^\\])*:\z"), F.lit(0)).otherwise(F.lit(1))))


def component(s: Column | str, i: int) -> Column:
    """The i-th of the 13 components (0 is `cpe`), null if there are fewer."""
    return F.get(split_name(s), F.lit(i))


def bind_name(**components: Column) -> Column:
    """A bound name from bound components; attributes not given are ANY."""
    cells = [F.coalesce(components.get(a, F.lit("a" if a == "part" else "*")), F.lit("*")) for a in ATTRIBUTES]
    return F.concat_ws(":", F.lit(PREFIX), *cells)


def build_name(vendor: Column, product: Column, version: Column, update: Column | None = None, target_sw: Column | None = None) -> Column:
    """The name of raw entities; null if neither vendor nor product is given."""
    given = lambda x: x.isNotNull() & (x != "")
    more = {k: bind_raw(v) for k, v in (("update", update), ("target_sw", target_sw)) if v is not None}
    name = bind_name(vendor=bind_raw(vendor), product=bind_raw(product), version=bind_raw(version), **more)
    return F.when(given(vendor) | given(product), name)


def build_name_from_map(args: Column) -> Column:
    """As build_name from a map of strings, whose blank values are ANY."""
    value = lambda k: F.nullif(F.trim(F.element_at(args, F.lit(k))), F.lit(""))
    return build_name(*(value(k) for k in ("vendor", "product", "version", "update", "target_sw")))


def unbind_name(s: Column | str) -> Column:
    """A struct of the 11 bound components, null if the name is malformed."""

    def body(cells: Column) -> Column:
        good = (F.size(cells) == 13) & (F.get(cells, F.lit(0)) == "cpe") & (F.get(cells, F.lit(1)) == "2.3") & F.get(cells, F.lit(2)).isin(*PARTS)
        return F.when(good, F.struct(*[F.get(cells, F.lit(i + 2)).alias(a) for i, a in enumerate(ATTRIBUTES)]))

    return let(split_name(s), body)


def components_map(s: Column | str) -> Column:
    """Attribute -> bound component of a valid name, null for others."""
    cells = F.slice(split_name(s), 3, 11)
    return F.when(is_valid_name(s), F.map_from_arrays(F.array(*[F.lit(a) for a in ATTRIBUTES]), cells))


def wfn_text(name: Column) -> Column:
    """`wfn:[part="a", vendor="v", ...]` of an unbound struct; ANY is left out."""
    cells = []
    for a in ATTRIBUTES:
        c = name.getField(a)
        quoted = F.regexp_replace(F.regexp_replace(c, r"(?s)\\(.)", "$1"), r"([^a-z0-9_])", r"\\$1")
        cells.append(F.when(c == "*", F.lit(None)).when(c == "-", F.lit(f"{a}=NA")).otherwise(F.concat(F.lit(f'{a}="'), quoted, F.lit('"'))))
    return F.when(name.isNotNull(), F.concat(F.lit("wfn:["), F.array_join(F.array_compact(F.array(*cells)), ", "), F.lit("]")))


def is_valid_name(s: Column | str) -> Column:
    """True if the whole string follows the grammar."""
    return col_of(s).rlike(GRAMMAR)


def component_errors(c: Column, attribute: Column | str) -> Column:
    """Kinds of error in one component, as `attribute:kind` in a fixed order."""
    a = F.lit(attribute) if isinstance(attribute, str) else attribute
    # paired escapes become one letter, so that what remains unescaped stands alone
    bare = F.regexp_replace(c, r"(?s)\\.", "e")
    bad = r"[^a-z0-9._\-*?]"
    kinds = [
        F.when(c == "", F.lit("empty")),
        F.when(bare.endswith("\\"), F.lit("dangling_escape")),
        F.when(F.exists(F.regexp_extract_all(c, F.lit(r"(?s)\\."), F.lit(0)), lambda e: e.rlike(r"(?s)\A\\[A-Za-z0-9_]\z")), F.lit("illegal_escape")),
        F.when(F.exists(F.regexp_extract_all(c, F.lit(r"(?s)\\."), F.lit(0)), lambda e: e.rlike(r"(?s)\A\\[^!-~]\z")), F.lit("nonprintable_escape")),
        F.when(bare.rlike("[A-Z]"), F.lit("uppercase")),
        F.when(bare.rlike(r"[ \t\n\r\x0b\x0c]"), F.lit("whitespace")),
        F.when(bare.rlike(r"(?s)[^A-Za-z0-9._\-*? \t\n\r\x0b\x0c\\]"), F.lit("special")),
        F.when(F.regexp_replace(bare, bad, "").rlike(r"\A[*?]*[^*?].*[*?].*[^*?][*?]*\z"), F.lit("wildcard_middle")),
        F.when((c != "") & F.regexp_replace(bare, bad, "").rlike(r"\A[*?]*\z"), F.lit("wildcard_only")),
        F.when(F.regexp_replace(bare, bad, "").rlike(r"\A(?:\*[*?]+|\?+\*[*?]*)|[^*?](?:\*[*?]+|\?+\*[*?]*)\z"), F.lit("wildcard_run")),
    ]
    named = F.transform(F.array_compact(F.array(*kinds)), lambda k: F.concat(a, F.lit(":"), k))
    return F.when(c.isin("*", "-"), F.array().cast("array<string>")).otherwise(named)


def validation_errors(s: Column | str) -> Column:
    """All error kinds of a name, empty for a valid one.

    White space comes first (after a wrong prefix); with a wrong prefix or count
    of components, the components themselves are not looked at.
    """
    s = col_of(s)
    none = F.array().cast("array<string>")
    space = F.when(s.rlike(r"[ \t\n\r\x0b\x0c]"), F.array(F.lit("whitespace"))).otherwise(none)

    def body(cells: Column) -> Column:
        part = F.when(~F.get(cells, F.lit(2)).isin(*PARTS), F.array(F.lit("part:invalid"))).otherwise(none)
        attributes = F.array(*[F.lit(a) for a in ATTRIBUTES[1:]])
        each = F.flatten(F.zip_with(F.slice(cells, 4, 10), attributes, lambda c, a: component_errors(c, a)))
        prefixed = F.coalesce((F.get(cells, F.lit(0)) == "cpe") & (F.get(cells, F.lit(1)) == "2.3"), F.lit(False))
        return F.when(~prefixed, F.concat(F.array(F.lit("prefix")), space)).when(F.size(cells) != 13, F.concat(space, F.array(F.lit("component_count")))).otherwise(F.concat(space, part, each))

    return let(split_name(s), body)


def unescape_permissive(c: Column | str) -> Column:
    """Drop each escaping backslash, keeping one that dangles."""
    return F.regexp_replace(col_of(c), r"(?s)\\(.)", "$1")


def canonicalize_alias(alias: Column | str) -> Column:
    """A near-miss name with normalised, escaped values; null beyond salvage."""
    s = F.regexp_replace(col_of(alias), r"(?U)^\s+|\s+$", "")

    def salvage(c: Column) -> Column:
        raw = normalize_raw(unescape_permissive(c))
        return F.when(c.isin("*", "-"), c).when(raw != "", bind_component(raw))

    def body(cells: Column) -> Column:
        shaped = (F.size(cells) == 13) & (F.lower(F.get(cells, F.lit(0))) == "cpe") & (F.get(cells, F.lit(1)) == "2.3")
        values = F.transform(F.slice(cells, 3, 11), salvage)
        return F.when(shaped & ~F.exists(values, lambda v: v.isNull()), F.concat(F.lit(PREFIX + ":"), F.array_join(values, ":")))

    return let(split_name(s), body)


def surrogate_key(title: Column | str, cell: Column | str) -> Column:
    """`d_` and 32 hex digits of the SHA-1 of title, unit separator and cell."""
    return F.concat(F.lit("d_"), F.substring(F.sha1(F.concat(col_of(title), F.lit("\x1f"), col_of(cell)).cast("binary")), 1, 32))


def vendor_product(alias: Column | str) -> Column:
    """(vendor, product) bound text, empty strings if the name has not 13 parts."""

    def body(cells: Column) -> Column:
        full = F.size(cells) == 13
        return F.struct(F.when(full, F.get(cells, F.lit(3))).otherwise("").alias("vendor"), F.when(full, F.get(cells, F.lit(4))).otherwise("").alias("product"))

    return let(split_name(alias), body)


def register_sql(spark: SparkSession) -> None:
    """The scalar functions as SQL functions, which Catalyst inlines."""
    pattern = GRAMMAR.replace("\\", "\\\\").replace("'", "\\'")
    for name, body in (
        ("cpe_normalize", r"regexp_replace(regexp_replace(lower(s), '(?U)^\\s+|\\s+$', ''), '(?U)\\s+', '_')"),
        ("cpe_bind", r"coalesce(regexp_replace(s, '([^a-z0-9._-])', '\\\\$1'), '*')"),
        ("cpe_unbind", r"if(s in ('*', '-'), null, regexp_replace(s, '(?s)\\\\(.)', '$1'))"),
    ):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING) RETURNS STRING RETURN {body}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION cpe_is_valid(s STRING) RETURNS BOOLEAN RETURN s rlike '{pattern}'")
