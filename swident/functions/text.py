"""Titles, annotations, model answers and other free text as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import col_of

# Words that stand for no value, update words, noise patterns.
CELL_NULLS = ["", "-", "--", "---", "n/a", "null", "unknown"]
ANSWER_NULLS = ["", "null", "none", "n/a", "-"]
UPDATE_WORDS = ["beta", "alpha", "rc", "release", "build", "sp", "patch"]
NOISE = [
    r"\bkb\s?\d{6,}\b",
    r"^(?:security |cumulative )?update for\b",
    r"\bhotfix\b",
    r"\blanguage pack\b",
    r"^microsoft \.net.*targeting pack\b",
    r"^windows software development kit\b",
]
# A closing `for x`, and a word that is a version.
FOR_TARGET = r"\bfor ([a-z0-9._+-]+)\s*$"
VERSION_WORD = r"\Av?\d+(?:\.\d+)*[a-z0-9._-]*\z"
ENTITIES = ["vendor", "product", "version", "target_sw"]


def strip(s: Column | str) -> Column:
    """Without white space (Unicode's too) at either end."""
    return F.regexp_replace(col_of(s), r"(?U)^\s+|\s+$", "")


def empty_to_null(s: Column) -> Column:
    return F.when(s != "", s)


def clean_cell(s: Column | str) -> Column:
    """Stripped; null and words for nothing become the empty string."""
    t = strip(F.coalesce(col_of(s), F.lit("")))
    return F.when(F.lower(t).isin(*CELL_NULLS), F.lit("")).otherwise(t)


def compose_title(cells: list[Column], version: Column | None = None) -> Column:
    """The non-empty cells joined, then the version if the title lacks it."""
    joined = F.array_join(F.filter(F.array(*[clean_cell(c) for c in cells]), lambda x: x != ""), " ")
    if version is not None:
        v = clean_cell(version)
        joined = F.when((joined != "") & (v != "") & ~F.contains(F.lower(joined), F.lower(v)), F.concat(joined, F.lit(" "), v)).otherwise(joined)
    return strip(F.regexp_replace(joined, r"(?U)\s+", " "))


def item_title(name: Column | str, version: Column | str) -> Column:
    """The name, and the version if the name (same case) lacks it."""
    n, v = col_of(name), F.coalesce(col_of(version), F.lit(""))
    return F.when((v != "") & ~F.contains(n, v), F.concat(n, F.lit(" "), v)).otherwise(n)


def is_noise(title: Column | str) -> Column:
    """Updates, hotfixes, language packs and development kits."""
    return col_of(title).rlike("(?i)" + "|".join(f"(?:{p})" for p in NOISE))


def split_aliases(cell: Column | str) -> Column:
    """Distinct aliases of a cell in order, split at commas without a backslash before."""
    parts = F.transform(F.split(col_of(cell), r"(?<!\\),"), strip)
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def parse_annotation(title: Column | str, annotated: Column | str) -> Column:
    """Struct of entities from `[text](cpe_kind)` spans and a closing `for x`."""
    title, annotated = col_of(title), col_of(annotated)

    def first(kind: str) -> Column:
        return empty_to_null(F.lower(strip(F.regexp_extract(annotated, rf"\[([^\]]*)\]\(cpe_{kind}\)", 1))))

    target = empty_to_null(F.regexp_extract(F.lower(strip(title)), FOR_TARGET, 1))
    return F.struct(*[first(k).alias(k) for k in ("vendor", "product", "version")], target.alias("target_sw"))


def positional_extract(title: Column | str) -> Column:
    """Entities by position: vendor, product words, version, update, `for x`.

    The first word that looks like a version splits the title; the word after
    it is the update if it is an update word with digits behind at most.
    """
    text = F.lower(strip(col_of(title)))
    target = empty_to_null(F.regexp_extract(text, FOR_TARGET, 1))
    rest = strip(F.regexp_replace(text, FOR_TARGET, ""))
    words = F.array_remove(F.split(rest, r"(?U)\s+"), "")
    versions = F.transform(words, lambda w: w.rlike(VERSION_WORD))
    at = F.array_position(versions, True).cast("int")  # 1-based, 0 for none
    before = F.when(at > 0, F.slice(words, F.lit(1), F.greatest(at - 1, F.lit(0)))).otherwise(words)
    after = F.when(at > 0, F.get(words, at))
    update = F.when(F.regexp_replace(after, "[0-9]+$", "").isin(*UPDATE_WORDS), after)
    return F.struct(
        F.get(before, F.lit(0)).alias("vendor"),
        empty_to_null(F.array_join(F.slice(before, 2, 1_000_000), " ")).alias("product"),
        F.when(at > 0, F.get(words, at - 1)).alias("version"),
        update.alias("update"),
        target.alias("target_sw"),
        F.lit(0.5).alias("confidence"),
    )


def parse_response(answer: Column | str) -> Column:
    """Entities of a model's JSON answer, with `error` if it holds none.

    The text from the first to the last brace is parsed; only string values
    count, stripped and lower-cased; confidence is clamped to 0..1.
    """
    raw = F.regexp_extract(col_of(answer), r"(?s)\{.*\}", 0)
    parsed = F.try_parse_json(F.when(raw != "", raw))
    is_object = F.schema_of_variant(parsed).startswith("OBJECT")

    def text(key: str) -> Column:
        v = F.try_variant_get(parsed, f"$.{key}", "variant")
        is_string = F.schema_of_variant(v) == "STRING"
        return F.when(is_string, empty_to_null(F.lower(strip(F.try_variant_get(parsed, f"$.{key}", "string")))))

    number = F.try_variant_get(parsed, "$.confidence", "double")
    clamped = F.when(number.isNull() | F.isnan(number), F.lit(0.0)).otherwise(F.least(F.greatest(number, F.lit(0.0)), F.lit(1.0)))
    error = F.when(raw == "", F.lit("no_json")).when(parsed.isNull() | ~F.coalesce(is_object, F.lit(False)), F.lit("bad_json"))
    return F.struct(*[text(k).alias(k) for k in ("vendor", "product", "version", "update", "target_sw")], clamped.alias("confidence"), error.alias("error"))


def clean_field_answer(answer: Column | str) -> Column:
    """First line of a one-field answer without quotes; null for words of nothing."""
    line = F.split_part(strip(F.coalesce(col_of(answer), F.lit(""))), F.lit("\n"), F.lit(1))
    bare = F.lower(F.regexp_replace(line, "(?U)^[\\s\"'`]+|[\\s\"'`]+$", ""))
    return F.when(~bare.isin(*ANSWER_NULLS), bare)


def slug(name: Column | str) -> Column:
    """Lower case, runs of other characters than `a-z 0-9 . _ -` as `_`, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(col_of(name)), r"[^a-z0-9._-]+", "_"), "^_+|_+$", "")


def creator(created_by: Column | str) -> Column:
    c = F.coalesce(col_of(created_by), F.lit(""))
    return F.when(c.isin("", "system"), "system").otherwise("human")
