"""File sources with explicit schemas.  Input position is a column, never assumed.

position(): CSV and text files that are read in order get `pos` from the file
name, block start and row counter, so that firsts and lasts are well defined
whatever the number of splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import strip
from ..storage import exists, small_side, stored

RESULT_FIELDS = ["title", "vendor", "product", "version", "update", "target_sw", "confidence", "cpe", "valid", "validation_errors", "rule", "rule_name", "match_similarity", "matched_cpe", "error", "stage", "fast_rule", "agent_turns", "note", "latency_ms", "tokens_in", "tokens_out"]
SNAPSHOT = "cpeName string, cpeNameId string, title string, deprecated boolean, ord long"


def position(df: DataFrame) -> DataFrame:
    """df with pos, rising in file order.

    Scans give the rows of a block (file and start) in order within a partition,
    so their increasing ids are without gaps there: a row's place is its block's
    offset plus its id less the block's first.  Blocks are counted in a pass of
    their own and are the small side of the join; rows are not moved.
    """
    marked = df.select("*", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_i"))
    blocks = marked.groupBy("_f", "_b").agg(F.count("*").alias("_n"), F.min("_i").alias("_i0"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_f", "_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = stored(blocks.select("_f", "_b", (before - F.col("_i0")).alias("_p0")), "blocks")
    return marked.join(small_side(starts), ["_f", "_b"]).withColumn("pos", (F.col("_p0") + F.col("_i")).cast("long")).drop("_f", "_b", "_i", "_p0")


def read_titles(spark: SparkSession, path: str) -> DataFrame:
    """title and annotated of a headerless CSV; blank titles and a header row are skipped."""
    raw = position(spark.read.schema("title string, annotated string").option("multiLine", True).option("escape", '"').csv(path))
    named = raw.where(F.coalesce(strip("title"), F.lit("")) != "")
    return named.where(~((F.lower(strip("title")) == "title") & (F.col("pos") == 0))).select("pos", strip("title").alias("title"), "annotated")


def read_export(spark: SparkSession, path: str, columns: list[str], sep: str = ",") -> DataFrame:
    """Named columns of a CSV export with a header (and perhaps a byte order mark)."""
    df = spark.read.option("header", True).option("sep", sep).option("multiLine", True).option("escape", '"').csv(path)
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"input is missing columns {missing}; found {df.columns}")
    return position(df)


def read_catalog(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """Rows of a `;`-separated catalog export with line and malformed.

    A row is malformed if it has not as many fields as the header; lines count
    from 2, as the header is line 1.
    """
    head = spark.read.option("header", True).option("sep", ";").csv(path).columns
    if missing := [c for c in required if c not in head]:
        raise ValueError(f"input is missing expected columns: {missing}")
    schema = ", ".join(f"`{c}` string" for c in head) + ", _bad string"
    options = {"header": False, "sep": ";", "multiLine": True, "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "columnPruning": False}
    # the parser keeps the text of a record whose fields don't fit the schema
    rows = position(spark.read.schema(schema).options(**options).csv(path)).where("pos > 0")
    return rows.select((F.col("pos") + 1).alias("line"), F.col("_bad").isNotNull().alias("malformed"), *[F.col(f"`{c}`") for c in head])


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """name, title, deprecated and ord of a JSON-lines snapshot, plain or gzipped.

    Snapshots of build_snapshot() say each entry's place; others count in file order.
    """
    raw = position(spark.read.schema(SNAPSHOT).json(path))
    return raw.select(F.col("cpeName").alias("name"), F.coalesce("title", F.lit("")).alias("title"), F.coalesce("deprecated", F.lit(False)).alias("deprecated"), F.coalesce("ord", "pos").alias("ord"))


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """A results CSV, typed; columns beside the known 22 stay as text."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    casts = {"valid": F.col("valid") == "True", "confidence": F.col("confidence").try_cast("double"), "match_similarity": F.col("match_similarity").try_cast("double")} | {c: F.col(c).try_cast("long") for c in ("agent_turns", "latency_ms", "tokens_in", "tokens_out")}
    return position(df).withColumns({k: v for k, v in casts.items() if k in df.columns})


def read_tiers(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Parsed catalogs of several tiers in one frame, each row with its tier."""
    out = None
    for tier, path in paths.items():
        one = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path).withColumn("tier", F.lit(tier))
        out = one if out is None else out.unionByName(one)
    return out


def read_replay(spark: SparkSession, path: str) -> DataFrame:
    """title and answer (JSON text) of one JSON object keyed by title."""
    raw = spark.read.option("wholetext", True).text(path)
    return raw.select(F.explode(F.expr("variant_get(parse_json(value), '$', 'map<string,variant>')")).alias("title", "v")).select("title", F.to_json("v").alias("answer"))


def read_packages(spark: SparkSession, path: str, source: str) -> DataFrame:
    """name, version, vendor and source of a tab-separated dpkg or rpm listing."""
    cells = F.split("value", "\t")
    rows = position(spark.read.text(path)).where(F.size(cells) >= 2)
    return rows.select("pos", F.substring_index(cells[0], ":", 1).alias("name") if source == "dpkg" else cells[0].alias("name"), cells[1].alias("version"), F.coalesce(F.get(cells, F.lit(2)), F.lit("")).alias("vendor"), F.lit(source).alias("source"))


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """query and payload (JSON text) of a cache: a table of write_cache(), or a JSON object keyed by query.

    A cache that is not there yet is empty.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], "query string, payload string")
    if path.endswith(".json"):
        return read_replay(spark, path).select(F.col("title").alias("query"), F.col("answer").alias("payload"))
    return spark.read.schema("query string, payload string").parquet(path)


def registry_items(spark: SparkSession) -> DataFrame:
    """Installed software of this Windows host (three hives); empty elsewhere."""
    items: list[tuple[str, str, str, str]] = []
    try:
        import winreg
    except ImportError:
        winreg = None
    if winreg:
        base = r"Software\Microsoft\Windows\CurrentVersion\Uninstall"
        hives = [(winreg.HKEY_LOCAL_MACHINE, winreg.KEY_WOW64_64KEY, "hklm64"), (winreg.HKEY_LOCAL_MACHINE, winreg.KEY_WOW64_32KEY, "hklm32"), (winreg.HKEY_CURRENT_USER, 0, "hkcu")]
        for root, view, source in hives:
            with winreg.OpenKey(root, base, 0, winreg.KEY_READ | view) as top:
                for i in range(winreg.QueryInfoKey(top)[0]):
                    with winreg.OpenKey(top, winreg.EnumKey(top, i)) as k:
                        values = {winreg.EnumValue(k, j)[0]: winreg.EnumValue(k, j)[1] for j in range(winreg.QueryInfoKey(k)[1])}
                    if values.get("SystemComponent") != 1 and values.get("DisplayName"):
                        items.append((str(values["DisplayName"]), str(values.get("DisplayVersion", "")), str(values.get("Publisher", "")), source))
    rows = [(i, *r) for i, r in enumerate(items)]
    return spark.createDataFrame(rows, "pos long, name string, version string, vendor string, source string")


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """path and SHA-256 of each file."""
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"))
