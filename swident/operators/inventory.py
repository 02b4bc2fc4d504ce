"""Title preparation and inventory clean-up: filter in a fixed order, keep firsts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import compose_title, is_noise, item_title, strip


def first_of(df: DataFrame, keys: list[Column], pos: str = "pos") -> DataFrame:
    """The row with the smallest pos of each key; row_number prunes before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(pos))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def last_of(df: DataFrame, keys: list[str], pos: str = "pos") -> DataFrame:
    """The row with the largest pos of each key."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in df.columns if c not in keys]), pos).alias("_last")).select(*keys, "_last.*")


def title_outcome(rows: DataFrame, columns: list[str], version: str | None = None, min_length: int = 3, keep_noise: bool = False) -> DataFrame:
    """pos, title and outcome: garbage, too_short, noise, duplicate or written.

    Checks run in that order; only titles that pass the others count as seen.
    """
    title = compose_title([F.col(c) for c in columns], F.col(version) if version else None)
    noisy = F.lit(False) if keep_noise else is_noise("title")
    first = F.when(F.col("title") == "", "garbage").when(F.length("title") < min_length, "too_short").when(noisy, "noise")
    rows = rows.select("pos", title.alias("title")).withColumn("outcome", first)
    seen = F.row_number().over(Window.partitionBy(F.lower("title"), F.col("outcome")).orderBy("pos"))
    return rows.withColumn("_n", F.when(F.col("outcome").isNull(), seen)).select("pos", "title", F.coalesce("outcome", F.when(F.col("_n") == 1, "written").otherwise("duplicate")).alias("outcome"))


def titles(rows: DataFrame, columns: list[str], version: str | None = None, **options: object) -> DataFrame:
    """pos and title of the distinct titles worth resolving."""
    return title_outcome(rows, columns, version, **options).where("outcome = 'written'").select("pos", "title")


def title_counters(outcomes: DataFrame) -> DataFrame:
    kinds = {"garbage": "garbage", "too_short": "too_short", "noise": "noise", "duplicates": "duplicate", "written": "written"}
    return outcomes.agg(F.count("*").alias("rows_read"), *[F.count_if(F.col("outcome") == v).alias(k) for k, v in kinds.items()])


def curate_inventory(items: DataFrame, keep_noise: bool = False) -> DataFrame:
    """First item of each (name, version), without empty and noisy ones, in name order.

    A noisy item still counts as the first of its key.
    """
    named = items.withColumns({c: strip(F.coalesce(c, F.lit(""))) for c in ("version", "vendor")}).withColumn("clean", strip(F.coalesce("name", F.lit("")))).where("clean <> ''")
    firsts = first_of(named, [F.lower("clean"), F.lower("version")])
    kept = firsts if keep_noise else firsts.where(~is_noise("name"))
    return kept.select("pos", F.col("clean").alias("name"), "version", "vendor", "source", item_title("clean", "version").alias("title")).orderBy(F.lower("name"), "pos")
