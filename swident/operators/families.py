"""Product families, the split deal and its leak check."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import split_name, vendor_product
from ..storage import stored
from .components import connected_components

SPLITS = ["benchmark_gold", "test", "train"]


def row_pairs(rows: DataFrame, key: str = "key") -> DataFrame:
    """rows with pairs: `vendor:product` of each 13-part alias, or `__row__:key`."""
    texts = F.transform(F.filter("cpes", lambda a: F.size(split_name(a)) == 13), lambda a: F.concat(vendor_product(a).vendor, F.lit(":"), vendor_product(a)["product"]))
    return rows.withColumn("pairs", F.when(F.size(texts) > 0, F.array_distinct(texts)).otherwise(F.array(F.concat(F.lit("__row__:"), F.col(key)))))


def families(rows: DataFrame, key: str = "key") -> DataFrame:
    """rows(key, cpes) with family, the smallest pair connected through shared rows."""
    paired = row_pairs(rows, key)
    edges = paired.select(F.get("pairs", F.lit(0)).alias("a"), F.explode("pairs").alias("b")).distinct()
    labels = connected_components(edges)
    return paired.join(labels, F.get("pairs", F.lit(0)) == F.col("node")).drop("node").withColumnRenamed("component", "family")


def deal(rows: DataFrame, fractions: dict[str, float], seed: int = 20260804) -> DataFrame:
    """rows(family, ...) with split: families dealt whole, in seeded order.

    A family goes to the first of benchmark and test that has room for it, or
    that is still empty, else to train.  The deal depends on all families before,
    so one task streams (family, size) in order past two running totals.
    """
    sizes = stored(rows.groupBy("family").agg(F.count("*").cast("long").alias("size")), "sizes")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    room = [math.floor(total * fractions[s]) for s in SPLITS[:2]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealt = [0, 0]
        for b in batches:
            out = []
            for size in b.column(1).to_pylist():
                to = next((i for i in (0, 1) if dealt[i] + size <= room[i] or not dealt[i]), 2)
                if to < 2:
                    dealt[to] += size
                out.append(SPLITS[to])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["family", "split"])

    seeded = F.md5(F.concat(F.lit(f"{seed}:"), F.col("family")).cast("binary"))
    in_order = sizes.orderBy(seeded, "family").coalesce(1)
    return rows.join(in_order.mapInArrow(run, "family string, split string"), "family")


def leaks(dealt: DataFrame) -> DataFrame:
    """Pairs that occur in more than one split; empty for a sound deal."""
    return dealt.select(F.explode("pairs").alias("pair"), "split").groupBy("pair").agg(F.count_distinct("split").alias("n_splits")).where("n_splits > 1")
