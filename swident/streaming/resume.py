"""Restartable runs: file streams with checkpoints instead of append-and-skip loops."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def resumable_run(spark: SparkSession, source: str, schema: StructType, work: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str) -> StreamingQuery:
    """Process the Parquet files of `source` that no former run has processed.

    work maps a batch of titles to results; titles that the sink already has are
    skipped, so a run that was cut short between sink and checkpoint writes no
    title twice.  All available files are taken, then the query ends.
    """

    def batch(df: DataFrame, _: int) -> None:
        fresh = df.dropDuplicates(["title"])
        if _has_rows(df.sparkSession, sink):
            fresh = fresh.join(df.sparkSession.read.parquet(sink).select("title"), "title", "left_anti")
        work(fresh).write.mode("append").parquet(sink)

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _has_rows(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(where)) and any(s.getPath().getName().endswith(".parquet") for s in fs.listStatus(where))
