"""Tables in the folder that driver and executors share, and checked broadcasts.

Step tables cut lineage in a way that outlives any executor.  They stay until
release() or the end of the process, as a query's result may still read them.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes up to which a side of a join is broadcast.
BROADCAST_BYTES = 128 << 20
_made: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder, from spark.checkpoint.dir.

    Where that is absent a local master gets a folder of its own; a cluster has
    no folder that all machines see, so there the setting is required.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        local = tempfile.mkdtemp(prefix="swident-")
        atexit.register(shutil.rmtree, local, ignore_errors=True)
        path = f"file://{local}"
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, to be removed by release()."""
    if not _made:
        atexit.register(_at_exit)
    _made.append(f"{shared_dir(spark)}/swident/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def stored(df: DataFrame, name: str = "step") -> DataFrame:
    """df written as Parquet to the shared folder and read again."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file(spark: SparkSession, path: str) -> tuple:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _file(spark, path)
    return fs.exists(where)


def replace(df: DataFrame, path: str) -> None:
    """Write df as Parquet beside `path` and put it in its place when it is whole."""
    spark = df.sparkSession
    beside = f"{path.rstrip('/')}.{uuid.uuid4().hex}.new"
    df.write.parquet(beside)
    fs, where = _file(spark, path)
    if fs.exists(where):
        fs.delete(where, True)
    fs.rename(_file(spark, beside)[1], where)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small text file on whatever store the path names."""
    fs, where = _file(spark, path)
    out = fs.create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def release(spark: SparkSession) -> None:
    """Remove all step tables made so far; call it when results are written."""
    paths, _made[:] = _made[:], []
    for path in paths:
        fs, where = _file(spark, path)
        fs.delete(where, True)


def _at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        release(spark)


def fits(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether df's rows are shown to take max_bytes at most.

    The size is counted: fixed-width columns by their width, others by the bytes
    of their text form.
    """
    fixed = {"boolean": 1, "int": 4, "bigint": 8, "double": 8}
    width = sum(fixed.get(t, 0) for _, t in df.dtypes) + 16
    sizes = [F.octet_length(F.col(f"`{c}`")) if t in ("string", "binary") else F.octet_length(F.to_json(F.struct(f"`{c}`"))) for c, t in df.dtypes if t not in fixed]
    size = sum((F.coalesce(s, F.lit(0)) for s in sizes), F.lit(width)).cast("long")
    return (df.agg(F.sum(size)).first()[0] or 0) <= max_bytes


def small_side(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if it fits max_bytes, else unhinted: beyond the bound the join shuffles."""
    return F.broadcast(df) if fits(df, max_bytes) else df
