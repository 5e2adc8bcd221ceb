"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when its counted rows take at most this many bytes.
BROADCAST_BYTES = 64_000_000
#: So many rows of a table that is grouped by a key come to a task.
TASK_ROWS = 300_000
_LOCAL: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir; only one-machine sessions may do without."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="spark-"))
    return _LOCAL[0]


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: lineage is cut and a lost executor loses nothing."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, *keys: str, rows: int | None = None) -> DataFrame:
    """df by its keys in tasks of about TASK_ROWS rows, so a task's memory doesn't grow with the table; a small df stays as it is.

    `rows` is the number of its rows, or a bound, where counting it would compute it.
    Joins, windows and groups on the same keys that follow need no further shuffle, and Spark doesn't merge these partitions.
    """
    parts = (df.count() if rows is None else rows) // TASK_ROWS
    return df.repartition(max(parts, df.sparkSession.sparkContext.defaultParallelism), *keys) if parts > 1 else df


def write_counted(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None, **options: str) -> int:
    """Write Parquet and say how many rows, counted as they were written and not by reading them again."""
    seen = Observation()
    writer = df.observe(seen, F.count("*").alias("n")).write.mode(mode).options(**options)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return seen.get["n"]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table or file of the shared folder, if it is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it isn't there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(x.getPath().getName() for x in fs.listStatus(at)) if fs.exists(at) else []


def join_counted(left: DataFrame, right: DataFrame, on: list[str], row_bytes: int = 200, most: int = BROADCAST_BYTES) -> DataFrame:
    """Left join that broadcasts `right` only if its counted rows, at row_bytes each, fit into `most` bytes."""
    return left.join(F.broadcast(right) if right.count() * row_bytes <= most else right, on, "left")


def put_json(spark: SparkSession, path: str, value: object) -> None:
    """A small JSON file; it appears under its name when it is whole, and replaces an older one of that name."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    at, begun = hadoop.Path(path), hadoop.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(begun, True)
    out.write(bytearray(json.dumps(value).encode()))
    out.close()
    fs.delete(at, False)
    if not fs.rename(begun, at):
        raise OSError(f"{path} could not be written")


def get_json(spark: SparkSession, path: str) -> object:
    """The value of a file of put_json."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark._jsc.hadoopConfiguration()).open(at)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
