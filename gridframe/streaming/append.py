"""Streams of batches: each micro-batch is checked, appended as its own partition once, and written to a ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridframe.operators.append import append_batch


def stream_files(spark: SparkSession, path: str, schema: str, per_trigger: int = 1) -> DataFrame:
    """Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def append_stream(stream: DataFrame, table: str, ledger: str, checkpoint: str, key: str, good: str) -> StreamingQuery:
    """Append rows of groups whose rows all satisfy `good`; groups that other batches hold and bad groups are left out.

    The partition is named by the batch number and overwritten on replay, so a batch that runs twice gives the same table.
    """

    def one(batch: DataFrame, number: int) -> None:
        bad = batch.where(f"not coalesce({good}, false)").select(key).distinct()
        accepted = batch.join(bad, key, "left_anti")
        rows = append_batch(accepted, table, f"{number:08d}", key)
        entry = batch.agg(F.lit(number).alias("batch"), F.count("*").alias("received"), F.lit(rows).alias("appended"))
        entry.write.mode("overwrite").parquet(f"{ledger}/batch={number:08d}")

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def dedup_stream(stream: DataFrame, key: list[str], ts: str, late: str = "1 day") -> DataFrame:
    """The first row of each key within the watermark."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(key)
