"""Prefix scans over ordered rows in which no task holds all rows of a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridframe.sources.shared import join_counted, stored


def carry_forward(rows: DataFrame, keys: list[str], order: list[str], value: str, into: str) -> DataFrame:
    """rows with `into`: the last non-null `value` at or before each row among rows of the same keys; null if a key is null.

    Rows are dealt by ranges of (keys, order), rows that tie by their hash, so a key's rows lie in as many ranges as they need.
    Each range is scanned on its own; its last value of every key goes on to the ranges behind it through a table of range
    ends, which has a row a range and key. Rows that tie in `order` should agree on the value.
    """
    plain = [c for c, kind in rows.dtypes if not kind.startswith("map")]
    rows = rows.withColumn("_tie", F.xxhash64(*plain))
    dealt = stored(rows.repartitionByRange(*keys, *order, "_tie").withColumn("_range", F.spark_partition_id()), "ranges")
    place = F.struct(*order, "_tie")
    last = dealt.groupBy("_range", *keys).agg(F.max_by(value, F.when(F.col(value).isNotNull(), place)).alias("_last"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ends = stored(last.select("_range", *keys, F.last("_last", ignorenulls=True).over(before).alias("_before")).where("_before is not null"), "ends")
    own = F.last(value, ignorenulls=True).over(Window.partitionBy("_range", *keys).orderBy(*order, "_tie").rowsBetween(Window.unboundedPreceding, 0))
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    out = join_counted(dealt.withColumn("_own", own), ends, ["_range", *keys])
    return out.withColumn(into, F.when(known, F.coalesce("_own", "_before"))).drop("_tie", "_range", "_own", "_before")
