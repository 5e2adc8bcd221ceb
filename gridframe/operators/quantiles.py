"""Exact quantiles of any number of rows, without gathering a group's values in one place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridframe.sources.shared import stored


def ordered_places(rows: DataFrame, order: Sequence, count: str) -> DataFrame:
    """rows with `start`: the sum of `count` over all rows before in the given order; ranges are sorted apart, then get offsets."""
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    dealt = stored(dealt, "ranges").withColumn("_part", F.shiftright("_id", 33))
    sizes = dealt.groupBy("_part").agg(F.sum(count).alias("_size"))  # a row a partition
    before = F.coalesce(F.sum("_size").over(Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.sum(count).over(Window.partitionBy("_part").orderBy("_id").rowsBetween(Window.unboundedPreceding, 0)) - F.col(count)
    out = dealt.withColumn("_inside", inside).join(F.broadcast(sizes.withColumn("_before", before)), "_part")
    return out.withColumn("start", F.col("_inside") + F.col("_before")).drop("_id", "_part", "_size", "_inside", "_before")


def exact_quantiles(df: DataFrame, column: str, qs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """by and `quantiles`, an array in the order of qs: linear interpolation between neighbouring values, nulls left out.

    Values are counted, ranges of (by, value) are sorted apart and each group's ranks are looked up; `by` has few groups.
    """
    by = list(by)
    counts = df.where(F.col(column).isNotNull()).groupBy(*by, F.col(column).cast("double").alias("_v")).agg(F.count("*").alias("_c"))
    placed = stored(ordered_places(counts, [*by, "_v"], "_c"), "places")
    groups = placed.groupBy(*by).agg(F.min("start").alias("_first"), F.sum("_c").alias("_n"))
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(q)).alias("q")) for i, q in enumerate(qs)])
    ranks = groups.withColumn("w", F.explode(wanted)).withColumn("_h", (F.col("_n") - 1) * F.col("w.q"))
    ranks = ranks.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("w.i").alias("_i"), "_h", (F.col("_first") + F.floor("_h")).alias("_lo"), (F.col("_first") + F.ceil("_h")).alias("_hi"))
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    at = lambda r: (F.col("start") <= F.col(r)) & (F.col(r) < F.col("start") + F.col("_c"))
    met = placed.join(F.broadcast(ranks), same & (at("_lo") | at("_hi")))  # a few ranks a group
    value = lambda r: F.max(F.when(at(r), F.col("_v")))
    one = met.groupBy(*by, "_i", "_h").agg(value("_lo").alias("_a"), value("_hi").alias("_b"))
    one = one.withColumn("_q", F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(F.col("_a") + (F.col("_h") - F.floor("_h")) * (F.col("_b") - F.col("_a"))))
    return one.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_q"))), lambda x: x["_q"]).alias("quantiles"))
