"""The 120 ordered top-three outcomes of six lanes: class ids by closed form, decoding, marginals."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

N_CLASSES = 120
ORDERS = list(permutations(range(1, 7), 3))


def _above(a: Column, b: Column) -> Column:
    return F.when(a > b, 1).otherwise(0)


def class_id(first: str | Column, second: str | Column, third: str | Column) -> Column:
    """0..119, or null unless the lanes are three different ones of 1..6."""
    f, s, t = (F.col(x) if isinstance(x, str) else x for x in (first, second, third))
    good = f.between(1, 6) & s.between(1, 6) & t.between(1, 6) & (f != s) & (s != t) & (f != t)
    return F.when(good, (f - 1) * 20 + (s - 1 - _above(s, f)) * 4 + (t - 1 - _above(t, f) - _above(t, s)))


def class_table(spark: SparkSession) -> DataFrame:
    """class_id, first, second, third, label of all 120 classes."""
    rows = spark.range(N_CLASSES).select(F.col("id").cast("int").alias("class_id"))
    lanes = F.array(*[F.lit(x) for x in range(1, 7)])
    f = (F.floor(F.col("class_id") / 20) + 1).cast("int")
    rows = rows.withColumn("first", f).withColumn("rest", F.array_remove(lanes, F.col("first")))
    rows = rows.withColumn("second", F.element_at("rest", (F.floor(F.col("class_id") % 20 / 4) + 1).cast("int")))
    rows = rows.withColumn("rest", F.array_remove("rest", F.col("second"))).withColumn("third", F.element_at("rest", (F.col("class_id") % 4 + 1).cast("int")))
    return rows.select("class_id", "first", "second", "third", F.concat_ws("-", "first", "second", "third").alias("label"))


def decode(df: DataFrame, column: str = "class_id") -> DataFrame:
    """df with first, second, third and label of its class; null outside 0..119. The class table has 120 rows."""
    return df.join(F.broadcast(class_table(df.sparkSession).withColumnRenamed("class_id", column)), column, "left")


def same_first() -> list[list[int]]:
    """For each class the classes with its first lane."""
    return [[j for j, o in enumerate(ORDERS) if o[0] == own[0]] for own in ORDERS]
