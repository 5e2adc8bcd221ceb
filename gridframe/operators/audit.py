"""Completeness audits: summaries, missing values, gaps, profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridframe.operators.quantiles import exact_quantiles


def blank(c: str) -> Column:
    return F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")


def summary(df: DataFrame, group: str, date: str) -> DataFrame:
    """One row: rows, groups and the range of dates."""
    return df.agg(F.count("*").alias("n_rows"), F.countDistinct(group).alias("n_groups"), F.min(date).alias("date_min"), F.max(date).alias("date_max"))


def count_by(df: DataFrame, column: str) -> DataFrame:
    """value, n: rows per category, most first; missing is (blank)."""
    v = F.when(blank(column), "(blank)").otherwise(F.trim(F.col(column).cast("string")))
    return df.groupBy(v.alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value")


def groups_by(df: DataFrame, by: str | Column, group: str) -> DataFrame:
    """value, n_groups: distinct groups per category."""
    return df.groupBy((F.col(by) if isinstance(by, str) else by).alias("value")).agg(F.countDistinct(group).alias("n_groups"))


def missing_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, missing, total in one pass over all columns."""
    one = df.agg(F.count("*").alias("total"), *[F.sum(blank(c).cast("long")).alias(c) for c in columns])
    return one.unpivot(["total"], [F.col(c) for c in columns], "column", "missing").select("column", F.coalesce("missing", F.lit(0)).alias("missing"), "total")


def top_missing(df: DataFrame, columns: Sequence[str], limit: int = 10) -> DataFrame:
    """Columns with most missing values, with their rate in per cent."""
    rate = F.col("missing") / F.col("total") * 100
    return missing_counts(df, columns).where("missing > 0").withColumn("rate", F.round(rate, 2)).orderBy(F.desc("missing"), "column").limit(limit).select("column", "missing", "rate")


def sequence_gaps(df: DataFrame, by: Sequence[str], number: str) -> DataFrame:
    """Numbers missing between the least and greatest of each group."""
    g = df.groupBy(*by).agg(F.min(number).alias("lo"), F.max(number).alias("hi"), F.sort_array(F.collect_set(number)).alias("present"))
    gaps = F.array_except(F.sequence("lo", "hi"), "present")
    return g.withColumn("missing", gaps).where(F.size("missing") > 0).select(*by, F.array_join("present", "|").alias("present"), F.array_join("missing", "|").alias("missing"))


def missing_by_group(df: DataFrame, group: str, missing: Column, kind: Column, kinds: Sequence[str], order: str, sample: Sequence[str]) -> DataFrame:
    """Groups with missing values: total, missing, their rate, missing by kind, and columns of the group's first row."""
    first = F.min_by(F.struct(*sample), F.col(order))
    g = df.groupBy(F.col(group).alias("group_id")).agg(
        F.count("*").alias("total"), F.count_if(missing).alias("missing"), *[F.count_if(missing & (kind == k)).alias(f"missing_{k.lower()}") for k in kinds], first.alias("s")
    )
    return g.where("missing > 0").select("group_id", "total", "missing", (F.col("missing") / F.col("total")).alias("rate"), *[f"missing_{k.lower()}" for k in kinds], "s.*")


def missing_breakdown(df: DataFrame, missing: Column, dims: dict[str, Column]) -> DataFrame:
    """dim, value, missing: one count per value of each dimension, by grouping sets in one pass."""
    rows = df.where(missing).select(*[F.coalesce(c.cast("string"), F.lit("(blank)")).alias(n) for n, c in dims.items()])
    names = list(dims)
    g = rows.groupingSets([[F.col(n)] for n in names], *[F.col(n) for n in names]).agg(F.count("*").alias("missing"), F.grouping_id().alias("gid"))
    dim, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, n in enumerate(names):
        own = (1 << len(names)) - 1 - (1 << (len(names) - 1 - i))
        dim, value = F.when(F.col("gid") == own, n).otherwise(dim), F.when(F.col("gid") == own, F.col(n)).otherwise(value)
    return g.select(dim.alias("dim"), value.alias("value"), "missing")


def reason_counts(df: DataFrame, column: str, separator: str = r"\|") -> DataFrame:
    """reason, n of a column that holds several reasons in one text."""
    return df.select(F.explode(F.split(column, separator)).alias("reason")).where("reason <> ''").groupBy("reason").agg(F.count("*").alias("n"))


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Counts of row by column over a fixed domain; combinations that never occur are 0."""
    return df.groupBy(row).agg(*[F.count_if(F.col(column) == v).alias(f"n_{v}") for v in values])


def value_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """feature, n, nulls, cardinality, lo, hi of numeric columns in one pass."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in columns])).alias("x")).select("x.*")
    return long.groupBy("feature").agg(F.count("*").alias("n"), F.count_if(F.col("v").isNull()).alias("nulls"), F.countDistinct("v").alias("cardinality"), F.min("v").alias("lo"), F.max("v").alias("hi"))


def derived_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """feature with mean, population deviation and percentiles (linear interpolation)."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in columns])).alias("x")).select("x.*")
    qs = [0.01, 0.05, 0.5, 0.95, 0.99]
    g = long.groupBy("feature").agg(F.count("v").alias("n"), F.count_if(F.col("v").isNull()).alias("cold"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"))
    g = g.join(exact_quantiles(long, "v", qs, ["feature"]).withColumnRenamed("quantiles", "q"), "feature", "left")
    return g.select("feature", "n", "cold", "mean", "std", *[F.get("q", i).alias(f"p{int(q * 100):02d}") for i, q in enumerate(qs)])


def rate_profile(df: DataFrame, by: str, flags: dict[str, Column]) -> DataFrame:
    """Rows and the rate of each flag per value of a column."""
    return df.groupBy(by).agg(F.count("*").alias("n"), *[F.avg(c.cast("double")).alias(n) for n, c in flags.items()])


def discontinuities(rates: DataFrame, order: str, rate: str, jump: float) -> DataFrame:
    """rates with the change from the row before and whether it exceeds `jump`. A row a period, so one window is small."""
    w = Window.partitionBy(F.lit(0)).orderBy(order)
    return rates.withColumn("delta", F.col(rate) - F.lag(rate).over(w)).withColumn("jump", F.coalesce(F.abs("delta") > jump, F.lit(False)))


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """rule, rejected: rows that each illegal-source rule would catch."""
    one = df.agg(*[F.count_if(c).alias(n) for n, c in rules.items()])
    return one.unpivot([], [F.col(n) for n in rules], "rule", "rejected")
