"""As-of features: only rows of strictly earlier days of the same entity count; without any, the value stays null."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridframe.operators.scan import carry_forward


def prior(entity: list[str], day: str):
    """All rows of strictly earlier days."""
    return Window.partitionBy(*entity).orderBy(day).rangeBetween(Window.unboundedPreceding, -1)


def add_counts(df: DataFrame, entity: str, day: str) -> DataFrame:
    """prior_count: rows of earlier days, null at a cold start."""
    return df.withColumn("prior_count", F.nullif(F.count("*").over(prior([entity], day)), F.lit(0)))


def add_recent(df: DataFrame, entity: str, day: str, order: list[str], outcome: str, flag: str, n: int = 5) -> DataFrame:
    """Number, mean outcome and flag rate of the last n rows of earlier days."""
    w = Window.partitionBy(entity).orderBy(day, *order).rowsBetween(-n, -1)
    named = {"_n": F.count("*").over(w), "_m": F.avg(outcome).over(w), "_f": F.avg(F.col(flag).cast("double")).over(w)}
    day_start = Window.partitionBy(entity, day).orderBy(*order)
    out = df.withColumns(named)
    out = out.withColumns({"recent_n": F.nullif(F.first("_n").over(day_start), F.lit(0)), "recent_mean": F.first("_m").over(day_start), "recent_rate": F.first("_f").over(day_start)})
    return out.drop(*named)


def add_mean_std(df: DataFrame, entity: str, day: str, value: str) -> DataFrame:
    """Mean and population deviation over earlier days."""
    p = prior([entity], day)
    return df.withColumns({"prior_mean": F.avg(value).over(p), "prior_std": F.stddev_pop(value).over(p)})


def add_context_count(df: DataFrame, entity: str, day: str, context: str) -> DataFrame:
    """Rows of earlier days in the same context: 0 if there are others only, null at a cold start."""
    total = F.count("*").over(prior([entity], day))
    own = F.count("*").over(prior([entity, context], day))
    return df.withColumn("context_count", F.when(total > 0, own))


def add_weighted_rate(df: DataFrame, entity: str, day: str, flag: str, half_life: float = 90.0) -> DataFrame:
    """Rate of a flag over earlier days with exponential weights; the target day cancels in the ratio.

    Weights count from the entity's first day, so no calendar makes them overflow.
    """
    w = F.exp(F.lit(math.log(2) / half_life) * (F.col(day) - F.col("_first")))
    df = df.withColumn("_first", F.min(day).over(Window.partitionBy(entity)))
    p = prior([entity], day)
    return df.withColumn("weighted_rate", F.sum(w * F.col(flag)).over(p) / F.sum(w).over(p)).drop("_first")


def add_recency(df: DataFrame, entity: str, day: str) -> DataFrame:
    """Days since the last earlier day."""
    return df.withColumn("days_since", F.col(day) - F.max(day).over(prior([entity], day)))


def add_lineage(df: DataFrame, entity: str, day: str) -> DataFrame:
    """Cold-start flag, latest source day and number of source rows."""
    p = prior([entity], day)
    return df.withColumns({"cold_start": F.count("*").over(p) == 0, "source_day": F.max(day).over(p), "source_rows": F.count("*").over(p)})


def latest_interval(df: DataFrame, intervals: DataFrame, on: list[str], day: str, start: str, end: str) -> DataFrame:
    """df with `_g`: start, end and interval_id of the interval that began last strictly before the day; null where none did.

    Both sides are unioned and the latest start is carried forward over ranges of rows, so there is no range join and no task
    holds a key. Rows whose key has a null are in no interval; intervals of one key must not overlap.
    """
    kind = intervals.select(F.struct(start, end, "interval_id")).schema[0].dataType
    left = df.withColumns({"_at": F.col(day), "_kind": F.lit(0), "_i": F.lit(None).cast(kind)})
    right = intervals.dropna(subset=on).select(*on, F.col(start).alias("_at"), F.lit(1).alias("_kind"), F.struct(start, end, "interval_id").alias("_i"))
    # Rows of a day sort before intervals that start on it: the start must be strictly earlier.
    both = carry_forward(left.unionByName(right, allowMissingColumns=True), on, ["_at", "_kind"], "_i", "_g")
    return both.where("_kind = 0").drop("_at", "_kind", "_i")


def interval_join(df: DataFrame, intervals: DataFrame, on: list[str], day: str, start: str, end: str) -> DataFrame:
    """df with the interval whose start is strictly before the day and whose end is not before it; null where there is none."""
    both = latest_interval(df, intervals, on, day, start, end)
    valid = F.col(f"_g.{end}").isNull() | (F.col(f"_g.{end}") >= F.col(day))
    return both.withColumn("interval_id", F.when(valid, F.col("_g.interval_id"))).drop("_g")


def verified_interval(df: DataFrame, intervals: DataFrame, on: list[str], day: str, start: str, end: str, grade: str, accepted: list[str]) -> DataFrame:
    """interval_join over intervals of accepted evidence only, with `verified` and the reason where there is none."""
    both = latest_interval(df, intervals.where(F.col(grade).isin(*accepted)), on, day, start, end)
    valid = F.col("_g").isNotNull() & (F.col(f"_g.{end}").isNull() | (F.col(f"_g.{end}") >= F.col(day)))
    both = both.withColumns({"interval_id": F.when(valid, F.col("_g.interval_id")), "_none": F.col("_g").isNull()})
    reason = F.when(F.col("interval_id").isNotNull(), "verified").when(F.col("_none"), "no_earlier_interval").otherwise("interval_ended")
    return both.withColumns({"verified": F.col("interval_id").isNotNull(), "reason": reason}).drop("_g", "_none")


def fold_members(df: DataFrame, roles: DataFrame, date: str) -> DataFrame:
    """Every (row, fold, role) whose date lies between the role's bounds; roles is a table of a few rows a fold."""
    return df.join(F.broadcast(roles), F.col(date).between(F.col("start"), F.col("stop")))


def same_day_previous(df: DataFrame, keys: list[str], order: list[str], key: str) -> DataFrame:
    """The row before on the same day: its key and distance in order, with a class of confidence."""
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumns({"previous": F.lag(key).over(w), "gap": F.col(order[0]) - F.lag(order[0]).over(w)})
    kind = F.when(F.col("previous").isNull(), "none").when(F.col("gap") == 0, "same place").when(F.col("gap") == 1, "direct").otherwise("earlier")
    return out.withColumn("confidence", kind)


def episodes(df: DataFrame, entity: str, ts: str, order: list[str], gap_seconds: int) -> DataFrame:
    """Episode number of each row: a new one starts after a gap."""
    w = Window.partitionBy(entity).orderBy(ts, *order)
    # Microseconds as an integer: a sum of rounded seconds would move rows across the gap.
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    wait = micros - F.lag(micros).over(w)
    start = F.when(wait.isNull() | (wait > gap_seconds * 1_000_000), 1).otherwise(0)
    return df.withColumn("start", start).withColumn("episode", F.sum("start").over(w.rowsBetween(Window.unboundedPreceding, 0)))
