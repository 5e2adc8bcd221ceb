"""As-of features in runs: new days are worked on from a stored state instead of the whole history.

Everything a row gets depends on its entity's earlier days only, so it is a matter of (entity, day). A day of an entity is
summed up as one row (number, mean, squared deviations, weights at the day, last rows), rows of consecutive spans merge into one
of the same form, and the state before a run is just such a row per entity. A run unions the state with the sums of its days,
takes prefixes over an entity's days (a row a day, whatever the number of its rows) and joins them to the rows; the merged rows
are the next state. All history in one run, a run a day, and any days in between give the same features.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridframe.sources.shared import exists, listed, remove

LAST = 5


class Roles(NamedTuple):
    """Columns: row key, entity, day (a whole number), order within a day, value, flag (0 or 1), context."""

    key: str
    entity: str
    day: str
    order: list[str]
    value: str
    flag: str
    context: str
    half_life: float = 90.0


def _decay(days: Column, half_life: float) -> Column:
    return F.exp(F.lit(-math.log(2) / half_life) * days)


def day_sums(rows: DataFrame, r: Roles) -> DataFrame:
    """entity, day, n, nv (values), mean, m2, weight, hits (weights at the day), last (the day's last rows, in order)."""
    sums = rows.groupBy(F.col(r.entity).alias("entity"), F.col(r.day).cast("long").alias("day")).agg(
        F.count("*").alias("n"),
        F.count(r.value).alias("nv"),
        F.coalesce(F.avg(r.value), F.lit(0.0)).alias("mean"),
        F.coalesce(F.var_pop(r.value) * F.count(r.value), F.lit(0.0)).alias("m2"),
        F.count("*").cast("double").alias("weight"),
        F.coalesce(F.sum(F.col(r.flag).cast("double")), F.lit(0.0)).alias("hits"),
    )
    newest = Window.partitionBy("entity", "day").orderBy(*[F.desc(c) for c in r.order])
    some = rows.select(F.col(r.entity).alias("entity"), F.col(r.day).cast("long").alias("day"), *r.order, F.col(r.value).cast("double").alias("value"), F.col(r.flag).cast("double").alias("flag"))
    some = some.withColumn("_k", F.row_number().over(newest)).where(F.col("_k") <= LAST)
    last = some.groupBy("entity", "day").agg(F.sort_array(F.collect_list(F.struct((-F.col("_k")).alias("k"), "value", "flag"))).alias("last"))
    last = last.withColumn("last", F.transform("last", lambda x: F.struct(x["value"].alias("value"), x["flag"].alias("flag"))))
    last = last.withColumnsRenamed({"entity": "_e", "day": "_d"})
    return sums.join(last, F.col("entity").eqNullSafe(F.col("_e")) & (F.col("day") == F.col("_d"))).drop("_e", "_d")


def context_sums(rows: DataFrame, r: Roles) -> DataFrame:
    """entity, context, day, n."""
    return rows.groupBy(F.col(r.entity).alias("entity"), F.col(r.context).alias("context"), F.col(r.day).cast("long").alias("day")).agg(F.count("*").alias("n"))


def _tail(x: Column) -> Column:
    return F.when(F.size(x) <= LAST, x).otherwise(F.slice(x, F.greatest(F.size(x) - LAST + 1, F.lit(1)), LAST))


def _sums(days: DataFrame, over, half_life: float) -> dict[str, Column]:
    """Merged n, nv, mean, m2 and weights (at `_zero`) of rows with `_zero` (a day) and `_mid` (a mean near theirs)."""
    at = 1 / _decay(F.col("day") - F.col("_zero"), half_life)
    off = F.col("mean") - F.col("_mid")
    total = lambda c: F.coalesce(over(F.sum(c)), F.lit(0))
    return {"_n": total("n"), "_nv": total("nv"), "_s1": total(F.col("nv") * off), "_s2": total(F.col("m2") + F.col("nv") * off * off), "_w": total(F.col("weight") * at), "_h": total(F.col("hits") * at)}


def _mean() -> Column:
    return F.col("_mid") + F.col("_s1") / F.nullif(F.col("_nv"), F.lit(0))


def _m2() -> Column:
    return F.greatest(F.col("_s2") - F.col("_s1") * F.col("_s1") / F.nullif(F.col("_nv"), F.lit(0)), F.lit(0.0))


def next_state(days: DataFrame, half_life: float) -> DataFrame:
    """The rows of each entity merged into one, as of its last day. days: day_sums of some days and the state before them."""
    whole = days.groupBy("entity").agg(F.min("day").alias("_zero"), F.max("day").alias("_last"), F.min_by("mean", F.when(F.col("nv") > 0, F.col("day"))).alias("_mid"))
    whole = whole.select(F.col("entity").alias("_e"), "_zero", "_last", F.coalesce("_mid", F.lit(0.0)).alias("_mid"))
    rows = days.join(whole, F.col("entity").eqNullSafe(F.col("_e"))).drop("_e")
    sums = _sums(rows, lambda c: c, half_life)
    merged = rows.groupBy("entity").agg(F.max("_last").alias("day"), F.max("_zero").alias("_zero"), F.max("_mid").alias("_mid"), *[c.alias(n) for n, c in sums.items()], F.sort_array(F.collect_list(F.struct("day", "last"))).alias("_lists"))
    fade = _decay(F.col("day") - F.col("_zero"), half_life)
    last = _tail(F.flatten(F.transform("_lists", lambda x: x["last"])))
    return merged.select("entity", "day", F.col("_n").alias("n"), F.col("_nv").alias("nv"), F.coalesce(_mean(), F.lit(0.0)).alias("mean"), F.coalesce(_m2(), F.lit(0.0)).alias("m2"), (F.col("_w") * fade).alias("weight"), (F.col("_h") * fade).alias("hits"), last.alias("last"))


def prefixes(days: DataFrame, half_life: float) -> DataFrame:
    """Features of every (entity, day): what all earlier rows of `days` say."""
    own = Window.partitionBy("entity")
    p = own.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    rows = days.withColumns({"_zero": F.min("day").over(own), "_mid": F.coalesce(F.first(F.when(F.col("nv") > 0, F.col("mean")), ignorenulls=True).over(own.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), F.lit(0.0))})
    rows = rows.withColumns(_sums(rows, lambda c: c.over(p), half_life))
    # Each earlier day has a row at least, so the last five rows lie in the last five of them.
    rows = rows.withColumns({"_recent": _tail(F.flatten(F.collect_list("last").over(own.orderBy("day").rowsBetween(-LAST, -1)))), "_seen": F.max("day").over(p)})
    values = F.filter(F.transform("_recent", lambda x: x["value"]), lambda v: v.isNotNull())
    mean = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v) / F.nullif(F.size(a), F.lit(0))
    n = F.nullif(F.col("_n"), F.lit(0))
    return rows.select(
        "entity",
        "day",
        n.alias("prior_count"),
        F.nullif(F.size("_recent"), F.lit(0)).cast("long").alias("recent_n"),
        mean(values).alias("recent_mean"),
        mean(F.transform("_recent", lambda x: x["flag"])).alias("recent_rate"),
        _mean().alias("prior_mean"),
        F.sqrt(_m2() / F.nullif(F.col("_nv"), F.lit(0))).alias("prior_std"),
        (F.col("_h") / F.nullif(F.col("_w"), F.lit(0.0))).alias("weighted_rate"),
        (F.col("day") - F.col("_seen")).alias("days_since"),
        (F.col("_n") == 0).alias("cold_start"),
        F.col("_seen").alias("source_day"),
        F.col("_n").alias("source_rows"),
    )


def features(rows: DataFrame, days: DataFrame, contexts: DataFrame, r: Roles) -> DataFrame:
    """rows with all features; days and contexts hold the sums of the rows' days and the state before them."""
    own = contexts.withColumn("_own", F.coalesce(F.sum("n").over(Window.partitionBy("entity", "context").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    j = rows.withColumns({"_e": F.col(r.entity), "_d": F.col(r.day).cast("long"), "_c": F.col(r.context)})
    table = prefixes(days, r.half_life)
    names = [c for c in table.columns if c not in ("entity", "day")]
    j = j.join(table.withColumnsRenamed({"entity": "_e2", "day": "_d2"}), F.col("_e").eqNullSafe(F.col("_e2")) & (F.col("_d") == F.col("_d2")))
    j = j.join(own.select(F.col("entity").alias("_e3"), F.col("context").alias("_c3"), F.col("day").alias("_d3"), "_own"), F.col("_e").eqNullSafe(F.col("_e3")) & F.col("_c").eqNullSafe(F.col("_c3")) & (F.col("_d") == F.col("_d3")))
    return j.select(*rows.columns, *names, F.when(F.col("source_rows") > 0, F.col("_own")).alias("context_count"))


class DailyFeatures:
    """Features of a growing table of chunks, in any order of arrival.

    add() stores a chunk under its name, a name that comes again replaces it. run() finds the first day whose rows differ from
    what was worked on, drops state and features from there on, and goes on from the last state before it, `span` days a run.
    Rows with one key count once. A run that broke off is repeated by the next: the ledger of its days is written last. `root`
    is a folder that driver and executors share. Rows without a day are left out.
    """

    def __init__(self, spark: SparkSession, root: str, roles: Roles, span: int = 1) -> None:
        self.spark, self.root, self.roles, self.span = spark, root, roles, span

    def add(self, chunk: str, rows: DataFrame) -> None:
        rows.where(F.col(self.roles.day).isNotNull()).withColumn("on_day", F.col(self.roles.day).cast("long")).write.mode("overwrite").partitionBy("on_day").parquet(f"{self.root}/raw/chunk_id={chunk}")

    def _raw(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/raw")

    def _digests(self) -> dict[int, str]:
        """Of each day the number of rows and a digest that ignores their order and chunks; a row a day comes to the driver."""
        raw = self._raw()
        raw = raw.dropDuplicates([self.roles.key]).select("on_day", F.xxhash64(*[c for c in raw.columns if c != "chunk_id"]).alias("h"))
        sums = raw.groupBy("on_day").agg(F.count("*").alias("n"), F.bit_xor("h").alias("x"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s"))
        return {d.on_day: f"{d.n}:{d.x}:{d.s}" for d in sums.collect()}

    def _ledger(self) -> dict[int, str]:
        path = f"{self.root}/ledger"
        names = [n for n in listed(self.spark, path) if n.startswith("day=") and exists(self.spark, f"{path}/{n}/_SUCCESS")]
        if not names:
            return {}
        return {d.on_day: d.digest for d in self.spark.read.parquet(*[f"{path}/{n}" for n in names]).collect()}

    def run(self) -> list[int]:
        """Work on what is new or changed: the last days of the runs that were needed."""
        now, was = self._digests(), self._ledger()
        changed = [d for d in {*now, *was} if now.get(d) != was.get(d)]
        if not changed:
            return []
        first = min(changed)
        for name in ("ledger", "state", "contexts", "features"):
            for old in listed(self.spark, f"{self.root}/{name}"):
                # Runs are named by their last day: one that ends on the first changed day or later may hold such days.
                if old.startswith("day=") and int(old[4:]) >= first:
                    remove(self.spark, f"{self.root}/{name}/{old}")
        states = [int(n[4:]) for n in listed(self.spark, f"{self.root}/ledger") if n.startswith("day=")]
        before = max(states, default=None)
        todo = sorted(d for d in now if before is None or d > before)
        done = []
        for at in range(0, len(todo), self.span):
            part = todo[at : at + self.span]
            self._one(part, before, {d: now[d] for d in part})
            before = part[-1]
            done.append(before)
        return done

    def _one(self, part: list[int], before: int | None, digests: dict[int, str]) -> None:
        r = self.roles
        rows = self._raw().where(F.col("on_day").between(part[0], part[-1])).dropDuplicates([r.key]).drop("chunk_id", "on_day")
        days, contexts = day_sums(rows, r), context_sums(rows, r)
        if before is not None:
            days = days.unionByName(self.spark.read.parquet(f"{self.root}/state/day={before}"))
            contexts = contexts.unionByName(self.spark.read.parquet(f"{self.root}/contexts/day={before}"))
        # Three results read the sums, so they are written once.
        work = {n: f"{self.root}/work/{n}" for n in ("days", "contexts")}
        for name, df in (("days", days), ("contexts", contexts)):
            df.write.mode("overwrite").parquet(work[name])
        days, contexts = (self.spark.read.schema(df.schema).parquet(work[n]) for n, df in (("days", days), ("contexts", contexts)))
        features(rows, days, contexts, r).write.mode("overwrite").parquet(f"{self.root}/features/day={part[-1]}")
        next_state(days, r.half_life).write.mode("overwrite").parquet(f"{self.root}/state/day={part[-1]}")
        contexts.groupBy("entity", "context").agg(F.max("day").alias("day"), F.sum("n").alias("n")).write.mode("overwrite").parquet(f"{self.root}/contexts/day={part[-1]}")
        self.spark.createDataFrame(sorted(digests.items()), "on_day long, digest string").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/ledger/day={part[-1]}")

    def table(self) -> DataFrame:
        """All rows with their features."""
        names = [n for n in listed(self.spark, f"{self.root}/features") if n.startswith("day=")]
        return self.spark.read.parquet(*[f"{self.root}/features/{n}" for n in names])
