"""Probability scores, baselines, calibration, splits, encodings and residual diagnostics.

Probability vectors are arrays; metrics are computed with higher-order functions row by row and then averaged, so nothing
is exploded. A probability of zero for the actual class gives an infinite loss.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridframe.operators.checks import FAULTS, prob_issues
from gridframe.operators.quantiles import exact_quantiles, ordered_places


def loss(p: Column) -> Column:
    """-ln p, infinite at zero and below."""
    return F.when(p <= 0, float("inf")).otherwise(-F.ln(p))


def total(a: str | Column, f=lambda x: x) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + f(x))


def rank_of_actual(p: str, actual: str) -> Column:
    """1 + classes with more probability, or as much and a smaller id."""
    own = F.get(p, F.col(actual).cast("int"))
    better = F.filter(p, lambda x, i: (x > own) | ((x == own) & (i < F.col(actual))))
    return F.size(better) + 1


def class_losses(pred: DataFrame, p: str, actual: str) -> DataFrame:
    """pred with p_actual, log_loss, brier and rank."""
    own = F.get(p, F.col(actual).cast("int"))
    out = pred.withColumn("p_actual", own)
    return out.withColumns({"log_loss": loss(F.col("p_actual")), "brier": total(p, lambda x: x * x) - 2 * F.col("p_actual") + 1, "rank": rank_of_actual(p, actual)})


def metrics(losses: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean losses, hit rates, ranks and tails per group."""
    tails = exact_quantiles(losses, "log_loss", [0.9, 0.95, 0.99], by).withColumnRenamed("quantiles", "_tails")
    middle = exact_quantiles(losses, "rank", [0.5], by).withColumnRenamed("quantiles", "_middle")
    means = losses.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.avg("log_loss").alias("log_loss"),
        F.avg("brier").alias("brier"),
        *[F.avg((F.col("rank") <= k).cast("double")).alias(f"hit_{k}") for k in (1, 3, 5, 10, 20)],
        F.avg("rank").alias("mean_rank"),
        F.avg(1 / F.col("rank")).alias("mrr"),
        F.max("log_loss").alias("loss_max"),
        *[F.avg((F.col("p_actual") < t).cast("double")).alias(f"below_1e{e}") for e, t in ((3, 1e-3), (4, 1e-4), (6, 1e-6))],
    )
    for part in (tails, middle):  # one row a group
        means = means.join(part, list(by)) if by else means.join(part)
    return means.withColumns({"median_rank": F.get("_middle", 0), **{f"loss_p{p}": F.get("_tails", i) for i, p in enumerate((90, 95, 99))}}).drop("_tails", "_middle")


def order_losses(pred: DataFrame, p: str, actual: str, orders: DataFrame) -> DataFrame:
    """The seven losses of an ordered top-three forecast.

    `orders` has a row a class (120): class_id, first, second, third; it is joined to the actual class, and marginals are
    sums of the vector over the classes that agree with it.
    """
    firsts = orders.agg(F.transform(F.array_sort(F.collect_list(F.struct("class_id", "first", "second", "third"))), lambda x: F.struct(x["first"], x["second"], x["third"])).alias("o"))
    j = pred.join(F.broadcast(orders.withColumnRenamed("class_id", actual)), actual)
    j = j.crossJoin(F.broadcast(firsts))  # one row
    z = F.zip_with(p, "o", lambda x, o: F.struct(x.alias("p"), o.alias("o")))

    def mass(cond) -> Column:
        return F.aggregate("z", F.lit(0.0), lambda s, x: s + F.when(cond(x["o"]), x["p"]).otherwise(0.0))

    j = j.withColumn("z", z)
    same1 = lambda o: o["first"] == F.col("first")
    same2 = lambda o: same1(o) & (o["second"] == F.col("second"))
    lanes = F.array_sort(F.array("first", "second", "third"))
    same_set = lambda o: F.array_sort(F.array(o["first"], o["second"], o["third"])) == lanes
    j = j.withColumns({"p1": mass(same1), "p2": mass(same2), "ps": mass(same_set), "pa": F.get(p, F.col(actual).cast("int"))})
    part = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    return j.withColumns(
        {
            "order_loss": loss(F.col("pa")),
            "winner_loss": loss(F.col("p1")),
            "exacta_loss": loss(F.col("p2")),
            "set_loss": loss(F.col("ps")),
            "second_loss": loss(part(F.col("p2"), F.col("p1"))),
            "third_loss": loss(part(F.col("pa"), F.col("p2"))),
            "brier": total(p, lambda x: x * x) - 2 * F.col("pa") + 1,
        }
    ).drop("z", "o")


LOSSES = ["order_loss", "winner_loss", "exacta_loss", "set_loss", "second_loss", "third_loss", "brier"]


def _rows(weight: str | None) -> Column:
    """Number of rows, or their summed weight where rows are counts already."""
    return F.count("*") if weight is None else F.sum(weight)


def frequency(df: DataFrame, column: str, domain: DataFrame, tau: float, weight: str | None = None) -> DataFrame:
    """Smoothed frequency of each domain value: (count + tau/K) / (N + tau)."""
    counts = df.groupBy(column).agg(_rows(weight).alias("c"))
    full = domain.select(column).join(counts, column, "left").withColumn("c", F.coalesce("c", F.lit(0)))
    w = Window.partitionBy(F.lit(0))  # one row a domain value
    return full.withColumn("p", (F.col("c") + tau / F.count("*").over(w)) / (F.sum("c").over(w) + tau)).select(column, F.col("c").alias("n"), "p")


def hierarchical(df: DataFrame, column: str, levels: list[list[str]], domain: DataFrame, tau: float, least: int, weight: str | None = None) -> DataFrame:
    """Backoff frequencies: the finest level with at least `least` rows, smoothed to its parent; levels go from coarse to fine."""
    out = frequency(df, column, domain, tau, weight).select(column, "p")
    known: list[str] = []
    for level in levels:
        counts = df.groupBy(*level, column).agg(_rows(weight).alias("c"))
        sizes = df.groupBy(*level).agg(_rows(weight).alias("size"))
        grid = sizes.join(out, known, "inner") if known else sizes.join(F.broadcast(out))
        grid = grid.join(counts, [*level, column], "left").withColumn("c", F.coalesce("c", F.lit(0)))
        own = (F.col("c") + tau * F.col("p")) / (F.col("size") + tau)
        out = grid.withColumn("p", F.when(F.col("size") >= least, own).otherwise(F.col("p"))).select(*level, column, "p")
        known = level
    return out


def stagewise(first: DataFrame, second: DataFrame, third: DataFrame) -> DataFrame:
    """P(first) P(second | first) P(third | first, second)."""
    return first.join(second, "first").join(third, ["first", "second"]).withColumn("p", F.col("p1") * F.col("p2") * F.col("p3"))


def grid_select(losses: DataFrame, params: list[str], loss_column: str, ordinal: str) -> DataFrame:
    """The parameters with the least mean loss; the first in grid order wins ties."""
    g = losses.groupBy(*params, ordinal).agg(F.avg(loss_column).alias("loss"))
    return g.orderBy("loss", ordinal).limit(1)


def grid_refit(train: DataFrame, selection: DataFrame, level: str, column: str, domain: DataFrame, taus: Sequence[float], leasts: Sequence[int], n: str) -> tuple[DataFrame, DataFrame]:
    """The grid of (tau, least) with its loss on the selection counts, best first, and the frequencies refitted on both with the best.

    All tables hold counts `n` of (level, column); the first in grid order wins ties.
    """
    grid = domain.sparkSession.createDataFrame([(i, float(t), int(m)) for i, (t, m) in enumerate((t, m) for t in taus for m in leasts)], "ordinal int, tau double, least int")

    def probs(counts: DataFrame, params: DataFrame) -> DataFrame:
        k = domain.count()
        own = counts.groupBy(level, column).agg(F.sum(n).alias("c"))
        whole = domain.select(column).join(counts.groupBy(column).agg(F.sum(n).alias("w")), column, "left").withColumn("w", F.coalesce("w", F.lit(0)))
        total = counts.agg(F.sum(n).alias("all"))
        sizes = counts.groupBy(level).agg(F.sum(n).alias("size"))
        rows = whole.crossJoin(F.broadcast(total)).crossJoin(F.broadcast(params)).crossJoin(F.broadcast(sizes)).join(own, [level, column], "left")
        base = (F.col("w") + F.col("tau") / k) / (F.col("all") + F.col("tau"))
        p = F.when(F.col("size") >= F.col("least"), (F.coalesce("c", F.lit(0)) + F.col("tau") * base) / (F.col("size") + F.col("tau"))).otherwise(base)
        return rows.select("ordinal", "tau", "least", level, column, p.alias("p"))

    met = selection.groupBy(level, column).agg(F.sum(n).alias("s")).join(probs(train, grid), [level, column])
    losses = met.groupBy("ordinal", "tau", "least").agg((F.sum(F.col("s") * loss(F.col("p"))) / F.sum("s")).alias("loss")).orderBy("loss", "ordinal")
    both = train.select(level, column, n).unionByName(selection.select(level, column, n))
    return losses, probs(both, losses.limit(1).select("ordinal", "tau", "least"))


def tempered(p: str | Column, t: Column) -> Column:
    """p^(1/T), normalised."""
    raised = F.transform(p, lambda x: F.pow(x, 1 / t))
    return F.transform(raised, lambda x: x / total(raised))


def temperature(pred: DataFrame, p: str, actual: str, grid: Sequence[float]) -> DataFrame:
    """Mean loss of each temperature, least first."""
    g = pred.select(p, actual, F.explode(F.array(*[F.lit(float(t)) for t in grid])).alias("t"))
    own = F.pow(F.get(p, F.col(actual).cast("int")), 1 / F.col("t")) / total(p, lambda x: F.pow(x, 1 / F.col("t")))
    return g.withColumn("l", loss(own)).groupBy("t").agg(F.avg("l").alias("loss")).orderBy("loss", "t")


def calibrate(fit: DataFrame, pred: DataFrame, p: str, actual: str, grid: Sequence[float]) -> tuple[float, DataFrame]:
    """The temperature that fits `fit` best, and `pred` with raw_loss, calibrated_loss and the calibrated probabilities.

    Only rows of `fit` choose; in a tie the lowest temperature does.
    """
    best = float(temperature(fit, p, actual, grid).first()["t"])
    out = pred.withColumn("calibrated", tempered(p, F.lit(best)))
    at = F.col(actual).cast("int")
    return best, out.withColumns({"raw_loss": loss(F.get(p, at)), "calibrated_loss": loss(F.get("calibrated", at))})


def qualify(pred: DataFrame, expected: DataFrame, key: str, p: str, n: int, population: str) -> DataFrame:
    """One row a population of `expected`: how many keys are expected, covered, missing, repeated and valid, the faults and the verdict.

    `errors` lists what disqualifies it as name:count; predictions for keys that nobody expects are in the row of population null.
    """
    faults = prob_issues(pred, key, p, n).withColumnRenamed("key", "_k")
    given = pred.select(F.col(key).alias("_k")).groupBy("_k").agg(F.count("*").alias("rows"))
    worst = faults.groupBy("_k").agg(F.min("fault").alias("fault"))
    j = expected.select(F.col(key).alias("_e"), population).join(given.join(worst, "_k", "left"), F.col("_e") == F.col("_k"), "full_outer")
    known, covered = F.col("_e").isNotNull(), F.col("_e").isNotNull() & F.col("_k").isNotNull()
    g = j.groupBy(population).agg(
        F.count_if(known).alias("expected"), F.count_if(covered).alias("covered"), F.count_if(known & F.col("_k").isNull()).alias("missing"), F.count_if(~known).alias("extra"),
        F.count_if(covered & (F.col("rows") > 1)).alias("repeated"), F.count_if(covered & (F.col("rows") == 1) & F.col("fault").isNull()).alias("valid"),
        *[F.count_if(F.col("fault") == f).alias(f"_{k}") for k, f in enumerate(FAULTS)],
    )
    named = [(name, F.col(name)) for name in ("missing", "extra", "repeated")] + [(f, F.col(f"_{k}")) for k, f in enumerate(FAULTS)]
    errors = F.array_join(F.array_compact(F.array(*[F.when(c > 0, F.concat(F.lit(f"{name}:"), c.cast("string"))) for name, c in named])), "|")
    return g.select(population, "expected", "covered", "missing", "extra", "repeated", "valid", errors.alias("errors"), (errors != "").alias("disqualified"))


def assemble_log_probs(scores: str | Column) -> Column:
    """Log-probabilities from scores by log-sum-exp."""
    m = F.array_max(scores)
    lse = m + F.ln(total(scores, lambda x: F.exp(x - m)))
    return F.transform(scores, lambda x: x - lse)


def ensemble(parts: Sequence[tuple[str, float]]) -> Column:
    """Weighted sum of probability vectors, normalised; null if a component is missing."""
    weight = sum(w for _, w in parts)
    out = F.transform(parts[0][0], lambda x: x * (parts[0][1] / weight))
    for name, w in parts[1:]:
        out = F.zip_with(out, name, _adding(w / weight))
    return F.transform(out, lambda x: x / total(out))


def _adding(share: float):
    return lambda a, b: a + b * share


def ranked_codes(counts: DataFrame, n: str, value: str) -> DataFrame:
    """value, code: 1 for the largest count, ties by value."""
    placed = ordered_places(counts.select(n, value).withColumn("_one", F.lit(1).cast("long")), [F.desc(n), F.col(value)], "_one")
    return placed.select(value, (F.col("start") + 1).cast("int").alias("code"))


def leave_one_out(df: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """Mean of the flag over the other rows of the key, null for a single row."""
    w = Window.partitionBy(*keys)
    return df.withColumn("loo", (F.sum(flag).over(w) - F.col(flag)) / F.nullif(F.count("*").over(w) - 1, F.lit(0)))


def quantile_edges(train: DataFrame, column: str, bins: int) -> DataFrame:
    """One row: distinct inner edges of equal-frequency bins."""
    return exact_quantiles(train, column, [k / bins for k in range(1, bins)]).select(F.array_distinct("quantiles").alias("edges"))


def bin_of(column: str, edges: str = "edges") -> Column:
    """Number of edges at or below the value; -1 for missing."""
    return F.when(F.col(column).isNull(), -1).otherwise(F.size(F.filter(edges, lambda e: e <= F.col(column))))


def bootstrap(daily: DataFrame, cluster: str, total_column: str, n_column: str, rounds: int, seed: int) -> DataFrame:
    """Paired bootstrap over clusters with Poisson(1) weights from a hash: one row, mean and 95 % interval."""
    rows = daily.withColumn("b", F.explode(F.sequence(F.lit(1), F.lit(rounds))))
    u = (F.xxhash64(F.col(cluster), "b", F.lit(seed)).bitwiseAND(F.lit((1 << 53) - 1)) / float(1 << 53)).alias("u")
    steps = [0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563, 0.9994058151824183, 0.9999167588507119]
    weight = F.lit(0)
    for s in steps:
        weight = weight + F.when(F.col("u") >= s, 1).otherwise(0)
    rows = rows.withColumn("u", u).withColumn("w", weight)
    per = rows.groupBy("b").agg((F.sum(F.col("w") * F.col(total_column)) / F.nullif(F.sum(F.col("w") * F.col(n_column)), F.lit(0))).alias("delta"))
    q = F.percentile("delta", F.array(F.lit(0.025), F.lit(0.975)))
    return per.agg(F.avg("delta").alias("mean"), F.get(q, 0).alias("low"), F.get(q, 1).alias("high"))


def dominance(losses: DataFrame, stages: Sequence[str], share: float, pair: float, low: float, high: float, extreme: float) -> DataFrame:
    """losses with one of ten exclusive error classes; every row gets one.

    low below `low`; extreme from `extreme`; a stage with `share` of the loss (the largest, ties to the first) dominates; else
    two stages with `pair` of it together; else balanced, split by `high`. Three stages give 3 + 3 + 4 classes.
    """
    whole = sum((F.col(s) for s in stages[1:]), F.col(stages[0]))
    kind = F.when(whole < low, "low").when(whole >= extreme, "extreme")
    top = F.greatest(*stages)
    for s in stages:
        kind = kind.when((F.col(s) == top) & (F.col(s) >= share * whole), F.lit(f"{s}_dominant"))
    small = F.least(*stages)
    for s in stages:
        others = "_and_".join(x for x in stages if x != s)
        kind = kind.when((F.col(s) == small) & (whole - F.col(s) >= pair * whole), F.lit(others))
    return losses.withColumn("error_class", kind.when(whole >= high, "balanced_high").otherwise("balanced"))


def taxonomy(losses: DataFrame, stages: Sequence[str], share: float, low: float, high: float) -> DataFrame:
    """losses with its error class: low loss, one dominant stage, or spread over stages, split by size."""
    whole = sum((F.col(s) for s in stages[1:]), F.col(stages[0]))
    out = losses.withColumn("_t", whole)
    kind = F.when(F.col("_t") <= low, "low")
    for s in reversed(stages):
        kind = kind.when((F.col(s) >= share * F.col("_t")) & (F.col(s) == F.greatest(*stages)), s)
    return out.withColumn("error_class", kind.when(F.col("_t") >= high, "spread_high").otherwise("spread")).drop("_t")
