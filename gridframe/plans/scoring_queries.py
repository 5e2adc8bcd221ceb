"""Scores, baselines, encodings, diagnostics, appends, plans and text functions on the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridframe.functions import orders as om
from gridframe.functions import text as tx
from gridframe.operators import append as ap
from gridframe.operators import manifest as mf
from gridframe.operators import outcomes as oc
from gridframe.operators import scoring as sc
from gridframe.operators.quantiles import exact_quantiles
from gridframe.plans.registry import query, r6
from gridframe.plans.views import E, P, T, entry, prob
from gridframe.session import table
from gridframe.sources import pages as pg
from gridframe.sources.shared import new_path, stored

_L = f"""{P}, l AS (SELECT vec_id, label, p, p[label + 1] AS pa, -ln(p[label + 1]) AS log_loss, list_sum(list_transform(p, lambda x: x * x)) - 2 * p[label + 1] + 1 AS brier,
 1 + (SELECT count(*) FROM range(1, 11) t(i) WHERE p[i] > p[label + 1] OR (p[i] = p[label + 1] AND i < label + 1)) AS rank FROM p WHERE label BETWEEN 0 AND 9)"""


def _losses(spark, d):
    return sc.class_losses(prob(spark, d).where("label between 0 and 9"), "p", "label")


@query("rank_actual", f"WITH {_L} SELECT vec_id, CAST(rank AS INTEGER) AS rank FROM l")
def rank_actual(spark, d):
    return _losses(spark, d).select("vec_id", "rank")


@query("metrics7", f"WITH {_L} SELECT count(*) AS n, round(avg(log_loss) + 1e-9, 6) AS log_loss, round(avg(brier) + 1e-9, 6) AS brier, round(avg(rank) + 1e-9, 6) AS mean_rank FROM l")
def metrics7(spark, d):
    return sc.metrics(_losses(spark, d)).select("n", *[r6(c).alias(c) for c in ("log_loss", "brier", "mean_rank")])


_EXT = ["hit_1", "hit_3", "hit_5", "hit_10", "hit_20", "mean_rank", "median_rank", "mrr", "loss_p90", "loss_p95", "loss_p99", "loss_max", "below_1e3", "below_1e4", "below_1e6"]
_EXT_SQL = "round(avg(CASE WHEN rank <= 1 THEN 1.0 ELSE 0 END) + 1e-9, 6) AS hit_1, round(avg(CASE WHEN rank <= 3 THEN 1.0 ELSE 0 END) + 1e-9, 6) AS hit_3, round(avg(CASE WHEN rank <= 5 THEN 1.0 ELSE 0 END) + 1e-9, 6) AS hit_5, round(avg(CASE WHEN rank <= 10 THEN 1.0 ELSE 0 END) + 1e-9, 6) AS hit_10, round(avg(CASE WHEN rank <= 20 THEN 1.0 ELSE 0 END) + 1e-9, 6) AS hit_20, round(avg(rank) + 1e-9, 6) AS mean_rank, round(quantile_cont(rank, 0.5) + 1e-9, 6) AS median_rank, round(avg(1 / rank) + 1e-9, 6) AS mrr, round(quantile_cont(log_loss, 0.9) + 1e-9, 6) AS loss_p90, round(quantile_cont(log_loss, 0.95) + 1e-9, 6) AS loss_p95, round(quantile_cont(log_loss, 0.99) + 1e-9, 6) AS loss_p99, round(max(log_loss) + 1e-9, 6) AS loss_max, round(avg(CASE WHEN pa < 1e-3 THEN 1.0 ELSE 0 END) + 1e-9, 6) AS below_1e3, round(avg(CASE WHEN pa < 1e-4 THEN 1.0 ELSE 0 END) + 1e-9, 6) AS below_1e4, round(avg(CASE WHEN pa < 1e-6 THEN 1.0 ELSE 0 END) + 1e-9, 6) AS below_1e6"


@query("metrics_ext", f"WITH {_L} SELECT {_EXT_SQL} FROM l")
def metrics_ext(spark, d):
    return sc.metrics(_losses(spark, d)).select(*[r6(c).alias(c) for c in _EXT])


@query("metrics_rollup", f"WITH {_L}, x AS (SELECT CAST(vec_id % 3 AS BIGINT) AS model, CAST(vec_id % 4 AS BIGINT) AS fold, log_loss FROM l) SELECT model, fold, count(*) AS n, round(avg(log_loss) + 1e-9, 6) AS log_loss FROM x GROUP BY ROLLUP (model, fold)")
def metrics_rollup(spark, d):
    x = _losses(spark, d).select((F.col("vec_id") % 3).alias("model"), (F.col("vec_id") % 4).alias("fold"), "log_loss")
    return x.rollup("model", "fold").agg(F.count("*").alias("n"), r6(F.avg("log_loss")).alias("log_loss"))


_BY = {"outcome": "label", "venue": "vec_id % 5", "number": "vec_id % 12", "daypart": "vec_id % 30 // 10"}


@query("metrics_by_group", f"WITH {_L} " + " UNION ALL ".join(f"SELECT '{n}' AS dim, CAST({c} AS VARCHAR) AS value, count(*) AS n, round(avg(log_loss) + 1e-9, 6) AS log_loss, round(avg(CASE WHEN rank <= 3 THEN 1.0 ELSE 0 END) + 1e-9, 6) AS hit_3 FROM l GROUP BY {c}" for n, c in _BY.items()))
def metrics_by_group(spark, d):
    dims = F.array(*[F.struct(F.lit(n).alias("dim"), F.expr(c.replace("//", "div")).cast("string").alias("value")) for n, c in _BY.items()])
    x = _losses(spark, d).withColumn("g", F.explode(dims)).select("g.*", "log_loss", "brier", "rank", "p_actual")
    return sc.metrics(x, ["dim", "value"]).select("dim", "value", "n", r6("log_loss").alias("log_loss"), r6("hit_3").alias("hit_3"))


def _pairs(spark, d):
    l = _losses(spark, d).select("vec_id", F.col("log_loss").alias("a"))
    flat = F.transform("p", lambda x: 0.5 * x + 0.05)
    b = prob(spark, d).where("label between 0 and 9").withColumn("p", flat)
    b = sc.class_losses(b, "p", "label").select("vec_id", F.col("log_loss").alias("b"))
    return l.join(b, "vec_id").select("vec_id", (F.col("vec_id") % 30).alias("day"), (F.col("vec_id") % 4).alias("fold"), (F.col("a") - F.col("b")).alias("delta"))


_PAIR = f"{_L}, d AS (SELECT vec_id, CAST(vec_id % 30 AS BIGINT) AS day, CAST(vec_id % 4 AS BIGINT) AS fold, log_loss + ln(0.5 * pa + 0.05) AS delta FROM l)"


@query("paired_delta", f"WITH {_PAIR} SELECT fold, count(*) AS n, round(avg(delta) + 1e-9, 6) AS delta, round(min(delta) + 1e-9, 6) AS best, round(max(delta) + 1e-9, 6) AS worst FROM d GROUP BY fold")
def paired_delta(spark, d):
    return _pairs(spark, d).groupBy("fold").agg(F.count("*").alias("n"), r6(F.avg("delta")).alias("delta"), r6(F.min("delta")).alias("best"), r6(F.max("delta")).alias("worst"))


@query("paired_daily", f"WITH {_PAIR}, y AS (SELECT day, sum(delta) AS t FROM d GROUP BY day), f AS (SELECT fold, avg(delta) AS m FROM d GROUP BY fold) SELECT count(*) AS days, count(*) FILTER (t < 0) AS improved_days, (SELECT count(*) FROM f WHERE m < 0) AS improved_folds, (SELECT arg_max(fold, m) FROM f) AS worst_fold, round((SELECT max(m) FROM f) + 1e-9, 6) AS worst_delta FROM y")
def paired_daily(spark, d):
    g = stored(_pairs(spark, d).groupBy("fold", "day").agg(F.sum("delta").alias("t"), F.count("*").alias("n")), "daily")
    days = g.groupBy("day").agg(F.sum("t").alias("t")).agg(F.count("*").alias("days"), F.count_if(F.col("t") < 0).alias("improved_days"))
    m = g.groupBy("fold").agg((F.sum("t") / F.sum("n")).alias("m"))
    return days.join(m.agg(F.count_if(F.col("m") < 0).alias("improved_folds"), F.max_by("fold", "m").alias("worst_fold"), r6(F.max("m")).alias("worst_delta")))


@query("paired_bootstrap")
def paired_bootstrap(spark, d):
    daily = _pairs(spark, d).groupBy("day").agg(F.sum("delta").alias("total"), F.count("*").alias("n"))
    return sc.bootstrap(daily, "day", "total", "n", 200, 7)


@query("fold_stability", f"WITH {_L}, f AS (SELECT CAST(vec_id % 3 AS BIGINT) AS model, CAST(vec_id % 4 AS BIGINT) AS fold, avg(log_loss) AS m FROM l GROUP BY 1, 2) SELECT model, round(avg(m) + 1e-9, 6) AS mean, round(stddev_pop(m) + 1e-9, 6) AS std, arg_min(fold, m) AS best, arg_max(fold, m) AS worst FROM f GROUP BY model")
def fold_stability(spark, d):
    f = _losses(spark, d).groupBy((F.col("vec_id") % 3).alias("model"), (F.col("vec_id") % 4).alias("fold")).agg(F.avg("log_loss").alias("m"))
    return f.groupBy("model").agg(r6(F.avg("m")).alias("mean"), r6(F.stddev_pop("m")).alias("std"), F.min_by("fold", "m").alias("best"), F.max_by("fold", "m").alias("worst"))


@query("qualification", f"WITH {_L} SELECT count(*) AS expected, count(*) FILTER (vec_id % 9 <> 0) AS covered, count(*) FILTER (vec_id % 9 <> 0 AND abs(list_sum(p) - 1) <= 1e-10) AS valid, count(*) FILTER (vec_id % 9 = 0) > 0 AS disqualified FROM l")
def qualification(spark, d):
    from gridframe.operators.checks import prob_issues

    all_ = prob(spark, d).where("label between 0 and 9")
    given = all_.where("vec_id % 9 <> 0")
    bad = prob_issues(given, "vec_id", "p", 10).agg(F.count("*").alias("bad"))
    counts = all_.agg(F.count("*").alias("expected")).join(given.agg(F.count("*").alias("covered"))).join(bad)
    return counts.select("expected", "covered", (F.col("covered") - F.col("bad")).alias("valid"), ((F.col("covered") < F.col("expected")) | (F.col("bad") > 0)).alias("disqualified"))


def _targets(spark, d):
    return oc.target_status(entry(spark, d), "group_id", "lane", "finish", least=3, extra=[F.first("venue").alias("venue"), F.first("status").alias("status")]).where("class_id is not null").select("group_id", F.col("class_id").cast("int").alias("class_id"), "f1", "f2", "f3", "venue", "status")


def _counts(spark, d):
    """Groups per venue, status and class: a small table that baselines and diagnostics are rolled up from."""
    return stored(_targets(spark, d).groupBy("venue", "status", "class_id", "f1", "f2", "f3").agg(F.count("*").alias("n")), "classes")


_C = f"{E}, {T}, k AS (SELECT group_id, CAST(class_id AS INTEGER) AS class_id, f1, f2, f3, venue, status FROM c WHERE class_id IS NOT NULL)"


@query("uniform_eval", f"WITH {_C} SELECT count(*) AS n, round(ln(120) + 1e-9, 6) AS order_loss, round(ln(6) + 1e-9, 6) AS winner_loss, round(ln(30) + 1e-9, 6) AS exacta_loss, round(ln(20) + 1e-9, 6) AS set_loss, round(ln(5) + 1e-9, 6) AS second_loss, round(ln(4) + 1e-9, 6) AS third_loss, round(119 / 120 + 1e-9, 6) AS brier FROM k")
def uniform_eval(spark, d):
    pred = _targets(spark, d).select("group_id", "class_id", F.array_repeat(F.lit(1 / 120), 120).alias("p"))
    out = sc.order_losses(pred, "p", "class_id", om.class_table(spark))
    return out.agg(F.count("*").alias("n"), *[r6(F.avg(c)).alias(c) for c in sc.LOSSES])


@query("oracle_eval", f"WITH {_C} SELECT count(*) AS n, CAST(0 AS DOUBLE) AS order_loss, CAST(0 AS DOUBLE) AS brier FROM k")
def oracle_eval(spark, d):
    hot = F.transform(F.sequence(F.lit(0), F.lit(119)), lambda i: F.when(i == F.col("class_id"), 1.0).otherwise(0.0))
    pred = _targets(spark, d).select("group_id", "class_id", hot.alias("p"))
    out = sc.order_losses(pred, "p", "class_id", om.class_table(spark))
    return out.agg(F.count("*").alias("n"), r6(F.avg("order_loss")).alias("order_loss"), r6(F.avg("brier")).alias("brier"))


# ---- baselines

_DOM = "dm AS (SELECT CAST(range AS INTEGER) AS class_id FROM range(120))"
_B1 = f"{_C}, {_DOM}, n1 AS (SELECT dm.class_id, count(k.class_id) AS n FROM dm LEFT JOIN k ON dm.class_id = k.class_id GROUP BY 1), b1 AS (SELECT class_id, n, (n + 30.0 / 120) / (sum(n) OVER () + 30.0) AS p FROM n1)"


@query("b0", f"WITH {_C}, {_DOM} SELECT dm.class_id, count(k.class_id) AS n, round(1 / 120 + 1e-9, 6) AS p, round(count(k.class_id) * ln(120) + 1e-9, 6) AS loss FROM dm LEFT JOIN k ON dm.class_id = k.class_id GROUP BY 1")
def b0(spark, d):
    n = _targets(spark, d).groupBy("class_id").agg(F.count("*").alias("c"))
    p = om.class_table(spark).select("class_id", F.lit(1 / om.N_CLASSES).alias("p"))
    return p.join(n, "class_id", "left").select("class_id", F.coalesce("c", F.lit(0)).alias("n"), r6("p").alias("p"), r6(F.coalesce("c", F.lit(0)) * sc.loss(F.col("p"))).alias("loss"))


@query("b1", f"WITH {_B1} SELECT class_id, n, round(p + 1e-9, 6) AS p FROM b1")
def b1(spark, d):
    return sc.frequency(_targets(spark, d), "class_id", om.class_table(spark), 30.0).withColumn("p", r6("p"))


@query("b2", f"WITH {_B1}, sv AS (SELECT venue, count(*) AS size FROM k GROUP BY venue), cv AS (SELECT venue, class_id, count(*) AS c FROM k GROUP BY 1, 2), v AS (SELECT sv.venue, b1.class_id, CASE WHEN size >= 20 THEN (coalesce(c, 0) + 30 * p) / (size + 30) ELSE p END AS p FROM sv CROSS JOIN b1 LEFT JOIN cv ON cv.venue = sv.venue AND cv.class_id = b1.class_id), ss AS (SELECT venue, status, count(*) AS size FROM k GROUP BY 1, 2), cs AS (SELECT venue, status, class_id, count(*) AS c FROM k GROUP BY 1, 2, 3) SELECT ss.venue, ss.status, v.class_id, round(CASE WHEN size >= 20 THEN (coalesce(c, 0) + 30 * p) / (size + 30) ELSE p END + 1e-9, 6) AS p FROM ss JOIN v ON ss.venue = v.venue LEFT JOIN cs ON cs.venue = ss.venue AND cs.status = ss.status AND cs.class_id = v.class_id")
def b2(spark, d):
    return sc.hierarchical(_counts(spark, d), "class_id", [["venue"], ["venue", "status"]], om.class_table(spark), 30.0, 20, "n").withColumn("p", r6("p"))


_ST = f"{_C}, la AS (SELECT CAST(unnest(range(1, 7)) AS INTEGER) AS lane), a1 AS (SELECT la.lane AS first, (count(k.f1) + 5.0) / ((SELECT count(*) FROM k) + 30.0) AS p1 FROM la LEFT JOIN k ON k.f1 = la.lane GROUP BY 1), a2 AS (SELECT x.lane AS first, y.lane AS second, (count(k.f1) + 6.0) / ((SELECT count(*) FROM k WHERE f1 = x.lane) + 30.0) AS p2 FROM la x JOIN la y ON x.lane <> y.lane LEFT JOIN k ON k.f1 = x.lane AND k.f2 = y.lane GROUP BY 1, 2), a3 AS (SELECT x.lane AS first, y.lane AS second, z.lane AS third, (count(k.f1) + 7.5) / ((SELECT count(*) FROM k WHERE f1 = x.lane AND f2 = y.lane) + 30.0) AS p3 FROM la x JOIN la y ON x.lane <> y.lane JOIN la z ON z.lane <> x.lane AND z.lane <> y.lane LEFT JOIN k ON k.f1 = x.lane AND k.f2 = y.lane AND k.f3 = z.lane GROUP BY 1, 2, 3)"


def _stages(spark, counts):
    """first, second, third with c1, c2, c3, n: how many groups begin like that, of all n; one row a class (120)."""
    whole = lambda k: F.sum("c").over(Window.partitionBy(*["first", "second", "third"][:k]))
    own = counts.groupBy(F.col("f1").alias("first"), F.col("f2").alias("second"), F.col("f3").alias("third")).agg(F.sum("n").alias("c"))
    full = om.class_table(spark).select("first", "second", "third").join(F.broadcast(own), ["first", "second", "third"], "left").withColumn("c", F.coalesce("c", F.lit(0)))
    return full.withColumns({"c1": whole(1), "c2": whole(2), "c3": F.col("c"), "n": F.sum("c").over(Window.partitionBy(F.lit(0)))}).drop("c")


def _stage_probs(stages):
    return stages.withColumns({"p1": (F.col("c1") + 5.0) / (F.col("n") + 30.0), "p2": (F.col("c2") + 6.0) / (F.col("c1") + 30.0), "p3": (F.col("c3") + 7.5) / (F.col("c2") + 30.0)})


@query("b3", f"WITH {_ST} SELECT first, second, third, round(p1 * p2 * p3 + 1e-9, 6) AS p FROM a1 JOIN a2 USING (first) JOIN a3 USING (first, second)")
def b3(spark, d):
    return _stage_probs(_stages(spark, _counts(spark, d))).select("first", "second", "third", r6(F.col("p1") * F.col("p2") * F.col("p3")).alias("p"))


_GRID = [(0, 0.5), (1, 1.0), (2, 2.0), (3, 4.0)]


@query("grid_select", f"WITH {_L}, g AS (SELECT * FROM (VALUES (0, 0.5), (1, 1.0), (2, 2.0), (3, 4.0)) t(ordinal, tau)), x AS (SELECT ordinal, CAST(tau AS DOUBLE) AS tau, avg(-ln((pa + tau / 10) / (1 + tau))) AS loss FROM l CROSS JOIN g GROUP BY 1, 2) SELECT ordinal, tau, round(loss + 1e-9, 6) AS loss FROM x ORDER BY x.loss, ordinal LIMIT 1")
def grid_select(spark, d):
    grid = F.array(*[F.struct(F.lit(o).alias("ordinal"), F.lit(t).alias("tau")) for o, t in _GRID])
    x = _losses(spark, d).select("p_actual", F.explode(grid).alias("g")).select("p_actual", "g.*")
    x = x.withColumn("l", sc.loss((F.col("p_actual") + F.col("tau") / 10) / (1 + F.col("tau"))))
    return sc.grid_select(x, ["tau"], "l", "ordinal").withColumn("loss", r6("loss"))


_TEMPS = [0.5, 1.0, 1.5, 2.0, 3.0]


@query("temperature", f"WITH {_L}, t AS (SELECT CAST(unnest({_TEMPS}) AS DOUBLE) AS t) SELECT t, round(avg(-ln(pow(pa, 1 / t) / list_sum(list_transform(p, lambda x: pow(x, 1 / t))))) + 1e-9, 6) AS loss FROM l CROSS JOIN t GROUP BY t")
def temperature(spark, d):
    return sc.temperature(prob(spark, d).where("label between 0 and 9"), "p", "label", _TEMPS).withColumn("loss", r6("loss"))


@query("impute_scale", f"WITH {E}, x AS (SELECT group_id, lane, CASE WHEN discount > 0.02 THEN price END AS v, group_id % 2 = 0 AS train FROM e), m AS (SELECT quantile_cont(v, 0.5) FILTER (train) AS med FROM x), f AS (SELECT avg(coalesce(v, med)) AS mean, stddev_pop(coalesce(v, med)) AS std FROM x CROSS JOIN m WHERE train) SELECT group_id, lane, v IS NULL AS was_missing, round((coalesce(v, med) - mean) / std + 1e-9, 6) AS scaled FROM x CROSS JOIN m CROSS JOIN f")
def impute_scale(spark, d):
    x = entry(spark, d, venue=False).select("group_id", "lane", F.when(F.col("discount") > 0.02, F.col("price")).alias("v"), (F.col("group_id") % 2 == 0).alias("train"))
    med = exact_quantiles(x.where("train"), "v", [0.5]).select(F.get("quantiles", 0).alias("med"))
    filled = x.join(F.broadcast(med)).withColumn("w", F.coalesce("v", "med"))  # one row
    fit = filled.where("train").agg(F.avg("w").alias("mean"), F.stddev_pop("w").alias("std"))
    return filled.join(F.broadcast(fit)).select("group_id", "lane", F.col("v").isNull().alias("was_missing"), r6((F.col("w") - F.col("mean")) / F.col("std")).alias("scaled"))


@query("vocab", "WITH v AS (SELECT p_name, CAST(row_number() OVER (ORDER BY n DESC, p_name) AS INTEGER) AS code FROM (SELECT p_name, count(*) AS n FROM part WHERE p_partkey % 2 = 0 GROUP BY 1 HAVING count(*) >= 20)) SELECT p_partkey, coalesce(code, 0) AS code FROM part LEFT JOIN v USING (p_name)")
def vocab(spark, d):
    p = table(spark, d, "part")
    v = sc.ranked_codes(p.where("p_partkey % 2 = 0").groupBy("p_name").agg(F.count("*").alias("n")).where("n >= 20"), "n", "p_name")
    return p.join(v, "p_name", "left").select("p_partkey", F.coalesce("code", F.lit(0)).alias("code"))


@query("oof_target_enc", f"WITH {E}, x AS (SELECT *, CAST(group_id % 5 AS BIGINT) AS fold, CASE WHEN finish = 1 THEN 1 ELSE 0 END AS win FROM e), t AS (SELECT entity, sum(win) AS w, count(*) AS n FROM x GROUP BY 1), f AS (SELECT entity, fold, sum(win) AS w, count(*) AS n FROM x GROUP BY 1, 2) SELECT f.entity, f.fold, round((t.w - f.w + 2.5) / (t.n - f.n + 10) + 1e-9, 6) AS encoded FROM f JOIN t ON f.entity = t.entity")
def oof_target_enc(spark, d):
    x = entry(spark, d, venue=False).select("entity", (F.col("group_id") % 5).alias("fold"), F.when(F.col("finish") == 1, 1).otherwise(0).alias("win"))
    f = x.groupBy("entity", "fold").agg(F.sum("win").alias("w"), F.count("*").alias("n"))
    t = f.groupBy("entity").agg(F.sum("w").alias("tw"), F.sum("n").alias("tn"))
    return f.join(t, "entity").select("entity", "fold", r6((F.col("tw") - F.col("w") + 2.5) / (F.col("tn") - F.col("n") + 10)).alias("encoded"))


@query("feature_hash")
def feature_hash(spark, d):
    from pyspark.ml.feature import FeatureHasher

    e = entry(spark, d).select("group_id", "lane", F.col("venue").cast("string").alias("venue"), "segment", F.coalesce("returnflag", F.lit("__MISSING__")).alias("returnflag"))
    hashed = FeatureHasher(inputCols=["venue", "segment", "returnflag"], outputCol="v", numFeatures=1 << 17).transform(e)
    return hashed.select("group_id", "lane", F.col("v").cast("string").alias("features"))


@query("logsumexp_assemble", "WITH s AS (SELECT vec_id, list_transform(embedding[1:6], lambda x: CAST(x AS DOUBLE) * 10) AS s FROM embeddings), m AS (SELECT vec_id, s, list_max(s) AS m FROM s) SELECT vec_id, round(list_max(s) - (m + ln(list_sum(list_transform(s, lambda x: exp(x - m))))) + 1e-9, 6) AS top, round(list_min(s) - (m + ln(list_sum(list_transform(s, lambda x: exp(x - m))))) + 1e-9, 6) AS low FROM m")
def logsumexp_assemble(spark, d):
    s = table(spark, d, "embeddings").select("vec_id", F.transform(F.slice("embedding", 1, 6), lambda x: x.cast("double") * 10).alias("s"))
    s = s.withColumn("lp", sc.assemble_log_probs("s"))
    return s.select("vec_id", r6(F.array_max("lp")).alias("top"), r6(F.array_min("lp")).alias("low"))


@query("loo_prior", f"WITH {E}, x AS (SELECT group_id, lane, entity, price, CASE WHEN finish = 1 THEN 1 ELSE 0 END AS win FROM e) SELECT group_id, lane, price, round((sum(win) OVER (PARTITION BY entity) - win) / nullif(count(*) OVER (PARTITION BY entity) - 1, 0) + 1e-9, 6) AS loo FROM x")
def loo_prior(spark, d):
    x = entry(spark, d, venue=False).select("group_id", "lane", "entity", "price", F.when(F.col("finish") == 1, 1).otherwise(0).alias("win"))
    return sc.leave_one_out(x, ["entity"], "win").select("group_id", "lane", "price", r6("loo").alias("loo"))


@query("ensemble", f"WITH {P} SELECT vec_id, round(list_max(list_transform(p, lambda x: 0.75 * x + 0.025)) + 1e-9, 6) AS top FROM p")
def ensemble(spark, d):
    p = prob(spark, d).withColumn("u", F.array_repeat(F.lit(0.1), 10))
    return p.select("vec_id", r6(F.array_max(sc.ensemble([("p", 0.75), ("u", 0.25)]))).alias("top"))


@query("seed", "SELECT o_orderkey, CAST('0x' || substr(sha256(o_orderkey || ':' || o_custkey), 1, 8) AS BIGINT) AS seed FROM orders")
def seed(spark, d):
    return table(spark, d, "orders").select("o_orderkey", ap.seed_of(F.col("o_orderkey").cast("string"), F.lit(":"), F.col("o_custkey").cast("string")).alias("seed"))


# ---- diagnostics

_SL = f"{_ST}, pr AS (SELECT k.group_id, k.venue, -ln(p1) AS first_loss, -ln(p2) AS second_loss, -ln(p3) AS third_loss FROM k JOIN a1 ON a1.first = f1 JOIN a2 ON a2.first = f1 AND a2.second = f2 JOIN a3 ON a3.first = f1 AND a3.second = f2 AND a3.third = f3)"


def _stage_losses(spark, d):
    """Losses of each class's stages with the number of its groups (c3); all groups of a class have the same."""
    p = _stage_probs(_stages(spark, _counts(spark, d))).where("c3 > 0")
    return p.select("c3", sc.loss(F.col("p1")).alias("first_loss"), sc.loss(F.col("p2")).alias("second_loss"), sc.loss(F.col("p3")).alias("third_loss"), sc.loss(F.col("p1") * F.col("p2") * F.col("p3")).alias("whole_loss"))


@query("stage_decomp", f"WITH {_SL} SELECT round(avg(first_loss) + 1e-9, 6) AS first_loss, round(avg(second_loss) + 1e-9, 6) AS second_loss, round(avg(third_loss) + 1e-9, 6) AS third_loss, round(avg(first_loss + second_loss + third_loss) + 1e-9, 6) AS total, true AS identity_holds FROM pr")
def stage_decomp(spark, d):
    s = _stage_losses(spark, d).withColumn("total", F.col("first_loss") + F.col("second_loss") + F.col("third_loss"))
    mean = lambda c: r6(F.sum(F.col(c) * F.col("c3")) / F.sum("c3")).alias(c)
    # The chain of stages is the loss of the whole order: the largest difference of the two.
    return s.agg(*[mean(c) for c in ("first_loss", "second_loss", "third_loss", "total")], (F.max(F.abs(F.col("total") - F.col("whole_loss"))) <= 1e-12).alias("identity_holds"))


@query("taxonomy", f"WITH {_SL}, tx AS (SELECT *, first_loss + second_loss + third_loss AS t, greatest(first_loss, second_loss, third_loss) AS g FROM pr) SELECT CASE WHEN t <= 4.1 THEN 'low' WHEN third_loss >= 0.4 * t AND third_loss = g THEN 'third_loss' WHEN second_loss >= 0.4 * t AND second_loss = g THEN 'second_loss' WHEN first_loss >= 0.4 * t AND first_loss = g THEN 'first_loss' WHEN t >= 5 THEN 'spread_high' ELSE 'spread' END AS error_class, count(*) AS n FROM tx GROUP BY 1")
def taxonomy(spark, d):
    t = sc.taxonomy(_stage_losses(spark, d), ["first_loss", "second_loss", "third_loss"], 0.4, 4.1, 5.0)
    return t.groupBy("error_class").agg(F.sum("c3").alias("n"))


_QS = "[0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]"


def _binned(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", F.when(F.col("l_discount") > 0.01, F.col("l_extendedprice")).alias("v"), "l_quantity")
    edges = sc.quantile_edges(li.where("l_orderkey % 2 = 0"), "v", 10)
    return li.join(F.broadcast(edges)).withColumn("bin", sc.bin_of("v"))  # one row of edges


_BIN = f"li AS (SELECT l_orderkey, CASE WHEN l_discount > 0.01 THEN l_extendedprice END AS v, l_quantity FROM lineitem), ed AS (SELECT list_distinct(quantile_cont(v, {_QS})) AS edges FROM li WHERE l_orderkey % 2 = 0), bn AS (SELECT li.*, CASE WHEN v IS NULL THEN -1 ELSE CAST(len(list_filter(edges, lambda e: e <= v)) AS INTEGER) END AS bin FROM li CROSS JOIN ed)"


@query("quantile_bins", f"WITH {_BIN} SELECT bin, count(*) AS n, round(min(v) + 1e-9, 6) AS lo, round(max(v) + 1e-9, 6) AS hi FROM bn GROUP BY bin")
def quantile_bins(spark, d):
    return _binned(spark, d).groupBy("bin").agg(F.count("*").alias("n"), r6(F.min("v")).alias("lo"), r6(F.max("v")).alias("hi"))


@query("error_profile", f"WITH {_BIN} SELECT CAST(l_orderkey % 3 AS BIGINT) AS fold, bin, count(*) AS support, round(avg(l_quantity) + 1e-9, 6) AS loss, round(avg(l_quantity) - (SELECT avg(l_quantity) FROM li) + 1e-9, 6) AS delta FROM bn GROUP BY 1, 2")
def error_profile(spark, d):
    b = _binned(spark, d)
    base = b.agg(F.avg("l_quantity").alias("base"))
    g = b.groupBy((F.col("l_orderkey") % 3).alias("fold"), "bin").agg(F.count("*").alias("support"), F.avg("l_quantity").alias("l"))
    return g.join(F.broadcast(base)).select("fold", "bin", "support", r6("l").alias("loss"), r6(F.col("l") - F.col("base")).alias("delta"))


# ---- appends and plans


_MR = "SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS day, l_returnflag, l_linestatus, CASE WHEN l_orderkey % 9 = 0 THEN NULL WHEN l_orderkey % 10 = 0 THEN 3 + l_linenumber % 2 ELSE 4 END AS declared, nullif(l_discount, 0) AS discount, nullif(l_partkey % 6, 0) AS part FROM lineitem"
_CNT = "(SELECT string_agg(k || ':' || n, '|' ORDER BY k) FROM ({})) AS {}"


@query(
    "manifest_row",
    f"""WITH m AS ({_MR}), h AS (SELECT sha256(coalesce(CAST(part AS VARCHAR), '\\N')) AS h FROM m), hb AS (SELECT substr(h, 1, 2) AS b, sha256(string_agg(h, '' ORDER BY h)) AS bh FROM h GROUP BY 1),
sz AS (SELECT CASE WHEN count(DISTINCT declared) = 0 THEN 'missing' WHEN count(DISTINCT declared) > 1 THEN 'ambiguous' WHEN abs(max(declared) - count(*)) > 1 THEN 'mismatch' END AS k FROM m GROUP BY l_orderkey)
SELECT 1 AS manifest_version, 'lines' AS snapshot_name, 'one row per l_linenumber per l_orderkey' AS row_grain, count(*) AS raw_row_count, count(DISTINCT l_orderkey) AS group_count, count(*) FILTER (l_linestatus = 'F') AS training_row_count, min(day) AS date_min, max(day) AS date_max,
CAST(count(*) FILTER (part IS NULL) AS BIGINT) AS part_missing, round(100 * count(*) FILTER (part IS NULL) / count(*), 2) AS part_missing_percent, count(*) FILTER (part IS NULL) = count(*) AS part_all_missing,
{_CNT.format("SELECT l_returnflag AS k, count(*) AS n FROM m GROUP BY 1", "category_rows")}, {_CNT.format("SELECT l_returnflag AS k, count(DISTINCT l_orderkey) AS n FROM m GROUP BY 1", "category_groups")},
{_CNT.format("SELECT strftime(day, '%Y-%m') AS k, count(DISTINCT l_orderkey) AS n FROM m GROUP BY 1", "month_groups")}, {_CNT.format("SELECT l_linestatus AS k, count(*) AS n FROM m GROUP BY 1", "status_counts")},
{_CNT.format("SELECT 'part' AS k, count(*) AS n FROM m WHERE part IS NULL", "top_missing")}, {_CNT.format("SELECT k, count(*) AS n FROM sz WHERE k IS NOT NULL GROUP BY 1", "size_mismatches")},
CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) AS duplicate_members, (SELECT count(*) FROM (SELECT l_orderkey FROM m GROUP BY 1 HAVING count(DISTINCT l_linestatus) > 1)) AS group_conflicts,
(SELECT count(*) FROM (SELECT l_orderkey FROM m GROUP BY 1 HAVING count(DISTINCT l_linenumber) < max(l_linenumber) - min(l_linenumber) + 1)) AS number_gaps,
(SELECT count(DISTINCT o_custkey % 40) FROM orders) AS batches, (SELECT count(*) FROM orders) AS batch_rows, (SELECT max(o_custkey % 40) FROM orders) AS last_batch, (SELECT sha256(string_agg(bh, '' ORDER BY b)) FROM hb) AS content_hash FROM m""",
)
def manifest_row(spark, d):
    """Written as one JSON text and read back."""
    n = F.col("l_orderkey")
    declared = F.when(n % 9 == 0, F.lit(None)).when(n % 10 == 0, 3 + F.col("l_linenumber") % 2).otherwise(4)
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("day"), "l_returnflag", "l_linestatus", declared.alias("declared"), F.nullif(F.col("l_partkey") % 6, F.lit(0)).alias("part"))
    ledger = table(spark, d, "orders").select((F.col("o_custkey") % 40).alias("batch"), F.lit(1).alias("rows"))
    m = mf.dataset_manifest(rows, "lines", "l_orderkey", "l_linenumber", "day", "l_returnflag", "l_linestatus", "l_linenumber", "declared", ["l_linestatus"], ["part"], F.col("l_linestatus") == "F", ledger)
    return ap.json_manifest(m, new_path(spark, "manifest"))


@query("file_hashes")
def file_hashes(spark, d):
    return ap.file_hashes(spark, f"{d}/documents.parquet")


_LH = "WITH r AS (SELECT sha256(coalesce(CAST({a} AS VARCHAR), '\\N') || '|' || coalesce({b}, '\\N')) AS h FROM {t}), b AS (SELECT substr(h, 1, 2) AS b, sha256(string_agg(h, '' ORDER BY h)) AS bh, count(*) AS n FROM r GROUP BY 1)"


@query("logical_hash", _LH.format(a="p_partkey", b="p_name", t="part") + " SELECT CAST(sum(n) AS BIGINT) AS n_rows, sha256(string_agg(bh, '' ORDER BY b)) AS content_hash FROM b")
def logical_hash(spark, d):
    return ap.logical_hash(table(spark, d, "part"), ["p_partkey", "p_name"])


@query("snapshot_id", _LH.format(a="o_orderkey", b="o_orderstatus", t="orders") + " SELECT CAST(sum(n) AS BIGINT) || '-' || substr(sha256(string_agg(bh, '' ORDER BY b)), 1, 12) AS snapshot_id FROM b")
def snapshot_id(spark, d):
    h = ap.logical_hash(table(spark, d, "orders"), ["o_orderkey", "o_orderstatus"])
    return h.select(F.concat_ws("-", F.col("n_rows").cast("string"), F.substring("content_hash", 1, 12)).alias("snapshot_id"))


@query("hash_drift", "WITH a AS (SELECT p_partkey, md5(p_name) AS h FROM part WHERE p_partkey % 5 <> 0), b AS (SELECT p_partkey, md5(CASE WHEN p_partkey % 3 = 0 THEN p_name || 'x' ELSE p_name END) AS h FROM part WHERE p_partkey % 7 <> 0) SELECT coalesce(a.p_partkey, b.p_partkey) AS p_partkey, CASE WHEN a.h IS NULL THEN 'added' WHEN b.h IS NULL THEN 'removed' ELSE 'changed' END AS status FROM a FULL JOIN b ON a.p_partkey = b.p_partkey WHERE a.h IS DISTINCT FROM b.h")
def hash_drift(spark, d):
    p = table(spark, d, "part")
    md5 = lambda c: F.md5(c.cast("binary")).alias("h")
    a = p.where("p_partkey % 5 <> 0").select("p_partkey", md5(F.col("p_name")))
    b = p.where("p_partkey % 7 <> 0").select("p_partkey", md5(F.when(F.col("p_partkey") % 3 == 0, F.concat("p_name", F.lit("x"))).otherwise(F.col("p_name"))))
    return ap.drift(a, b, "p_partkey", "h")


@query("append_dry_run", "WITH o AS (SELECT * FROM orders WHERE o_orderkey % 3 = 0), n AS (SELECT * FROM orders WHERE o_orderkey % 2 = 0 AND o_custkey NOT IN (SELECT o_custkey FROM o)), x AS (SELECT (SELECT count(*) FROM o) AS before_rows, (SELECT count(DISTINCT o_custkey) FROM o) AS before_groups, (SELECT count(*) FROM n) AS added_rows, (SELECT count(DISTINCT o_custkey) FROM n) AS added_groups) SELECT *, before_rows + added_rows AS after_rows, before_groups + added_groups AS after_groups, (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_orderkey % 2 = 0) AS actual_groups, CAST(700 AS BIGINT) AS expected_groups, (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_orderkey % 2 = 0) = 700 AS as_expected FROM x")
def append_dry_run(spark, d):
    o = table(spark, d, "orders")
    return ap.dry_run(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 3 = 0"), "o_custkey", 700)


@query("append_apply", "SELECT batch_id, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT o_custkey) AS BIGINT) AS n_groups FROM (SELECT 'a' AS batch_id, o_custkey FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT 'b', o_custkey FROM orders WHERE o_orderkey % 2 = 0 AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 3 = 0)) GROUP BY 1")
def append_apply(spark, d):
    path = new_path(spark, "append")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    for batch, part in (("a", o.where("o_orderkey % 3 = 0")), ("b", o.where("o_orderkey % 2 = 0")), ("b", o.where("o_orderkey % 2 = 0"))):
        ap.append_batch(part, path, batch, "o_custkey")  # the third run repeats the second
    return spark.read.parquet(path).groupBy("batch_id").agg(F.count("*").alias("n_rows"), F.countDistinct("o_custkey").alias("n_groups"))


_AB = "a AS (SELECT * FROM orders WHERE o_custkey % 3 = 0), b AS (SELECT * FROM orders WHERE o_custkey % 3 <> 0)"
_STEPS_SQL = " UNION ALL ".join(f"SELECT '{x}' AS batch_id, '{step}' AS step, CAST(({n}) AS BIGINT) AS n_rows, 'done' AS status" for x, backup in (("a", "0"), ("b", "1")) for step, n in (("backup", backup), ("append", f"SELECT count(*) FROM {x}"), ("load", f"SELECT count(*) FROM {x}"), ("export", f"SELECT count(*) FROM {x}"), ("audit", "1"), ("manifest", "1"), ("log", "1")))


@query("append_steps", f"WITH {_AB} {_STEPS_SQL} UNION ALL SELECT 'table', 'rows', count(*), 'done' FROM orders")
def append_steps(spark, d):
    root = new_path(spark, "steps")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    ap.AppendRun(spark, root, "a", "o_custkey").run(o.where("o_custkey % 3 = 0"))
    second = ap.AppendRun(spark, root, "b", "o_custkey")
    for stop in ("append", "audit", None, None):  # broken off twice, resumed, then run again with nothing left to do
        second.run(o.where("o_custkey % 3 <> 0"), stop)
    whole = spark.read.parquet(second.table).agg(F.count("*").alias("n_rows")).select(F.lit("table").alias("batch_id"), F.lit("rows").alias("step"), "n_rows", F.lit("done").alias("status"))
    return second.ledger().unionByName(whole)


@query("apply_guard", "WITH s AS (SELECT o_custkey AS batch, CASE WHEN o_orderkey % 2 = 0 THEN 'dry_run' ELSE 'apply' END AS mode, CASE WHEN o_orderstatus = 'F' THEN 'passed' ELSE 'failed' END AS status, o_orderpriority AS h FROM orders), a AS (SELECT DISTINCT batch, h FROM s WHERE mode = 'apply'), d AS (SELECT DISTINCT batch, h, true AS ok FROM s WHERE mode = 'dry_run' AND status = 'passed') SELECT batch, coalesce(ok, false) AS allowed FROM a LEFT JOIN d USING (batch, h)")
def apply_guard(spark, d):
    o = table(spark, d, "orders")
    s = o.select(F.col("o_custkey").alias("batch"), F.when(F.col("o_orderkey") % 2 == 0, "dry_run").otherwise("apply").alias("mode"), F.when(F.col("o_orderstatus") == "F", "passed").otherwise("failed").alias("status"), F.col("o_orderpriority").alias("h"))
    return ap.apply_guard(s, "batch", "h")


@query("wave_select", "SELECT CAST(substr(c_name, 10) AS BIGINT) AS number, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING' AND CAST(substr(c_name, 10) AS BIGINT) BETWEEN 100 AND 900 ORDER BY number")
def wave_select(spark, d):
    c = table(spark, d, "customer").select(F.regexp_extract("c_name", r"#(\d+)$", 1).cast("long").alias("number"), "c_mktsegment")
    return c.where("c_mktsegment = 'BUILDING' and number between 100 and 900").orderBy("number")


@query("gap_plan", "WITH p AS (SELECT CAST(unnest(generate_series(DATE '1996-01-01', DATE '1996-03-31', INTERVAL 1 DAY)) AS DATE) AS date), q AS (SELECT date, CAST(unnest(range(1, 6)) AS INTEGER) AS number FROM p) SELECT date, number, strftime(date, '%Y%m%d') || '_x_' || number AS key, 'https://example.org/r?day=' || strftime(date, '%Y%m%d') || '&no=' || number AS url FROM q WHERE NOT EXISTS (SELECT 1 FROM orders WHERE CAST(o_orderdate AS DATE) = date AND o_custkey % 5 + 1 = number)")
def gap_plan(spark, d):
    o = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("date"), (F.col("o_custkey") % 5 + 1).cast("int").alias("number"))
    p = ap.gap_plan(ap.calendar(spark, "1996-01-01", "1996-03-31", 5), o, ["date", "number"])
    url = F.concat(F.lit("https://example.org/r?day="), F.url_encode(F.date_format("date", "yyyyMMdd")), F.lit("&no="), F.col("number").cast("string"))
    return p.select("date", "number", tx.make_key("date", F.lit("x"), "number").alias("key"), url.alias("url"))


@query("date_windows", "WITH a AS (SELECT max(CAST(o_orderdate AS DATE)) AS anchor FROM orders), w AS (SELECT CAST(unnest(range(1, 25)) AS INTEGER) AS window_no) SELECT window_no, CAST(ceil(window_no / 5) AS INTEGER) AS wave_no, anchor - (window_no - 1) * 7 - 6 AS date_from, anchor - (window_no - 1) * 7 AS date_to FROM w CROSS JOIN a")
def date_windows(spark, d):
    anchor = table(spark, d, "orders").agg(F.max(F.to_date("o_orderdate")).cast("string")).first()[0]
    return ap.date_windows(spark, anchor, 7, 24, 5)


@query("plan_report", "WITH o AS (SELECT CAST(o_orderdate AS DATE) AS day, o_orderkey FROM orders), a AS (SELECT max(day) AS anchor FROM o) SELECT CAST((anchor - day) // 30 + 1 AS INTEGER) AS window_no, count(*) AS candidates, arg_min(o_orderkey, (day, o_orderkey)) AS first_id, arg_max(o_orderkey, (day, o_orderkey)) AS last_id FROM o CROSS JOIN a GROUP BY 1")
def plan_report(spark, d):
    o = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day"), "o_orderkey")
    anchor = o.agg(F.max("day").alias("anchor"))
    w = (F.floor(F.datediff("anchor", "day") / 30) + 1).cast("int")
    order = F.struct("day", "o_orderkey")
    return o.join(F.broadcast(anchor)).groupBy(w.alias("window_no")).agg(F.count("*").alias("candidates"), F.min_by("o_orderkey", order).alias("first_id"), F.max_by("o_orderkey", order).alias("last_id"))


@query("job_meta", "SELECT o_custkey, string_agg(DISTINCT o_orderstatus, ';' ORDER BY o_orderstatus) AS tracks, min(CAST(o_orderdate AS DATE)) AS date_from, max(CAST(o_orderdate AS DATE)) AS date_to, count(*) AS n FROM orders GROUP BY 1")
def job_meta(spark, d):
    day = F.to_date("o_orderdate")
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_set("o_orderstatus")), ";").alias("tracks"), F.min(day).alias("date_from"), F.max(day).alias("date_to"), F.count("*").alias("n"))


# ---- text functions and pages


@query("nfkc")
def nfkc(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.nfkc("text").alias("text"))


@query("label_norm")
def label_norm(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.label_key("source").alias("label"))


_NUM = "CASE WHEN p_partkey % 7 = 0 THEN '--' ELSE 'no ' || p_size || ',' || lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') || '.5kg' END"


def _numbers(spark, d):
    s = F.concat(F.lit("no "), F.col("p_size").cast("string"), F.lit(","), F.lpad((F.col("p_partkey") % 1000).cast("string"), 3, "0"), F.lit(".5kg"))
    return table(spark, d, "part").select("p_partkey", F.when(F.col("p_partkey") % 7 == 0, "--").otherwise(s).alias("s"))


@query("clean_int", f"SELECT p_partkey, CASE WHEN s = '--' THEN '' ELSE regexp_extract(replace(s, ',', ''), '(-?\\d+)', 1) END AS v FROM (SELECT p_partkey, {_NUM} AS s FROM part)")
def clean_int(spark, d):
    return _numbers(spark, d).select("p_partkey", tx.clean_int("s").alias("v"))


@query("clean_dec", f"SELECT p_partkey, CASE WHEN s = '--' THEN '' ELSE regexp_extract(regexp_replace(s, '[,倍]|kg', '', 'g'), '(-?\\d+(?:\\.\\d+)?)', 1) END AS v FROM (SELECT p_partkey, {_NUM} AS s FROM part)")
def clean_dec(spark, d):
    return _numbers(spark, d).select("p_partkey", tx.clean_decimal("s").alias("v"))


@query("finish_norm", "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'R' THEN 'SCR' WHEN l_linestatus = 'F' THEN 'DNF' ELSE CAST(l_linenumber AS VARCHAR) END AS finish FROM lineitem")
def finish_norm(spark, d):
    s = F.when(F.col("l_returnflag") == "R", "取消").when(F.col("l_linestatus") == "F", "競走中止").otherwise(F.concat(F.col("l_linenumber").cast("string"), F.lit(" 着")))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", tx.finish_mark(s).alias("finish"))


@query("split_pair", "SELECT p_partkey, regexp_extract(p_brand, '^([^\\d]+)(\\d+)', 1) AS letters, regexp_extract(p_brand, '^([^\\d]+)(\\d+)', 2) AS digits, CAST(p_size AS VARCHAR) AS value, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_partkey % 9 AS VARCHAR) ELSE CAST(-(p_partkey % 9) - 1 AS VARCHAR) END AS change FROM part")
def split_pair(spark, d):
    k = F.col("p_partkey") % 9
    change = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("(+"), k.cast("string"), F.lit(")"))).otherwise(F.concat(F.lit("("), (-k - 1).cast("string"), F.lit(")")))
    p = table(spark, d, "part").select("p_partkey", tx.split_letters_digits("p_brand").alias("a"), tx.split_value_change(F.concat(F.col("p_size").cast("string"), change)).alias("b"))
    return p.select("p_partkey", "a.*", "b.*")


@query("extract_num_unit", "SELECT o_orderkey, CAST(o_custkey % 9000 + 1000 AS VARCHAR) AS v FROM orders")
def extract_num_unit(spark, d):
    s = F.concat(F.lit("ダート "), (F.col("o_custkey") % 9000 + 1000).cast("string"), F.lit(" m"))
    return table(spark, d, "orders").select("o_orderkey", tx.number_before_unit(s).alias("v"))


@query("first_heading", "SELECT page_id, trim(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<h[1-3][^>]*>(.*?)</h[1-3]>', 1), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS h FROM pages")
def first_heading(spark, d):
    return table(spark, d, "pages").select("page_id", tx.first_heading("html").alias("h"))


@query("visible_text")
def visible_text(spark, d):
    return pg.parse_html(table(spark, d, "pages"), "page_id").select("page_id", "visible")


@query("parse_pages")
def parse_pages(spark, d):
    return pg.parse_html(table(spark, d, "pages"), "page_id").select("page_id", F.size("tables").alias("n_tables"), F.length("visible").alias("n_visible"))


@query("parse_bool", "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true WHEN 3 THEN NULL ELSE CASE WHEN p_size % 2 = 1 AND p_size < 2 THEN true END END AS flag FROM part")
def parse_bool(spark, d):
    n = F.col("p_partkey") % 5
    s = F.when(n == 0, " TRUE ").when(n == 1, "no").when(n == 2, "1").when(n == 3, F.concat(F.lit("y"), F.col("p_name"))).otherwise((F.col("p_size") % 2 + F.floor(F.col("p_size") / 2) * 10).cast("string"))
    return table(spark, d, "part").select("p_partkey", tx.parse_bool(F.when((n == 4) & (s == "0"), "").otherwise(s)).alias("flag"))


@query("prediction_roundtrip", f"WITH {P} SELECT vec_id, len(p) AS n, round(list_sum(p) + 1e-9, 6) AS total, round(p[1] + 1e-9, 6) AS first, true AS exact FROM p")
def prediction_roundtrip(spark, d):
    path = new_path(spark, "predictions")
    p = prob(spark, d).select("vec_id", "p")
    names = [f"p{k:03d}" for k in range(10)]
    # The text of a double has as many digits as it takes to read the same double again.
    p.select("vec_id", *[F.col("p")[k].cast("string").alias(n) for k, n in enumerate(names)]).write.option("header", True).option("compression", "gzip").csv(path)
    back = spark.read.option("header", True).schema("vec_id bigint, " + ", ".join(f"{n} double" for n in names)).csv(path)
    j = back.select("vec_id", F.array(*names).alias("q")).join(p, "vec_id")
    return j.select("vec_id", F.size("q").cast("long").alias("n"), r6(F.aggregate("q", F.lit(0.0), lambda a, x: a + x)).alias("total"), r6(F.col("q")[0]).alias("first"), (F.col("p") == F.col("q")).alias("exact"))


@query("to_json_list", "SELECT l_orderkey, '[' || array_to_string(list_sort(list(DISTINCT l_linenumber)), ',') || ']' AS lanes FROM lineitem GROUP BY 1")
def to_json_list(spark, d):
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.to_json(F.sort_array(F.collect_set("l_linenumber"))).alias("lanes"))


# ---- streams


@query("stream_append", "SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_groups FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE value < 0.05)")
def stream_append(spark, d):
    """One file a trigger; a user with a bad row in any file leaves the table with all rows."""
    from gridframe.streaming.acceptance import Acceptance
    from gridframe.streaming.append import stream_files

    root = new_path(spark, "stream")
    ev = table(spark, d, "events").select("event_id", "user_id", "value")
    ev.repartition(3, "event_id").write.parquet(f"{root}/in")
    schema = ", ".join(f"{n} {t}" for n, t in ev.dtypes)
    to = Acceptance(spark, f"{root}/to", "user_id", "event_id", good="value >= 0.05")
    to.start(stream_files(spark, f"{root}/in", schema, 1), f"{root}/state").awaitTermination()
    return to.rows().where("status = 'accepted'").agg(F.count("*").alias("n_rows"), F.countDistinct("user_id").alias("n_groups"))


@query("stream_dedup", "SELECT count(DISTINCT (user_id, event_type, CAST(ts AS DATE))) AS n FROM events")
def stream_dedup(spark, d):
    from gridframe.streaming.append import dedup_stream, stream_files

    root = new_path(spark, "dedup")
    ev = table(spark, d, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), F.to_date("ts").alias("day"))
    ev.write.parquet(f"{root}/in")
    schema = ", ".join(f"{n} {t}" for n, t in ev.dtypes)
    out = dedup_stream(stream_files(spark, f"{root}/in", schema, 10_000), ["user_id", "event_type", "day"], "ts", "60 days")
    out.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/out").agg(F.count("*").alias("n"))
