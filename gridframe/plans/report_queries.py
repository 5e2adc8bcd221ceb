"""Report sinks, refits and calibration on rows of their own, qualification by population, error profiles by family."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridframe.functions import orders as om
from gridframe.functions import text as tx
from gridframe.operators import outcomes as oc
from gridframe.operators import scoring as sc
from gridframe.plans.more_queries import _LEASTS, _REFIT, _TAUS
from gridframe.plans.registry import query, r6
from gridframe.plans.scoring_queries import _L, _targets
from gridframe.plans.views import E, T, entry, prob
from gridframe.session import table
from gridframe.sources import contracts as src
from gridframe.sources.shared import new_path, stored


@query(
    "report_sinks",
    """WITH m AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 6 = 0 THEN 1 ELSE 0 END AS part, CASE WHEN l_discount = 0 THEN 1 ELSE 0 END AS discount FROM lineitem WHERE l_partkey % 6 = 0 OR l_discount = 0),
p AS (SELECT CAST(o_orderdate AS DATE) AS day, o_custkey % 5 AS wave, count(*) AS jobs FROM orders GROUP BY 1, 2)
SELECT 'missing' AS report, count(*) AS n_rows, CAST(sum(part) AS BIGINT) AS total, true AS in_order, true AS equal FROM m UNION ALL SELECT 'plan', count(*), CAST(sum(jobs) AS BIGINT), true, true FROM p""",
)
def report_sinks(spark, d):
    """The report of rows with missing fields and the plan by day and wave: written, read back and compared, totals from their manifests."""
    li, o = table(spark, d, "lineitem"), table(spark, d, "orders")
    missing = li.where("l_partkey % 6 = 0 or l_discount = 0").select("l_orderkey", "l_linenumber", F.when(F.col("l_partkey") % 6 == 0, 1).otherwise(0).alias("part"), F.when(F.col("l_discount") == 0, 1).otherwise(0).alias("discount"))
    plan = o.groupBy(F.to_date("o_orderdate").alias("day"), (F.col("o_custkey") % 5).alias("wave")).agg(F.count("*").alias("jobs"))
    out = []
    for name, rows, order, total in (("missing", missing, ["l_orderkey", "l_linenumber"], "part"), ("plan", plan, ["day", "wave"], "jobs")):
        path = new_path(spark, f"report-{name}")
        src.write_report(rows.limit(0), path, order)  # an older report, which the next one replaces
        manifest = src.write_report(rows, path, order, {"total": F.sum(total)})
        back = src.read_report(spark, path)
        typed = back.select(*[F.col(c).cast(t).alias(c) for c, t in rows.dtypes], "_at")
        equal = not typed.drop("_at").exceptAll(rows).limit(1).count() and not rows.exceptAll(typed.drop("_at")).limit(1).count()
        # Each file is in order and begins where the one before it ended or later.
        span = typed.groupBy("_at.file").agg(F.min(F.struct(*order)).alias("a"), F.max(F.struct(*order)).alias("b"), F.min_by(F.struct(*order), "_at.row").alias("first"), F.max_by(F.struct(*order), "_at.row").alias("last")).orderBy("file").collect()
        ordered = all(s.a == s.first and s.b == s.last for s in span) and all(x.b <= y.a for x, y in zip(span, span[1:], strict=False))
        out.append((name, manifest["rows"], manifest["total"], ordered, equal))
    return spark.createDataFrame(out, "report string, n_rows long, total long, in_order boolean, equal boolean")


@query(
    "grid_refit_probs",
    f"""WITH {_REFIT.rsplit(' SELECT ordinal, tau, least, round(sum', 1)[0]}, best AS (SELECT tau, least FROM (SELECT ordinal, tau, least, sum(se.n * -ln(p)) / sum(se.n) AS loss FROM se JOIN z USING (venue, class_id) GROUP BY 1, 2, 3) ORDER BY loss, ordinal LIMIT 1),
al AS (SELECT venue, class_id, count(*) AS n FROM k GROUP BY 1, 2), wa AS (SELECT dm.class_id, coalesce(sum(n), 0) AS w FROM (SELECT CAST(range AS INTEGER) AS class_id FROM range(120)) dm LEFT JOIN al ON al.class_id = dm.class_id GROUP BY 1), sa AS (SELECT venue, sum(n) AS size FROM al GROUP BY 1)
SELECT tau, least, sa.venue, wa.class_id, round(CASE WHEN size >= least THEN (coalesce(al.n, 0) + tau * ((w + tau / 120) / ((SELECT sum(n) FROM al) + tau))) / (size + tau) ELSE (w + tau / 120) / ((SELECT sum(n) FROM al) + tau) END + 1e-9, 6) AS p
FROM best CROSS JOIN sa CROSS JOIN wa LEFT JOIN al ON al.venue = sa.venue AND al.class_id = wa.class_id""",
)
def grid_refit_probs(spark, d):
    """The frequencies refitted on training and selection rows with the parameters that the selection rows chose."""
    t = stored(_targets(spark, d).groupBy("venue", "class_id", (F.col("group_id") % 3 == 0).alias("chosen")).agg(F.count("*").alias("n")), "split")
    _, refit = sc.grid_refit(t.where("not chosen"), t.where("chosen"), "venue", "class_id", om.class_table(spark), _TAUS, _LEASTS, "n")
    return refit.select("tau", "least", "venue", "class_id", r6("p").alias("p"))


_TEMPS = [0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 5.0]


@query(
    "calibrated_eval",
    f"""WITH {_L}, t AS (SELECT CAST(unnest({_TEMPS}) AS DOUBLE) AS t), f AS (SELECT t, avg(-ln(pow(pa, 1 / t) / list_sum(list_transform(p, lambda x: pow(x, 1 / t))))) AS loss FROM l CROSS JOIN t WHERE vec_id % 2 = 0 GROUP BY t), b AS (SELECT t FROM f ORDER BY loss, t LIMIT 1),
e AS (SELECT CAST(vec_id % 3 AS BIGINT) AS fold, b.t, -ln(pa) AS raw, -ln(pow(pa, 1 / b.t) / list_sum(list_transform(p, lambda x: pow(x, 1 / b.t)))) AS cal FROM l CROSS JOIN b WHERE vec_id % 2 = 1)
SELECT fold, t AS temperature, count(*) AS n, round(avg(raw) + 1e-9, 6) AS raw_loss, round(avg(cal) + 1e-9, 6) AS calibrated_loss, CASE WHEN avg(cal) < avg(raw) THEN 'calibrated' ELSE 'raw' END AS winner FROM e GROUP BY 1, 2""",
)
def calibrated_eval(spark, d):
    """A temperature fitted on calibration rows and applied to evaluation rows, by fold, against raw probabilities."""
    p = prob(spark, d).where("label between 0 and 9")
    best, out = sc.calibrate(p.where("vec_id % 2 = 0"), p.where("vec_id % 2 = 1"), "p", "label", _TEMPS)
    g = out.groupBy((F.col("vec_id") % 3).alias("fold"), F.lit(best).alias("temperature")).agg(F.count("*").alias("n"), F.avg("raw_loss").alias("r"), F.avg("calibrated_loss").alias("c"))
    return g.select("fold", "temperature", "n", r6("r").alias("raw_loss"), r6("c").alias("calibrated_loss"), F.when(F.col("c") < F.col("r"), "calibrated").otherwise("raw").alias("winner"))


@query(
    "qualification_report",
    """WITH e AS (SELECT vec_id, CASE WHEN vec_id % 4 = 3 THEN 'side' ELSE 'main' END AS population FROM embeddings WHERE vec_id % 10 <> 0),
g AS (SELECT vec_id, CASE WHEN vec_id % 11 = 0 THEN 'length' WHEN vec_id % 13 = 0 THEN 'blank' WHEN vec_id % 17 = 0 THEN 'not finite' WHEN vec_id % 19 = 0 THEN 'outside [0,1]' WHEN vec_id % 23 = 0 THEN 'sum' END AS fault FROM embeddings WHERE vec_id % 9 <> 0 UNION ALL SELECT vec_id, NULL FROM embeddings WHERE vec_id % 29 = 0 AND vec_id % 9 <> 0),
r AS (SELECT vec_id, count(*) AS n, min(fault) AS fault FROM g GROUP BY 1), j AS (SELECT e.vec_id AS ek, r.vec_id AS rk, population, n, fault FROM e FULL JOIN r ON e.vec_id = r.vec_id),
a AS (SELECT population, count(ek) AS expected, count(*) FILTER (ek IS NOT NULL AND rk IS NOT NULL) AS covered, count(*) FILTER (ek IS NOT NULL AND rk IS NULL) AS missing, count(*) FILTER (ek IS NULL) AS extra, count(*) FILTER (ek IS NOT NULL AND n > 1) AS repeated, count(*) FILTER (ek IS NOT NULL AND n = 1 AND fault IS NULL) AS valid,
 count(*) FILTER (fault = 'length') AS f0, count(*) FILTER (fault = 'blank') AS f1, count(*) FILTER (fault = 'not finite') AS f2, count(*) FILTER (fault = 'outside [0,1]') AS f3, count(*) FILTER (fault = 'sum') AS f4 FROM j GROUP BY 1),
x AS (SELECT *, array_to_string(list_filter([CASE WHEN missing > 0 THEN 'missing:' || missing END, CASE WHEN extra > 0 THEN 'extra:' || extra END, CASE WHEN repeated > 0 THEN 'repeated:' || repeated END, CASE WHEN f0 > 0 THEN 'length:' || f0 END, CASE WHEN f1 > 0 THEN 'blank:' || f1 END, CASE WHEN f2 > 0 THEN 'not finite:' || f2 END, CASE WHEN f3 > 0 THEN 'outside [0,1]:' || f3 END, CASE WHEN f4 > 0 THEN 'sum:' || f4 END], lambda v: v IS NOT NULL), '|') AS errors FROM a)
SELECT population, expected, covered, missing, extra, repeated, valid, errors, errors <> '' AS disqualified FROM x""",
)
def qualification_report(spark, d):
    """Predictions with every fault, held against the keys of two populations."""
    k = F.col("vec_id")
    expected = table(spark, d, "embeddings").where("vec_id % 10 <> 0").select("vec_id", F.when(k % 4 == 3, "side").otherwise("main").alias("population"))
    p = prob(spark, d).where("vec_id % 9 <> 0").select("vec_id", "p")
    first = lambda x: F.transform("p", lambda v, i: F.when(i == 0, x).otherwise(v))
    shift = F.transform("p", lambda v, i: F.when(i == 0, F.lit(1.5)).otherwise(v))
    bad = F.when(k % 11 == 0, F.slice("p", 1, 9)).when(k % 13 == 0, first(F.lit(None).cast("double"))).when(k % 17 == 0, first(F.lit(float("nan")))).when(k % 19 == 0, shift).when(k % 23 == 0, F.transform("p", lambda v: v / 2)).otherwise(F.col("p"))
    given = p.select("vec_id", bad.alias("p")).unionByName(p.where("vec_id % 29 = 0"))
    return sc.qualify(given, expected, "vec_id", "p", 10, "population")


_FAMILIES = {"price": "l_extendedprice", "size": "l_quantity", "discount": "CASE WHEN l_discount > 0.01 THEN l_discount END"}
_CUTS = "[0.2, 0.4, 0.6, 0.8]"


@query(
    "error_families",
    "WITH li AS (SELECT l_orderkey, l_tax AS loss, "
    + ", ".join(f"{x} AS {n}" for n, x in _FAMILIES.items())
    + " FROM lineitem), ed AS (SELECT "
    + ", ".join(f"list_distinct(quantile_cont({n}, {_CUTS})) AS e_{n}" for n in _FAMILIES)
    + " FROM li WHERE l_orderkey % 2 = 0), bn AS ("
    + " UNION ALL ".join(f"SELECT '{n}' AS family, l_orderkey % 3 AS fold, CASE WHEN {n} IS NULL THEN -1 ELSE CAST(len(list_filter(e_{n}, lambda e: e <= {n})) AS INTEGER) END AS bin, loss FROM li CROSS JOIN ed" for n in _FAMILIES)
    + ") SELECT family, CAST(fold AS BIGINT) AS fold, bin, count(*) AS support, round(avg(loss) + 1e-9, 6) AS loss, round(avg(loss) - (SELECT avg(loss) FROM li) + 1e-9, 6) AS delta FROM bn GROUP BY 1, 2, 3",
)
def error_families(spark, d):
    """Mean loss by family of features, fold and bin; bins of a family are fitted on training rows. One pass for all families."""
    li = table(spark, d, "lineitem").select("l_orderkey", F.col("l_tax").alias("loss"), *[F.expr(x).alias(n) for n, x in _FAMILIES.items()])
    train, rows = li.where("l_orderkey % 2 = 0"), li
    for n in _FAMILIES:
        edges = sc.quantile_edges(train, n, 5).select(F.col("edges").alias(f"e_{n}"))
        rows = rows.join(F.broadcast(edges))  # one row of edges
    binned = [F.struct(F.lit(n).alias("family"), sc.bin_of(n, f"e_{n}").alias("bin")) for n in _FAMILIES]
    g = rows.select("l_orderkey", "loss", F.explode(F.array(*binned)).alias("b")).groupBy("b.family", (F.col("l_orderkey") % 3).alias("fold"), "b.bin").agg(F.count("*").alias("support"), F.avg("loss").alias("l"))
    return g.join(F.broadcast(li.agg(F.avg("loss").alias("base")))).select("family", "fold", "bin", "support", r6("l").alias("loss"), r6(F.col("l") - F.col("base")).alias("delta"))


@query("snapshot_ranges", f"WITH {E}, {T}, ev AS (SELECT * FROM t WHERE n >= 3 AND n = n_lanes AND max_lane <= 6) SELECT 'groups' AS name, count(*) AS n_rows, min(race_date) AS date_min, max(race_date) AS date_max, CAST(count(DISTINCT race_date) AS BIGINT) AS n_dates FROM ev UNION ALL SELECT 'entries', count(*), min(e.race_date), max(e.race_date), CAST(count(DISTINCT e.race_date) AS BIGINT) FROM e JOIN ev USING (group_id) UNION ALL SELECT 'eligibility', count(*), min(race_date), max(race_date), CAST(count(DISTINCT race_date) AS BIGINT) FROM t")
def snapshot_ranges(spark, d):
    """Rows and dates of a snapshot's tables."""
    t = oc.build_snapshot(entry(spark, d), "group_id", "lane", "finish", ["venue", "race_date"], ["entity", "race_date"], [], store=stored)
    out = None
    for name, source in (("groups", "group_features"), ("entries", "entry_features"), ("eligibility", "eligibility")):
        one = t[source].agg(F.count("*").alias("n_rows"), F.min("race_date").alias("date_min"), F.max("race_date").alias("date_max"), F.countDistinct("race_date").alias("n_dates")).select(F.lit(name).alias("name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@query("data_attribute", r"SELECT page_id, CASE page_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'n' || page_id ELSE 'url ' || coalesce(url, '') END AS v FROM pages")
def data_attribute(spark, d):
    """An attribute put before each page: none, in single quotes, in double quotes and with white space around it."""
    n, k = F.col("page_id"), F.col("page_id").cast("string")
    tag = F.when(n % 3 == 0, "<div data-idx='x' data-id=bare>").when(n % 3 == 1, F.concat(F.lit("<div DATA-ID='n"), k, F.lit("' data-id='later'>"))).otherwise(F.concat(F.lit('<div class="a" data-id=" url  '), F.coalesce("url", F.lit("")), F.lit('\n">')))
    return table(spark, d, "pages").select("page_id", tx.data_attribute(F.concat(tag, F.coalesce("html", F.lit(""))), "id").alias("v"))
