"""Audits, as-of features, outcomes and snapshots on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridframe.operators import asof
from gridframe.operators import audit as au
from gridframe.operators import outcomes as oc
from gridframe.operators.checks import group_size_issues
from gridframe.plans.registry import query, r6
from gridframe.plans.views import E, H, T, entry, hist
from gridframe.session import table
from gridframe.sources.shared import stored

# ---- audits


@query("ds_summary", "SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_groups, min(CAST(l_shipdate AS DATE)) AS date_min, max(CAST(l_shipdate AS DATE)) AS date_max FROM lineitem")
def ds_summary(spark, d):
    return au.summary(table(spark, d, "lineitem").withColumn("day", F.to_date("l_shipdate")), "l_orderkey", "day")


@query("count_by", "SELECT coalesce(nullif(trim(nullif(l_returnflag, 'N')), ''), '(blank)') AS value, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, value")
def count_by(spark, d):
    return au.count_by(table(spark, d, "lineitem").withColumn("l_returnflag", F.nullif("l_returnflag", F.lit("N"))), "l_returnflag")


@query("groups_by", "SELECT l_returnflag AS value, count(DISTINCT l_orderkey) AS n_groups FROM lineitem GROUP BY 1")
def groups_by(spark, d):
    return au.groups_by(table(spark, d, "lineitem"), "l_returnflag", "l_orderkey")


@query("groups_by_month", "SELECT strftime(o_orderdate, '%Y-%m') AS value, count(DISTINCT o_custkey) AS n_groups FROM orders GROUP BY 1")
def groups_by_month(spark, d):
    return au.groups_by(table(spark, d, "orders"), F.substring(F.date_format("o_orderdate", "yyyy-MM-dd"), 1, 7), "o_custkey")


_GAPS = "SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN text END AS text, CASE WHEN doc_id % 5 <> 0 THEN lang ELSE ' ' END AS lang, source FROM documents"


def _gappy(spark, d):
    return table(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 3 != 0, F.col("text")).alias("text"), F.when(F.col("doc_id") % 5 != 0, F.col("lang")).otherwise(" ").alias("lang"), "source")


@query("top_missing", f"WITH g AS ({_GAPS}), m AS (SELECT 'text' AS \"column\", count(*) FILTER (text IS NULL OR trim(text) = '') AS missing, count(*) AS total FROM g UNION ALL SELECT 'lang', count(*) FILTER (lang IS NULL OR trim(lang) = ''), count(*) FROM g UNION ALL SELECT 'source', count(*) FILTER (source IS NULL OR trim(source) = ''), count(*) FROM g) SELECT \"column\", CAST(missing AS BIGINT) AS missing, round(missing / total * 100, 2) AS rate FROM m WHERE missing > 0 ORDER BY missing DESC, \"column\" LIMIT 10")
def top_missing(spark, d):
    return au.top_missing(_gappy(spark, d), ["doc_id", "text", "lang", "source"])


@query("status_counts", "SELECT count(*) FILTER (l_returnflag = 'R') AS n_r, count(*) FILTER (l_returnflag = 'A') AS n_a, count(*) FILTER (l_returnflag = 'N') AS n_n FROM lineitem")
def status_counts(spark, d):
    return table(spark, d, "lineitem").agg(*[F.count_if(F.col("l_returnflag") == k).alias(f"n_{k.lower()}") for k in "RAN"])


@query("seq_gaps", "SELECT l_orderkey, array_to_string(list_sort(p), '|') AS present, array_to_string(list_filter(range(lo, hi + 1), lambda x: NOT list_contains(p, x)), '|') AS missing FROM (SELECT l_orderkey, list(DISTINCT CAST(l_linenumber AS BIGINT)) AS p, CAST(min(l_linenumber) AS BIGINT) AS lo, CAST(max(l_linenumber) AS BIGINT) AS hi FROM lineitem GROUP BY 1) WHERE len(p) < hi - lo + 1")
def seq_gaps(spark, d):
    return au.sequence_gaps(table(spark, d, "lineitem"), ["l_orderkey"], "l_linenumber")


@query("flag_totals", f"WITH {E} SELECT count(*) FILTER (finish = 1) AS win, count(*) FILTER (finish = 2) AS second, count(*) FILTER (finish <= 3) AS top3, count(*) FILTER (returnflag = 'R') AS returned, count(*) FILTER (linestatus = 'F') AS closed FROM e")
def flag_totals(spark, d):
    rules = {"win": F.col("finish") == 1, "second": F.col("finish") == 2, "top3": F.col("finish") <= 3, "returned": F.col("returnflag") == "R", "closed": F.col("linestatus") == "F"}
    return entry(spark, d, venue=False).agg(*[F.count_if(c).alias(n) for n, c in rules.items()])


@query("audit_long", "SELECT 'rows' AS section, 'all' AS key, CAST(count(*) AS BIGINT) AS value FROM lineitem UNION ALL SELECT 'groups', 'all', count(DISTINCT l_orderkey) FROM lineitem UNION ALL SELECT 'flag', l_returnflag, count(*) FROM lineitem GROUP BY l_returnflag UNION ALL SELECT 'month', strftime(l_shipdate, '%Y-%m'), count(DISTINCT l_orderkey) FROM lineitem GROUP BY 2 UNION ALL SELECT 'duplicates', 'all', CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) FROM lineitem UNION ALL SELECT 'status', l_linestatus, count(*) FROM lineitem GROUP BY 2 UNION ALL SELECT 'missing', 'l_discount', count(*) FROM lineitem WHERE l_discount = 0 UNION ALL SELECT 'missing', 'l_tax', count(*) FROM lineitem WHERE l_tax = 0 UNION ALL SELECT 'gaps', 'all', count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_linenumber) < max(l_linenumber) - min(l_linenumber) + 1) UNION ALL SELECT 'feature', 'large', count(*) FILTER (l_quantity > 25) FROM lineitem UNION ALL SELECT 'feature', 'returned', count(*) FILTER (l_returnflag = 'R') FROM lineitem UNION ALL SELECT 'size', reason, count(*) FROM (SELECT CASE WHEN count(DISTINCT x) = 0 THEN 'missing' WHEN count(DISTINCT x) > 1 THEN 'ambiguous' WHEN abs(max(x) - count(*)) > 1 THEN 'mismatch' END AS reason FROM (SELECT l_orderkey, CASE WHEN l_orderkey % 9 = 0 THEN NULL WHEN l_orderkey % 10 = 0 THEN 3 + l_linenumber % 2 ELSE 4 END AS x FROM lineitem) GROUP BY l_orderkey) WHERE reason IS NOT NULL GROUP BY reason")
def audit_long(spark, d):
    li = table(spark, d, "lineitem")
    one = au.summary(li, "l_orderkey", "l_shipdate").select(F.expr("stack(2, 'rows', n_rows, 'groups', n_groups) AS (section, value)")).withColumn("key", F.lit("all"))
    flags = au.count_by(li, "l_returnflag").select(F.lit("flag").alias("section"), F.col("value").alias("key"), F.col("n").alias("value"))
    months = au.groups_by(li, F.date_format("l_shipdate", "yyyy-MM"), "l_orderkey").select(F.lit("month").alias("section"), F.col("value").alias("key"), F.col("n_groups").alias("value"))
    dup = li.groupBy("l_orderkey", "l_linenumber").count().agg(F.sum(F.col("count") - 1).alias("value")).select(F.lit("duplicates").alias("section"), F.lit("all").alias("key"), "value")
    long = lambda section, rows, key, value: rows.select(F.lit(section).alias("section"), F.col(key).cast("string").alias("key"), F.col(value).cast("long").alias("value"))
    blanks = li.select(F.nullif("l_discount", F.lit(0.0)).alias("l_discount"), F.nullif("l_tax", F.lit(0.0)).alias("l_tax"))
    totals = li.agg(F.count_if(F.col("l_quantity") > 25).alias("large"), F.count_if(F.col("l_returnflag") == "R").alias("returned")).unpivot([], [F.col("large"), F.col("returned")], "key", "value")
    declared = F.when(F.col("l_orderkey") % 9 == 0, F.lit(None)).when(F.col("l_orderkey") % 10 == 0, 3 + F.col("l_linenumber") % 2).otherwise(4)
    sizes = group_size_issues(li.withColumn("declared", declared), "l_orderkey", "declared", report_missing=True).groupBy("reason").agg(F.count("*").alias("n"))
    gaps = au.sequence_gaps(li, ["l_orderkey"], "l_linenumber").agg(F.count("*").alias("n")).withColumn("key", F.lit("all"))
    parts = [flags, months, dup, long("status", au.count_by(li, "l_linestatus"), "value", "n"), long("missing", au.missing_counts(blanks, ["l_discount", "l_tax"]), "column", "missing"), long("gaps", gaps, "key", "n"), long("feature", totals, "key", "value"), long("size", sizes, "reason", "n")]
    for part in parts:
        one = one.unionByName(part)
    return one


_MISS = "discount = 0"


@query("missing_by_group", f"WITH {E} SELECT group_id, count(*) AS total, count(*) FILTER ({_MISS}) AS missing, count(*) FILTER ({_MISS}) / count(*) AS rate, count(*) FILTER ({_MISS} AND returnflag = 'R') AS missing_r, count(*) FILTER ({_MISS} AND returnflag = 'A') AS missing_a, any_value(venue) AS venue, any_value(race_date) AS race_date FROM e GROUP BY group_id HAVING count(*) FILTER ({_MISS}) > 0")
def missing_by_group(spark, d):
    return au.missing_by_group(entry(spark, d), "group_id", F.col("discount") == 0, F.col("returnflag"), ["R", "A"], "lane", ["venue", "race_date"])


@query("missing_rows", f"WITH {E} SELECT group_id, lane, race_date, venue, entity, quantity, price, returnflag FROM e WHERE {_MISS}")
def missing_rows(spark, d):
    return entry(spark, d).where(_MISS).select("group_id", "lane", "race_date", "venue", "entity", "quantity", "price", "returnflag")


@query("missing_breakdown", f"WITH {E}, m AS (SELECT * FROM e WHERE {_MISS}) SELECT 'month' AS dim, strftime(race_date, '%Y-%m') AS value, count(*) AS missing FROM m GROUP BY 2 UNION ALL SELECT 'lane', CAST(lane AS VARCHAR), count(*) FROM m GROUP BY 2 UNION ALL SELECT 'flag', returnflag, count(*) FROM m GROUP BY 2 UNION ALL SELECT 'venue', CAST(venue AS VARCHAR), count(*) FROM m GROUP BY 2")
def missing_breakdown(spark, d):
    dims = {"month": F.date_format("race_date", "yyyy-MM"), "lane": F.col("lane"), "flag": F.col("returnflag"), "venue": F.col("venue")}
    return au.missing_breakdown(entry(spark, d), F.expr(_MISS), dims)


@query("manual_check_topk", f"WITH {E} SELECT group_id, count(*) FILTER ({_MISS} AND returnflag = 'A') AS normal_missing, count(*) FILTER ({_MISS}) AS missing, any_value(race_date) AS race_date FROM e GROUP BY group_id HAVING count(*) FILTER ({_MISS} AND returnflag = 'A') > 0 ORDER BY 2 DESC, 3 DESC, race_date, group_id LIMIT 10")
def manual_check_topk(spark, d):
    m = F.expr(_MISS)
    g = entry(spark, d).groupBy("group_id").agg(F.count_if(m & (F.col("returnflag") == "A")).alias("normal_missing"), F.count_if(m).alias("missing"), F.first("race_date").alias("race_date"))
    return g.where("normal_missing > 0").orderBy(F.desc("normal_missing"), F.desc("missing"), "race_date", "group_id").limit(10)


@query("missing_reason", f"WITH {E}, r AS (SELECT CASE WHEN venue IN (1, 2) THEN 'page_has_none' WHEN race_date < DATE '1996-01-01' THEN 'before_period' ELSE 'needs_check' END AS reason FROM e WHERE {_MISS}) SELECT reason, count(*) AS n FROM r GROUP BY reason")
def missing_reason(spark, d):
    confirmed = table(spark, d, "nation").where("n_nationkey in (1, 2)").select(F.col("n_nationkey").alias("venue"), F.lit(True).alias("ok"))
    m = entry(spark, d).where(_MISS).join(F.broadcast(confirmed), "venue", "left")  # a nation has 25 rows
    reason = F.when(F.col("ok"), "page_has_none").when(F.col("race_date") < F.lit("1996-01-01").cast("date"), "before_period").otherwise("needs_check")
    return m.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query("ledger_summary", "SELECT o_orderstatus AS mode, o_orderpriority AS status, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1, 2")
def ledger_summary(spark, d):
    from gridframe.operators.append import ledger_summary as summary

    o = table(spark, d, "orders").select(F.col("o_orderstatus").alias("mode"), F.col("o_orderpriority").alias("status"), F.col("o_totalprice").alias("total"))
    return summary(o, ["mode", "status"], ["total"]).withColumn("total", F.round("total", 2))


@query("reason_counts", "SELECT reason, count(*) AS n FROM (SELECT unnest(string_split(p_name || ' ' || p_type, ' ')) AS reason FROM part) WHERE reason <> '' GROUP BY reason")
def reason_counts(spark, d):
    return au.reason_counts(table(spark, d, "part").select(F.concat_ws(" ", "p_name", "p_type").alias("r")), "r", " ")


@query("outcome_crosstab", f"WITH {E}, {T} SELECT venue, count(*) FILTER (target_status = 'void') AS n_void, count(*) FILTER (target_status = 'tied') AS n_tied, count(*) FILTER (target_status = 'unique_order') AS n_unique_order, count(*) FILTER (target_status = 'abandoned') AS n_abandoned FROM t GROUP BY venue")
def outcome_crosstab(spark, d):
    t = oc.target_status(entry(spark, d), "group_id", "lane", "finish", least=3, extra=[F.first("venue").alias("venue")])
    return au.crosstab(t, "venue", "target_status", ["void", "tied", "unique_order", "abandoned"])


@query("coverage_funnel", f"WITH {E}, {T}, f AS (SELECT count(*) AS candidates, count(*) FILTER (n >= 3) AS eligible, count(*) FILTER (target_status = 'unique_order') AS scorable, count(*) FILTER (target_status = 'unique_order' AND group_id % 4 <> 0) AS predicted FROM t) SELECT *, round(eligible / candidates + 1e-9, 6) AS eligible_rate, round(scorable / nullif(eligible, 0) + 1e-9, 6) AS scorable_rate, round(predicted / nullif(scorable, 0) + 1e-9, 6) AS predicted_rate FROM f")
def coverage_funnel(spark, d):
    t = oc.target_status(entry(spark, d, venue=False), "group_id", "lane", "finish", least=3)
    clear = F.col("target_status") == "unique_order"
    f = t.agg(F.count("*").alias("candidates"), F.count_if(F.col("n") >= 3).alias("eligible"), F.count_if(clear).alias("scorable"), F.count_if(clear & (F.col("group_id") % 4 != 0)).alias("predicted"))
    rate = lambda a, b: r6(F.col(a) / F.nullif(F.col(b), F.lit(0)))
    return f.withColumns({"eligible_rate": rate("eligible", "candidates"), "scorable_rate": rate("scorable", "eligible"), "predicted_rate": rate("predicted", "scorable")})


def _profile_sql(cols, t):
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, count(*) AS n, count(*) FILTER ({c} IS NULL) AS nulls, count(DISTINCT {c}) AS cardinality, CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM {t}" for c in cols)


@query("value_profile", _profile_sql(["l_quantity", "l_extendedprice", "l_linenumber"], "lineitem"))
def value_profile(spark, d):
    return au.value_profile(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_linenumber"])


@query("pit_audit", "SELECT feature, rule, nulls, CASE WHEN nulls = 0 THEN 'ok' ELSE 'review' END AS verdict FROM (SELECT 'value' AS feature, 'post' AS rule, count(*) FILTER (value IS NULL) AS nulls FROM events UNION ALL SELECT 'user_id', 'pre', count(*) FILTER (user_id IS NULL) FROM events)")
def pit_audit(spark, d):
    rules = spark.createDataFrame([("value", "post"), ("user_id", "pre")], "feature string, rule string")
    p = au.value_profile(table(spark, d, "events"), ["value", "user_id"]).join(F.broadcast(rules), "feature")
    return p.select("feature", "rule", "nulls", F.when(F.col("nulls") == 0, "ok").otherwise("review").alias("verdict"))


@query("venue_rates", f"WITH {E} SELECT venue, count(*) AS n, round(avg(CASE WHEN discount = 0 THEN 1.0 ELSE 0 END) + 1e-9, 6) AS missing_rate, round(avg(CASE WHEN returnflag = 'R' THEN 1.0 ELSE 0 END) + 1e-9, 6) AS returned_rate, round(avg(CASE WHEN finish = 1 THEN 1.0 ELSE 0 END) + 1e-9, 6) AS win_rate FROM e GROUP BY venue")
def venue_rates(spark, d):
    r = au.rate_profile(entry(spark, d), "venue", {"missing_rate": F.col("discount") == 0, "returned_rate": F.col("returnflag") == "R", "win_rate": F.col("finish") == 1})
    return r.select("venue", "n", *[r6(c).alias(c) for c in ("missing_rate", "returned_rate", "win_rate")])


@query("regime_profile", "WITH r AS (SELECT strftime(o_orderdate, '%Y-%m') AS regime, count(*) AS n, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0 END) AS rate FROM orders GROUP BY 1), x AS (SELECT *, rate - lag(rate) OVER (ORDER BY regime) AS delta FROM r) SELECT regime, n, round(rate + 1e-9, 6) AS rate, round(delta + 1e-9, 6) AS delta, coalesce(abs(delta) > 0.0512345, false) AS jump FROM x")
def regime_profile(spark, d):
    o = table(spark, d, "orders").withColumn("regime", F.date_format("o_orderdate", "yyyy-MM"))
    r = au.discontinuities(au.rate_profile(o, "regime", {"rate": F.col("o_orderstatus") == "F"}), "regime", "rate", 0.0512345)
    return r.select("regime", "n", r6("rate").alias("rate"), r6("delta").alias("delta"), "jump")


_BAD_SOURCE = "CASE event_id % 11 WHEN 0 THEN day WHEN 1 THEN day + 1 WHEN 2 THEN NULL ELSE day - 1 - event_id % 3 END"


@query("leakage_canaries", f"WITH {H}, x AS (SELECT *, {_BAD_SOURCE} AS source_day, CASE WHEN event_id % 13 = 0 THEN entity + 1 ELSE entity END AS source_entity, CASE WHEN event_id % 17 = 0 THEN -1 ELSE 1 END AS source_rows, CASE WHEN event_id % 19 = 0 THEN 'payout' ELSE 'history' END AS source_kind FROM h) SELECT unnest(['same_day', 'future_day', 'other_entity', 'negative_rows', 'forbidden_source', 'rows_without_day', 'too_old']) AS rule, unnest([count(*) FILTER (source_day = day), count(*) FILTER (source_day > day), count(*) FILTER (source_entity <> entity), count(*) FILTER (source_rows < 0), count(*) FILTER (source_kind = 'payout'), count(*) FILTER (source_day IS NULL AND source_rows > 0), count(*) FILTER (day - source_day > 3)]) AS rejected FROM x")
def leakage_canaries(spark, d):
    """Rows whose lineage was spoilt on purpose, by rule; the features themselves have none of these (asof_lineage)."""
    k = F.col("event_id")
    source = F.when(k % 11 == 0, F.col("day")).when(k % 11 == 1, F.col("day") + 1).when(k % 11 == 2, F.lit(None)).otherwise(F.col("day") - 1 - k % 3)
    rows = hist(spark, d).withColumns({"source_day": source, "source_entity": F.when(k % 13 == 0, F.col("entity") + 1).otherwise(F.col("entity")), "source_rows": F.when(k % 17 == 0, -1).otherwise(1), "source_kind": F.when(k % 19 == 0, "payout").otherwise("history")})
    rules = {
        "same_day": F.col("source_day") == F.col("day"),
        "future_day": F.col("source_day") > F.col("day"),
        "other_entity": F.col("source_entity") != F.col("entity"),
        "negative_rows": F.col("source_rows") < 0,
        "forbidden_source": F.col("source_kind") == "payout",
        "rows_without_day": F.col("source_day").isNull() & (F.col("source_rows") > 0),
        "too_old": F.col("day") - F.col("source_day") > 3,
    }
    return au.violations(rows, rules)


# ---- as-of features

_PRIOR = "PARTITION BY entity ORDER BY day RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


@query("asof_count", f"WITH {H} SELECT event_id, nullif(count(*) OVER ({_PRIOR}), 0) AS prior_count FROM h")
def asof_count(spark, d):
    return asof.add_counts(hist(spark, d), "entity", "day").select("event_id", "prior_count")


@query("asof_recent5", f"WITH {H}, x AS (SELECT a.event_id, b.value, b.hit, row_number() OVER (PARTITION BY a.event_id ORDER BY b.day DESC, b.ts DESC, b.event_id DESC) AS rn FROM h a LEFT JOIN h b ON a.entity = b.entity AND b.day < a.day) SELECT event_id, nullif(count(value), 0) AS recent_n, round(avg(value) + 1e-9, 6) AS recent_mean, round(avg(hit) + 1e-9, 6) AS recent_rate FROM x WHERE rn <= 5 GROUP BY event_id")
def asof_recent5(spark, d):
    r = asof.add_recent(hist(spark, d), "entity", "day", ["ts", "event_id"], "value", "hit")
    return r.select("event_id", "recent_n", r6("recent_mean").alias("recent_mean"), r6("recent_rate").alias("recent_rate"))


@query("asof_mean_std", f"WITH {H} SELECT event_id, round(avg(value) OVER ({_PRIOR}) + 1e-9, 6) AS prior_mean, round(stddev_pop(value) OVER ({_PRIOR}) + 1e-9, 6) AS prior_std FROM h")
def asof_mean_std(spark, d):
    r = asof.add_mean_std(hist(spark, d), "entity", "day", "value")
    return r.select("event_id", r6("prior_mean").alias("prior_mean"), r6("prior_std").alias("prior_std"))


@query("asof_ctx_count", f"WITH {H} SELECT event_id, CASE WHEN count(*) OVER ({_PRIOR}) > 0 THEN count(*) OVER (PARTITION BY entity, venue ORDER BY day RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS context_count FROM h")
def asof_ctx_count(spark, d):
    return asof.add_context_count(hist(spark, d), "entity", "day", "venue").select("event_id", "context_count")


@query("asof_ewm", f"WITH {H} SELECT a.event_id, round(sum(b.hit * exp(-ln(2) / 90 * (a.day - b.day))) / sum(exp(-ln(2) / 90 * (a.day - b.day))) + 1e-9, 6) AS weighted_rate FROM h a LEFT JOIN h b ON a.entity = b.entity AND b.day < a.day GROUP BY a.event_id")
def asof_ewm(spark, d):
    r = asof.add_weighted_rate(hist(spark, d), "entity", "day", "hit")
    return r.select("event_id", r6("weighted_rate").alias("weighted_rate"))


@query("asof_recency", f"WITH {H} SELECT event_id, day - max(day) OVER ({_PRIOR}) AS days_since FROM h")
def asof_recency(spark, d):
    return asof.add_recency(hist(spark, d), "entity", "day").select("event_id", F.col("days_since").cast("long").alias("days_since"))


@query("asof_lineage", f"WITH {H} SELECT event_id, count(*) OVER ({_PRIOR}) = 0 AS cold_start, max(day) OVER ({_PRIOR}) AS source_day, count(*) OVER ({_PRIOR}) AS source_rows FROM h")
def asof_lineage(spark, d):
    return asof.add_lineage(hist(spark, d), "entity", "day").select("event_id", "cold_start", F.col("source_day").cast("long").alias("source_day"), "source_rows")


@query("derived_profile", f"WITH {H}, x AS (SELECT CAST(nullif(count(*) OVER ({_PRIOR}), 0) AS DOUBLE) AS prior_count, avg(value) OVER ({_PRIOR}) AS prior_mean FROM h), l AS (SELECT 'prior_count' AS feature, prior_count AS v FROM x UNION ALL SELECT 'prior_mean', prior_mean FROM x) SELECT feature, count(v) AS n, count(*) FILTER (v IS NULL) AS cold, round(avg(v) + 1e-9, 6) AS mean, round(stddev_pop(v) + 1e-9, 6) AS std, round(quantile_cont(v, 0.01) + 1e-9, 6) AS p01, round(quantile_cont(v, 0.05) + 1e-9, 6) AS p05, round(quantile_cont(v, 0.5) + 1e-9, 6) AS p50, round(quantile_cont(v, 0.95) + 1e-9, 6) AS p95, round(quantile_cont(v, 0.99) + 1e-9, 6) AS p99 FROM l GROUP BY feature")
def derived_profile(spark, d):
    r = asof.add_mean_std(asof.add_counts(hist(spark, d), "entity", "day"), "entity", "day", "value")
    p = au.derived_profile(r, ["prior_count", "prior_mean"])
    return p.select("feature", "n", "cold", *[r6(c).alias(c) for c in ("mean", "std", "p01", "p05", "p50", "p95", "p99")])


@query("episodes", "WITH x AS (SELECT event_id, user_id, ts, lag(ts) OVER w AS prev FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), s AS (SELECT *, CASE WHEN prev IS NULL OR epoch_us(ts) - epoch_us(prev) > 1800000000 THEN 1 ELSE 0 END AS start FROM x) SELECT event_id, start, CAST(sum(start) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS episode FROM s")
def episodes(spark, d):
    return asof.episodes(hist(spark, d), "entity", "ts", ["event_id"], 1800).select("event_id", "start", "episode")


# ---- outcomes and snapshots


@query("target_status", f"WITH {E}, {T} SELECT group_id, target_status, f1, f2, f3, class_id FROM c")
def target_status(spark, d):
    return oc.target_status(entry(spark, d, venue=False), "group_id", "lane", "finish", least=3).select("group_id", "target_status", "f1", "f2", "f3", "class_id")


@query("target_status_settled", f"WITH {E}, x AS (SELECT *, status <> 'O' AS settled, CASE WHEN group_id % 11 = 0 AND lane = 1 THEN 9 WHEN group_id % 13 = 0 AND lane = 2 THEN NULL ELSE finish END AS place FROM e), g AS (SELECT group_id, min(CASE WHEN settled THEN 1 ELSE 0 END) AS ok, count(*) AS n, count(DISTINCT lane) AS nl, min(lane) AS lo, max(lane) AS hi, count(DISTINCT place) AS np, count(*) FILTER (place IS NULL OR place NOT BETWEEN 1 AND 6) AS outside, max(CASE WHEN place = 1 THEN lane END) AS f1, max(CASE WHEN place = 2 THEN lane END) AS f2, max(CASE WHEN place = 3 THEN lane END) AS f3 FROM x GROUP BY group_id) SELECT group_id, CASE WHEN ok = 0 OR n < 3 OR n <> nl OR lo < 1 OR hi > 6 OR outside > 0 THEN 'void' WHEN np < n THEN 'tied' ELSE 'unique_order' END AS target_status, f1, f2, f3 FROM g")
def target_status_settled(spark, d):
    k = F.col("group_id")
    place = F.when((k % 11 == 0) & (F.col("lane") == 1), 9).when((k % 13 == 0) & (F.col("lane") == 2), F.lit(None)).otherwise(F.col("finish"))
    e = entry(spark, d, venue=False).withColumns({"settled": F.col("status") != "O", "place": place})
    return oc.target_status(e, "group_id", "lane", "place", least=3, settled="settled").select("group_id", "target_status", "f1", "f2", "f3")


def _facts(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("group_id"), F.when(F.col("o_orderkey") % 19 != 0, F.col("o_orderpriority")).alias("priority"), F.when(F.col("o_orderkey") % 21 == 0, " ").otherwise(F.col("o_orderstatus")).alias("clerk"), (F.col("o_orderkey") % 7).alias("place"))
    o = o.where("group_id % 13 <> 0")
    return o.unionByName(o.where("group_id % 17 = 0"))


_FACTS = "f0 AS (SELECT o_orderkey AS group_id, CASE WHEN o_orderkey % 19 <> 0 THEN o_orderpriority END AS priority, CASE WHEN o_orderkey % 21 = 0 THEN ' ' ELSE o_orderstatus END AS clerk, o_orderkey % 7 AS place FROM orders WHERE o_orderkey % 13 <> 0), f AS (SELECT * FROM f0 UNION ALL SELECT * FROM f0 WHERE group_id % 17 = 0), en AS (SELECT l_orderkey AS group_id, l_linenumber AS lane, CASE WHEN l_suppkey % 23 <> 0 THEN l_suppkey END AS entity, CASE WHEN l_partkey % 29 = 0 THEN -1 ELSE l_orderkey % 7 END AS place FROM lineitem WHERE l_orderkey % 31 <> 0)"


def _entries(spark, d):
    li = table(spark, d, "lineitem").where("l_orderkey % 31 <> 0")
    return li.select(F.col("l_orderkey").alias("group_id"), F.col("l_linenumber").alias("lane"), F.when(F.col("l_suppkey") % 23 != 0, F.col("l_suppkey")).alias("entity"), F.when(F.col("l_partkey") % 29 == 0, -1).otherwise(F.col("l_orderkey") % 7).alias("place"))


_LANES = "list_sort(list(DISTINCT CAST(lane AS INTEGER)))"


@query("exclusion_reasons", f"WITH {_FACTS}, a AS (SELECT group_id, count(*) AS facts, count(*) FILTER (priority IS NULL OR trim(priority) = '') AS mp, count(*) FILTER (clerk IS NULL OR trim(clerk) = '') AS mc, any_value(place) AS place FROM f GROUP BY 1), b AS (SELECT group_id, count(*) AS n, {_LANES} AS lanes, count(*) FILTER (entity IS NULL) AS ne, list(DISTINCT place) AS places FROM en GROUP BY 1), j AS (SELECT coalesce(a.group_id, b.group_id) AS group_id, [CASE WHEN facts IS NULL THEN 'missing_facts' END, CASE WHEN facts > 1 THEN 'duplicate_facts' END, CASE WHEN mp > 0 THEN 'missing:priority' END, CASE WHEN mc > 0 THEN 'missing:clerk' END, CASE WHEN coalesce(n, 0) <> 4 THEN 'entry_count' END, CASE WHEN lanes IS NULL OR lanes <> [1, 2, 3, 4] THEN 'lane_set' END, CASE WHEN ne > 0 THEN 'missing_entity' END, CASE WHEN len(list_filter(places, lambda x: x <> place)) > 0 THEN 'identity:place' END] AS r FROM a FULL JOIN b ON a.group_id = b.group_id) SELECT group_id, array_to_string(list_sort(list_filter(r, lambda x: x IS NOT NULL)), '|') AS reasons FROM j")
def exclusion_reasons(spark, d):
    out = oc.exclusion_reasons(_facts(spark, d), _entries(spark, d), "group_id", ["priority", "clerk"], "lane", "entity", ["place"], 4)
    return out.select("group_id", F.array_join("reasons", "|").alias("reasons"))


def _complete_sql(rows, lane_fields, group_fields, lanes):
    own = ", ".join([f"CASE WHEN bool_or({c} IS NULL) THEN 'missing:lane' || lane || ':{c}' END" for c in lane_fields] + ["CASE WHEN count(*) > 1 THEN 'lane_repeated' END"])
    whole = "".join(f", CASE WHEN bool_or(b_{c}) THEN 'missing:{c}' END" for c in group_fields)
    marks = "".join(f", bool_or({c} IS NULL) AS b_{c}" for c in group_fields)
    return f"WITH r AS ({rows}), l AS (SELECT group_id, lane, [{own}] AS own{marks} FROM r GROUP BY group_id, lane), g AS (SELECT group_id, list_concat(flatten(list(own)), [CASE WHEN {_LANES} <> {lanes} THEN 'lane_set' END{whole}]) AS all_ FROM l GROUP BY group_id) SELECT group_id, array_to_string(list_sort(list_distinct(list_filter(all_, lambda x: x IS NOT NULL))), '|') AS reasons FROM g"


_PROGRAM = "SELECT l_orderkey AS group_id, CASE WHEN l_orderkey % 37 = 0 AND l_linenumber = 2 THEN 1 ELSE l_linenumber END AS lane, CASE WHEN l_suppkey % 23 <> 0 THEN l_suppkey END AS racer, CASE WHEN l_partkey % 29 <> 0 THEN l_partkey END AS motor, CASE WHEN l_partkey % 31 <> 0 THEN l_partkey END AS boat, CASE WHEN l_orderkey % 11 <> 0 THEN l_shipdate END AS closed_at FROM lineitem"


@query("program_reasons", _complete_sql(_PROGRAM, ["racer", "motor", "boat"], ["closed_at"], "[1, 2, 3, 4]"))
def program_reasons(spark, d):
    table(spark, d, "lineitem").createOrReplaceTempView("program_lines")
    rows = spark.sql(_PROGRAM.replace("FROM lineitem", "FROM program_lines"))
    return oc.completeness_reasons(rows, "group_id", "lane", ["racer", "motor", "boat"], ["closed_at"], 4).select("group_id", F.array_join("reasons", "|").alias("reasons"))


_LANE_FIELDS = ["weight", "adjust", "exhibition", "tilt", "course", "start_time", "propeller"]
_RACE_FIELDS = ["weather", "wind", "wind_direction", "temperature", "water_temperature", "wave"]
_PREVIEW = "SELECT l_orderkey AS group_id, l_linenumber AS lane, " + ", ".join(f"CASE WHEN (l_partkey + {k}) % {41 + 2 * k} <> 0 THEN l_quantity END AS {c}" for k, c in enumerate(_LANE_FIELDS)) + ", " + ", ".join(f"CASE WHEN (l_orderkey + {k}) % {43 + 2 * k} <> 0 THEN l_tax END AS {c}" for k, c in enumerate(_RACE_FIELDS)) + " FROM lineitem"


@query("preview_reasons", _complete_sql(_PREVIEW, _LANE_FIELDS, _RACE_FIELDS, "[1, 2, 3, 4]"))
def preview_reasons(spark, d):
    table(spark, d, "lineitem").createOrReplaceTempView("preview_lines")
    rows = spark.sql(_PREVIEW.replace("FROM lineitem", "FROM preview_lines"))
    return oc.completeness_reasons(rows, "group_id", "lane", _LANE_FIELDS, _RACE_FIELDS, 4).select("group_id", F.array_join("reasons", "|").alias("reasons"))


_ELIG = f"""{E}, {T}, m AS (SELECT group_id, count(*) FILTER (x IS NULL) AS mx FROM (SELECT group_id, CASE WHEN equipment % 50 <> 0 THEN equipment END AS x FROM e) GROUP BY group_id),
el AS (SELECT t.group_id, venue, target_status, list_sort(list_filter([CASE WHEN mx > 0 THEN 'missing:part' END, CASE WHEN n < 3 THEN 'entry_count' END, CASE WHEN n <> n_lanes THEN 'lane_repeated' END, CASE WHEN max_lane > 6 THEN 'lane_range' END], lambda r: r IS NOT NULL)) AS why FROM t JOIN m USING (group_id)),
ev AS (SELECT group_id, venue, target_status, len(why) = 0 AS eligible, len(why) = 0 AND target_status = 'unique_order' AS main, array_to_string(list_sort(list_filter(list_concat(why, [CASE WHEN target_status <> 'unique_order' THEN 'target_' || target_status END]), lambda r: r IS NOT NULL)), '|') AS reasons FROM el)"""


def _snapshot(spark, d):
    e = entry(spark, d).withColumn("part", F.when(F.col("equipment") % 50 != 0, F.col("equipment")))
    return oc.build_snapshot(e, "group_id", "lane", "finish", ["venue"], ["entity", "price"], ["part"], store=stored)


@query("eligibility", f"WITH {_ELIG} SELECT * FROM ev")
def eligibility(spark, d):
    return _snapshot(spark, d)["eligibility"]


@query("snapshot_tables", f"WITH {_ELIG} SELECT 'group_features' AS name, count(*) AS n FROM ev WHERE eligible UNION ALL SELECT 'entry_features', count(*) FROM e JOIN ev USING (group_id) WHERE eligible UNION ALL SELECT 'targets', count(*) FROM ev WHERE eligible UNION ALL SELECT 'auxiliary', count(*) FROM e JOIN ev USING (group_id) WHERE eligible UNION ALL SELECT 'eligibility', count(*) FROM ev")
def snapshot_tables(spark, d):
    out = None
    for name, t in _snapshot(spark, d).items():
        one = t.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


_OK = f"{_ELIG}, el2 AS (SELECT * FROM ev), tg AS (SELECT c.group_id, c.target_status, class_id FROM c JOIN ev USING (group_id) WHERE eligible), bt AS (SELECT group_id, CASE WHEN group_id % 5 = 0 THEN 'void' ELSE target_status END AS target_status, CASE WHEN group_id % 7 = 0 THEN NULL ELSE class_id END AS class_id FROM tg WHERE group_id % 11 <> 0 UNION ALL SELECT group_id, target_status, class_id FROM tg WHERE group_id % 13 = 0 AND group_id % 11 <> 0 UNION ALL SELECT -1 - group_id, target_status, class_id FROM tg WHERE group_id % 17 = 0)"


@query(
    "snapshot_checks",
    f"""WITH {_OK}, dup AS (SELECT count(*) AS n FROM (SELECT group_id FROM bt GROUP BY 1 HAVING count(*) > 1))
SELECT 'eligibility_unique' AS check_name, CAST(0 AS BIGINT) AS issues UNION ALL SELECT 'targets_unique', n FROM dup UNION ALL SELECT 'entries_unique', count(*) FROM (SELECT group_id, lane FROM e JOIN ev USING (group_id) WHERE eligible AND group_id % 19 = 0 GROUP BY 1, 2)
UNION ALL SELECT 'targets_missing', count(*) FROM ev WHERE eligible AND group_id % 11 = 0 UNION ALL SELECT 'targets_extra', count(*) FROM bt WHERE group_id < 0
UNION ALL SELECT 'class_of_unclear', count(*) FROM bt WHERE target_status <> 'unique_order' AND class_id IS NOT NULL UNION ALL SELECT 'class_missing', count(*) FROM bt WHERE target_status = 'unique_order' AND class_id IS NULL
UNION ALL SELECT 'main_not_eligible', count(*) FROM ev WHERE NOT eligible AND group_id % 2 = 0 UNION ALL SELECT 'auxiliary_keys', count(*) FROM ev WHERE eligible AND group_id % 23 = 0""",
)
def snapshot_checks(spark, d):
    """A snapshot that was damaged on purpose: each check finds the rows that were changed."""
    t = _snapshot(spark, d)
    k = F.col("group_id")
    tg = t["targets"].select("group_id", "target_status", "class_id")
    kept = tg.where("group_id % 11 <> 0")
    bad = kept.select("group_id", F.when(k % 5 == 0, "void").otherwise(F.col("target_status")).alias("target_status"), F.when(k % 7 != 0, F.col("class_id")).alias("class_id"))
    bad = bad.unionByName(kept.where("group_id % 13 = 0")).unionByName(tg.where("group_id % 17 = 0").withColumn("group_id", -1 - k))
    ef = t["entry_features"]
    damaged = t | {
        "targets": bad,
        "entry_features": ef.unionByName(ef.where("group_id % 19 = 0")),
        "eligibility": t["eligibility"].withColumn("main", F.when(~F.col("eligible") & (k % 2 == 0), True).otherwise(F.col("main"))),
        "auxiliary": t["auxiliary"].where("group_id % 23 <> 0"),
    }
    return oc.snapshot_issues(damaged, "group_id", "lane")


@query("snapshot_profile", f"WITH {_ELIG}, dm AS (SELECT unnest(['void', 'tied', 'unique_order', 'abandoned']) AS target_status) SELECT target_status, count(group_id) AS n, count(*) FILTER (eligible) AS eligible, count(*) FILTER (main) AS main FROM dm LEFT JOIN ev USING (target_status) GROUP BY target_status")
def snapshot_profile(spark, d):
    domain = spark.range(1).select(F.explode(F.array(*map(F.lit, ["void", "tied", "unique_order", "abandoned"]))).alias("target_status"))
    g = _snapshot(spark, d)["eligibility"].groupBy("target_status").agg(F.count("*").alias("n"), F.count_if("eligible").alias("eligible"), F.count_if("main").alias("main"))
    return domain.join(g, "target_status", "left").select("target_status", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "eligible", "main")])


@query("outcome_class", f"WITH {E}, g AS (SELECT group_id, count(*) FILTER (finish = 1) AS n1, count(*) FILTER (finish = 2) AS n2, count(*) FILTER (finish = 3) AS n3, count(*) AS n, count(DISTINCT CASE WHEN finish BETWEEN 1 AND 6 THEN finish END) AS places FROM e GROUP BY group_id) SELECT group_id, CASE WHEN greatest(n1, n2, n3) > 1 THEN 'tied' WHEN n1 = 1 AND n2 = 1 AND n3 = 1 AND n = 6 AND places = 6 THEN 'unique_order' WHEN n1 = 1 AND n2 = 1 AND n3 = 1 THEN 'unique_top3_abnormal' ELSE 'void' END AS outcome FROM g")
def outcome_class(spark, d):
    return oc.outcome_class(entry(spark, d, venue=False), "group_id", "lane", "finish")


_COMBO = "CAST(l_linenumber AS VARCHAR) || '-' || (l_suppkey % 7 + 1) || '-' || (l_partkey % 6 + 1)"


@query("combo_norm", f"WITH x AS (SELECT l_orderkey, regexp_extract_all({_COMBO}, '[1-6]') AS g, l_discount FROM lineitem) SELECT l_orderkey, array_to_string(list_sort(list_distinct(list(array_to_string(g, '-')) FILTER (len(g) = 3 AND len(list_distinct(g)) = 3 AND l_discount > 0))), '|') AS combos FROM x GROUP BY l_orderkey HAVING count(*) FILTER (len(g) = 3 AND len(list_distinct(g)) = 3 AND l_discount > 0) > 0")
def combo_norm(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", F.expr(_COMBO.replace("VARCHAR", "STRING")).alias("combo"), F.when(F.col("l_discount") > 0, F.col("l_discount")).alias("amount"))
    return oc.payout_combinations(li, "l_orderkey", "combo", "amount").where(F.size("combos") > 0).select("l_orderkey", F.array_join("combos", "|").alias("combos"))


@query("scorable", f"WITH {E}, {T}, x AS (SELECT group_id, n >= 4 AS eligible, target_status, CASE WHEN group_id % 5 = 0 THEN 'x' ELSE f1 || '-' || f2 || '-' || f3 END AS paid, f1 || '-' || f2 || '-' || f3 AS expected FROM t) SELECT group_id, coalesce(eligible AND target_status = 'unique_order' AND paid = expected, false) AS scorable FROM x")
def scorable(spark, d):
    t = oc.target_status(entry(spark, d, venue=False), "group_id", "lane", "finish", least=3)
    label = F.concat_ws("-", "f1", "f2", "f3")
    x = t.select("group_id", (F.col("n") >= 4).alias("eligible"), F.col("target_status").alias("outcome"), label.alias("expected"), F.array(F.when(F.col("group_id") % 5 == 0, "x").otherwise(label)).alias("combos"))
    return oc.scorable(x, "eligible", "outcome", "expected", "combos").select("group_id", "scorable")


@query("universe_roles", f"WITH {E}, {T}, u AS (SELECT CASE target_status WHEN 'unique_order' THEN 'U0' WHEN 'tied' THEN 'U1' ELSE 'U2' END AS role, venue < 10 AS equipment, race_date >= DATE '1999-01-01' AS temporal FROM t) SELECT role, count(*) AS n, count(*) FILTER (equipment) AS equipment, count(*) FILTER (temporal) AS temporal FROM u GROUP BY role")
def universe_roles(spark, d):
    t = oc.target_status(entry(spark, d), "group_id", "lane", "finish", least=3, extra=[F.first("venue").alias("venue"), F.first("race_date").alias("race_date")])
    role = F.when(F.col("target_status") == "unique_order", "U0").when(F.col("target_status") == "tied", "U1").otherwise("U2")
    return t.groupBy(role.alias("role")).agg(F.count("*").alias("n"), F.count_if(F.col("venue") < 10).alias("equipment"), F.count_if(F.col("race_date") >= F.lit("1999-01-01").cast("date")).alias("temporal"))


@query("lane_sorted", f"WITH {E}, l AS (SELECT group_id, coalesce(CASE WHEN lane <= 6 THEN lane END, 99) AS k, entity, price FROM e) SELECT group_id, array_to_string(list(k ORDER BY k, entity, price), '|') AS lanes, array_to_string(list(entity ORDER BY k, entity, price), '|') AS entities FROM l GROUP BY group_id")
def lane_sorted(spark, d):
    k = F.coalesce(F.when(F.col("lane") <= 6, F.col("lane")), F.lit(99))
    g = entry(spark, d, venue=False).groupBy("group_id").agg(F.array_sort(F.collect_list(F.struct(k.alias("k"), "entity", "price"))).alias("s"))
    return g.select("group_id", F.array_join("s.k", "|").alias("lanes"), F.array_join("s.entity", "|").alias("entities"))
