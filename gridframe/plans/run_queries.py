"""Scans over hot keys, features in daily runs, streams with quarantine, snapshot validation and restorable appends."""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridframe.operators import asof, daily, validation
from gridframe.plans.audit_queries import _ELIG, _PRIOR, _snapshot
from gridframe.plans.registry import query, r6
from gridframe.plans.views import H, hist
from gridframe.session import table
from gridframe.sources import shared
from gridframe.sources.shared import dealt, new_path, stored

# ---- intervals

_DAYS = "SELECT unnest([19723, 19727, 19732, 19738, 19745]) AS d"
_LATEST = """j AS (SELECT h.event_id, h.day, iv.interval_id, iv.end_day, row_number() OVER (PARTITION BY h.event_id ORDER BY iv.start_day DESC) AS rn FROM h LEFT JOIN (SELECT * FROM iv WHERE grade <> 'C') iv ON {on} AND iv.start_day < h.day),
x AS (SELECT event_id, interval_id IS NULL AS none, CASE WHEN end_day IS NULL OR end_day >= day THEN interval_id END AS interval_id FROM j WHERE rn = 1)
SELECT event_id, interval_id, interval_id IS NOT NULL AS verified, CASE WHEN interval_id IS NOT NULL THEN 'verified' WHEN none THEN 'no_earlier_interval' ELSE 'interval_ended' END AS reason FROM x"""


def _verified(spark, d, keys: dict):
    h = hist(spark, d).select("event_id", "day", *[c.alias(k) for k, c in keys.items()])
    d_ = F.col("d")
    iv = h.select(*keys).distinct().withColumn("d", F.explode(F.array(*[F.lit(x) for x in (19723, 19727, 19732, 19738, 19745)])))
    grade = F.when(d_ % 3 == 0, "A").when(d_ % 3 == 1, "B").otherwise("C")
    iv = iv.select(*keys, d_.alias("start_day"), F.when(d_ % 2 == 0, d_ + 3).alias("end_day"), F.concat_ws("_", *keys, d_).alias("interval_id"), grade.alias("grade"))
    return asof.verified_interval(h, iv, list(keys), "day", "start_day", "end_day", "grade", ["A", "B"]).select("event_id", "interval_id", "verified", "reason")


@query("interval_one_key", f"WITH {H}, iv AS (SELECT d AS start_day, CASE WHEN d % 2 = 0 THEN d + 3 END AS end_day, concat_ws('_', 0, d) AS interval_id, CASE d % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS grade FROM ({_DAYS})), {_LATEST.format(on='true')}")
def interval_one_key(spark, d):
    """All rows have one key, which is in as many ranges as its rows need."""
    return _verified(spark, d, {"venue": F.lit(0)})


@query("interval_two_keys", f"WITH {H}, iv AS (SELECT venue, event_type, d AS start_day, CASE WHEN d % 2 = 0 THEN d + 3 END AS end_day, concat_ws('_', venue, event_type, d) AS interval_id, CASE d % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS grade FROM (SELECT DISTINCT venue, event_type FROM h), ({_DAYS})), {_LATEST.format(on='h.venue = iv.venue AND h.event_type = iv.event_type')}")
def interval_two_keys(spark, d):
    return _verified(spark, d, {"venue": F.col("venue"), "event_type": F.col("event_type")})


# ---- features in runs

_ROLES = daily.Roles("event_id", "entity", "day", ["ts", "event_id"], "value", "hit", "venue")
_ASOF_SQL = f"""WITH {H}, r AS (SELECT a.event_id, b.value, b.hit, row_number() OVER (PARTITION BY a.event_id ORDER BY b.day DESC, b.ts DESC, b.event_id DESC) AS rn FROM h a LEFT JOIN h b ON a.entity = b.entity AND b.day < a.day),
r5 AS (SELECT event_id, nullif(count(value), 0) AS recent_n, round(avg(value) + 1e-9, 6) AS recent_mean, round(avg(hit) + 1e-9, 6) AS recent_rate FROM r WHERE rn <= 5 GROUP BY event_id),
w AS (SELECT a.event_id, round(sum(b.hit * exp(-ln(2) / 90 * (a.day - b.day))) / sum(exp(-ln(2) / 90 * (a.day - b.day))) + 1e-9, 6) AS weighted_rate FROM h a LEFT JOIN h b ON a.entity = b.entity AND b.day < a.day GROUP BY a.event_id),
p AS (SELECT event_id, nullif(count(*) OVER ({_PRIOR}), 0) AS prior_count, round(avg(value) OVER ({_PRIOR}) + 1e-9, 6) AS prior_mean, round(stddev_pop(value) OVER ({_PRIOR}) + 1e-9, 6) AS prior_std,
 day - max(day) OVER ({_PRIOR}) AS days_since, count(*) OVER ({_PRIOR}) = 0 AS cold_start, max(day) OVER ({_PRIOR}) AS source_day, count(*) OVER ({_PRIOR}) AS source_rows,
 CASE WHEN count(*) OVER ({_PRIOR}) > 0 THEN count(*) OVER (PARTITION BY entity, venue ORDER BY day RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS context_count FROM h)
SELECT * FROM p JOIN r5 USING (event_id) JOIN w USING (event_id)"""
_FEATURES = "prior_count recent_n recent_mean recent_rate prior_mean prior_std weighted_rate days_since cold_start source_day source_rows context_count".split()
_ROUNDED = {"recent_mean", "recent_rate", "prior_mean", "prior_std", "weighted_rate"}


def _rounded(rows):
    return rows.select("event_id", *[r6(c).alias(c) if c in _ROUNDED else F.col(c) for c in _FEATURES])


@query("asof_at_once", _ASOF_SQL)
def asof_at_once(spark, d):
    """All history as one run without a state before it: no task holds an entity's rows."""
    rows = hist(spark, d).drop("date")
    return _rounded(daily.features(rows, daily.day_sums(rows, _ROLES), daily.context_sums(rows, _ROLES), _ROLES))


@query("asof_in_runs", _ASOF_SQL)
def asof_in_runs(spark, d):
    """Chunks in any order, one of them twice, and one that comes late for days that were worked on."""
    rows = hist(spark, d).drop("date")
    run = daily.DailyFeatures(spark, new_path(spark, "daily"), _ROLES, 15)
    early, late = rows.where("day < 19735"), rows.where("day >= 19735")
    for name, part in (("b", early.where("event_id % 3 = 1")), ("a", early.where("event_id % 3 = 0")), ("b", early.where("event_id % 3 = 1"))):
        run.add(name, part)
    run.run()
    run.add("d", late)
    run.add("c", early.where("event_id % 3 = 2 and day >= 19729"))
    run.run()
    run.add("e", early.where("event_id % 3 = 2 and day < 19729"))
    run.run()
    return _rounded(run.table())


# ---- streams with quarantine

_STREAM = """l AS (SELECT l_orderkey AS g, l_linenumber AS m, l_quantity, l_orderkey % 13 = 0 AND l_linenumber > 2 AS odd, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem),
r AS (SELECT g, m, CASE WHEN g % 9 = 0 AND m = 3 THEN 'many' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity, CASE WHEN odd THEN 'b' ELSE 'a' END AS meta, CASE WHEN g % 7 = 0 THEN n + 1 WHEN g % 11 = 0 THEN n - 1 ELSE n END AS declared FROM l
 UNION ALL SELECT g, 1, '1', 'a', n FROM l WHERE g % 17 = 0 AND m = 2)"""
_VERDICTS = """v AS (SELECT g, count(*) AS n, CASE WHEN count(*) FILTER (quantity = 'many' OR m > 6) > 0 THEN 'rows' WHEN count(*) > count(DISTINCT m) THEN 'duplicates' WHEN count(DISTINCT meta) > 1 THEN 'metadata'
 WHEN count(DISTINCT declared) > 1 THEN 'ambiguous_size' WHEN count(*) > max(declared) THEN 'too_many' WHEN count(*) < max(declared) THEN 'incomplete' ELSE 'ok' END AS reason FROM r GROUP BY g)"""


@query("stream_acceptance", f"WITH {_STREAM}, {_VERDICTS} SELECT CASE reason WHEN 'ok' THEN 'accepted' WHEN 'incomplete' THEN 'pending' ELSE 'quarantined' END AS status, reason, count(*) AS n_groups, CAST(sum(n) AS BIGINT) AS n_rows FROM v GROUP BY reason UNION ALL SELECT 'ledger', 'rows', CAST(4 AS BIGINT), count(*) FROM r")
def stream_acceptance(spark, d):
    """Four parts, one a trigger (a file each on small tables), with the lines of an order in several of them: groups turn complete, or bad, as files come."""
    from gridframe.streaming.acceptance import Acceptance
    from gridframe.streaming.append import stream_files

    root, k = new_path(spark, "stream"), F.col("g")
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("g"), F.col("l_linenumber").cast("int").alias("m"), F.col("l_quantity").cast("int").cast("string").alias("quantity"))
    li = dealt(li, "g").withColumn("n", F.count("*").over(Window.partitionBy("g")).cast("int"))
    rows = li.select("g", "m", F.when((k % 9 == 0) & (F.col("m") == 3), "many").otherwise(F.col("quantity")).alias("quantity"), F.when((k % 13 == 0) & (F.col("m") > 2), "b").otherwise("a").alias("meta"), F.when(k % 7 == 0, F.col("n") + 1).when(k % 11 == 0, F.col("n") - 1).otherwise(F.col("n")).alias("declared"))
    rows = rows.unionByName(li.where("g % 17 = 0 and m = 2").select("g", F.lit(1).alias("m"), F.lit("1").alias("quantity"), F.lit("a").alias("meta"), F.col("n").alias("declared")))
    rows = stored(rows.withColumn("part", F.col("m") % 4), "lines")
    files = max(1, math.ceil(rows.count() / (4 * shared.TASK_ROWS)))
    for part in range(4):  # a task writes about TASK_ROWS rows
        rows.where(F.col("part") == part).drop("part").repartition(files).write.mode("append").parquet(f"{root}/in")
    schema = ", ".join(f"{c} {t}" for c, t in rows.drop("part").dtypes)
    to = Acceptance(spark, f"{root}/to", "g", "m", [("quantity", "int", None)], "m <= 6", "declared", ["meta"])
    to.start(stream_files(spark, f"{root}/in", schema, files), f"{root}/state").awaitTermination()
    out = to.rows().groupBy("status", "reason").agg(F.countDistinct("g").alias("n_groups"), F.count("*").alias("n_rows"))
    return out.unionByName(to.ledger().agg(F.lit("ledger").alias("status"), F.lit("rows").alias("reason"), F.count("*").alias("n_groups"), F.sum("received").alias("n_rows")))


# ---- snapshot validation

_G = "group_id"
_DAMAGED = f"""el1 AS (SELECT group_id, venue, CASE WHEN group_id % 29 = 0 THEN 'odd' ELSE target_status END AS target_status, eligible, CASE WHEN NOT eligible AND group_id % 2 = 0 THEN true ELSE main END AS main, CASE WHEN group_id % 31 = 0 THEN '' ELSE reasons END AS reasons FROM ev),
el2 AS (SELECT * FROM el1 UNION ALL SELECT * FROM el1 WHERE group_id % 37 = 0),
t0 AS (SELECT c.group_id, CASE WHEN group_id % 5 = 0 THEN 'void' ELSE c.target_status END AS target_status, CASE WHEN group_id % 7 = 0 THEN NULL WHEN group_id % 41 = 0 THEN class_id + 120 ELSE class_id END AS class_id,
 CASE WHEN group_id % 43 = 0 THEN '1-1-2' WHEN c.target_status = 'unique_order' THEN f1 || '-' || f2 || '-' || f3 END AS label FROM c JOIN ev USING (group_id) WHERE eligible),
tt AS (SELECT * FROM t0 WHERE group_id % 11 <> 0 UNION ALL SELECT * FROM t0 WHERE group_id % 11 <> 0 AND group_id % 13 = 0 UNION ALL SELECT -1 - group_id, target_status, class_id, label FROM t0 WHERE group_id % 17 = 0),
g0 AS (SELECT c.group_id, CASE WHEN group_id % 53 <> 0 THEN c.venue END AS venue, n AS n_entries FROM c JOIN ev USING (group_id) WHERE eligible AND group_id % 47 <> 0),
gf AS (SELECT * FROM g0 UNION ALL SELECT * FROM g0 WHERE group_id % 59 = 0),
b0 AS (SELECT e.group_id, CASE WHEN group_id % 61 = 0 AND lane = 1 THEN 11 ELSE lane END AS lane, entity, CASE WHEN group_id % 67 <> 0 THEN price END AS price FROM e JOIN ev USING (group_id) WHERE eligible AND NOT (group_id % 71 = 0 AND lane = 2)),
ef AS (SELECT * FROM b0 UNION ALL SELECT * FROM b0 WHERE group_id % 19 = 0),
a0 AS (SELECT e.group_id, CASE WHEN group_id % 79 = 0 AND lane = 1 THEN NULL ELSE lane END AS lane, CASE WHEN group_id % 73 = 0 THEN 0 ELSE finish END AS finish FROM e JOIN ev USING (group_id) WHERE eligible),
ax AS (SELECT * FROM a0 WHERE group_id % 23 <> 0 UNION ALL SELECT -1 - group_id, lane, finish FROM a0 WHERE group_id % 83 = 0),
labels AS (SELECT (f - 1) * 20 + (s - 1 - CASE WHEN s > f THEN 1 ELSE 0 END) * 4 + (t - 1 - CASE WHEN t > f THEN 1 ELSE 0 END - CASE WHEN t > s THEN 1 ELSE 0 END) AS class_id, f || '-' || s || '-' || t AS l FROM (SELECT unnest(range(1, 7)) AS f), (SELECT unnest(range(1, 7)) AS s), (SELECT unnest(range(1, 7)) AS t) WHERE f <> s AND s <> t AND f <> t),
u AS (SELECT 'e' AS t, group_id AS g, NULL::BIGINT AS lane, target_status AS st, eligible, main, NULL::BIGINT AS n FROM el2 UNION ALL SELECT 't', group_id, NULL, target_status, NULL, NULL, NULL FROM tt UNION ALL SELECT 'g', group_id, NULL, NULL, NULL, NULL, n_entries FROM gf
 UNION ALL SELECT 'b', group_id, lane, NULL, NULL, NULL, NULL FROM ef UNION ALL SELECT 'a', group_id, lane, NULL, NULL, NULL, NULL FROM ax),
k AS (SELECT g, count(*) FILTER (t = 'e') AS n_e, count(*) FILTER (t = 't') AS n_t, count(*) FILTER (t = 'g') AS n_g, count(*) FILTER (t = 'b') AS n_b, count(*) FILTER (t = 'a') AS n_a, coalesce(bool_or(eligible), false) AS ok, max(n) AS n,
 max(st) FILTER (t = 'e') AS s_e, max(st) FILTER (t = 't') AS s_t, count(DISTINCT lane) FILTER (t = 'b' AND lane BETWEEN 1 AND 6) AS d_b, count(DISTINCT lane) FILTER (t = 'a' AND lane BETWEEN 1 AND 6) AS d_a,
 max(lane) FILTER (t = 'b' AND lane BETWEEN 1 AND 6) AS m_b, max(lane) FILTER (t = 'a' AND lane BETWEEN 1 AND 6) AS m_a, count(*) FILTER (t = 'b' AND lane BETWEEN 1 AND 6) AS v_b, count(*) FILTER (t = 'a' AND lane BETWEEN 1 AND 6) AS v_a,
 list_sort(list(DISTINCT lane) FILTER (t = 'b' AND lane BETWEEN 1 AND 6)) AS l_b, list_sort(list(DISTINCT lane) FILTER (t = 'a' AND lane BETWEEN 1 AND 6)) AS l_a FROM u GROUP BY g)"""
_COUNTS = {
    "eligibility:main_not_eligible": "el2 WHERE main AND NOT eligible", "eligibility:main_not_unique": "el2 WHERE main AND target_status <> 'unique_order'",
    "eligibility:unique_not_main": "el2 WHERE eligible AND target_status = 'unique_order' AND NOT main", "eligibility:excluded_without_reason": "el2 WHERE NOT eligible AND reasons = ''",
    "eligibility:main_with_reason": "el2 WHERE main AND reasons <> ''", "eligibility:blank_key": "el2 WHERE group_id IS NULL", "eligibility:status": "el2 WHERE target_status = 'odd'",
    "targets:class_missing": "tt WHERE target_status = 'unique_order' AND class_id IS NULL", "targets:class_range": "tt WHERE target_status = 'unique_order' AND class_id > 119",
    "targets:class_of_unclear": "tt WHERE target_status <> 'unique_order' AND class_id IS NOT NULL", "targets:label_of_class": "tt JOIN labels USING (class_id) WHERE target_status = 'unique_order' AND label <> l",
    "targets:label_of_unclear": "tt WHERE target_status <> 'unique_order' AND label <> ''", "targets:blank_key": "tt WHERE group_id IS NULL", "targets:status": "tt WHERE target_status NOT IN ('unique_order', 'tied', 'void', 'abandoned')",
    "group_features:blank_key": "gf WHERE group_id IS NULL", "group_features:blank_venue": "gf WHERE venue IS NULL",
    "entry_features:lane": "ef WHERE lane > 6", "entry_features:blank_key": "ef WHERE group_id IS NULL", "entry_features:blank_entity": "ef WHERE entity IS NULL", "entry_features:blank_price": "ef WHERE price IS NULL",
    "auxiliary:lane": "ax WHERE lane IS NULL", "auxiliary:finish": "ax WHERE finish < 1", "auxiliary:blank_key": "ax WHERE group_id IS NULL",
    "eligibility_unique": "k WHERE n_e > 1", "targets_unique": "k WHERE n_t > 1", "group_features_unique": "k WHERE n_g > 1", "targets_status": "k WHERE n_t > 0 AND n_e > 0 AND s_t <> s_e",
    **{f"{t}_missing": f"k WHERE ok AND n_{x} = 0" for t, x in (("targets", "t"), ("group_features", "g"), ("entry_features", "b"), ("auxiliary", "a"))},
    **{f"{t}_extra": f"k WHERE NOT ok AND n_{x} > 0" for t, x in (("targets", "t"), ("group_features", "g"), ("entry_features", "b"), ("auxiliary", "a"))},
    **{f"{t}_lane_twice": f"k WHERE v_{x} > d_{x}" for t, x in (("entry_features", "b"), ("auxiliary", "a"))},
    **{f"{t}_lane_set": f"k WHERE n_{x} > 0 AND (coalesce(m_{x}, 0) <> d_{x} OR d_{x} <> coalesce(n, d_{x}))" for t, x in (("entry_features", "b"), ("auxiliary", "a"))},
    "lanes_differ": "k WHERE n_b > 0 AND n_a > 0 AND l_a IS DISTINCT FROM l_b",
}
_PROFILE = {
    "eligibility": ("count(*) FROM ev", "count(*) FROM el2"), "targets": ("count(*) FROM ev WHERE eligible", "count(*) FROM tt"), "group_features": ("count(*) FROM ev WHERE eligible", "count(*) FROM gf"),
    "entry_features": ("sum(n) FROM c JOIN ev USING (group_id) WHERE eligible", "count(*) FROM ef"), "eligible": ("count(*) FROM ev WHERE eligible", "count(*) FROM el2 WHERE eligible"), "excluded": ("count(*) FROM ev WHERE NOT eligible", "count(*) FROM el2 WHERE NOT eligible"),
    "main": ("count(*) FROM ev WHERE main", "count(*) FROM el2 WHERE main"), "main_excluded": ("count(*) FROM ev WHERE NOT main", "count(*) FROM el2 WHERE NOT main"),
    "status:tied": ("count(*) FROM ev WHERE target_status = 'tied'", "count(*) FROM el2 WHERE target_status = 'tied'"), "status:abandoned": ("0", "count(*) FROM el2 WHERE target_status = 'abandoned'"),
}
_HEADERS = {"eligibility": 0, "targets": 0, "group_features": 1, "entry_features": 1, "auxiliary": 1}
_VALID_SQL = " UNION ALL ".join(
    [f"SELECT '{n}' AS check_name, count(*) AS issues FROM {x}" for n, x in _COUNTS.items()]
    + [f"SELECT '{t}_columns', CAST({n} AS BIGINT)" for t, n in _HEADERS.items()]
    + [f"SELECT 'profile:{n}', CAST((SELECT {a}) <> (SELECT {b}) AS BIGINT)" for n, (a, b) in _PROFILE.items()]
)


@query("snapshot_validation", f"WITH {_ELIG}, {_DAMAGED} {_VALID_SQL}")
def snapshot_validation(spark, d):
    """All checks on a snapshot that was damaged on purpose, with a profile recorded before the damage."""
    s, k = _snapshot(spark, d), F.col(_G)
    e = s["eligibility"]
    p = e.agg(*[c.alias(n) for n, c in {"n": F.count("*"), "ok": F.count_if("eligible"), "main": F.count_if("main"), "tied": F.count_if(F.col("target_status") == "tied")}.items()]).first()
    profile = {"eligibility": p.n, "targets": p.ok, "group_features": p.ok, "entry_features": s["entry_features"].count(), "eligible": p.ok, "excluded": p.n - p.ok, "main": p.main, "main_excluded": p.n - p.main, "status:tied": p.tied, "status:abandoned": 0}
    el = e.withColumns({"target_status": F.when(k % 29 == 0, "odd").otherwise(F.col("target_status")), "main": F.col("main") | ~F.col("eligible") & (k % 2 == 0), "reasons": F.when(k % 31 == 0, "").otherwise(F.col("reasons"))})
    t = s["targets"].withColumns({"target_status": F.when(k % 5 == 0, "void").otherwise(F.col("target_status")), "class_id": F.when(k % 7 == 0, None).when(k % 41 == 0, F.col("class_id") + 120).otherwise(F.col("class_id")), "order_label": F.when(k % 43 == 0, "1-1-2").otherwise(F.col("order_label"))})
    kept = t.where("group_id % 11 <> 0")
    gf = s["group_features"].withColumn("venue", F.when(k % 53 != 0, F.col("venue"))).where("group_id % 47 <> 0")
    ef = s["entry_features"].where("not (group_id % 71 = 0 and lane = 2)").withColumns({"lane": F.when((k % 61 == 0) & (F.col("lane") == 1), 11).otherwise(F.col("lane")), "price": F.when(k % 67 != 0, F.col("price"))})
    ax = s["auxiliary"].withColumns({"lane": F.when((k % 79 == 0) & (F.col("lane") == 1), None).otherwise(F.col("lane")), "actual_finish": F.when(k % 73 == 0, 0).otherwise(F.col("actual_finish"))})
    damaged = {
        "eligibility": el.unionByName(el.where("group_id % 37 = 0")),
        "targets": kept.unionByName(kept.where("group_id % 13 = 0")).unionByName(t.where("group_id % 17 = 0").withColumn(_G, -1 - k)),
        "group_features": gf.unionByName(gf.where("group_id % 59 = 0")),
        "entry_features": ef.unionByName(ef.where("group_id % 19 = 0")),
        "auxiliary": ax.where("group_id % 23 <> 0").unionByName(ax.where("group_id % 83 = 0").withColumn(_G, -1 - k)),
    }
    contract = {n: list(x.columns) for n, x in damaged.items()}
    contract["group_features"] = contract["group_features"][::-1]
    contract["auxiliary"] = [*contract["auxiliary"], "weather"]
    required = {"group_features": ["venue"], "entry_features": ["entity", "price"]}
    return validation.validate_snapshot(damaged, _G, "lane", required, contract, ["entity"], profile)


# ---- restorable appends

_VT = """b AS (SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 3 = 0 THEN 'a' WHEN o_custkey % 3 = 1 THEN 'b' ELSE 'c' END AS batch, CAST(o_orderdate AS DATE) AS day FROM orders),
f AS (SELECT batch, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT o_custkey) AS BIGINT) AS g, CAST(min(day) AS VARCHAR) AS d0, CAST(max(day) AS VARCHAR) AS d1 FROM b GROUP BY batch)"""


def _step_row(n, batch, mode, before, added, after, validation, report):
    """A ledger row in SQL: numbers before, added and after are sums over the batches named."""
    total = lambda bs, c: f"(SELECT coalesce(sum({c}), 0) FROM f WHERE batch IN ({', '.join(map(repr, bs)) or 'NULL'}))"
    parts = ", ".join(f"CAST({total(bs, c)} AS BIGINT) AS {name}_{kind}" for name, bs in (("before", before), ("added", added), ("after", after)) for kind, c in (("rows", "n"), ("groups", "g")))
    return f"SELECT CAST({n} AS INTEGER) AS n, '{batch}' AS batch_id, '{mode}' AS mode, {parts}, f.d0 AS date_min, f.d1 AS date_max, f.g AS groups_actual, '{validation}' AS validation, '{report}' AS report FROM f WHERE batch = '{batch[0]}'"


_VT_SQL = " UNION ALL ".join(
    _step_row(*x)
    for x in [
        (1, "a", "applied", "", "a", "a", "passed", ""),
        (2, "b", "dry_run", "a", "b", "a", "passed", ""),
        (3, "b", "partial", "a", "b", "a", "passed", "failed: append"),
        (4, "b", "partial", "a", "b", "a", "passed", "failed: audit"),
        (5, "b", "applied", "a", "b", "ab", "passed", ""),
        (6, "c", "applied", "ab", "c", "abc", "passed", ""),
    ]
)


@query("append_restore", f"WITH {_VT} {_VT_SQL} UNION ALL SELECT 0, 'table', 'after failure', NULL, NULL, NULL, NULL, f.n, f.g, f.d0, f.d1, NULL, NULL, NULL FROM f WHERE batch = 'a' UNION ALL SELECT 7, 'table', 'restored', NULL, NULL, NULL, NULL, sum(f.n), sum(f.g), min(f.d0), max(f.d1), NULL, NULL, NULL FROM f WHERE batch IN ('a', 'b')")
def append_restore(spark, d):
    """Three batches; the second fails behind two steps and is resumed, the third is taken back by a restore."""
    from gridframe.operators.versions import StepFailed, VersionedTable

    o = table(spark, d, "orders")
    rows = o.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"), F.lit(None).cast("int").alias("declared"), F.lit("all").alias("scope"))
    t = VersionedTable(spark, new_path(spark, "versions"), "o_custkey", "o_orderkey", "o_orderkey", "declared", "scope", "day")
    parts = {b: rows.where(f"o_custkey % 3 = {k}") for k, b in enumerate("abc")}
    seen = lambda n, mode: t.rows().agg(F.lit(n).alias("n"), F.lit("table").alias("batch_id"), F.lit(mode).alias("mode"), F.count("*").alias("after_rows"), F.countDistinct("o_custkey").alias("after_groups"), F.min("day").cast("string").alias("date_min"), F.max("day").cast("string").alias("date_max"))
    t.apply(parts["a"], "a")
    t.dry_run(parts["b"], "b")
    for run, stop in ((t.apply, "append"), (t.resume, "audit")):
        try:
            run(parts["b"], "b", fail_after=stop)
        except StepFailed:
            broken = seen(0, "after failure")
    t.resume(parts["b"], "b")
    second = t.version()
    t.apply(parts["c"], "c")
    t.restore(second)
    names = "n batch_id mode before_rows before_groups added_rows added_groups after_rows after_groups date_min date_max groups_actual validation report".split()
    return t.ledger().select(*names).unionByName(broken, allowMissingColumns=True).unionByName(seen(7, "restored"), allowMissingColumns=True)
