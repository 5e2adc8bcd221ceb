"""Split rules, the final lock, targets against four sources, same-day results, report sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from gridframe.operators import outcomes as oc
from gridframe.operators import reconcile as rc
from gridframe.operators import splits
from gridframe.plans.registry import query
from gridframe.plans.views import E, H, T, entry, hist
from gridframe.session import table
from gridframe.sources.shared import new_path, stored


def _quarter(k: int) -> dt.date:
    return dt.date(1995 + k // 4, 3 * (k % 4) + 1, 1)


def _span(a: int, b: int) -> tuple[str, str]:
    return str(_quarter(a)), str(_quarter(b + 1) - dt.timedelta(days=1))


_LOCK = ("1998-07-01", "1999-06-30")
#: Six folds that move on by a quarter, and one that breaks every rule but the empty role.
_FOLDS = [(f, role, *_span(a, b)) for f in range(6) for role, a, b in (("train", 0, f + 5), ("selection", f + 6, f + 6), ("calibration", f + 7, f + 7), ("evaluation", f + 8, f + 8))]
_BROKEN = [(6, "train", *_span(0, 10)), (6, "selection", *_span(11, 11)), (6, "calibration", "1997-12-20", "1998-03-31"), (6, "evaluation", "1998-04-01", "1998-07-10")]
_ALL = ", ".join(f"({f}, '{r}', DATE '{a}', DATE '{b}')" for f, r, a, b in _FOLDS + _BROKEN)
_SETS = " UNION ALL ".join(
    f"SELECT '{name}:' || c AS check_name, n AS issues FROM (SELECT 'role_empty' AS c, count(*) AS n FROM b WHERE {w} AND (t1 IS NULL OR s1 IS NULL OR c1 IS NULL OR e1 IS NULL) UNION ALL SELECT 'roles_out_of_order', count(*) FROM b WHERE {w} AND NOT (t1 < s0 AND s1 < c0 AND c1 < e0) UNION ALL SELECT 'date_in_several_roles', count(*) FROM (SELECT fold, day FROM days WHERE {w} GROUP BY 1, 2 HAVING count(*) > 1) UNION ALL SELECT 'date_in_several_evaluations', count(*) FROM (SELECT day FROM days WHERE {w} AND role = 'evaluation' GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'locked_members', CAST(coalesce(sum(n), 0) AS BIGINT) FROM days WHERE {w} AND day BETWEEN DATE '{_LOCK[0]}' AND DATE '{_LOCK[1]}')"
    for name, w in (("six", "fold < 6"), ("seven", "true"))
)


@query(
    "split_rules",
    f"""WITH r(fold, role, start, stop) AS (VALUES {_ALL}), days AS (SELECT fold, role, CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders JOIN r ON CAST(o_orderdate AS DATE) BETWEEN start AND stop GROUP BY 1, 2, 3),
b AS (SELECT fold, max(day) FILTER (role = 'train') AS t1, min(day) FILTER (role = 'selection') AS s0, max(day) FILTER (role = 'selection') AS s1, min(day) FILTER (role = 'calibration') AS c0, max(day) FILTER (role = 'calibration') AS c1, min(day) FILTER (role = 'evaluation') AS e0, max(day) FILTER (role = 'evaluation') AS e1 FROM days GROUP BY fold) {_SETS}""",
)
def split_rules(spark, d):
    roles = spark.createDataFrame(_FOLDS + _BROKEN, "fold int, role string, start string, stop string")
    o = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day"))
    members = o.join(F.broadcast(roles), F.col("day").between(F.to_date("start"), F.to_date("stop")))  # a few rows a fold
    out = None
    for name, part in (("six", members.where("fold < 6")), ("seven", members)):
        one = splits.split_issues(part, "fold", "role", "day", _LOCK).withColumn("check_name", F.concat(F.lit(f"{name}:"), "check_name"))
        out = one if out is None else out.unionByName(one)
    return out


_DEV = "o_orderdate < TIMESTAMP '1998-07-01'"
_SEALED = "o_orderdate >= TIMESTAMP '1998-07-01' AND o_orderdate < TIMESTAMP '1999-07-01'"


@query(
    "final_lock",
    f"""SELECT 'development' AS name, true AS allowed, count(*) AS n FROM orders WHERE {_DEV} UNION ALL SELECT 'stricter', true, count(*) FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01' AND o_orderstatus = 'F'
UNION ALL SELECT 'joined', true, count(*) FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE {_DEV} UNION ALL SELECT 'after', true, count(*) FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01'
UNION ALL SELECT unnest(['whole', 'one_side', 'too_wide', 'filtered_late', 'while_locked', 'wrong_hash', 'unknown_key']), false, NULL UNION ALL SELECT 'unlocked', true, count(*) FROM orders WHERE {_SEALED} AND o_orderkey % 10 = 0""",
)
def final_lock(spark, d):
    """Queries that the lock lets through, with their rows, and those it refuses."""
    lock = splits.FinalLock(spark, new_path(spark, "lock"), f"{d}/orders.parquet", "o_orderdate", *_LOCK, "abc")
    o, dev = table(spark, d, "orders"), lock.development()
    keys = o.where(_SEALED).where("o_orderkey % 10 = 0").select("o_orderkey")
    asked = {
        "development": lambda: lock.check(dev),
        "stricter": lambda: lock.check(o.where("o_orderdate < timestamp'1997-01-01' and o_orderstatus = 'F'")),
        "joined": lambda: lock.check(dev.join(table(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))),
        "after": lambda: lock.check(o.where("o_orderdate > timestamp'2000-01-01'")),
        "whole": lambda: lock.check(o),
        "one_side": lambda: lock.check(dev.join(o.groupBy("o_custkey").agg(F.count("*").alias("all")), "o_custkey")),
        "too_wide": lambda: lock.check(o.where("o_orderdate < timestamp'1998-07-02'")),
        "filtered_late": lambda: lock.check(o.where("year(o_orderdate) < 1998 or o_orderkey % 2 = 0")),
        "while_locked": lambda: lock.sealed(keys, "o_orderkey"),
        "wrong_hash": lambda: lock.unlock("abd", "a try"),
        "unlocked": lambda: (lock.unlock("abc", "final evaluation"), lock.sealed(keys, "o_orderkey"))[1],
        "unknown_key": lambda: lock.sealed(dev.select("o_orderkey"), "o_orderkey"),
    }
    out = None
    for name, ask in asked.items():
        try:
            one = ask().agg(F.lit(name).alias("name"), F.lit(True).alias("allowed"), F.count("*").alias("n"))
        except splits.LockViolation:
            one = spark.range(1).select(F.lit(name).alias("name"), F.lit(False).alias("allowed"), F.lit(None).cast("long").alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


# ---- targets against their sources

_LABELS = "labels AS (SELECT CAST((f - 1) * 20 + (s - 1 - CASE WHEN s > f THEN 1 ELSE 0 END) * 4 + (t - 1 - CASE WHEN t > f THEN 1 ELSE 0 END - CASE WHEN t > s THEN 1 ELSE 0 END) AS INTEGER) AS class_id, f || '-' || s || '-' || t AS l FROM (SELECT unnest(range(1, 7)) AS f), (SELECT unnest(range(1, 7)) AS s), (SELECT unnest(range(1, 7)) AS t) WHERE f <> s AND s <> t AND f <> t)"
_RECONCILE = f"""WITH {E}, {T}, {_LABELS}, fin AS (SELECT group_id, list(finish ORDER BY lane, finish) AS fs FROM e GROUP BY 1),
f AS (SELECT group_id, race_date, venue, group_id % 12 AS race_no, group_id % 4 AS batch, group_id % 10 = 0 AS source_excluded, CASE WHEN group_id % 10 = 0 THEN 'gap' ELSE '' END AS source_reasons, group_id % 6 <> 0 AS eligible, CASE WHEN group_id % 6 = 0 THEN 'program' ELSE '' END AS exclusion_reasons,
 target_status AS outcome, fs, class_id, CASE WHEN target_status = 'unique_order' THEN f1 || '-' || f2 || '-' || f3 END AS raw, group_id % 21 <> 0 AS identity_match, target_status = 'unique_order' AND group_id % 6 <> 0 AND group_id % 8 <> 0 AS scorable FROM c JOIN fin USING (group_id)),
old AS (SELECT group_id, outcome AS st, CAST(CASE WHEN outcome = 'tied' THEN 0 WHEN group_id % 5 = 0 THEN (class_id + 1) % 120 ELSE class_id END AS INTEGER) AS class_id FROM f WHERE outcome = 'unique_order' AND group_id % 7 <> 0 OR outcome = 'tied' AND group_id % 2 = 0),
nw AS (SELECT group_id, CASE WHEN scorable THEN 'unique_order' WHEN outcome = 'tied' THEN 'tied' ELSE 'void' END AS st, CAST(CASE WHEN scorable AND group_id % 16 = 1 THEN (class_id + 1) % 120 WHEN scorable THEN class_id WHEN outcome = 'tied' AND group_id % 4 = 1 THEN 3 END AS INTEGER) AS class_id FROM f),
paid AS (SELECT group_id, list_sort(list(DISTINCT combo)) AS p FROM (SELECT group_id, CASE WHEN group_id % 9 = 0 THEN '6-5-4' ELSE raw END AS combo FROM f WHERE raw IS NOT NULL AND group_id % 25 <> 0 UNION ALL SELECT group_id, '1-2-3' FROM f WHERE raw IS NOT NULL AND group_id % 14 = 0) GROUP BY 1),
aud AS (SELECT group_id, [CASE WHEN group_id % 27 = 0 THEN '6-5-4' ELSE raw END] AS a FROM f WHERE raw IS NOT NULL AND group_id % 3 = 0),
j AS (SELECT f.*, old.group_id IS NOT NULL AS old_exists, coalesce(old.st, '') AS old_status, old.class_id AS old_class, coalesce(lo.l, '') AS old_combo, nw.st AS new_status, nw.class_id AS new_class, coalesce(ln.l, '') AS new_combo, coalesce(p, []) AS p, coalesce(a, []) AS a,
 coalesce(list_contains(coalesce(p, []), raw), false) AS is_paid FROM f LEFT JOIN old USING (group_id) LEFT JOIN nw USING (group_id) LEFT JOIN labels lo ON lo.class_id = old.class_id LEFT JOIN labels ln ON ln.class_id = nw.class_id LEFT JOIN paid USING (group_id) LEFT JOIN aud USING (group_id)),
m AS (SELECT *, array_to_string(list_filter([CASE WHEN old_exists AND old_combo <> coalesce(raw, '') THEN 'old_target_differs_from_result' END, CASE WHEN old_exists AND NOT is_paid THEN 'old_target_not_paid' END, CASE WHEN old_exists AND len(a) > 0 AND NOT coalesce(list_contains(a, raw), false) THEN 'old_target_not_in_audit' END,
 CASE WHEN scorable AND new_combo <> coalesce(raw, '') THEN 'new_class_differs_from_result' END, CASE WHEN scorable AND NOT (len(p) = 1 AND p[1] = raw) THEN 'new_target_not_paid_alone' END, CASE WHEN outcome = 'tied' AND new_class IS NOT NULL THEN 'tie_as_one_class' END], lambda x: x IS NOT NULL), '|') AS mismatch_reasons FROM j)
SELECT group_id, race_date, venue, race_no, batch, source_excluded, source_reasons, eligible, exclusion_reasons, outcome, CAST(to_json(fs) AS VARCHAR) AS finish_by_lane, coalesce(raw, '') AS raw_combo, array_to_string(p, '|') AS payout_combos, array_to_string(a, '|') AS audit_combos, identity_match,
 old_exists, old_status, old_class, old_combo, old_exists AND old_combo = coalesce(raw, '') AS old_matches_raw, old_exists AND is_paid AS old_matches_payout, new_status, new_class, new_combo, scorable AND new_combo = coalesce(raw, '') AS new_matches_raw, scorable AND is_paid AS new_matches_payout, scorable,
 CASE WHEN mismatch_reasons <> '' THEN 'mismatch' WHEN outcome = 'tied' THEN 'tied_several_winners' WHEN scorable AND NOT old_exists THEN 'recovered' WHEN scorable THEN 'matched' ELSE 'not_scorable' END AS status, mismatch_reasons FROM m"""


@query("source_reconcile", _RECONCILE)
def source_reconcile(spark, d):
    """Old and new targets, results and payouts of every group, with faults put into each of the four."""
    e, k = entry(spark, d), F.col("group_id")
    s = oc.target_status(e, "group_id", "lane", "finish", least=3, extra=[F.first("race_date").alias("race_date"), F.first("venue").alias("venue"), F.transform(F.sort_array(F.collect_list(F.struct("lane", "finish"))), lambda x: x["finish"]).alias("finishes")])
    s = stored(s.select("group_id", "target_status", "class_id", "f1", "f2", "f3", "race_date", "venue", "finishes"), "groups")  # seven tables below read it
    unique = F.col("target_status") == "unique_order"
    scorable = unique & (k % 6 != 0) & (k % 8 != 0)
    facts = s.select(
        "group_id", "race_date", "venue", (k % 12).alias("race_no"), (k % 4).alias("batch"), (k % 10 == 0).alias("source_excluded"), F.when(k % 10 == 0, "gap").otherwise("").alias("source_reasons"), (k % 6 != 0).alias("eligible"), F.when(k % 6 == 0, "program").otherwise("").alias("exclusion_reasons"),
        F.col("target_status").alias("outcome"), "finishes", *[F.when(unique, F.col(f)).alias(f) for f in ("f1", "f2", "f3")], (k % 21 != 0).alias("identity_match"), scorable.alias("scorable"),
    )
    tied, clear = s.where("target_status = 'tied'"), s.where(unique)
    next_class = (F.col("class_id") + 1) % 120
    old = clear.where("group_id % 7 <> 0").select("group_id", "target_status", F.when(k % 5 == 0, next_class).otherwise(F.col("class_id")).alias("class_id")).unionByName(tied.where("group_id % 2 = 0").select("group_id", "target_status", F.lit(0).alias("class_id")))
    status = F.when(scorable, "unique_order").when(F.col("target_status") == "tied", "tied").otherwise("void")
    new = s.select("group_id", status.alias("target_status"), F.when(scorable & (k % 16 == 1), next_class).when(scorable, F.col("class_id")).when((F.col("target_status") == "tied") & (k % 4 == 1), 3).alias("class_id"))
    raw = F.concat_ws("-", "f1", "f2", "f3")
    payouts = clear.where("group_id % 25 <> 0").select("group_id", F.when(k % 9 == 0, "6-5-4").otherwise(raw).alias("combo")).unionByName(clear.where("group_id % 14 = 0").select("group_id", F.lit("1-2-3").alias("combo")))
    audit = clear.where("group_id % 3 = 0").select("group_id", F.when(k % 27 == 0, "6-5-4").otherwise(raw).alias("combo"))
    return rc.reconcile_sources(facts, old, new, payouts, audit, "group_id", facts.columns[1:9])


# ---- same-day results

_SAME_DAY = f"""WITH {H}, x AS (SELECT event_id, entity, date, hour(ts) AS number, event_id % 2 AS venue, CASE WHEN event_id % 11 <> 0 THEN ts END AS finished, CASE WHEN event_id % 23 <> 0 THEN ts + to_hours(CAST(event_id % 5 - 1 AS BIGINT)) END AS available, CASE WHEN event_id % 13 <> 0 THEN ts + to_hours(CAST(event_id % 6 AS BIGINT)) END AS captured,
 ts + to_hours(2) AS cutoff, CASE WHEN event_id % 7 <> 0 THEN event_type END AS printed, event_id % 17 <> 0 AS artifact, event_id % 19 <> 0 AS source_ok, event_id % 3 = 0 AS audited FROM h),
w AS (SELECT *, lag(event_id) OVER o AS previous, lag(venue) OVER o AS pv, lag(number) OVER o AS pn, lag(finished) OVER o AS pf FROM x WINDOW o AS (PARTITION BY entity, date ORDER BY number, event_id)),
p AS (SELECT *, previous IS NOT NULL AS same_date, coalesce(pv = venue, false) AS same_venue, previous IS NOT NULL AS same_entity, coalesce(pn < number, false) AS earlier_number, coalesce(pf < available, false) AS finished_before_available, printed IS NOT NULL AS is_printed, coalesce(available <= cutoff, false) AS available_by_cutoff FROM w),
q AS (SELECT *, same_date AND same_venue AND earlier_number AND finished_before_available AND is_printed AND available_by_cutoff AND artifact AND source_ok AS every, same_date AND same_venue AND earlier_number AND is_printed AND source_ok AND (finished_before_available OR pf IS NULL OR available IS NULL) AND (available_by_cutoff OR available IS NULL) AS cand FROM p),
r AS (SELECT *, CASE WHEN previous IS NULL THEN 'insufficient' WHEN every AND coalesce(captured <= cutoff, false) THEN 'timestamp_confirmed' WHEN every AND audited THEN 'semantic_confirmed' WHEN cand THEN 'semantic_candidate' ELSE 'insufficient' END AS confidence FROM q)
SELECT event_id, previous, confidence, CASE WHEN previous IS NULL THEN 'no_earlier_group' WHEN NOT same_venue THEN 'same_venue' WHEN NOT earlier_number THEN 'earlier_number' WHEN NOT finished_before_available THEN 'finished_before_available' WHEN NOT is_printed THEN 'printed' WHEN NOT available_by_cutoff THEN 'available_by_cutoff' WHEN NOT artifact THEN 'artifact_kept' WHEN NOT source_ok THEN 'no_later_fields' WHEN confidence = 'semantic_candidate' THEN 'not_audited' ELSE 'ok' END AS reason,
 CASE WHEN confidence IN ('timestamp_confirmed', 'semantic_confirmed') THEN printed END AS value_used FROM r"""


@query("same_day_result", _SAME_DAY)
def same_day_result(spark, d):
    k, ts = F.col("event_id"), F.col("ts").cast("timestamp")
    hours = lambda n: ts + F.make_dt_interval(F.lit(0), n.cast("int"))
    h = hist(spark, d).select(
        "event_id", "entity", "date", F.hour("ts").alias("number"), (k % 2).alias("venue"), F.when(k % 11 != 0, ts).alias("finished"), F.when(k % 23 != 0, hours(k % 5 - 1)).alias("available"), F.when(k % 13 != 0, hours(k % 6)).alias("captured"), hours(F.lit(2)).alias("cutoff"), F.when(k % 7 != 0, F.col("event_type")).alias("printed_value")
    )
    out = rc.same_day_result(h, "entity", "date", ["number", "event_id"], "event_id", "venue", "finished", "available", "captured", "cutoff", "printed_value", k % 17 != 0, k % 19 != 0, k % 3 == 0)
    return out.select("event_id", "previous", "confidence", "reason", "value_used")
