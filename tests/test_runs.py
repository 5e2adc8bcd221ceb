"""Scans over hot keys, features in runs, stream acceptance, snapshot validation and restorable appends on small literals."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from gridframe.operators import asof, daily
from gridframe.operators.scan import carry_forward
from gridframe.operators.validation import TABLES, validate_snapshot
from gridframe.operators.versions import STEPS, StepFailed, VersionedTable
from gridframe.sources.shared import exists, new_path
from gridframe.streaming.acceptance import Acceptance


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---- scans


def test_carry_forward_of_one_hot_key_over_many_ranges(spark):
    rng = random.Random(3)
    data = [("hot" if k % 10 else None if k % 20 else f"k{k}", k // 3, k, f"v{k}" if rng.random() < 0.01 else None) for k in range(3000)]
    df = spark.createDataFrame(data, "key string, at int, id int, v string").where("v is null or id % 3 = 0").repartition(7)
    got = {r.id: (r.key, r.at, r.seen) for r in carry_forward(df, ["key"], ["at", "id"], "v", "seen").collect()}
    last, n = {}, 0
    for key, at, k, v in sorted(((a, b, c, d) for a, b, c, d in data if d is None or c % 3 == 0), key=lambda r: r[1:3]):
        last[key] = v or last.get(key)
        assert got[k] == (key, at, last[key] if key else None)
        n += 1
    assert len(got) == n and carry_forward(df.limit(0), ["key"], ["at"], "v", "seen").count() == 0


def test_no_window_gathers_a_key(spark):
    df = spark.createDataFrame([(1, 5), (1, 9), (None, 3)], "venue int, day int")
    iv = spark.createDataFrame([(1, 4, 6, "a"), (1, 8, None, "b"), (None, 1, None, "n")], "venue int, start int, stop int, interval_id string")
    out = asof.interval_join(df, iv, ["venue"], "day", "start", "stop")
    assert rows(out.select("venue", "day", "interval_id")) == [(1, 5, "a"), (1, 9, "b"), (None, 3, None)]
    windows = re.findall(r"Window \[.*?\], \[(.*?)\], \[", out._jdf.queryExecution().optimizedPlan().toString())
    assert windows and all("_range" in w for w in windows)


# ---- features in runs

ROLES = daily.Roles("id", "who", "day", ["id"], "value", "hit", "place")
HISTORY = [(k, "a" if k % 3 else f"b{k % 4}", 100 + (k * 7) % 40, None if k % 11 == 0 else 1e6 + (k * 37 % 101) / 7, k % 2, k % 5) for k in range(400)] + [(1000, None, 120, 1.0, 1, None), (1001, None, 121, 2.0, 0, None)]
SCHEMA = "id long, who string, day long, value double, hit int, place int"


def brute_features():
    out = {}
    for i, who, day, _, _, place in HISTORY:
        old = sorted((r for r in HISTORY if r[1] == who and r[2] < day), key=lambda r: (r[2], r[0]))
        five, vals = old[-5:], [r[3] for r in old if r[3] is not None]
        mean = sum(vals) / len(vals) if vals else None
        w = [math.exp(-math.log(2) / 90 * (day - r[2])) for r in old]
        fives = [r[3] for r in five if r[3] is not None]
        out[i] = {
            "prior_count": len(old) or None, "recent_n": len(five) or None, "recent_mean": sum(fives) / len(fives) if fives else None, "recent_rate": sum(r[4] for r in five) / len(five) if five else None,
            "prior_mean": mean, "prior_std": math.sqrt(sum((v - mean) ** 2 for v in vals) / len(vals)) if vals else None, "weighted_rate": sum(x * r[4] for x, r in zip(w, old, strict=True)) / sum(w) if old else None,
            "days_since": day - old[-1][2] if old else None, "cold_start": not old, "source_day": old[-1][2] if old else None, "source_rows": len(old), "context_count": sum(r[5] == place for r in old) if old else None,
        }
    return out


def same_features(df):
    want, got = brute_features(), {r.id: r for r in df.collect()}
    assert len(got) == df.count() == len(want)
    for i, f in want.items():
        for name, v in f.items():
            assert got[i][name] == (v if v is None or not isinstance(v, float) else pytest.approx(v, rel=1e-9, abs=1e-6)), (i, name)


def test_features_in_runs_equal_brute_force_in_any_order(spark):
    df = spark.createDataFrame(HISTORY, SCHEMA)
    same_features(daily.features(df, daily.day_sums(df, ROLES), daily.context_sums(df, ROLES), ROLES))
    run = daily.DailyFeatures(spark, new_path(spark, "daily"), ROLES, 20)
    run.add("x", df.where("id % 2 = 1 and day < 130"))
    assert run.run()
    run.add("z", df.where("day >= 125"))  # repeats some rows of x
    run.add("y", df.where("id % 2 = 0 and day between 110 and 130"))
    assert run.run()
    run.add("w", df.where("id % 2 = 0 and day < 112"))
    assert run.run() and run.run() == []
    same_features(run.table())


def test_features_in_runs_after_a_chunk_was_replaced(spark):
    df = spark.createDataFrame(HISTORY, SCHEMA)
    run = daily.DailyFeatures(spark, new_path(spark, "daily"), ROLES, 40)
    run.add("a", df.where("day < 115").withColumn("value", F.lit(0.0)))
    run.add("b", df.where("day >= 115"))
    run.run()
    run.add("a", df.where("day < 115"))
    run.run()
    same_features(run.table())


# ---- acceptance of a stream

PIECES = [
    [(1, 1, "5", "x", 2), (2, 1, "5", "x", 1), (3, 1, "5", "x", 3), (4, 1, "5", "x", 2), (None, 1, "5", "x", 1)],
    [(1, 2, "6", "x", 2), (2, 1, "5", "x", 1), (3, 2, "many", "x", 3), (5, None, "1", "x", 2), (5, None, "1", "x", 2)],
    [(4, 2, "5", "y", 2), (6, 1, "5", "x", 1), (6, 2, "5", "x", 2), (7, 1, "5", "x", 1), (7, 2, "5", "x", 1), (8, 1, "5", "x", 2)],
    [(9, 9, "5", "x", 1)],
]
VERDICTS = {None: "ok", 1: "ok", 2: "duplicates", 3: "rows", 4: "metadata", 5: "ok", 6: "ambiguous_size", 7: "too_many", 8: "incomplete", 9: "rows"}


@pytest.mark.parametrize("compact", [2, 16])
def test_acceptance_retracts_groups_and_replays(spark, compact):
    to = Acceptance(spark, new_path(spark, "accept"), "g", "m", [("quantity", "int", None)], "m is null or m < 9", "declared", ["meta"], compact)
    frames = [spark.createDataFrame(p, "g int, m int, quantity string, meta string, declared int") for p in PIECES]
    for n, df in enumerate(frames):
        to.accept(df, n)
    for n in (3, 1):  # batches that run again, the latter as it was before the ones after it
        to.accept(frames[n], n)
    got = to.rows().collect()
    assert len(got) == sum(map(len, PIECES)) and {r.g: r.reason for r in got} == VERDICTS
    assert {r.status for r in got if r.reason == "ok"} == {"accepted"} and {r.status for r in got if r.g == 8} == {"pending"}
    ledger = {r.batch: r for r in to.ledger().collect()}
    assert [ledger[n].received for n in range(4)] == list(map(len, PIECES)) and [ledger[n].retracted for n in range(4)] == [0, 2, 1, 0]
    assert (ledger[0].accepted, ledger[0].pending, ledger[0].quarantined) == (2, 3, 0)


# ---- snapshot validation


def snapshot(spark):
    return {
        "eligibility": spark.createDataFrame([(1, "unique_order", True, True, ""), (2, "tied", True, False, "target_tied"), (3, "void", False, False, "entry_count")], "group_id int, target_status string, eligible boolean, main boolean, reasons string"),
        "targets": spark.createDataFrame([(1, "unique_order", 0, "1-2-3"), (2, "tied", None, None)], "group_id int, target_status string, class_id int, order_label string"),
        "group_features": spark.createDataFrame([(1, "v", 3), (2, "v", 3)], "group_id int, venue string, n_entries long"),
        "entry_features": spark.createDataFrame([(g, k, 1.0) for g in (1, 2) for k in (1, 2, 3)], "group_id int, lane int, price double"),
        "auxiliary": spark.createDataFrame([(g, k, k) for g in (1, 2) for k in (1, 2, 3)], "group_id int, lane int, actual_finish int"),
    }


def test_validation_finds_each_fault_alone(spark):
    good = snapshot(spark)
    contract = {n: list(t.columns) for n, t in good.items()}
    required = {"group_features": ["venue"], "entry_features": ["price"]}
    profile = {"eligibility": 3, "eligible": 2, "excluded": 1, "main": 1, "main_excluded": 2, "targets": 2, "auxiliary": 6, "status:tied": 1, "status:abandoned": 0}
    issues = lambda t, p=profile: {r.check_name: r.issues for r in validate_snapshot(t, "group_id", "lane", required, contract, ["finish"], p).where("issues > 0").collect()}
    assert issues(good) == {}
    assert issues({n: t.limit(0) for n, t in good.items()}, {}) == {}
    assert issues(good, {"eligible": 5, "status:void": 1}) == {"profile:eligible": 1}
    changed = {
        "lanes_differ": good | {"auxiliary": good["auxiliary"].where("not (group_id = 1 and lane = 3)")},
        "targets_status": good | {"targets": good["targets"].withColumn("target_status", F.when(F.col("group_id") == 2, "void").otherwise(F.col("target_status")))},
        "targets:label_of_class": good | {"targets": good["targets"].withColumn("order_label", F.when(F.col("group_id") == 1, "1-2-4"))},
        "entry_features_columns": good | {"entry_features": good["entry_features"].withColumn("finish", F.lit(1))},
    }
    found = {n: issues(t) for n, t in changed.items()}
    assert found["lanes_differ"] == {"lanes_differ": 1, "auxiliary_lane_set": 1, "profile:auxiliary": 1}
    assert found["targets_status"] == {"targets_status": 1} and found["targets:label_of_class"] == {"targets:label_of_class": 1} and found["entry_features_columns"] == {"entry_features_columns": 2}
    assert set(TABLES) == set(good)


# ---- restorable appends

BATCH = "race string, horse int, no int, size int, track string, day date"


def batch(spark, days, track="t", size=2):
    import datetime as dt

    return spark.createDataFrame([(f"{d}", h, 10 * d + h, size, track, dt.date(2024, 1, d)) for d in days for h in (1, 2)], BATCH)


def versioned(spark):
    return VersionedTable(spark, new_path(spark, "versions"), "race", "horse", "no", "size", "track", "day", ["day"])


def test_append_failing_behind_any_step_restores_and_resumes(spark):
    t = versioned(spark)
    assert t.rows() is None and t.apply(batch(spark, [1, 2]), "a")
    before, old = rows(t.rows()), t.version()
    new = batch(spark, [3])
    run = t.apply
    for step in STEPS[:-1]:
        with pytest.raises(StepFailed) as failed:
            run(new, "b", fail_after=step)
        assert failed.value.step == step and t.version() == old and rows(t.rows()) == before
        assert t.ledger().orderBy(F.desc("n")).first().report == f"failed: {step}"
        run = t.resume
    with pytest.raises(ValueError):
        t.resume(batch(spark, [4]), "b")
    assert t.resume(new, "b") and t.resume(new, "b") and t.rows().count() == 6
    last = t.ledger().orderBy(F.desc("n")).first()
    assert (last.mode, last.before_rows, last.added_rows, last.after_rows, last.before_groups, last.after_groups, last.date_min) == ("applied", 4, 2, 6, 2, 3, "2024-01-03")
    assert last.before_hash != last.after_hash and len(t.ledger().columns) == 21
    kept = t.version()
    t.restore(old)
    assert rows(t.rows()) == before
    t.restore(kept)
    assert t.rows().count() == 6 and exists(spark, f"{t.root}/rows/batch_id=b") and not any(x.startswith("rows/") for x in t.prune())


def test_append_refuses_and_dry_runs(spark):
    t = versioned(spark)
    t.apply(batch(spark, [1]), "a")
    bad = {"duplicates": batch(spark, [5]).union(batch(spark, [5])), "overlap": batch(spark, [1, 6]), "sizes": batch(spark, [7], size=5), "scope": batch(spark, [8]).union(batch(spark, [9], "u")), "empty": batch(spark, [10]).limit(0)}
    for rule, df in bad.items():
        assert not t.apply(df, rule) and not t.dry_run(df, rule)
        assert all(rule in r.report and r.validation == "failed" and r.added_rows == 0 for r in t.ledger().where(F.col("batch_id") == rule).collect())
    assert t.dry_run(batch(spark, [2]), "c", expected=1) and not t.apply(batch(spark, [2]), "a")
    r = t.ledger().where("batch_id = 'c'").first()
    assert (r.mode, r.validation, r.added_rows, r.after_rows, r.groups_expected, r.groups_actual) == ("dry_run", "passed", 2, 2, 1, 1)
    assert t.rows().count() == 2 and t.version() == 1
