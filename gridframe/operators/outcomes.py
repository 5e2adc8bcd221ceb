"""Outcome status, eligibility, snapshot tables and reconciliation of grouped entries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridframe.functions.orders import class_id


def target_status(entries: DataFrame, group: str, lane: str, finish: str, lanes: int = 6, least: int | None = None, extra: Sequence[Column] = (), settled: str | None = None) -> DataFrame:
    """Group, status (void, tied, unique_order), lanes at 1, 2, 3 and the class.

    Void: not `settled` (a flag of the group's rows, if given), fewer than `least` entries (exactly `lanes` when it is not
    given), a lane twice or beyond `lanes`, or a finish that is missing or outside 1 to `lanes`; else tied: a finish twice.
    """
    # Distinct values are counted where they begin in a group's order: several distinct counts at once would triple the rows and shuffle them again.
    begins = {name: F.col(c).isNotNull() & ~F.lag(c).over(Window.partitionBy(group).orderBy(c)).eqNullSafe(F.col(c)) for name, c in (("_new_lane", lane), ("_new_finish", finish))}
    g = entries.withColumns(begins).groupBy(group).agg(
        F.count("*").alias("n"),
        F.count_if("_new_lane").alias("n_lanes"),
        F.count_if("_new_finish").alias("n_finishes"),
        F.max(lane).alias("max_lane"),
        F.min(lane).alias("min_lane"),
        F.count_if(~F.coalesce(F.col(finish).between(1, lanes), F.lit(False))).alias("n_outside"),
        (F.min(F.col(settled).cast("int")) if settled else F.lit(1)).alias("settled"),
        *[F.max(F.when(F.col(finish) == k, F.col(lane))).alias(f"f{k}") for k in (1, 2, 3)],
        *extra,
    )
    wrong = (F.col("n") != lanes) if least is None else (F.col("n") < least)
    void = wrong | (F.col("n") != F.col("n_lanes")) | (F.col("max_lane") > lanes) | (F.col("min_lane") < 1) | (F.col("n_outside") > 0) | (F.coalesce("settled", F.lit(0)) < 1)
    status = F.when(void, "void").when(F.col("n_finishes") < F.col("n"), "tied").otherwise("unique_order")
    out = g.withColumn("target_status", status)
    return out.withColumn("class_id", F.when(F.col("target_status") == "unique_order", class_id("f1", "f2", "f3"))).drop("min_lane", "n_outside", "settled")


def reasons(*parts: tuple[str, Column]) -> Column:
    """Sorted names of the conditions that hold."""
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(cond, name) for name, cond in parts]))))


def _differs(column: str):
    return lambda x: x != F.col(column)


def exclusion_reasons(facts: DataFrame, entries: DataFrame, group: str, required: Sequence[str], lane: str, entity: str, identity: Sequence[str], lanes: int) -> DataFrame:
    """group, reasons: why a group can't be predicted; empty where it can.

    missing_facts, duplicate_facts, missing:column of a required fact, entry_count, lane_set, missing_entity, and
    identity:column where an entry's column differs from the fact's. Groups of either side come.
    """
    f = facts.groupBy(group).agg(F.count("*").alias("_facts"), *[F.count_if(F.trim(F.col(c).cast("string")).isin("") | F.col(c).isNull()).alias(f"_m_{c}") for c in required], *[F.first(c).alias(f"_f_{c}") for c in identity])
    e = entries.groupBy(group).agg(
        F.count("*").alias("_n"),
        F.sort_array(F.collect_set(F.col(lane).cast("int"))).alias("_lanes"),
        F.count_if(F.col(entity).isNull()).alias("_no_entity"),
        *[F.collect_set(c).alias(f"_e_{c}") for c in identity],
    )
    j = f.join(e, group, "full_outer")
    none = F.coalesce("_n", F.lit(0))
    why = reasons(
        ("missing_facts", F.col("_facts").isNull()),
        ("duplicate_facts", F.col("_facts") > 1),
        *[(f"missing:{c}", F.col(f"_m_{c}") > 0) for c in required],
        ("entry_count", none != lanes),
        ("lane_set", ~F.coalesce(F.col("_lanes") == F.sequence(F.lit(1), F.lit(lanes)), F.lit(False))),
        ("missing_entity", F.col("_no_entity") > 0),
        *[(f"identity:{c}", F.exists(f"_e_{c}", _differs(f"_f_{c}"))) for c in identity],
    )
    return j.select(group, why.alias("reasons"))


def group_identity(facts: DataFrame, entries: DataFrame, group: str, lane: str, columns: Sequence[str]) -> DataFrame:
    """group and its columns: from the fact row if there is exactly one, else from the first entry by lane, else ''."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    f = facts.groupBy(group).agg(F.count("*").alias("_n"), *[F.first(text(c)).alias(f"_f_{c}") for c in columns])
    e = entries.groupBy(group).agg(F.min(F.struct(F.col(lane).alias("_lane"), *[text(c).alias(c) for c in columns])).alias("_e"))
    j = f.join(e, group, "full_outer")
    return j.select(group, *[F.when(F.col("_n") == 1, F.col(f"_f_{c}")).otherwise(F.coalesce(F.col(f"_e.{c}"), F.lit(""))).alias(c) for c in columns])


def completeness_reasons(entries: DataFrame, group: str, lane: str, lane_fields: Sequence[str], group_fields: Sequence[str], lanes: int) -> DataFrame:
    """group, reasons: lane_set, lane_repeated, missing:laneK:field and missing:field of a group's program or preview rows."""
    rows = entries.groupBy(group, lane).agg(F.count("*").alias("n"), *[F.max(F.col(c).isNull()).alias(c) for c in [*lane_fields, *group_fields]])
    own = F.array_compact(F.array(*[F.when(F.col(c), F.concat(F.lit("missing:lane"), F.col(lane).cast("string"), F.lit(f":{c}"))) for c in lane_fields], F.when(F.col("n") > 1, F.lit("lane_repeated"))))
    g = rows.withColumn("_own", own).groupBy(group).agg(F.flatten(F.collect_list("_own")).alias("_own"), F.sort_array(F.collect_set(F.col(lane).cast("int"))).alias("_lanes"), *[F.max(c).alias(c) for c in group_fields])
    whole = F.array_compact(F.array(F.when(F.col("_lanes") != F.sequence(F.lit(1), F.lit(lanes)), "lane_set"), *[F.when(F.col(c), f"missing:{c}") for c in group_fields]))
    return g.select(group, F.array_sort(F.array_distinct(F.concat("_own", whole))).alias("reasons"))


def outcome_class(results: DataFrame, group: str, lane: str, place: str, payout_count: str | None = None) -> DataFrame:
    """Group and outcome: tied if one of places 1 to 3 has several lanes (or several payouts), unique_order for a full permutation,
    unique_top3_abnormal if only the top three are clear, else void."""
    g = results.groupBy(group).agg(
        *[F.count_if(F.col(place) == k).alias(f"n{k}") for k in range(1, 7)],
        F.count("*").alias("n"),
        F.max(payout_count).alias("payouts") if payout_count else F.lit(1).alias("payouts"),
    )
    tied = (F.greatest("n1", "n2", "n3") > 1) | (F.col("payouts") > 1)
    top = (F.col("n1") == 1) & (F.col("n2") == 1) & (F.col("n3") == 1)
    rest = (F.col("n4") == 1) & (F.col("n5") == 1) & (F.col("n6") == 1)
    kind = F.when(tied, "tied").when(top & rest & (F.col("n") == 6), "unique_order").when(top, "unique_top3_abnormal").otherwise("void")
    return g.select(group, kind.alias("outcome"))


def payout_combinations(rows: DataFrame, group: str, combo: str, amount: str) -> DataFrame:
    """Group and its sorted distinct combinations of three different lanes with an amount."""
    digits = F.regexp_extract_all(F.col(combo), F.lit("([1-6])"), F.lit(1))
    good = (F.size(digits) == 3) & (F.size(F.array_distinct(digits)) == 3) & F.col(amount).isNotNull()
    return rows.withColumn("_c", F.when(good, F.array_join(digits, "-"))).groupBy(group).agg(F.sort_array(F.collect_set("_c")).alias("combos"))


def scorable(rows: DataFrame, eligible: str, outcome: str, expected: str, combos: str) -> DataFrame:
    """rows with `scorable`: eligible, a clear top three, and exactly the expected combination paid."""
    ok = F.col(eligible) & F.col(outcome).isin("unique_order", "unique_top3_abnormal") & (F.size(combos) == 1) & (F.element_at(combos, 1) == F.col(expected))
    return rows.withColumn("scorable", F.coalesce(ok, F.lit(False)))


def build_snapshot(entries: DataFrame, group: str, lane: str, finish: str, meta: Sequence[str], features: Sequence[str], required: Sequence[str], least: int = 3, store: Callable[[DataFrame, str], DataFrame] | None = None) -> dict[str, DataFrame]:
    """The snapshot's tables: group_features, entry_features, targets, auxiliary, eligibility.

    `store` writes a table and reads it back; with it the entries and the groups are computed once for all five tables.
    """
    if store:
        entries = store(entries.select(group, lane, finish, *dict.fromkeys([*meta, *features, *required])), "entries")
    missing = [F.count_if(F.col(c).isNull()).alias(f"_m_{c}") for c in required]
    status = target_status(entries, group, lane, finish, least=least, extra=[*[F.first(c).alias(c) for c in meta], *missing])
    why = reasons(
        *[(f"missing:{c}", F.col(f"_m_{c}") > 0) for c in required],
        ("entry_count", F.col("n") < least),
        ("lane_repeated", F.col("n") != F.col("n_lanes")),
        ("lane_range", F.col("max_lane") > 6),
    )
    full = status.withColumn("why", why).withColumn("eligible", F.size("why") == 0)
    if store:
        full = store(full, "groups")
    target_reason = F.when(F.col("target_status") != "unique_order", F.concat(F.lit("target_"), "target_status"))
    all_reasons = F.array_join(F.array_sort(F.array_compact(F.concat("why", F.array(target_reason)))), "|")
    eligibility = full.select(group, *meta, "target_status", "eligible", (F.col("eligible") & (F.col("target_status") == "unique_order")).alias("main"), all_reasons.alias("reasons"))
    keys = full.where("eligible").select(group)
    return {
        "group_features": full.where("eligible").select(group, *meta, F.col("n").alias("n_entries")),
        "entry_features": entries.join(keys, group, "left_semi").select(group, lane, *features),
        "targets": full.where("eligible").select(group, "target_status", "class_id", F.when(F.col("target_status") == "unique_order", F.concat_ws("-", "f1", "f2", "f3")).alias("order_label")),
        "auxiliary": entries.join(keys, group, "left_semi").select(group, lane, F.col(finish).alias("actual_finish")),
        "eligibility": eligibility,
    }


def snapshot_issues(tables: dict[str, DataFrame], group: str, lane: str) -> DataFrame:
    """check, issues: uniqueness, equal key sets, blank classes of unclear outcomes, consistent flags."""
    e, t = tables["eligibility"], tables["targets"]
    keys = e.where("eligible").select(group)
    found = {
        "eligibility_unique": e.groupBy(group).count().where("count > 1"),
        "targets_unique": t.groupBy(group).count().where("count > 1"),
        "entries_unique": tables["entry_features"].groupBy(group, lane).count().where("count > 1"),
        "targets_missing": keys.join(t.select(group), group, "left_anti"),
        "targets_extra": t.select(group).join(keys, group, "left_anti"),
        "class_of_unclear": t.where("target_status <> 'unique_order' and class_id is not null"),
        "class_missing": t.where("target_status = 'unique_order' and class_id is null"),
        "main_not_eligible": e.where("main and not eligible"),
        "auxiliary_keys": keys.join(tables["auxiliary"].select(group).distinct(), group, "left_anti"),
    }
    out = None
    for name, rows in found.items():
        one = rows.agg(F.count("*").alias("issues")).select(F.lit(name).alias("check_name"), "issues")
        out = one if out is None else out.unionByName(one)
    return out


def reconcile_targets(new: DataFrame, old: DataFrame, key: str, value: str) -> DataFrame:
    """Status of each key of two target tables, with the reasons for a mismatch."""
    a = new.select(key, F.col(value).alias("new_value"), F.lit(True).alias("in_new"))
    b = old.select(key, F.col(value).alias("old_value"), F.lit(True).alias("in_old"))
    j = a.join(b, key, "full_outer")
    why = reasons(("missing_old", F.col("in_old").isNull()), ("missing_new", F.col("in_new").isNull()), ("value", F.col("in_new") & F.col("in_old") & ~F.col("new_value").eqNullSafe(F.col("old_value"))))
    status = F.when(F.size("why") == 0, "match").when(F.array_contains("why", "value"), "mismatch").otherwise("one_sided")
    return j.withColumn("why", why).select(key, "new_value", "old_value", status.alias("status"), F.array_join("why", "|").alias("reasons"))


def version_diff(old: DataFrame, new: DataFrame, key: str, main: str) -> DataFrame:
    """change of each key between two versions: unchanged_main, added_main, added_prediction_only, removed, other."""
    j = old.select(key, F.col(main).alias("old_main")).join(new.select(key, F.col(main).alias("new_main")), key, "full_outer")
    change = (
        F.when(F.col("new_main").isNull(), "removed")
        .when(F.col("old_main").isNull() & F.col("new_main"), "added_main")
        .when(F.col("old_main").isNull(), "added_prediction_only")
        .when(F.col("old_main") & F.col("new_main"), "unchanged_main")
        .otherwise("other")
    )
    return j.select(key, change.alias("change"))


def keyset_diff(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys that only one of two tables has, and which."""
    x = a.select(key).distinct().withColumn("_a", F.lit(1))
    y = b.select(key).distinct().withColumn("_b", F.lit(1))
    return x.join(y, key, "full_outer").where("_a is null or _b is null").select(key, F.when(F.col("_b").isNull(), "left").otherwise("right").alias("side"))


def identity_match(a: DataFrame, b: DataFrame, group: str, lane: str, entity: str) -> DataFrame:
    """Whether two tables give a group the same entity per lane; null where one of them has no rows."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.where(F.col(lane).isNotNull()).groupBy(group).agg(F.array_sort(F.collect_set(F.struct(lane, entity))).alias(name))

    j = side(a, "_x").join(side(b, "_y"), group, "full_outer")
    return j.select(group, F.when(F.col("_x").isNull() | F.col("_y").isNull(), F.lit(None).cast("boolean")).otherwise(F.col("_x") == F.col("_y")).alias("match"))
