"""Targets against their sources, and results of earlier groups on the same day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridframe.functions.orders import class_table


def reconcile_sources(facts: DataFrame, old: DataFrame, new: DataFrame, payouts: DataFrame, audit: DataFrame, key: str, context: Sequence[str]) -> DataFrame:
    """Every group's old and new target held against its raw result and its payouts: 29 columns where `context` has eight.

    facts: key, the `context` columns, outcome, finishes (by lane), f1, f2, f3 (null if there is no clear top three),
    identity_match, scorable. old, new: key, target_status, class_id. payouts, audit: key, combo, a row a winning combination.
    All five are one tagged union and one aggregation by key; only keys of `facts` come out. Repeated rows count once.
    """
    decoded = class_table(facts.sparkSession).select(F.col("class_id").alias("_id"), F.col("label").alias("combo"))  # 120 rows
    with_combo = lambda t: t.join(F.broadcast(decoded), F.col("class_id") == F.col("_id"), "left")
    tag = lambda df, name, *cols: df.select(F.col(key), F.struct(*cols).alias(name))
    target = lambda t, name: tag(with_combo(t), name, F.col("target_status").alias("status"), F.col("class_id").cast("int").alias("class_id"), "combo")
    rest = [c for c in facts.columns if c != key]
    rows = tag(facts, "fact", *rest)
    for other in (target(old, "old"), target(new, "new"), payouts.select(key, F.col("combo").alias("paid")), audit.select(key, F.col("combo").alias("audited"))):
        rows = rows.unionByName(other, allowMissingColumns=True)
    sets = {n: F.array_sort(F.collect_set(n)).alias(n) for n in ("paid", "audited")}
    g = rows.groupBy(key).agg(F.min("fact").alias("fact"), F.min("old").alias("old"), F.min("new").alias("new"), *sets.values()).where("fact is not null")
    g = g.select(key, "fact.*", "old", "new", "paid", "audited")
    clear = F.col("f1").isNotNull() & F.col("f2").isNotNull() & F.col("f3").isNotNull()
    g = g.withColumns({"raw_combo": F.when(clear, F.concat_ws("-", "f1", "f2", "f3")), "old_exists": F.col("old").isNotNull()})
    paid = F.coalesce(F.array_contains("paid", F.col("raw_combo")), F.lit(False))
    audited = (F.size("audited") > 0) & ~F.coalesce(F.array_contains("audited", F.col("raw_combo")), F.lit(False))
    same = lambda t: F.col(f"{t}.combo").eqNullSafe(F.col("raw_combo"))
    once = F.coalesce((F.size("paid") == 1) & (F.get("paid", 0) == F.col("raw_combo")), F.lit(False))
    ladder = [
        ("old_target_differs_from_result", F.col("old_exists") & ~same("old")),
        ("old_target_not_paid", F.col("old_exists") & ~paid),
        ("old_target_not_in_audit", F.col("old_exists") & audited),
        ("new_class_differs_from_result", F.col("scorable") & ~same("new")),
        ("new_target_not_paid_alone", F.col("scorable") & ~once),
        ("tie_as_one_class", (F.col("outcome") == "tied") & F.col("new.class_id").isNotNull()),
    ]
    g = g.withColumn("mismatch_reasons", F.array_join(F.array_compact(F.array(*[F.when(c, n) for n, c in ladder])), "|"))
    status = F.when(F.col("mismatch_reasons") != "", "mismatch").when(F.col("outcome") == "tied", "tied_several_winners").when(F.col("scorable") & ~F.col("old_exists"), "recovered").when(F.col("scorable"), "matched").otherwise("not_scorable")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return g.select(
        key, *context, "outcome", F.to_json("finishes").alias("finish_by_lane"), text("raw_combo").alias("raw_combo"), F.array_join("paid", "|").alias("payout_combos"), F.array_join("audited", "|").alias("audit_combos"), "identity_match",
        "old_exists", text("old.status").alias("old_status"), F.col("old.class_id").alias("old_class"), text("old.combo").alias("old_combo"), (F.col("old_exists") & same("old")).alias("old_matches_raw"), (F.col("old_exists") & paid).alias("old_matches_payout"),
        text("new.status").alias("new_status"), F.col("new.class_id").alias("new_class"), text("new.combo").alias("new_combo"), (F.col("scorable") & same("new")).alias("new_matches_raw"), (F.col("scorable") & paid).alias("new_matches_payout"), "scorable", status.alias("status"), "mismatch_reasons",
    )


#: The predicates of a same-day result, in the order in which the first that fails is the reason.
PREDICATES = ["same_date", "same_venue", "same_entity", "earlier_number", "finished_before_available", "printed", "available_by_cutoff", "artifact_kept", "no_later_fields"]


def same_day_result(rows: DataFrame, entity: str, date: str, order: Sequence[str], key: str, venue: str, finished: str, available: str, captured: str, cutoff: str, printed: str, artifact: Column, source_ok: Column, audited: Column) -> DataFrame:
    """rows with the entity's previous group of the day, nine predicates, provenance, reason and the value that may be used.

    Two times count: when the earlier group was over and when its result could be read for this one. `printed` is the value that
    the group's own preview shows, `available` its publication, `captured` when it was fetched, `cutoff` the time of the
    prediction. The earlier group comes from the order of the day, its result is never joined.
    timestamp_confirmed: all predicates hold and it was captured by the cutoff. semantic_confirmed: all hold, captured later or at
    an unknown time, and the page was audited. semantic_candidate: printed and in order, but a time or the audit is missing.
    insufficient: anything else. The value is null for the last two, with the first reason.
    """
    w = Window.partitionBy(entity, date).orderBy(*order)
    before = F.lag(F.struct(F.col(key).alias("key"), F.col(date).alias("date"), F.col(entity).alias("entity"), F.col(venue).alias("venue"), F.struct(*order).alias("at"), F.col(finished).alias("finished"))).over(w)
    out = rows.withColumn("_p", before)
    yes = lambda c: F.coalesce(c, F.lit(False))
    some = F.col("_p").isNotNull()
    found = {
        "same_date": yes(F.col("_p.date") == F.col(date)),
        "same_venue": yes(F.col("_p.venue") == F.col(venue)),
        "same_entity": yes(F.col("_p.entity") == F.col(entity)),
        "earlier_number": yes(F.col("_p.at")[order[0]] < F.col(order[0])),
        "finished_before_available": yes(F.col("_p.finished") < F.col(available)),
        "printed": F.col(printed).isNotNull(),
        "available_by_cutoff": yes(F.col(available) <= F.col(cutoff)),
        "artifact_kept": yes(artifact),
        "no_later_fields": yes(source_ok),
    }
    out = out.withColumns(found)
    every = lambda names: F.forall(F.array(*names), lambda x: x)
    all_hold = every(PREDICATES)
    identity = every(["same_date", "same_venue", "same_entity", "earlier_number", "printed", "no_later_fields"])
    # A time that isn't known leaves a candidate; one that contradicts does not.
    unknown = lambda flag, *times: F.col(flag) | sum((F.col(t).isNull().cast("int") for t in times[1:]), F.col(times[0]).isNull().cast("int")).cast("boolean")
    candidate = identity & unknown("finished_before_available", "_p.finished", available) & unknown("available_by_cutoff", available, cutoff)
    confidence = F.when(all_hold & yes(F.col(captured) <= F.col(cutoff)), "timestamp_confirmed").when(all_hold & yes(audited), "semantic_confirmed").when(candidate, "semantic_candidate").otherwise("insufficient")
    reason = F.when(~some, "no_earlier_group").otherwise(F.coalesce(*[F.when(~F.col(p), p) for p in PREDICATES], F.when(F.col("confidence") == "semantic_candidate", "not_audited"), F.lit("ok")))
    out = out.withColumn("confidence", F.when(some, confidence).otherwise("insufficient"))
    usable = F.col("confidence").isin("timestamp_confirmed", "semantic_confirmed")
    return out.withColumns({"previous": F.col("_p.key"), "reason": reason, "value_used": F.when(usable, F.col(printed))}).drop("_p")
