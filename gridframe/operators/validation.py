"""Validation of a snapshot's tables in one pass: row checks as one projection a table, key sets by one tagged union.

Every table is read once. Its rows become (table, group, lane, a few values, the bits of the row checks they break), the union of
all tables is aggregated by group and the groups to one row of counts. Broken rows are counted in that aggregation and not by
observed metrics, which count the rows of a repeated map task twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridframe.functions.orders import class_table
from gridframe.operators.checks import schema_issues

STATUSES = ["unique_order", "tied", "void", "abandoned"]
TABLES = ["eligibility", "targets", "group_features", "entry_features", "auxiliary"]


def _blank(c: str) -> Column:
    return F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")


def row_checks(group: str, lane: str, required: dict[str, Sequence[str]], lanes: int, classes: int) -> dict[str, dict[str, Column]]:
    """Table -> check -> whether a row breaks it. targets has `_label`, the label of its class."""
    status, unique = F.col("target_status"), F.col("target_status") == "unique_order"
    bad_lane = F.coalesce(~F.col(lane).between(1, lanes), F.lit(True))
    outside = F.coalesce(~F.col("class_id").between(0, classes - 1), F.lit(False))
    checks = {
        "eligibility": {
            "main_not_eligible": F.col("main") & ~F.col("eligible"),
            "main_not_unique": F.col("main") & ~unique,
            "unique_not_main": F.col("eligible") & unique & ~F.col("main"),
            "excluded_without_reason": ~F.col("eligible") & (F.coalesce("reasons", F.lit("")) == ""),
            "main_with_reason": F.col("main") & (F.coalesce("reasons", F.lit("")) != ""),
        },
        "targets": {
            "class_missing": unique & F.col("class_id").isNull(),
            "class_range": unique & outside,
            "class_of_unclear": ~unique & F.col("class_id").isNotNull(),
            "label_of_class": unique & F.col("class_id").isNotNull() & ~outside & ~F.col("order_label").eqNullSafe(F.col("_label")),
            "label_of_unclear": ~unique & (F.coalesce("order_label", F.lit("")) != ""),
        },
        "group_features": {},
        "entry_features": {"lane": bad_lane},
        "auxiliary": {"lane": bad_lane, "finish": F.coalesce(F.col("actual_finish") < 1, F.lit(True))},
    }
    for name, own in checks.items():
        own["blank_key"] = _blank(group)
        if name in ("eligibility", "targets"):
            own["status"] = F.coalesce(~status.isin(*STATUSES), F.lit(True))
        own |= {f"blank_{c}": _blank(c) for c in required.get(name, ())}
    return checks


def _group_checks() -> dict[str, Column]:
    """Checks of a group's rows in all tables; n_x counts them, lanes_x has a bit a lane."""
    has = lambda x: F.col(f"n_{x}") > 0
    known, eligible = has("eligibility"), F.coalesce("eligible", F.lit(False))
    out = {f"{t}_unique": F.col(f"n_{t}") > 1 for t in ("eligibility", "targets", "group_features")}
    out["targets_status"] = has("targets") & known & ~F.col("status_targets").eqNullSafe(F.col("status_eligibility"))
    for t in TABLES[1:]:
        out[f"{t}_missing"] = eligible & ~has(t)
        out[f"{t}_extra"] = has(t) & ~eligible
    for t in ("entry_features", "auxiliary"):
        bits = F.coalesce(f"lanes_{t}", F.lit(0).cast("long"))
        out[f"{t}_lane_twice"] = F.col(f"valid_{t}") > F.bit_count(bits)
        # Lanes from 1 on without a gap are one less than a power of two; there are as many as the group has entries.
        out[f"{t}_lane_set"] = has(t) & ((bits.bitwiseAND(bits + 1) != 0) | (F.bit_count(bits) != F.coalesce("n_entries", F.bit_count(bits))))
    out["lanes_differ"] = has("entry_features") & has("auxiliary") & ~F.col("lanes_entry_features").eqNullSafe(F.col("lanes_auxiliary"))
    return out


def validate_snapshot(tables: dict[str, DataFrame], group: str, lane: str, required: dict[str, Sequence[str]], contract: dict[str, Sequence[str]], forbidden: Sequence[str] = (), profile: dict[str, int] | None = None, lanes: int = 6) -> DataFrame:
    """check_name, issues of a snapshot's five tables.

    `contract` has each table's header, `forbidden` the columns that features may not have, `profile` recorded counts: rows of
    a table under its name, eligible, excluded, main, main_excluded, and status:<status>. Each recorded count that differs from
    the actual one is an issue.
    """
    spark = tables["eligibility"].sparkSession
    classes = class_table(spark).select(F.col("class_id").alias("_class"), F.col("label").alias("_label"))
    checks = row_checks(group, lane, required, lanes, 120)
    rows, names = None, []
    for name in TABLES:
        df = tables[name]
        if name == "targets":  # 120 rows
            df = df.join(F.broadcast(classes), F.col("class_id") == F.col("_class"), "left")
        bits = F.lit(0).cast("long")
        for check, broken in checks[name].items():
            bits = bits + F.when(F.coalesce(broken, F.lit(False)), F.lit(1 << len(names)).cast("long")).otherwise(F.lit(0))
            names.append(f"{name}:{check}")
        value = lambda c: F.col(c) if c in df.columns else F.lit(None)  # noqa: B023, E731
        one = df.select(
            F.lit(name).alias("t"),
            F.col(group).alias("g"),
            (F.col(lane) if lane in df.columns else F.lit(None)).cast("long").alias("lane"),
            value("target_status").cast("string").alias("status"),
            value("eligible").cast("boolean").alias("eligible"),
            value("main").cast("boolean").alias("main"),
            value("n_entries").cast("long").alias("n_entries"),
            bits.alias("bits"),
        )
        rows = one if rows is None else rows.unionByName(one)
    is_ = lambda t: F.col("t") == t
    good = F.col("lane").between(1, lanes)
    lane_bit = lambda t: F.when(is_(t) & good, F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("lane") - 1).cast("int")))
    groups = rows.groupBy("g").agg(
        *[F.count_if(is_(t)).alias(f"n_{t}") for t in TABLES],
        *[F.max(F.when(is_(t), F.col("status"))).alias(f"status_{t}") for t in ("eligibility", "targets")],
        *[F.bit_or(lane_bit(t)).alias(f"lanes_{t}") for t in ("entry_features", "auxiliary")],
        *[F.count_if(is_(t) & good).alias(f"valid_{t}") for t in ("entry_features", "auxiliary")],
        F.bool_or("eligible").alias("eligible"),
        F.max("n_entries").alias("n_entries"),
        F.count_if("eligible").alias("c_eligible"),
        F.count_if("main").alias("c_main"),
        *[F.count_if(is_("eligibility") & (F.col("status") == s)).alias(f"c_status:{s}") for s in STATUSES],
        *[F.sum(F.getbit("bits", F.lit(k)).cast("long")).alias(f"b{k}") for k in range(len(names))],
    )
    of_groups = _group_checks()
    counts = groups.agg(
        *[F.coalesce(F.sum(f"b{k}"), F.lit(0)).alias(n) for k, n in enumerate(names)],
        *[F.count_if(c).alias(n) for n, c in of_groups.items()],
        *[F.coalesce(F.sum(f"n_{t}"), F.lit(0)).alias(f"count:{t}") for t in TABLES],
        *[F.coalesce(F.sum(f"c_{c}"), F.lit(0)).alias(f"count:{c}") for c in ("eligible", "main", *[f"status:{s}" for s in STATUSES])],
    ).first()
    total = counts["count:eligibility"]
    actual = {k[6:]: v for k, v in counts.asDict().items() if k.startswith("count:")} | {"excluded": total - counts["count:eligible"], "main_excluded": total - counts["count:main"]}
    out = [(n, int(counts[n])) for n in (*names, *of_groups)]
    for t in TABLES:
        out.append((f"{t}_columns", len(schema_issues(tables[t].columns, contract[t], forbidden if t.endswith("features") else ()))))
    out += [(f"profile:{k}", int(actual[k] != v)) for k, v in sorted((profile or {}).items())]
    return spark.createDataFrame(out, "check_name string, issues long")
