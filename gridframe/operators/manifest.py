"""One-row manifest of a data set: counts, ranges, missing values, conflicts, gaps, ledger and content hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridframe.operators import audit as au
from gridframe.operators import checks as ck
from gridframe.operators.append import logical_hash


def _listed(counts: DataFrame, key: str, n: str, name: str) -> DataFrame:
    """One row with the text `key:n|key:n`, by key; `counts` has a row a category."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(key).cast("string").alias("k"), F.col(n).cast("long").alias("n"))))
    return counts.agg(F.array_join(F.transform(pairs, lambda x: F.concat_ws(":", x["k"], x["n"])), "|").alias(name))


def dataset_manifest(rows: DataFrame, name: str, group: str, member: str, date: str, category: str, status: str, number: str, declared: str, meta: Sequence[str], columns: Sequence[str], training: Column, ledger: DataFrame) -> DataFrame:
    """One row. `training` says which rows are training rows, `ledger` has batch, mode and rows of every applied batch."""
    month = F.date_format(date, "yyyy-MM")
    blank_rate = lambda c: F.round(100 * F.sum(au.blank(c).cast("long")) / F.count("*"), 2)
    parts = [
        rows.agg(
            F.count("*").alias("raw_row_count"),
            F.countDistinct(group).alias("group_count"),
            F.count_if(training).alias("training_row_count"),
            F.min(date).alias("date_min"),
            F.max(date).alias("date_max"),
            *[F.sum(au.blank(c).cast("long")).alias(f"{c}_missing") for c in columns],
            *[blank_rate(c).alias(f"{c}_missing_percent") for c in columns],
            *[(F.sum(au.blank(c).cast("long")) == F.count("*")).alias(f"{c}_all_missing") for c in columns],
        ),
        _listed(au.count_by(rows, category), "value", "n", "category_rows"),
        _listed(au.groups_by(rows, category, group), "value", "n_groups", "category_groups"),
        _listed(au.groups_by(rows, month, group), "value", "n_groups", "month_groups"),
        _listed(au.count_by(rows, status), "value", "n", "status_counts"),
        _listed(au.top_missing(rows, columns), "column", "missing", "top_missing"),
        _listed(ck.group_size_issues(rows, group, declared, report_missing=True).groupBy("reason").agg(F.count("*").alias("n")), "reason", "n", "size_mismatches"),
        rows.groupBy(group, member).agg(F.count("*").alias("n")).agg(F.sum(F.col("n") - 1).alias("duplicate_members")),
        ck.metadata_conflicts(rows, group, meta).agg(F.count("*").alias("group_conflicts")),
        au.sequence_gaps(rows, [group], number).agg(F.count("*").alias("number_gaps")),
        ledger.agg(F.countDistinct("batch").alias("batches"), F.sum("rows").alias("batch_rows"), F.max("batch").alias("last_batch")),
        logical_hash(rows, columns).select("content_hash"),
    ]
    out = rows.sparkSession.range(1).select(F.lit(1).alias("manifest_version"), F.lit(name).alias("snapshot_name"), F.lit(f"one row per {member} per {group}").alias("row_grain"))
    for part in parts:  # each has one row
        out = out.join(part)
    return out
