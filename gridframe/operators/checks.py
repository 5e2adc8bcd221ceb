"""Row and group checks. Every check returns issues: row_no, group_id, column, rule, message."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridframe.functions.text import blank_to_null, clean, parse_bool

ISSUE = ["row_no", "group_id", "column", "rule", "message"]

#: Rule kind -> whether a trimmed, non-blank value breaks it.
def _breaks(kind: str, v: Column, arg) -> Column:
    if kind == "pattern":
        return ~v.rlike(arg)
    if kind == "enum":
        return ~v.isin(*arg)
    if kind == "date":
        return ~((F.length(v) == 10) & v.rlike(r"^\d{4}-\d{2}-\d{2}$") & v.try_cast("date").isNotNull())
    if kind == "int":
        return ~v.rlike(r"(?U)^-?\d+$")
    if kind == "decimal":
        return v.try_cast("double").isNull()
    if kind == "bool":
        return parse_bool(v).isNull()
    if kind == "status":
        return ~(v.isin(*arg) | (v.rlike(r"^\d+$") & F.coalesce(v.try_cast("long") > 0, F.lit(False))))
    raise ValueError(f"no rule kind {kind}")


#: Rule kinds for which a blank value is a fault too.
_BLANK_BREAKS = {"pattern", "enum", "date", "required"}


def row_issues(rules: Sequence[tuple[str, str, object]]) -> Column:
    """The issues of a row under rules (column, kind, argument), as an array."""
    found = []
    for column, kind, arg in rules:
        v = clean(F.col(column).cast("string"))
        bad = (v == "") if kind == "required" else F.when(v == "", F.lit(kind in _BLANK_BREAKS)).otherwise(_breaks(kind, v, arg))
        issue = F.struct(F.lit(column).alias("column"), F.lit(kind).alias("rule"), F.concat(F.lit(f"{column} fails {kind}: "), v).alias("message"))
        found.append(F.when(bad, issue))
    return F.array_compact(F.array(*found))


def check_rows(df: DataFrame, rules: Sequence[tuple[str, str, object]], row_no: str, group: str) -> DataFrame:
    """Issues of rules (column, kind, argument); one pass over df, whatever the number of rules."""
    rows = df.select(F.col(row_no).alias("row_no"), F.col(group).cast("string").alias("group_id"), F.explode(row_issues(rules)).alias("i"))
    return rows.select("row_no", "group_id", "i.*")


def duplicates_in_group(df: DataFrame, group: str, member: str, ordinal: str, integers: bool = False) -> DataFrame:
    """Second and later rows of one (group, member) with the ordinal of the first; ordinal breaks ties.

    With `integers` only members that look like a number count, without white space around it.
    """
    if integers:
        df = df.withColumn(member, F.when(clean(F.col(member).cast("string")).rlike(r"(?U)^-?\d+$"), clean(F.col(member).cast("string"))))
    w = Window.partitionBy(group, member).orderBy(ordinal)
    rows = df.where(F.col(member).isNotNull()).withColumns({"nth": F.row_number().over(w), "first_row": F.first(ordinal).over(w)})
    return rows.where("nth > 1").select(F.col(group).alias("group_id"), F.col(member).alias("member"), F.col(ordinal).alias("row_no"), "first_row")


def group_size_issues(df: DataFrame, group: str, declared: str, tolerance: int = 1, report_missing: bool = False) -> DataFrame:
    """Groups whose declared size is missing (if asked for), ambiguous or off by more than the tolerance."""
    g = df.groupBy(F.col(group).alias("group_id")).agg(F.countDistinct(declared).alias("kinds"), F.max(declared).cast("long").alias("declared"), F.count("*").alias("actual"))
    g = g.withColumn("diff", F.when(F.col("kinds") == 1, F.col("declared") - F.col("actual")))
    missing = F.when(F.col("kinds") == 0, F.lit("missing")) if report_missing else F.when(F.col("kinds") == 0, F.lit(None).cast("string"))
    reason = F.when(F.col("kinds") == 0, missing).when(F.col("kinds") > 1, "ambiguous").when(F.abs("diff") > tolerance, "mismatch")
    declared_one = F.when(F.col("kinds") == 1, F.col("declared"))
    return g.withColumn("reason", reason).where("reason is not null").select("group_id", "reason", declared_one.alias("declared"), "actual", "diff")


def schema_issues(columns: Sequence[str], contract: Sequence[str], forbidden: Sequence[str] = (), tokens: Sequence[str] = ()) -> list[str]:
    """Header differences, in order, and forbidden columns by name or token; looks at names only."""
    out = [] if list(columns) == list(contract) else [f"header differs: missing {sorted(set(contract) - set(columns))}, extra {sorted(set(columns) - set(contract))}"]
    return out + [f"forbidden column {c}" for c in columns if c in forbidden or any(t.lower() in c.lower() for t in tokens)]


def overlap(new: DataFrame, old: DataFrame, key: str, limit: int = 50) -> DataFrame:
    """First keys (sorted) of new that old has too, each with the number of all of them."""
    both = new.select(key).distinct().join(old.select(key).distinct(), key, "left_semi")
    return both.orderBy(key).limit(limit).crossJoin(F.broadcast(both.agg(F.count("*").alias("n_all"))))  # one row


def scope_issues(df: DataFrame, column: str, required: str | None = None) -> DataFrame:
    """One row: the scopes of a batch and its fault, if it has more than one, none, or not the required one."""
    g = df.agg(F.sort_array(F.collect_set(blank_to_null(column))).alias("scopes"))
    fault = F.when(F.size("scopes") == 0, "none").when(F.size("scopes") > 1, "several")
    if required is not None:
        fault = fault.when(F.element_at("scopes", 1) != required, "other")
    return g.select(F.array_join("scopes", "|").alias("scopes"), F.coalesce(fault, F.lit("ok")).alias("verdict"))


def metadata_conflicts(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """Groups whose rows differ in columns that describe the group."""
    return df.groupBy(F.col(group).alias("group_id")).agg(F.countDistinct(F.struct(*columns)).alias("signatures"), F.count("*").alias("n_rows")).where("signatures > 1")


def required_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, missing: blank values of required columns, in one pass."""
    counts = df.agg(*[F.sum(F.when(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""), 1).otherwise(0)).alias(c) for c in columns])
    return counts.unpivot([], [F.col(c) for c in columns], "column", "missing")


#: Faults of a probability row.
FAULTS = ["length", "blank", "not finite", "outside [0,1]", "sum"]


def prob_issues(pred: DataFrame, key: str, p: str, n: int, tolerance: float = 1e-10) -> DataFrame:
    """key and the first fault of a probability row: length, blank, finite, range or sum."""
    total = F.aggregate(p, F.lit(0.0), lambda a, x: a + x)
    fault = (
        F.when(F.col(p).isNull() | (F.size(p) != n), "length")
        .when(F.exists(p, lambda x: x.isNull()), "blank")
        .when(F.exists(p, lambda x: F.isnan(x) | (F.abs(x) == float("inf"))), "not finite")
        .when(F.exists(p, lambda x: (x < 0) | (x > 1)), "outside [0,1]")
        .when(F.abs(total - 1) > tolerance, "sum")
    )
    return pred.select(F.col(key).alias("key"), fault.alias("fault")).where("fault is not null")


def valid_keys(pred: DataFrame, key: str, p: str, n: int, tolerance: float = 1e-10) -> DataFrame:
    """Keys with a row of n finite, non-negative probabilities of sum 1; there is no upper bound per value."""
    total = F.aggregate(p, F.lit(0.0), lambda a, x: a + x)
    good = (F.size(p) == n) & F.forall(p, lambda x: x.isNotNull() & ~F.isnan(x) & (x >= 0)) & (F.abs(total - 1) <= tolerance)
    return pred.where(good).select(F.col(key).alias("key")).distinct()


def cross_job_overlap(jobs: DataFrame, key: str, job: str, existing: DataFrame) -> DataFrame:
    """Keys planned twice in a job, in several jobs, or that exist already."""
    g = jobs.groupBy(key).agg(F.count("*").alias("n"), F.countDistinct(job).alias("jobs"))
    old = existing.select(key).distinct().withColumn("exists", F.lit(True))
    g = g.join(old, key, "left").withColumn("exists", F.coalesce("exists", F.lit(False)))
    g = g.withColumns({"within": F.col("n") > F.col("jobs"), "between": F.col("jobs") > 1})
    return g.where("within or between or exists").select(F.col(key).alias("key"), "n", "jobs", "within", "between", "exists")


def reconcile(manifest: DataFrame, listing: DataFrame, key: str, hash_column: str) -> DataFrame:
    """Status of every key in a manifest or a listing: duplicate, missing, unlisted, empty, hash mismatch or ok."""
    m = manifest.groupBy(key).agg(F.count("*").alias("listed"), F.min(hash_column).alias("want"))
    f = listing.groupBy(key).agg(F.min(hash_column).alias("have"), F.max("bytes").alias("bytes"), F.lit(True).alias("present"))
    both = m.join(f, key, "full_outer")
    status = (
        F.when(F.col("listed") > 1, "duplicate")
        .when(F.col("present").isNull(), "missing")
        .when(F.col("listed").isNull(), "unlisted")
        .when(F.coalesce("bytes", F.lit(0)) == 0, "empty")
        .when(F.col("want") != F.col("have"), "hash mismatch")
        .otherwise("ok")
    )
    return both.select(F.col(key).alias("key"), status.alias("status"))


def bundle_status(manifest: DataFrame, listing: DataFrame, imported: DataFrame, key: str, path: str, hash_column: str, pattern: str) -> DataFrame:
    """Status of every key of a bundle: bad id, path mismatch, already imported, or else that of reconcile."""
    m = manifest.groupBy(key).agg(F.min(path).alias("_path"))
    named = m.select(key, (~F.col(key).cast("string").rlike(pattern)).alias("_bad"), (F.regexp_extract("_path", r"([^/]+)\.[^./]*$", 1) != F.col(key).cast("string")).alias("_moved"))
    old = imported.select(key).distinct().withColumn("_old", F.lit(True))
    out = reconcile(manifest, listing, key, hash_column).withColumnRenamed("key", key).join(named, key, "left").join(old, key, "left")
    status = F.when(F.col("_bad"), "bad id").when(F.col("_moved"), "path mismatch").when(F.col("_old") & F.col("status").isin("ok"), "already imported").otherwise(F.col("status"))
    return out.select(F.col(key).alias("key"), status.alias("status"))


def id_issues(df: DataFrame, id_column: str, pattern: str, parts: Sequence[Column]) -> DataFrame:
    """Rows whose id doesn't match the pattern, or whose columns differ from the id's groups in order."""
    v = F.col(id_column).cast("string")
    same = F.lit(True)
    for k, part in enumerate(parts, 1):
        same = same & (F.regexp_extract(v, pattern, k) == part.cast("string"))
    return df.where(~F.coalesce(v.rlike(pattern) & same, F.lit(False)))


def accept_batch(new: DataFrame, old: DataFrame, group: str, member: str, ordinal: str, declared: str, scope: str, meta: Sequence[str], rules: Sequence = (), contract: Sequence[str] | None = None, ids: tuple | None = None) -> DataFrame:
    """rule, issues: number of issues of every check on an incoming batch; an empty batch is an issue itself.

    `contract` is the header that both tables must have in order, `ids` the arguments of id_issues behind the table.
    """
    parts = {
        "rows": check_rows(new, rules, ordinal, group) if rules else new.limit(0),
        "duplicates": duplicates_in_group(new, group, member, ordinal),
        "sizes": group_size_issues(new, group, declared, 0),
        "overlap": new.select(group).distinct().join(old.select(group).distinct(), group, "left_semi"),
        "metadata": metadata_conflicts(new, group, meta),
        "scope": scope_issues(new, scope).where("verdict <> 'ok'"),
    }
    if ids is not None:
        parts["identity"] = id_issues(new, *ids)
    out = new.agg(F.when(F.count("*") == 0, 1).otherwise(0).cast("long").alias("issues")).select(F.lit("empty").alias("rule"), "issues")
    for name, issues in parts.items():
        out = out.unionByName(issues.agg(F.count("*").alias("issues")).select(F.lit(name).alias("rule"), "issues"))
    if contract is not None:
        wrong = len(schema_issues(new.columns, contract)) + len(schema_issues(old.columns, contract))
        out = out.unionByName(new.sparkSession.range(1).select(F.lit("header").alias("rule"), F.lit(wrong).cast("long").alias("issues")))
    return out
