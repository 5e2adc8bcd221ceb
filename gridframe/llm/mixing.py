"""Mixing sources to target weights by hierarchical budgeting, in DataFrame operations only.

A token budget flows down a domain - language - source tree by weights. A child that can't use its share (its tokens times
`max_epochs`) leaves the rest to its siblings, and only what a whole family can't use goes to the families beside it. Each
leaf then takes a prefix of tokens from its stream: epochs over all its documents, each in its own seeded order. The order
is a hash of (seed, epoch, doc_id); the place where the budget ends is found by descending through the hash's leading
digits, so neither a leaf nor an epoch is ever sorted in one task.

Null language, source or text count as `unknown` and empty; a document without words has no tokens and stays if the
budget reaches its place. Repeated rows count as often as they stand; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridframe.llm.common import join_small, stored

LEVELS = ["domain", "lang", "source"]
DOMAIN_WEIGHTS = {"domain0": 4.0, "domain1": 3.0, "domain2": 2.0, "domain3": 1.0}
LANG_WEIGHTS = {"en": 4.0, "de": 2.0, "fr": 2.0, "es": 2.0}
BUDGET_SHARE = 0.6
MAX_EPOCHS = 2
SEED = 17


def domain_of(source: str) -> Column:
    """The domain of a source: its number mod 4, or domain0 for sources without one."""
    number = F.regexp_extract(F.col(source), r"(\d{1,9})$", 1)
    return F.concat(F.lit("domain"), (F.when(number == "", 0).otherwise(number.try_cast("long")) % 4).cast("string"))


def leaves_of(docs: DataFrame, *kept: str) -> DataFrame:
    """doc_id, domain, lang, source, tokens (words) and the kept columns."""
    base = docs.withColumns(
        {"_l": F.coalesce("lang", F.lit("unknown")), "_s": F.coalesce("source", F.lit("unknown")), "_t": F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))}
    )
    return base.select("doc_id", domain_of("_s").alias("domain"), F.col("_l").alias("lang"), F.col("_s").alias("source"), F.col("_t").cast("long").alias("tokens"), *kept)


def _weight(column: str, weights: dict[str, float]) -> Column:
    """The weight of a name, 1 where none is given."""
    out = F.lit(1.0)
    for name, w in weights.items():
        out = F.when(F.col(column) == name, F.lit(w)).otherwise(out)
    return out


def _filled(children: DataFrame, parent: list[str]) -> DataFrame:
    """Water-filling: children (weight, capacity) of each parent share its `budget`; full ones leave the rest to siblings."""
    order = [F.col("capacity") / F.col("weight"), *[F.col(c) for c in LEVELS if c in children.columns]]
    w = Window.partitionBy(*parent).orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    onward = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    open_ = children.withColumn("level", level).withColumn("full", F.col("capacity") <= F.col("level") * F.col("weight"))
    final = F.max(F.when(~F.col("full"), F.col("level"))).over(Window.partitionBy(*parent))
    given = F.when(F.col("full") | final.isNull(), F.col("capacity")).otherwise(F.least("capacity", final * F.col("weight")))
    return open_.withColumn("given", given).drop("level", "full", "budget").withColumnRenamed("given", "budget")


def budgets(leaves: DataFrame, budget_share: float, max_epochs: int, domain_weights: dict, lang_weights: dict) -> DataFrame:
    """Token quota of each leaf: domain, lang, source, size (tokens of one epoch), quota."""
    leaf = leaves.groupBy(*LEVELS).agg(F.sum("tokens").alias("size"))
    leaf = leaf.withColumns({"capacity": F.col("size") * F.lit(float(max_epochs)), "weight": F.lit(1.0)})
    lang = leaf.groupBy("domain", "lang").agg(F.sum("capacity").alias("capacity")).withColumn("weight", _weight("lang", lang_weights))
    domain = lang.groupBy("domain").agg(F.sum("capacity").alias("capacity")).withColumn("weight", _weight("domain", domain_weights))
    whole = F.sum("capacity").over(Window.partitionBy("root")) / F.lit(float(max_epochs)) * F.lit(budget_share)
    domain = domain.withColumn("root", F.lit(0)).withColumn("budget", F.floor(whole + F.lit(1e-6)).cast("double"))
    domain = _filled(domain, ["root"])
    lang = _filled(lang.join(domain.select("domain", "budget"), "domain"), ["domain"])
    leaf = _filled(leaf.join(lang.select("domain", "lang", "budget"), ["domain", "lang"]), ["domain", "lang"])
    return leaf.select(*LEVELS, "size", F.floor(F.col("budget") + F.lit(1e-6)).cast("long").alias("quota"))


def _order(seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), "epoch", "doc_id").cast("binary"))


def mix(leaves: DataFrame, budget_share: float = BUDGET_SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED, domain_weights: dict | None = None, lang_weights: dict | None = None) -> DataFrame:
    """Leaves' rows (a stored table, as it is read several times) with `epoch`: one row for each time a document is taken."""
    quota = budgets(leaves, budget_share, max_epochs, DOMAIN_WEIGHTS if domain_weights is None else domain_weights, LANG_WEIGHTS if lang_weights is None else lang_weights)
    names = ["domain", "lang", "source"]
    whole = F.when(F.col("size") > 0, F.least(F.floor(F.col("quota") / F.col("size")), F.lit(max_epochs))).otherwise(1).cast("int")
    quota = quota.withColumns({"whole": whole, "left": F.when(F.col("size") > 0, F.col("quota") - whole * F.col("size")).otherwise(0)})
    rows = join_small(leaves, stored(quota.select(*names, "size", "whole", "left"), "quota"), names, "inner")
    full = rows.where("whole > 0").withColumn("epoch", F.explode(F.sequence(F.lit(1), "whole"))).drop("size", "whole", "left")
    part = rows.where((F.col("left") > 0) & (F.col("whole") < max_epochs)).withColumn("epoch", F.col("whole") + 1)
    part = part.withColumn("place", _order(seed)).drop("size", "whole")
    taken, digits = [], 2
    for at in (1, 3):  # two steps of 256 and then the exact order within the bucket where the budget ends
        bucket = F.substring("place", at, digits)
        sums = part.withColumn("bucket", bucket).groupBy(*names, "left", "bucket").agg(F.sum("tokens").alias("sum"))
        run = F.sum("sum").over(Window.partitionBy(*names).orderBy("bucket"))
        ends = sums.withColumn("run", run).withColumn("before", F.col("run") - F.col("sum"))
        ends = ends.where(F.col("before") <= F.col("left"))
        ends = ends.select(*names, "bucket", (F.col("run") <= F.col("left")).alias("inside"), (F.col("left") - F.col("before")).alias("rest"))
        part = part.withColumn("bucket", bucket).join(ends, [*names, "bucket"])
        taken.append(part.where("inside").drop("left", "place", "bucket", "inside", "rest"))
        part = part.where("not inside").drop("left", "bucket", "inside").withColumnRenamed("rest", "left")
    run = F.sum("tokens").over(Window.partitionBy(*names).orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    taken.append(part.withColumn("run", run).where("run <= left").drop("left", "place", "run"))
    out = full
    for t in taken:
        out = out.unionByName(t)
    return out


def op8_source_mix(spark, sf_dir: str) -> DataFrame:
    leaves = stored(leaves_of(spark.read.parquet(f"{sf_dir}/documents.parquet")), "leaves")
    return mix(leaves).select("doc_id", "domain", "lang", "source", "tokens", F.col("epoch").cast("long").alias("epoch"))


def _case(column: str, weights: dict[str, float]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN CAST({v} AS DOUBLE)" for k, v in weights.items()) + " ELSE CAST(1 AS DOUBLE) END"


def _fill_sql(name: str, source: str, parent: str, order: str) -> str:
    return f"""
{name}_l AS (SELECT *, (budget - coalesce(sum(capacity) OVER (PARTITION BY {parent} ORDER BY capacity / weight, {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
   / sum(weight) OVER (PARTITION BY {parent} ORDER BY capacity / weight, {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv FROM {source}),
{name}_f AS (SELECT *, max(CASE WHEN capacity > lv * weight THEN lv END) OVER (PARTITION BY {parent}) AS fin FROM {name}_l),
{name} AS (SELECT * EXCLUDE (budget, lv, fin), CASE WHEN capacity <= lv * weight OR fin IS NULL THEN capacity ELSE least(capacity, fin * weight) END AS budget FROM {name}_f)"""


OP8_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,
   CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS tokens FROM documents),
t AS (SELECT *, 'domain' || CASE WHEN regexp_extract(source, '(\d{{1,9}})$', 1) = '' THEN 0 ELSE CAST(regexp_extract(source, '(\d{{1,9}})$', 1) AS BIGINT) % 4 END AS domain FROM d),
leaf0 AS (SELECT domain, lang, source, sum(tokens) AS size, CAST(sum(tokens) * {MAX_EPOCHS} AS DOUBLE) AS capacity, CAST(1 AS DOUBLE) AS weight FROM t GROUP BY ALL),
lang0 AS (SELECT domain, lang, sum(capacity) AS capacity, {_case("lang", LANG_WEIGHTS)} AS weight FROM leaf0 GROUP BY domain, lang),
dom0 AS (SELECT 0 AS root, domain, sum(capacity) AS capacity, {_case("domain", DOMAIN_WEIGHTS)} AS weight FROM lang0 GROUP BY domain),
dom1 AS (SELECT *, CAST(floor(sum(capacity) OVER () / {float(MAX_EPOCHS)} * {BUDGET_SHARE} + 1e-6) AS DOUBLE) AS budget FROM dom0),
{_fill_sql("dom", "dom1", "root", "domain")},
lang1 AS (SELECT lang0.*, dom.budget FROM lang0 JOIN dom USING (domain)),
{_fill_sql("lng", "lang1", "domain", "lang")},
leaf1 AS (SELECT leaf0.*, lng.budget FROM leaf0 JOIN lng USING (domain, lang)),
{_fill_sql("lf", "leaf1", "domain, lang", "source")},
q AS (SELECT domain, lang, source, size, CAST(floor(budget + 1e-6) AS BIGINT) AS quota FROM lf),
w AS (SELECT *, CASE WHEN size > 0 THEN least(quota // size, {MAX_EPOCHS}) ELSE 1 END AS whole FROM q),
x AS (SELECT t.*, whole, CASE WHEN size > 0 THEN quota - whole * size ELSE 0 END AS rest FROM t JOIN w USING (domain, lang, source)),
f AS (SELECT doc_id, domain, lang, source, tokens, unnest(range(1, CAST(whole AS BIGINT) + 1)) AS epoch FROM x),
p AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('{SEED}|' || (whole + 1) || '|' || doc_id), doc_id ROWS UNBOUNDED PRECEDING) AS run
   FROM x WHERE rest > 0 AND whole < {MAX_EPOCHS})
SELECT doc_id, domain, lang, source, tokens, CAST(epoch AS BIGINT) AS epoch FROM f
UNION ALL SELECT doc_id, domain, lang, source, tokens, CAST(whole + 1 AS BIGINT) AS epoch FROM p WHERE run <= rest"""
