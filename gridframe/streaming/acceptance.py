"""A stream of batches whose groups are judged over all batches so far: accepted, pending or quarantined.

A group may come in pieces. What is known of it is kept as state, a row per batch, group and member, and every batch judges
the groups that it touches from their state of earlier batches and its own rows. Faults never go away, so a group that turns
bad in a later batch takes its earlier rows with it: a row's status is the newest verdict on its group.

Everything is written under the batch's number and a batch reads numbers below its own only, so a replayed batch
writes the same again. Its ledger entry comes last, and rows and verdicts without one aren't read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridframe.operators.checks import row_issues
from gridframe.sources.shared import dealt, exists, join_counted, listed

#: So many batches' state is merged into one table.
COMPACT = 16
#: How two states of a member become one.
_MERGE = {"n": F.sum, "broken": F.sum, "least": F.min, "most": F.max, "meta_a": F.min, "meta_b": F.max}


class Acceptance:
    """Rules: row checks (`rules`, as check_rows takes them, and the SQL condition `good`), one row a member of a group,
    one value of each `meta` column, and as many rows as `declared` says; fewer leave the group pending.

    `root` is a folder that driver and executors share. Null groups are a group of their own, null members don't repeat.
    """

    def __init__(self, spark: SparkSession, root: str, group: str, member: str, rules: Sequence = (), good: str = "true", declared: str | None = None, meta: Sequence[str] = (), compact: int = COMPACT) -> None:
        self.spark, self.root, self.group, self.member, self.rules, self.good, self.declared, self.meta, self.compact = spark, root, group, member, rules, good, declared, meta, compact

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        return stream.writeStream.foreachBatch(self.accept).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    # ---- one batch

    def _path(self, name: str, number: int) -> str:
        return f"{self.root}/{name}/batch={number:08d}"

    def _numbers(self, name: str) -> list[int]:
        return [int(n[6:]) for n in listed(self.spark, f"{self.root}/{name}") if n.startswith("batch=") and exists(self.spark, f"{self.root}/{name}/{n}/_SUCCESS")]

    def _read(self, name: str, numbers: list[int]) -> DataFrame:
        return self.spark.read.option("basePath", f"{self.root}/{name}").parquet(*[self._path(name, n) for n in numbers])

    def _found(self, rows: DataFrame) -> DataFrame:
        """The rows' state: group, member, rows, broken rules, and the least and greatest declared size and metadata."""
        bad = ~F.coalesce(F.expr(self.good), F.lit(False))
        if self.rules:
            bad = bad | (F.size(row_issues(self.rules)) > 0)
        broken = F.when(bad, 1).otherwise(0)
        size = F.col(self.declared).cast("long") if self.declared else F.lit(None).cast("long")
        meta = F.xxhash64(*self.meta) if self.meta else F.lit(0).cast("long")
        return dealt(rows, self.group).groupBy(F.col(self.group).alias("g"), F.col(self.member).alias("m")).agg(
            F.count("*").alias("n"), F.sum(broken).alias("broken"), F.min(size).alias("least"), F.max(size).alias("most"), F.min(meta).alias("meta_a"), F.max(meta).alias("meta_b")
        )

    def _verdicts(self, state: DataFrame) -> DataFrame:
        """g, status, reason of every group in `state`."""
        members = self._merged(state)
        twice = F.max(F.when(F.col("m").isNotNull(), F.col("n")).otherwise(0)) > 1
        n, most = F.sum("n"), F.max("most")
        reason = F.when(F.sum("broken") > 0, "rows").when(twice, "duplicates").when(F.min("meta_a") != F.max("meta_b"), "metadata").when(F.min("least") != most, "ambiguous_size").when(n > most, "too_many").when(n < most, "incomplete").otherwise("ok")
        out = members.groupBy("g").agg(reason.alias("reason"))
        return out.select("g", F.when(F.col("reason") == "ok", "accepted").when(F.col("reason") == "incomplete", "pending").otherwise("quarantined").alias("status"), "reason")

    def accept(self, batch: DataFrame, number: int) -> None:
        """Judge a batch; a number that comes again is judged again from the same earlier batches."""
        seen = Observation()
        batch.observe(seen, F.count("*").alias("received")).write.mode("overwrite").parquet(self._path("rows", number))
        own = self._found(self.spark.read.schema(batch.schema).parquet(self._path("rows", number)))
        own.write.mode("overwrite").parquet(self._path("state", number))
        own = self.spark.read.schema(own.schema).parquet(self._path("state", number))
        state, rows, old = own, own.count(), self._before(number)
        if old is not None:
            rows += old.count()
            touched = own.select(F.col("g").alias("_g")).distinct()
            state = own.unionByName(old.join(touched, old["g"].eqNullSafe(touched["_g"]), "left_semi").select(*own.columns))
        self._verdicts(dealt(state, "g", rows=rows)).write.mode("overwrite").parquet(self._path("verdicts", number))
        now = self.spark.read.parquet(self._path("verdicts", number))
        held = self._latest([n for n in self._numbers("ledger") if n < number])
        turned = now.where("status = 'quarantined'").join(held.where("status <> 'quarantined'").select(F.col("g").alias("_g")), F.col("g").eqNullSafe(F.col("_g")), "left_semi") if held is not None else now.limit(0)
        entry = now.agg(F.lit(seen.get["received"]).cast("long").alias("received"), F.count("*").alias("groups"), F.count_if(F.col("status") == "accepted").alias("accepted"), F.count_if(F.col("status") == "pending").alias("pending"), F.count_if(F.col("status") == "quarantined").alias("quarantined"))
        entry.withColumn("retracted", F.lit(turned.count()).cast("long")).coalesce(1).write.mode("overwrite").parquet(self._path("ledger", number))
        if (number + 1) % self.compact == 0:  # states stay, as a replayed batch reads those below it
            self._merged(self._before(number + 1)).write.mode("overwrite").parquet(self._path("merged", number))

    def _merged(self, state: DataFrame) -> DataFrame:
        return state.groupBy("g", "m").agg(*[f(c).alias(c) for c, f in _MERGE.items()])

    def _before(self, number: int) -> DataFrame | None:
        """State of all batches below a number: the newest merged one and those after it."""
        base = max((n for n in self._numbers("merged") if n < number), default=-1)
        paths = [self._path("merged", base)] * (base >= 0) + [self._path("state", n) for n in self._numbers("state") if base < n < number]
        return self.spark.read.parquet(*paths) if paths else None

    # ---- what readers see

    def _latest(self, numbers: list[int]) -> DataFrame | None:
        """g, status, reason: the newest verdict on each group."""
        if not numbers:
            return None
        newest = self._read("verdicts", numbers).groupBy("g").agg(F.max_by(F.struct("status", "reason"), "batch").alias("v"))
        return newest.select("g", "v.status", "v.reason")

    def rows(self) -> DataFrame:
        """All rows of finished batches with batch, status and reason."""
        numbers = self._numbers("ledger")
        verdicts = self._latest(numbers).withColumn("_g", F.struct("g")).drop("g")
        return join_counted(self._read("rows", numbers).withColumn("_g", F.struct(F.col(self.group).alias("g"))), verdicts, ["_g"]).drop("_g")

    def ledger(self) -> DataFrame:
        """batch, received, groups, accepted, pending, quarantined, retracted."""
        return self._read("ledger", self._numbers("ledger"))
