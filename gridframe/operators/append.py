"""Idempotent appends, ledgers, hashes, plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridframe.sources.shared import write_counted


def new_only(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """Rows of groups that are not there yet."""
    return new.join(old.select(key).distinct(), key, "left_anti")


def already_applied(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """One row: groups of new, those that are missing in old, and whether all are there."""
    keys = new.select(key).distinct()
    missing = keys.join(old.select(key).distinct(), key, "left_anti")
    return keys.agg(F.count("*").alias("groups")).join(missing.agg(F.count("*").alias("missing"))).withColumn("applied", F.col("missing") == 0)


def row_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of a row's columns as text, null apart from empty."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns]), 256)


def logical_hash(df: DataFrame, columns: Sequence[str], prefix: int | None = None, bucket_rows: int = 1 << 20) -> DataFrame:
    """One row: rows and a content hash that ignores their order: row hashes, hashed in order by bucket, then the buckets.

    A bucket is a prefix of hex digits of the row hashes. Without `prefix` it is two digits, or as many as keep a bucket
    at about `bucket_rows` rows; more than two are folded two by two, so that no step gathers more than 256 hashes.
    """
    rows = df.select(row_hash(columns).alias("h"))
    if prefix is None:
        n, prefix = df.count(), 2
        while n > bucket_rows * 16**prefix:
            prefix += 2
    ordered = lambda c: F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("b", "h"))), lambda x: x["h"]), ""), 256).alias("h")
    level = rows.groupBy(F.substring("h", 1, prefix).alias("b")).agg(F.sha2(F.array_join(F.sort_array(F.collect_list("h")), ""), 256).alias("h"), F.count("*").alias("n"))
    for digits in range(prefix - 2, 0, -2):
        level = level.withColumn("up", F.substring("b", 1, digits)).groupBy("up").agg(ordered("b"), F.sum("n").alias("n")).withColumnRenamed("up", "b")
    return level.agg(F.sum("n").alias("n_rows"), ordered("b").alias("content_hash"))


def drift(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """Keys whose recorded and actual hashes differ or that one side lacks."""
    j = a.select(key, F.col(value).alias("recorded")).join(b.select(key, F.col(value).alias("actual")), key, "full_outer")
    status = F.when(F.col("recorded").isNull(), "added").when(F.col("actual").isNull(), "removed").when(F.col("recorded") != F.col("actual"), "changed")
    return j.withColumn("status", status).where("status is not null").select(key, "status")


def file_hashes(spark: SparkSession, glob: str) -> DataFrame:
    """path, bytes and SHA-256 of every file; a file is read whole by one task (2 GB at most)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(glob)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def append_batch(new: DataFrame, path: str, batch_id: str, key: str) -> int:
    """Write a batch as the partition batch_id=... of a table, without groups that other batches hold; running it again gives the same table."""
    spark = new.sparkSession
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    rows = new.withColumn("batch_id", F.lit(batch_id))
    if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(path)):
        old = spark.read.parquet(path).where(F.col("batch_id") != batch_id).select(key).distinct()
        rows = rows.join(old, key, "left_anti")
    return write_counted(rows, path, partition_by=["batch_id"], partitionOverwriteMode="dynamic")


def dry_run(new: DataFrame, old: DataFrame, group: str, expected: int | None = None) -> DataFrame:
    """One ledger row: rows and groups before, added and after, without writing anything.

    With `expected` it also records the number of groups that were announced and whether it fits; it is not enforced.
    """
    fresh = new_only(new, old, group).agg(F.count("*").alias("added_rows"), F.countDistinct(group).alias("added_groups"))
    before = old.agg(F.count("*").alias("before_rows"), F.countDistinct(group).alias("before_groups"))
    j = before.join(fresh)
    j = j.withColumns({"after_rows": F.col("before_rows") + F.col("added_rows"), "after_groups": F.col("before_groups") + F.col("added_groups")})
    if expected is None:
        return j
    given = new.agg(F.countDistinct(group).alias("actual_groups"))
    return j.join(given).withColumns({"expected_groups": F.lit(expected).cast("long"), "as_expected": F.col("actual_groups") == expected})


#: The steps of an append, in order.
STEPS = ["backup", "append", "load", "export", "audit", "manifest", "log"]


class AppendRun:
    """An append in seven recorded steps. A run that broke off is resumed: steps in the ledger are not done again.

    Every step writes to a place named by the batch, so one that broke off half-way is simply written anew, and a batch is
    never in the table twice. `root` is a folder that driver and executors share.
    """

    def __init__(self, spark: SparkSession, root: str, batch_id: str, group: str) -> None:
        self.spark, self.root, self.batch_id, self.group = spark, root, batch_id, group
        self.table = f"{root}/table"

    def _exists(self, path: str) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)

    def done(self) -> list[str]:
        """The steps that the ledger has of this batch."""
        return [s for s in STEPS if self._exists(f"{self.root}/ledger/batch_id={self.batch_id}/step={s}/_SUCCESS")]

    def _own(self) -> DataFrame:
        return self.spark.read.parquet(self.table).where(F.col("batch_id") == self.batch_id)

    def _write(self, df: DataFrame, name: str) -> int:
        return write_counted(df, f"{self.root}/{name}/batch_id={self.batch_id}")

    def run(self, new: DataFrame, stop_after: str | None = None) -> list[str]:
        """Do the steps that are left (up to `stop_after`) and return their names."""
        left = [s for s in STEPS if s not in self.done()]
        for step in left:
            rows = getattr(self, f"_{step}")(new)
            entry = self.spark.range(1).select(F.lit(rows).cast("long").alias("n_rows"), F.lit("done").alias("status"))
            entry.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/ledger/batch_id={self.batch_id}/step={step}")
            if step == stop_after:
                return left[: left.index(step) + 1]
        return left

    def _backup(self, new: DataFrame) -> int:
        """The batches that were there before and their sizes; partitions are never rewritten by another batch."""
        if not self._exists(self.table):
            return 0
        before = self.spark.read.parquet(self.table).where(F.col("batch_id") != self.batch_id)
        return self._write(before.groupBy(F.col("batch_id").alias("batch")).agg(F.count("*").alias("n_rows")), "backup")

    def _append(self, new: DataFrame) -> int:
        return append_batch(new, self.table, self.batch_id, self.group)

    def _load(self, new: DataFrame) -> int:
        """All rows of the batch are in the table, none of their groups in another batch."""
        own = self._own()
        twice = own.select(self.group).distinct().join(self.spark.read.parquet(self.table).where(F.col("batch_id") != self.batch_id), self.group, "left_semi")
        if twice.limit(1).count():
            raise ValueError(f"batch {self.batch_id} shares groups with another batch")
        return own.count()

    def _export(self, new: DataFrame) -> int:
        return self._write(self._own().drop("batch_id"), "export")

    def _audit(self, new: DataFrame) -> int:
        kinds = self._own().drop("batch_id")
        return self._write(kinds.agg(F.count("*").alias("n_rows"), F.countDistinct(self.group).alias("n_groups"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in kinds.columns]), "audit")

    def _manifest(self, new: DataFrame) -> int:
        columns = [c for c in self._own().columns if c != "batch_id"]
        one = logical_hash(self._own(), columns).withColumn("columns", F.lit(",".join(columns)))
        return self._write(one.select(F.to_json(F.struct("*")).alias("value")), "manifest")

    def _log(self, new: DataFrame) -> int:
        return self._write(new.agg(F.count("*").alias("received")).withColumn("appended", F.lit(self._own().count())), "log")

    def ledger(self) -> DataFrame:
        """batch_id, step, n_rows, status of all batches."""
        return self.spark.read.parquet(f"{self.root}/ledger").select("batch_id", "step", "n_rows", "status")


def json_manifest(df: DataFrame, path: str) -> DataFrame:
    """Write a one-row table as one JSON text (pretty, in one file) and read it back; the committer publishes it whole."""
    df.select(F.to_json(F.struct("*"), {"pretty": "true"}).alias("value")).coalesce(1).write.mode("overwrite").text(path)
    return df.sparkSession.read.schema(df.schema).json(path, multiLine=True)


def apply_guard(steps: DataFrame, batch: str, hash_column: str) -> DataFrame:
    """batch, allowed: an apply needs a passed dry run of the same hash."""
    dry = steps.where("mode = 'dry_run' and status = 'passed'").select(batch, hash_column).distinct().withColumn("ok", F.lit(True))
    return steps.where("mode = 'apply'").select(batch, hash_column).distinct().join(dry, [batch, hash_column], "left").select(batch, F.coalesce("ok", F.lit(False)).alias("allowed"))


def apply_preconditions(plans: DataFrame, ledger: DataFrame, batch: str, expected: str, actual: str, job: str) -> DataFrame:
    """batch, reason: why an apply is refused, or ok: the content hash, a passed dry run of that hash, and the same jobs in it.

    `plans` has a row per batch and job with both hashes, `ledger` the jobs of passed dry runs with the hash they ran on.
    """
    jobs = F.array_join(F.array_sort(F.collect_set(F.col(job).cast("string"))), ",")
    want = plans.groupBy(batch).agg(F.max(expected).alias("_expected"), F.max(actual).alias("_actual"), jobs.alias("_jobs"))
    dry = ledger.groupBy(batch, F.col(actual).alias("_h")).agg(jobs.alias("_dry"))
    j = want.join(dry, (want[batch] == dry[batch]) & (F.col("_actual") == F.col("_h")), "left").select(want[batch], "_expected", "_actual", "_jobs", "_dry")
    reason = F.when(~F.col("_expected").eqNullSafe(F.col("_actual")), "hash").when(F.col("_dry").isNull(), "no dry run").when(F.col("_dry") != F.col("_jobs"), "other jobs").otherwise("ok")
    return j.select(batch, reason.alias("reason"))


def run_states(jobs: DataFrame, run: str, ordinal: str, failed: Column, rows: str) -> DataFrame:
    """jobs with `state`: done, failed (or empty) for the first that stops the run, not_run for those behind it."""
    w = Window.partitionBy(run).orderBy(ordinal).rowsBetween(Window.unboundedPreceding, -1)
    stops = failed | (F.col(rows) == 0)
    before = F.coalesce(F.max(stops.cast("int")).over(w), F.lit(0))
    return jobs.withColumn("state", F.when(before == 1, "not_run").when(failed, "failed").when(F.col(rows) == 0, "empty").otherwise("done"))


def ledger_summary(ledger: DataFrame, by: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Batches and sums per mode and status."""
    return ledger.groupBy(*by).agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in sums])


def calendar(spark: SparkSession, first: str, last: str, numbers: int) -> DataFrame:
    """date, number: every number of every day."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("date"))
    return days.withColumn("number", F.explode(F.sequence(F.lit(1), F.lit(numbers))))


def gap_plan(plan: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Planned keys that don't exist yet."""
    return plan.join(existing.select(*keys).distinct(), keys, "left_anti")


def date_windows(spark: SparkSession, anchor: str, days: int, n: int, per_wave: int) -> DataFrame:
    """window_no, wave_no, date_from, date_to: contiguous windows backward from an anchor, newest first."""
    rows = spark.range(n).select((F.col("id") + 1).cast("int").alias("window_no"))
    end = F.date_sub(F.lit(anchor).cast("date"), (F.col("window_no") - 1) * days)
    return rows.select("window_no", F.ceil(F.col("window_no") / per_wave).cast("int").alias("wave_no"), F.date_sub(end, days - 1).alias("date_from"), end.alias("date_to"))


def seed_of(*parts: str | Column) -> Column:
    """Unsigned 32-bit seed: the first eight hex digits of the SHA-256 of the joined parts."""
    return F.conv(F.substring(F.sha2(F.concat(*parts), 256), 1, 8), 16, 10).cast("long")
