"""Walk-forward splits and the final lock: rules over fold members, and a guard that reads the query's plan."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridframe.sources.shared import get_json, listed, put_json

ROLES = ["train", "selection", "calibration", "evaluation"]


def split_issues(members: DataFrame, fold: str, role: str, date: str, lock: tuple[str, str], roles: Sequence[str] = ROLES) -> DataFrame:
    """check_name, issues: roles in order, one role a date of a fold, evaluations apart, no role empty, nothing in the lock.

    Members are counted by (fold, role, date) first, so what is compared grows with the days.
    """
    days = members.groupBy(F.col(fold).alias("fold"), F.col(role).alias("role"), F.col(date).cast("date").alias("day")).agg(F.count("*").alias("n"))
    bounds = days.groupBy("fold").agg(*[f(F.when(F.col("role") == r, F.col("day"))).alias(f"{r}_{name}") for r in roles for name, f in (("from", F.min), ("to", F.max))])
    in_order = F.lit(True)
    for a, b in zip(roles, roles[1:], strict=False):
        in_order = in_order & (F.col(f"{a}_to") < F.col(f"{b}_from"))
    empty = F.lit(False)
    for r in roles:
        empty = empty | F.col(f"{r}_from").isNull()
    per_day = days.groupBy("fold", "day").agg(F.count("*").alias("k"))
    shared = days.where(F.col("role") == roles[-1]).groupBy("day").agg(F.count("*").alias("k"))
    locked = F.col("day").between(*[F.lit(x).cast("date") for x in lock])
    one = lambda name, df, n=F.count("*"): df.agg(F.coalesce(n, F.lit(0)).cast("long").alias("issues")).select(F.lit(name).alias("check_name"), "issues")  # noqa: B008, E731
    out = one("role_empty", bounds.where(empty))
    for part in (one("roles_out_of_order", bounds.where(~in_order)), one("date_in_several_roles", per_day.where("k > 1")), one("date_in_several_evaluations", shared.where("k > 1")), one("locked_members", days.where(locked), F.sum("n"))):
        out = out.unionByName(part)
    return out


class LockViolation(PermissionError):
    """A query reads rows that are locked, or an unlock was refused."""


_SCAN = re.compile(r"^\(\d+\) Scan .*?(?=^\(\d+\) |\Z)", re.S | re.M)
_LIMIT = r"(LessThan|LessThanOrEqual|GreaterThan|GreaterThanOrEqual|EqualTo)\({column},(\d{{4}}-\d{{2}}-\d{{2}})(?:[ T]([0-9:.]+))?Z?\)"


class FinalLock:
    """Rows of a table with dates from `start` to `stop` are sealed until they are unlocked with the right hash.

    check() takes a query's physical plan and asks of every scan of the table's files that filters pushed down to it leave out the
    locked dates; a scan without them is refused, wherever it stands in the query. `root` holds the log of unlocks, to which
    entries are only added.
    """

    def __init__(self, spark: SparkSession, root: str, table: str, column: str, start: str, stop: str, sha: str) -> None:
        self.spark, self.root, self.table, self.column, self.start, self.stop, self.sha = spark, root, table, column, start, stop, sha

    def _outside(self, rows: DataFrame) -> Column:
        kind = rows.schema[self.column].dataType
        after = (dt.date.fromisoformat(self.stop) + dt.timedelta(days=1)).isoformat()
        return (F.col(self.column) < F.lit(self.start).cast(kind)) | (F.col(self.column) >= F.lit(after).cast(kind))

    def development(self) -> DataFrame:
        """Rows before the lock."""
        rows = self.spark.read.parquet(self.table)
        return rows.where(F.col(self.column) < F.lit(self.start).cast(rows.schema[self.column].dataType))

    def _allows(self, scan: str) -> bool:
        pushed = re.search(r"^PushedFilters: \[(.*)\]$", scan, re.M)
        for kind, day, time in re.findall(_LIMIT.format(column=re.escape(self.column)), pushed[1] if pushed else ""):
            midnight = not time or not time.strip("0:.")
            if kind in ("LessThan",) and (day < self.start or day == self.start and midnight):
                return True
            if kind in ("LessThanOrEqual", "EqualTo") and day < self.start:
                return True
            if kind in ("GreaterThan", "GreaterThanOrEqual", "EqualTo") and day > self.stop:
                return True
        return False

    def check(self, query: DataFrame) -> DataFrame:
        """The query itself, if no scan of the table can see a locked row."""
        old = self.spark.conf.get("spark.sql.maxMetadataStringLength")
        self.spark.conf.set("spark.sql.maxMetadataStringLength", "1000000")
        try:
            again = query.select("*")  # planned anew, with whole paths and filters
            plan = self.spark._jvm.PythonSQLUtils.explainString(again._jdf.queryExecution(), "formatted")
        finally:
            self.spark.conf.set("spark.sql.maxMetadataStringLength", old)
        name = re.sub(r"^\w+://?[^/]*", "", self.table).rstrip("/")
        for scan in _SCAN.findall(plan):
            paths = re.search(r"^Location: \w+ \[(.*)\]$", scan, re.M)
            if paths and re.search(re.escape(name) + r"(?:/|,|$|\])", paths[1]) and not self._allows(scan):
                raise LockViolation(f"a scan of {self.table} isn't limited to dates before {self.start}")
        return query

    def unlocked(self) -> bool:
        return any(get_json(self.spark, f"{self.root}/unlocks/{n}")["accepted"] for n in listed(self.spark, f"{self.root}/unlocks"))

    def unlock(self, sha: str, why: str) -> None:
        """Open the lock with the hash it was sealed with; every attempt is logged."""
        n = len(listed(self.spark, f"{self.root}/unlocks")) + 1
        put_json(self.spark, f"{self.root}/unlocks/n={n:06d}.json", {"sha": sha, "why": why, "accepted": sha == self.sha})
        if sha != self.sha:
            raise LockViolation("wrong hash")

    def sealed(self, keys: DataFrame, key: str) -> DataFrame:
        """The locked rows of some keys; refused while locked, and if a key isn't among the locked rows."""
        if not self.unlocked():
            raise LockViolation("locked")
        rows = self.spark.read.parquet(self.table)
        inside = rows.where(~self._outside(rows))
        if keys.select(key).distinct().join(inside, key, "left_anti").limit(1).count():
            raise LockViolation("a key is not in the locked range")
        return inside.join(keys.select(key).distinct(), key, "left_semi")
