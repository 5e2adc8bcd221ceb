"""A table of batches under versions: an append is a new version, a restore goes back to an older one.

A batch's rows are written once, under its name. A version is a list of batches with their rows, groups and content hash, so
counts and the hash of a version come from the list and never from reading the table again. Which version is current says the
last entry of the pointer's log; entries are small files that appear whole under a new name. An old version stays readable until prune().

An append goes through the steps of STEPS after the acceptance checks. If a step fails, the pointer goes back to the version before
the run and the ledger names the step; resume() goes on from there. `root` is a folder that driver and executors share.
One writer at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridframe.operators.append import logical_hash
from gridframe.operators.checks import accept_batch
from gridframe.sources.shared import exists, get_json, listed, put_json, remove

STEPS = ["backup", "append", "load", "export", "audit", "manifest", "log"]
#: The ledger's columns.
LEDGER = (
    "batch_id string, created_at string, mode string, source string, source_hash string, before_hash string, after_hash string, before_rows long, after_rows long, before_groups long, after_groups long, "
    "added_rows long, added_groups long, scope string, date_min string, date_max string, groups_expected long, groups_actual long, validation string, report string"
)


class StepFailed(RuntimeError):
    """A step of an append that failed; `step` names it."""

    def __init__(self, step: str, why: str) -> None:
        super().__init__(f"{step}: {why}")
        self.step = step


class VersionedTable:
    """Appends, dry runs, restores and their ledger.

    `group`, `member`, `ordinal`, `declared`, `scope` and `meta` are columns for accept_batch, `date` the one whose range is
    recorded. `export` turns the rows of a batch into those that are exported.
    """

    def __init__(self, spark: SparkSession, root: str, group: str, member: str, ordinal: str, declared: str, scope: str, date: str, meta: Sequence[str] = (), rules: Sequence = (), export: Callable[[DataFrame], DataFrame] | None = None) -> None:
        self.spark, self.root, self.group, self.member, self.ordinal, self.declared, self.scope, self.date = spark, root, group, member, ordinal, declared, scope, date
        self.meta, self.rules, self.export = list(meta) or [group], list(rules), export or (lambda df: df)

    # ---- versions

    def _last(self, name: str) -> int:
        return max((int(n[2:-5]) for n in listed(self.spark, f"{self.root}/{name}") if n.startswith("n=") and n.endswith(".json")), default=0)

    def _get(self, name: str) -> Any:
        return get_json(self.spark, f"{self.root}/{name}.json")

    def _put(self, name: str, value: Any) -> None:
        put_json(self.spark, f"{self.root}/{name}.json", value)

    def _has(self, name: str) -> bool:
        return exists(self.spark, f"{self.root}/{name}.json")

    def version(self) -> int:
        """The current version; 0 before the first append."""
        last = self._last("pointer")
        return self._get(f"pointer/n={last:06d}")["version"] if last else 0

    def point(self, version: int, why: str) -> None:
        self._put(f"pointer/n={self._last('pointer') + 1:06d}", {"version": version, "why": why})

    def parts(self, version: int | None = None) -> list[dict]:
        """The batches of a version: batch_id, n_rows, n_groups, content_hash."""
        version = self.version() if version is None else version
        return self._get(f"versions/n={version:06d}") if version else []

    def rows(self, version: int | None = None) -> DataFrame | None:
        """The rows of a version with batch_id; None before the first append."""
        paths = [f"{self.root}/rows/batch_id={p['batch_id']}" for p in self.parts(version)]
        return self.spark.read.option("basePath", f"{self.root}/rows").parquet(*paths) if paths else None

    def restore(self, version: int) -> None:
        """Make an older version current again."""
        if version and not self._has(f"versions/n={version:06d}"):
            raise ValueError(f"no version {version}")
        self.point(version, "restore")

    def prune(self) -> list[str]:
        """Delete versions that the pointer never named, and rows of batches that no other version lists."""
        named = {self._get(f"pointer/n={n:06d}")["version"] for n in range(1, self._last("pointer") + 1)}
        kept = {p["batch_id"] for v in named for p in self.parts(v)} if named else set()
        gone = [f"versions/{n}" for n in listed(self.spark, f"{self.root}/versions") if n.endswith(".json") and int(n[2:-5]) not in named]
        gone += [f"rows/{n}" for n in listed(self.spark, f"{self.root}/rows") if n.startswith("batch_id=") and n[9:] not in kept]
        for name in gone:
            remove(self.spark, f"{self.root}/{name}")
        return gone

    @staticmethod
    def _summary(parts: list[dict]) -> tuple[int, int, str]:
        """Rows, groups and hash of a version; batches share no groups."""
        text = "|".join(f"{p['batch_id']}:{p['content_hash']}" for p in sorted(parts, key=lambda p: p["batch_id"]))
        return sum(p["n_rows"] for p in parts), sum(p["n_groups"] for p in parts), hashlib.sha256(text.encode()).hexdigest()

    # ---- acceptance, ledger

    def _issues(self, new: DataFrame, old: DataFrame | None) -> dict[str, int]:
        before = new.limit(0) if old is None else old.select(*[c for c in old.columns if c != "batch_id"])
        found = accept_batch(new, before, self.group, self.member, self.ordinal, self.declared, self.scope, self.meta, self.rules, contract=new.columns if old is None else before.columns)
        return {r.rule: int(r.issues) for r in found.collect()}

    def _facts(self, new: DataFrame) -> dict[str, Any]:
        """One pass over a batch for what the ledger says of it."""
        one = new.agg(F.count("*").alias("added_rows"), F.countDistinct(self.group).alias("added_groups"), F.array_join(F.array_sort(F.collect_set(F.col(self.scope).cast("string"))), "|").alias("scope"), F.min(self.date).cast("string").alias("date_min"), F.max(self.date).cast("string").alias("date_max")).first()
        return one.asDict()

    def _log(self, entry: dict[str, Any]) -> None:
        n = self._last("ledger") + 1
        self._put(f"ledger/n={n:06d}", {"n": n} | {c.split()[0]: entry.get(c.split()[0]) for c in LEDGER.split(", ")})

    def ledger(self) -> DataFrame:
        """All runs in order, `n` from 1."""
        return self.spark.read.schema(f"n int, {LEDGER}").json(f"{self.root}/ledger/*.json")

    def _entry(self, new: DataFrame, batch_id: str, mode: str, created_at: str, source: str, expected: int | None) -> tuple[dict[str, Any], dict[str, int]]:
        parts = self.parts()
        rows, groups, own = self._summary(parts)
        issues = self._issues(new, self.rows())
        if any(p["batch_id"] == batch_id for p in parts):
            issues["batch_id"] = 1
        entry = {"batch_id": batch_id, "created_at": created_at, "mode": mode, "source": source, "source_hash": logical_hash(new, new.columns).first().content_hash, "before_hash": own, "after_hash": own, "before_rows": rows, "after_rows": rows, "before_groups": groups, "after_groups": groups, "added_rows": 0, "added_groups": 0, "groups_expected": expected}
        facts = self._facts(new)
        entry |= {k: facts[k] for k in ("scope", "date_min", "date_max")} | {"groups_actual": facts["added_groups"], "_facts": facts}
        bad = {k: n for k, n in issues.items() if n}
        entry |= {"validation": "failed" if bad else "passed", "report": ", ".join(f"{k}: {n}" for k, n in sorted(bad.items()))}
        return entry, bad

    def dry_run(self, new: DataFrame, batch_id: str, created_at: str = "", source: str = "", expected: int | None = None) -> bool:
        """Check a batch and write a ledger row with what an append would add; the table stays as it is."""
        entry, bad = self._entry(new, batch_id, "dry_run", created_at, source, expected)
        if not bad:
            entry |= {k: entry["_facts"][k] for k in ("added_rows", "added_groups")}
        self._log(entry)
        return not bad

    # ---- append

    def done(self, batch_id: str) -> list[str]:
        """The steps of an append that are behind it."""
        return [s for s in STEPS if self._has(f"state/{batch_id}/{s}")]

    def apply(self, new: DataFrame, batch_id: str, created_at: str = "", source: str = "", expected: int | None = None, fail_after: str | None = None) -> bool:
        """Append a batch, or write a ledger row and leave the table as it is if a check fails. `fail_after` breaks off behind a step."""
        return self._checked(new, batch_id, *self._entry(new, batch_id, "applied", created_at, source, expected), fail_after)

    def _checked(self, new: DataFrame, batch_id: str, entry: dict[str, Any], bad: dict[str, int], fail_after: str | None) -> bool:
        if bad:
            self._log(entry)
            return False
        return self._run(new, batch_id, entry, fail_after)

    def resume(self, new: DataFrame, batch_id: str, created_at: str = "", source: str = "", expected: int | None = None, fail_after: str | None = None) -> bool:
        """Go on with an append that broke off. Its rows must be the ones that were begun."""
        if "log" in self.done(batch_id):
            return True
        if not self._has(f"state/{batch_id}/begun"):
            raise ValueError(f"batch {batch_id} was not begun")
        entry, bad = self._entry(new, batch_id, "applied", created_at, source, expected)
        if self._get(f"state/{batch_id}/begun")["source_hash"] != entry["source_hash"]:
            raise ValueError(f"batch {batch_id} was begun with other rows")
        return self._checked(new, batch_id, entry, bad, fail_after)

    def _run(self, new: DataFrame, batch_id: str, entry: dict[str, Any], fail_after: str | None) -> bool:
        before = self.version()
        self._put(f"state/{batch_id}/begun", {"source_hash": entry["source_hash"]})
        step = STEPS[0]
        try:
            for step in STEPS:
                # The pointer went back when the run broke off, so backup and load are always done again.
                if step in self.done(batch_id) and step not in ("backup", "load"):
                    if step == "append":
                        entry |= self._appended(batch_id)
                    continue
                getattr(self, f"_step_{step}")(new, batch_id, entry, before)
                self._put(f"state/{batch_id}/{step}", {"version_before": before})
                if step == fail_after:
                    raise StepFailed(step, "asked to fail behind it")
        except Exception as why:
            if self.version() != before:
                self.point(before, f"{batch_id} failed")
            self._log(entry | {"after_hash": entry["before_hash"], "after_rows": entry["before_rows"], "after_groups": entry["before_groups"], "mode": "partial", "report": f"failed: {step}"})
            raise why if isinstance(why, StepFailed) else StepFailed(step, str(why)) from why
        return True

    def _appended(self, batch_id: str) -> dict[str, Any]:
        one = self._get(f"parts/{batch_id}")
        return {"added_rows": one["n_rows"], "added_groups": one["n_groups"], "_hash": one["content_hash"]}

    def _step_backup(self, new: DataFrame, batch_id: str, entry: dict[str, Any], before: int) -> None:
        """Old rows are never rewritten, so the version before the run, kept with the step, is the backup."""

    def _step_append(self, new: DataFrame, batch_id: str, entry: dict[str, Any], before: int) -> None:
        seen, path = Observation(), f"{self.root}/rows/batch_id={batch_id}"
        new.observe(seen, F.count("*").alias("n")).write.mode("overwrite").parquet(path)
        # The batch's facts and hash were taken when it was checked; what was written must be as many rows.
        if seen.get["n"] != entry["_facts"]["added_rows"]:
            raise ValueError("the batch changed between its check and its append")
        entry |= {"added_rows": seen.get["n"], "added_groups": entry["_facts"]["added_groups"], "_hash": entry["source_hash"]}
        self._put(f"parts/{batch_id}", {"batch_id": batch_id, "n_rows": entry["added_rows"], "n_groups": entry["added_groups"], "content_hash": entry["_hash"]})

    def _step_load(self, new: DataFrame, batch_id: str, entry: dict[str, Any], before: int) -> None:
        """The new version, then the pointer."""
        number = self._last("versions") + 1
        self._put(f"versions/n={number:06d}", [*self.parts(before), self._get(f"parts/{batch_id}")])
        self.point(number, batch_id)
        entry["after_rows"], entry["after_groups"], entry["after_hash"] = self._summary(self.parts(number))

    def _own(self, batch_id: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/rows/batch_id={batch_id}")

    def _step_export(self, new: DataFrame, batch_id: str, entry: dict[str, Any], before: int) -> None:
        self.export(self._own(batch_id)).write.mode("overwrite").parquet(f"{self.root}/export/batch_id={batch_id}")

    def _step_audit(self, new: DataFrame, batch_id: str, entry: dict[str, Any], before: int) -> None:
        own = self._own(batch_id)
        own.agg(F.count("*").alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in own.columns]).write.mode("overwrite").parquet(f"{self.root}/audit/batch_id={batch_id}")

    def _step_manifest(self, new: DataFrame, batch_id: str, entry: dict[str, Any], before: int) -> None:
        self._put(f"manifest/{batch_id}", dict(zip(("version", "n_rows", "n_groups", "content_hash"), (self.version(), *self._summary(self.parts())), strict=True)))

    def _step_log(self, new: DataFrame, batch_id: str, entry: dict[str, Any], before: int) -> None:
        self._log(entry)
