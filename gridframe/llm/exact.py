"""Exact deduplication with static binary-fuse filters over immutable snapshots.

Texts are equal when identical after every run of ASCII white space became one space; null counts as empty. A snapshot's
distinct digests are dealt into buckets of bounded size and each bucket gets a static binary-fuse filter (8-bit
fingerprints). An incoming batch is grouped by digest within itself, its digests are screened by the filters, and only
positives meet the snapshot's exact buckets. The texts of every group with more than one row are then compared byte by
byte; where one digest stands for several texts, its rows are grouped by the text itself. Of equal texts the row with the
smallest doc_id stays, rows without an id come last, and of rows with one id and one text any single one stays.

Repeated rows are copies like any other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridframe.llm.common import BROADCAST_BYTES, join_groups, join_small, size_of, stored

BUCKET_KEYS = 65_536


def normalised(text: str | Column) -> Column:
    """White-space runs as one space; null as empty."""
    return F.regexp_replace(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    x = keys ^ np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


class FuseFilter:
    """Static three-wise binary-fuse filter: every key it was built from is found, others with probability 1/256."""

    def __init__(self, seed: int, segment: int, cells: np.ndarray) -> None:
        self.seed, self.segment, self.cells = seed, segment, cells

    @staticmethod
    def _places(hashes: np.ndarray, segment: int, segments: int) -> np.ndarray:
        first = (hashes >> np.uint64(40)) % np.uint64(segments)
        parts = [(hashes >> np.uint64(s)) % np.uint64(segment) for s in (0, 13, 26)]
        return np.stack([(first + np.uint64(k)) * np.uint64(segment) + p for k, p in enumerate(parts)]).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> FuseFilter:
        """Peel slots that one key alone uses, all such keys of a round at once, then fill them in reverse."""
        keys = np.unique(keys.astype(np.uint64))
        segment = 1 << max(2, int(np.log2(max(len(keys), 4)) / 1.75))
        segments = max(1, int(np.ceil(len(keys) * 1.23 / segment)) + 1)
        for seed in range(1, 200):
            hashes = _mix(keys, seed)
            places = cls._places(hashes, segment, segments)
            size = (segments + 2) * segment
            count = np.bincount(places.ravel(), minlength=size)
            who = np.zeros(size, np.int64)
            for row in places:
                np.add.at(who, row, np.arange(len(keys)))
            rounds, left = [], len(keys)
            while left:
                single = np.flatnonzero(count == 1)
                if not len(single):
                    break
                key, index = np.unique(who[single], return_index=True)
                rounds.append((key, single[index]))
                for row in places[:, key]:
                    np.subtract.at(count, row, 1)
                    np.subtract.at(who, row, key)
                left -= len(key)
            if not left:
                cells = np.zeros(size, np.uint8)
                prints = (hashes & np.uint64(0xFF)).astype(np.uint8)
                for key, slot in reversed(rounds):
                    value = prints[key].copy()
                    for row in places[:, key]:
                        value ^= np.where(row == slot, np.uint8(0), cells[row])
                    cells[slot] = value
                return cls(seed, segment, cells)
        raise ValueError("no binary-fuse filter found")

    def has(self, keys: np.ndarray) -> np.ndarray:
        hashes = _mix(keys.astype(np.uint64), self.seed)
        a, b, c = (self.cells[p] for p in self._places(hashes, self.segment, len(self.cells) // self.segment - 2))
        return (a ^ b ^ c) == (hashes & np.uint64(0xFF)).astype(np.uint8)


def digest(text: str | Column = "text") -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


def digests(docs: DataFrame, digest_bytes: int) -> DataFrame:
    """doc_id, a number of the row, sha, key (its first bytes, all in earnest) and a 64-bit fp for the filters."""
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), digest().alias("sha"))
    return rows.withColumn("key", F.substring("sha", 1, digest_bytes)).withColumn("fp", F.xxhash64("key"))


def _first() -> Column:
    """A row's place among rows of the same text: by id, then by row."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")


def grouped(rows: DataFrame) -> DataFrame:
    """Digests of a batch with the first row and the number of rows."""
    return rows.groupBy("key", "fp").agg(F.min(_first()).alias("first"), F.count("*").alias("n"))


def snapshot_filters(groups: DataFrame, buckets: int) -> DataFrame:
    """One binary-fuse filter a bucket of an immutable snapshot: bucket, seed, segment, cells."""

    def build(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        f = FuseFilter.build(part["fp"].to_numpy().view(np.uint64))
        return pd.DataFrame([(key[0], f.seed, f.segment, f.cells.tobytes())], columns=["bucket", "seed", "segment", "cells"])

    dealt = groups.select("fp", F.pmod("fp", F.lit(buckets)).alias("bucket"))
    return dealt.groupBy("bucket").applyInPandas(build, "bucket long, seed int, segment int, cells binary")


def screened(incoming: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """Incoming groups with `maybe`: false where the snapshot can't hold the digest."""

    def test(part: pa.Table, own: pa.Table) -> pa.Table:
        keys = part.column("fp").to_numpy().view(np.uint64)
        maybe = np.zeros(len(keys), bool)
        if own.num_rows and len(keys):
            f = own.to_pylist()[0]
            maybe = FuseFilter(f["seed"], f["segment"], np.frombuffer(f["cells"], np.uint8)).has(keys)
        return part.select(["key", "fp", "none", "doc_id", "row", "n"]).append_column("maybe", pa.array(maybe))

    dealt = incoming.select("key", "fp", "first.*", "n", F.pmod("fp", F.lit(buckets)).alias("bucket"))
    tested = dealt.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(test, "key binary, fp bigint, none boolean, doc_id bigint, row bigint, n bigint, maybe boolean")
    return tested.select("key", "fp", F.struct("none", "doc_id", "row").alias("first"), "n", "maybe")


def add_batch(snapshot: DataFrame, filters: DataFrame, buckets: int, incoming: DataFrame) -> DataFrame:
    """Groups of snapshot and batch together; only positives of the filters meet the exact buckets."""
    tested = screened(incoming, filters, buckets)
    merged = snapshot.select("key", "fp", "first", "n").unionByName(tested.where("maybe").drop("maybe"))
    exact = merged.groupBy("key", "fp").agg(F.min("first").alias("first"), F.sum("n").alias("n"))
    return exact.unionByName(tested.where("not maybe").drop("maybe"))


def exact_groups(docs: DataFrame, bucket_keys: int = BUCKET_KEYS, digest_bytes: int = 32) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    The earlier half of the ids is the snapshot, the later half the incoming batch; any split gives the same rows.
    """
    rows = stored(digests(docs, digest_bytes), "digests")
    middle = rows.agg(F.percentile_approx("doc_id", 0.5, 1000), F.count("*")).first()
    total = middle[1]
    early = F.col("doc_id") <= F.lit(middle[0] or 0)
    snapshot = stored(grouped(rows.where(early)), "snapshot")
    buckets = max(16, -(-snapshot.count() // bucket_keys))
    filters = stored(snapshot_filters(snapshot, buckets), "filters")
    groups = stored(add_batch(snapshot, filters, buckets, grouped(rows.where(~early | F.col("doc_id").isNull()))), "groups")
    several = groups.where("n > 1").select("key", "first", "n")
    mixed = stored(_mixed(docs, rows, several, digest_bytes), "mixed")
    split = mixed.limit(1).count()
    members = join_groups(rows.drop("fp"), several, "key", "n", total)
    if split:  # the digests that stand for several texts are grouped apart
        members = members.join(mixed, "key", "left_anti")
    first = F.coalesce("first.doc_id", "doc_id").alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), F.coalesce(F.col("first.row") == F.col("row"), F.lit(True)).alias("kept")
    out = members.select("doc_id", *first, F.lower(F.hex("sha")).alias("text_sha256"))
    return out.unionByName(_by_text(docs, mixed, digest_bytes)) if split else out


def _keyed(docs: DataFrame, digest_bytes: int) -> DataFrame:
    return docs.select("doc_id", normalised("text").alias("text"), F.substring(digest(), 1, digest_bytes).alias("key"))


def _mixed(docs: DataFrame, rows: DataFrame, several: DataFrame, digest_bytes: int) -> DataFrame:
    """The digests that stand for more than one text, compared byte by byte."""
    ids = rows.join(F.broadcast(several.select("key")) if size_of(several) <= BROADCAST_BYTES else several.select("key"), "key", "left_semi").select("doc_id").distinct()
    ids = stored(ids, "copies")
    # Other rows with one of these ids are groups of their own text, so they do no harm.
    texts = join_small(_keyed(docs, digest_bytes), ids, ["doc_id"], "left_semi").unionByName(_keyed(docs.where("doc_id is null"), digest_bytes))
    return texts.groupBy("key").agg(F.min("text").alias("a"), F.max("text").alias("b")).where("a <> b").select("key")


def _by_text(docs: DataFrame, mixed: DataFrame, digest_bytes: int) -> DataFrame:
    """The result's rows of digests that stand for several texts."""
    same = Window.partitionBy("text")
    texts = _keyed(docs, digest_bytes).join(mixed, "key", "left_semi").withColumn("row", F.monotonically_increasing_id())
    first = texts.withColumns({"first": F.min(_first()).over(same), "n": F.count("*").over(same)})
    return first.select("doc_id", F.col("first.doc_id").alias("keep_id"), F.col("n").alias("group_size"), (F.col("first.row") == F.col("row")).alias("kept"), F.lower(F.hex(digest())).alias("text_sha256"))


def op9_exact_copies(spark, sf_dir: str) -> DataFrame:
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP9_SQL = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, CAST(count(*) OVER w AS BIGINT) AS group_size,
  row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)"""
