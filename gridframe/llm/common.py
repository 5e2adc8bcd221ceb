"""Shared pieces of the training-data operators: shared-folder tables, size-checked joins, skew-safe joins."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridframe.sources.shared import new_path

#: A side is broadcast only when its counted rows take at most this many bytes in the hash table that the driver builds of them.
BROADCAST_BYTES = 64_000_000
#: What that table takes for a row besides the row's values: header, place in the page, slots of a map that is up to half empty.
ROW_BYTES = 80
_WIDTHS = {"boolean": 1, "int": 4, "float": 4}


_HELD: dict[str, Callable[[], None]] = {}


def hold(name: str, drop: Callable[[], None]) -> None:
    """Called in a Python worker by an operator that keeps something between tasks: what other operators kept goes."""
    others = [n for n in _HELD if n != name]
    for other in others:
        _HELD.pop(other)()
    if others:
        gc.collect()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc keeps freed memory otherwise
        if trim:
            trim(0)
    _HELD[name] = drop


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: lineage is cut and a lost executor loses nothing."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_path = path
    return out


def drop_stored(df: DataFrame | None) -> None:
    """Delete a table made by stored() that nothing reads any more."""
    path = getattr(df, "_stored_path", None)
    if path:
        jvm = df.sparkSession._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more."""
    gc.collect()
    spark._jvm.System.gc()


def size_of(df: DataFrame) -> int:
    """Bytes of all rows of df in a hash table, counted: fixed types by their width, arrays by their elements, other columns by their text."""
    total = F.lit(ROW_BYTES).cast("double")
    for name, kind in df.dtypes:
        width = F.lit(_WIDTHS.get(kind, 8))
        if kind.startswith("array<") and "struct" not in kind:
            width = 16 + F.coalesce(F.size(F.col(name)), F.lit(0)) * _WIDTHS.get(kind[6:-1], 8)
        elif kind in ("string", "binary") or "<" in kind:
            width = 16 + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0))
        total = total + width
    return int(df.agg(F.coalesce(F.sum(total), F.lit(0.0))).first()[0])


def join_small(left: DataFrame, small: DataFrame, on: list[str], how: str, size: int | None = None) -> DataFrame:
    """Join that broadcasts `small` only when its bytes (counted, or `size`) are few; otherwise it shuffles and AQE splits skewed keys."""
    return left.join(F.broadcast(small) if (size_of(small) if size is None else size) <= BROADCAST_BYTES else small, on, how)


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int, share: int = 1000) -> DataFrame:
    """Left join of rows to one row per key, where a key may hold a large part of all rows.

    Groups with more than total/share rows number fewer than `share`, so they go by broadcast, whatever the input's size;
    the others are joined by a shuffle in which no key is large. Rows of the former get a random shuffle key.
    """
    cols = [c for c in groups.columns if c != key]
    heavy_at = max(total // share, 64)
    heavy = groups.where(F.col(size) > heavy_at).select(F.col(key).alias("_hk"), *[F.col(c).alias(f"_h_{c}") for c in cols])
    light = groups.where(F.col(size) <= heavy_at).select(F.col(key).alias("_lk"), *[F.col(c).alias(f"_l_{c}") for c in cols])
    out = rows.join(F.broadcast(heavy), F.col(key) == F.col("_hk"), "left")
    other = [c for c in rows.columns if c != key]
    spread = F.xxhash64(*other).cast("string") if dict(rows.dtypes)[key] in ("string", "binary") else F.xxhash64(*other)
    if dict(rows.dtypes)[key] == "binary":
        spread = spread.cast("binary")
    out = out.withColumn("_jk", F.when(F.col("_hk").isNull(), F.col(key)).otherwise(spread))
    out = out.join(light, F.col("_jk") == F.col("_lk"), "left")
    return out.select(*rows.columns, *[F.coalesce(f"_h_{c}", f"_l_{c}").alias(c) for c in cols])
