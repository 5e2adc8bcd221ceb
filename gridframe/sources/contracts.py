"""Contracted sources and sinks: text tables, exact headers, key pruning, last row wins, path fallback, ledgers."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gridframe.sources.shared import get_json, put_json, write_counted

ENCODINGS = ["utf-8-sig", "utf-8", "cp932", "shift_jis", "euc_jp"]


def scan_strings(spark: SparkSession, path: str, columns: Sequence[str], exact: bool = False) -> DataFrame:
    """A CSV table as text columns in contract order; a header without a required column (or any other, if exact) is an error."""
    header = spark.read.option("header", True).csv(path).columns
    if (list(header) != list(columns)) if exact else (set(columns) - set(header)):
        raise ValueError(f"header {header} breaks the contract")
    schema = StructType([StructField(c, StringType()) for c in header])
    rows = spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    return rows.select(*columns)


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text: booleans lower-case, dates ISO, null ''."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


def write_text(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """CSV files with a header, sorted within range partitions if an order is given."""
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    rows.write.mode("overwrite").option("header", True).csv(path)


def to_parquet(df: DataFrame, path: str) -> DataFrame:
    """Write as zstd Parquet and read back."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def replace_load(df: DataFrame, path: str, issues: DataFrame) -> tuple[int, bool]:
    """Replace the table at `path` by df as text, unless there are issues: rows of the table now, and whether it was loaded."""
    if issues.limit(1).count():
        return df.sparkSession.read.parquet(path).count(), False
    return write_counted(as_text(df), path), True


def write_report(df: DataFrame, path: str, order: Sequence[str], totals: dict[str, Column] | None = None) -> dict:
    """A report as CSV files in order, and a manifest with its columns, rows and totals, counted as the rows were written.

    Files go to a folder of this run's own and the manifest, written last, names it: until then readers see the report before,
    a run that fails shows nothing, and no task writes where another attempt's files lie.
    """
    run, seen = uuid.uuid4().hex, Observation()
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    counted = rows.observe(seen, F.count("*").alias("rows"), *[c.alias(n) for n, c in (totals or {}).items()])
    counted.write.option("header", True).csv(f"{path}/run={run}")
    manifest = {"run": run, "columns": df.columns, "order": list(order), **seen.get}
    put_json(df.sparkSession, f"{path}/manifest.json", manifest)
    return manifest


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the last whole report, as text, with `_at` (their order)."""
    manifest = get_json(spark, f"{path}/manifest.json")
    schema = StructType([StructField(c, StringType()) for c in manifest["columns"]])
    return spark.read.schema(schema).option("header", True).csv(f"{path}/run={manifest['run']}").withColumn("_at", F.struct(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("row")))


def semi_select(df: DataFrame, keys: DataFrame, on: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows whose key is selected; the header must equal `columns` where given."""
    if columns is not None and list(df.columns) != list(columns):
        raise ValueError("header breaks the contract")
    return df.join(keys.select(on).distinct(), on, "left_semi")


def wide_to_array(df: DataFrame, key: str, columns: Sequence[str], name: str = "p") -> DataFrame:
    """key and one array of the wide columns as doubles."""
    return df.select(key, F.array(*[F.col(c).cast("double") for c in columns]).alias(name))


def index_last_wins(df: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """One row a key: the last by ordinal; rows with a null key go."""
    good = df.dropna(subset=list(keys))
    rest = [c for c in df.columns if c not in keys]
    return good.groupBy(*keys).agg(F.max_by(F.struct(*rest), ordinal).alias("r")).select(*keys, "r.*")


def priority_union(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Rows of the first source that has their key."""
    out = None
    for k, f in enumerate(frames):
        f = f.withColumn("priority", F.lit(k))
        out = f if out is None else out.unionByName(f)
    first = F.min("priority").over(Window.partitionBy(*keys))
    return out.withColumn("_p", first).where("priority = _p").drop("_p")


def append_ledger(old: DataFrame, new: DataFrame) -> DataFrame:
    """Entries of an older header get the new columns blank."""
    return old.unionByName(new, allowMissingColumns=True)


def tag_union(complete: DataFrame, excluded: DataFrame) -> DataFrame:
    """Both lists with source_excluded."""
    return complete.withColumn("source_excluded", F.lit(False)).unionByName(excluded.withColumn("source_excluded", F.lit(True)))


@F.pandas_udf(StringType())
def decode_page(content: pd.Series) -> pd.Series:
    """Bytes of a page by the first encoding that fits, else UTF-8 with replacements."""

    def one(b):
        if b is None:
            return None
        for e in ENCODINGS:
            try:
                return bytes(b).decode(e)
            except UnicodeDecodeError:
                continue
        return bytes(b).decode("utf-8", "replace")

    return content.map(one)


def read_pages(spark: SparkSession, glob: str) -> DataFrame:
    """key (file stem) and html of page files."""
    files = spark.read.format("binaryFile").load(glob)
    return files.select(F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1).alias("key"), decode_page("content").alias("html"))
