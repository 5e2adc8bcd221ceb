"""Text functions of result pages and entry tables. Blank, white space and null are one: missing."""

from __future__ import annotations

import re

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def clean(c: str | Column) -> Column:
    """Trimmed text, '' where missing."""
    return F.trim(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")))


def blank_to_null(c: str | Column) -> Column:
    return F.nullif(clean(c), F.lit(""))


@F.pandas_udf(StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """NFKC form with white space collapsed (Spark has no normalisation function)."""
    return texts.map(lambda x: None if x is None else " ".join(unicodedata.normalize("NFKC", x).split()))


def label_key(c: str | Column) -> Column:
    """A label without spaces, colons, parentheses and slashes, after NFKC."""
    return F.regexp_replace(nfkc(c), r"[\s:：()（）/／]", "")


def clean_int(c: str | Column) -> Column:
    """First integer of a text without thousands commas; '' for dashes and none."""
    t = F.regexp_replace(clean(c), ",", "")
    return F.when(t.isin("-", "--"), "").otherwise(F.regexp_extract(t, r"(-?\d+)", 1))


def clean_decimal(c: str | Column) -> Column:
    """First number of a text without commas and units (times, kg)."""
    t = F.regexp_replace(clean(c), "[,倍]|kg", "")
    return F.when(t.isin("-", "--"), "").otherwise(F.regexp_extract(t, r"(-?\d+(?:\.\d+)?)", 1))


#: The marks of entries without a finish.
FINISH_MARKS = {"取消": "SCR", "除外": "EXC", "中止": "DNF"}


def finish_mark(c: str | Column, marks: dict[str, str] | None = None) -> Column:
    """SCR, EXC or DNF by mark, else the first digits."""
    t = clean(c)
    out = F.regexp_extract(t, r"(\d+)", 1)
    for mark, code in reversed((FINISH_MARKS if marks is None else marks).items()):
        out = F.when(t.contains(mark), code).otherwise(out)
    return out


def split_letters_digits(c: str | Column) -> Column:
    """Struct (letters, digits) of texts such as a sex and an age."""
    t = clean(c)
    return F.struct(F.regexp_extract(t, r"^([^\d]+)(\d+)", 1).alias("letters"), F.regexp_extract(t, r"^([^\d]+)(\d+)", 2).alias("digits"))


def split_value_change(c: str | Column) -> Column:
    """Struct (value, change) of texts such as 500(+2); both '' where there is no number."""
    t = clean(c)
    change = F.regexp_replace(F.regexp_extract(t, r"\(([+-]?\d+)\)", 1), r"^\+", "")
    return F.struct(F.regexp_extract(t, r"^(\d+)", 1).alias("value"), change.alias("change"))


def number_before_unit(c: str | Column, unit: str = "m") -> Column:
    """Three or four digits before a unit."""
    return F.regexp_extract(clean(c), rf"(\d{{3,4}})\s*{unit}", 1)


def first_heading(html: str | Column) -> Column:
    """Text of the first h1, h2 or h3; a tag counts as a space, white space as one space."""
    inner = F.regexp_extract(html, r"(?is)<h[1-3][^>]*>(.*?)</h[1-3]>", 1)
    return F.trim(F.regexp_replace(F.regexp_replace(inner, r"<[^>]+>", " "), r"\s+", " "))


def data_attribute(html: str | Column, name: str) -> Column:
    """Value of the first data-<name> attribute in quotes, white space as one space; '' where there is none."""
    found = F.regexp_extract(html, rf"(?i)\bdata-{re.escape(name)}=[\"']([^\"']*)[\"']", 1)
    return F.trim(F.regexp_replace(found, r"\s+", " "))


def parse_bool(c: str | Column) -> Column:
    """true for 1, true, yes and false for 0, false, no in any case; null for all else."""
    t = F.lower(clean(c))
    return F.when(t.isin("1", "true", "yes"), True).when(t.isin("0", "false", "no"), False)


def make_key(date: str | Column, place: str | Column, number: str | Column) -> Column:
    """yyyymmdd_place_number."""
    return F.concat_ws("_", F.date_format(date, "yyyyMMdd"), F.col(place) if isinstance(place, str) else place, (F.col(number) if isinstance(number, str) else number).cast("string"))


def parse_key(key: str | Column) -> Column:
    """Struct (date, place, number) of a natural key; blanks where it doesn't match."""
    k, rx = clean(key), r"^(\d{4})(\d{2})(\d{2})_([^_]+)_(\d{1,2})$"
    date = F.when(k.rlike(rx), F.concat_ws("-", F.regexp_extract(k, rx, 1), F.regexp_extract(k, rx, 2), F.regexp_extract(k, rx, 3))).otherwise("")
    return F.struct(date.alias("date"), F.regexp_extract(k, rx, 4).alias("place"), F.regexp_extract(k, rx, 5).alias("number"))


def positive_int(c: str | Column) -> Column:
    """The value if it is digits only and above zero, else null."""
    t = clean(c)
    return F.when(t.rlike(r"^\d+$") & (t.try_cast("long") > 0), t.try_cast("long"))


def bucket(c: str | Column, edges: list[float], labels: list[str]) -> Column:
    """Label of the first edge that the value doesn't exceed, the last label above; '' for missing and non-positive."""
    v = F.col(c) if isinstance(c, str) else c
    out = F.lit(labels[-1])
    for edge, label in reversed(list(zip(edges, labels, strict=False))):
        out = F.when(v <= edge, label).otherwise(out)
    return F.when(v.isNull() | (v <= 0), "").otherwise(out)
