"""Result pages: visible text and tables by an HTML parser in Arrow batches, then column expressions."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridframe.functions import text as tx


class _Tables(HTMLParser):
    """Rows of cells of the outermost tables, and the text outside scripts and styles; end tags of cells and rows may be left out."""

    _CELLS, _UNSEEN = {"td", "th"}, {"script", "style"}

    def __init__(self) -> None:
        super().__init__()
        self.tables: list[list[list[str]]] = []
        self.text: list[str] = []
        self.open_tables: list[int] = []  # what is open, from outside in; only the first is read
        self.unseen: str | None = None
        self.cell: list[str] | None = None

    def end_cell(self) -> None:
        if self.cell is not None:
            self.tables[-1][-1].append(" ".join("".join(self.cell).split()))
            self.cell = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        outermost = len(self.open_tables) == 1
        if tag in self._UNSEEN:
            self.unseen = tag
        elif tag == "table":
            if not self.open_tables:
                self.tables.append([])
            self.open_tables.append(len(self.tables))
        elif outermost and (tag == "tr" or tag in self._CELLS):
            self.end_cell()
            if tag == "tr" or not self.tables[-1]:
                self.tables[-1].append([])
            if tag != "tr":
                self.cell = []

    def handle_endtag(self, tag: str) -> None:
        if tag == self.unseen:
            self.unseen = None
        elif len(self.open_tables) == 1 and (tag in ("tr", "table") or tag in self._CELLS):
            self.end_cell()
        if tag == "table" and self.open_tables:
            self.open_tables.pop()

    def handle_data(self, data: str) -> None:
        if self.unseen is None:
            self.text.append(data)
            if self.cell is not None:
                self.cell.append(data)

    def close(self) -> None:
        super().close()
        self.end_cell()


def parse_html(pages: DataFrame, key: str = "key", html: str = "html") -> DataFrame:
    """key, html, visible text and tables (array of rows of cells) of each page."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for k, h in zip(part[key], part[html], strict=True):
                p = _Tables()
                p.feed(h or "")
                p.close()
                rows.append((k, h, " ".join(" ".join(p.text).split()), [[r for r in t if r] for t in p.tables]))
            yield pd.DataFrame(rows, columns=[key, html, "visible", "tables"])

    kind = dict(pages.dtypes)[key]
    return pages.select(key, html).mapInPandas(run, f"{key} {kind}, {html} string, visible string, tables array<array<array<string>>>")


#: Fields of an entry table and the words in the header that each is known by.
HEADERS = {
    "finish": ["着順"],
    "gate": ["枠"],
    "number": ["馬番"],
    "name": ["馬名"],
    "sex_age": ["性齢", "性年齢"],
    "carried": ["負担重量", "斤量", "重量"],
    "rider": ["騎手"],
    "trainer": ["調教師"],
    "weight": ["馬体重"],
    "weight_diff": ["増減"],
    "time": ["タイム"],
    "margin": ["着差"],
    "last_3f": ["上がり", "上り", "3F"],
    "popularity": ["人気"],
    "odds": ["単勝"],
}
#: Words in the labels of the course's condition and of the class; surfaces by their word on the page.
CONDITION, CLASS_NAME = ["馬場"], ["条件", "クラス", "格"]
SURFACES = {"ダート": "dirt", "芝": "turf"}


def result_entries(parsed: DataFrame, key: str = "key") -> DataFrame:
    """One row per entry of each page's result table (the first with number and name headers), with the group's metadata."""
    row = parsed.select(key, F.posexplode("tables").alias("t", "rows"), "tables")
    labels = F.transform(F.get("rows", 0), lambda c: F.regexp_replace(c, r"[\s:：()（）/／]", ""))
    place = lambda words: F.expr("get(filter(sequence(0, size(labels) - 1), i -> " + " or ".join(f"contains(labels[i], '{w}')" for w in words) + "), 0)")
    results = row.withColumn("labels", labels).where("size(labels) > 0").where(place(HEADERS["number"]).isNotNull() & place(HEADERS["name"]).isNotNull())
    first = results.withColumn("k", F.row_number().over(Window.partitionBy(key).orderBy("t"))).where("k = 1")
    entries = first.select(key, "labels", F.posexplode(F.slice("rows", F.lit(2), F.size("rows"))).alias("at", "cells"))
    fields = [F.get("cells", place(words).cast("int")).alias(n) for n, words in HEADERS.items()]
    e = entries.select(key, "at", *fields).where("coalesce(number, '') <> '' or coalesce(name, '') <> ''")
    pair = parsed.select(key, F.explode(F.flatten("tables")).alias("cells")).where("size(cells) = 2").select(key, F.get("cells", 0).alias("label"), F.get("cells", 1).alias("v"))
    course = F.max(F.when(F.col("label") == "距離", F.col("v")))
    surface = F.lit("")
    for word, name in SURFACES.items():
        surface = F.when(F.col("course").contains(word), name).otherwise(surface)
    known = lambda words: F.max(F.when(sum((F.col("label").contains(w).cast("int") for w in words[1:]), F.col("label").contains(words[0]).cast("int")) > 0, F.col("v")))
    meta = pair.groupBy(key).agg(course.alias("course"), F.max(F.when(F.col("label") == "天候", F.col("v"))).alias("weather"), known(CONDITION).alias("condition"), known(CLASS_NAME).alias("class_name"))
    sex, weight = tx.split_letters_digits("sex_age"), tx.split_value_change("weight")
    out = e.join(meta, key, "left").select(
        key,
        tx.parse_key(key)["date"].alias("date"),
        tx.number_before_unit("course").alias("distance"),
        surface.alias("surface"),
        F.coalesce("weather", F.lit("")).alias("weather"),
        F.coalesce("condition", F.lit("")).alias("condition"),
        F.coalesce("class_name", F.lit("")).alias("class_name"),
        tx.clean_int("number").alias("number"),
        tx.clean("name").alias("name"),
        tx.finish_mark("finish").alias("finish"),
        sex["letters"].alias("sex"),
        sex["digits"].alias("age"),
        weight["value"].alias("body_weight"),
        F.coalesce(F.nullif(tx.clean_int("weight_diff"), F.lit("")), weight["change"]).alias("weight_change"),
        tx.clean_int("gate").alias("gate"),
        tx.clean_decimal("carried").alias("carried"),
        tx.clean("rider").alias("rider"),
        tx.clean("trainer").alias("trainer"),
        tx.clean("time").alias("time"),
        tx.clean("margin").alias("margin"),
        tx.clean_decimal("last_3f").alias("last_3f"),
        tx.clean_int("popularity").alias("popularity"),
        tx.clean_decimal("odds").alias("odds"),
    )
    return out.withColumn("group_size", F.count("*").over(Window.partitionBy(key)))
