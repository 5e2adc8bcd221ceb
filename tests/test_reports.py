"""Report sinks, page tables without end tags, and values of the queries that SQL cannot express."""

import hashlib
import unicodedata
from html.parser import HTMLParser

import duckdb
import pytest
from pyspark.sql import functions as F

from gridframe.operators import scoring as sc
from gridframe.plans import QUERIES
from gridframe.sources import contracts as src
from gridframe.sources import pages as pg
from gridframe.sources.shared import new_path, put_json, write_counted

SF = "/root/testdata/sf0.001"


def test_report_shows_nothing_of_a_run_that_fails(spark):
    path, good = new_path(spark, "report"), spark.range(50).select("id", (F.col("id") % 7).alias("k"))
    assert src.write_report(good, path, ["k", "id"], {"total": F.sum("k")})["total"] == sum(i % 7 for i in range(50))
    bad = spark.range(50).select("id", F.when(F.col("id") == 40, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("k"))
    with pytest.raises(Exception, match="broken"):
        src.write_report(bad, path, ["k"])
    back = src.read_report(spark, path).orderBy("_at")
    assert [(int(r.k), int(r.id)) for r in back.collect()] == sorted((i % 7, i) for i in range(50))
    assert src.write_report(good.limit(0), path, ["id"])["rows"] == 0 and src.read_report(spark, path).count() == 0


def test_write_counted_and_small_files(spark):
    path = new_path(spark, "counted")
    assert write_counted(spark.range(1000).repartition(5), path) == spark.read.parquet(path).count() == 1000
    assert write_counted(spark.range(0), path) == 0
    put_json(spark, f"{path}-x.json", {"a": 1})
    put_json(spark, f"{path}-x.json", {"a": "é"})
    from gridframe.sources.shared import get_json

    assert get_json(spark, f"{path}-x.json") == {"a": "é"}


def test_page_tables_without_end_tags_and_long_tables(spark):
    head = "<tr><th>着順<th>馬番<th>馬名"
    rows = "".join(f"<tr><td>{k}<td>{k}<td>n{k}" for k in range(1, 10_050))
    html = f"<table><tr><td>馬場状態<td>良<tr><td>競走条件<td>A 級<tr><td>天候<td>晴</table><table>{head}{rows}<script>no</script></table>after"
    parsed = pg.parse_html(spark.createDataFrame([("20310102_north_9", html), ("20310102_north_1", None)], "key string, html string"))
    got = pg.result_entries(parsed).collect()
    assert len(got) == 10_049 and {(r["condition"], r["class_name"], r["weather"]) for r in got} == {("良", "A 級", "晴")}
    assert {r["name"] for r in got} == {f"n{k}" for k in range(1, 10_050)}


def texts(column="text"):
    return dict(duckdb.sql(f"SELECT doc_id, {column} FROM '{SF}/documents.parquet'").fetchall())


def test_normalised_texts_and_labels(spark):
    got = {r.doc_id: r.text for r in QUERIES["nfkc"](spark, SF).collect()}
    assert got == {i: None if t is None else " ".join(unicodedata.normalize("NFKC", t).split()) for i, t in texts().items()}
    labels = {r.doc_id: r.label for r in QUERIES["label_norm"](spark, SF).collect()}
    assert labels == {i: None if t is None else "".join(c for c in unicodedata.normalize("NFKC", t) if not c.isspace() and c not in ":()/") for i, t in texts("source").items()}


def test_file_hashes(spark):
    (r,) = QUERIES["file_hashes"](spark, SF).collect()
    data = open(f"{SF}/documents.parquet", "rb").read()
    assert (r.bytes, r.sha256) == (len(data), hashlib.sha256(data).hexdigest())


class Plain(HTMLParser):
    def __init__(self):
        super().__init__()
        self.parts, self.skip, self.n = [], 0, 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style")
        self.n += tag == "table"

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style")

    def handle_data(self, data):
        self.parts += [] if self.skip else [data]


def test_visible_text_of_pages(spark):
    got = {r.page_id: r.visible for r in QUERIES["visible_text"](spark, SF).collect()}
    sizes = {r.page_id: (r.n_tables, r.n_visible) for r in QUERIES["parse_pages"](spark, SF).collect()}
    for i, html in duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall():
        p = Plain()
        p.feed(html or "")
        p.close()
        want = " ".join(" ".join(p.parts).split())
        assert got[i] == want and sizes[i] == (p.n, len(want))


def test_hashed_features_are_spread_and_stable(spark):
    rows, again = ([r.features for r in QUERIES["feature_hash"](spark, SF).select("features").collect()] for _ in range(2))
    assert sorted(rows) == sorted(again) and all(r.startswith("(131072,[") for r in rows)
    assert {sum(map(float, r.rsplit("[", 1)[1].rstrip("])").split(","))) for r in rows} == {3.0}
    assert 3 < len(set(rows)) < len(rows)


def test_bootstrap_interval_holds_the_mean_and_narrows(spark):
    daily = spark.range(400).select(F.col("id").alias("day"), (F.col("id") % 11).cast("double").alias("total"), F.lit(2).alias("n"))
    wide, narrow = (sc.bootstrap(daily.where(f"day < {n}"), "day", "total", "n", 200, 7).first() for n in (40, 400))
    true = sum(i % 11 for i in range(400)) / 800
    assert narrow.low < true < narrow.high and narrow.low < narrow.mean < narrow.high and narrow.high - narrow.low < wide.high - wide.low
    assert sc.bootstrap(daily, "day", "total", "n", 200, 7).first() == narrow
    r = QUERIES["paired_bootstrap"](spark, SF).first()
    assert r.low <= r.mean <= r.high


def test_calibration_chooses_on_its_own_rows_only(spark):
    flat, sharp = [0.4, 0.3, 0.3], [0.9, 0.05, 0.05]
    fit = spark.createDataFrame([(flat, 0)] * 20, "p array<double>, y int")
    pred = spark.createDataFrame([(sharp, 1)], "p array<double>, y int")
    best, out = sc.calibrate(fit, pred, "p", "y", [0.25, 1.0, 4.0])
    r = out.first()
    assert best == 0.25 and r.calibrated_loss > r.raw_loss and sum(r.calibrated) == pytest.approx(1)


def test_qualification_of_empty_and_unknown(spark):
    expected = spark.createDataFrame([(1, "u"), (2, "u")], "k int, population string")
    none = spark.createDataFrame([], "k int, p array<double>")
    (r,) = sc.qualify(none, expected, "k", "p", 2, "population").collect()
    assert (r.expected, r.covered, r.missing, r.errors, r.disqualified) == (2, 0, 2, "missing:2", True)
    got = {r.population: r.errors for r in sc.qualify(spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5]), (9, [1.0, 0.0])], "k int, p array<double>"), expected, "k", "p", 2, "population").collect()}
    assert got == {"u": "", None: "extra:1"}
