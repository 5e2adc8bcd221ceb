"""Small literals for what the driver's tables cannot show."""

import datetime as dt
import hashlib
import math
import pathlib
import unicodedata
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridframe.functions import orders as om
from gridframe.functions import text as tx
from gridframe.operators import append as ap
from gridframe.operators import asof
from gridframe.operators import checks as ck
from gridframe.operators import outcomes as oc
from gridframe.operators import scoring as sc
from gridframe.operators.quantiles import exact_quantiles
from gridframe.plans import QUERIES
from gridframe.sources import contracts as src
from gridframe.sources import pages as pg


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_class_ids_are_the_order_of_permutations(spark):
    want = [(i, *o, "-".join(map(str, o))) for i, o in enumerate(permutations(range(1, 7), 3))]
    table = om.class_table(spark)
    assert sorted(rows(table)) == want
    assert table.where(om.class_id("first", "second", "third") != F.col("class_id")).count() == 0
    bad = spark.createDataFrame([(1, 1, 2), (0, 1, 2), (7, 1, 2)], "a int, b int, c int")
    assert [r[0] for r in bad.select(om.class_id("a", "b", "c")).collect()] == [None] * 3


ENTRIES = [
    ("r10", "k", 1, "1", "1600", 5),
    ("r10", "k", 2, "2", "1600", 5),
    ("r10", "k", 3, "3", "1600", 5),
    ("r10", "k", 4, "SCR", "1600", 5),
    ("r10", "k", 5, "DNF", "1600", 5),
    ("r08", "o", 1, "EXC", "1200", 3),
    ("r08", "o", 2, "4", "1200", 3),
    ("r08", "o", 3, "1", "1200", 3),
]


def entries(spark):
    return spark.createDataFrame(ENTRIES, "group string, track string, number int, finish string, distance string, size int").withColumn("row", F.monotonically_increasing_id())


def test_valid_entries_have_no_issues(spark):
    e = entries(spark)
    rules = [("finish", "status", ["SCR", "EXC", "DNF"]), ("distance", "int", None), ("track", "enum", ["k", "o"])]
    assert ck.check_rows(e, rules, "row", "group").count() == 0
    assert ck.group_size_issues(e, "group", "size", 1).count() == 0
    assert ck.duplicates_in_group(e, "group", "number", "row").count() == 0


def test_invalid_rows(spark):
    bad = spark.createDataFrame([(2, "2026-06-16_k_10", "2026/06/16", "tokyo", "one-mile", "lost"), (3, "20260616_k_10", "2026-06-16", "k", "", "")], "row int, id string, date string, track string, distance string, finish string")
    rules = [("id", "pattern", r"^\d{8}_(k|o)_\d{1,2}$"), ("date", "date", None), ("track", "enum", ["k", "o"]), ("distance", "int", None), ("finish", "status", ["SCR"])]
    found = ck.check_rows(bad, rules, "row", "id")
    assert sorted(r["column"] for r in found.collect()) == ["date", "distance", "finish", "id", "track"]
    assert {r["row_no"] for r in found.collect()} == {2}


def test_scope_and_duplicates(spark):
    df = spark.createDataFrame([("a", 7, 1, "k"), ("a", 7, 2, "k"), ("a", 8, 3, " ")], "g string, m int, o int, s string")
    assert rows(ck.duplicates_in_group(df, "g", "m", "o")) == [("a", 7, 2, 1)]
    assert rows(ck.scope_issues(df, "s", "k")) == [("k", "ok")]
    assert rows(ck.scope_issues(df, "s", "o")) == [("k", "other")]
    assert rows(ck.scope_issues(df.limit(0), "s")) == [("", "none")]


def test_text_functions(spark):
    df = spark.createDataFrame([("1,234円", "１２ｋｇ", "競走除外", "牡4", "500(+2)", "計不", "ダート 1400m")], "a string, b string, c string, d string, e string, f string, g string")
    got = df.select(
        tx.clean_int("a"), tx.nfkc("b"), tx.finish_mark("c"), tx.split_letters_digits("d"), tx.split_value_change("e"), tx.split_value_change("f"), tx.number_before_unit("g")
    ).first()
    assert got[0] == "1234" and got[1] == "12kg" and got[2] == "EXC"
    assert tuple(got[3]) == ("牡", "4") and tuple(got[4]) == ("500", "2") and tuple(got[5]) == ("", "") and got[6] == "1400"


PAGE = """<main><script>hidden()</script><h2>夕なぎ記念</h2>
<table><tbody><tr><td>芝 2000m</td><td>距離</td></tr><tr><td>距離</td><td>芝 2000m</td></tr><tr><td>天候</td><td>雨</td></tr></tbody></table>
<table><tr><th>馬名</th><th>馬番</th><th>枠番</th><th>単勝オッズ</th><th>馬体重</th><th>性齢</th><th>着順</th><th>調教師</th><th>タイム</th><th>上がり3F</th><th>斤量</th><th>着差</th></tr>
<tr><td>ハマナスロード</td><td>11</td><td>7</td><td>18.6</td><td>431(+13)</td><td>牝3</td><td>2</td><td>北 一郎</td><td>2:04.8</td><td>38.9</td><td>52.5</td><td>クビ</td></tr>
<tr><td>トオリアメ</td><td>4</td><td>3</td><td>1,077.5</td><td>計不</td><td>牡7</td><td>競走中止</td><td>南 二郎</td><td></td><td></td><td>57</td><td></td></tr></table></main>"""


def test_result_page(spark):
    pages = spark.createDataFrame([("20310102_north_9", PAGE)], "key string, html string")
    parsed = pg.parse_html(pages)
    assert "hidden" not in parsed.first()["visible"]
    got = sorted(pg.result_entries(parsed).collect(), key=lambda r: r["number"])
    assert [(r["number"], r["finish"], r["odds"], r["body_weight"], r["weight_change"]) for r in got] == [("11", "2", "18.6", "431", "13"), ("4", "DNF", "1077.5", "", "")]
    assert (got[0]["date"], got[0]["distance"], got[0]["surface"], got[0]["weather"], got[0]["group_size"]) == ("2031-01-02", "2000", "turf", "雨", 2)
    assert [(r["gate"], r["carried"], r["trainer"], r["time"], r["margin"], r["last_3f"]) for r in got] == [("7", "52.5", "北 一郎", "2:04.8", "クビ", "38.9"), ("3", "57", "南 二郎", "", "", "")]


def test_csv_contract_and_round_trip(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('﻿a,b\n1,"全角 ""引用"""\n2,\n', encoding="utf-8")
    t = src.scan_strings(spark, str(path), ["a", "b"], exact=True)
    assert rows(t) == [("1", '全角 "引用"'), ("2", None)]
    with pytest.raises(ValueError):
        src.scan_strings(spark, str(path), ["a", "c"])
    src.write_text(src.as_text(t), str(tmp_path / "out"), ["a"])
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 2
    assert rows(src.to_parquet(t, str(tmp_path / "p")).orderBy("a")) == rows(t)


def test_page_bytes_by_encoding(spark, tmp_path):
    (tmp_path / "x1.html").write_bytes("競走".encode("cp932"))
    (tmp_path / "x2.html").write_bytes("競走".encode())
    assert sorted(rows(src.read_pages(spark, str(tmp_path / "*.html")))) == [("x1", "競走"), ("x2", "競走")]
    assert ap.file_hashes(spark, str(tmp_path)).count() == 2


def test_asof_counts_only_earlier_days(spark):
    h = spark.createDataFrame([(1, 1, 1, 1.0, 1), (2, 1, 1, 2.0, 0), (3, 1, 2, 3.0, 1), (4, 1, 5, 4.0, 1)], "id int, e int, day int, v double, f int")
    got = asof.add_recency(asof.add_recent(asof.add_counts(h, "e", "day"), "e", "day", ["id"], "v", "f"), "e", "day")
    by = {r["id"]: r for r in got.collect()}
    assert [by[i]["prior_count"] for i in (1, 2, 3, 4)] == [None, None, 2, 3]
    assert [by[i]["recent_mean"] for i in (1, 2, 3, 4)] == [None, None, 1.5, 2.0]
    assert [by[i]["days_since"] for i in (1, 2, 3, 4)] == [None, None, 1, 3]
    shuffled = asof.add_counts(h.repartition(3, "v"), "e", "day")
    assert {r["id"]: r["prior_count"] for r in shuffled.collect()} == {i: by[i]["prior_count"] for i in by}


def test_interval_starting_on_the_day_is_rejected(spark):
    df = spark.createDataFrame([("a", 5), ("a", 10), ("b", 5)], "k string, day long")
    iv = spark.createDataFrame([("a", 5, 9, 1), ("a", 9, None, 2)], "k string, s long, e long, interval_id int")
    got = {(r["k"], r["day"]): r["interval_id"] for r in asof.interval_join(df, iv, ["k"], "day", "s", "e").collect()}
    assert got == {("a", 5): None, ("a", 10): 2, ("b", 5): None}


def test_outcomes_of_the_three_group_corpus(spark):
    data = [("g1", i, i) for i in range(1, 7)] + [("g2", i, f) for i, f in zip(range(1, 7), (1, 2, 2, 4, 5, 6), strict=True)] + [("g3", i, i) for i in range(1, 6)]
    e = spark.createDataFrame(data, "g string, lane int, finish int")
    got = {r["g"]: (r["target_status"], r["class_id"]) for r in oc.target_status(e, "g", "lane", "finish").collect()}
    assert got == {"g1": ("unique_order", 0), "g2": ("tied", None), "g3": ("void", None)}
    snap = oc.build_snapshot(e.withColumn("x", F.lit(1)), "g", "lane", "finish", [], ["x"], ["x"], least=6)
    assert {r["g"]: (r["eligible"], r["main"], r["reasons"]) for r in snap["eligibility"].collect()} == {
        "g1": (True, True, ""),
        "g2": (True, False, "target_tied"),
        "g3": (False, False, "entry_count|target_void"),
    }
    assert all(r["issues"] == 0 for r in oc.snapshot_issues(snap, "g", "lane").collect())


def test_payouts(spark):
    p = spark.createDataFrame([("a", "1-2-3", 100), ("a", "1=3=2", 50), ("b", "1-1-2", 10), ("b", "4-5-6", None)], "g string, c string, y int")
    assert {r["g"]: r["combos"] for r in oc.payout_combinations(p, "g", "c", "y").collect()} == {"a": ["1-2-3", "1-3-2"], "b": []}


def test_uniform_and_bad_predictions(spark):
    p = spark.createDataFrame([("a", 7)], "k string, class_id int").withColumn("p", F.array_repeat(F.lit(1 / 120), 120))
    got = sc.order_losses(p, "p", "class_id", om.class_table(spark)).first()
    want = [math.log(120), math.log(6), math.log(30), math.log(20), math.log(5), math.log(4), 119 / 120]
    assert all(abs(got[c] - w) < 1e-12 for c, w in zip(sc.LOSSES, want, strict=True))
    bad = p.withColumn("p", F.transform("p", lambda x, i: F.when(i == 0, -0.1).when(i == 1, 2 / 120 + 0.1).otherwise(x)))
    assert rows(ck.prob_issues(bad, "k", "p", 120)) == [("a", "outside [0,1]")]
    zero = sc.class_losses(p.withColumn("p", F.transform("p", lambda x, i: F.when(i == 7, 0.0).otherwise(x))), "p", "class_id").first()
    assert zero["log_loss"] == math.inf and zero["rank"] == 120


def test_append_is_idempotent(spark, tmp_path):
    t = str(tmp_path / "t")
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, v int")
    assert [ap.append_batch(a, t, b, "k") for b in ("1", "1", "2")] == [2, 2, 0]
    assert spark.read.parquet(t).count() == 2
    same = ap.logical_hash(a, ["k", "v"]).first()
    assert ap.logical_hash(a.orderBy(F.desc("k")).repartition(3), ["k", "v"]).first() == same


def test_append_in_steps_resumes(spark, tmp_path):
    new = spark.createDataFrame([("x", 1), ("y", None)], "k string, v int")
    run = ap.AppendRun(spark, str(tmp_path / "r"), "b1", "k")
    for k, stop in enumerate(ap.STEPS):  # broken off after each step in turn
        assert run.run(new, stop) == [stop] and run.done() == sorted(ap.STEPS[: k + 1], key=ap.STEPS.index)
    assert run.run(new) == [] and spark.read.parquet(run.table).count() == 2
    other = ap.AppendRun(spark, str(tmp_path / "r"), "b2", "k")
    assert other.run(spark.createDataFrame([("y", 5), ("z", 6)], "k string, v int")) == ap.STEPS
    assert {(r["batch_id"], r["k"]) for r in spark.read.parquet(run.table).collect()} == {("b1", "x"), ("b1", "y"), ("b2", "z")}
    assert {(r["batch_id"], r["step"], r["n_rows"]) for r in run.ledger().where("step in ('backup', 'append')").collect()} == {("b1", "backup", 0), ("b1", "append", 2), ("b2", "backup", 1), ("b2", "append", 1)}


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(4)
    data = [(g, float(v)) for g, n in (("a", 1), ("b", 2), ("c", 997)) for v in np.round(rng.normal(size=n), 2)] + [("c", None), ("d", math.inf), ("d", math.inf)]
    df = spark.createDataFrame(data, "g string, v double")
    qs = [0.0, 0.01, 0.5, 0.77, 1.0]
    got = {r["g"]: r["quantiles"] for r in exact_quantiles(df, "v", qs, ["g"]).collect()}
    for g in "abc":
        assert np.allclose(got[g], np.quantile([v for k, v in data if k == g and v is not None], qs))
    assert got["d"] == [math.inf] * 5
    whole = exact_quantiles(df.where("g <> 'd'"), "v", qs).first()["quantiles"]
    assert np.allclose(whole, np.quantile([v for k, v in data if k != "d" and v is not None], qs))
    assert exact_quantiles(df.limit(0), "v", qs, ["g"]).count() == 0


def test_logical_hash_folds_grown_buckets(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("k"))
    want = sorted(hashlib.sha256(str(i).encode()).hexdigest() for i in range(500))
    level = {h[:4]: "" for h in want}
    for b in level:
        level[b] = hashlib.sha256("".join(h for h in want if h[:4] == b).encode()).hexdigest()
    up = {b[:2] for b in level}
    top = "".join(hashlib.sha256("".join(level[x] for x in sorted(level) if x[:2] == b).encode()).hexdigest() for b in sorted(up))
    assert ap.logical_hash(df, ["k"], bucket_rows=1).first()["content_hash"] == ap.logical_hash(df, ["k"], 4).first()["content_hash"] == hashlib.sha256(top.encode()).hexdigest()


def test_settled_and_outside_finishes_are_void(spark):
    rows_ = [("a", i, i, True) for i in range(1, 7)] + [("b", i, i, i > 1) for i in range(1, 7)] + [("c", i, i + 1, True) for i in range(1, 7)] + [("d", i, 1 if i < 3 else i, True) for i in range(1, 7)]
    e = spark.createDataFrame(rows_, "g string, lane int, finish int, done boolean")
    got = {r["g"]: r["target_status"] for r in oc.target_status(e, "g", "lane", "finish", settled="done").collect()}
    assert got == {"a": "unique_order", "b": "void", "c": "void", "d": "tied"}


def test_queries_without_sql_equal_python(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["nfkc"](spark, sf).collect():
        text = docs[r["doc_id"]]["text"]
        assert r["text"] == (None if text is None else " ".join(unicodedata.normalize("NFKC", text).split()))
    files = QUERIES["file_hashes"](spark, sf).collect()
    for r in files:
        data = pathlib.Path(r["path"].removeprefix("file:")).read_bytes()
        assert (r["bytes"], r["sha256"]) == (len(data), hashlib.sha256(data).hexdigest())
    assert files


def test_windows_touch_and_go_back(spark):
    w = rows(ap.date_windows(spark, "2026-06-30", 10, 3, 2).orderBy("window_no"))
    assert w[0] == (1, 1, dt.date(2026, 6, 21), dt.date(2026, 6, 30)) and w[2] == (3, 2, dt.date(2026, 6, 1), dt.date(2026, 6, 10))


def test_schema_issues():
    assert ck.schema_issues(["a", "b"], ["a", "b"]) == []
    assert len(ck.schema_issues(["a", "odds_final"], ["a", "b"], tokens=["ODDS"])) == 2
