"""Checks, sources, projections and joins on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridframe.functions import orders as om
from gridframe.functions import text as tx
from gridframe.operators import append as ap
from gridframe.operators import asof
from gridframe.operators import checks as ck
from gridframe.operators import outcomes as oc
from gridframe.plans.registry import query, r6
from gridframe.plans.views import E, H, P, T, entry, hist, prob
from gridframe.session import table
from gridframe.sources.shared import stored
from gridframe.sources import contracts as src

# ---- sources


@query("scan_strings", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, coalesce(o_orderpriority, '') AS o_orderpriority FROM orders")
def scan_strings(spark, d):
    o = table(spark, d, "orders")
    return src.as_text(o.select("o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("o_orderdate"), "o_orderpriority"))


@query("load_coalesced", "SELECT count(*) AS n_rows, CAST(count(*) FILTER (v = '') AS BIGINT) AS blanks FROM (SELECT coalesce(CAST(nullif(l_returnflag, 'N') AS VARCHAR), '') AS v FROM lineitem)")
def load_coalesced(spark, d):
    t = src.as_text(table(spark, d, "lineitem").select(F.nullif(F.col("l_returnflag"), F.lit("N")).alias("v")))
    return t.agg(F.count("*").alias("n_rows"), F.count_if(F.col("v") == "").alias("blanks"))


@query("semi_selected", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def semi_selected(spark, d):
    keys = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return src.semi_select(table(spark, d, "orders"), keys, "o_custkey").select("o_orderkey", "o_custkey", "o_orderstatus")


@query("parquet_roundtrip", "SELECT p_partkey, p_name, p_brand, p_size FROM part")
def parquet_roundtrip(spark, d):
    return src.as_text(table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_size")).select(F.col("p_partkey").cast("long").alias("p_partkey"), "p_name", "p_brand", F.col("p_size").cast("int").alias("p_size"))


@query("wide_to_array", "SELECT vec_id, [CAST(embedding[1] AS DOUBLE), CAST(embedding[2] AS DOUBLE), CAST(embedding[3] AS DOUBLE)] AS p FROM embeddings")
def wide_to_array(spark, d):
    e = table(spark, d, "embeddings")
    wide = e.select("vec_id", *[F.get("embedding", i).alias(f"p_{i:03d}") for i in range(3)])
    return src.wide_to_array(wide, "vec_id", ["p_000", "p_001", "p_002"])


@query("json_last_wins", "SELECT entity, k, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM (SELECT user_id AS entity, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_id, event_type FROM events) WHERE k IS NOT NULL GROUP BY entity, k")
def json_last_wins(spark, d):
    ev = table(spark, d, "events").select(F.col("user_id").alias("entity"), F.from_json("props", "k long")["k"].alias("k"), "event_id", "event_type")
    return src.index_last_wins(ev.withColumn("ordinal", F.col("event_id")), ["entity", "k"], "ordinal").select("entity", "k", "event_id", "event_type")


@query("priority_union", "WITH a AS (SELECT o_orderkey AS k, o_totalprice AS v, 0 AS priority FROM orders WHERE o_orderkey % 3 = 0), b AS (SELECT o_orderkey AS k, -o_totalprice AS v, 1 AS priority FROM orders WHERE o_orderkey % 2 = 0) SELECT * FROM a UNION ALL SELECT * FROM b WHERE k NOT IN (SELECT k FROM a)")
def priority_union(spark, d):
    o = table(spark, d, "orders")
    a = o.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"))
    b = o.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("k"), (-F.col("o_totalprice")).alias("v"))
    return src.priority_union([a, b], ["k"]).select("k", "v", "priority")


@query("ledger_evolve", "SELECT o_orderkey AS batch, o_orderstatus AS mode, NULL AS note FROM orders WHERE o_orderkey % 4 = 0 UNION ALL SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 4 = 1")
def ledger_evolve(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("batch"), F.col("o_orderstatus").alias("mode"), F.col("o_orderpriority").alias("note"))
    return src.append_ledger(o.where("batch % 4 = 0").drop("note"), o.where("batch % 4 = 1"))


@query("candidate_union", "SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS venue, c_custkey, c_acctbal < 0 AS source_excluded FROM customer")
def candidate_union(spark, d):
    c = table(spark, d, "customer").select(F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("venue"), "c_custkey", "c_acctbal")
    return src.tag_union(c.where("c_acctbal >= 0"), c.where("c_acctbal < 0")).drop("c_acctbal")


# ---- row checks


def _issues(name, column, kind, arg, view, sql_bad, sql_from, group="NULL"):
    sql = f"SELECT row_no, group_id, '{column}' AS \"column\", '{kind}' AS rule, '{column} fails {kind}: ' || v AS message FROM ({sql_from}) WHERE {sql_bad}"

    @query(name, sql)
    def run(spark, d):
        return ck.check_rows(view(spark, d), [(column, kind, arg)], "row_no", "group_id")

    return run


_issues("v_pattern", "c_name", "pattern", r"^Customer#\d{8}[0-4]$", lambda s, d: table(s, d, "customer").select(F.col("c_custkey").alias("row_no"), F.col("c_nationkey").alias("group_id"), "c_name"),
        r"NOT regexp_matches(v, '^Customer#\d{8}[0-4]$')", "SELECT c_custkey AS row_no, CAST(c_nationkey AS VARCHAR) AS group_id, c_name AS v FROM customer")
_issues("v_enum", "o_orderpriority", "enum", ["1-URGENT", "2-HIGH", "3-MEDIUM"], lambda s, d: table(s, d, "orders").select(F.col("o_orderkey").alias("row_no"), F.col("o_custkey").alias("group_id"), "o_orderpriority"),
        "v NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')", "SELECT o_orderkey AS row_no, CAST(o_custkey AS VARCHAR) AS group_id, o_orderpriority AS v FROM orders")
_issues("v_date", "day", "date", None, lambda s, d: table(s, d, "orders").select(F.col("o_orderkey").alias("row_no"), F.col("o_custkey").alias("group_id"), F.when(F.col("o_orderkey") % 5 == 0, F.date_format("o_orderdate", "yyyy/MM/dd")).when(F.col("o_orderkey") % 7 == 0, F.concat(F.date_format("o_orderdate", "yyyy-MM"), F.lit("-31"))).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day")),
        r"NOT (length(v) = 10 AND regexp_matches(v, '^\d{4}-\d{2}-\d{2}$') AND TRY_CAST(v AS DATE) IS NOT NULL)", "SELECT o_orderkey AS row_no, CAST(o_custkey AS VARCHAR) AS group_id, CASE WHEN o_orderkey % 5 = 0 THEN strftime(o_orderdate, '%Y/%m/%d') WHEN o_orderkey % 7 = 0 THEN strftime(o_orderdate, '%Y-%m') || '-31' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS v FROM orders")
_issues("v_int", "size", "int", None, lambda s, d: table(s, d, "part").select(F.col("p_partkey").alias("row_no"), F.col("p_brand").alias("group_id"), F.when(F.col("p_partkey") % 3 == 0, F.concat(F.col("p_size").cast("string"), F.lit("cm"))).when(F.col("p_partkey") % 4 == 0, "").otherwise(F.col("p_size").cast("string")).alias("size")),
        r"v <> '' AND NOT regexp_matches(v, '^-?\d+$')", "SELECT p_partkey AS row_no, p_brand AS group_id, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS VARCHAR) || 'cm' WHEN p_partkey % 4 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END AS v FROM part")
_issues("v_decimal", "price", "decimal", None, lambda s, d: table(s, d, "part").select(F.col("p_partkey").alias("row_no"), F.col("p_brand").alias("group_id"), F.when(F.col("p_partkey") % 3 == 0, F.concat(F.col("p_size").cast("string"), F.lit(".5x"))).otherwise(F.concat(F.col("p_size").cast("string"), F.lit(".25"))).alias("price")),
        "TRY_CAST(v AS DOUBLE) IS NULL", "SELECT p_partkey AS row_no, p_brand AS group_id, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS VARCHAR) || '.5x' ELSE CAST(p_size AS VARCHAR) || '.25' END AS v FROM part")
_issues("v_status", "finish", "status", ["SCR", "EXC", "DNF"], lambda s, d: table(s, d, "lineitem").select(F.col("l_orderkey").alias("row_no"), F.col("l_suppkey").alias("group_id"), F.when(F.col("l_returnflag") == "R", "SCR").when(F.col("l_linestatus") == "F", "lost").otherwise((F.col("l_linenumber") - 1).cast("string")).alias("finish")),
        r"v NOT IN ('SCR', 'EXC', 'DNF') AND NOT (regexp_matches(v, '^\d+$') AND TRY_CAST(v AS BIGINT) > 0)", "SELECT l_orderkey AS row_no, CAST(l_suppkey AS VARCHAR) AS group_id, CASE WHEN l_returnflag = 'R' THEN 'SCR' WHEN l_linestatus = 'F' THEN 'lost' ELSE CAST(l_linenumber - 1 AS VARCHAR) END AS v FROM lineitem")

# ---- group checks

_ORD = "l_orderkey * 1000000000 + l_partkey * 10000 + l_suppkey + CAST(l_quantity AS BIGINT) * 100000 + CAST(round(l_extendedprice * 100) AS BIGINT)"


def _lines(spark, d):
    """Lines with an ordinal that is made from the row, as Parquet rows have no order of their own."""
    return table(spark, d, "lineitem").withColumn("ordinal", F.expr(_ORD))


@query("dup_in_group", f"SELECT group_id, member, row_no, first_row FROM (SELECT l_orderkey AS group_id, l_linenumber AS member, {_ORD} AS row_no, row_number() OVER w AS nth, first({_ORD}) OVER w AS first_row FROM lineitem WINDOW w AS (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ORD})) WHERE nth > 1")
def dup_in_group(spark, d):
    return ck.duplicates_in_group(_lines(spark, d), "l_orderkey", "l_linenumber", "ordinal")


_SIZE = "SELECT l_orderkey AS group_id, count(DISTINCT dec) AS kinds, CAST(max(dec) AS BIGINT) AS declared, count(*) AS actual FROM (SELECT l_orderkey, {dec} AS dec FROM lineitem) GROUP BY l_orderkey"
_SIZE_ONE = "SELECT group_id, reason, CASE WHEN kinds = 1 THEN declared END AS declared, actual, CASE WHEN kinds = 1 THEN declared - actual END AS diff FROM (SELECT *, CASE WHEN kinds = 0 THEN {missing} WHEN kinds > 1 THEN 'ambiguous' WHEN abs(declared - actual) > {tol} THEN 'mismatch' END AS reason FROM ({size})) WHERE reason IS NOT NULL"


@query("group_size_check", _SIZE_ONE.format(missing="NULL", tol=1, size=_SIZE.format(dec="CASE WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_orderkey % 13 = 0 THEN l_linenumber ELSE 4 END")))
def group_size_check(spark, d):
    dec = F.when(F.col("l_orderkey") % 11 == 0, F.lit(None)).when(F.col("l_orderkey") % 13 == 0, F.col("l_linenumber")).otherwise(4)
    return ck.group_size_issues(table(spark, d, "lineitem").withColumn("declared", dec), "l_orderkey", "declared", 1)


@query("group_size_audit", _SIZE_ONE.format(missing="'missing'", tol=0, size=_SIZE.format(dec="CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE 4 END")))
def group_size_audit(spark, d):
    dec = F.when(F.col("l_orderkey") % 11 != 0, 4)
    return ck.group_size_issues(table(spark, d, "lineitem").withColumn("declared", dec), "l_orderkey", "declared", 0, True)


@query("overlap_keys", "SELECT DISTINCT o_orderkey, (SELECT count(DISTINCT o_orderkey) FROM orders WHERE o_orderkey % 6 = 0) AS n_all FROM orders WHERE o_orderkey % 6 = 0 ORDER BY 1 LIMIT 50")
def overlap_keys(spark, d):
    o = table(spark, d, "orders")
    return ck.overlap(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 3 = 0"), "o_orderkey")


@query("single_scope", "SELECT string_agg(DISTINCT s, '|' ORDER BY s) AS scopes, 'several' AS verdict FROM (SELECT nullif(trim(c_mktsegment), '') AS s FROM customer)")
def single_scope(spark, d):
    return ck.scope_issues(table(spark, d, "customer"), "c_mktsegment")


@query("id_consistency", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) % 7 <> user_id % 7")
def id_consistency(spark, d):
    ev = table(spark, d, "events").withColumn("k", F.regexp_extract("props", r'"k": (\d+)', 1).cast("long"))
    return ev.where("k % 7 <> user_id % 7").select("event_id", "k")


@query("metadata_conflict", "SELECT l_orderkey AS group_id, count(DISTINCT (l_returnflag, l_linestatus)) AS signatures, count(*) AS n_rows FROM lineitem GROUP BY 1 HAVING count(DISTINCT (l_returnflag, l_linestatus)) > 1")
def metadata_conflict(spark, d):
    return ck.metadata_conflicts(table(spark, d, "lineitem"), "l_orderkey", ["l_returnflag", "l_linestatus"])


@query("append_verdict", f"""WITH n AS (SELECT *, {_ORD} AS ordinal FROM lineitem WHERE l_orderkey % 4 = 0), o AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey % 6 = 0)
SELECT 'empty' AS rule, CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS issues FROM n
UNION ALL SELECT 'rows', 0 UNION ALL SELECT 'duplicates', CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) FROM n
UNION ALL SELECT 'sizes', count(*) FROM (SELECT l_orderkey FROM n GROUP BY l_orderkey HAVING count(*) <> 4)
UNION ALL SELECT 'overlap', count(DISTINCT l_orderkey) FROM n WHERE l_orderkey IN (SELECT l_orderkey FROM o)
UNION ALL SELECT 'metadata', count(*) FROM (SELECT l_orderkey FROM n GROUP BY l_orderkey HAVING count(DISTINCT l_linestatus) > 1)
UNION ALL SELECT 'scope', CAST(CASE WHEN count(DISTINCT l_returnflag) <> 1 THEN 1 ELSE 0 END AS BIGINT) FROM n
UNION ALL SELECT 'identity', count(*) FROM n WHERE l_suppkey % 9 = 0
UNION ALL SELECT 'header', 1""")
def append_verdict(spark, d):
    # The id of every ninth supplier's rows names another flag; the old table has its last columns in another order.
    flag = F.when(F.col("l_suppkey") % 9 == 0, "?").otherwise(F.col("l_returnflag"))
    li = _lines(spark, d).withColumns({"declared": F.lit(4), "id": F.concat_ws("_", "l_orderkey", flag)})
    old = li.where("l_orderkey % 6 = 0").select(*li.columns[:-2], "id", "declared")
    ids = ("id", r"^(\d+)_(.)$", [F.col("l_orderkey"), F.col("l_returnflag")])
    return ck.accept_batch(li.where("l_orderkey % 4 = 0"), old, "l_orderkey", "l_linenumber", "ordinal", "declared", "l_returnflag", ["l_linestatus"], contract=li.columns, ids=ids)


@query("required_non_null", "SELECT 'text' AS \"column\", CAST(count(*) FILTER (text IS NULL OR trim(text) = '') AS BIGINT) AS missing FROM documents UNION ALL SELECT 'lang', CAST(count(*) FILTER (lang IS NULL OR trim(lang) = '') AS BIGINT) FROM documents UNION ALL SELECT 'source', CAST(count(*) FILTER (source IS NULL OR trim(source) = '') AS BIGINT) FROM documents")
def required_non_null(spark, d):
    return ck.required_missing(table(spark, d, "documents"), ["text", "lang", "source"])


_PBAD = f"WITH {P}, q AS (SELECT vec_id, CASE WHEN vec_id % 10 = 0 THEN list_transform(p, (x, i) -> CASE WHEN i = 1 THEN x - 0.5 WHEN i = 2 THEN x + 0.5 ELSE x END) WHEN vec_id % 10 = 1 THEN p[1:9] WHEN vec_id % 10 = 2 THEN list_transform(p, x -> x * 0.5) ELSE p END AS p FROM p)"
_PBAD = _PBAD.replace("(x, i) ->", "lambda x, i:").replace("x -> x * 0.5", "lambda x: x * 0.5")


def _damaged(spark, d):
    p = prob(spark, d)
    shifted = F.transform("p", lambda x, i: F.when(i == 0, x - 0.5).when(i == 1, x + 0.5).otherwise(x))
    v = F.when(F.col("vec_id") % 10 == 0, shifted).when(F.col("vec_id") % 10 == 1, F.slice("p", 1, 9)).when(F.col("vec_id") % 10 == 2, F.transform("p", lambda x: x * 0.5)).otherwise(F.col("p"))
    return p.select("vec_id", v.alias("p"))


@query("prob_validity", _PBAD + " SELECT vec_id AS key, fault FROM (SELECT vec_id, CASE WHEN len(p) <> 10 THEN 'length' WHEN len(list_filter(p, lambda x: x < 0 OR x > 1)) > 0 THEN 'outside [0,1]' WHEN abs(list_sum(p) - 1) > 1e-10 THEN 'sum' END AS fault FROM q) WHERE fault IS NOT NULL")
def prob_validity(spark, d):
    return ck.prob_issues(_damaged(spark, d), "vec_id", "p", 10)


@query("prob_valid_keys", _PBAD + " SELECT DISTINCT vec_id AS key FROM q WHERE len(p) = 10 AND len(list_filter(p, lambda x: x < 0)) = 0 AND abs(list_sum(p) - 1) <= 1e-10")
def prob_valid_keys(spark, d):
    return ck.valid_keys(_damaged(spark, d), "vec_id", "p", 10)


@query("job_overlap", "WITH j AS (SELECT o_custkey AS key, o_orderstatus AS job FROM orders), g AS (SELECT key, count(*) AS n, count(DISTINCT job) AS jobs FROM j GROUP BY key), x AS (SELECT *, n > jobs AS within, jobs > 1 AS between, key IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3) AS exists FROM g) SELECT * FROM x WHERE within OR between OR exists")
def job_overlap(spark, d):
    jobs = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("job"))
    old = table(spark, d, "customer").where("c_nationkey = 3").select(F.col("c_custkey").alias("k"))
    return ck.cross_job_overlap(jobs, "k", "job", old)


@query("manifest_reconcile", "WITH m AS (SELECT doc_id, count(*) AS listed, min(h) AS want FROM (SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN 'x' ELSE md5(CAST(doc_id AS VARCHAR)) END AS h FROM labels UNION ALL SELECT doc_id, 'y' FROM labels WHERE doc_id % 25 = 0) GROUP BY doc_id), f AS (SELECT doc_id, min(md5(CAST(doc_id AS VARCHAR))) AS have, max(CASE WHEN doc_id % 8 = 0 THEN 0 ELSE n_chars END) AS bytes, true AS present FROM documents WHERE doc_id % 6 <> 1 GROUP BY doc_id) SELECT coalesce(m.doc_id, f.doc_id) AS key, CASE WHEN listed > 1 THEN 'duplicate' WHEN present IS NULL THEN 'missing' WHEN listed IS NULL THEN 'unlisted' WHEN coalesce(bytes, 0) = 0 THEN 'empty' WHEN want <> have THEN 'hash mismatch' ELSE 'ok' END AS status FROM m FULL JOIN f ON m.doc_id = f.doc_id")
def manifest_reconcile(spark, d):
    digest = F.md5(F.col("doc_id").cast("string").cast("binary"))
    m = table(spark, d, "labels").select("doc_id", F.when(F.col("doc_id") % 9 == 0, "x").otherwise(digest).alias("h"))
    m = m.unionByName(table(spark, d, "labels").where("doc_id % 25 = 0").select("doc_id", F.lit("y").alias("h")))
    f = table(spark, d, "documents").where("doc_id % 6 <> 1").select("doc_id", digest.alias("h"), F.when(F.col("doc_id") % 8 == 0, 0).otherwise(F.col("n_chars")).alias("bytes"))
    return ck.reconcile(m, f, "doc_id", "h")


# ---- projections


@query("training_rows", f"WITH {E} SELECT group_id, lane, race_date, venue, entity, finish, price, CASE WHEN finish = 1 THEN 1 ELSE 0 END AS is_win, CASE WHEN finish = 2 THEN 1 ELSE 0 END AS is_second, CASE WHEN finish <= 3 THEN 1 ELSE 0 END AS is_top3, CASE WHEN returnflag = 'R' THEN 1 ELSE 0 END AS is_returned, CASE WHEN quantity <= 10 THEN 'short' WHEN quantity <= 25 THEN 'mile' WHEN quantity <= 40 THEN 'middle' ELSE 'long' END AS size_bucket FROM e WHERE linestatus <> 'F' OR returnflag <> 'N' ORDER BY race_date, venue, group_id, lane")
def training_rows(spark, d):
    e = entry(spark, d).where("linestatus <> 'F' or returnflag <> 'N'")
    flag = lambda c: F.when(c, 1).otherwise(0)
    out = e.select("group_id", "lane", "race_date", "venue", "entity", "finish", "price", flag(F.col("finish") == 1).alias("is_win"), flag(F.col("finish") == 2).alias("is_second"), flag(F.col("finish") <= 3).alias("is_top3"), flag(F.col("returnflag") == "R").alias("is_returned"), tx.bucket("quantity", [10, 25, 40], ["short", "mile", "middle", "long"]).alias("size_bucket"))
    return out.orderBy(*[F.col(c).asc_nulls_last() for c in ("race_date", "venue", "group_id", "lane")])


@query("bucket", "SELECT p_partkey, CASE WHEN p_size <= 14 THEN 'short' WHEN p_size <= 17 THEN 'mile' WHEN p_size <= 22 THEN 'middle' ELSE 'long' END AS b FROM part")
def bucket(spark, d):
    return table(spark, d, "part").select("p_partkey", tx.bucket("p_size", [14, 17, 22], ["short", "mile", "middle", "long"]).alias("b"))


@query("make_key", "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') || '_' || o_orderstatus || '_' || (o_orderkey % 12 + 1) AS k FROM orders")
def make_key(spark, d):
    return table(spark, d, "orders").select("o_orderkey", tx.make_key("o_orderdate", "o_orderstatus", F.col("o_orderkey") % 12 + 1).alias("k"))


@query("parse_key", "SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date, CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE o_orderstatus END AS place, CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE CAST(o_orderkey % 12 + 1 AS VARCHAR) END AS number FROM orders")
def parse_key(spark, d):
    k = F.when(F.col("o_orderkey") % 10 == 0, "bad_key").otherwise(tx.make_key("o_orderdate", "o_orderstatus", F.col("o_orderkey") % 12 + 1))
    return table(spark, d, "orders").select("o_orderkey", tx.parse_key(k).alias("k")).select("o_orderkey", "k.*")


@query("flatten_nested", "SELECT l_orderkey, l_linenumber, l_quantity, coalesce(l_discount, 0.5) AS discount FROM lineitem")
def flatten_nested(spark, d):
    li = table(spark, d, "lineitem")
    cards = li.groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_quantity", "l_discount")).alias("boats"))
    return cards.select("l_orderkey", F.explode("boats").alias("b")).select("l_orderkey", "b.l_linenumber", "b.l_quantity", F.coalesce("b.l_discount", F.lit(0.5)).alias("discount"))


@query("feature_catalogue", "SELECT feature, role, CAST(missing AS BIGINT) AS missing, missing > 0 AS nullable FROM (SELECT 'doc_id' AS feature, 'identity' AS role, count(*) FILTER (doc_id IS NULL) AS missing FROM documents UNION ALL SELECT 'lang', 'feature', count(*) FILTER (lang IS NULL OR trim(lang) = '') FROM documents UNION ALL SELECT 'source', 'feature', count(*) FILTER (source IS NULL OR trim(source) = '') FROM documents)")
def feature_catalogue(spark, d):
    roles = spark.createDataFrame([("doc_id", "identity"), ("lang", "feature"), ("source", "feature")], "feature string, role string")
    counts = ck.required_missing(table(spark, d, "documents"), ["doc_id", "lang", "source"]).withColumnRenamed("column", "feature")
    return counts.join(F.broadcast(roles), "feature").select("feature", "role", F.col("missing").cast("long").alias("missing"), (F.col("missing") > 0).alias("nullable"))


@query("feature_lineage", "SELECT feature, source, round(missing / total + 1e-9, 6) AS null_rate, CASE WHEN missing = 0 THEN 'complete' ELSE 'partial' END AS verdict FROM (SELECT 'embedding' AS feature, 'vectors' AS source, count(*) FILTER (embedding IS NULL) AS missing, count(*) AS total FROM embeddings UNION ALL SELECT 'label', 'annotation', count(*) FILTER (label IS NULL), count(*) FROM embeddings)")
def feature_lineage(spark, d):
    lineage = spark.createDataFrame([("embedding", "vectors"), ("label", "annotation")], "feature string, source string")
    one = table(spark, d, "embeddings").agg(F.count("*").alias("total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in ("embedding", "label")])
    long = one.unpivot(["total"], ["embedding", "label"], "feature", "missing").join(F.broadcast(lineage), "feature")
    return long.select("feature", "source", r6(F.col("missing") / F.col("total")).alias("null_rate"), F.when(F.col("missing") == 0, "complete").otherwise("partial").alias("verdict"))


# ---- joins and sets


@query("append_new_only", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 2 = 0 AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 3 = 0)")
def append_new_only(spark, d):
    o = table(spark, d, "orders")
    return ap.new_only(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 3 = 0"), "o_custkey").select("o_orderkey", "o_custkey")


@query("already_applied", "SELECT count(DISTINCT o_custkey) AS groups, CAST(count(DISTINCT CASE WHEN o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 3 = 0) THEN o_custkey END) AS BIGINT) AS missing, count(DISTINCT CASE WHEN o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 3 = 0) THEN o_custkey END) = 0 AS applied FROM orders WHERE o_orderkey % 2 = 0")
def already_applied(spark, d):
    o = table(spark, d, "orders")
    return ap.already_applied(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 3 = 0"), "o_custkey")


@query("facts_entries", "SELECT o_orderkey, l_linenumber, o_custkey, l_quantity FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey < 5)")
def facts_entries(spark, d):
    owners = table(spark, d, "customer").where("c_nationkey < 5").select(F.col("c_custkey").alias("o_custkey"))
    facts = src.semi_select(table(spark, d, "orders"), owners, "o_custkey").withColumnRenamed("o_orderkey", "l_orderkey")
    return facts.join(table(spark, d, "lineitem"), "l_orderkey").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "o_custkey", "l_quantity")


@query("candidate_join", "SELECT c_custkey, n_name, o_orderkey, l_linenumber FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey < 3 LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F' LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_returnflag = 'R'")
def candidate_join(spark, d):
    c, n, o, li = (table(spark, d, t) for t in ("customer", "nation", "orders", "lineitem"))
    j = c.join(n.where("n_regionkey < 3"), c.c_nationkey == n.n_nationkey, "left")
    o, li = o.where("o_orderstatus = 'F'"), li.where("l_returnflag = 'R'")
    j = j.join(o, o.o_custkey == c.c_custkey, "left").join(li, li.l_orderkey == o.o_orderkey, "left")
    return j.select("c_custkey", "n_name", "o_orderkey", "l_linenumber")


_SIDE = "SELECT l_orderkey, list_sort(list(DISTINCT (l_linenumber, {v}))) AS m FROM lineitem WHERE {w} GROUP BY l_orderkey"


@query("identity_match", f"WITH a AS ({_SIDE.format(v='l_suppkey', w='l_orderkey % 5 <> 0')}), b AS ({_SIDE.format(v='CASE WHEN l_orderkey % 3 = 0 THEN l_suppkey + 1 ELSE l_suppkey END', w='l_orderkey % 7 <> 0')}) SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, CASE WHEN a.m IS NULL OR b.m IS NULL THEN NULL ELSE a.m = b.m END AS match FROM a FULL JOIN b ON a.l_orderkey = b.l_orderkey")
def identity_match(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    other = li.where("l_orderkey % 7 <> 0").withColumn("l_suppkey", F.when(F.col("l_orderkey") % 3 == 0, F.col("l_suppkey") + 1).otherwise(F.col("l_suppkey")))
    return oc.identity_match(li.where("l_orderkey % 5 <> 0"), other, "l_orderkey", "l_linenumber", "l_suppkey")


@query("keyset_diff", "SELECT o_custkey, CASE WHEN r = 0 THEN 'left' ELSE 'right' END AS side FROM (SELECT o_custkey, max(CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END) AS l, max(CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END) AS r FROM orders GROUP BY 1) WHERE l + r = 1")
def keyset_diff(spark, d):
    o = table(spark, d, "orders")
    return oc.keyset_diff(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 3 = 0"), "o_custkey")


@query("pred_missing_extra", "SELECT vec_id, CASE WHEN vec_id % 3 = 0 THEN 'left' ELSE 'right' END AS side FROM embeddings WHERE (vec_id % 3 = 0) <> (vec_id % 4 = 0)")
def pred_missing_extra(spark, d):
    e = table(spark, d, "embeddings")
    return oc.keyset_diff(e.where("vec_id % 3 = 0"), e.where("vec_id % 4 = 0"), "vec_id")


@query("version_diff", "WITH a AS (SELECT o_orderkey, o_orderstatus = 'F' AS m FROM orders WHERE o_orderkey % 5 <> 0), b AS (SELECT o_orderkey, o_orderstatus <> 'O' AS m FROM orders WHERE o_orderkey % 7 <> 0) SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN b.m IS NULL THEN 'removed' WHEN a.m IS NULL AND b.m THEN 'added_main' WHEN a.m IS NULL THEN 'added_prediction_only' WHEN a.m AND b.m THEN 'unchanged_main' ELSE 'other' END AS change FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey")
def version_diff(spark, d):
    o = table(spark, d, "orders")
    old = o.where("o_orderkey % 5 <> 0").select("o_orderkey", (F.col("o_orderstatus") == "F").alias("main"))
    new = o.where("o_orderkey % 7 <> 0").select("o_orderkey", (F.col("o_orderstatus") != "O").alias("main"))
    return oc.version_diff(old, new, "o_orderkey", "main")


@query("target_reconcile", f"WITH {E}, {T}, a AS (SELECT group_id, class_id FROM c WHERE group_id % 5 <> 0), b AS (SELECT group_id, CASE WHEN group_id % 3 = 0 THEN class_id + 1 ELSE class_id END AS class_id FROM c WHERE group_id % 7 <> 0) SELECT coalesce(a.group_id, b.group_id) AS group_id, a.class_id AS new_value, b.class_id AS old_value, CASE WHEN a.group_id IS NULL OR b.group_id IS NULL THEN 'one_sided' WHEN a.class_id IS DISTINCT FROM b.class_id THEN 'mismatch' ELSE 'match' END AS status, CASE WHEN a.group_id IS NULL THEN 'missing_new' WHEN b.group_id IS NULL THEN 'missing_old' WHEN a.class_id IS DISTINCT FROM b.class_id THEN 'value' ELSE '' END AS reasons FROM a FULL JOIN b ON a.group_id = b.group_id")
def target_reconcile(spark, d):
    c = stored(oc.target_status(entry(spark, d), "group_id", "lane", "finish", least=3).select("group_id", "class_id"), "targets")
    old = c.where("group_id % 7 <> 0").withColumn("class_id", F.when(F.col("group_id") % 3 == 0, F.col("class_id") + 1).otherwise(F.col("class_id")))
    return oc.reconcile_targets(c.where("group_id % 5 <> 0"), old, "group_id", "class_id")


@query("trace_keys", "SELECT o_orderkey, o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AS funded, o_orderkey IN (SELECT l_orderkey FROM lineitem) AS filled, CASE WHEN o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) THEN 'empty' WHEN o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) THEN 'unfunded' ELSE 'complete' END AS final_stage FROM orders WHERE o_totalprice > 450000")
def trace_keys(spark, d):
    keys = table(spark, d, "orders").where("o_totalprice > 450000").select("o_orderkey", "o_custkey")
    good = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), F.lit(True).alias("a"))
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("b", F.lit(True))
    j = keys.join(good, "o_custkey", "left").join(lines, "o_orderkey", "left")
    no = F.lit(False)
    j = j.select("o_orderkey", F.coalesce("a", no).alias("funded"), F.coalesce("b", no).alias("filled"))
    return j.withColumn("final_stage", F.when(~F.col("filled"), "empty").when(~F.col("funded"), "unfunded").otherwise("complete"))


_IV = "SELECT venue, CAST(d AS BIGINT) AS start_day, CAST(CASE WHEN d % 2 = 0 THEN d + 3 END AS BIGINT) AS end_day, venue * 100 + (d - 19723) AS interval_id FROM (SELECT DISTINCT event_id % 5 AS venue FROM events) CROSS JOIN (SELECT unnest([19723, 19727, 19732, 19738, 19745]) AS d)"


@query("interval_join", f"WITH {H}, iv AS ({_IV}), j AS (SELECT h.event_id, iv.interval_id, iv.end_day, h.day, row_number() OVER (PARTITION BY h.event_id ORDER BY iv.start_day DESC) AS rn FROM h LEFT JOIN iv ON h.venue = iv.venue AND iv.start_day < h.day) SELECT event_id, CASE WHEN end_day IS NULL OR end_day >= day THEN interval_id END AS interval_id FROM j WHERE rn = 1")
def interval_join(spark, d):
    h = hist(spark, d)
    starts = h.select("venue").distinct().withColumn("d", F.explode(F.array(*[F.lit(x) for x in (19723, 19727, 19732, 19738, 19745)])))
    iv = starts.select("venue", F.col("d").alias("start_day"), F.when(F.col("d") % 2 == 0, F.col("d") + 3).alias("end_day"), (F.col("venue") * 100 + (F.col("d") - 19723)).alias("interval_id"))
    return asof.interval_join(h.select("event_id", "venue", "day"), iv, ["venue"], "day", "start_day", "end_day").select("event_id", "interval_id")


_IVE = f"SELECT *, CASE start_day % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS grade FROM ({_IV})"


@query("verified_equipment", f"WITH {H}, iv AS ({_IVE}), j AS (SELECT h.event_id, h.day, iv.interval_id, iv.end_day, row_number() OVER (PARTITION BY h.event_id ORDER BY iv.start_day DESC) AS rn FROM h LEFT JOIN (SELECT * FROM iv WHERE grade IN ('A', 'B')) iv ON h.venue = iv.venue AND iv.start_day < h.day), x AS (SELECT event_id, interval_id IS NULL AS none, CASE WHEN end_day IS NULL OR end_day >= day THEN interval_id END AS interval_id FROM j WHERE rn = 1) SELECT event_id, interval_id, interval_id IS NOT NULL AS verified, CASE WHEN interval_id IS NOT NULL THEN 'verified' WHEN none THEN 'no_earlier_interval' ELSE 'interval_ended' END AS reason FROM x")
def verified_equipment(spark, d):
    h = hist(spark, d)
    starts = h.select("venue").distinct().withColumn("d", F.explode(F.array(*[F.lit(x) for x in (19723, 19727, 19732, 19738, 19745)])))
    grade = F.when(F.col("d") % 3 == 0, "A").when(F.col("d") % 3 == 1, "B").otherwise("C")
    iv = starts.select("venue", F.col("d").alias("start_day"), F.when(F.col("d") % 2 == 0, F.col("d") + 3).alias("end_day"), (F.col("venue") * 100 + (F.col("d") - 19723)).alias("interval_id"), grade.alias("grade"))
    return asof.verified_interval(h.select("event_id", "venue", "day"), iv, ["venue"], "day", "start_day", "end_day", "grade", ["A", "B"]).select("event_id", "interval_id", "verified", "reason")


_ROLES = [(f, role, f"{1995 + f}-{m1:02d}-01", f"{1995 + f}-{m2:02d}-28") for f in range(4) for role, m1, m2 in (("train", 1, 4), ("selection", 5, 6), ("calibration", 7, 8), ("evaluation", 9, 12))]
_ROLES_SQL = "(VALUES " + ", ".join(f"({f}, '{r}', DATE '{a}', DATE '{b}')" for f, r, a, b in _ROLES) + ") AS r(fold_id, role, start, stop)"


def roles(spark):
    rows = spark.createDataFrame(_ROLES, "fold_id int, role string, start string, stop string")
    return rows.withColumns({"start": F.to_date("start"), "stop": F.to_date("stop")})


@query("fold_membership", f"SELECT o_orderkey, fold_id, role FROM orders JOIN {_ROLES_SQL} ON CAST(o_orderdate AS DATE) BETWEEN start AND stop")
def fold_membership(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return asof.fold_members(o, roles(spark), "day").select("o_orderkey", "fold_id", "role")


@query("fold_checks", f"WITH m AS (SELECT CAST(o_orderdate AS DATE) AS day, fold_id, role FROM orders JOIN {_ROLES_SQL} ON CAST(o_orderdate AS DATE) BETWEEN start AND stop) SELECT fold_id, CAST(count(*) AS BIGINT) AS members, CAST(count(DISTINCT role) AS BIGINT) AS n_roles, max(CASE WHEN role = 'train' THEN day END) < min(CASE WHEN role = 'selection' THEN day END) AND max(CASE WHEN role = 'selection' THEN day END) < min(CASE WHEN role = 'calibration' THEN day END) AND max(CASE WHEN role = 'calibration' THEN day END) < min(CASE WHEN role = 'evaluation' THEN day END) AS ordered FROM m GROUP BY fold_id")
def fold_checks(spark, d):
    o = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day"))
    m = asof.fold_members(o, roles(spark), "day")
    hi = lambda r: F.max(F.when(F.col("role") == r, F.col("day")))
    lo = lambda r: F.min(F.when(F.col("role") == r, F.col("day")))
    names = ["train", "selection", "calibration", "evaluation"]
    ordered = (hi(names[0]) < lo(names[1])) & (hi(names[1]) < lo(names[2])) & (hi(names[2]) < lo(names[3]))
    return m.groupBy("fold_id").agg(F.count("*").alias("members"), F.countDistinct("role").alias("n_roles"), ordered.alias("ordered"))


@query("rolling_origin", "WITH w AS (SELECT y, make_date(y, 1, 1) AS start, make_date(y, 12, 31) AS stop FROM range(1996, 2002) t(y)), n AS (SELECT y, count(*) FILTER (CAST(o_orderdate AS DATE) < start) AS train, count(*) FILTER (CAST(o_orderdate AS DATE) BETWEEN start AND stop) AS evaluation FROM w CROSS JOIN orders GROUP BY y) SELECT CAST(y AS INTEGER) AS y, CAST(train AS BIGINT) AS train, CAST(evaluation AS BIGINT) AS evaluation FROM n WHERE train >= 5000")
def rolling_origin(spark, d):
    years = spark.range(1996, 2002).select(F.col("id").cast("int").alias("y")).withColumns({"start": F.make_date("y", F.lit(1), F.lit(1)), "stop": F.make_date("y", F.lit(12), F.lit(31))})
    o = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day"))
    j = o.join(F.broadcast(years), F.col("day") <= F.col("stop"))
    return j.groupBy("y").agg(F.count_if(F.col("day") < F.col("start")).alias("train"), F.count_if(F.col("day") >= F.col("start")).alias("evaluation")).where("train >= 5000")


@query("lock_guard", "SELECT CAST(count(*) FILTER (CAST(o_orderdate AS DATE) NOT BETWEEN DATE '2000-01-01' AND DATE '2000-12-31') AS BIGINT) AS passed, CAST(count(*) FILTER (CAST(o_orderdate AS DATE) BETWEEN DATE '2000-01-01' AND DATE '2000-12-31') AS BIGINT) AS locked FROM orders")
def lock_guard(spark, d):
    o = table(spark, d, "orders").select(F.to_date("o_orderdate").between(F.lit("2000-01-01").cast("date"), F.lit("2000-12-31").cast("date")).alias("inside"))
    return o.agg(F.count_if(~F.col("inside")).alias("passed"), F.count_if("inside").alias("locked"))


@query("same_day_prev", f"WITH {H}, x AS (SELECT event_id, lag(event_id) OVER w AS previous, hour(ts) - lag(hour(ts)) OVER w AS gap FROM h WINDOW w AS (PARTITION BY entity, date ORDER BY hour(ts), event_id)) SELECT event_id, previous, CASE WHEN previous IS NULL THEN 'none' WHEN gap = 0 THEN 'same place' WHEN gap = 1 THEN 'direct' ELSE 'earlier' END AS confidence FROM x")
def same_day_prev(spark, d):
    h = hist(spark, d).withColumn("slot", F.hour("ts"))
    return asof.same_day_previous(h, ["entity", "date"], ["slot", "event_id"], "event_id").select("event_id", "previous", "confidence")


@query("sidecar_join", f"WITH {E}, s AS (SELECT group_id, lane, count(*) AS copies, max(price) AS top FROM e GROUP BY 1, 2) SELECT e.group_id, e.lane, copies, top FROM e JOIN s ON e.group_id = s.group_id AND e.lane = s.lane")
def sidecar_join(spark, d):
    e = entry(spark, d).select("group_id", "lane", "price")
    s = e.groupBy("group_id", "lane").agg(F.count("*").alias("copies"), F.max("price").alias("top"))
    return e.drop("price").join(s, ["group_id", "lane"])


@query("class_encode", f"WITH {E}, {T} SELECT group_id, class_id FROM c WHERE class_id IS NOT NULL")
def class_encode(spark, d):
    return oc.target_status(entry(spark, d), "group_id", "lane", "finish", least=3).where("class_id is not null").select("group_id", "class_id")


@query("class_decode", f"WITH {E}, {T} SELECT group_id, f1 AS first, f2 AS second, f3 AS third, f1 || '-' || f2 || '-' || f3 AS label FROM c WHERE class_id IS NOT NULL")
def class_decode(spark, d):
    c = oc.target_status(entry(spark, d), "group_id", "lane", "finish", least=3).where("class_id is not null")
    return om.decode(c.select("group_id", F.col("class_id").cast("int").alias("class_id"))).drop("class_id")
