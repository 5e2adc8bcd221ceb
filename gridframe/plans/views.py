"""Bindings of the operators' roles (group, lane, entity, date, venue, finish) to the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridframe.session import table
from gridframe.sources.shared import dealt

#: The same views as SQL, to be put behind WITH.
E = """e AS (SELECT l_orderkey AS group_id, l_linenumber AS lane, l_suppkey AS entity, l_partkey AS equipment, CAST(o_orderdate AS DATE) AS race_date,
 c_nationkey AS venue, c_mktsegment AS segment, o_orderpriority AS priority, o_orderstatus AS status, o_totalprice AS total, l_quantity AS quantity,
 l_extendedprice AS price, l_discount AS discount, l_tax AS tax, l_returnflag AS returnflag, l_linestatus AS linestatus, CAST(l_shipdate AS DATE) AS shipdate,
 CAST(rank() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC) AS INTEGER) AS finish
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""
H = """h AS (SELECT event_id, user_id AS entity, ts, CAST(ts AS DATE) AS date, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS day, value,
 CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS hit, event_type, event_id % 5 AS venue FROM events)"""
P = """p AS (SELECT vec_id, label, list_transform(ex, lambda x: x / list_sum(ex)) AS p FROM
 (SELECT vec_id, label, list_transform(embedding[1:10], lambda x: exp(CAST(x AS DOUBLE))) AS ex FROM embeddings))"""
T = """g AS (SELECT group_id, any_value(race_date) AS race_date, any_value(venue) AS venue, any_value(status) AS status, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT lane) AS BIGINT) AS n_lanes,
 CAST(count(DISTINCT finish) AS BIGINT) AS n_finishes, max(lane) AS max_lane,
 max(CASE WHEN finish = 1 THEN lane END) AS f1, max(CASE WHEN finish = 2 THEN lane END) AS f2, max(CASE WHEN finish = 3 THEN lane END) AS f3 FROM e GROUP BY group_id),
t AS (SELECT *, CASE WHEN n < 3 OR n <> n_lanes OR max_lane > 6 THEN 'void' WHEN n_finishes < n THEN 'tied' ELSE 'unique_order' END AS target_status FROM g),
c AS (SELECT *, CASE WHEN target_status = 'unique_order' THEN (f1 - 1) * 20 + (f2 - 1 - CASE WHEN f2 > f1 THEN 1 ELSE 0 END) * 4
 + (f3 - 1 - CASE WHEN f3 > f1 THEN 1 ELSE 0 END - CASE WHEN f3 > f2 THEN 1 ELSE 0 END) END AS class_id FROM t)"""


def entry(spark: SparkSession, d: str, venue: bool = True) -> DataFrame:
    """One row per line of an order: group, lane, entity, date, venue, finish by quantity.

    Lines are dealt by their order in tasks of bounded size, and customers join the orders before the lines do, so lines are
    shuffled once. Without `venue` the customers are not joined, and venue and segment are null: for queries that need neither.
    """
    li, o = dealt(table(spark, d, "lineitem"), "l_orderkey"), table(spark, d, "orders")
    if venue:
        o = o.join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    else:
        o = o.withColumns({"c_nationkey": F.lit(None).cast("long"), "c_mktsegment": F.lit(None).cast("string")})
    rows = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.select(
        F.col("l_orderkey").alias("group_id"),
        F.col("l_linenumber").alias("lane"),
        F.col("l_suppkey").alias("entity"),
        F.col("l_partkey").alias("equipment"),
        F.to_date("o_orderdate").alias("race_date"),
        F.col("c_nationkey").alias("venue"),
        F.col("c_mktsegment").alias("segment"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        F.col("l_returnflag").alias("returnflag"),
        F.col("l_linestatus").alias("linestatus"),
        F.to_date("l_shipdate").alias("shipdate"),
    )
    # Ranked under its new name, as a partitioning by a name that is dropped above the window would be lost.
    return rows.withColumn("finish", F.rank().over(Window.partitionBy("group_id").orderBy(F.desc("quantity"))))


def hist(spark: SparkSession, d: str) -> DataFrame:
    """Event history: entity, ts, date, day, value, hit, venue."""
    ev = table(spark, d, "events")
    return ev.select(
        "event_id",
        F.col("user_id").alias("entity"),
        "ts",
        F.to_date("ts").alias("date"),
        F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")).alias("day"),
        "value",
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("hit"),
        "event_type",
        (F.col("event_id") % 5).alias("venue"),
    )


def prob(spark: SparkSession, d: str) -> DataFrame:
    """Softmax of the first ten components, and the label."""
    e = table(spark, d, "embeddings").withColumn("ex", F.transform(F.slice("embedding", 1, 10), lambda x: F.exp(x.cast("double"))))
    total = F.aggregate("ex", F.lit(0.0), lambda a, x: a + x)
    return e.select("vec_id", "label", F.transform("ex", lambda x: x / total).alias("p"))
