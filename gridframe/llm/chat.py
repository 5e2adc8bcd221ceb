"""Chat formatting by multi-party perspective rotation, in DataFrame operations only.

Every participant of a dialogue (each role but `system`) gets a rendering in which that speaker is the assistant and all
others are named users; only the assistant's words are trained on. A row is one turn of one rendering, with its text
segment and the span of the segment that the loss mask leaves open, so a dialogue of any length is never gathered.

Null text counts as empty, turns without a conversation are one conversation of their own, a null role is the participant `unknown`, turns of one number keep their rows (repeated rows
stay repeated), an empty table gives an empty result, other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridframe.llm.common import join_groups

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def rotate_perspectives(turns: DataFrame, total: int | None = None) -> DataFrame:
    """conv_id, turn, role, text -> conv_id, perspective, turn, role, name, segment, train_from, train_to, trained."""
    speaker = F.coalesce(F.lower(F.trim("role")), F.lit("unknown"))
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit("none"))
    rows = turns.select("conv_id", key.alias("_key"), "turn", speaker.alias("speaker"), F.coalesce("text", F.lit("")).alias("text"))
    cast = rows.where("speaker <> 'system'").groupBy("_key").agg(F.collect_set("speaker").alias("people"))
    sizes = rows.groupBy("_key").agg(F.count("*").alias("n")).join(cast, "_key")
    n = turns.count() if total is None else total
    told = join_groups(rows, sizes, "_key", "n", n)
    seen = told.withColumn("perspective", F.explode(F.sort_array("people")))
    own, system = F.col("speaker") == F.col("perspective"), F.col("speaker") == "system"
    role = F.when(system, "system").when(own, "assistant").otherwise("user")
    name = F.when(system | own, F.lit(None)).otherwise(F.col("speaker"))
    head = F.concat(F.lit(OPEN), role, F.when(name.isNull(), "").otherwise(F.concat(F.lit(" name="), name)), F.lit("\n"))
    out = seen.select("conv_id", "perspective", "turn", role.alias("role"), name.alias("name"), head.alias("head"), "text", own.alias("trained"))
    return out.select(
        "conv_id",
        "perspective",
        "turn",
        "role",
        "name",
        F.concat("head", "text", F.lit(CLOSE)).alias("segment"),
        F.when(F.col("trained"), F.length("head")).otherwise(0).cast("long").alias("train_from"),
        F.when(F.col("trained"), F.length("head") + F.length("text") + len(CLOSE) - 1).otherwise(0).cast("long").alias("train_to"),
        "trained",
    )


def op4_perspective_chat(spark, sf_dir: str) -> DataFrame:
    return rotate_perspectives(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


OP4_SQL = f"""
WITH t AS (SELECT conv_id, turn, coalesce(lower(trim(role)), 'unknown') AS speaker, coalesce(text, '') AS text FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
j AS (SELECT t.*, perspective, speaker = perspective AS trained,
  CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS role,
  CASE WHEN speaker = 'system' OR speaker = perspective THEN NULL ELSE speaker END AS name
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
h AS (SELECT *, '{OPEN}' || role || CASE WHEN name IS NULL THEN '' ELSE ' name=' || name END || chr(10) AS head FROM j)
SELECT conv_id, perspective, turn, role, name, head || text || '<|im_end|>' || chr(10) AS segment,
  CAST(CASE WHEN trained THEN length(head) ELSE 0 END AS BIGINT) AS train_from,
  CAST(CASE WHEN trained THEN length(head) + length(text) + {len(CLOSE) - 1} ELSE 0 END AS BIGINT) AS train_to, trained
FROM h"""
