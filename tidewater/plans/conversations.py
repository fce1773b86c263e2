"""Conversations: turn order checks and role profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.asof import DEFAULT_BLOCK_ROWS, halo_window
from tidewater.plans.catalog import job
from tidewater.sources.tables import Tables

ROLES = ["system", "user", "assistant"]


def conversation_check_df(conv: DataFrame, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    # the text stays behind: only whether it is blank goes through the sort
    blank = F.length(F.regexp_replace("text", r"\s", "")) == 0
    c = conv.select("conv_id", "turn", "role", blank.alias("blank"))

    def exprs(w):
        return {"prev_turn": F.lag("turn", 1).over(w), "prev_role": F.lag("role", 1).over(w)}

    turns = halo_window(c, "conv_id", ["turn"], exprs, before=1, after=0, block_rows=block_rows)
    first = F.col("prev_turn").isNull()
    flags = turns.select(
        "conv_id",
        F.when(first, F.col("turn") != 0).otherwise(F.col("turn") != F.col("prev_turn") + 1).alias("turn_gap"),
        (F.col("role") == F.col("prev_role")).alias("role_repeat"),
        "blank",
        (~F.col("role").isin(*ROLES)).alias("bad_role"),
        ((F.col("role") == "system") & ~first).alias("late_system"),
    )

    def n(c):
        return F.sum(F.when(F.col(c), 1).otherwise(0)).cast("bigint").alias(f"n_{c}")

    out = flags.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"), n("turn_gap"), n("role_repeat"), n("blank"), n("bad_role"), n("late_system")
    )
    bad = F.col("n_turn_gap") + F.col("n_role_repeat") + F.col("n_blank") + F.col("n_bad_role") + F.col("n_late_system")
    return out.withColumn("valid", bad == 0)


@job(
    "conversation_check",
    f"""
    SELECT conv_id, COUNT(*) AS n_turns,
           CAST(SUM(CASE WHEN turn_gap THEN 1 ELSE 0 END) AS BIGINT) AS n_turn_gap,
           CAST(SUM(CASE WHEN role_repeat THEN 1 ELSE 0 END) AS BIGINT) AS n_role_repeat,
           CAST(SUM(CASE WHEN blank THEN 1 ELSE 0 END) AS BIGINT) AS n_blank,
           CAST(SUM(CASE WHEN bad_role THEN 1 ELSE 0 END) AS BIGINT) AS n_bad_role,
           CAST(SUM(CASE WHEN late_system THEN 1 ELSE 0 END) AS BIGINT) AS n_late_system,
           SUM(CASE WHEN turn_gap OR role_repeat OR blank OR bad_role OR late_system THEN 1 ELSE 0 END) = 0 AS valid
    FROM (
      SELECT conv_id,
             CASE WHEN prev_turn IS NULL THEN turn <> 0 ELSE turn <> prev_turn + 1 END AS turn_gap,
             COALESCE(role = prev_role, false) AS role_repeat,
             length(regexp_replace(text, '\\s', '', 'g')) = 0 AS blank,
             role NOT IN ({', '.join(repr(r) for r in ROLES)}) AS bad_role,
             role = 'system' AND prev_turn IS NOT NULL AS late_system
      FROM (SELECT *, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS prev_turn,
                      lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev_role FROM conversations)
    ) GROUP BY conv_id
    """,
    group="conversations",
)
def conversation_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per conversation: turn numbering gaps, the same role twice in a row,
    blank turns, unknown roles and system turns after the start."""
    return conversation_check_df(Tables(spark, sf_dir).conversations)


@job(
    "conversation_roles",
    """
    SELECT conv_id, COUNT(*) AS n_turns,
           COUNT(*) FILTER (WHERE role = 'user') AS n_user,
           COUNT(*) FILTER (WHERE role = 'assistant') AS n_assistant,
           COUNT(*) FILTER (WHERE role = 'system') AS n_system,
           arg_min(role, turn) AS first_role, arg_max(role, turn) AS last_role,
           CAST(SUM(length(text)) AS BIGINT) AS n_chars
    FROM conversations GROUP BY conv_id
    """,
    group="conversations",
)
def conversation_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Role profile per conversation from partial aggregates (min_by/max_by
    for the first and last role) -- no per-conversation list is collected."""
    c = Tables(spark, sf_dir).conversations

    def cnt(r):
        return F.count(F.when(F.col("role") == r, 1)).alias(f"n_{r}")

    return c.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"),
        cnt("user"),
        cnt("assistant"),
        cnt("system"),
        F.min_by("role", "turn").alias("first_role"),
        F.max_by("role", "turn").alias("last_role"),
        F.sum(F.length("text")).cast("bigint").alias("n_chars"),
    )
