"""Chat formatting by multi-party perspective rotation (operator 10).

For every participant of a conversation (every role but ``system``) the whole dialogue is rendered with that speaker as
assistant and all others as named users. The rendering is given turn by turn: its text, the place of the turn's first
and last character in the whole rendering, and the span that a loss mask leaves open, which is what the assistant says
with its end mark. Joining ``rendered`` in the order of ``seq`` gives the training text.

Only DataFrame operations are used. Places are sums over all turns before; they are taken in two levels, within chunks
of ``CHUNK`` turns and then over the chunks' totals, so that a very long conversation is no single task's.

Defined cases: rows without conv_id belong to no dialogue and are left out; a null text is empty; a null role is the
speaker ``unknown``; turns without number come last; turns of one number are ordered by role, then text, and repeated
rows are all kept; a conversation of system turns alone has no perspective; control marks inside a text are parted
(``<|`` becomes ``< |``), so that no text can end its turn; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read

CHUNK = 256
SYSTEM, UNKNOWN, END = "system", "unknown", "<|end|>\n"


def rotate(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """conv_id, perspective, seq, turn, role, rendered, char_start, char_end, open_start, open_end (null where masked)."""
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(UNKNOWN)).alias("role"),
        F.replace(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit("<|"), F.lit("< |")).alias("text"),
    )
    # Distinct roles first, so that what is gathered of a conversation are its speakers, not its turns.
    speakers = turns.filter(F.col("role") != SYSTEM).select("conv_id", F.col("role").alias("perspective")).distinct()
    rows = turns.join(speakers, "conv_id").withColumn("part", F.coalesce(F.floor(F.col("turn") / chunk), F.lit((1 << 62))))
    own = F.col("role") == F.col("perspective")
    name = F.replace(F.replace(F.col("role"), F.lit("<|"), F.lit("< |")), F.lit("|>"), F.lit("| >"))
    head = F.when(F.col("role") == SYSTEM, "<|system|>\n").when(own, "<|assistant|>\n").otherwise(F.concat(F.lit("<|user name="), name, F.lit("|>\n")))
    rows = rows.withColumn("head", head).withColumn("rendered", F.concat("head", "text", F.lit(END))).withColumn("size", F.length("rendered").cast("long"))
    within = Window.partitionBy("conv_id", "perspective", "part").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    rows = rows.withColumn("nth", F.row_number().over(within)).withColumn("upto", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    before = Window.partitionBy("conv_id", "perspective").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        turns.join(speakers, "conv_id").withColumn("part", F.coalesce(F.floor(F.col("turn") / chunk), F.lit((1 << 62))))
        .withColumn("size", F.length(head) + F.length("text") + len(END))
        .groupBy("conv_id", "perspective", "part").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
        .select("conv_id", "perspective", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("chars_before"))
    )
    start = F.col("chars_before") + F.col("upto") - F.col("size")
    return rows.join(parts, ["conv_id", "perspective", "part"]).select(
        "conv_id", "perspective", (F.col("rows_before") + F.col("nth") - 1).cast("long").alias("seq"), "turn", "role", "rendered",
        start.alias("char_start"), (start + F.col("size")).alias("char_end"),
        F.when(own, start + F.length("head")).alias("open_start"), F.when(own, start + F.col("size") - 1).alias("open_end"),
    )


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(read(spark, sf_dir, "conversations"))


SQL = """
WITH turns AS (
  SELECT conv_id, turn, COALESCE(role, 'unknown') AS role, REPLACE(COALESCE(text, ''), '<|', '< |') AS text FROM conversations WHERE conv_id IS NOT NULL),
speakers AS (SELECT DISTINCT conv_id, role AS perspective FROM turns WHERE role <> 'system'),
heads AS (
  SELECT t.*, perspective, CASE WHEN role = 'system' THEN '<|system|>' || chr(10) WHEN role = perspective THEN '<|assistant|>' || chr(10)
    ELSE '<|user name=' || REPLACE(REPLACE(role, '<|', '< |'), '|>', '| >') || '|>' || chr(10) END AS head
  FROM turns t JOIN speakers USING (conv_id)),
said AS (SELECT *, head || text || '<|end|>' || chr(10) AS rendered FROM heads),
placed AS (
  SELECT *, ROW_NUMBER() OVER w - 1 AS seq, CAST(SUM(LENGTH(rendered)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS char_end
  FROM said WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn ASC NULLS LAST, role, text))
SELECT conv_id, perspective, CAST(seq AS BIGINT) AS seq, turn, role, rendered, char_end - LENGTH(rendered) AS char_start, char_end,
  CASE WHEN role = perspective THEN char_end - LENGTH(rendered) + LENGTH(head) END AS open_start,
  CASE WHEN role = perspective THEN char_end - 1 END AS open_end
FROM placed
"""
