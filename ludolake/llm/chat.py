"""Operator 7: chat formatting from every participant's point of view.

For each participant of a conversation the dialogue is rendered once: the participant's turns as the
assistant, all others as named users, and system turns as they are. A rendered dialogue is kept as one row
per turn, in order, so a conversation of any length stays spread over many rows; ``begin`` and ``end`` are
the turn's character positions in the whole rendering, and ``trained`` masks the assistant's turns.

Positions come from two running sums, one inside blocks of ``BLOCK`` turn numbers and one over the
blocks' totals, so no task gets a whole conversation. The participants of a conversation are its
distinct roles other than ``system``; a turn is copied once for each.

Defined results: a null role is the participant ``unknown``; role names are trimmed and lower-cased. A
null text is an empty turn. Null turn numbers come first. Rows with equal turn numbers follow by role and
text, and repeated rows all stay. A null conversation id is one conversation. A conversation with system
turns only is rendered once, without an assistant.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 128
OPEN, CLOSE = "<|", "|>"
END = "<|end|>\n"


def rotate_perspectives(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                        text: str = "text", system: str = "system") -> DataFrame:
    """Rows (conv_id, perspective, turn, position, chat_role, name, segment, begin, end, trained)."""
    name = F.lower(F.trim(F.col(f"`{role}`").cast("string")))
    name = F.when(name.isNull() | (name == ""), "unknown").otherwise(name)
    rows = conversations.select(
        F.col(f"`{conv}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"),
        name.alias("name"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    people = rows.groupBy("conv_id", "name").agg(F.lit(1).alias("one")).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("name") != system, F.col("name")))).alias("people"))
    people = people.withColumn("people", F.when(F.size("people") > 0, F.col("people")).otherwise(F.array(F.lit(""))))
    return _positions(rows, people, system)


def _positions(rows: DataFrame, people: DataFrame, system: str) -> DataFrame:
    both = rows.withColumnRenamed("conv_id", "__conv").join(people, F.col("__conv").eqNullSafe(F.col("conv_id"))).drop("__conv")
    both = both.select("conv_id", "turn", "name", "text", F.explode("people").alias("perspective"))
    chat_role = (F.when(F.col("name") == system, "system").when(F.col("name") == F.col("perspective"), "assistant")
                 .otherwise("user"))
    both = both.withColumn("chat_role", chat_role)
    head = F.when(F.col("chat_role") == "user", F.concat(F.lit("user name="), F.col("name"))).otherwise(F.col("chat_role"))
    both = both.withColumn("segment", F.concat(F.lit(OPEN), head, F.lit(CLOSE + "\n"), F.col("text"), F.lit(END)))
    both = (both.withColumn("size", F.char_length("segment").cast("long"))
            .withColumn("block", F.floor(F.coalesce(F.col("turn"), F.lit(-(1 << 40))) / BLOCK)))
    key = ["conv_id", "perspective"]
    inner = Window.partitionBy(*key, "block").orderBy(F.col("turn").asc_nulls_first(), "name", "text")
    totals = both.groupBy(*key, "block").agg(F.sum("size").alias("total"), F.count(F.lit(1)).alias("many"))
    outer = Window.partitionBy(*key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(F.col("conv_id").alias("__c"), F.col("perspective").alias("__p"), F.col("block").alias("__b"),
                           F.coalesce(F.sum("total").over(outer), F.lit(0)).alias("chars_before"),
                           F.coalesce(F.sum("many").over(outer), F.lit(0)).alias("turns_before"))
    so_far = inner.rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("run", F.sum("size").over(so_far)).withColumn("nth", F.count(F.lit(1)).over(so_far))
    both = both.join(before, F.col("conv_id").eqNullSafe(F.col("__c")) & (F.col("perspective") == F.col("__p"))
                     & (F.col("block") == F.col("__b")))
    end = F.col("chars_before") + F.col("run")
    return both.select(
        "conv_id", "perspective", "turn", (F.col("turns_before") + F.col("nth") - 1).alias("position"), "chat_role",
        F.when(F.col("chat_role") == "user", F.col("name")).alias("name"), "segment",
        (end - F.col("size")).alias("begin"), end.alias("end"), (F.col("chat_role") == "assistant").alias("trained"))


ORACLE = """
WITH r AS (SELECT conv_id, turn, CASE WHEN trim(lower(coalesce(role, ''))) = '' THEN 'unknown' ELSE lower(trim(role)) END AS name,
                  coalesce(text, '') AS text FROM conversations),
people AS (SELECT conv_id, name AS perspective FROM (SELECT DISTINCT conv_id, name FROM r) WHERE name <> 'system'
           UNION ALL SELECT conv_id, '' FROM r GROUP BY conv_id HAVING count(*) FILTER (WHERE name <> 'system') = 0),
b AS (SELECT r.conv_id, p.perspective, r.turn, r.name, r.text,
             CASE WHEN r.name = 'system' THEN 'system' WHEN r.name = p.perspective THEN 'assistant' ELSE 'user' END AS chat_role
      FROM r JOIN people p ON r.conv_id IS NOT DISTINCT FROM p.conv_id),
s AS (SELECT *, '<|' || CASE WHEN chat_role = 'user' THEN 'user name=' || name ELSE chat_role END || '|>' || chr(10) || text
             || '<|end|>' || chr(10) AS segment FROM b),
n AS (SELECT *, sum(length(segment)) OVER w AS run, row_number() OVER w AS nth FROM s
      WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, name, text
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT conv_id, perspective, turn, CAST(nth - 1 AS BIGINT) AS position, chat_role,
       CASE WHEN chat_role = 'user' THEN name END AS name, segment, CAST(run - length(segment) AS BIGINT) AS begin,
       CAST(run AS BIGINT) AS "end", chat_role = 'assistant' AS trained
FROM n
"""
