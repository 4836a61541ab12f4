"""Chat formatting by collapsing cumulative snapshots, with DataFrame operations only.

A logged conversation is often a snapshot of one that went on. Every turn is hashed with its position, and the exclusive
or of the hashes up to a turn is the rolling hash of that prefix (two lanes of 64 bits). A conversation whose full hash
is that of a proper prefix of another one goes, by an anti-join; of equal conversations the smallest id stays. Only then
are the turns of those that stay read and rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from urbanframe.llm.common import table, written

#: Markers of a rendered turn: start, between role and text, end. They are broken up where they stand in a text.
START, END = "<|im_start|>", "<|im_end|>"


def _turn_hashes() -> dict[str, Column]:
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    return {"x": F.xxhash64(F.lit(1), role, text), "y": F.xxhash64(F.lit(2), text, role), "tie": F.md5(F.concat(role, F.lit("\x01"), text))}


def turn_prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, k, a, b, last): the two lanes of the rolling hash up to each turn, k the number of turns so far."""
    rows = turns.select("conv_id", "turn", *(h.alias(n) for n, h in _turn_hashes().items()))
    order = Window.partitionBy("conv_id").orderBy("turn", "tie")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.select("conv_id", F.row_number().over(order).alias("k"), "x", "y", "turn", "tie", F.lead(F.lit(1)).over(order).isNull().alias("last"))
    placed = placed.withColumns({"p": F.xxhash64(F.lit(3), "k", "x"), "q": F.xxhash64(F.lit(4), "k", "y")})
    return placed.select("conv_id", "k", F.bit_xor("p").over(upto).alias("a"), F.bit_xor("q").over(upto).alias("b"), "last")


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies) of the conversations that prefix no longer one; of equal ones the smallest id."""
    prefixes = written(turn_prefixes(turns), "turn-prefixes")
    whole = prefixes.filter("last").groupBy("k", "a", "b").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    proper = prefixes.filter("NOT last").select("k", "a", "b").distinct()
    return whole.join(proper, ["k", "a", "b"], "left_anti").select("conv_id", F.col("k").cast("long").alias("n_turns"), "n_copies")


def render_conversations(turns: DataFrame) -> DataFrame:
    """One row for each maximal conversation of turns (conv_id, turn, role, text): conv_id, n_turns, n_copies, rendered.

    Turns are taken in the order of turn (null first; ties in the order of the MD5 of role, U+0001 and text, repeated rows stay repeated). Null role and
    text count as empty, and a turn with an empty text is still a turn. Rows with a null conv_id form one conversation.
    Other columns are left out. A conversation is one output record, so its length bounds what a task holds at once.
    """
    kept = maximal_conversations(turns)
    safe = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), r"<\|(im_start|im_end)\|>", "< |$1|>")
    role = F.regexp_replace(F.coalesce(F.col("role"), F.lit("")), r"[\r\n]|<\|(im_start|im_end)\|>", " ")
    said = turns.select("conv_id", "turn", _turn_hashes()["tie"].alias("tie"), F.concat(F.lit(START), role, F.lit("\n"), safe, F.lit(END + "\n")).alias("piece"))
    kept = kept.withColumnRenamed("conv_id", "__kept")
    joined = said.join(kept, F.col("conv_id").eqNullSafe(F.col("__kept")))
    grouped = joined.groupBy("conv_id").agg(F.first("n_turns").alias("n_turns"), F.first("n_copies").alias("n_copies"), F.sort_array(F.collect_list(F.struct("turn", "tie", "piece"))).alias("pieces"))
    return grouped.select("conv_id", "n_turns", "n_copies", F.array_join(F.col("pieces.piece"), "").alias("rendered"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render_conversations(table(spark, sf_dir, "conversations"))


ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, md5(coalesce(role, '') || chr(1) || coalesce(text, '')) AS tie FROM conversations),
p AS (
  SELECT conv_id, row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS n,
         string_agg(role || chr(1) || text, chr(2)) OVER (PARTITION BY conv_id ORDER BY turn, tie ROWS UNBOUNDED PRECEDING) AS said
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, tie)),
whole AS (SELECT said, min(conv_id) AS conv_id, k AS n_turns, count(*) AS n_copies FROM p WHERE k = n GROUP BY said, k),
kept AS (SELECT * FROM whole WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.k < p.n AND p.k = n_turns AND p.said = whole.said))
SELECT kept.conv_id, n_turns, n_copies, string_agg(
         '<|im_start|>' || regexp_replace(role, '[\r\n]|<\|(im_start|im_end)\|>', ' ', 'g') || chr(10) ||
         regexp_replace(text, '<\|(im_start|im_end)\|>', '< |\1|>', 'g') || '<|im_end|>' || chr(10), '' ORDER BY turn, tie) AS rendered
FROM kept JOIN t ON t.conv_id = kept.conv_id GROUP BY ALL
"""
