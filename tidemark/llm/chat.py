"""Chat formatting with collapse of cumulative snapshots.

Logs often hold a conversation again and again as it grows. Each turn hashes its place,
role and text; the running sums of these hashes (four lanes modulo 2**32) name every
turn-prefix of a conversation. A conversation whose whole name is a proper prefix name
of another, longer one is a snapshot and goes; of equal ones the smallest conv_id stays.
The rest is rendered with a chat template.

Defined cases: rows that repeat (conv_id, turn, role, text) count once; turns of one
number are ordered by role, then text; a null turn comes first, a null role is
``unknown``, a null text is empty; rows with a null conv_id are one conversation, which
sorts before all others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LANES = 4


def turn_prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, pos, role, text, n_turns and the prefix name p0..p3 up to this turn."""
    t = turns.select("conv_id", "turn", F.coalesce(F.col("role"), F.lit("unknown")).alias("role"),
                     F.coalesce(F.col("text"), F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    same = (F.lag("turn").over(order).eqNullSafe(F.col("turn")) & (F.lag("role").over(order) == F.col("role"))
            & (F.lag("text").over(order) == F.col("text")))
    t = t.withColumn("again", F.coalesce(same, F.lit(False)) & (F.row_number().over(order) > 1))
    t = t.withColumn("pos", F.sum(F.when(F.col("again"), 0).otherwise(1)).over(
        order.rowsBetween(Window.unboundedPreceding, 0))).where(~F.col("again"))
    by_pos = Window.partitionBy("conv_id").orderBy("pos")
    run = by_pos.rowsBetween(Window.unboundedPreceding, 0)
    for i in range(LANES):
        lane = F.pmod(F.xxhash64(F.lit(i), F.col("pos"), F.col("role"), F.col("text")), F.lit(1 << 32))
        t = t.withColumn(f"p{i}", F.pmod(F.sum(lane).over(run), F.lit(1 << 32)))
    return t.withColumn("n_turns", F.count(F.lit(1)).over(Window.partitionBy("conv_id")))


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns and copies (equal conversations) of those that no longer one begins with."""
    p = turn_prefixes(turns)
    names = [f"p{i}" for i in range(LANES)]
    whole = p.where("pos = n_turns").groupBy("n_turns", *names).agg(
        F.min(F.struct(F.col("conv_id").isNotNull().alias("some"), "conv_id")).alias("c"),
        F.count(F.lit(1)).alias("copies"))
    # a hot first turn collapses map-side here, before it meets the join
    inner = p.where("pos < n_turns").select(F.col("pos").alias("n_turns"), *names).distinct()
    return whole.join(inner, ["n_turns", *names], "left_anti").select(
        F.col("c.conv_id").alias("conv_id"), "n_turns", "copies")


def render(turns: DataFrame, keep: DataFrame, begin: str = "<|im_start|>", end: str = "<|im_end|>") -> DataFrame:
    """conv_id, n_turns, copies, rendered text of the conversations in ``keep``."""
    p = turn_prefixes(turns).select("conv_id", "pos", "role", "text")
    k = keep.select(F.col("conv_id").alias("k_id"), "n_turns", "copies")
    rows = p.join(k, F.col("conv_id").eqNullSafe(F.col("k_id"))).groupBy("conv_id", "n_turns", "copies").agg(
        F.array_sort(F.collect_list(F.struct("pos", "role", "text"))).alias("xs"))
    return rows.select("conv_id", "n_turns", "copies", F.concat_ws("", F.transform(
        "xs", lambda x: F.concat(F.lit(begin), x["role"], F.lit("\n"), x["text"], F.lit(end + "\n")))).alias("rendered"))


def format_chats(turns: DataFrame) -> DataFrame:
    """Maximal conversations, rendered: conv_id, n_turns, copies, rendered."""
    return render(turns, maximal_conversations(turns))
