"""Chat logs: collapse of cumulative snapshots, then rendering.

A log that was written after every turn holds a conversation many times, each time a little longer. Every turn gets the
hash of all turns up to it (a rolling prefix hash: exclusive or of 128-bit hashes of position, role and text). A
conversation is redundant if its last prefix hash is an inner prefix hash of another one; of equal
conversations the one with the smallest id stays. What is left is rendered.

Turns are put in order by range partitioning on (conversation, turn, role, beginning of the text), and windows run inside one block
of one conversation only; counts and hashes of earlier blocks are carried on, one row per block. So a conversation that holds
a third of all rows is many blocks. Rendering gives one row per part of at most `PART` turns. DataFrame
functions only.

Odd cases: turns are ordered by turn number, nulls first, then role, then text; repeated rows are turns of their
own; rows without conversation id are one conversation; a null role is `unknown`, a null text is empty in what is rendered but
differs from an empty text in comparisons. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stored

#: turns rendered into one row
PART = 1000
#: characters of a text that decide on its block
HEAD = 64
#: what stands before the role, between role and text, and after a turn
TEMPLATE = ("<|im_start|>", "\n", "<|im_end|>\n")

_ORDER = ("turn", "role", "text")


def _before(column: str, merge, zero: Column, by: str = "block") -> Column:
    """`column` of all earlier blocks of the conversation together."""
    earlier = W.partitionBy("conv").orderBy(by).rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(merge(column).over(earlier), zero)


def positions(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, position, block, role, text): turns numbered from 1 inside their conversation."""
    rows = turns.select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"),
        F.col(text_col).cast("string").alias("text"),
    )
    # the bounds of the ranges are sampled on the driver, so they take the beginning of a text only, which sorts like the text
    ranged = rows.repartitionByRange("conv", "turn", "role", F.substring("text", 1, HEAD))
    blocks = stored(ranged.withColumn("block", F.spark_partition_id()), "turns")
    inside = W.partitionBy("conv", "block").orderBy(*_ORDER)
    sizes = blocks.groupBy("conv", "block").count()
    offsets = sizes.select(F.col("conv").alias("c"), F.col("block").alias("b"), _sum_before().alias("offset"))
    numbered = blocks.withColumn("rank", F.row_number().over(inside))
    joined = numbered.join(offsets, F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")))
    return joined.select("conv", (F.col("rank") + F.col("offset")).alias("position"), "block", "role", "text")


def _sum_before() -> Column:
    earlier = W.partitionBy("conv").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum("count").over(earlier), F.lit(0))


def prefixes(placed: DataFrame) -> DataFrame:
    """(conv, position, p1, p2): the hash of all turns up to each turn."""
    own = [F.xxhash64(F.lit(seed), "position", F.col("role").isNull(), "role", F.col("text").isNull(), "text") for seed in (1, 2)]
    turns = placed.select("conv", "position", "block", own[0].alias("h1"), own[1].alias("h2"))
    inside = W.partitionBy("conv", "block").orderBy("position").rowsBetween(W.unboundedPreceding, 0)
    local = turns.withColumns({"p1": F.bit_xor("h1").over(inside), "p2": F.bit_xor("h2").over(inside)})
    totals = turns.groupBy("conv", "block").agg(F.bit_xor("h1").alias("t1"), F.bit_xor("h2").alias("t2"))
    totals = totals.select(
        F.col("conv").alias("c"), F.col("block").alias("b"),
        _before("t1", F.bit_xor, F.lit(0)).alias("o1"), _before("t2", F.bit_xor, F.lit(0)).alias("o2"),
    )
    joined = local.join(totals, F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")))
    return joined.select("conv", "position", F.col("p1").bitwiseXOR(F.col("o1")).alias("p1"), F.col("p2").bitwiseXOR(F.col("o2")).alias("p2"))


def maximal(hashed: DataFrame) -> DataFrame:
    """(conv, n_turns): conversations that are no prefix of another one, one of each set of equal ones."""
    last = hashed.groupBy("conv").agg(F.max(F.struct("position", "p1", "p2")).alias("end")).select("conv", "end.*")
    ends = last.select(F.col("conv").alias("c"), F.col("position").alias("at"))
    inner = hashed.join(ends, F.col("conv").eqNullSafe(F.col("c")) & (F.col("position") == F.col("at")), "left_anti")
    inner = inner.select("position", "p1", "p2").distinct()
    single = last.groupBy("position", "p1", "p2").agg(F.min("conv").alias("conv"))
    return single.join(inner, ["position", "p1", "p2"], "left_anti").select("conv", F.col("position").alias("n_turns"))


def collapse(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    template: tuple[str, str, str] = TEMPLATE, part: int = PART,
) -> DataFrame:
    """(conv_id, part, n_turns, rendered): the conversations that stay, rendered; n_turns of the whole conversation."""
    placed = stored(positions(turns, conv_col, turn_col, role_col, text_col), "positions")
    hashed = stored(prefixes(placed), "prefixes")
    kept = stored(maximal(hashed).select(F.col("conv").alias("kept"), "n_turns"), "maximal")
    start, between, end = map(F.lit, template)
    shown = F.concat(start, F.coalesce("role", F.lit("unknown")), between, F.coalesce("text", F.lit("")), end)
    rows = placed.join(kept, F.col("conv").eqNullSafe(F.col("kept")))
    rows = rows.select("conv", "n_turns", F.floor((F.col("position") - 1) / part).cast("int").alias("part"), "position", shown.alias("shown"))
    parts = rows.groupBy("conv", "n_turns", "part").agg(F.sort_array(F.collect_list(F.struct("position", "shown"))).alias("turns"))
    return parts.select(
        F.col("conv").alias(conv_col), "part", F.col("n_turns").cast("long"),
        F.array_join(F.transform("turns", lambda t: t["shown"]), "").alias("rendered"),
    )


CHECK_SQL = f"""
    WITH t AS (
        SELECT conv_id, role, text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos
        FROM conversations),
    p AS (
        SELECT conv_id, pos, list({{'r': role, 't': text}}) OVER (PARTITION BY conv_id ORDER BY pos) AS prefix,
               count(*) OVER (PARTITION BY conv_id) AS n
        FROM t),
    whole AS (SELECT n, prefix, min(conv_id) AS conv_id FROM p WHERE pos = n GROUP BY n, prefix),
    inner_prefix AS (SELECT DISTINCT prefix FROM p WHERE pos < n),
    kept AS (SELECT conv_id, n FROM whole WHERE prefix NOT IN (SELECT prefix FROM inner_prefix))
    SELECT k.conv_id, CAST((pos - 1) // {PART} AS INTEGER) AS part, n AS n_turns,
           string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY pos) AS rendered
    FROM kept k JOIN t ON t.conv_id = k.conv_id GROUP BY 1, 2, 3"""
