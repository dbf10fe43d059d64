"""Chat formatting with cumulative snapshots collapsed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: How a turn is written; both parts are parameters of ``chat_format``.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def rolling_turns(conversations: DataFrame) -> DataFrame:
    """Turns in order with the rolling hash of the prefix that each one ends.

    The hash of a prefix is the exclusive or of two fingerprints of (place,
    role, text), so each turn adds to the hash before it. Rows that repeat a
    turn entirely count once; turns that share a number are ordered by role,
    then text. A null role or text differs from an empty one.
    """
    turns = (
        conversations.select("conv_id", "turn", "role", "text")
        .repartition("conv_id")
        .dropDuplicates(["conv_id", "turn", "role", "text"])
    )
    ordered = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = turns.withColumn("place", F.row_number().over(ordered))
    # Nulls do not change a Spark hash, so they are marked.
    parts = ["place", "role", "text", F.col("role").isNull(), F.col("text").isNull()]
    marks = {
        "mark_a": F.xxhash64(F.lit(1), *parts),
        "mark_b": F.xxhash64(F.lit(2), *parts),
    }
    rolling = Window.partitionBy("conv_id").orderBy("place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    last = Window.partitionBy("conv_id")
    return placed.withColumns(marks).withColumns(
        {
            "prefix_a": F.bit_xor("mark_a").over(rolling),
            "prefix_b": F.bit_xor("mark_b").over(rolling),
            "n_turns": F.max("place").over(last),
        }
    ).drop("mark_a", "mark_b")


def maximal_conversations(rolling: DataFrame) -> DataFrame:
    """Conversations that are no prefix of another one: conv_id, n_turns.

    Equal conversations collapse to the smallest conv_id before the
    anti-join and prefixes are distinct, so neither side has a hot key.
    """
    key = ["place", "prefix_a", "prefix_b"]
    whole = (
        rolling.filter("place = n_turns")
        .groupBy(*key)
        .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    )
    prefixes = rolling.filter("place < n_turns").select(*key).distinct()
    return whole.join(prefixes, key, "left_anti").select(
        "conv_id", F.col("place").alias("n_turns"), "n_copies"
    )


def chat_format(conversations: DataFrame, opening: str = OPEN, closing: str = CLOSE) -> DataFrame:
    """Render each maximal conversation as one text.

    A logged conversation whose turns are the first turns of a longer one, or
    all turns of one with a smaller conv_id, is dropped. Returns conv_id,
    n_turns, n_copies (conversations with the same turns) and chat. A null
    role is written as ``unknown``, a null text as nothing; rows without a
    conv_id form one conversation. Other columns are not read; an empty table
    gives an empty result.
    """
    rolling = rolling_turns(conversations)
    keep = maximal_conversations(rolling).withColumnRenamed("conv_id", "keep_id")
    turn = F.concat(
        F.lit(opening), F.coalesce("role", F.lit("unknown")), F.lit("\n"),
        F.coalesce("text", F.lit("")), F.lit(closing),
    )
    return (
        rolling.select("conv_id", "place", turn.alias("written"))
        .join(keep, F.col("conv_id").eqNullSafe(F.col("keep_id")))
        .groupBy("conv_id", "n_turns", "n_copies")
        .agg(
            F.array_join(
                F.transform(
                    F.sort_array(F.collect_list(F.struct("place", "written"))), lambda x: x["written"]
                ),
                "",
            ).alias("chat")
        )
        .select("conv_id", F.col("n_turns").cast("long").alias("n_turns"), "n_copies", "chat")
    )
