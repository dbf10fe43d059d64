"""Numbers of rows in a total order, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.scratch import Scratch

_PART, _AT, _BEFORE, _FIRST = "_part", "_at", "_before", "_first"


def number_rows(
    scratch: Scratch, name: str, rows: DataFrame, group: str, order: list[str]
) -> DataFrame:
    """Add ``n``, each row's place in its group from 0, and ``size``, the group's rows.

    Rows are dealt out by range and sorted inside their partition, so a group
    that dominates spreads over many tasks. Only one row per partition and group
    meets in a window: its running count says how many rows lie in the
    partitions before. ``order`` should tell all rows apart; equal ones fall
    into one partition. Nulls come first. ``group`` must not be null.
    """
    keys = [F.col(group), *[F.col(c) for c in order]]
    placed = scratch.store(
        f"{name}-sorted",
        rows.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn(_AT, F.monotonically_increasing_id()),
    ).withColumn(_PART, F.shiftright(_AT, 33))
    parts = placed.groupBy(group, _PART).agg(
        F.count("*").alias(_BEFORE), F.min(_AT).alias(_FIRST)
    )
    whole = Window.partitionBy(group)
    running = whole.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    shifts = scratch.store(
        f"{name}-parts",
        parts.select(
            group,
            _PART,
            _FIRST,
            F.coalesce(F.sum(_BEFORE).over(running), F.lit(0)).alias(_BEFORE),
            F.sum(_BEFORE).over(whole).alias("size"),
        ),
    )
    numbered = scratch.store(
        name,
        placed.join(shifts, [group, _PART]).select(
            *rows.columns, (F.col(_AT) - F.col(_FIRST) + F.col(_BEFORE)).alias("n"), "size"
        ),
    )
    scratch.drop(f"{name}-sorted", f"{name}-parts")
    return numbered
