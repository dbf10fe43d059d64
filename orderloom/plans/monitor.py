"""Orders that need a look: never processed, processed to nothing, or damaged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.operators.allocations import pair_lists, read_segments, totals_in_place
from orderloom.operators.ledger import settled
from orderloom.operators.orders import inbound_scan, listed_orders


def unusable_reason() -> Column:
    """Why no report can take the order, NULL when one does."""
    return F.when(~F.col("readable"), "bad JSON").when(F.col("route").isNull(), "no route")


def empty_reason() -> Column:
    """Why the reports of a processed order are empty or carry an unusable store."""
    return (
        F.when(F.col("line_rows") == 0, "no lines")
        .when(F.col("allocated_rows") == 0, "no valid pair")
        .when(F.col("bad_stores") > 0, "bad store")
    )


def damage_reasons() -> list[Column]:
    """What was left out of an order that is reported otherwise."""
    return [
        F.when(F.col("bad_lines"), "bad line"),
        F.when(F.col("bad_segments"), "bad segment"),
        F.when(F.col("repeated_keys"), "repeated key"),
    ]


def _each_reason(rows: DataFrame, *reasons: Column) -> DataFrame:
    """One row per order and reason that holds."""
    held = F.array_compact(F.array(*reasons))
    return rows.select("source_id", "company_code", F.explode(held).alias("reason"))


def document_facts(inbound: DataFrame) -> DataFrame:
    """What one pass over the documents tells of every order, unusable ones included."""
    paired = pair_lists(read_segments(listed_orders(inbound_scan(inbound), None)))
    return paired.select(
        "source_id", "company_code", "readable", "route", totals_in_place(paired).alias("totals")
    ).select("source_id", "company_code", "readable", "route", "totals.*")


def order_problems(orders: DataFrame) -> DataFrame:
    """Reasons of processed orders, from the totals and flags that are kept with them."""
    return _each_reason(orders, empty_reason(), *damage_reasons())


def error_monitor(inbound: DataFrame, ledger: DataFrame) -> DataFrame:
    """One row per order and reason, for staging rows and the ledger of what is done.

    The documents are reduced to their reasons before the ledger join, so only
    ids and reasons are shuffled.
    """
    told = document_facts(inbound).select(
        "source_id",
        "company_code",
        unusable_reason().alias("unusable"),
        F.when(F.col("route").isNotNull(), empty_reason()).alias("empty"),
        F.array_compact(F.array(*damage_reasons())).alias("damage"),
    )
    done = settled(ledger, "details", ["Success"]).select(F.col("source_id").alias("done_id"))
    joined = told.join(done, F.col("source_id") == F.col("done_id"), "left")
    first = F.when(F.col("done_id").isNotNull(), F.col("empty")).otherwise(
        F.coalesce("unusable", F.lit("details missing"))
    )
    reasons = F.concat(F.array_compact(F.array(first)), "damage")
    return joined.select("source_id", "company_code", F.explode(reasons).alias("reason"))
