"""Transmission versions of a purchase order.

Numbering runs per company and order number, letter case ignored. One order
number may own a large share of all rows, and all of those may come in one
second. So no window ever ranks rows of an order number: rows are counted by
hour, by second, and by time and block of source ids (each combined before the
shuffle), running counts are taken over the counts of one level inside the next,
and their sum is the number of rows before a block. Only the rows of one order,
time and block, at most ``BLOCK`` ids, are ordered one by one. The headers are
read twice, for the counts and for the rows: give stored ones, not documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PO_KEY = ["po_company", "po_number"]
#: Neighbouring source ids that are ordered together.
BLOCK = 1024
_HOUR, _SECOND = 3_600_000_000, 1_000_000


def _key(column: str) -> Column:
    """Upper-cased text that is never null, so that joins on it are plain."""
    return F.coalesce(F.concat(F.lit("="), F.upper(column)), F.lit(""))


def _keyed(headers: DataFrame) -> DataFrame:
    """Keys of every level; a row without a time comes before all others.

    No key is nullable. So no branch of the plan gets a filter of its own, and
    the counts of blocks, which three branches start from, are shuffled once.
    """
    micros = F.coalesce(F.unix_micros("downloaded_at"), F.lit(-(2**62)))
    zero = F.lit(0).cast("long")
    return headers.select(
        "*",
        _key("company").alias(PO_KEY[0]),
        _key("customer_po").alias(PO_KEY[1]),
        F.coalesce(F.floor(micros / _HOUR), zero).alias("t_hour"),
        F.coalesce(F.floor(micros / _SECOND), zero).alias("t_second"),
        micros.alias("t_micro"),
        F.coalesce(F.floor(F.col("source_id") / BLOCK), zero).alias("t_block"),
    )


def _running(counts: DataFrame, inside: list[str], order: list[str], name: str) -> DataFrame:
    """Add the count of the groups before each, inside the group of the level above.

    Groups that tie in ``order`` do not count for each other.
    """
    window = Window.partitionBy(*inside).orderBy(*order)
    frame = window.rangeBetween if len(order) == 1 else window.rowsBetween
    before = F.sum("n").over(frame(Window.unboundedPreceding, -1))
    return counts.withColumn(name, F.coalesce(before, F.lit(0)))


def _before_block(keyed: DataFrame, order: list[str]) -> DataFrame:
    """Rows of each order number before each of its times and blocks, in the given order."""
    hour, second = [*PO_KEY, "t_hour"], [*PO_KEY, "t_hour", "t_second"]
    blocks = keyed.groupBy(*second, "t_micro", "t_block").agg(F.count("*").alias("n"))
    seconds = blocks.groupBy(*second).agg(F.sum("n").alias("n"))
    hours = seconds.groupBy(*hour).agg(F.sum("n").alias("n"))
    by_hour = _running(hours, PO_KEY, ["t_hour"], "hours").drop("n")
    by_second = _running(seconds, hour, ["t_second"], "seconds").drop("n")
    by_block = _running(blocks, second, order, "blocks").drop("n")
    return (
        by_block.join(by_second.join(by_hour, hour), second)
        .withColumn("before", F.col("hours") + F.col("seconds") + F.col("blocks"))
        .drop("hours", "seconds", "blocks")
    )


def _numbered(headers: DataFrame, within: Column, order: list[str], name: str) -> DataFrame:
    keyed = _keyed(headers)
    on = [*PO_KEY, "t_hour", "t_second", "t_micro", "t_block"]
    return (
        keyed.withColumn("within", within)
        .join(_before_block(keyed, order), on)
        .withColumn(name, (F.col("before") + F.col("within")).cast("int"))
        .select(*headers.columns, name)
    )


def arrival_version(headers: DataFrame, name: str = "version") -> DataFrame:
    """1 + earlier transmissions of the same order; equal times share a number."""
    return _numbered(headers, F.lit(1), ["t_micro"], name)


def recalculate_versions(headers: DataFrame, name: str = "version") -> DataFrame:
    """Consecutive numbers by download time; equal times are ordered by source id."""
    window = Window.partitionBy(*PO_KEY, "t_hour", "t_second", "t_micro", "t_block")
    rank = F.row_number().over(window.orderBy("source_id"))
    return _numbered(headers, rank, ["t_micro", "t_block"], name)


def version_corrections(headers: DataFrame) -> DataFrame:
    """Headers whose stored ``version`` is not the recalculated one."""
    return (
        recalculate_versions(headers, "correct_version")
        .filter("version <> correct_version")
        .select("source_id", "company", "customer_po", "version", "correct_version")
    )


def inherit_version(rows: DataFrame, versions: DataFrame) -> DataFrame:
    """Give downstream rows the details version of their source id."""
    return rows.join(versions.select("source_id", "version"), "source_id", "left")


def latest_versions(headers: DataFrame) -> DataFrame:
    """The highest version of each company and order number.

    An aggregate rather than a window: partial maxima shrink a dominant order
    number before the shuffle.
    """
    rest = [c for c in headers.columns if c not in ("version", "source_id")]
    best = F.max(F.struct("version", "source_id", *rest))
    keyed = headers.groupBy(F.upper("company").alias("k1"), F.upper("customer_po").alias("k2"))
    return keyed.agg(best.alias("best")).select(*[F.col(f"best.{c}") for c in headers.columns])
