"""The processing ledger: an append-only record of what is done per row and report.

Of the entries of one source id and report the newest decides. ``Success`` and
``Unusable`` settle it, ``Reopened`` makes it due again. Entries carry ``seq``,
the number of their commit; a ledger without that column has only one per id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORTS = ["details", "style_color", "store", "style_color_size", "prepack", "daily"]
DOWNSTREAM = REPORTS[1:]
SETTLED = ["Success", "Unusable"]


def status_ledger(source_ids: DataFrame, report: str, run: str) -> DataFrame:
    """Entries for the given source ids, Success unless they bring their own status."""
    status = F.col("status") if "status" in source_ids.columns else F.lit("Success")
    return source_ids.select(
        "source_id",
        F.lit(report).alias("report"),
        status.alias("status"),
        F.current_timestamp().alias("processed"),
        F.lit(run).alias("run"),
        *[c for c in ("arrival_day",) if c in source_ids.columns],
    )


def settled(ledger: DataFrame, report: str, statuses: list[str] | None = None) -> DataFrame:
    """Entries that settle a report, without those reopened later.

    Only the reopened ids, which are few, are looked up; the other entries are
    neither grouped nor sorted.
    """
    own = ledger.filter(F.col("report") == report)
    done = own.filter(F.col("status").isin(statuses or SETTLED))
    if "seq" not in ledger.columns:
        return done
    again = own.filter("status = 'Reopened'").select(
        F.col("source_id").alias("again_id"), F.col("seq").alias("again_seq")
    )
    later = (F.col("source_id") == F.col("again_id")) & (F.col("again_seq") > F.col("seq"))
    return done.join(again, later, "left_anti")


def pending(rows: DataFrame, ledger: DataFrame, report: str, key: str = "id") -> DataFrame:
    """Rows the report has not settled; downstream reports also need the details.

    Give it narrow rows: the payload should not travel through these joins
    (see ``pick_pending``).
    """
    done = settled(ledger, report).select(F.col("source_id").alias("done_id"))
    left = rows.join(done, F.col(key) == F.col("done_id"), "left_anti")
    if report == "details":
        return left
    detailed = settled(ledger, "details", ["Success"]).select(F.col("source_id").alias("done_id"))
    return left.join(detailed, F.col(key) == F.col("done_id"), "left_semi")


def pick_pending(
    inbound: DataFrame, ledger: DataFrame | None, report: str
) -> DataFrame | None:
    """Full staging rows still to do, None when there are none.

    The ledger is compared on ids alone, which reads one column of the staging
    table. How the ids come back to the payload is left to the planner, which
    measures their size.
    """
    if ledger is None:
        return inbound
    due = pending(inbound.select("id"), ledger, report)
    if due.isEmpty():
        return None
    return inbound.join(due, "id", "left_semi")
