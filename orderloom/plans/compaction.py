"""Joining the folders of finished runs into one, so that their number stays small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators.ledger import DOWNSTREAM, settled
from orderloom.plans.full_run import current_orders
from orderloom.sources.notes import Folder
from orderloom.sources.tables import AGAIN, VERSIONS, ReportStore

#: The report whose commits make the rows of a table count.
TABLES = {
    "lines": "details",
    "details": "details",
    "unusable": "details",
    "orders": "details",
    "corrections": VERSIONS,
    "style_color": "style_color",
    "store": "store",
    "style_color_size": "style_color_size",
    "prepack": "prepack",
    "prepack_orders": "prepack",
}


def compact(store: ReportStore) -> str | None:
    """Merge all finished runs that are not merged yet; returns the new run.

    A run is finished when every report has it. Its rows are written once more
    in their life: merged runs are left alone. Version corrections go into the
    order rows, rows and ledger entries that a later run replaced go. The commit
    log switches to the new folder in one step, then the old ones are deleted;
    a stop before that leaves everything as it was.

    Nothing is merged while a reopened order waits, nor when there is at most
    one run to merge.
    """
    with store.pinned():
        commits = store.commits()
        reports = ["details", VERSIONS, *DOWNSTREAM]
        held = {report: set(store.runs(report)) for report in reports}
        finished = set.intersection(*held.values())
        open_runs = held["details"] - finished
        moved = {
            c.run for c in commits if not c.run.startswith("merged-") and c.run not in open_runs
        }
        if len(moved & finished) < 2 or _is_waiting(store, reports):
            return None
        seq = 1 + max(c.seq for c in commits)
        target = f"merged-{seq:09d}"
        for table, report in TABLES.items():
            rows = _merged(store, table, report, moved)
            store.write_report(table, rows, target, "part" if table == "lines" else None)
        merged = [store.write_ledger(_entries(store, r, moved), r, target, seq) for r in reports]
        kept = [c for c in commits if c.run not in moved]
        store.log.merge([*kept, *merged])
    for run in moved:
        # The numbering of a run is used up when its versions are committed.
        for table in [*TABLES, "numbered"]:
            Folder(store.spark, f"{store.root}/{table}").delete(f"run={run}")
        for report in reports:
            for kind in (report, report + AGAIN):
                Folder(store.spark, f"{store.root}/ledger/kind={kind}").delete(f"run={run}")
    return target


def _is_waiting(store: ReportStore, reports: list[str]) -> bool:
    for report in reports:
        again = store.reopened(report)
        if again is not None and not again.filter("done_run IS NULL").isEmpty():
            return True
    return False


def _merged(store: ReportStore, table: str, report: str, moved: set[str]) -> DataFrame:
    rows = store.read(table, report).filter(F.col("run").isin(sorted(moved)))
    if table == "lines":
        return rows.filter("part <> 'raw'").drop("run").withColumn("part", F.lit("plain"))
    if table == "corrections":
        rows = rows.limit(0)
    if table == "orders":
        current = current_orders(store).select("source_id", F.col("version").alias("current"))
        rows = rows.join(current, "source_id").withColumn("version", F.col("current")).drop("current")
    return rows.drop("run", "po_bucket")


def _entries(store: ReportStore, report: str, moved: set[str]) -> DataFrame:
    rows = settled(store.ledger([report]), report).filter(F.col("run").isin(sorted(moved)))
    newest = rows.groupBy("source_id").agg(
        F.max_by(F.struct("status", "arrival_day"), "seq").alias("last")
    )
    return newest.select("source_id", "last.status", "last.arrival_day")
