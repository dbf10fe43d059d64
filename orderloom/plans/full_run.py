"""One pickup of new orders through all reports, safe to repeat.

Documents are parsed once: the first phase writes typed lines, and every
report, also one that failed in an earlier run or was reopened, reads those
columns. Orders that no report can take are kept with the reason and not read
again.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators.allocations import (
    allocations,
    pair_lists,
    read_segments,
    totals_in_place,
)
from orderloom.operators.attributes import ATTRIBUTES, is_pack, line_attributes
from orderloom.operators.catalogue import catalogue_override, looks_up
from orderloom.operators.ledger import DOWNSTREAM, pending, pick_pending
from orderloom.operators.orders import HEADER_COLUMNS, headers, inbound_scan, listed_orders
from orderloom.operators.orders import unnest_lines
from orderloom.operators.versions import PO_KEY, inherit_version, latest_versions
from orderloom.operators.versions import recalculate_versions
from orderloom.plans import monitor, prepack, reports
from orderloom.sources.staging import DAY, FinishedDays, Staging
from orderloom.sources.tables import VERSIONS, ReportStore, po_bucket

STAGED = [
    *HEADER_COLUMNS,
    "company_code",
    DAY,
    "reason",
    "line_pos",
    "has_line",
    *[c for c in ATTRIBUTES if c != "line_qty"],
    "bom",
]
PACK_FIELDS = [c for c in prepack.PACK_COLUMNS if c != "bom"]
HEADERS = {
    "details": reports.details_header,
    "style_color": reports.style_color_header,
    "store": reports.store_header,
    "style_color_size": reports.style_color_size_header,
}
#: Reports that pair stores by a key of their own in the original procedures.
PAIRED = ["style_color", "store", "style_color_size"]
PAIRINGS = ("line", "original")


def new_run() -> str:
    return datetime.now(timezone.utc).strftime("run-%Y%m%dT%H%M%S%f")


def run_staged(
    store: ReportStore,
    staging: Staging,
    catalogue: DataFrame | None = None,
    run: str | None = None,
    pairing: str = "line",
) -> list[str]:
    """Pick up what a staging table has to do; returns the days that were read.

    Only days whose files changed since they were finished, and days with a
    reopened order, are listed, scanned and compared with their own part of the
    ledger. The days are noted as finished as they were before they were read.
    """
    with store.pinned():
        days = FinishedDays(store.spark, staging, store.root)
        found = days.open_days(store.reopened_days())
        names = sorted(found)
        run_all_reports(
            store, staging.read(names) if names else None, catalogue, run, pairing, names
        )
        if found:
            days.finish(found)
        return names


def run_all_reports(
    store: ReportStore,
    inbound: DataFrame | None,
    catalogue: DataFrame | None = None,
    run: str | None = None,
    pairing: str = "line",
    days: list[str] | None = None,
) -> None:
    """Details, then versions, then the other reports of every run that lacks them.

    Versions are in the ledger like a report: a run that stopped after its
    details gets its corrections on the next call. ``pairing`` "original" gives
    each report the pairing key of its own procedure instead of line and
    segment; one store keeps to one pairing. ``days`` names the arrival days of
    ``inbound`` if they are known, and limits the ledger to them.
    """
    with store.pinned():
        run = run or new_run()
        finish_versions(store)
        if inbound is not None and run not in store.runs("details"):
            scanned = inbound_scan(inbound)
            due = pick_pending(scanned, store.ledger(["details"], days), "details")
            if due is not None:
                details_phase(store, due, catalogue, run, pairing)
        later_phases(store)


def _waiting(store: ReportStore, report: str) -> list[str]:
    done = set(store.runs(report))
    return [run for run in store.runs("details") if run not in done]


def finish_versions(store: ReportStore) -> None:
    """Corrections that committed details still lack; before any further numbering."""
    for run in _waiting(store, VERSIONS):
        _versions_phase(store, run)


def later_phases(store: ReportStore) -> None:
    """What committed details still lack, and what was reopened."""
    finish_versions(store)
    for report in DOWNSTREAM:
        for run in _waiting(store, report):
            lines = staged_lines(store, [run]).filter("reason IS NULL")
            _downstream(store, report, lines, run)
        _build_again(store, report)


def details_phase(
    store: ReportStore,
    due: DataFrame,
    catalogue: DataFrame | None,
    run: str,
    pairing: str = "line",
) -> None:
    """Parse, write details, order rows and unusable rows; nothing is due, nothing is committed."""
    if pairing not in PAIRINGS:
        raise ValueError(f"pairing is one of {PAIRINGS}")
    if DAY not in due.columns:
        # Rows from elsewhere than a staging table arrive when they are picked up.
        due = due.withColumn(DAY, F.date_format(F.current_date(), "yyyy-MM-dd"))
    _write_lines(store, _staged_lines(due, pairing), catalogue, run)
    lines = staged_lines(store, [run])
    if lines.isEmpty():
        return
    usable = lines.filter("reason IS NULL")
    store.write_report("details", reports.details_report(allocations(usable)), run)
    unusable = lines.filter("reason IS NOT NULL").select("source_id", "company_code", DAY, "reason")
    store.write_report("unusable", unusable, run)
    heads = usable.filter("line_pos = 0")
    totals = [c for c in lines.columns if c.endswith("totals")]
    store.write_report("numbered", _numbered(store, headers(usable)), run)
    numbered = inherit_version(
        heads.select(*HEADER_COLUMNS, "company_code", DAY, *totals),
        store.read_runs("numbered", [run]).filter("stored IS NULL"),
    )
    store.write_report("orders", numbered.select("*", "totals.*").drop("totals"), run)
    settled = (
        store.read_runs("orders", [run])
        .select("source_id", DAY, F.lit("Success").alias("status"))
        .unionByName(
            store.read_runs("unusable", [run]).select(
                "source_id", DAY, F.lit("Unusable").alias("status")
            )
        )
    )
    store.commit("details", settled, run)


def _write_lines(
    store: ReportStore, staged: DataFrame, catalogue: DataFrame | None, run: str
) -> None:
    """Write the lines; those that look up the catalogue go through the join, alone.

    They are a part of their own, so the other lines are neither shuffled nor
    parsed again for the join.
    """
    part = F.when(looks_up(), "raw").otherwise("plain") if catalogue is not None else F.lit("plain")
    store.write_report("lines", staged.withColumn("part", part), run, "part")
    if catalogue is None:
        return
    raw = store.read_runs("lines", [run]).filter("part = 'raw'").drop("part", "run")
    looked = catalogue_override(raw, catalogue).select(*raw.columns)
    store.write_part("lines", looked, run, "part=looked")


def staged_lines(store: ReportStore, runs: list[str] | None = None) -> DataFrame:
    """Typed lines of some runs, or all that count, after the catalogue."""
    lines = store.read("lines", "details") if runs is None else store.read_runs("lines", runs)
    return lines.filter("part <> 'raw'").drop("part")


def _staged_lines(due: DataFrame, pairing: str) -> DataFrame:
    """Typed lines of all orders with their allocations; totals stand on the first line."""
    paired = read_segments(listed_orders(due, None))
    lists = {"": "details" if pairing == "original" else None}
    if pairing == "original":
        lists |= {f"_{report}": report for report in PAIRED}
    for suffix, key in lists.items():
        paired = pair_lists(paired, key, f"store_lists{suffix}")
    totals = {
        f"{suffix[1:]}_totals" if suffix else "totals": totals_in_place(
            paired, f"store_lists{suffix}", summed=bool(suffix)
        )
        for suffix in lists
    }
    told = paired.withColumns({**totals, "reason": monitor.unusable_reason()})
    lines = line_attributes(unnest_lines(told.drop("map_lists", "readable")))
    return lines.select(
        *STAGED,
        *[f"stores{suffix}" for suffix in lists],
        *[F.when(F.col("line_pos") == 0, F.col(c)).alias(c) for c in totals],
        *[F.when(is_pack() | looks_up(), F.col(c)).alias(c) for c in PACK_FIELDS],
    )


def _in_buckets(rows: DataFrame, keyed: DataFrame, buckets: int) -> DataFrame:
    """Rows of a bucketed table in the buckets of ``keyed``, as a partition filter.

    At most ``buckets`` numbers reach the driver.
    """
    touched = keyed.select(po_bucket(buckets).cast("int").alias("b")).distinct().collect()
    return rows.filter(F.col("po_bucket").cast("int").isin([r.b for r in touched]))


def _touched(rows: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of the order numbers that occur in the new ones."""
    keyed = [F.upper("company").alias(PO_KEY[0]), F.upper("customer_po").alias(PO_KEY[1])]
    keys = new.select(*keyed).distinct()
    same = F.lit(True)
    for name in PO_KEY:
        same = same & F.col(name).eqNullSafe(F.col(f"new_{name}"))
    renamed = keys.toDF(*[f"new_{name}" for name in PO_KEY])
    return rows.select("*", *keyed).join(renamed, same, "left_semi").drop(*PO_KEY)


def _numbered(store: ReportStore, new: DataFrame) -> DataFrame:
    """Versions of all rows of the new orders' numbers, beside the one stored so far.

    Numbered once for both uses: new orders get their version, earlier ones
    their corrections.
    """
    columns = ["source_id", "company", "customer_po", "downloaded_at"]
    seen = new.select(*columns, F.lit(None).cast("int").alias("stored"))
    if store.runs("details"):
        earlier = current_orders(store, touching=new)
        touched = _touched(earlier.select(*columns, F.col("version").alias("stored")), new)
        seen = seen.unionByName(touched)
    return recalculate_versions(seen).drop("downloaded_at")


def _versions_phase(store: ReportStore, run: str) -> None:
    """Log corrections for the order numbers this run touched."""
    numbered = store.read_runs("numbered", [run]).drop("run")
    corrections = numbered.filter("stored <> version").select(
        "source_id",
        "company",
        "customer_po",
        "version",
        F.current_timestamp().alias("corrected_at"),
    )
    store.write_report("corrections", corrections, run)
    store.commit(VERSIONS, store.read_runs("orders", [run]).select("source_id", DAY), run)


def _downstream(store: ReportStore, report: str, lines: DataFrame, run: str) -> None:
    """Write a report of staged lines and commit it."""
    if report == "prepack":
        store.write_report("prepack", prepack.prepack_summary(lines), run)
        store.write_report("prepack_orders", prepack.bom_gate(lines), run)
    elif report != "daily":
        build = getattr(reports, f"{report}_report")
        stores = f"stores_{report}" if f"stores_{report}" in lines.columns else "stores"
        store.write_report(report, build(allocations(lines, stores)), run)
    store.commit(report, lines.filter("line_pos = 0").select("source_id", DAY), run)


def _build_again(store: ReportStore, report: str) -> None:
    """A reopened report of orders whose details stand, from the lines that are kept."""
    again = store.reopened(report)
    if again is None:
        return
    ids = again.filter("done_run IS NULL").select("source_id")
    due = pending(ids, store.ledger(["details", report]), report, key="source_id")
    if due.isEmpty():
        return
    lines = staged_lines(store).filter("reason IS NULL")
    _downstream(store, report, lines.join(due, "source_id", "left_semi"), f"again-{new_run()}")


def current_orders(
    store: ReportStore, report: str = "details", touching: DataFrame | None = None
) -> DataFrame:
    """Order rows of a report's committed runs with their current version.

    With ``touching``, only the buckets of its order numbers are read.
    """
    orders = store.read("orders", "details")
    if orders is None or not store.runs(report):
        raise ValueError(f"no committed run of {report}")
    if report != "details":
        orders = orders.filter(F.col("run").isin(store.runs(report)))
        again = store.reopened(report)
        if again is not None:
            orders = orders.join(again.filter("done_run IS NULL"), "source_id", "left_anti")
    corrections = store.read("corrections", VERSIONS)
    if touching is not None:
        orders = _in_buckets(orders, touching, store.buckets)
        if corrections is not None:
            corrections = _in_buckets(corrections, touching, store.buckets)
    orders = orders.drop("run", "po_bucket")
    if corrections is None:
        return orders
    newest = (
        corrections.groupBy("source_id")
        .agg(F.max_by("version", "corrected_at").alias("corrected"))
    )
    return (
        orders.join(newest, "source_id", "left")
        .withColumn("version", F.coalesce("corrected", "version"))
        .drop("corrected")
    )


def report_headers(store: ReportStore, report: str) -> DataFrame:
    """Header rows of a report; the version always follows the details."""
    orders = current_orders(store, report)
    own = f"{report}_totals"
    if own in orders.columns:
        summed = ["total_qty", "total_amount"]
        orders = orders.drop(*summed).select("*", *[f"{own}.{c}" for c in summed])
    if report == "daily":
        return reports.daily_log(orders)
    if report == "prepack":
        gated = store.read("prepack_orders", "prepack").drop("run")
        return prepack.prepack_header(inherit_version(gated, orders))
    return HEADERS[report](orders)


def report_details(store: ReportStore, report: str) -> DataFrame:
    rows = store.read(report)
    if rows is None:
        raise ValueError(f"no committed run of {report}")
    return rows.drop("run")


def order_problems(store: ReportStore) -> DataFrame:
    """Orders that no report takes, or that came out empty or damaged, and why."""
    told = monitor.order_problems(current_orders(store))
    return told.unionByName(store.read("unusable", "details").select(*told.columns))


def create_views(store: ReportStore) -> list[str]:
    """Temporary views: the latest version of every report, the daily log, the problems."""
    names = []
    for report in [*HEADERS, "prepack"]:
        latest = latest_versions(report_headers(store, report))
        details = report_details(store, report).join(
            latest.select("source_id"), "source_id", "left_semi"
        )
        for name, rows in ((f"latest_{report}_header", latest), (f"latest_{report}", details)):
            rows.createOrReplaceTempView(name)
            names.append(name)
    report_headers(store, "daily").createOrReplaceTempView("daily_log")
    order_problems(store).createOrReplaceTempView("order_problems")
    return [*names, "daily_log", "order_problems"]
