"""Headline timings on one local session; prints one JSON line.

The staging table is written once beforehand, as the reports find it in
production; every query then reads, parses and reports. Each is run once to
warm up and timed on the second run.
"""

from __future__ import annotations

import json
import os
import shutil
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F

from orderloom.operators import versions
from orderloom.operators.catalogue import catalogue_lookup
from orderloom.operators.orders import inbound_scan, order_lines, routed_headers
from orderloom.plans import full_run, prepack, reports
from orderloom.plans.prepare import attributed_lines, document_totals, order_allocations
from orderloom.session import local_session
from orderloom.sources import derived_orders as derived
from orderloom.sources.staging import Staging
from orderloom.sources.tables import ReportStore, read_inbound

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def consume(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session("bench", CPUS, **{"spark.sql.shuffle.partitions": CPUS})
    work = tempfile.mkdtemp(prefix="bench-")
    times: dict[str, float] = {}

    def timed(name, run, warm=True) -> None:
        if warm:
            run()
        start = time.time()
        run()
        times[name] = round(time.time() - start, 3)

    def derive() -> None:
        derived.purchase_orders(spark, SF_DIR).write.mode("overwrite").parquet(f"{work}/inbound")

    derive()
    inbound = read_inbound(spark, f"{work}/inbound")
    catalogue = catalogue_lookup(
        derived.catalogue_company(spark, SF_DIR),
        derived.catalogue_product(spark, SF_DIR),
        derived.catalogue_retail(spark, SF_DIR),
    )
    orders = inbound.count()
    allocated = order_allocations(inbound, catalogue)
    attributed = attributed_lines(inbound, catalogue)

    def versions_from_documents() -> None:
        store = ReportStore(spark, f"{work}/headers")
        store.write_report("orders", routed_headers(inbound_scan(inbound)), "first")
        consume(versions.recalculate_versions(store.read_runs("orders", ["first"])))

    timed("order_lines", lambda: consume(order_lines(inbound_scan(inbound))))
    timed("details_report", lambda: consume(reports.details_report(allocated)))
    timed("details_totals", lambda: consume(document_totals(inbound)))
    timed("store_report", lambda: consume(reports.store_report(allocated)))
    timed("style_color_report", lambda: consume(reports.style_color_report(allocated)))
    timed("style_color_size_report", lambda: consume(reports.style_color_size_report(allocated)))
    timed("prepack_summary", lambda: consume(prepack.prepack_summary(attributed)))
    timed("recalculate_versions", versions_from_documents)
    strict = order_allocations(inbound, catalogue, pairing="store")
    timed("strict_store_report", lambda: consume(reports.store_report(strict)))

    # The staging table by arrival day: a quarter's rows a day, then one percent more.
    store, staging = ReportStore(spark, f"{work}/store"), Staging(spark, f"{work}/staging")
    staging.write(inbound.filter("id % 100 <> 0"), F.date_trunc("quarter", "created"))
    timed("run_all_reports", lambda: full_run.run_staged(store, staging, catalogue), warm=False)
    staging.write(inbound.filter("id % 100 = 0"), "2024-01-02")
    timed("run_one_percent_more", lambda: full_run.run_staged(store, staging, catalogue), warm=False)
    total = round(sum(times.values()), 3)
    result = {
        "metric": "total seconds of the headline queries",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "orders": orders,
        "orders_per_second_all_reports": round(orders / times["run_all_reports"], 1),
    }
    spark.stop()
    shutil.rmtree(work)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
