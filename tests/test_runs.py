"""Ledger, full runs, retries, streaming and the monitor."""

import json
from datetime import datetime, timedelta

import pytest
from conftest import line, order, rows
from pyspark.sql import functions as F

from orderloom.operators.ledger import pending, pick_pending
from orderloom.plans import full_run, monitor, reports
from orderloom.plans.compaction import compact
from orderloom.sources.notes import Folder
from orderloom.sources.staging import FinishedDays, Staging
from orderloom.sources.tables import ReportStore, read_inbound
from orderloom.streaming import incremental
from orderloom.streaming.incremental import incremental_run

SDQ = {"SDQ03": "0001", "SDQ04": "2", "SDQ05": "0002", "SDQ06": "3"}
START = datetime(2024, 1, 1, 8)


def sent(day, **more):
    return (order([line(sdq=SDQ)], **more), START + timedelta(days=day))


@pytest.fixture(autouse=True, scope="module")
def interpreted(spark):
    """Compiling the plans takes far longer than these few rows."""
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    spark.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    yield
    spark.conf.unset("spark.sql.codegen.wholeStage")
    spark.conf.unset("spark.sql.codegen.factoryMode")


@pytest.fixture
def store(spark, tmp_path):
    return ReportStore(spark, str(tmp_path / "store"), buckets=4)


def counts(store):
    return {
        report: full_run.report_details(store, report).count()
        for report in ["details", "style_color", "store", "style_color_size", "prepack"]
    }


def test_pending_follows_the_ledger(spark, inbound):
    staged = inbound(sent(0), sent(1), sent(2), sent(3))
    ledger = spark.createDataFrame(
        [(1, "details", "Success"), (2, "details", "Success"), (2, "store", "Success"),
         (3, "details", "Failed"), (4, "store", "Success")],
        "source_id long, report string, status string",
    )
    assert rows(pending(staged, ledger, "details"), "id") == [(3,), (4,)]
    assert rows(pending(staged, ledger, "store"), "id") == [(1,)]
    picked = pick_pending(staged, ledger, "details")
    assert rows(picked, "id") == [(3,), (4,)]
    assert pick_pending(staged.filter("id = 1"), ledger, "details") is None
    assert pick_pending(staged, None, "details") is staged


def test_late_orders_are_renumbered_and_reruns_add_nothing(inbound, store):
    staged = inbound(sent(2), sent(0), sent(1), sent(2), (order([line()], kind="ZZ"), START))
    full_run.run_all_reports(store, staged.filter("id = 1"))
    assert rows(full_run.report_headers(store, "details"), "source_id", "version") == [(1, 1)]
    full_run.run_all_reports(store, staged)
    expected = [(1, 3), (2, 1), (3, 2), (4, 4)]
    for report in ["details", "style_color", "store", "style_color_size"]:
        found = rows(full_run.report_headers(store, report), "source_id", "version")
        assert found == expected
    before = counts(store)
    assert before == {
        "details": 8, "style_color": 4, "store": 8, "style_color_size": 4, "prepack": 0
    }
    full_run.run_all_reports(store, staged)
    assert counts(store) == before
    assert len(store.runs("details")) == 2
    assert len(rows(full_run.report_headers(store, "daily"))) == 4


def test_interrupted_run_is_finished_without_repeats(inbound, store, monkeypatch):
    staged = inbound(sent(0), sent(1))
    commit = ReportStore.commit

    def failing(self, report, ids, run, **more):
        if report == "store":
            raise OSError("lost")
        commit(self, report, ids, run, **more)

    monkeypatch.setattr(ReportStore, "commit", failing)
    with pytest.raises(OSError):
        full_run.run_all_reports(store, staged)
    assert store.read("store") is None and store.runs("style_color")
    monkeypatch.setattr(ReportStore, "commit", commit)
    full_run.run_all_reports(store, staged)
    assert counts(store) == {
        "details": 4, "style_color": 2, "store": 4, "style_color_size": 2, "prepack": 0
    }


def test_corrections_of_a_stopped_run_are_made_up_for(inbound, store, monkeypatch):
    staged = inbound(sent(2), sent(0))
    full_run.run_all_reports(store, staged.filter("id = 1"))
    commit = ReportStore.commit

    def failing(self, report, ids, run, **more):
        if report == "versions":
            raise OSError("lost")
        commit(self, report, ids, run, **more)

    monkeypatch.setattr(ReportStore, "commit", failing)
    with pytest.raises(OSError):
        full_run.run_all_reports(store, staged)
    monkeypatch.undo()
    full_run.run_all_reports(store, staged)
    full_run.run_all_reports(store, staged)
    found = rows(full_run.report_headers(store, "details"), "source_id", "version")
    assert found == [(1, 2), (2, 1)]


def test_half_written_ledger_marks_nothing(spark, inbound, store):
    staged = inbound(sent(0), sent(1))
    full_run.run_all_reports(store, staged.filter("id = 1"))
    left = spark.createDataFrame([(2, "Success")], "source_id long, status string")
    path = f"{store.root}/ledger/kind=details/run=stopped/arrival_day=2024-01-01"
    left.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    full_run.run_all_reports(store, staged)
    assert rows(full_run.report_headers(store, "details"), "source_id") == [(1,), (2,)]


def test_lost_details_do_not_count(inbound, store, monkeypatch):
    staged = inbound(sent(0))
    monkeypatch.setattr(ReportStore, "commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        full_run.run_all_reports(store, staged)
    monkeypatch.undo()
    full_run.run_all_reports(store, staged)
    assert counts(store)["details"] == 2


def test_views_show_the_latest_version(spark, inbound, store):
    staged = inbound(sent(1), sent(0), sent(0, po="PO2"))
    full_run.run_all_reports(store, staged)
    assert "latest_store" in full_run.create_views(store)
    found = spark.sql("SELECT source_id, version FROM latest_store_header ORDER BY source_id")
    assert rows(found) == [(1, 2), (3, 1)]
    assert spark.table("latest_details").count() == 4
    assert spark.table("daily_log").count() == 3


def test_stream_picks_up_new_files_once(spark, inbound, store, tmp_path):
    folder, checkpoint = str(tmp_path / "inbound"), str(tmp_path / "checkpoint")

    def pickup():
        query = incremental_run(spark, folder, store, checkpoint)
        query.awaitTermination()
        assert query.exception() is None

    staged = inbound(sent(1), sent(0), sent(2))
    staged.filter("id = 1").write.mode("append").parquet(folder)
    pickup()
    staged.filter("id > 1").write.mode("append").parquet(folder)
    pickup()
    pickup()
    assert rows(full_run.report_headers(store, "store"), "source_id", "version") == [
        (1, 2), (2, 1), (3, 3),
    ]
    assert counts(store)["store"] == 6
    assert read_inbound(spark, folder).count() == 3


def test_monitor_names_the_reason(spark, inbound):
    staged = inbound(
        order([line(sdq=SDQ)]),
        '{"PurchaseOrderHeader": {',
        order([line()], kind="ZZ"),
        order(None),
        order([line(sdq={"SDQ03": "1", "SDQ04": "0"})]),
        order([line(sdq={"SDQ03": "X", "SDQ04": "1"})]),
        order([line(sdq=SDQ)]),
    )
    ledger = spark.createDataFrame(
        [(i, "details", "Success") for i in (1, 4, 5, 6)],
        "source_id long, report string, status string",
    )
    assert rows(monitor.error_monitor(staged, ledger), "source_id", "reason") == [
        (2, "bad JSON"), (3, "no route"), (4, "no lines"), (5, "no valid pair"),
        (6, "bad store"), (7, "details missing"),
    ]


def test_unusable_orders_are_parsed_once_and_shown(spark, inbound, store, monkeypatch):
    staged = inbound(
        sent(0), '{"PurchaseOrderHeader": {', order([line()], kind="ZZ"), order(None),
        order([line(sdq={"SDQ03": "X", "SDQ04": "1"}), "no line"]),
    )
    full_run.run_all_reports(store, staged)
    assert rows(store.ledger(["details"]), "source_id", "status") == [
        (1, "Success"), (2, "Unusable"), (3, "Unusable"), (4, "Success"), (5, "Success"),
    ]
    full_run.create_views(store)
    problems = [(2, "bad JSON"), (3, "no route"), (4, "no lines"), (5, "bad line"), (5, "bad store")]
    assert rows(spark.table("order_problems"), "source_id", "reason") == problems
    monkeypatch.setattr(full_run, "details_phase", lambda *_: pytest.fail("read again"))
    full_run.run_all_reports(store, staged)
    monkeypatch.undo()
    # A type that gets a route later is done when it is reopened.
    mended = staged.withColumn("json", F.when(F.col("id") == 3, F.lit(json.dumps(order([line(sdq=SDQ)], po="PO9")))).otherwise(F.col("json")))
    full_run.run_all_reports(store, mended)
    assert rows(store.read("unusable", "details"), "source_id") == [(2,), (3,)]
    store.reopen(mended.filter("id = 3").select(F.col("id").alias("source_id")), ["details"])
    full_run.run_all_reports(store, mended)
    assert rows(store.read("unusable", "details"), "source_id") == [(2,)]
    assert rows(full_run.report_headers(store, "store"), "source_id") == [(1,), (3,), (4,), (5,)]


def ids(spark, *numbers):
    return spark.createDataFrame([(n,) for n in numbers], "source_id long")


def test_reopened_report_is_built_again_from_kept_lines(spark, inbound, store):
    staged = inbound(sent(0), sent(1), sent(2))
    full_run.run_all_reports(store, staged)
    before = rows(full_run.report_details(store, "store"))
    store.reopen(ids(spark, 2, 99), ["store"])
    # Until it is done again the order is not shown; other reports stand.
    assert rows(full_run.report_details(store, "store"), "source_id") == [(1,), (1,), (3,), (3,)]
    assert rows(full_run.report_headers(store, "store"), "source_id") == [(1,), (3,)]
    assert counts(store)["details"] == 6
    full_run.run_all_reports(store, staged)
    assert rows(full_run.report_details(store, "store")) == before
    assert rows(full_run.report_headers(store, "store"), "source_id", "version") == [(1, 1), (2, 2), (3, 3)]
    runs = len(store.commits())
    full_run.run_all_reports(store, staged)
    assert rows(full_run.report_details(store, "store")) == before and len(store.commits()) == runs


def test_reopened_details_follow_the_new_document(spark, inbound, store):
    first = inbound(sent(0), sent(1))
    full_run.run_all_reports(store, first)
    other = {"SDQ03": "0009", "SDQ04": "7"}
    changed = inbound((order([line(sdq=other)]), START - timedelta(days=1)), sent(1))
    store.reopen(ids(spark, 1), ["details"])
    full_run.run_all_reports(store, changed)
    for _ in range(2):
        found = rows(full_run.report_details(store, "store"), "source_id", "store_number", "store_qty")
        assert found == [(1, 9, 7), (2, 1, 2), (2, 2, 3)]
        assert rows(full_run.report_headers(store, "details"), "source_id", "version") == [(1, 1), (2, 2)]
        assert counts(store)["details"] == 3
        store.reopen(ids(spark, 1), ["details"])
        full_run.run_all_reports(store, changed)


def run_days(store, staging, *expected):
    for days in expected:
        assert full_run.run_staged(store, staging) == list(days)


def test_pickup_opens_changed_days_alone(spark, inbound, store, tmp_path):
    staging = Staging(spark, str(tmp_path / "staging"))
    staged = inbound(*[sent(i) for i in range(6)])
    staging.write(staged.filter("id <= 2"), "2024-01-01")
    staging.write(staged.filter("id = 3"), "2024-01-02")
    run_days(store, staging, ["2024-01-01", "2024-01-02"], [])
    staging.write(staged.filter("id = 4"), "2024-01-02")
    staging.write(staged.filter("id = 5"), "2024-01-03")
    opened = staging.read(["2024-01-03"])
    assert all("arrival_day=2024-01-03" in f for f in opened.inputFiles())
    ledger = store.ledger(["details"], ["2024-01-02"])
    plan = ledger._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(arrival_day" in plan and "2024-01-02" in plan
    run_days(store, staging, ["2024-01-02", "2024-01-03"], [])
    assert counts(store)["details"] == 10
    # Far beyond the listed days only the low-water mark is left of them.
    staging.write(staged.filter("id = 6"), "2024-06-01")
    run_days(store, staging, ["2024-06-01"], [])
    note = FinishedDays(spark, staging, store.root).notes.latest()
    assert note["low_water"] == "2024-05-02" and list(note["finished"]) == ["2024-06-01"]
    store.reopen(ids(spark, 1), ["details"])
    run_days(store, staging, ["2024-01-01"], [])
    assert counts(store)["details"] == 12


def test_a_stopped_pickup_leaves_its_days_open(spark, inbound, store, tmp_path, monkeypatch):
    staging = Staging(spark, str(tmp_path / "staging"))
    staging.write(inbound(sent(0)), "2024-01-01")
    monkeypatch.setattr(ReportStore, "commit", lambda *_, **__: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        full_run.run_staged(store, staging)
    monkeypatch.undo()
    run_days(store, staging, ["2024-01-01"], [])
    assert counts(store)["details"] == 2


def test_small_runs_read_their_buckets_of_the_history(spark, inbound, store):
    full_run.run_all_reports(store, inbound(*[sent(i, po=f"PO{i}") for i in range(20)]))
    new = inbound(sent(30, po="PO7")).select(
        F.lit(99).cast("long").alias("source_id"), F.lit("Kohls").alias("company"),
        F.lit("PO7").alias("customer_po"), F.col("created").alias("downloaded_at"),
    )
    plan = full_run.current_orders(store, touching=new)._jdf.queryExecution().executedPlan().toString()
    scans = [text for text in plan.splitlines() if "FileScan" in text or "PartitionFilters" in text]
    assert scans and all("po_bucket" in text.split("PartitionFilters")[1] for text in scans if "PartitionFilters" in text)
    touched = full_run.current_orders(store, touching=new)
    assert "PO7" in [r.customer_po for r in touched.collect()] and touched.count() < 20
    numbered = full_run._numbered(store, new)
    assert rows(numbered, "source_id", "stored", "version") == [(8, 1, 1), (99, None, 2)]


def test_only_looked_up_lines_enter_the_catalogue_join(spark, inbound, store):
    catalogue = spark.createDataFrame(
        [("BELK", "P1", "TEAL", "XL")],
        "catalogue_company string, catalogue_product string, catalogue_color string, catalogue_size string",
    )
    staged = inbound(
        order([line(sdq=SDQ), line(sdq=SDQ, ProductId=None)], "BELK", "NE", "SA"), sent(0)
    )
    plans = []
    write = ReportStore.write_part

    def noted(self, table, rows_, run, part):
        plans.append(rows_._jdf.queryExecution().executedPlan().toString())
        write(self, table, rows_, run, part)

    ReportStore.write_part = noted
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        full_run.run_all_reports(store, staged, catalogue)
    finally:
        ReportStore.write_part = write
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    (plan,) = plans
    assert "SortMergeJoin" in plan and "Broadcast" not in plan and "(part" in plan.split("PartitionFilters")[1]
    (run,) = store.runs("details")
    parts = {r.part: r["count"] for r in store.read_runs("lines", [run]).groupBy("part").count().collect()}
    assert parts == {"plain": 2, "raw": 1, "looked": 1}
    found = rows(full_run.report_details(store, "details"), "source_id", "color")
    assert found == [(1, "RED"), (1, "RED"), (1, "TEAL"), (1, "TEAL"), (2, "RED"), (2, "RED")]


def test_compaction_keeps_every_report(spark, inbound, store, monkeypatch):
    staged = inbound(*[sent(5 - i) for i in range(6)])
    for number in range(1, 5):
        full_run.run_all_reports(store, staged.filter(f"id <= {number}"))
    store.reopen(ids(spark, 2), ["style_color"])
    assert compact(store) is None  # something waits
    full_run.run_all_reports(store, staged.filter("id <= 4"))

    def everything():
        heads = [rows(full_run.report_headers(store, r)) for r in (*full_run.HEADERS, "daily")]
        details = [rows(full_run.report_details(store, r)) for r in full_run.HEADERS]
        return [[tuple(map(str, row)) for row in table] for table in heads + details]

    before = everything()
    calls = []
    entries = Folder.entries
    monkeypatch.setattr(Folder, "entries", lambda self: calls.append(1) or entries(self))
    store.commits()
    listed = len(calls)
    target = compact(store)
    assert target and everything() == before
    assert {c.run for c in store.commits()} == {target}
    calls.clear()
    store.commits()
    assert len(calls) == listed == 2
    monkeypatch.undo()
    assert compact(store) is None
    full_run.run_all_reports(store, staged)
    assert rows(full_run.report_headers(store, "store"), "source_id", "version") == [
        (i, 7 - i) for i in range(1, 7)
    ]
    assert compact(store) is None  # one run and what is merged already
    store.reopen(ids(spark, 1), ["details"])
    full_run.run_all_reports(store, staged)
    assert counts(store)["details"] == 12


def test_a_stopped_merge_counts_nothing_twice(spark, inbound, store, monkeypatch):
    staged = inbound(sent(0), sent(1), sent(2))
    for number in (1, 2):
        full_run.run_all_reports(store, staged.filter(f"id <= {number}"))
    monkeypatch.setattr(Folder, "delete", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        compact(store)
    monkeypatch.undo()
    assert counts(store)["details"] == 4
    full_run.run_all_reports(store, staged)
    assert counts(store)["details"] == 6


def test_original_pairing_is_a_mode_of_the_run(spark, inbound, store):
    lines = [
        line(LineItemId="1", sdq={"SDQ03": "0001", "SDQ04": "2"}),
        line(LineItemId="2", sdq={"SDQ03": "0003", "SDQ04": "4"}, VendorItemNumber="B1"),
    ]
    staged = inbound(order(lines), (order(None, "Maurices", "SO"), START))
    full_run.run_all_reports(store, staged, pairing="original")
    found = rows(full_run.report_details(store, "store"), "source_id", "store_number", "store_qty")
    assert found == [(1, 1, 6), (1, 3, 6), (2, 45, None)]
    assert rows(full_run.report_headers(store, "store"), "source_id", "order_qty_total") == [(1, 12), (2, 0)]
    assert rows(full_run.report_headers(store, "details"), "source_id", "total_qty") == [(1, 6), (2, 0)]
    with pytest.raises(ValueError):
        full_run.run_all_reports(store, inbound(sent(9), sent(8), sent(7)), pairing="other")


def test_stream_drops_what_is_delivered_again(spark, inbound, store, tmp_path, monkeypatch):
    folder, checkpoint = str(tmp_path / "inbound"), str(tmp_path / "checkpoint")
    now = datetime.now()
    staged = inbound(*[(order([line(sdq=SDQ)]), now + timedelta(minutes=i)) for i in range(3)])
    looked = []
    ledger = ReportStore.ledger
    monkeypatch.setattr(ReportStore, "ledger", lambda self, *a, **b: looked.append(1) or ledger(self, *a, **b))

    def pickup(some):
        some.coalesce(1).write.mode("append").parquet(folder)
        query = incremental_run(spark, folder, store, checkpoint)
        query.awaitTermination()
        assert query.exception() is None

    pickup(staged.filter("id < 3"))
    pickup(staged)
    assert looked == []  # young rows are told by the stream's state alone
    monkeypatch.undo()
    assert counts(store)["details"] == 6
    # What was downloaded before the stream's memory began is told by the ledger.
    old = inbound(sent(0), sent(1), sent(2), sent(3))
    full_run.run_all_reports(store, old.filter("id = 4"))
    pickup(old)
    assert counts(store)["details"] == 8


def test_a_large_ledger_is_not_broadcast(spark, store):
    ids = spark.range(300_000)
    store.commit("details", ids.withColumnRenamed("id", "source_id"), "first")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    try:
        with store.pinned():
            due = pending(ids, store.ledger(["details"]), "details")
            plan = due._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_a_run_has_its_settings_and_puts_them_back(spark, inbound, store, monkeypatch):
    """Small splits, since documents cost CPU, and no sort before a table is split by a few values."""
    split, files = "spark.sql.files.maxPartitionBytes", "spark.sql.maxConcurrentOutputFileWriters"
    plans, write = [], ReportStore.write_report

    def noted(self, table, rows_, run, part_by=None):
        plans.append((spark.conf.get(split), spark.conf.get(files)))
        write(self, table, rows_, run, part_by)

    monkeypatch.setattr(ReportStore, "write_report", noted)
    had = spark.conf.getAll
    full_run.run_all_reports(store, inbound(sent(0)))
    assert plans and all(int(s) <= 16 << 20 and int(f) > 16 for s, f in plans)
    with pytest.raises(OSError), store.pinned():
        raise OSError("lost")
    assert spark.conf.getAll == had


def test_payloads_do_not_go_through_the_stream(spark, inbound, store, tmp_path, monkeypatch):
    """Nor are they shuffled to leave out what is delivered again."""
    seen, plans = [], []
    rows_of, write = incremental.batch_rows, ReportStore.write_report

    def noted(store_, batch, *more):
        seen.append(batch.columns)
        found = rows_of(store_, batch, *more)
        if found is not None:
            plans.append(found._jdf.queryExecution().executedPlan().toString())
        return found

    monkeypatch.setattr(incremental, "batch_rows", noted)
    folder, checkpoint = str(tmp_path / "in [1]"), str(tmp_path / "checkpoint")
    for some in ("id < 3", "id < 5"):
        inbound(*[sent(i) for i in range(4)]).filter(some).coalesce(1).write.mode("append").parquet(folder)
        query = incremental_run(spark, folder.replace("[", "\\[").replace("]", "\\]"), store, checkpoint)
        query.awaitTermination()
        assert query.exception() is None
    assert seen and all("json" not in columns for columns in seen)
    assert len(plans) == 2 and "Exchange" not in plans[0]
    assert "BroadcastHashJoin" in plans[1] and "Exchange hashpartitioning" not in plans[1]
    assert rows(full_run.report_headers(store, "details"), "source_id") == [(1,), (2,), (3,), (4,)]


def test_report_quantities_agree(spark, sf_dir):
    """Positive quantities of the details add up in every summing report."""
    from orderloom.registry.queries import _allocations

    rows_ = _allocations(spark, sf_dir).filter("route <> 'MS'").persist()
    sums = [
        reports.details_report(rows_).groupBy("source_id").agg(F.sum("qty").alias("n")),
        reports.store_report(rows_).groupBy("source_id").agg(F.sum("store_qty").alias("n")),
        reports.style_color_report(rows_).groupBy("source_id").agg(F.sum("qty_ordered").alias("n")),
        reports.style_color_size_report(rows_).groupBy("source_id").agg(F.sum("qty").alias("n")),
    ]
    first, *others = [set(rows(s.filter("n is not null"))) for s in sums]
    rows_.unpersist()
    assert first and all(o == first for o in others)
