"""Routing, header fields and line shapes, on literal documents."""

import json
from datetime import date

import pytest
from conftest import line, order, rows
from pyspark.sql import functions as F

from orderloom.functions.texts import compact_date, decimal_text_int, safe_decimal, safe_int, scalar
from orderloom.operators.attributes import is_pack, line_attributes
from orderloom.operators.orders import (
    header_fields,
    headers,
    inbound_scan,
    order_lines,
    parse_orders,
    routed_headers,
    valid_json,
)
from orderloom.plans import monitor
from orderloom.plans.prepare import order_allocations

ROUTED = [
    ("Kohls", "BULK", "NE", "KB"),
    ("KOHLS", "pack by store", "NE", "KS"),
    ("Kohls", "PREPACK", "NE", "KP"),
    ("Kohls", "COMPOUND PREPACK", "NE", "KP"),
    ("Arula", "NE", "KN", "AK"),
    ("ARULA", "NE", "SA", "AS"),
    ("Maurices", "SO", "NE", "MS"),
    ("BELK", "NE", "BK", "BB"),
    ("Belk", "NE", "RL", "BB"),
    ("BELK", "NE", "SA", "BS"),
    ("BELK", "SO", "ZZ", None),
    ("Elsewhere", "BULK", "SA", None),
]


def test_routes_ignore_letter_case(inbound):
    documents = [order([line()], c, k, t) for c, k, t, _ in ROUTED]
    parsed = parse_orders(inbound(*documents))
    assert [r.route for r in parsed.orderBy("source_id").collect()] == [r for *_, r in ROUTED]


def test_scan_keeps_downloaded_purchase_orders(inbound):
    staged = inbound(order([line()]), order([line()]), order([line()]))
    staged = staged.withColumn("transaction_type", F.when(F.col("id") == 1, "860").otherwise("850"))
    staged = staged.withColumn("status", F.when(F.col("id") == 2, "Failed").otherwise("Downloaded"))
    assert rows(inbound_scan(staged), "id") == [(3,)]


def test_unreadable_documents_do_not_route(inbound):
    good = json.dumps(order([line()]))
    staged = inbound(
        order([line()]), '{"PurchaseOrderHeader": {', "not json", "[1, 2]", "",
        good + " garbage", good + good, f"{good},{good}", good + "]", good + "}", "\n " + good + " \t\n",
        good + '],"end":1} x', '"text"', "null", "5",
    )
    assert rows(valid_json(staged), "id") == [(1,), (11,), (4,)]
    parsed = parse_orders(staged)
    assert rows(parsed.filter("route is not null"), "source_id") == [(1,), (11,)]
    assert rows(parsed.filter("readable"), "source_id") == [(1,), (11,)]


def test_header_types_and_dates(inbound):
    staged = inbound(
        order([line()], kind="bulk"),
        order([line()], kind="COMPOUND PREPACK", CancelDate="20241399"),
        order([line()], "Maurices", "SO", RequestedShipDate=""),
        order([line()], "BELK", "NE", "RL", RequestedShipDate=""),
    )
    found = rows(
        header_fields(parse_orders(staged)), "source_id", "po_type", "start_date", "cancel_date"
    )
    end = date(2024, 1, 31)
    assert found == [
        (1, "BULK", date(2024, 1, 10), end),
        (2, "COMPOUND PREPACK", date(2024, 1, 10), None),
        (3, "SO", date(2024, 1, 12), end),
        (4, "RL", None, end),
    ]


@pytest.mark.parametrize("shape", ["array", "object"])
def test_lines_as_array_or_object(inbound, shape):
    one = line(LineItemId="9")
    staged = inbound(order([one] if shape == "array" else one))
    found = rows(order_lines(staged), "line_pos", "has_line", "line_item_id", "gtin")
    assert found == [(0, True, "9", "G1")]


@pytest.mark.parametrize("lines", [None, [], "text", 5])
def test_orders_without_lines_keep_one_row(inbound, lines):
    found = order_lines(inbound(order(lines)))
    assert rows(found, "source_id", "line_pos", "has_line") == [(1, 0, False)]
    assert rows(headers(found), "source_id", "customer_po") == [(1, "PO1")]


def test_headers_list_every_order_once(inbound):
    staged = inbound(order([line(), line()]), order(None), order(line()))
    assert rows(headers(order_lines(staged)), "source_id") == [(1,), (2,), (3,)]


def test_field_values_keep_their_text(inbound):
    odd = line(GTIN=12, ProductId={"a": 1}, BuyerPartNumber=None, UnitPrice=2.50, Pack=3.0)
    odd["ColorDescription"] = "[not json"
    found = rows(
        order_lines(inbound(order([odd]))),
        "gtin",
        "product_id",
        "buyer_part_number",
        "unit_price_text",
        "pack_text",
        "color_description",
    )
    assert found == [("12", None, None, "2.5", "3.0", "[not json")]


def test_one_parse_per_document(inbound):
    """Documents are parsed once and lines once, and again only if an element is no object."""
    from pyspark.sql import functions as F

    from orderloom.operators import allocations
    from orderloom.plans import prepack, reports
    from orderloom.plans.prepare import attributed_lines, document_totals
    from orderloom.routes import ALL_ROUTES

    staged = inbound(order([line()]))
    scanned = inbound_scan(staged)
    lines, heads = order_lines(scanned), routed_headers(scanned)
    allocated = order_allocations(staged)
    frames = {
        "valid_json": (valid_json(staged), 1, 0),
        "lines": (lines, 1, 1),
        "some lines": (lines.filter("has_line and route = 'KB'"), 1, 1),
        "headers": (heads.filter("route is not null"), 1, 0),
        "first lines": (headers(lines), 1, 1),
        "without sdq": (allocations.lines_without_sdq(lines), 1, 1),
        "segments": (allocations.sdq_segments(lines), 1, 1),
        "details": (reports.details_report(allocated), 1, 1),
        "store": (reports.store_report(allocated), 1, 1),
        "single store": (reports.single_store_total(allocated), 1, 1),
        "totals": (document_totals(staged).filter("total_qty > 0"), 1, 1),
        "attributes": (attributed_lines(staged, routes=ALL_ROUTES).filter("route = 'BB'"), 1, 1),
        "packs": (prepack.prepack_summary(lines), 1, 1),
        "gate": (prepack.bom_gate(lines), 1, 1),
        "monitor": (monitor.document_facts(staged).filter("route is null"), 1, 1),
    }
    for name, (frame, documents, lists) in frames.items():
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json(StructField(d,") == documents, name
        # The two readings of a list stand in one coalesce.
        assert plan.count("from_json(ArrayType(StructType(StructField(LineItemId") == 2 * lists, name


def test_numbers_from_text(spark):
    values = ["12", " 12 ", "", "  ", "x", "12.0", "12.345", "238.7", "-3", None]
    frame = spark.createDataFrame([(v,) for v in values], "t string")
    found = [
        tuple(r)
        for r in frame.select(
            safe_int(F.col("t")),
            safe_decimal(F.col("t")).cast("string"),
            decimal_text_int(F.col("t")),
        ).collect()
    ]
    assert found == [
        (12, "12.00", 12),
        (12, "12.00", 12),
        (None, None, None),
        (None, None, None),
        (None, None, None),
        (None, "12.00", 12),
        (None, "12.35", 12),
        (None, "238.70", 238),
        (-3, "-3.00", -3),
        (None, None, None),
    ]


def test_dates_and_scalars_from_text(spark):
    frame = spark.createDataFrame(
        [("20240229", "[1]"), ("20230229", '{"a":1}'), ("", "[x"), (None, "plain")],
        "d string, t string",
    )
    found = rows(frame.select(compact_date(F.col("d")), scalar("t")))
    assert found == [
        (date(2024, 2, 29), None),
        (None, None),
        (None, "[x"),
        (None, "plain"),
    ]


def test_a_bad_line_or_segment_goes_alone(spark, inbound):
    good = line(LineItemId="2", sdq=[{"SDQ03": "7", "SDQ04": "5"}, "bad", {"SDQ03": "8", "SDQ04": "6"}])
    staged = inbound(
        order([line(sdq={"SDQ03": "1", "SDQ04": "2"}), "x", 5, None, [1], good], kind="PACK BY STORE"),
        order([line(sdq={"SDQ03": "1", "SDQ04": "2"})], kind="PACK BY STORE", po="PO2"),
        order([5], kind="PACK BY STORE", po="PO3"),
    )
    lines = order_lines(inbound_scan(staged))
    assert rows(lines.filter("has_line"), "source_id", "line_item_id") == [(1, "1"), (1, "2"), (2, "1")]
    assert rows(headers(lines), "source_id") == [(1,), (2,), (3,)]
    got = order_allocations(staged).filter("allocated")
    assert rows(got, "source_id", "store_number", "qty") == [(1, "1", 2), (1, "7", 5), (1, "8", 6), (2, "1", 2)]
    facts = monitor.document_facts(staged)
    assert rows(monitor.order_problems(facts), "source_id", "reason") == [
        (1, "bad line"), (1, "bad segment"), (3, "bad line"), (3, "no lines"),
    ]


def test_quoted_documents_and_brackets_are_no_lines_or_packs(inbound):
    quoted = json.dumps(line(GTIN="Q"))
    staged = inbound(
        order([line(LineItemId="1"), quoted, line(LineItemId="2", sdq="[none]", bom="[none]")]),
        order("[none]"),
        order([quoted]),
        order([line(bom=[], GTIN="E"), line(bom=["x", {"Quantity": "3"}], GTIN="P")], "BELK", "NE", "BK"),
    )
    lines = order_lines(inbound_scan(staged))
    found = lines.filter("has_line")
    assert rows(found.filter("source_id < 4"), "source_id", "line_item_id") == [(1, "1"), (1, "2")]
    assert rows(headers(lines), "source_id") == [(1,), (2,), (3,), (4,)]
    packs = line_attributes(found).select("gtin", is_pack().alias("pack"), "style")
    assert rows(packs) == [
        ("E", True, None), ("G1", False, "A1234"), ("G1", False, "A1234"), ("P", True, "A1234 P3"),
    ]
    kept = order_allocations(staged).filter("allocated and source_id < 4")
    assert rows(kept, "source_id", "store_number") == [(1, None), (1, None)]
