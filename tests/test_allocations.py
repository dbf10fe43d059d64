"""Store allocations, reports and pairing modes, on literal documents."""

from decimal import Decimal

import pytest
from conftest import line, order, rows
from pyspark.sql import functions as F

from orderloom.functions import sdq
from orderloom.operators.allocations import (
    line_stores,
    lines_without_sdq,
    sdq_fields,
    sdq_pairs,
    sdq_segments,
)
from orderloom.operators.orders import order_lines
from orderloom.plans import full_run, reports
from orderloom.plans.prepare import attributed_lines, document_totals, order_allocations

PAIR = {"SDQ01": "EA", "SDQ02": "92", "SDQ03": "0045", "SDQ04": "5", "SDQ05": "0046", "SDQ06": "0"}


def test_segments_fields_and_pairs(inbound):
    lines = [
        line(LineItemId="1", sdq=PAIR),
        line(LineItemId="2", sdq=[{"SDQ03": "0001", "SDQ04": "2"}, {"SDQ09": "0002", "SDQ10": "x"}]),
        line(LineItemId="3"),
        line(LineItemId="4", sdq="none"),
        line(LineItemId="5", sdq={"SDQ03": "0007", "SDQ04": "3", "SDQ23": "0009", "SDQ100": "4"}),
    ]
    found = order_lines(inbound(order(lines, kind="PACK BY STORE")))
    assert rows(sdq_segments(found), "line_item_id", "segment") == [
        ("1", 0), ("2", 0), ("2", 1), ("5", 0),
    ]
    assert rows(sdq_fields(found).filter("line_item_id = '5'"), "index", "value") == [
        (100, "4"), (23, "0009"), (3, "0007"), (4, "3"),
    ]
    assert rows(sdq_pairs(found), "line_item_id", "segment", "store_number", "qty") == [
        ("1", 0, "0045", 5),
        ("1", 0, "0046", 0),
        ("2", 0, "0001", 2),
        ("2", 1, "0002", None),
        ("5", 0, "0007", 3),
    ]


@pytest.mark.parametrize(
    "company, kind, code, kept",
    [
        ("Kohls", "BULK", "NE", True),
        ("ARULA", "NE", "SA", True),
        ("Kohls", "PACK BY STORE", "NE", False),
        ("ARULA", "NE", "KN", False),
    ],
)
def test_lines_without_allocations(inbound, company, kind, code, kept):
    staged = inbound(order([line(), line(sdq={"SDQ03": "1", "SDQ04": "x"})], company, kind, code))
    expected = [(None, None)] if kept else []
    assert rows(lines_without_sdq(order_lines(staged)), "gtin") == [("G1",)] * kept
    details = reports.details_report(order_allocations(staged))
    assert rows(details, "store_number", "qty") == expected
    totals = reports.details_header(reports.order_totals(order_allocations(staged)))
    assert rows(totals, "total_items", "total_qty") == [(1 if kept else 0, 0)]


def test_store_text_groups_but_prints_numbers(inbound):
    sdq = {"SDQ03": "0045", "SDQ04": "1", "SDQ05": "45", "SDQ06": "2", "SDQ07": "X1", "SDQ08": "4"}
    rows_ = order_allocations(inbound(order([line(sdq=sdq), line(sdq=sdq)])))
    assert rows(reports.store_report(rows_), "store_number", "store_qty") == [
        (45, 2), (45, 4), (None, 8),
    ]
    assert rows(reports.order_totals(rows_), "bad_stores", "total_qty") == [(2, 14)]


def test_maurices_counts_lines_without_quantity_filter(inbound):
    staged = inbound(
        order([line(Quantity="3.9"), line(Quantity="x", ProductId="P2")], "Maurices", "SO"),
        order(None, "Maurices", "SO"),
        order([line(Quantity="-2.0")], "Maurices", "SO"),
    )
    rows_ = order_allocations(staged)
    assert rows(reports.details_report(rows_), "source_id", "store_number", "qty", "sku", "upc") == [
        (1, "0045", 3, "P1", None),
        (1, "0045", None, "P2", None),
        (3, "0045", -2, "P1", None),
    ]
    assert rows(reports.single_store_total(rows_), "source_id", "store_number", "store_qty") == [
        (1, 45, 3), (2, 45, None), (3, 45, -2),
    ]
    assert rows(reports.order_totals(rows_), "source_id", "total_items", "total_qty") == [
        (1, 2, 3), (2, 0, 0), (3, 1, -2),
    ]


def test_amounts_and_missing_prices(inbound):
    lines = [
        line(sdq=PAIR),
        line(sdq=PAIR, SalesPrice=" "),
        line(sdq=PAIR, UnitPrice="n/a", GTIN="G2"),
    ]
    rows_ = order_allocations(inbound(order(lines)))
    found = rows(reports.style_color_size_report(rows_), "upc", "retail_price", "qty", "amount")
    assert found == [
        ("G1", Decimal("5.00"), 5, Decimal("12.50")),
        ("G1", None, 5, Decimal("12.50")),
        ("G2", Decimal("5.00"), 5, None),
    ]
    header = reports.style_color_size_header(reports.order_totals(rows_))
    assert rows(header, "total_order_qty", "total_order_amount") == [(15, Decimal("25.00"))]


def test_only_prepack_style_color_splits_by_upc(inbound):
    lines = [line(sdq=PAIR, ProductId="P1", GTIN="G1"), line(sdq=PAIR, ProductId="P2", GTIN="G2")]
    staged = inbound(order(lines), order(lines, kind="PREPACK"))
    found = rows(
        reports.style_color_report(order_allocations(staged)), "source_id", "upc", "qty_ordered"
    )
    assert found == [(1, None, 10), (2, "P1", 5), (2, "P2", 5)]


def brute_strict(lines, keys):
    """Every store slot against every quantity slot of the order, by hand."""
    slots = []
    for position, one in enumerate(lines):
        sdq = one["DestinationInfo"]["SDQ"]
        for segment, keyed in enumerate(sdq if isinstance(sdq, list) else [sdq]):
            for key, value in keyed.items():
                number = int(key[3:5])
                if number >= 3:
                    slots.append((one, segment, number, value))
    out = []
    for s, s_seg, s_no, store in slots:
        for q, q_seg, q_no, qty in slots:
            same = {
                "line": s["LineItemId"] == q["LineItemId"],
                "upc": s["GTIN"] == q["GTIN"],
                "style": s["VendorItemNumber"] == q["VendorItemNumber"],
                "segment": s_seg == q_seg,
            }
            if s_no % 2 and q_no == s_no + 1 and all(same[k] for k in keys) and int(qty) > 0:
                out.append((store, int(qty)))
    return out


def test_strict_pairing_matches_brute_force(inbound):
    lines = [
        line(LineItemId="1", sdq={"SDQ03": "0001", "SDQ04": "2", "SDQ05": "0002"}),
        line(LineItemId="2", sdq={"SDQ03": "0003", "SDQ04": "4", "SDQ05": "0004", "SDQ06": "6"}),
        line(LineItemId="3", GTIN="G2", sdq={"SDQ03": "0005", "SDQ04": "1"}),
        line(LineItemId="4", sdq={"SDQ03": "0001", "SDQ04": "2"}),
    ]
    staged = inbound(order(lines))
    expected = brute_strict(lines, ["upc", "style"])
    strict = order_allocations(staged, pairing="details").filter("allocated")
    got = rows(strict, "store_number", "qty", "copies")
    assert sorted((s, q) for s, q, n in got for _ in range(n)) == sorted(expected)
    per_store = {}
    for store, qty in brute_strict(lines, ["upc"]):
        per_store[int(store)] = per_store.get(int(store), 0) + qty
    report = reports.store_report(order_allocations(staged, pairing="store"))
    assert rows(report, "store_number", "store_qty") == sorted(per_store.items())
    default = reports.store_report(order_allocations(inbound(order(lines))))
    assert rows(default, "store_number", "store_qty") == [(1, 4), (3, 4), (4, 6), (5, 1)]


def test_strict_drops_arrays_and_missing_codes(inbound):
    lines = [line(sdq=[PAIR]), line(sdq=PAIR, GTIN=None), line(sdq=PAIR)]
    staged = inbound(order(lines), order(lines, kind="PACK BY STORE"))
    strict = order_allocations(staged, pairing="details").filter("allocated")
    assert rows(strict, "source_id", "store_number", "qty", "copies") == [
        (1, "0045", 5, 1), (2, "0045", 5, 2), (2, "0045", 5, 2),
    ]


def test_stores_survive_without_a_join(inbound):
    staged = inbound(order([line(sdq=PAIR)]))
    plan = line_stores(attributed_lines(staged))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_original_pairing_reads_once_and_shuffles_nothing(inbound):
    staged = inbound(order([line(sdq=PAIR)]), order(None, "Maurices", "SO"))
    for report in ("details", "store", "style_color", "style_color_size"):
        rows_ = order_allocations(staged, pairing=report)
        plan = rows_._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan and plan.count("Scan") == 1
    store = reports.store_report(order_allocations(staged, pairing="store"))
    assert rows(store, "source_id", "store_number", "store_qty") == [(1, 45, 5), (2, 45, None)]


def test_repeated_lines_count_as_copies(inbound):
    lines = [line(LineItemId="1", sdq={"SDQ03": "0001", "SDQ04": "2"}) for _ in range(3)]
    staged = inbound(order(lines, kind="PACK BY STORE"))
    strict = order_allocations(staged, pairing="details").filter("allocated")
    assert rows(strict, "store_number", "qty", "copies") == [("0001", 2, 3)] * 3
    assert rows(document_totals(staged, pairing="details"), "total_qty", "allocated_rows") == [(18, 3)]


@pytest.mark.parametrize("pairing", [None, "details", "store"])
def test_totals_in_place_agree_with_an_aggregation(spark, inbound, pairing):
    lines = [
        line(sdq=PAIR),
        line(sdq={"SDQ03": "X", "SDQ04": "4", "SDQ3": "8", "SDQ4": "1"}, UnitPrice="n/a"),
        line(ProductId="P2", GTIN="G2"),
        line(sdq=[PAIR, {"SDQ03": "7", "SDQ04": "x"}], GTIN=None),
        line(sdq="[none]"),
    ]
    staged = inbound(
        *[order(some, c, k, t) for some in (lines, lines[:1], [], None)
          for c, k, t in (("Kohls", "BULK", "NE"), ("ARULA", "NE", "KN"), ("Maurices", "SO", "NE"))]
    )
    columns = ["source_id", "total_items", "total_qty", "total_amount", "line_rows",
               "allocated_rows", "bad_stores"]
    totals = document_totals(staged, pairing=pairing)
    assert "Exchange" not in totals._jdf.queryExecution().executedPlan().toString()
    expected = reports.order_totals(order_allocations(staged, pairing=pairing))
    # Rows of unnested lines that have several stores count several times there.
    counted = [c for c in columns if c != "line_rows"]
    assert rows(totals, *counted) == rows(expected, *counted)
    assert {r.line_rows for r in totals.collect()} == {5, 1, 0}


def test_two_spellings_of_a_number_keep_their_own_quantity(spark):
    from orderloom.functions.sdq import pairs, repeated_numbers, segments

    texts = [
        '{"SDQ3":"11","SDQ4":"9","SDQ03":"12","SDQ04":"8"}',
        '{"SDQ03":"12","SDQ4":"8"}',
        '{"SDQ1000000003":"1","SDQ1000000004":"5"}',
        '{"SDQ99999999999999999999":"1","SDQ100000000000000000000":"6"}',
        '{"SDQ0000000000000000000000000000000000000000000000003":"1","SDQ4":"7"}',
        '{"SDQ1299999999999":"1","SDQ1300000000000":"3","SDQ00":"9","SDQ2":"8"}',
    ]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    maps = segments(F.col("text"))
    found = frame.select("i", pairs(maps).alias("p"), repeated_numbers(maps).alias("twice")).orderBy("i")
    got = [([(p["store_number"], p["qty"]) for p in r.p], r.twice) for r in found.collect()]
    assert got == [
        ([("11", 9), ("12", 8)], True), ([("12", 8)], False), ([("1", 5)], False),
        ([("1", 6)], False), ([("1", 7)], False), ([("1", 3)], False),
    ]


def test_stores_pair_by_number_whatever_the_digits(spark, inbound):
    from orderloom.functions.sdq import pairs, positive_pairs, segments

    frame = spark.createDataFrame(
        [
            ('{"SDQ3":"1","SDQ4":"5"}',),
            ('{"SDQ99":"0099","SDQ10":"7"}',),
            ('{"SDQ101":"8","SDQ102":"2","SDQ01":"x","SDQ02":"9"}',),
        ],
        "text string",
    )
    found = frame.select(
        [pairs(segments(F.col("text"))).alias("all"), positive_pairs(segments(F.col("text"))).alias("some")]
    ).collect()
    assert [[(p["store_number"], p["qty"]) for p in row["all"]] for row in found] == [
        [("1", 5)], [], [("8", 2)]
    ]
    assert [[p["qty"] for p in row["some"]] for row in found] == [[5], [], [2]]


def test_odd_keys_pair_with_the_next_number(spark):
    """Keys outside two digits take the general way, and give what it gave."""
    maps = [
        {"SDQ03": "1", "SDQ04": "5", "SDQ01": "EA", "SDQ9": "2", "SDQ10": "6", "SDQ09": "3"},
        {"SDQ99": "4", "SDQ100": "7", "SDQ0099": "5", "SDQ0100": None, "SDQ199999999": "8"},
        {"SDQ200000000": "9", "SDQ1000000003": "6", "SDQ1000000004": "2", "SDQ7": "7", "SDQ008": "3"},
        {"SDQ11": "8", "SDQ12": None, "SDQ012": "4", "SDQ13\n": "9", "SDQ014": "2", "XSDQ15": "1"},
    ]
    frame = spark.createDataFrame([(maps,)], "maps array<map<string,string>>")
    told = frame.select(
        F.transform(sdq.pairs(F.col("maps")), lambda x: F.struct(x["segment"], x["store_number"], x["qty"])),
        F.size(sdq.positive_pairs(F.col("maps"))),
        sdq.repeated_numbers(F.col("maps")),
    ).first()
    assert sorted(map(tuple, told[0]), key=str) == [
        (0, "1", 5), (0, "2", 6), (0, "3", 6), (1, "4", 7), (1, "5", None),
        (2, "6", 2), (2, "7", 3), (3, "8", None), (3, "9", 2),
    ]
    assert (told[1], told[2]) == (7, True)


def test_partner_is_worked_out_once_per_store(spark):
    frame = spark.createDataFrame([], "maps array<map<string,string>>")
    plan = frame.select(sdq.positive_pairs(F.col("maps")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") < 10


def test_keys_of_the_original_pairing_do_not_run_together(inbound):
    """Line and UPC are one text in the key; 1 and 11 are not 11 and 1."""
    staged = inbound(
        order(
            [
                line(LineItemId="1", ProductId="11", sdq={"SDQ03": "0001", "SDQ04": "2"}),
                line(LineItemId="11", ProductId="1", sdq={"SDQ03": "0003", "SDQ04": "4"}),
            ],
            kind="PREPACK",
        )
    )
    found = order_allocations(staged, pairing="store")
    assert rows(found, "store_number", "qty") == [("0001", 2), ("0003", 4)]


def test_totals_of_own_pairings_are_sums_alone(inbound):
    staged = inbound(order([line(sdq={"SDQ03": "0001", "SDQ04": "2"})])).withColumn(
        "arrival_day", F.lit("2024-01-01")
    )
    kinds = full_run._staged_lines(staged, "original").schema
    assert kinds["store_totals"].dataType.names == ["total_qty", "total_amount"]
    assert "repeated_keys" in kinds["totals"].dataType.names
