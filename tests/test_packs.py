"""Bills of material, sizes and the catalogue, on literal documents."""

import pytest
from conftest import line, order, rows
from pyspark.sql import functions as F

from orderloom.functions.sizes import cut_suffix, plain_text, second_entry, size_fallback
from orderloom.operators.catalogue import catalogue_lookup, catalogue_override
from orderloom.operators.orders import order_lines
from orderloom.plans import prepack
from orderloom.plans.prepare import attributed_lines


def part(style="CS1", qty="4", color="RED", size="S", **more):
    fields = {
        "VendorItemNumber": style, "ColorDescription": color, "SizeDescription": size,
        "GTIN": "CG", "BuyerPartNumber": "CB", "ProductId": "CP", "Quantity": qty,
    }
    return {**fields, **more}


def packs(staged):
    return attributed_lines(staged)


@pytest.mark.parametrize(
    "text, cut, size",
    [
        ("SMALL REGULAR", "(R)", "SMALL REGULAR"),
        ("SMALL", "(NULL)", "SMALL"),
        (" 0X  tall ", "(T)", "0X  tall"),
        ('["x","M TALL"]', "(T)", "M TALL"),
        ('["x"," M "]', "(M)", "M"),
        ('["x",""]', "(NULL)", None),
        ('["x"]', "(NULL)", None),
        ("", "(NULL)", ""),
        (None, "(NULL)", None),
    ],
)
def test_cut_and_size(spark, text, cut, size):
    frame = spark.createDataFrame([(text,)], "t string").select(
        second_entry(F.col("t")).alias("second"), plain_text("t").alias("plain")
    )
    second, plain = F.col("second"), F.col("plain")
    assert rows(frame.select(cut_suffix(second, plain), size_fallback(second, plain))) == [
        (cut, size)
    ]


def test_pack_attributes_per_route(inbound):
    bom = [part(qty="4", color="BLUE"), part(qty="8"), part(qty="x")]
    one = line(bom=bom, size=["x", "M TALL"])
    staged = inbound(
        order([one], "Kohls", "PREPACK"),
        order([one], "ARULA", "NE", "KN"),
        order([one], "Maurices", "SO"),
        order([one], "BELK", "NE", "BK"),
        order([one], "BELK", "NE", "SA"),
    )
    found = rows(packs(staged), "route", "style", "color", "size", "inner_pack")
    assert found == [
        ("AK", "A1234 P12", "RED", "PPK", None),
        ("BB", "A1234 P12", "BLUE", "PPK", 2),
        ("BS", "A1234", "RED", "M TALL", None),
        ("KP", "A1234", "BLUE", "PPK", 2),
        ("MS", "P1", "BLUE", "CA", None),
    ]


def test_lines_that_are_no_packs(inbound):
    staged = inbound(
        order([line(bom=None), line(bom="text"), line()], "BELK", "NE", "BK"),
        order([line(size="0X REGULAR")], "Maurices", "SO"),
    )
    assert rows(packs(staged), "route", "style", "size", "inner_pack") == [
        ("BB", "A1234", None, None)
    ] * 3 + [("MS", "A1234 (R)", "0X REGULAR", None)]


def test_pack_without_whole_quantities_has_no_style(inbound):
    staged = inbound(order([line(bom=[part(qty="x")]), line(bom=[])], "BELK", "NE", "BK"))
    assert rows(packs(staged), "style", "size") == [(None, "PPK"), (None, "PPK")]


def test_prepack_keeps_each_composition_once(inbound):
    a, b = part("CS1", "4"), part("CS2", "8", size="M")
    lines = [line(bom=[a, b], GTIN="G1"), line(bom=[b, a], GTIN="G2"), line(bom=a, GTIN="G3"), line()]
    staged = inbound(order(lines, "Kohls", "PREPACK"), order([line()], "BELK", "NE", "BK"))
    found = packs(staged)
    assert rows(prepack.bom_gate(found), "source_id") == [(1,)]
    summary = prepack.prepack_summary(found)
    assert rows(summary, "prepack_number", "component_style", "component_qty") == [
        ("G1", "CS1", 4), ("G1", "CS2", 8), ("G3", "CS1", 4),
    ]


def test_prepack_columns_per_company(inbound):
    bom = [part(qty="4", size="0X REGULAR"), part("CS2", qty="8.0", size="L")]
    one = line(bom=bom)
    staged = inbound(
        order([one], "Kohls", "PREPACK"),
        order([one], "ARULA", "NE", "SA"),
        order([one], "Maurices", "SO"),
        order([one], "BELK", "NE", "RL"),
        order([one], "BELK", "NE", "SA"),
    )
    found = rows(
        prepack.prepack_summary(packs(staged)).drop("header_id", "customer_po"),
    )
    none = None
    assert found == [
        (1, "G1", "B1", none, none, none, "G1", "CS1", "RED", "0X REGULAR", "CG", "CB", 4),
        (1, "G1", "B1", none, none, none, "G1", "CS2", "RED", "L", "CG", "CB", none),
        (2, "A1234", "G1", none, none, none, none, "CS1", "RED", "0X REGULAR", none, "CG", 4),
        (2, "A1234", "G1", none, none, none, none, "CS2", "RED", "L", none, "CG", none),
        (3, "P1", "P1", none, none, none, none, "CS1 (R)", "RED", "0X REGULAR", none, "CP", 4),
        (3, "P1", "P1", none, none, none, none, "CS2 (NULL)", "RED", "L", none, "CP", 8),
        (4, none, none, "A1234 P4", "RED", "PPK4", "G1", "CS1", "RED", "0X REGULAR", "CG", none, 4),
        (4, none, none, "A1234 P4", "RED", "PPK4", "G1", "CS2", "RED", "L", "CG", none, none),
    ]


@pytest.fixture
def catalogue(spark):
    companies = spark.createDataFrame(
        [("Belk", "C2"), ("BELK", "C1"), ("ARULA", "C9")], "company string, company_id string"
    )
    product = spark.createDataFrame(
        [("P1", 20, "C1"), ("P1", 10, "C1"), ("P1", 5, "C9"), ("P2", 30, "C1")],
        "product_id string, pid long, company_id string",
    )
    retail = spark.createDataFrame(
        [(10, "TEAL", "Z2"), (10, "AQUA", "Z1"), (20, "PINK", "Z9"), (5, "GREY", "Z5")],
        "pid long, color string, size string",
    )
    return catalogue_lookup(companies, product, retail)


def test_catalogue_has_one_row_per_product(catalogue):
    assert rows(catalogue) == [
        ("ARULA", "P1", "GREY", "Z5"), ("BELK", "P1", "AQUA", "Z1"), ("BELK", "P2", None, None),
    ]


def test_catalogue_overrides_what_it_should(inbound, catalogue):
    size = ["x", "M"]
    lines = [
        line(ProductId="P1", size=size),
        line(ProductId="P1", size=size, bom=[part(color="BLUE")]),
        line(ProductId="P2", size=size),
        line(ProductId=None, size=size),
    ]
    staged = inbound(
        order(lines, "BELK", "NE", "BK"), order(lines, "BELK", "NE", "SA"), order(lines, "ARULA", "NE", "SA")
    )
    found = catalogue_override(attributed_lines(staged), catalogue)
    assert rows(found, "source_id", "line_pos", "color", "size") == [
        (1, 0, "AQUA", "Z1"), (1, 1, "BLUE", "PPK"), (1, 2, "RED", "M"), (1, 3, "RED", "M"),
        (2, 0, "AQUA", "Z1"), (2, 1, "AQUA", "Z1"), (2, 2, "RED", "M"), (2, 3, "RED", "M"),
        (3, 0, "RED", "M"), (3, 1, "RED", "PPK"), (3, 2, "RED", "M"), (3, 3, "RED", "M"),
    ]


def test_shuffled_catalogue_join_gives_the_same(spark, inbound, catalogue):
    staged = inbound(*[order([line(), line(ProductId=None)], "BELK", "NE", "SA")] * 20)
    expected = rows(catalogue_override(attributed_lines(staged), catalogue), "source_id", "color")
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = catalogue_override(attributed_lines(staged), catalogue)
        assert rows(joined, "source_id", "color") == expected
        assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
