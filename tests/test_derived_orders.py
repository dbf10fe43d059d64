"""Documents derived from the retail tables: what travels, and rows with gaps or repeats."""

import json
from datetime import datetime

from conftest import line, order

from orderloom.operators.orders import parse_orders
from orderloom.sources.derived_orders import purchase_orders

ORDERS = "o_orderkey long, o_custkey long, o_orderdate timestamp"
LINES = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_shipdate timestamp"
)
DAY = datetime(1996, 1, 2)


def _tables(spark, folder, orders, lines):
    spark.createDataFrame(orders, ORDERS).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(lines, LINES).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_lines_are_grouped_as_numbers(spark, tmp_path):
    """No text below the aggregate: it would be sorted and spilled there."""
    folder = _tables(spark, tmp_path, [(4, 3, DAY)], [(4, 1, 1, 1, 5.0, 1.0, DAY)])
    plan = purchase_orders(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    grouped = next(i for i, text in enumerate(lines) if "Aggregate [" in text)
    assert "LineItemId" in "".join(lines[: grouped + 1])
    assert "LineItemId" not in "".join(lines[grouped + 1 :])


def test_gaps_and_repeats_in_the_tables(spark, tmp_path):
    orders = [(4, 3, DAY), (4, 3, DAY), (None, 3, DAY), (6, 3, DAY)]
    lines = [(4, 2, 2, 2, 5.0, 1.0, DAY), (4, None, 1, 1, 6.0, 1.0, DAY), (None, 1, 1, 1, 1.0, 1.0, DAY)]
    found = purchase_orders(spark, _tables(spark, tmp_path, orders, lines)).collect()
    documents = {r.id: json.loads(r.json) if r.json else None for r in found}
    assert len(found) == 3 and set(documents) == {5, 7, None}
    details = documents[5]["PurchaseOrderHeader"]["PurchaseOrder"]["PurchaseOrderDetails"]
    # Both lines stand twice, as the order does; the one without a part has the last size.
    assert [d.get("LineItemId") for d in details] == [None, None, "2", "2"]
    assert details[0]["VendorSizeDescription"] == "L"
    assert "PurchaseOrderDetails" not in documents[7]["PurchaseOrderHeader"]["PurchaseOrder"]


def test_routing_upper_cases_once_for_each_deciding_field(inbound):
    parsed = parse_orders(inbound(order([line()])))
    plan = parsed.select("route")._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.count("upper(") <= 2


def test_line_partitions_are_not_joined_by_their_size(spark, tmp_path):
    folder = _tables(spark, tmp_path, [(4, 3, DAY)], [(4, 1, 1, 1, 5.0, 1.0, DAY)])
    plan = purchase_orders(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
