"""The report families, each as one aggregation over the allocations of all routes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.operators.orders import HEADER_COLUMNS, header_key

DETAIL_COLUMNS = [
    "style",
    "color",
    "size",
    "upc",
    "sku",
    "qty",
    "uom",
    "unit_price",
    "retail_price",
    "inner_pack",
    "qty_per_inner_pack",
    "store_number",
]
AMOUNT = "decimal(29,2)"


def _ordered(allocations: DataFrame) -> DataFrame:
    """What the summing reports count: positive quantities, or any Maurices line."""
    return allocations.filter(
        F.col("allocated") & ((F.col("route") == "MS") | (F.col("qty") > 0))
    )


def details_report(allocations: DataFrame) -> DataFrame:
    """One row per line and store."""
    extra = ["copies"] if "copies" in allocations.columns else []
    return allocations.filter("allocated").select(
        header_key("details").alias("header_id"),
        "source_id",
        "customer_po",
        *DETAIL_COLUMNS,
        *extra,
    )


def order_totals(
    allocations: DataFrame, keys: Sequence[str] = tuple(HEADER_COLUMNS)
) -> DataFrame:
    """One row per order with every header total, from a single aggregation.

    Items are distinct UPCs, or SKUs for Maurices, whose lines have no UPC.
    Orders without lines or allocations keep their row with zeros. Counting
    distinct items shuffles one row per order and item with the keys, so give
    only ``source_id`` where the header columns are at hand elsewhere.
    """
    got = F.col("allocated")
    item = F.when(F.col("route") == "MS", F.col("sku")).otherwise(F.col("upc"))
    qty = F.when(got, F.col("qty"))
    copies = F.col("copies") if "copies" in allocations.columns else F.lit(1)
    amount = F.col("unit_price") * qty * copies
    store = F.when(got, F.col("store_number"))
    return allocations.groupBy(*keys).agg(
        F.count_distinct(F.when(got, item)).cast("int").alias("total_items"),
        F.coalesce(F.sum(qty * copies), F.lit(0)).cast("long").alias("total_qty"),
        F.coalesce(F.sum(amount), F.lit(0)).cast(AMOUNT).alias("total_amount"),
        F.count_if("has_line").alias("line_rows"),
        F.count_if(got).alias("allocated_rows"),
        F.count_if(store.isNotNull() & store.try_cast("int").isNull()).alias("bad_stores"),
    )


def _header(totals: DataFrame, report: str, *columns: Column | str) -> DataFrame:
    return totals.select(
        header_key(report).alias("header_id"),
        "source_id",
        "company",
        "po_type",
        "customer_po",
        "date_downloaded",
        *columns,
        *(["version"] if "version" in totals.columns else []),
    )


def details_header(totals: DataFrame) -> DataFrame:
    return _header(
        totals,
        "details",
        "downloaded_at",
        "total_items",
        "total_qty",
        "start_date",
        "cancel_date",
        "department",
    )


def style_color_report(allocations: DataFrame) -> DataFrame:
    """Quantity by style and color; the Kohl's pre-pack route also splits by UPC."""
    return (
        _ordered(allocations)
        .groupBy(
            "source_id",
            "customer_po",
            "style",
            "color",
            F.when(F.col("route") == "KP", F.col("upc")).alias("upc"),
        )
        .agg(F.sum("qty").alias("qty_ordered"))
        .select(header_key("style_color").alias("header_id"), "*")
    )


def style_color_header(headers: DataFrame) -> DataFrame:
    return _header(
        headers, "style_color", "start_date", F.col("cancel_date").alias("complete_date")
    )


def store_report(allocations: DataFrame) -> DataFrame:
    """Quantity by store.

    Stores are grouped as sent and printed as numbers, so 0045 and 45 stay
    apart. Maurices has one row per order, also when the order has no line.
    """
    single = F.col("route") == "MS"
    counted = allocations.filter(single | (F.col("allocated") & (F.col("qty") > 0)))
    return (
        counted.groupBy(
            "source_id",
            "customer_po",
            F.when(single, F.col("division_store"))
            .otherwise(F.col("store_number"))
            .alias("store_text"),
        )
        .agg(F.sum("qty").alias("store_qty"))
        .select(
            header_key("store").alias("header_id"),
            "source_id",
            "customer_po",
            F.col("store_text").try_cast("int").alias("store_number"),
            "store_qty",
        )
    )


def single_store_total(allocations: DataFrame) -> DataFrame:
    """The Maurices store report: the header's store with the order's total."""
    return store_report(allocations.filter("route = 'MS'"))


def single_store_header(allocations: DataFrame, kept: Sequence[str]) -> DataFrame:
    """One row per Maurices order: header columns, its store, its total and its lines."""
    single = allocations.filter("route = 'MS'")
    totals = single.groupBy(*kept, "division_store").agg(
        F.sum("qty").alias("store_qty"), F.count_if("has_line").alias("line_rows")
    )
    return totals.select(
        header_key("store").alias("header_id"),
        *kept,
        F.col("division_store").try_cast("int").alias("store_number"),
        "store_qty",
        "line_rows",
    )


def store_header(totals: DataFrame) -> DataFrame:
    return _header(
        totals,
        "store",
        F.col("total_qty").alias("order_qty_total"),
        "start_date",
        F.col("cancel_date").alias("complete_date"),
        "department",
    )


def style_color_size_report(allocations: DataFrame) -> DataFrame:
    """Quantity and amount by style, color, size, codes and prices."""
    keys = ["style", "color", "size", "upc", "sku", "unit_price", "retail_price"]
    return (
        _ordered(allocations)
        .groupBy("source_id", "customer_po", *keys)
        .agg(F.sum("qty").alias("qty"))
        .select(
            header_key("style_color_size").alias("header_id"),
            "*",
            (F.col("unit_price") * F.col("qty")).cast(AMOUNT).alias("amount"),
        )
    )


def style_color_size_header(totals: DataFrame) -> DataFrame:
    return _header(
        totals,
        "style_color_size",
        F.col("total_qty").alias("total_order_qty"),
        F.col("total_amount").alias("total_order_amount"),
        "start_date",
        F.col("cancel_date").alias("complete_date"),
        "department",
    )


def daily_log(headers: DataFrame) -> DataFrame:
    """One row per processed order, whatever its route."""
    return headers.select(
        "company",
        "customer_po",
        F.to_date("downloaded_at").alias("download_date"),
        "version",
    )
