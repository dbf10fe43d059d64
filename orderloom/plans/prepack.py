"""The pre-pack summary: every distinct pack composition of an order, by component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.bom import components, first_color, pack_style, pack_units, signature
from orderloom.functions.sizes import cut_suffix, plain_text, second_entry
from orderloom.functions.texts import decimal_text_int, safe_int, scalar
from orderloom.operators.attributes import is_pack
from orderloom.operators.orders import HEADER_COLUMNS, header_key, through_generator
from orderloom.routes import PREPACK_ROUTES, by_route

ROUTES = [route for routes in PREPACK_ROUTES.values() for route in routes]
PACK_COLUMNS = ["vendor_item_number", "gtin", "product_id", "buyer_part_number", "bom"]


def pack_lines(lines: DataFrame) -> DataFrame:
    """Pack lines of the routes that report pre-packs, with their components.

    The components are read once: what is no pack leaves through a generator.
    """
    routed = lines.filter(F.col("route").isin(ROUTES))
    if "bom" in lines.columns:
        return routed.filter(is_pack())
    return through_generator(routed.withColumn("bom", components(F.col("bom_text"))), is_pack())


def bom_gate(lines: DataFrame) -> DataFrame:
    """Orders with at least one pack line; only those get a summary header."""
    return pack_lines(lines).select(*HEADER_COLUMNS).distinct()


def bom_signature(packs: DataFrame) -> DataFrame:
    return packs.withColumn("bom_signature", signature(F.col("bom")))


def bom_dedupe(packs: DataFrame) -> DataFrame:
    """The first line of each distinct composition of an order.

    A minimum rather than a window: the lines of an order sit in one task after
    unnesting, so the partial minimum drops repeats before anything is shuffled.
    """
    first = F.min(F.struct("line_pos", *PACK_COLUMNS)).alias("first")
    return (
        bom_signature(packs)
        .groupBy("source_id", "customer_po", "route", "bom_signature")
        .agg(first)
        .select("source_id", "customer_po", "route", "bom_signature", "first.*")
    )


def bom_components(unique: DataFrame) -> DataFrame:
    """One row per component of each remaining pack."""
    return unique.select("*", F.posexplode("bom").alias("component_pos", "component"))


def prepack_summary(lines: DataFrame) -> DataFrame:
    """Pack and component columns, as each company fills them."""
    unique = bom_dedupe(pack_lines(lines))
    bom, item = F.col("bom"), F.col("vendor_item_number")
    gtin, product, buyer = F.col("gtin"), F.col("product_id"), F.col("buyer_part_number")
    labelled = unique.select(
        "source_id",
        "customer_po",
        "route",
        "bom",
        by_route({"KP": gtin, "AK AS": item, "MS": product}).alias("prepack_number"),
        by_route({"KP": buyer, "AK AS": gtin, "MS": product}).alias("prepack_sku"),
        by_route({"BB": pack_style(item, bom)}).alias("prepack_style"),
        by_route({"BB": first_color(bom)}).alias("prepack_color"),
        by_route({"BB": F.concat(F.lit("PPK"), pack_units(bom).cast("string"))}).alias(
            "prepack_size"
        ),
        by_route({"KP BB": gtin}).alias("prepack_upc"),
    )
    part = F.col("component")
    parts = bom_components(labelled).select(
        "*",
        second_entry(part["SizeDescription"]).alias("cut_second"),
        plain_text("component.SizeDescription").alias("cut_plain"),
    )
    style = scalar("component.VendorItemNumber")
    return parts.select(
        header_key("prepack").alias("header_id"),
        "source_id",
        "customer_po",
        "prepack_number",
        "prepack_sku",
        "prepack_style",
        "prepack_color",
        "prepack_size",
        "prepack_upc",
        F.when(
            F.col("route") == "MS",
            F.concat(style, F.lit(" "), cut_suffix(F.col("cut_second"), F.col("cut_plain"))),
        )
        .otherwise(style)
        .alias("component_style"),
        scalar("component.ColorDescription").alias("component_color"),
        F.col("cut_plain").alias("component_size"),
        by_route({"KP BB": scalar("component.GTIN")}).alias("component_upc"),
        by_route(
            {
                "KP": scalar("component.BuyerPartNumber"),
                "AK AS": scalar("component.GTIN"),
                "MS": scalar("component.ProductId"),
            }
        ).alias("component_sku"),
        F.when(F.col("route") == "MS", decimal_text_int(part["Quantity"]))
        .otherwise(safe_int(part["Quantity"]))
        .alias("component_qty"),
    )


def prepack_header(gated: DataFrame) -> DataFrame:
    return gated.select(
        header_key("prepack").alias("header_id"),
        "source_id",
        "company",
        "po_type",
        "customer_po",
        "date_downloaded",
        *(["version"] if "version" in gated.columns else []),
    )
