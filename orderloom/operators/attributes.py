"""Per-route meaning of a line: style, color, size, codes, prices and packs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.bom import components, first_color, pack_style
from orderloom.functions.sizes import cut_suffix, plain_text, second_entry, size_fallback
from orderloom.functions.texts import decimal_text_int, safe_decimal, safe_int
from orderloom.routes import by_route

ATTRIBUTES = [
    "style",
    "color",
    "size",
    "upc",
    "sku",
    "uom",
    "unit_price",
    "retail_price",
    "inner_pack",
    "qty_per_inner_pack",
    "line_qty",
]


def is_pack(bom: Column | str = "bom") -> Column:
    """The line carries a bill of materials, an array or an object."""
    return (F.col(bom) if isinstance(bom, str) else bom).isNotNull()


def pack_size_label(route: Column | str = "route") -> Column:
    """Size printed for a pack; the Kohl's pre-pack route prints it on every line."""
    return by_route({"KP AK AS BB": F.lit("PPK"), "MS": F.lit("CA")}, route)


def line_attributes(lines: DataFrame) -> DataFrame:
    """Add the report columns of every line; catalogue values come later.

    Belk colors and sizes of non-packs are the document's own here and give
    way to the catalogue in ``catalogue_override``.
    """
    rows = lines.select(
        "*",
        components(F.col("bom_text")).alias("bom"),
        second_entry(F.col("vendor_size_text")).alias("size_second"),
        plain_text("vendor_size_text").alias("size_plain"),
    )
    second, plain = F.col("size_second"), F.col("size_plain")
    pack, bom, route = is_pack(), F.col("bom"), F.col("route")
    vendor_item, product = F.col("vendor_item_number"), F.col("product_id")
    color = F.col("color_description")
    packed_style = F.when(pack, pack_style(vendor_item, bom)).otherwise(vendor_item)
    bom_color = F.coalesce(first_color(bom), color)
    inner, per_inner = safe_int(F.col("pack_text")), safe_int(F.col("pack_size_text"))
    return rows.select(
        "*",
        by_route(
            {
                "KB KS KP BS": vendor_item,
                "AK AS BB": packed_style,
                "MS": F.when(pack, product).otherwise(
                    F.concat(vendor_item, F.lit(" "), cut_suffix(second, plain))
                ),
            }
        ).alias("style"),
        by_route(
            {"KB KS AK AS BS": color, "KP": first_color(bom), "MS BB": bom_color}
        ).alias("color"),
        F.when((route == "KP") | (pack & route.isin("AK", "AS", "BB", "MS")), pack_size_label())
        .otherwise(
            by_route(
                {
                    "KB KS AK AS": F.col("size_description"),
                    "MS": size_fallback(second, plain),
                    "BB BS": second,
                }
            )
        )
        .alias("size"),
        by_route({"KB KS": F.col("gtin"), "KP AK AS BB BS": product}).alias("upc"),
        by_route({"KB KS KP": F.col("buyer_part_number"), "AK AS MS": product}).alias("sku"),
        F.col("uom_type_code").alias("uom"),
        safe_decimal(F.col("unit_price_text")).alias("unit_price"),
        safe_decimal(
            F.when(route == "MS", F.col("retail_price_text")).otherwise(F.col("sales_price_text"))
        ).alias("retail_price"),
        by_route({"KB KS KP": inner, "BB": F.when(pack, inner)}).alias("inner_pack"),
        by_route({"KB KS KP": per_inner, "BB": F.when(pack, per_inner)}).alias(
            "qty_per_inner_pack"
        ),
        F.when(route == "MS", decimal_text_int(F.col("quantity_text"))).alias("line_qty"),
    )
