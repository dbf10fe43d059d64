"""Bills of materials: the component array of a pack line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.functions.texts import objects, safe_int

COMPONENT = (
    "VendorItemNumber string, ColorDescription string, SizeDescription string, "
    "GTIN string, BuyerPartNumber string, ProductId string, Quantity string"
)


def components(text: Column) -> Column:
    """Component structs in document order; a lone object becomes one component.

    NULL where the text is no array or object: such a line is not a pack. A
    component that is not an object is left out.
    """
    return F.filter(objects(text, f"struct<{COMPONENT}>"), lambda b: b.isNotNull())


def pack_units(bom: Column) -> Column:
    """Total component quantity, NULL when no component has a whole number."""
    return F.aggregate(
        F.transform(bom, lambda b: safe_int(b["Quantity"])),
        F.lit(None).cast("long"),
        lambda total, n: F.coalesce(total + n, total, n.cast("long")),
    )


def pack_style(vendor_item: Column, bom: Column) -> Column:
    """Vendor item with the pack total, such as ``A1234 P12``."""
    return F.concat(vendor_item, F.lit(" P"), pack_units(bom).cast("string"))


def first_color(bom: Column) -> Column:
    return F.get(bom, F.lit(0))["ColorDescription"]


def signature(bom: Column) -> Column:
    """Canonical text of a pack's composition, independent of component order."""

    def text(value: Column) -> Column:
        return F.coalesce(value, F.lit(""))

    keyed = F.transform(
        bom,
        lambda b: F.struct(
            text(b["VendorItemNumber"]).alias("style"),
            text(b["SizeDescription"]).alias("size"),
            text(b["ColorDescription"]).alias("color"),
            text(b["Quantity"]).alias("qty"),
        ),
    )
    return F.array_join(
        F.transform(
            F.array_sort(keyed),
            lambda b: F.concat_ws("|", b["style"], b["color"], b["size"], b["qty"]),
        ),
        "~",
    )
