"""From staging rows to orders and their lines, with one pass over the document.

The document is read with typed ``from_json``: fields whose shape varies stay
text at first, so an array and a single object take the same path and number
text keeps its exact spelling. Orders leave the parse through a generator, not
through a filter, because a filter on parsed fields would be pushed below the
parse and run it twice; behind the generator any filter is free to go.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.texts import compact_date, container, objects, scalar
from orderloom.routes import ALL_ROUTES, PRINTED_TYPE, by_route, route_of

ORDER_DOCUMENT = """struct<PurchaseOrderHeader: struct<
  PurchaseOrderNumber: string,
  CompanyCode: string,
  PurchaseOrderTypeCode: string,
  PurchaseOrder: struct<
    ReferencePOType: string,
    DepartmentNumber: string,
    RequestedShipDate: string,
    DoNotDeliveryBefore: string,
    CancelDate: string,
    DivisionIdentifier: string,
    PurchaseOrderDetails: string>>>
"""

# Document field -> column, for the scalar fields of a line.
LINE_FIELDS = {
    "LineItemId": "line_item_id",
    "VendorItemNumber": "vendor_item_number",
    "ColorDescription": "color_description",
    "SizeDescription": "size_description",
    "GTIN": "gtin",
    "ProductId": "product_id",
    "BuyerPartNumber": "buyer_part_number",
    "UOMTypeCode": "uom_type_code",
    "UnitPrice": "unit_price_text",
    "SalesPrice": "sales_price_text",
    "RetailPrice": "retail_price_text",
    "Pack": "pack_text",
    "PackSize": "pack_size_text",
    "Quantity": "quantity_text",
}
LINE_DOCUMENT = (
    "struct<"
    + ", ".join(f"{field}: string" for field in LINE_FIELDS)
    + ", VendorSizeDescription: string, DestinationInfo: struct<SDQ: string>, BOMDetails: string>"
)

HEADER_COLUMNS = [
    "source_id",
    "route",
    "company",
    "po_type",
    "customer_po",
    "date_downloaded",
    "downloaded_at",
    "start_date",
    "cancel_date",
    "department",
    "division_store",
]


def inbound_scan(inbound: DataFrame) -> DataFrame:
    """Purchase orders that arrived whole. Both tests reach the Parquet scan."""
    return inbound.filter(
        (F.col("transaction_type") == "850") & (F.col("status") == "Downloaded")
    )


def through_generator(frame: DataFrame, keep: Column | None = None) -> DataFrame:
    """The rows that ``keep`` holds for, computed once, whatever is filtered later."""
    one = F.array(F.struct(*frame.columns))
    return frame.select(F.explode(one if keep is None else F.when(keep, one)).alias("row")).select(
        "row.*"
    )


def _read_whole(payload: Column, kind: str) -> Column:
    """The payload's values as ``d``, and whether there is nothing but one value.

    Spark's reader stops at the end of a value, whatever follows. So the payload
    is read inside a larger document that ends with the payload's own hash: text
    that follows the value breaks the frame, a second value makes two.
    """
    frame = F.concat(
        F.lit('{"d":['), payload, F.lit('],"end":'), F.xxhash64(payload).cast("string"), F.lit("}")
    )
    schema = f"d array<{kind}>, end bigint, unreadable string"
    return F.from_json(frame, schema, {"columnNameOfCorruptRecord": "unreadable"})


def _is_whole(read: str, payload: Column) -> Column:
    value = F.get(F.col(f"{read}.d"), F.lit(0))
    return F.coalesce(
        F.col(f"{read}.unreadable").isNull()
        & (F.col(f"{read}.end") == F.xxhash64(payload))
        & (F.size(f"{read}.d") == 1)
        & value.isNotNull(),
        F.lit(False),
    )


def valid_json(inbound: DataFrame) -> DataFrame:
    """Rows whose payload is one JSON array or object and nothing else."""
    payload = F.col("json")
    read = inbound.withColumn("_read", _read_whole(payload, "string"))
    kept = _is_whole("_read", payload) & payload.rlike(r"^\s*[\[{]")
    return through_generator(read, kept).drop("_read")


def parse_orders(inbound: DataFrame) -> DataFrame:
    """One row per staging row: header fields, route, and the lines as text.

    ``readable`` tells whether the payload is one JSON object of the expected
    shape and nothing else; ``route`` is NULL when no report covers the order.
    """
    extra = [c for c in ("arrival_day",) if c in inbound.columns]
    parsed = inbound.select(
        "id",
        "created",
        "company_code",
        *extra,
        "json",
        _read_whole(F.col("json"), ORDER_DOCUMENT).alias("read"),
    ).select(
        "*",
        _is_whole("read", F.col("json")).alias("readable"),
        F.get("read.d", F.lit(0)).alias("doc"),
    )
    header = "doc.PurchaseOrderHeader"
    order = f"{header}.PurchaseOrder"
    fields = parsed.select(
        F.col("id").alias("source_id"),
        F.col("created").alias("downloaded_at"),
        "company_code",
        *extra,
        "readable",
        scalar(f"{header}.PurchaseOrderNumber").alias("customer_po"),
        scalar(f"{header}.CompanyCode").alias("company"),
        scalar(f"{header}.PurchaseOrderTypeCode").alias("type_code"),
        scalar(f"{order}.ReferencePOType").alias("reference_type"),
        scalar(f"{order}.DepartmentNumber").alias("department"),
        F.col(f"{order}.RequestedShipDate").alias("ship_text"),
        F.col(f"{order}.DoNotDeliveryBefore").alias("not_before_text"),
        F.col(f"{order}.CancelDate").alias("cancel_text"),
        scalar(f"{order}.DivisionIdentifier").alias("division_store"),
        container(F.col(f"{order}.PurchaseOrderDetails")).alias("details_text"),
    )
    route = F.when(
        F.col("readable"),
        route_of(F.col("company_code"), F.col("reference_type"), F.col("type_code")),
    )
    return through_generator(fields.withColumn("route", route))


def header_fields(parsed: DataFrame) -> DataFrame:
    """Header columns of the parsed orders, dates and printed order type included."""
    kept = ["source_id", "route", "company", "customer_po", "downloaded_at", "department"]
    printed = {code: F.lit(text) for code, text in PRINTED_TYPE.items()}
    rest = ("readable", "company_code", "arrival_day", "details_text")
    return parsed.select(
        *kept,
        "division_store",
        F.coalesce(
            by_route(printed),
            by_route(
                {"KP MS": F.col("reference_type"), "AK AS BB BS": F.col("type_code")}
            ),
        ).alias("po_type"),
        F.to_date("downloaded_at").alias("date_downloaded"),
        compact_date(
            F.when(F.col("route") == "MS", F.col("not_before_text")).otherwise(F.col("ship_text"))
        ).alias("start_date"),
        compact_date(F.col("cancel_text")).alias("cancel_date"),
        *[c for c in rest if c in parsed.columns],
    )


def routed_headers(inbound: DataFrame, routes: Iterable[str] = ALL_ROUTES) -> DataFrame:
    """Header columns of the orders that a route covers."""
    routed = parse_orders(inbound).filter(F.col("route").isin(list(routes)))
    return header_fields(routed).select(*HEADER_COLUMNS)


def listed_orders(inbound: DataFrame, routes: Iterable[str] | None = ALL_ROUTES) -> DataFrame:
    """Orders with their lines as one array, ``line_list``, in document order.

    An element that is not an object is NULL in its place. With ``routes`` None
    every staging row comes along, also those that no report covers.
    """
    parsed = parse_orders(inbound)
    if routes is not None:
        parsed = parsed.filter(F.col("route").isin(list(routes)))
    rows = header_fields(parsed)
    read = F.when(F.col("route").isNotNull(), F.col("details_text"))
    return rows.withColumn("line_list", objects(read, LINE_DOCUMENT)).drop("details_text")


def unnest_lines(listed: DataFrame) -> DataFrame:
    """One row per line of listed orders, their other columns repeated on each.

    ``line_pos`` counts from 0. An order without lines keeps one row whose
    ``has_line`` is false, so that ``line_pos = 0`` finds every order once. An
    element that is not an object is such a row too, in its place among the lines.
    Lists beside ``line_list`` are unnested with it: ``store_lists`` to ``stores``,
    ``store_lists_x`` to ``stores_x``.
    """
    lists = {
        c: c.replace("store_lists", "stores") for c in listed.columns if c.startswith("store_lists")
    }
    kept = [c for c in listed.columns if c not in ("line_list", *lists)]
    zipped = F.arrays_zip("line_list", *lists) if lists else F.col("line_list")
    line = "element.line_list" if lists else "element"
    rows = listed.select(*kept, zipped.alias("zipped"))
    empty = F.array(F.lit(None).cast(rows.schema["zipped"].dataType.elementType))
    unnested = rows.select(
        *kept,
        F.posexplode(F.when(F.size("zipped") > 0, F.col("zipped")).otherwise(empty)).alias(
            "line_pos", "element"
        ),
    )
    return unnested.select(
        *kept,
        "line_pos",
        F.col(line).isNotNull().alias("has_line"),
        *[scalar(f"{line}.{field}").alias(name) for field, name in LINE_FIELDS.items()],
        F.col(f"{line}.VendorSizeDescription").alias("vendor_size_text"),
        container(F.col(f"{line}.DestinationInfo.SDQ")).alias("sdq_text"),
        container(F.col(f"{line}.BOMDetails")).alias("bom_text"),
        *[F.col(f"element.{c}").alias(name) for c, name in lists.items()],
    )


def order_lines(inbound: DataFrame, routes: Iterable[str] = ALL_ROUTES) -> DataFrame:
    """Routed orders unnested to lines, header columns repeated on each."""
    listed = listed_orders(inbound, routes)
    return unnest_lines(listed.select(*HEADER_COLUMNS, "line_list"))


def headers(lines: DataFrame) -> DataFrame:
    """One row per order, from its first line row."""
    return lines.filter("line_pos = 0").select(*HEADER_COLUMNS)


def header_key(report: str, source_id: Column | str = "source_id") -> Column:
    """Key that ties details to their header: the same on every run and retry."""
    column = F.col(source_id) if isinstance(source_id, str) else source_id
    return F.concat(F.lit(f"{report}-"), column.cast("string"))
