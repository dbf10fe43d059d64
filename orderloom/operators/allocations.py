"""Store allocations of a line: which store gets how many."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import sdq
from orderloom.functions.sdq import entries, pairs, segments
from orderloom.functions.texts import (
    container,
    decimal_text_int,
    has_gap,
    once,
    safe_decimal,
    scalar,
)
from orderloom.operators.attributes import ATTRIBUTES
from orderloom.operators.orders import HEADER_COLUMNS
from orderloom.routes import (
    KEEP_UNALLOCATED_ROUTES,
    OBJECT_ONLY_ROUTES,
    STRICT_KEYS,
)

LINE_COLUMNS = [
    *HEADER_COLUMNS,
    "line_pos",
    "has_line",
    *[c for c in ATTRIBUTES if c != "line_qty"],
]
AMOUNT = "decimal(29,2)"
# The flags and totals that one pass over the lines of an order gives.
TOTALS = [
    "total_items",
    "total_qty",
    "total_amount",
    "line_rows",
    "allocated_rows",
    "bad_stores",
    "bad_lines",
    "bad_segments",
    "repeated_keys",
]


def sdq_segments(lines: DataFrame) -> DataFrame:
    """One row per segment of each line: its position and its key/value map."""
    return lines.select(
        "*", F.posexplode(segments(F.col("sdq_text"))).alias("segment", "keys")
    ).filter("keys IS NOT NULL")


def sdq_fields(lines: DataFrame) -> DataFrame:
    """One row per used key of each line: segment, index and value."""
    return lines.select("*", F.inline(entries(segments(F.col("sdq_text")))))


def sdq_pairs(lines: DataFrame) -> DataFrame:
    """One row per store of each line with its quantity, paired inside the segment."""
    return lines.select("*", F.inline(pairs(segments(F.col("sdq_text")))))


def positive_qty(paired: DataFrame) -> DataFrame:
    return paired.filter(F.col("qty") > 0)


def lines_without_sdq(lines: DataFrame) -> DataFrame:
    """Lines that are kept in the details although nothing is allocated."""
    kept = F.col("has_line") & F.col("route").isin(KEEP_UNALLOCATED_ROUTES)
    return lines.filter(kept & segments(F.col("sdq_text")).isNull())


def _kind(pairing: str | None) -> str:
    """Type of ``stores``: the details of the original joins count copies, their sums are long."""
    rest = {None: "qty: int", "details": "qty: int, copies: bigint"}.get(pairing, "qty: bigint")
    return f"array<struct<segment: int, store_number: string, {rest}>>"


def _one(store: Column, qty: Column, pairing: str | None = None) -> Column:
    copies = [F.lit(1).cast("long").alias("copies")] if pairing == "details" else []
    segment = F.lit(None).cast("int").alias("segment")
    one = F.struct(segment, store.alias("store_number"), qty.alias("qty"), *copies)
    return F.array(one).cast(_kind(pairing))


def header_store() -> Column:
    """The header's single store with the line's own quantity."""
    return _one(F.col("division_store"), F.col("line_qty"))


def _stores(
    has_line: Column, maps: Column, line_qty: Column, paired: Column, pairing: str | None = None
) -> Column:
    """The allocations of one line, whatever its route.

    Maurices sends one store per order and the quantity on the line; lines
    without allocations stay with NULLs where the route keeps them; the rest
    come paired.
    """
    unallocated = F.col("route").isin(KEEP_UNALLOCATED_ROUTES) & maps.isNull()
    none = _one(F.lit(None).cast("string"), F.lit(None).cast("int"), pairing)
    return (
        F.when(~has_line, F.lit(None).cast(_kind(pairing)))
        .when(F.col("route") == "MS", _one(F.col("division_store"), line_qty, pairing))
        .when(unallocated, none)
        .otherwise(paired)
    )


def line_stores(attributed: DataFrame) -> DataFrame:
    """Add ``stores`` to unnested lines: their allocations, without any join."""
    read = attributed.withColumn("maps", segments(F.col("sdq_text")))
    maps = F.col("maps")
    stores = _stores(F.col("has_line"), maps, F.col("line_qty"), sdq.positive_pairs(maps))
    return read.withColumn("stores", stores).drop("maps")


def _upc(line: Column) -> Column:
    return scalar(
        F.when(F.col("route").isin("KB", "KS"), line["GTIN"]).when(
            F.col("route") != "MS", line["ProductId"]
        )
    )


def _pairing_key(line: Column, report: str) -> Column:
    """What lines must share to pair in the report's own join, NULL when a part is missing.

    One text, with the length before each part but the last, so that no two keys read alike.
    """
    keys = STRICT_KEYS[report]
    parts = {"line": line["LineItemId"], "style": line["VendorItemNumber"], "upc": _upc(line)}
    told = []
    for part, value in parts.items():
        used = F.col("route").isin([r for r, named in keys.items() if part in named])
        shown = F.when(used, value if part == "upc" else scalar(value)).otherwise(F.lit(""))
        sized = once(shown, lambda v: F.concat(F.length(v).cast("string"), F.lit(":"), v))
        told.append(shown if part == "upc" else sized)
    return F.concat(*told)


def read_segments(listed: DataFrame) -> DataFrame:
    """Add ``map_lists``: the segment maps of every line of listed orders."""
    maps = F.transform(
        "line_list", lambda line: segments(container(line["DestinationInfo"]["SDQ"]))
    )
    return listed.withColumn("map_lists", maps)


def pair_lists(read: DataFrame, pairing: str | None = None, name: str = "store_lists") -> DataFrame:
    """Add the allocations of every line, paired inside the order's own row.

    By default a store takes the quantity of its own line and segment. With
    ``pairing`` the name of a report, it takes those of all lines that share the
    key of that report's original join. The lines of a document are one row
    here, so neither way needs a join or a shuffle; a line looks only at the
    lines of its key.
    """
    lists, rows = ["line_list", "map_lists"], read

    def legible(line: Column) -> Column:
        """Some of the original joins read lone objects alone."""
        return ~F.col("route").isin(OBJECT_ONLY_ROUTES) | line["DestinationInfo"]["SDQ"].startswith("{")

    if pairing is not None:
        keys = F.transform("line_list", lambda x: F.when(legible(x), _pairing_key(x, pairing)))
        rows, lists = read.withColumn("keys", keys), [*lists, "keys"]

    def stores(x: Column) -> Column:
        line, maps = x["line_list"], x["map_lists"]
        if pairing is None:
            paired = sdq.positive_pairs(maps)
        else:
            partners = F.filter("map_lists", lambda _, j: F.get("keys", j) == x["keys"])
            paired = F.when(
                legible(line), sdq.matched_pairs(maps, partners, pairing != "details")
            )
        qty = decimal_text_int(line["Quantity"])
        return _stores(line.isNotNull(), maps, qty, paired, pairing)

    return rows.withColumn(name, F.transform(F.arrays_zip(*lists), stores)).drop("keys")


def totals_in_place(
    paired: DataFrame, name: str = "store_lists", summed: bool = False
) -> Column:
    """A struct of all header totals and flags of an order, from its lists alone.

    Items are distinct UPCs, or SKUs for Maurices, whose lines have no UPC.
    Orders without lines or allocations have zeros. Quantities and lines are
    added up inside the order's row, so nothing is shuffled. With ``summed``
    the struct has the quantity and the amount alone.
    """
    kinds = paired.schema[name].dataType.elementType.elementType.names
    zipped = F.arrays_zip("line_list", name, "map_lists")

    def added(stores: Column) -> Column:
        def step(total: Column, x: Column) -> Column:
            times = x["copies"] if "copies" in kinds else F.lit(1).cast("long")
            return total + F.coalesce(x["qty"].cast("long") * times, F.lit(0).cast("long"))

        return F.aggregate(stores, F.lit(0).cast("long"), step)

    def items(x: Column) -> Column:
        item = F.when(F.col("route") == "MS", scalar(x["line_list"]["ProductId"])).otherwise(
            _upc(x["line_list"])
        )
        return F.when(F.size(x[name]) > 0, item)

    def of_line(x: Column) -> Column:
        price = safe_decimal(scalar(x["line_list"]["UnitPrice"]))
        item = [] if summed else [items(x).alias("item")]
        return once(
            added(x[name]),
            lambda qty: F.struct(
                *item, qty.alias("qty"), (price * qty).cast(AMOUNT).alias("amount")
            ),
        )

    def count(column: str, test) -> Column:
        return F.coalesce(F.size(F.filter(column, test)), F.lit(0)).cast("long")

    def sum_of(values: Column, kind: str) -> Column:
        zero = F.lit(0).cast(kind)
        return F.coalesce(
            F.aggregate(values, zero, lambda t, v: (t + F.coalesce(v, zero)).cast(kind)), zero
        )

    stores = F.filter(
        F.flatten(F.transform(F.filter(name, lambda s: s.isNotNull()), lambda s: s["store_number"])),
        lambda n: n.isNotNull(),
    )

    def total(lines: Column) -> Column:
        sums = [
            sum_of(lines["qty"], "long").alias("total_qty"),
            sum_of(lines["amount"], AMOUNT).alias("total_amount"),
        ]
        if summed:
            return F.struct(*sums)
        named = F.filter(lines["item"], lambda i: i.isNotNull())
        return F.struct(
            F.coalesce(F.size(F.array_distinct(named)), F.lit(0)).alias("total_items"),
            *sums,
            count("line_list", lambda x: x.isNotNull()).alias("line_rows"),
            sum_of(
                F.transform(name, lambda s: F.size(s).cast("long")), "long"
            ).alias("allocated_rows"),
            F.coalesce(
                F.size(F.filter(stores, lambda n: n.try_cast("int").isNull())), F.lit(0)
            ).cast("long").alias("bad_stores"),
            has_gap(F.col("line_list")).alias("bad_lines"),
            F.coalesce(F.exists("map_lists", lambda m: has_gap(m)), F.lit(False)).alias(
                "bad_segments"
            ),
            F.coalesce(F.exists("map_lists", sdq.repeated_numbers), F.lit(False)).alias(
                "repeated_keys"
            ),
        )

    # The lines are walked once; what they give is added up from there.
    return once(F.transform(zipped, of_line), total)


def allocations(stored: DataFrame, stores: str = "stores") -> DataFrame:
    """Lines unnested to stores.

    An order or line that yields nothing stays as one row with ``allocated``
    false, so header totals need no second pass over the documents.
    """
    fields = stored.schema[stores].dataType.elementType.names
    extra = [F.coalesce("a.copies", F.lit(1)).alias("copies")] if "copies" in fields else []
    return stored.select(*LINE_COLUMNS, F.explode_outer(stores).alias("a")).select(
        *LINE_COLUMNS,
        F.col("a").isNotNull().alias("allocated"),
        "a.store_number",
        "a.qty",
        *extra,
    )
