"""Purchase-order documents derived from the retail tables.

Every order of ``orders`` becomes one transmission whose document carries the
order's ``lineitem`` rows; every rule is plain arithmetic on the base columns,
so a SQL engine can compute the expected reports without touching JSON. The
document text is put together by SQL expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The vocabulary of the derived documents.
COMPANIES = ["Kohls", "ARULA", "Maurices", "BELK"]
KOHLS_TYPES = ["BULK", "PACK BY STORE", "PREPACK", "COMPOUND PREPACK"]
ARULA_TYPES = ["KN", "SA"]
BELK_TYPES = ["BK", "RL", "SA"]
SIZES = ["S", "M", "L"]
VENDOR_SIZES = ["S REGULAR", "M TALL", "L"]

# The columns of a numbered line, and how its document's text names them.
LINE_COLUMNS = ["line_no", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"]
NUMBER, PART, SUPP, POSITION, QUANTITY = (f"entry.{c}" for c in LINE_COLUMNS)
KEY = "o_orderkey"
COMPANY = "o_custkey % 4"


def _pick(values: list[str], index: str) -> str:
    """The value at an index from 0; the last one where the index is null."""
    listed = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({listed}), coalesce(cast({index} as int) + 1, -1))"


def _texts(**fields: str) -> str:
    """``"name":"value"`` members, comma-separated, for text-valued fields."""
    parts, before = [], ""
    for name, value in fields.items():
        parts += [f"""'{before}"{name}":"'""", value]
        before = '",'
    return ", ".join([*parts, """'"'"""])


def _object(*parts: str) -> str:
    """A JSON object of member lists; a NULL part is left out."""
    return f"concat('{{', concat_ws(',', {', '.join(parts)}), '}}')"


def _member(name: str, json: str) -> str:
    return f"""concat('"{name}":', {json})"""


def _money(cents: str) -> str:
    return f"concat(({cents}) div 100, '.', lpad(({cents}) % 100, 2, '0'))"


def _retail(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the position that becomes their LineItemId."""
    position = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"
    )
    columns = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"]
    lines = _retail(spark, sf_dir, "lineitem").select(*columns, "l_extendedprice", "l_shipdate")
    # A line is a few bytes here and some hundred as text. With the number of
    # partitions given they are not joined by the size they have before.
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (
        lines.repartition(partitions, "l_orderkey")
        .withColumn("line_no", F.row_number().over(position))
        .selectExpr(
            "l_orderkey",
            "line_no",
            "l_partkey",
            "l_suppkey",
            "l_linenumber",
            "cast(l_quantity as bigint) as l_quantity",
        )
    )


def _sdq(segmented: str) -> str:
    """Store allocations, one object or an array of two-store segments."""
    last = f"{POSITION} % 3"

    def slot(j: int, first: int, width: int = 2, when: str = "") -> str:
        store = f"lpad(({SUPP} + {37 * j}) % 200, 4, '0')"
        qty = f"if(({PART} + {j}) % 17 = 0, 'x', cast(({QUANTITY} + {j}) % 6 as string))"
        members = _texts(**{f"SDQ{first:0{width}d}": store, f"SDQ{first + 1:0{width}d}": qty})
        return f"if({when or f'{last} >= {j}'}, concat({members}), null)"

    head = f"""concat({_texts(SDQ01="'EA'", SDQ02="'92'")})"""
    unpaired = f"""if({PART} % 5 = 0, concat({_texts(SDQ23="'0999'")}), null)"""
    # Keys of many digits, and a second spelling of the first store's number.
    odd = [slot(3, 1000000003, 2, f"{PART} % 23 = 0"), slot(4, 3, 1, f"{PART} % 31 = 0")]
    flat = _object(head, slot(0, 3), slot(1, 5), slot(2, 7), *odd, unpaired)
    first = _object(head, slot(0, 3), slot(1, 5), *odd, unpaired)
    second = f"if({last} >= 2, {_object(head, slot(2, 3))}, null)"
    no_segment = f"""if({SUPP} % 19 = 0, '"x"', null)"""
    segments = f"concat('[', concat_ws(',', {first}, {second}, {no_segment}), ']')"
    return f"if({PART} % 13 <> 0, if({segmented}, {segments}, {flat}), null)"


def _bom() -> str:
    """Pack components; odd suppliers list them last to first."""
    maurices = f"{COMPANY} = 2"

    def component(c: int) -> str:
        size = f"if({maurices}, '{VENDOR_SIZES[c % 3]}', '{SIZES[c % 3]}')"
        members = _texts(
            VendorItemNumber=f"'CS{c}'",
            ColorDescription=f"concat('C', ({PART} + {c}) % 4)",
            SizeDescription=size,
            GTIN=f"'CG{c}'",
            BuyerPartNumber=f"'CB{c}'",
            ProductId=f"'CP{c}'",
            Quantity=f"concat(1 + ({PART} + {c}) % 6, if({maurices}, '.0', ''))",
        )
        return f"if({PART} % 4 >= {c}, {_object(f'concat({members})')}, null)"

    parts = [component(c) for c in range(4)]
    forward, backward = ", ".join(parts), ", ".join(reversed(parts))
    return (
        f"concat('[', if({SUPP} % 2 = 1, concat_ws(',', {backward}), "
        f"concat_ws(',', {forward})), ']')"
    )


def _line_document() -> str:
    cents = f"{PART} % 900 + 100"
    vendor_size = f"""concat('"', {_pick(VENDOR_SIZES, f"{PART} % 3")}, '"')"""
    segmented = (
        f"{NUMBER} % 2 = 1 and (({COMPANY} = 0 and {KEY} % 4 = 1) "
        f"or ({COMPANY} = 1 and {KEY} % 2 = 0) or {COMPANY} = 3)"
    )
    packed = (
        f"({COMPANY} = 0 and {KEY} % 4 >= 2) or ({PART} % 3 = 0 and "
        f"({COMPANY} in (1, 2) or ({COMPANY} = 3 and {KEY} % 3 <> 2)))"
    )
    pack = f"if({SUPP} % 7 = 0, '', cast({POSITION} as string))"
    members = _texts(
        LineItemId=NUMBER,
        VendorItemNumber=f"concat('ST', {PART} % 40)",
        ColorDescription=f"concat('C', {SUPP} % 5)",
        SizeDescription=_pick(SIZES, f"{PART} % 3"),
        GTIN=f"concat('G', {PART})",
        ProductId=f"concat('P', {PART})",
        BuyerPartNumber=f"concat('B', {PART})",
        UOMTypeCode="'EA'",
        UnitPrice=_money(cents),
        SalesPrice=f"if({PART} % 11 = 0, '', {_money(f'({cents}) * 2')})",
        RetailPrice=_money(f"({cents}) * 2"),
        Pack=pack,
        PackSize=pack,
        Quantity=f"concat({QUANTITY}, '.0')",
    )
    return _object(
        f"concat({members})",
        _member(
            "VendorSizeDescription",
            f"""if({SUPP} % 2 = 0, concat('["x",', {vendor_size}, ']'), {vendor_size})""",
        ),
        _member("DestinationInfo", _object(_member("SDQ", _sdq(segmented)))),
        f"case when {packed} then {_member('BOMDetails', _bom())} "
        # Text that only begins like an array is no pack.
        f"""when {PART} % 17 = 3 then '"BOMDetails":"[none]"' end""",
    )


def _document() -> str:
    def day(offset: int) -> str:
        date = f"date_format(date_add(o_orderdate, {offset}), 'yyyyMMdd')"
        return f"if({KEY} % 50 = 0, 'BAD', {date})"

    def order_type(company: dict[int, str]) -> str:
        cases = " ".join(f"when {COMPANY} = {i} then {sql}" for i, sql in company.items())
        return f"case when {KEY} % 109 = 0 then 'ZZ' {cases} else 'NE' end"

    # Behind the lines of some orders stands the text of an object, which is no line.
    quoted = f"""if({KEY} % 29 = 0, ',"{{\\\\"GTIN\\\\":\\\\"Q\\\\"}}"', '')"""
    details = (
        "case when size(lines) = 1 then lines[0] "
        f"when size(lines) > 1 then concat('[', array_join(lines, ','), {quoted}, ']') end"
    )
    order = _texts(
        ReferencePOType=order_type({0: _pick(KOHLS_TYPES, f"{KEY} % 4"), 2: "'SO'"}),
        DepartmentNumber="concat('D', o_custkey % 10)",
        RequestedShipDate=day(7),
        DoNotDeliveryBefore=day(10),
        CancelDate=day(30),
        DivisionIdentifier="lpad(o_custkey % 300, 4, '0')",
    )
    header = _texts(
        PurchaseOrderNumber="concat('PO', o_custkey)",
        CompanyCode=_pick(COMPANIES, COMPANY),
        PurchaseOrderTypeCode=order_type(
            {1: _pick(ARULA_TYPES, f"{KEY} % 2"), 3: _pick(BELK_TYPES, f"{KEY} % 3")}
        ),
    )
    body = _object(f"concat({order})", _member("PurchaseOrderDetails", details))
    inner = _object(f"concat({header})", _member("PurchaseOrder", body))
    return (
        f"""concat('{{"PurchaseOrderHeader":', {inner}, """
        f"if({KEY} % 107 = 0, '', '}}'), if({KEY} % 113 = 0, ' tail', ''))"
    )


def purchase_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging table ``inbound``: one document per order.

    One shuffle by order key serves line numbering, the join and the grouping.
    Lines travel and are grouped as numbers; their text is written once the order
    is one row, so no sort or aggregate holds documents. It is written inside
    ``transform``: as columns it makes one method that the JVM never compiles.
    A few orders are deliberately unusable: other transaction types and
    statuses, cut-off documents, documents with text behind them and an order
    type nobody handles. Some lines, segments and keys are not what they should be.
    """
    orders = _retail(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey", "cast(o_orderdate as timestamp) as o_orderdate"
    )
    lines = numbered_lines(spark, sf_dir)
    rows = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").selectExpr(
        "o_orderkey",
        "o_custkey",
        "o_orderdate",
        f"if(line_no is null, null, struct({', '.join(LINE_COLUMNS)})) as entry",
    )
    grouped = (
        rows.groupBy("o_orderkey", "o_custkey", "o_orderdate")
        .agg(F.expr("sort_array(collect_list(entry)) as entries"))
        .selectExpr("*", f"transform(entries, entry -> {_line_document()}) as lines")
    )
    company = _pick(COMPANIES, COMPANY)
    return grouped.selectExpr(
        "o_orderkey + 1 as id",
        f"{_document()} as json",
        "o_orderdate as created",
        f"{company} as company_code",
        "if(o_orderkey % 101 = 0, '860', '850') as transaction_type",
        "if(o_orderkey % 103 = 0, 'Failed', 'Downloaded') as status",
    )


def _catalogued_parts(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Even parts belong to company 4, parts divisible by three also to company 1."""
    parts = _retail(spark, sf_dir, "part").select("p_partkey", *columns)
    both = parts.withColumn("company_no", F.explode(F.array(F.lit(4), F.lit(1))))
    return both.filter(
        F.when(F.col("company_no") == 4, F.col("p_partkey") % 2 == 0).otherwise(
            F.col("p_partkey") % 3 == 0
        )
    )


def catalogue_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name and an id for every part: names come in two spellings and with many ids.

    The smallest ids of BELK and ARULA are those the catalogue uses.
    """
    kind = F.col("p_partkey") % 5
    names = F.when(kind == 0, "BELK").when(kind == 1, "Belk").when(kind == 2, "ARULA")
    ids = F.when(kind < 2, "CO4").when(kind < 4, "CO1").otherwise("CX")
    suffix = F.when(F.col("p_partkey") % 3 == 0, "").otherwise(F.concat(F.lit("-"), "p_partkey"))
    return _retail(spark, sf_dir, "part").select(
        names.when(kind == 3, "Arula").otherwise(F.col("p_brand")).alias("company"),
        F.concat(ids, suffix).alias("company_id"),
    )


def catalogue_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _catalogued_parts(spark, sf_dir).select(
        F.concat(F.lit("P"), "p_partkey").alias("product_id"),
        (F.col("p_partkey") * 10 + F.col("company_no")).alias("pid"),
        F.concat(F.lit("CO"), "company_no").alias("company_id"),
    )


def catalogue_retail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Colors and sizes; parts divisible by fourteen have none, by ten two."""
    rows = _catalogued_parts(spark, sf_dir, "p_brand", "p_size").filter("p_partkey % 14 <> 0")
    looks = rows.withColumn(
        "look", F.explode(F.when(F.col("p_partkey") % 10 == 0, F.array(F.lit(""), F.lit("!"))).otherwise(F.array(F.lit(""))))
    )
    return looks.select(
        (F.col("p_partkey") * 10 + F.col("company_no")).alias("pid"),
        F.concat("p_brand", "look").alias("color"),
        F.concat(F.lit("Z"), "p_size").alias("size"),
    )
