"""Named queries over the retail tables, with their expected-result SQL.

Every query derives its purchase orders from the tables it is given and runs
over all of them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions import bom, sizes
from orderloom.functions.texts import decimal_text_int, safe_decimal, safe_int
from orderloom.operators import allocations as alloc_ops
from orderloom.operators import catalogue as catalogue_ops
from orderloom.operators import ledger as ledger_ops
from orderloom.operators import orders as order_ops
from orderloom.operators import versions as version_ops
from orderloom.operators.attributes import is_pack, line_attributes, pack_size_label
from orderloom.plans import compaction, full_run, monitor, prepack, reports
from orderloom.plans.prepare import (
    CATALOGUE_ROUTES,
    attributed_lines,
    document_totals,
    order_allocations,
)
from orderloom.registry import oracle
from orderloom.routes import ALL_ROUTES, PREPACK_ROUTES
from orderloom.sources import derived_orders as derived
from orderloom.sources.staging import Staging
from orderloom.sources.tables import ReportStore, read_inbound, shared_folder
from orderloom.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# One name per route, as the report procedures are named.
ROUTE_NAMES = {
    "KB": "kohls_bulk",
    "KS": "kohls_packbystore",
    "KP": "kohls_prepack",
    "AK": "arula_kn",
    "AS": "arula_sa",
    "MS": "maurices",
    "BB": "belk_bk",
    "BS": "belk_sa",
}


def _register(name: str, run: Query, sql: str | None = None) -> None:
    QUERIES[name] = run
    if sql is not None:
        ORACLE[name] = sql


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        _register(run.__name__, run, sql)
        return run

    return add


def _inbound(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.purchase_orders(spark, sf_dir)


def _catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue_ops.catalogue_lookup(
        derived.catalogue_company(spark, sf_dir),
        derived.catalogue_product(spark, sf_dir),
        derived.catalogue_retail(spark, sf_dir),
    )


def _needed(spark: SparkSession, sf_dir: str, routes: list[str]) -> DataFrame | None:
    """The catalogue, where one of the routes uses it."""
    return _catalogue(spark, sf_dir) if CATALOGUE_ROUTES.intersection(routes) else None


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers of all routed orders, without touching their lines."""
    return order_ops.routed_headers(order_ops.inbound_scan(_inbound(spark, sf_dir)))


def _stored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The headers as a table: versions read them twice, documents are parsed once."""
    store = _store(spark, "headers")
    store.write_report("orders", _orders(spark, sf_dir), "first")
    return store.read_runs("orders", ["first"]).drop("run", "po_bucket")


def _lines(spark: SparkSession, sf_dir: str, routes: list[str] = ALL_ROUTES) -> DataFrame:
    """Unnested lines, without the rows that stand for orders with none."""
    scanned = order_ops.inbound_scan(_inbound(spark, sf_dir))
    return order_ops.order_lines(scanned, routes).filter("has_line").withColumn(
        "line_no", F.col("line_pos") + 1
    )


def _attributed(spark: SparkSession, sf_dir: str, routes: list[str] = ALL_ROUTES) -> DataFrame:
    return attributed_lines(_inbound(spark, sf_dir), _needed(spark, sf_dir, routes), routes)


def _allocations(
    spark: SparkSession, sf_dir: str, routes: list[str] = ALL_ROUTES, pairing: str | None = None
) -> DataFrame:
    return order_allocations(
        _inbound(spark, sf_dir), _needed(spark, sf_dir, routes), routes, pairing
    )


def _totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_totals(_inbound(spark, sf_dir))


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A half-filled ledger derived from the order keys."""
    key = F.col("o_orderkey")
    marks = F.array_compact(
        F.array(F.when(key % 5 != 0, F.lit("details")), F.when(key % 3 == 0, F.lit("store")))
    )
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        (key + 1).alias("source_id"), F.explode(marks).alias("report"), F.lit("Success").alias("status")
    )


def _sql(tail: str) -> str:
    return oracle.BASE + tail


# Sources, routing, extraction


@query(
    _sql(
        "SELECT source_id AS id, downloaded_at AS created, company AS company_code, "
        "transaction_type, status FROM received"
    )
)
def inbound_scan(spark, sf_dir):
    return order_ops.inbound_scan(_inbound(spark, sf_dir)).select(
        "id", "created", "company_code", "transaction_type", "status"
    )


@query(_sql("SELECT source_id AS id, company AS company_code FROM every WHERE well_formed"))
def valid_json(spark, sf_dir):
    return order_ops.valid_json(_inbound(spark, sf_dir)).select("id", "company_code")


@query(
    _sql(
        "SELECT source_id, route, well_formed AS readable FROM received"
    )
)
def route_orders(spark, sf_dir):
    parsed = order_ops.parse_orders(order_ops.inbound_scan(_inbound(spark, sf_dir)))
    return parsed.select("source_id", "route", "readable")


@query(
    _sql(
        "SELECT id, company AS company_code FROM received JOIN done ON id = source_id "
        "WHERE NOT details"
    )
)
def pending_details(spark, sf_dir):
    rows = order_ops.inbound_scan(_inbound(spark, sf_dir)).select("id", "company_code")
    return ledger_ops.pending(rows, _ledger(spark, sf_dir), "details")


@query(
    _sql(
        "SELECT id, company AS company_code FROM received JOIN done ON id = source_id "
        "WHERE details AND NOT store"
    )
)
def pending_store(spark, sf_dir):
    rows = order_ops.inbound_scan(_inbound(spark, sf_dir)).select("id", "company_code")
    return ledger_ops.pending(rows, _ledger(spark, sf_dir), "store")


@query(
    _sql(
        "SELECT source_id, route, company, customer_po, po_type, department, date_downloaded "
        "FROM po"
    )
)
def header_fields(spark, sf_dir):
    return _orders(spark, sf_dir).select(
        "source_id", "route", "company", "customer_po", "po_type", "department", "date_downloaded"
    )


@query(_sql("SELECT source_id, start_date, cancel_date FROM po"))
def order_dates(spark, sf_dir):
    return _orders(spark, sf_dir).select("source_id", "start_date", "cancel_date")


@query(
    _sql(
        "SELECT source_id, CAST(line_no AS VARCHAR) AS line_item_id, line_no, "
        "'ST' || (p % 40) AS vendor_item_number, 'P' || p AS product_id FROM line"
    )
)
def line_items(spark, sf_dir):
    return _lines(spark, sf_dir).select(
        "source_id", "line_item_id", "line_no", "vendor_item_number", "product_id"
    )


@query(
    _sql(
        "SELECT source_id, line_no, style, color, size, upc, sku, uom, unit_price, retail_price, "
        "inner_pack, qty_per_inner_pack, CASE WHEN route = 'MS' THEN CAST(q AS INTEGER) END "
        "AS line_qty FROM line"
    )
)
def line_attributes_by_route(spark, sf_dir):
    return _attributed(spark, sf_dir).filter("has_line").select(
        "source_id",
        (F.col("line_pos") + 1).alias("line_no"),
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
    )


@query(
    _sql(
        "SELECT source_id, line_no, unit_price, CASE WHEN p % 11 <> 0 THEN "
        "CAST((p % 900 + 100) * 0.02 AS DECIMAL(18,2)) END AS sales_price, "
        "pack_count AS pack FROM line"
    )
)
def safe_number(spark, sf_dir):
    return _lines(spark, sf_dir).select(
        "source_id",
        "line_no",
        safe_decimal(F.col("unit_price_text")).alias("unit_price"),
        safe_decimal(F.col("sales_price_text")).alias("sales_price"),
        safe_int(F.col("pack_text")).alias("pack"),
    )


@query(
    _sql(
        "SELECT source_id, line_no, CAST(NULL AS INTEGER) AS as_whole_number, "
        "CAST(q AS INTEGER) AS as_decimal_text FROM line"
    )
)
def decimal_text_qty(spark, sf_dir):
    return _lines(spark, sf_dir).select(
        "source_id",
        "line_no",
        safe_int(F.col("quantity_text")).alias("as_whole_number"),
        decimal_text_int(F.col("quantity_text")).alias("as_decimal_text"),
    )


# Bills of material


def _per_line(column: str, sql: str, build: Callable[[], Column], name: str) -> None:
    """A query that shows one derived column of every line."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _attributed(spark, sf_dir).filter("has_line").select(
            "source_id", (F.col("line_pos") + 1).alias("line_no"), build().alias(column)
        )

    _register(name, run, _sql(f"SELECT source_id, line_no, {sql} AS {column} FROM line"))


_per_line("is_pack", "is_pack", is_pack, "is_pack")
_per_line(
    "pack_style",
    "CASE WHEN is_pack AND route <> 'MS' THEN 'ST' || (p % 40) || ' P' || units END",
    lambda: bom.pack_style(F.col("vendor_item_number"), F.col("bom")),
    "pack_style",
)
_per_line(
    "first_color",
    "CASE WHEN is_pack THEN first_color END",
    lambda: bom.first_color(F.col("bom")),
    "first_component_color",
)
_per_line(
    "label",
    "CASE WHEN is_pack THEN CASE route WHEN 'MS' THEN 'CA' ELSE 'PPK' END END",
    lambda: F.when(is_pack(), pack_size_label()),
    "pack_size_label",
)
_per_line(
    "cut",
    "'(' || cut || ')'",
    lambda: sizes.cut_suffix(F.col("size_second"), F.col("size_plain")),
    "cut_suffix",
)
_per_line(
    "fallback",
    "vendor_size",
    lambda: sizes.size_fallback(F.col("size_second"), F.col("size_plain")),
    "size_fallback",
)


@query(
    _sql(
        "SELECT source_id, line_no, is_pack, inner_pack, qty_per_inner_pack FROM line "
        "WHERE route = 'BB'"
    )
)
def pack_only_inner(spark, sf_dir):
    return _attributed(spark, sf_dir, ["BB"]).filter("has_line").select(
        "source_id",
        (F.col("line_pos") + 1).alias("line_no"),
        is_pack().alias("is_pack"),
        "inner_pack",
        "qty_per_inner_pack",
    )


@query(
    _sql(
        "SELECT DISTINCT 'prepack-' || source_id AS header_id, "
        f"{oracle.HEAD} FROM line WHERE is_pack AND route IN ('KP', 'AK', 'AS', 'MS', 'BB')"
    )
)
def bom_gate(spark, sf_dir):
    return prepack.prepack_header(prepack.bom_gate(_lines(spark, sf_dir)))


_SIGNATURE = (
    "(SELECT string_agg('CS' || x || '|C' || ((p + x) % 4) || '|' || "
    + oracle.COMPONENT_SIZE
    + " || '|' || (1 + (p + x) % 6) || CASE WHEN route = 'MS' THEN '.0' ELSE '' END, '~' "
    "ORDER BY x) FROM (VALUES (0), (1), (2), (3)) AS t(x) WHERE x <= p % 4)"
)


@query(
    _sql(
        f"SELECT source_id, line_no, {_SIGNATURE} AS bom_signature FROM line "
        "WHERE is_pack AND route IN ('KP', 'AK', 'AS', 'MS', 'BB')"
    )
)
def bom_signature(spark, sf_dir):
    packs = prepack.bom_signature(prepack.pack_lines(_lines(spark, sf_dir)))
    return packs.select("source_id", "line_no", "bom_signature")


@query(_sql(f"SELECT source_id, line_no, {_SIGNATURE} AS bom_signature FROM pack"))
def bom_dedupe(spark, sf_dir):
    unique = prepack.bom_dedupe(prepack.pack_lines(_lines(spark, sf_dir)))
    return unique.select(
        "source_id", (F.col("line_pos") + 1).alias("line_no"), "bom_signature"
    )


@query(
    _sql(
        "SELECT source_id, line_no, 'CS' || x AS component_style, "
        "'C' || ((p + x) % 4) AS component_color FROM component"
    )
)
def bom_components(spark, sf_dir):
    unique = prepack.bom_dedupe(prepack.pack_lines(_lines(spark, sf_dir)))
    return prepack.bom_components(unique).select(
        "source_id",
        (F.col("line_pos") + 1).alias("line_no"),
        F.col("component.VendorItemNumber").alias("component_style"),
        F.col("component.ColorDescription").alias("component_color"),
    )


# Store allocations


@query(
    _sql(
        "SELECT source_id, line_no, CAST(segment AS INTEGER) AS segment, "
        "CAST(2 + 2 * count(*) + CASE WHEN p % 5 = 0 AND segment = 0 THEN 1 ELSE 0 END "
        "AS INTEGER) AS key_count FROM slot WHERE route <> 'none' "
        "GROUP BY source_id, line_no, segment, p"
    )
)
def sdq_segments(spark, sf_dir):
    return alloc_ops.sdq_segments(_lines(spark, sf_dir)).select(
        "source_id", "line_no", "segment", F.size("keys").alias("key_count")
    )


@query(
    _sql(
        "SELECT source_id, line_no, CAST(segment AS INTEGER) AS segment, "
        "CAST(idx AS INTEGER) AS index, store_number AS value FROM slot "
        "UNION ALL SELECT source_id, line_no, CAST(segment AS INTEGER), "
        "CAST(idx + 1 AS INTEGER), coalesce(CAST(qty AS VARCHAR), 'x') FROM slot "
        "UNION ALL SELECT source_id, line_no, 0, 23, '0999' FROM line "
        "WHERE has_sdq AND p % 5 = 0"
    )
)
def sdq_fields(spark, sf_dir):
    return alloc_ops.sdq_fields(_lines(spark, sf_dir)).select(
        "source_id", "line_no", "segment", "index", "value"
    )


_PAIRS = "SELECT source_id, line_no, CAST(segment AS INTEGER) AS segment, store_number, qty FROM slot"


@query(_sql(_PAIRS))
def sdq_pairs(spark, sf_dir):
    return alloc_ops.sdq_pairs(_lines(spark, sf_dir)).select(
        "source_id", "line_no", "segment", "store_number", "qty"
    )


@query(_sql(_PAIRS + " WHERE qty > 0"))
def positive_qty(spark, sf_dir):
    paired = alloc_ops.sdq_pairs(_lines(spark, sf_dir))
    return alloc_ops.positive_qty(paired).select(
        "source_id", "line_no", "segment", "store_number", "qty"
    )


@query(_sql("SELECT source_id, line_no FROM line WHERE route IN ('KB', 'AS') AND NOT has_sdq"))
def lines_without_sdq(spark, sf_dir):
    return alloc_ops.lines_without_sdq(_lines(spark, sf_dir)).select("source_id", "line_no")


@query(
    _sql(
        "SELECT source_id, line_no, division_store AS store_number, CAST(q AS INTEGER) AS qty "
        "FROM line WHERE route = 'MS'"
    )
)
def header_store(spark, sf_dir):
    rows = line_attributes(_lines(spark, sf_dir, ["MS"]))
    return rows.select("source_id", "line_no", F.inline(alloc_ops.header_store())).drop("segment")


# Catalogue


@query(
    "SELECT catalogue_company, min(company_id) AS company_id FROM (SELECT "
    "CASE WHEN p_partkey % 5 < 2 THEN 'BELK' WHEN p_partkey % 5 < 4 THEN 'ARULA' "
    "ELSE upper(p_brand) END AS catalogue_company, "
    "CASE WHEN p_partkey % 5 < 2 THEN 'CO4' WHEN p_partkey % 5 < 4 THEN 'CO1' ELSE 'CX' END "
    "|| CASE WHEN p_partkey % 3 = 0 THEN '' ELSE '-' || p_partkey END AS company_id FROM part) "
    "GROUP BY catalogue_company"
)
def company_id_lookup(spark, sf_dir):
    return catalogue_ops.company_id_lookup(derived.catalogue_company(spark, sf_dir))


@query(
    "SELECT company AS catalogue_company, 'P' || p_partkey AS catalogue_product, "
    "CASE WHEN p_partkey % 14 <> 0 THEN p_brand END AS catalogue_color, "
    "CASE WHEN p_partkey % 14 <> 0 THEN 'Z' || p_size END AS catalogue_size "
    "FROM part JOIN (VALUES ('BELK', 2), ('ARULA', 3)) AS c(company, step) "
    "ON p_partkey % step = 0"
)
def catalogue_lookup(spark, sf_dir):
    return _catalogue(spark, sf_dir)


@query(_sql("SELECT source_id, line_no, color, size FROM line WHERE route IN ('BB', 'BS')"))
def catalogue_override(spark, sf_dir):
    return _attributed(spark, sf_dir, ["BB", "BS"]).filter("has_line").select(
        "source_id", (F.col("line_pos") + 1).alias("line_no"), "color", "size"
    )


# Versions


@query(_sql("SELECT source_id, company, customer_po, arrival AS version FROM ver"))
def arrival_version(spark, sf_dir):
    return version_ops.arrival_version(_stored_orders(spark, sf_dir)).select(
        "source_id", "company", "customer_po", "version"
    )


@query(_sql("SELECT source_id, company, customer_po, version FROM ver"))
def recalculate_versions(spark, sf_dir):
    return version_ops.recalculate_versions(_stored_orders(spark, sf_dir)).select(
        "source_id", "company", "customer_po", "version"
    )


@query(
    _sql(
        "SELECT source_id, company, customer_po, arrival AS version, version AS correct_version "
        "FROM ver WHERE arrival <> version"
    )
)
def version_corrections(spark, sf_dir):
    return version_ops.version_corrections(version_ops.arrival_version(_stored_orders(spark, sf_dir)))


@query(
    _sql(
        "SELECT 'style_color-' || source_id AS header_id, " + oracle.HEAD
        + ", start_date, cancel_date AS complete_date, version FROM ver"
    )
)
def inherit_version(spark, sf_dir):
    headers = _stored_orders(spark, sf_dir)
    versions = version_ops.recalculate_versions(headers)
    return reports.style_color_header(version_ops.inherit_version(headers, versions))


@query(
    _sql(
        "SELECT source_id, company, customer_po, version FROM (SELECT *, row_number() OVER "
        "(PARTITION BY company, customer_po ORDER BY version DESC) AS nth FROM ver) WHERE nth = 1"
    )
)
def latest_versions(spark, sf_dir):
    numbered = version_ops.recalculate_versions(_stored_orders(spark, sf_dir))
    return version_ops.latest_versions(
        numbered.select("source_id", "company", "customer_po", "version")
    )


# Reports over all routes


@query(oracle.details())
def details_report(spark, sf_dir):
    return reports.details_report(_allocations(spark, sf_dir))


_DETAILS_HEADER = (
    "'details-' || source_id AS header_id, "
    + oracle.HEAD
    + ", downloaded_at, coalesce(total_items, 0) AS total_items, "
    "coalesce(total_qty, 0) AS total_qty, start_date, cancel_date, department"
)


@query(oracle.totals(_DETAILS_HEADER))
def details_totals(spark, sf_dir):
    return reports.details_header(_totals(spark, sf_dir))


@query(oracle.style_color())
def style_color_report(spark, sf_dir):
    return reports.style_color_report(_allocations(spark, sf_dir))


@query(oracle.store())
def store_report(spark, sf_dir):
    return reports.store_report(_allocations(spark, sf_dir))


@query(
    oracle.totals(
        "'store-' || source_id AS header_id, "
        + oracle.HEAD
        + ", coalesce(total_qty, 0) AS order_qty_total, start_date, cancel_date AS complete_date, "
        "department"
    )
)
def store_header(spark, sf_dir):
    return reports.store_header(_totals(spark, sf_dir))


@query(
    _sql(
        ", total AS (SELECT po.source_id, CAST(sum(CAST(q AS INTEGER)) AS BIGINT) AS store_qty, "
        "count(l_orderkey) AS line_rows FROM po LEFT JOIN numbered ON l_orderkey = k "
        "WHERE route = 'MS' GROUP BY po.source_id) "
        "SELECT 'store-' || source_id AS header_id, source_id, company, po_type, customer_po, "
        "department, CAST(division_store AS INTEGER) AS store_number, store_qty, line_rows "
        "FROM total JOIN po USING (source_id)"
    )
)
def single_store_total(spark, sf_dir):
    """The one store of a Maurices order beside its header, and the lines behind the sum."""
    rows = _allocations(spark, sf_dir, ["MS"])
    kept = ["source_id", "company", "po_type", "customer_po", "department"]
    return reports.single_store_header(rows, kept)


@query(oracle.style_color_size())
def style_color_size_report(spark, sf_dir):
    return reports.style_color_size_report(_allocations(spark, sf_dir))


@query(
    oracle.totals(
        "'style_color_size-' || source_id AS header_id, "
        + oracle.HEAD
        + ", coalesce(total_qty, 0) AS total_order_qty, "
        "CAST(coalesce(total_amount, 0) AS DECIMAL(29,2)) AS total_order_amount, start_date, "
        "cancel_date AS complete_date, department"
    )
)
def order_amount_totals(spark, sf_dir):
    return reports.style_color_size_header(_totals(spark, sf_dir))


@query(oracle.prepack())
def prepack_summary(spark, sf_dir):
    return prepack.prepack_summary(_lines(spark, sf_dir))


@query(
    _sql(
        "SELECT company, customer_po, date_downloaded AS download_date, version FROM ver"
    )
)
def daily_log(spark, sf_dir):
    return reports.daily_log(version_ops.recalculate_versions(_stored_orders(spark, sf_dir)))


@query(
    _sql(
        "SELECT 'details-' || source_id AS details_id, 'store-' || source_id AS store_id FROM po"
    )
)
def header_key(spark, sf_dir):
    return _orders(spark, sf_dir).select(
        order_ops.header_key("details").alias("details_id"),
        order_ops.header_key("store").alias("store_id"),
    )


_DAMAGED = (
    " UNION ALL SELECT source_id, company, 'bad line' FROM po WHERE k % 29 = 0 "
    "AND (SELECT count(*) FROM numbered WHERE l_orderkey = k) > 1 "
    "UNION ALL SELECT DISTINCT source_id, company, 'bad segment' FROM line WHERE has_sdq "
    "AND line_no % 2 = 1 AND route IN ('KS', 'AK', 'BB', 'BS') AND s % 19 = 0 "
    "UNION ALL SELECT DISTINCT source_id, company, 'repeated key' FROM line "
    "WHERE has_sdq AND p % 31 = 0"
)


# Sinks, ledger, runs


def _store(spark: SparkSession, name: str) -> ReportStore:
    return ReportStore(spark, shared_folder(spark, name))


@query(oracle.details())
def write_report(spark, sf_dir):
    store = _store(spark, "write-report")
    store.write_report("details", reports.details_report(_allocations(spark, sf_dir)), "first")
    return store.read_runs("details", ["first"]).drop("run")


@query(_sql("SELECT source_id, 'details' AS report, 'Success' AS status FROM po"))
def status_ledger(spark, sf_dir):
    store = _store(spark, "ledger")
    store.commit("details", _orders(spark, sf_dir).select("source_id"), "first")
    return store.ledger().select("source_id", "report", "status")


@query(
    oracle.totals(
        "'style_color_size-' || source_id AS header_id, "
        + oracle.HEAD
        + ", coalesce(total_qty, 0) AS total_order_qty, "
        "CAST(coalesce(total_amount, 0) AS DECIMAL(29,2)) AS total_order_amount, start_date, "
        "cancel_date AS complete_date, department, version"
    )
)
def run_all_reports(spark, sf_dir):
    """Two pickups, late orders first, and a repeat that must add nothing."""
    store = _store(spark, "reports")
    inbound, catalogue = _staged_inbound(spark, sf_dir, store), _catalogue(spark, sf_dir)
    for received in (inbound.filter("created >= '1998-01-01'"), inbound, inbound):
        full_run.run_all_reports(store, received, catalogue)
    return full_run.report_headers(store, "style_color_size")


_COUNTED = {
    "details": (oracle.details(), "qty"),
    "style_color": (oracle.style_color(), "qty_ordered"),
    "store": (oracle.store(), "store_qty"),
    "style_color_size": (oracle.style_color_size(), "qty"),
    "prepack": (oracle.prepack(), "component_qty"),
}


@query(
    " UNION ALL ".join(
        f"SELECT '{report}' AS report, count(*) AS detail_rows, "
        f"CAST(sum({column}) AS BIGINT) AS quantity FROM ({sql})"
        for report, (sql, column) in _COUNTED.items()
    )
)
def incremental_run(spark, sf_dir):
    """The same tables by stream; what every report holds afterwards."""
    store = _store(spark, "stream")
    _staged_inbound(spark, sf_dir, store)
    stream = incremental.incremental_run(
        spark,
        f"{store.root}/inbound",
        store,
        f"{store.root}/checkpoint",
        _catalogue(spark, sf_dir),
    )
    stream.awaitTermination()
    parts = [
        full_run.report_details(store, report).agg(
            F.lit(report).alias("report"),
            F.count("*").alias("detail_rows"),
            F.sum(column).cast("long").alias("quantity"),
        )
        for report, (_, column) in _COUNTED.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query(oracle.details())
def pruned_pickup(spark, sf_dir):
    """Three days of a staging table, each picked up alone, with a compaction in between."""
    store = _store(spark, "pruned")
    staging, catalogue = Staging(spark, f"{store.root}/inbound"), _catalogue(spark, sf_dir)
    inbound = _staged_inbound(spark, sf_dir, store, "source")
    for number in range(3):
        day = f"2024-01-0{number + 1}"
        staging.write(inbound.filter(f"id % 3 = {number}"), day)
        if full_run.run_staged(store, staging, catalogue) != [day]:
            raise ValueError(f"another day than {day} was read")
        if number == 1:
            compaction.compact(store)
    return full_run.report_details(store, "details")


@query(oracle.details())
def reopened_orders(spark, sf_dir):
    """Reported without the catalogue; then the orders that need it are done again."""
    store = _store(spark, "reopened")
    inbound = _staged_inbound(spark, sf_dir, store)
    full_run.run_all_reports(store, inbound)
    belk = full_run.current_orders(store).filter("route IN ('BB', 'BS')")
    store.reopen(belk, ["details"])
    full_run.run_all_reports(store, inbound, _catalogue(spark, sf_dir))
    return full_run.report_details(store, "details")


@query(
    _sql(
        ", pairs AS (SELECT source_id, count(*) AS n FROM alloc GROUP BY source_id) "
        "SELECT source_id, company AS company_code, "
        "CASE WHEN well_formed THEN 'no route' ELSE 'bad JSON' END AS reason "
        "FROM received WHERE route IS NULL "
        "UNION ALL SELECT source_id, company, CASE WHEN EXISTS (SELECT 1 FROM numbered "
        "WHERE l_orderkey = k) THEN 'no valid pair' ELSE 'no lines' END "
        "FROM po LEFT JOIN pairs USING (source_id) WHERE pairs.n IS NULL" + _DAMAGED
    )
)
def order_problems(spark, sf_dir):
    """The view over a store after a full run; the documents are not read for it."""
    store = _store(spark, "problems")
    full_run.run_all_reports(store, _staged_inbound(spark, sf_dir, store), _catalogue(spark, sf_dir))
    full_run.create_views(store)
    return spark.table("order_problems")


@query(
    oracle.strict(
        "store",
        ", summed AS (SELECT source_id, CAST(sum(qty) AS BIGINT) AS qty FROM paired "
        "GROUP BY source_id) SELECT 'store-' || source_id AS header_id, "
        + oracle.HEAD
        + ", coalesce(qty, 0) AS order_qty_total, start_date, cancel_date AS complete_date, "
        "department, version FROM ver LEFT JOIN summed USING (source_id)",
    )
)
def original_pairing_run(spark, sf_dir):
    """A full run by the original keys: header totals follow the report's own pairing."""
    store = _store(spark, "original")
    inbound, catalogue = _staged_inbound(spark, sf_dir, store), _catalogue(spark, sf_dir)
    full_run.run_all_reports(store, inbound, catalogue, pairing="original")
    return full_run.report_headers(store, "store")


def _staged_inbound(
    spark: SparkSession, sf_dir: str, store: ReportStore, name: str = "inbound"
) -> DataFrame:
    """The staging table as files, as the pickups find it."""
    _inbound(spark, sf_dir).write.parquet(f"{store.root}/{name}", compression="zstd")
    return read_inbound(spark, f"{store.root}/{name}")


@query(
    _sql(
        ", lines AS (SELECT source_id, count(*) AS n FROM line GROUP BY source_id), "
        "pairs AS (SELECT source_id, count(*) AS n FROM alloc GROUP BY source_id) "
        "SELECT source_id, company AS company_code, CASE WHEN NOT well_formed THEN 'bad JSON' "
        "WHEN route IS NULL THEN 'no route' ELSE 'details missing' END AS reason "
        "FROM received JOIN done ON id = source_id WHERE NOT details "
        "UNION ALL SELECT source_id, company, CASE WHEN lines.n IS NULL THEN 'no lines' "
        "ELSE 'no valid pair' END FROM po JOIN done ON id = source_id "
        "LEFT JOIN lines USING (source_id) LEFT JOIN pairs USING (source_id) "
        "WHERE details AND pairs.n IS NULL" + _DAMAGED
    )
)
def error_monitor(spark, sf_dir):
    return monitor.error_monitor(_inbound(spark, sf_dir), _ledger(spark, sf_dir))


# Strict pairing: the original joins' own keys


@query(
    oracle.strict(
        "details",
        "SELECT 'details-' || source_id AS header_id, source_id, customer_po, "
        f"{oracle.DETAIL}, count(*) AS copies FROM paired GROUP BY ALL",
    )
)
def strict_details_report(spark, sf_dir):
    rows = reports.details_report(_allocations(spark, sf_dir, pairing="details"))
    keys = [c for c in rows.columns if c != "copies"]
    return rows.groupBy(*keys).agg(F.sum("copies").alias("copies"))


@query(
    oracle.strict(
        "store",
        "SELECT 'store-' || source_id AS header_id, source_id, customer_po, "
        "CAST(store_number AS INTEGER) AS store_number, CAST(sum(qty) AS BIGINT) AS store_qty "
        "FROM paired GROUP BY source_id, customer_po, store_number",
    )
)
def strict_store_report(spark, sf_dir):
    return reports.store_report(_allocations(spark, sf_dir, pairing="store"))


@query(
    oracle.strict(
        "style_color",
        "SELECT 'style_color-' || source_id AS header_id, source_id, customer_po, style, color, "
        "CASE WHEN route = 'KP' THEN upc END AS upc, CAST(sum(qty) AS BIGINT) AS qty_ordered "
        "FROM paired GROUP BY source_id, customer_po, style, color, "
        "CASE WHEN route = 'KP' THEN upc END",
    )
)
def strict_style_color_report(spark, sf_dir):
    return reports.style_color_report(
        _allocations(spark, sf_dir, pairing="style_color")
    )


@query(
    oracle.strict(
        "style_color_size",
        "SELECT 'style_color_size-' || source_id AS header_id, source_id, customer_po, style, "
        "color, size, upc, sku, unit_price, retail_price, CAST(sum(qty) AS BIGINT) AS qty, "
        "CAST(unit_price * sum(qty) AS DECIMAL(29,2)) AS amount FROM paired "
        "GROUP BY source_id, customer_po, style, color, size, upc, sku, unit_price, retail_price",
    )
)
def strict_style_color_size_report(spark, sf_dir):
    return reports.style_color_size_report(
        _allocations(spark, sf_dir, pairing="style_color_size")
    )


# One query per report and route


def _register_routes() -> None:
    kinds = {
        "details": (reports.details_report, oracle.details),
        "style_color": (reports.style_color_report, oracle.style_color),
        "store": (reports.store_report, oracle.store),
        "style_color_size": (reports.style_color_size_report, oracle.style_color_size),
    }
    for route, prefix in ROUTE_NAMES.items():
        for kind, (report, sql) in kinds.items():

            def run(spark, sf_dir, route=route, report=report):
                return report(_allocations(spark, sf_dir, [route]))

            _register(f"{prefix}_{kind}", run, sql([route]))
    for company, routes in PREPACK_ROUTES.items():

        def run(spark, sf_dir, routes=routes):
            return prepack.prepack_summary(_lines(spark, sf_dir, routes))

        _register(f"{company}_prepack_summary", run, oracle.prepack(routes))


_register_routes()
