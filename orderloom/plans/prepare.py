"""The shared front half of every report: from staging rows to lines and allocations."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from orderloom.operators.allocations import (
    allocations,
    pair_lists,
    read_segments,
    totals_in_place,
)
from orderloom.operators.attributes import line_attributes
from orderloom.operators.catalogue import catalogue_override
from orderloom.operators.orders import (
    HEADER_COLUMNS,
    inbound_scan,
    listed_orders,
    order_lines,
    through_generator,
    unnest_lines,
)
from orderloom.routes import ALL_ROUTES

CATALOGUE_ROUTES = {"BB", "BS"}


def _with_catalogue(
    attributed: DataFrame, catalogue: DataFrame | None, routes: Iterable[str]
) -> DataFrame:
    """The catalogue joins only where it counts."""
    if catalogue is None or not CATALOGUE_ROUTES.intersection(routes):
        return attributed
    return catalogue_override(attributed, catalogue)


def attributed_lines(
    inbound: DataFrame, catalogue: DataFrame | None = None, routes: Iterable[str] = ALL_ROUTES
) -> DataFrame:
    """Lines with their report columns."""
    routes = list(routes)
    lines = line_attributes(order_lines(inbound_scan(inbound), routes))
    return _with_catalogue(lines, catalogue, routes)


def paired_orders(
    inbound: DataFrame, routes: Iterable[str] = ALL_ROUTES, pairing: str | None = None
) -> DataFrame:
    """Orders with their lines and allocations as lists; see ``pair_lists``."""
    return pair_lists(read_segments(listed_orders(inbound_scan(inbound), routes)), pairing)


def order_allocations(
    inbound: DataFrame,
    catalogue: DataFrame | None = None,
    routes: Iterable[str] = ALL_ROUTES,
    pairing: str | None = None,
) -> DataFrame:
    """One row per line and store; with ``pairing``, by the keys of that report's own join."""
    routes = list(routes)
    paired = paired_orders(inbound, routes, pairing)
    lines = unnest_lines(paired.select(*HEADER_COLUMNS, "line_list", "store_lists"))
    return allocations(_with_catalogue(line_attributes(lines), catalogue, routes))


def document_totals(
    inbound: DataFrame, routes: Iterable[str] = ALL_ROUTES, pairing: str | None = None
) -> DataFrame:
    """Header columns and all totals of every routed order, without a shuffle."""
    paired = paired_orders(inbound, routes, pairing)
    totals = paired.select(*HEADER_COLUMNS, totals_in_place(paired).alias("totals"))
    return through_generator(totals).select(*HEADER_COLUMNS, "totals.*")
