"""Which orders each report covers, and how each order type names its fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Route code -> company, deciding field, accepted order types.
ROUTES = {
    "KB": ("KOHLS", "reference_type", ["BULK"]),
    "KS": ("KOHLS", "reference_type", ["PACK BY STORE"]),
    "KP": ("KOHLS", "reference_type", ["PREPACK", "COMPOUND PREPACK"]),
    "AK": ("ARULA", "type_code", ["KN"]),
    "AS": ("ARULA", "type_code", ["SA"]),
    "MS": ("MAURICES", "reference_type", ["SO"]),
    "BB": ("BELK", "type_code", ["BK", "RL"]),
    "BS": ("BELK", "type_code", ["SA"]),
}
ALL_ROUTES = list(ROUTES)

# Routes whose order type is printed as a constant.
PRINTED_TYPE = {"KB": "BULK", "KS": "PACK BY STORE"}

# Routes that can carry packs, by company, for the pre-pack summary.
PREPACK_ROUTES = {"kohls": ["KP"], "arula": ["AK", "AS"], "maurices": ["MS"], "belk": ["BB"]}

# Keys that pair a store with a quantity besides the adjacent
# index, per report and route, in the reference's own joins.
STRICT_KEYS = {
    "details": {
        "KB": ["style", "upc"],
        "KS": ["line", "upc", "segment"],
        "KP": ["line", "upc"],
        "AK": ["line", "upc", "segment"],
        "AS": ["upc"],
        "BB": ["line", "upc", "segment"],
        "BS": ["line", "upc", "segment"],
    },
    "store": {
        "KB": ["upc"],
        "KS": ["upc", "segment"],
        "KP": ["line", "upc"],
        "AK": ["upc", "segment"],
        "AS": ["upc"],
        "BB": ["upc", "segment"],
        "BS": ["line", "upc", "segment"],
    },
    "style_color": {
        "KB": ["style", "upc"],
        "KS": ["line", "upc", "segment"],
        "KP": ["line", "upc"],
        "AK": ["line", "upc", "segment"],
        "AS": ["upc"],
        "BB": ["line", "upc", "segment"],
        "BS": ["line", "upc", "segment"],
    },
    "style_color_size": {
        "KB": ["upc"],
        "KS": ["upc", "segment"],
        "KP": ["line", "upc"],
        "AK": ["upc", "segment"],
        "AS": ["upc"],
        "BB": ["line", "upc", "segment"],
        "BS": ["line", "upc", "segment"],
    },
}

# Routes whose own joins skip allocations sent as an array.
OBJECT_ONLY_ROUTES = ["KB", "KP", "AS"]

# Routes whose details keep lines that have no allocations.
KEEP_UNALLOCATED_ROUTES = ["KB", "AS"]


def route_of(company_code: Column, reference_type: Column, type_code: Column) -> Column:
    """Route code of an order, NULL when no report covers it; case is ignored.

    Company and type are upper-cased together and looked up, once for each deciding
    field; with a comparison per route every one of them upper-cases anew.
    """
    kinds = {"reference_type": reference_type, "type_code": type_code}
    found = []
    for field, kind in kinds.items():
        codes = {
            f"{company}\0{name}": code
            for code, (company, by, types) in ROUTES.items()
            if by == field
            for name in types
        }
        listed = F.create_map(*[F.lit(text) for pair in codes.items() for text in pair])
        found.append(listed[F.upper(F.concat(company_code, F.lit("\0"), kind))])
    return F.coalesce(*found)


def by_route(choices: dict[str, Column], route: Column | str = "route") -> Column:
    """Pick a column by route; keys are space-separated route codes."""
    column = F.col(route) if isinstance(route, str) else route
    chain = None
    for codes, value in choices.items():
        hit = column.isin(codes.split())
        chain = F.when(hit, value) if chain is None else chain.when(hit, value)
    return chain
