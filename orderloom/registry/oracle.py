"""Expected results in plain SQL, straight from the retail tables.

The SQL never sees a document: it repeats the arithmetic the derived documents
are built from, so agreement checks the whole way through JSON and back.
"""

from __future__ import annotations

BASE = """
WITH every AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderkey + 1 AS source_id,
    CASE o_custkey % 4 WHEN 0 THEN 'Kohls' WHEN 1 THEN 'ARULA' WHEN 2 THEN 'Maurices'
      ELSE 'BELK' END AS company,
    CASE WHEN o_orderkey % 101 = 0 THEN '860' ELSE '850' END AS transaction_type,
    CASE WHEN o_orderkey % 103 = 0 THEN 'Failed' ELSE 'Downloaded' END AS status,
    o_orderkey % 107 <> 0 AND o_orderkey % 113 <> 0 AS well_formed,
    CASE WHEN o_orderkey % 107 = 0 OR o_orderkey % 113 = 0 OR o_orderkey % 109 = 0 THEN NULL
      WHEN o_custkey % 4 = 0 THEN CASE o_orderkey % 4 WHEN 0 THEN 'KB' WHEN 1 THEN 'KS' ELSE 'KP' END
      WHEN o_custkey % 4 = 1 THEN CASE o_orderkey % 2 WHEN 0 THEN 'AK' ELSE 'AS' END
      WHEN o_custkey % 4 = 2 THEN 'MS'
      ELSE CASE WHEN o_orderkey % 3 = 2 THEN 'BS' ELSE 'BB' END END AS route,
    CASE o_custkey % 4
      WHEN 0 THEN CASE o_orderkey % 4 WHEN 0 THEN 'BULK' WHEN 1 THEN 'PACK BY STORE'
        WHEN 2 THEN 'PREPACK' ELSE 'COMPOUND PREPACK' END
      WHEN 1 THEN CASE o_orderkey % 2 WHEN 0 THEN 'KN' ELSE 'SA' END
      WHEN 2 THEN 'SO'
      ELSE CASE o_orderkey % 3 WHEN 0 THEN 'BK' WHEN 1 THEN 'RL' ELSE 'SA' END END AS po_type,
    'PO' || o_custkey AS customer_po,
    CAST(o_orderdate AS DATE) AS date_downloaded,
    o_orderdate AS downloaded_at,
    CASE WHEN o_orderkey % 50 <> 0 THEN CAST(CAST(o_orderdate AS DATE)
      + CASE WHEN o_custkey % 4 = 2 THEN 10 ELSE 7 END AS DATE) END AS start_date,
    CASE WHEN o_orderkey % 50 <> 0 THEN CAST(CAST(o_orderdate AS DATE) + 30 AS DATE) END
      AS cancel_date,
    'D' || (o_custkey % 10) AS department,
    lpad(CAST(o_custkey % 300 AS VARCHAR), 4, '0') AS division_store
  FROM orders
),
received AS (
  SELECT * FROM every WHERE transaction_type = '850' AND status = 'Downloaded'
),
po AS (SELECT * FROM received WHERE route IS NOT NULL),
numbered AS (
  SELECT l_orderkey, l_partkey AS p, l_suppkey AS s, l_linenumber AS ln,
    CAST(l_quantity AS BIGINT) AS q,
    CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
      l_extendedprice, l_shipdate) AS INTEGER) AS line_no
  FROM lineitem
),
raw_line AS (
  SELECT po.*, n.p, n.s, n.ln, n.q, n.line_no,
    route = 'KP' OR (route IN ('AK', 'AS', 'MS', 'BB') AND n.p % 3 = 0) AS is_pack,
    n.p % 13 <> 0 AS has_sdq,
    1 + n.p % 6
      + CASE WHEN n.p % 4 >= 1 THEN 1 + (n.p + 1) % 6 ELSE 0 END
      + CASE WHEN n.p % 4 >= 2 THEN 1 + (n.p + 2) % 6 ELSE 0 END
      + CASE WHEN n.p % 4 >= 3 THEN 1 + (n.p + 3) % 6 ELSE 0 END AS units,
    'C' || ((n.p + CASE WHEN n.s % 2 = 1 THEN n.p % 4 ELSE 0 END) % 4) AS first_color,
    CASE n.p % 3 WHEN 0 THEN 'S REGULAR' WHEN 1 THEN 'M TALL' ELSE 'L' END AS vendor_size,
    CASE n.p % 3 WHEN 0 THEN 'R' WHEN 1 THEN 'T' ELSE
      CASE WHEN n.s % 2 = 0 THEN 'L' ELSE 'NULL' END END AS cut,
    CASE n.p % 3 WHEN 0 THEN 'S' WHEN 1 THEN 'M' ELSE 'L' END AS plain_size,
    CASE WHEN n.s % 7 <> 0 THEN n.ln END AS pack_count,
    CASE WHEN n.p % 2 = 0 AND n.p % 14 <> 0 THEN pt.p_brand END AS cat_color,
    CASE WHEN n.p % 2 = 0 AND n.p % 14 <> 0 THEN 'Z' || pt.p_size END AS cat_size
  FROM po JOIN numbered n ON n.l_orderkey = po.k LEFT JOIN part pt ON pt.p_partkey = n.p
),
line AS (
  SELECT *,
    CASE WHEN route = 'MS' THEN
        CASE WHEN is_pack THEN 'P' || p ELSE 'ST' || (p % 40) || ' (' || cut || ')' END
      WHEN route IN ('AK', 'AS', 'BB') AND is_pack THEN 'ST' || (p % 40) || ' P' || units
      ELSE 'ST' || (p % 40) END AS style,
    CASE WHEN route = 'KP' THEN first_color
      WHEN route IN ('MS', 'BB') AND is_pack THEN first_color
      WHEN route IN ('BB', 'BS') THEN coalesce(cat_color, 'C' || (s % 5))
      ELSE 'C' || (s % 5) END AS color,
    CASE WHEN route = 'MS' THEN CASE WHEN is_pack THEN 'CA' ELSE vendor_size END
      WHEN is_pack THEN 'PPK'
      WHEN route IN ('BB', 'BS') THEN
        coalesce(cat_size, CASE WHEN s % 2 = 0 THEN vendor_size END)
      ELSE plain_size END AS size,
    CASE WHEN route IN ('KB', 'KS') THEN 'G' || p WHEN route <> 'MS' THEN 'P' || p END AS upc,
    CASE WHEN route IN ('KB', 'KS', 'KP') THEN 'B' || p
      WHEN route IN ('AK', 'AS', 'MS') THEN 'P' || p END AS sku,
    'EA' AS uom,
    CAST((p % 900 + 100) * 0.01 AS DECIMAL(18,2)) AS unit_price,
    CASE WHEN route = 'MS' OR p % 11 <> 0
      THEN CAST((p % 900 + 100) * 0.02 AS DECIMAL(18,2)) END AS retail_price,
    CASE WHEN route IN ('KB', 'KS', 'KP') OR (route = 'BB' AND is_pack) THEN pack_count END
      AS inner_pack,
    CASE WHEN route IN ('KB', 'KS', 'KP') OR (route = 'BB' AND is_pack) THEN pack_count END
      AS qty_per_inner_pack
  FROM raw_line
),
slot AS (
  SELECT line.*, j.j AS j,
    CASE WHEN line_no % 2 = 1 AND route IN ('KS', 'AK', 'BB', 'BS') AND j.j = 2 THEN 1 ELSE 0 END
      AS segment,
    CASE WHEN j.j = 3 THEN 1000000003 WHEN j.j = 4 THEN 3
      WHEN line_no % 2 = 1 AND route IN ('KS', 'AK', 'BB', 'BS') AND j.j = 2 THEN 3
      ELSE 3 + 2 * j.j END AS idx,
    lpad(CAST((s + 37 * j.j) % 200 AS VARCHAR), 4, '0') AS store_number,
    CASE WHEN (p + j.j) % 17 <> 0 THEN CAST((q + j.j) % 6 AS INTEGER) END AS qty
  FROM line JOIN (VALUES (0), (1), (2), (3), (4)) AS j(j)
    ON (j.j <= 2 AND j.j <= ln % 3) OR (j.j = 3 AND p % 23 = 0) OR (j.j = 4 AND p % 31 = 0)
  WHERE has_sdq
),
alloc AS (
  SELECT * EXCLUDE (j, segment, idx) FROM slot WHERE route <> 'MS' AND qty > 0
  UNION ALL BY NAME
  SELECT *, division_store AS store_number, CAST(q AS INTEGER) AS qty FROM line
  WHERE route = 'MS'
  UNION ALL BY NAME
  SELECT *, CAST(NULL AS VARCHAR) AS store_number, CAST(NULL AS INTEGER) AS qty FROM line
  WHERE route IN ('KB', 'AS') AND NOT has_sdq
),
counted AS (SELECT * FROM alloc WHERE route = 'MS' OR qty > 0),
ver AS (
  SELECT *,
    CAST(rank() OVER (PARTITION BY company, customer_po ORDER BY downloaded_at) AS INTEGER)
      AS arrival,
    CAST(row_number() OVER (PARTITION BY company, customer_po ORDER BY downloaded_at, source_id)
      AS INTEGER) AS version
  FROM po
),
done AS (
  SELECT o_orderkey + 1 AS id, o_orderkey % 5 <> 0 AS details, o_orderkey % 3 = 0 AS store
  FROM orders
),
pack AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY source_id, p % 12 ORDER BY line_no) AS nth
    FROM line WHERE is_pack AND route IN ('KP', 'AK', 'AS', 'MS', 'BB'))
  WHERE nth = 1
),
component AS (
  SELECT pack.*, x.x AS x FROM pack JOIN (VALUES (0), (1), (2), (3)) AS x(x) ON x.x <= p % 4
)
"""

DETAIL = (
    "style, color, size, upc, sku, qty, uom, unit_price, retail_price, inner_pack, "
    "qty_per_inner_pack, store_number"
)
HEAD = "source_id, company, po_type, customer_po, date_downloaded"


def _where(routes: list[str] | None) -> str:
    return f"route IN ({', '.join(repr(r) for r in routes)})" if routes else "TRUE"


def details(routes: list[str] | None = None) -> str:
    return (
        BASE
        + f"SELECT 'details-' || source_id AS header_id, source_id, customer_po, {DETAIL} "
        + f"FROM alloc WHERE {_where(routes)}"
    )


def totals(select: str, routes: list[str] | None = None) -> str:
    """Header rows with the order's totals beside them."""
    return (
        BASE
        + ", total AS (SELECT source_id, "
        + "CAST(count(DISTINCT CASE WHEN route = 'MS' THEN sku ELSE upc END) AS INTEGER) "
        + "AS total_items, CAST(sum(qty) AS BIGINT) AS total_qty, "
        + "CAST(sum(unit_price * qty) AS DECIMAL(29,2)) AS total_amount FROM alloc "
        + "GROUP BY source_id) "
        + f"SELECT {select} FROM ver LEFT JOIN total USING (source_id) WHERE {_where(routes)}"
    )


def style_color(routes: list[str] | None = None) -> str:
    return (
        BASE
        + "SELECT 'style_color-' || source_id AS header_id, source_id, customer_po, style, color, "
        + "CASE WHEN route = 'KP' THEN upc END AS upc, CAST(sum(qty) AS BIGINT) AS qty_ordered "
        + f"FROM counted WHERE {_where(routes)} "
        + "GROUP BY source_id, customer_po, style, color, CASE WHEN route = 'KP' THEN upc END"
    )


def store(routes: list[str] | None = None) -> str:
    return (
        BASE
        + "SELECT 'store-' || source_id AS header_id, source_id, customer_po, "
        + "CAST(store_number AS INTEGER) AS store_number, CAST(sum(qty) AS BIGINT) AS store_qty "
        + "FROM (SELECT source_id, customer_po, route, store_number, qty FROM counted "
        + "WHERE route <> 'MS' UNION ALL SELECT source_id, customer_po, route, "
        + "division_store, CAST(q AS INTEGER) FROM po LEFT JOIN numbered ON l_orderkey = k "
        + f"WHERE route = 'MS') WHERE {_where(routes)} "
        + "GROUP BY source_id, customer_po, store_number"
    )


def style_color_size(routes: list[str] | None = None) -> str:
    keys = "style, color, size, upc, sku, unit_price, retail_price"
    return (
        BASE
        + f"SELECT 'style_color_size-' || source_id AS header_id, source_id, customer_po, {keys}, "
        + "CAST(sum(qty) AS BIGINT) AS qty, "
        + "CAST(unit_price * sum(qty) AS DECIMAL(29,2)) AS amount "
        + f"FROM counted WHERE {_where(routes)} GROUP BY source_id, customer_po, {keys}"
    )


COMPONENT_SIZE = (
    "CASE WHEN route = 'MS' THEN CASE x % 3 WHEN 0 THEN 'S REGULAR' WHEN 1 THEN 'M TALL' "
    "ELSE 'L' END ELSE CASE x % 3 WHEN 0 THEN 'S' WHEN 1 THEN 'M' ELSE 'L' END END"
)


def prepack(routes: list[str] | None = None) -> str:
    return (
        BASE
        + "SELECT 'prepack-' || source_id AS header_id, source_id, customer_po, "
        + "CASE route WHEN 'KP' THEN 'G' || p WHEN 'MS' THEN 'P' || p WHEN 'BB' THEN NULL "
        + "ELSE 'ST' || (p % 40) END AS prepack_number, "
        + "CASE route WHEN 'KP' THEN 'B' || p WHEN 'MS' THEN 'P' || p WHEN 'BB' THEN NULL "
        + "ELSE 'G' || p END AS prepack_sku, "
        + "CASE WHEN route = 'BB' THEN style END AS prepack_style, "
        + "CASE WHEN route = 'BB' THEN first_color END AS prepack_color, "
        + "CASE WHEN route = 'BB' THEN 'PPK' || units END AS prepack_size, "
        + "CASE WHEN route IN ('KP', 'BB') THEN 'G' || p END AS prepack_upc, "
        + "'CS' || x || CASE WHEN route <> 'MS' THEN '' ELSE "
        + "CASE x % 3 WHEN 0 THEN ' (R)' WHEN 1 THEN ' (T)' ELSE ' (NULL)' END END "
        + "AS component_style, "
        + "'C' || ((p + x) % 4) AS component_color, "
        + f"{COMPONENT_SIZE} AS component_size, "
        + "CASE WHEN route IN ('KP', 'BB') THEN 'CG' || x END AS component_upc, "
        + "CASE route WHEN 'KP' THEN 'CB' || x WHEN 'MS' THEN 'CP' || x WHEN 'BB' THEN NULL "
        + "ELSE 'CG' || x END AS component_sku, "
        + "CAST(1 + (p + x) % 6 AS INTEGER) AS component_qty "
        + f"FROM component WHERE {_where(routes)}"
    )


def strict(report: str, tail: str) -> str:
    """Allocations paired by the report's own keys, as ``paired`` for ``tail``."""
    by_line = {
        "details": ["KS", "KP", "AK", "BB", "BS"],
        "store": ["KP", "BS"],
        "style_color": ["KS", "KP", "AK", "BB", "BS"],
        "style_color_size": ["KP", "BB", "BS"],
    }[report]
    by_style = {"details": ["KB"], "style_color": ["KB"]}.get(report, ["none"])
    return (
        BASE
        + f", paired AS (SELECT a.* EXCLUDE (qty, j, segment, idx), b.qty AS qty FROM slot a "
        + "JOIN slot b ON a.source_id = b.source_id AND a.upc = b.upc "
        + "AND a.segment = b.segment AND a.idx = b.idx "
        + f"AND (NOT a.{_where(by_line)} OR a.line_no = b.line_no) "
        + f"AND (NOT a.{_where(by_style)} OR a.style = b.style) "
        + "WHERE a.route <> 'MS' AND b.qty > 0 AND a.j <= 2 AND b.j <= 2 "
        + "UNION ALL BY NAME SELECT *, division_store AS store_number, "
        + "CAST(q AS INTEGER) AS qty FROM line WHERE route = 'MS'"
        + (
            " UNION ALL BY NAME SELECT *, CAST(NULL AS VARCHAR) AS store_number, "
            "CAST(NULL AS INTEGER) AS qty FROM line WHERE route IN ('KB', 'AS') AND NOT has_sdq"
            if report == "details"
            else ""
        )
        + (
            " UNION ALL BY NAME SELECT po.*, division_store AS store_number, "
            "CAST(NULL AS INTEGER) AS qty FROM po WHERE route = 'MS' "
            "AND k NOT IN (SELECT l_orderkey FROM numbered)"
            if report == "store"
            else ""
        )
        + ") "
        + tail
    )
