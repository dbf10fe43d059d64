import json
import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderloom.session import local_session
from orderloom.sources.tables import INBOUND_SCHEMA

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "4", **{"spark.sql.shuffle.partitions": "2"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


def line(**fields):
    """A line document; ``sdq``, ``bom`` and ``size`` take nested values."""
    nested = {}
    if "sdq" in fields:
        nested["DestinationInfo"] = {"SDQ": fields.pop("sdq")}
    if "bom" in fields:
        nested["BOMDetails"] = fields.pop("bom")
    if "size" in fields:
        nested["VendorSizeDescription"] = fields.pop("size")
    base = {
        "LineItemId": "1",
        "VendorItemNumber": "A1234",
        "ColorDescription": "RED",
        "SizeDescription": "M",
        "GTIN": "G1",
        "ProductId": "P1",
        "BuyerPartNumber": "B1",
        "UOMTypeCode": "EA",
        "UnitPrice": "2.50",
        "SalesPrice": "5.00",
        "RetailPrice": "6.00",
        "Pack": "2",
        "PackSize": "3",
        "Quantity": "7.0",
    }
    return {**base, **fields, **nested}


def order(lines, company="Kohls", kind="BULK", code="NE", po="PO1", **header):
    body = {
        "ReferencePOType": kind,
        "DepartmentNumber": "D1",
        "RequestedShipDate": "20240110",
        "DoNotDeliveryBefore": "20240112",
        "CancelDate": "20240131",
        "DivisionIdentifier": "0045",
        **header,
    }
    if lines is not None:
        body["PurchaseOrderDetails"] = lines
    return {
        "PurchaseOrderHeader": {
            "PurchaseOrderNumber": po,
            "CompanyCode": company,
            "PurchaseOrderTypeCode": code,
            "PurchaseOrder": body,
        }
    }


@pytest.fixture
def inbound(spark):
    """Staging rows from documents, (document, created) pairs or raw text."""

    def build(*documents, company=None):
        rows = []
        for position, document in enumerate(documents):
            created = datetime(2024, 1, 1, 8)
            if isinstance(document, tuple):
                document, created = document
            text = document if isinstance(document, str) else json.dumps(document)
            code = company
            if code is None:
                code = (
                    document["PurchaseOrderHeader"]["CompanyCode"]
                    if isinstance(document, dict)
                    else "Kohls"
                )
            rows.append((position + 1, text, created, code, "850", "Downloaded"))
        return spark.createDataFrame(rows, INBOUND_SCHEMA)

    return build


def rows(frame, *columns):
    """Collected rows as sorted tuples."""
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple(map(str, r)))
