"""Raw invoice lines for tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

from txnlake.schemas import RAW_SCHEMA

DEFAULT_TS = dt.datetime(2010, 12, 1, 8, 26)


def raw_rows(spark, rows):
    """rows: dicts with any of the raw columns; defaults fill the rest.
    ``_ord`` is the row position."""
    full = []
    for i, r in enumerate(rows):
        full.append((
            r.get("InvoiceNo"), r.get("StockCode"), r.get("Description", "ITEM"),
            r.get("Quantity"), r.get("InvoiceDate", DEFAULT_TS), r.get("UnitPrice"),
            r.get("CustomerID"), r.get("Country", "United Kingdom"), i,
        ))
    schema = T.StructType(list(RAW_SCHEMA.fields) + [T.StructField("_ord", T.LongType())])
    return spark.createDataFrame(full, schema)


def line(inv, code, qty, price, cust=None, **kw):
    d = {"InvoiceNo": inv, "StockCode": code, "Quantity": qty, "UnitPrice": price, "CustomerID": cust}
    d.update(kw)
    return d
