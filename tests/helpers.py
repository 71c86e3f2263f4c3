"""Small sales tables and result comparison."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from shelfline.sources.schema import SALES_SCHEMA


def sale(**changes):
    """A flawless sales row, with some fields changed."""
    row = {
        "Store_Name": "North  Mall", "Item_Code": "10", "Item_Barcode": "0001", "Description": "Tea",
        "Category": "Foods", "Department": "Drinks", "Sub_Department": "Hot", "Section": "Tea",
        "Quantity": 2, "Total_Sales": 20, "RRP": 10, "Supplier": "Other Ltd", "Date_Of_Sale": date(2025, 9, 22),
    }
    row.update(changes)
    for name in ("Quantity", "Total_Sales", "RRP"):
        if row[name] is not None:
            row[name] = Decimal(str(row[name]))
    return tuple(row[f.name] for f in SALES_SCHEMA)


def sales_frame(spark, rows):
    return spark.createDataFrame(rows, SALES_SCHEMA)


def plain(value):
    return float(value) if isinstance(value, Decimal) else value


def rows_of(df, *columns):
    """Rows as sorted tuples with decimals as floats."""
    found = df.select(*columns) if columns else df
    return sorted((tuple(plain(v) for v in row) for row in found.collect()), key=str)


def first(df):
    found = df.collect()
    assert len(found) == 1
    return {k: plain(v) for k, v in found[0].asDict().items()}
