"""The base sales table."""

from __future__ import annotations

from pyspark.sql import types as T

from shelfline.functions.numeric import MONEY

SALES_SCHEMA = T.StructType(
    [
        T.StructField("Store_Name", T.StringType()),
        T.StructField("Item_Code", T.StringType()),
        T.StructField("Item_Barcode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Category", T.StringType()),
        T.StructField("Department", T.StringType()),
        T.StructField("Sub_Department", T.StringType()),
        T.StructField("Section", T.StringType()),
        T.StructField("Quantity", MONEY),
        T.StructField("Total_Sales", MONEY),
        T.StructField("RRP", MONEY),
        T.StructField("Supplier", T.StringType()),
        T.StructField("Date_Of_Sale", T.DateType()),
    ]
)

NUMERIC_COLUMNS = ["Quantity", "Total_Sales", "RRP"]
TEXT_COLUMNS = [f.name for f in SALES_SCHEMA if isinstance(f.dataType, T.StringType)]
DATE_COLUMN = "Date_Of_Sale"

# A load without these columns is refused.
REQUIRED_COLUMNS = ["Store_Name", "Item_Code", "Quantity", "Total_Sales", "Supplier", "Date_Of_Sale"]
# A cleaned row without these values is rejected.
CRITICAL_COLUMNS = ["Store_Name", "Description", "Quantity", "Total_Sales"]
# A load in which one of these is missing anywhere is refused.
KEY_COLUMNS = ["Store_Name", "Item_Code"]
