"""Column contract of the transaction table at its stages."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw columns with their types, and their standard names.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("InvoiceNo", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField("InvoiceDate", T.StringType()),
        T.StructField("UnitPrice", T.DoubleType()),
        T.StructField("CustomerID", T.StringType()),
        T.StructField("Country", T.StringType()),
    ]
)
STANDARD_NAMES = {
    "InvoiceNo": "invoice_no",
    "StockCode": "product_id",
    "Description": "product_description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "UnitPrice": "unit_price",
    "CustomerID": "customer_id",
    "Country": "country",
}
INVOICE_TIME_FORMAT = "M/d/yyyy H:mm"

STANDARD_SCHEMA = T.StructType(
    [T.StructField(STANDARD_NAMES[f.name], f.dataType) for f in RAW_SCHEMA]
)
STANDARD_COLUMNS = STANDARD_SCHEMA.names

UNKNOWN = "Unknown"
NO_DESCRIPTION = "No Description"
