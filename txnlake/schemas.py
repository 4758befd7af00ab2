"""Declared schemas: raw feed, processed lines and the nine warehouse tables."""

from pyspark.sql import types as T

RAW_COLUMNS = ["InvoiceNo", "StockCode", "Description", "Quantity",
               "InvoiceDate", "UnitPrice", "CustomerID", "Country"]

# Raw feed as typed after T1/T2 (the CSV reader takes strings for the two
# coerced columns, see sources.files).
RAW_SCHEMA = T.StructType([
    T.StructField("InvoiceNo", T.StringType()),
    T.StructField("StockCode", T.StringType()),
    T.StructField("Description", T.StringType()),
    T.StructField("Quantity", T.IntegerType()),
    T.StructField("InvoiceDate", T.TimestampNTZType()),
    T.StructField("UnitPrice", T.DoubleType()),
    T.StructField("CustomerID", T.IntegerType()),
    T.StructField("Country", T.StringType()),
])

# The two raw files as they arrive (aligned by row position).
IDS_FILE_SCHEMA = T.StructType([
    T.StructField("InvoiceNo", T.StringType()),
    T.StructField("StockCode", T.StringType()),
])
FEATURES_FILE_SCHEMA = T.StructType([
    T.StructField("Description", T.StringType()),
    T.StructField("Quantity", T.IntegerType()),
    T.StructField("InvoiceDate", T.StringType()),
    T.StructField("UnitPrice", T.DoubleType()),
    T.StructField("CustomerID", T.StringType()),
    T.StructField("Country", T.StringType()),
])

PRICE = T.DecimalType(10, 2)
MONEY = T.DecimalType(12, 2)

DIM_PRODUCT = T.StructType([
    T.StructField("stock_code", T.StringType()),
    T.StructField("description", T.StringType()),
])
DIM_CUSTOMER = T.StructType([T.StructField("customer_id", T.IntegerType())])
DIM_COUNTRY = T.StructType([
    T.StructField("country_key", T.IntegerType()),
    T.StructField("country", T.StringType()),
])
DIM_DATE = T.StructType([
    T.StructField("date_key", T.IntegerType()),
    T.StructField("full_date", T.DateType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("month_name", T.StringType()),
    T.StructField("week", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("day_name", T.StringType()),
])

_FACT_BODY = [
    T.StructField("row_hash", T.StringType()),
    T.StructField("invoice_no", T.StringType()),
    T.StructField("stock_code", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("invoice_date", T.TimestampNTZType()),
    T.StructField("unit_price", PRICE),
    T.StructField("customer_id", T.IntegerType()),
    T.StructField("country_key", T.IntegerType()),
    T.StructField("revenue", MONEY),
    T.StructField("date_key", T.IntegerType()),
]


def _fact(id_name: str) -> T.StructType:
    return T.StructType([T.StructField(id_name, T.LongType())] + _FACT_BODY)


FACT_SALES = _fact("sale_id")
FACT_CANCELLATIONS = _fact("cancel_id")
FACT_ADJUSTMENT = _fact("adjustment_id")
FACT_NON_SALE = T.StructType([
    T.StructField("non_sale_id", T.LongType()),
    T.StructField("row_hash", T.StringType()),
    T.StructField("invoice_no", T.StringType()),
    T.StructField("stock_code", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("invoice_date", T.TimestampNTZType()),
    T.StructField("unit_price", PRICE),
    T.StructField("customer_id", T.IntegerType()),
    T.StructField("country_key", T.IntegerType()),
    T.StructField("transaction_type", T.StringType()),
    T.StructField("date_key", T.IntegerType()),
])
DQ_DUPLICATES = T.StructType([
    T.StructField("quality_issue_id", T.LongType()),
    T.StructField("invoice_no", T.StringType()),
    T.StructField("stock_code", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("description", T.StringType()),
    T.StructField("invoice_date", T.TimestampNTZType()),
    T.StructField("unit_price", PRICE),
    T.StructField("customer_id", T.IntegerType()),
    T.StructField("country", T.StringType()),
    T.StructField("transaction_type", T.StringType()),
    T.StructField("issue_type", T.StringType()),
    T.StructField("duplicate_group_count", T.IntegerType()),
])

# Processed lines as written (S3), for formats that carry no types.
PROCESSED_SCHEMA = T.StructType(list(RAW_SCHEMA.fields) + [
    T.StructField("TransactionType", T.StringType()),
    T.StructField("_ord", T.LongType()),
    T.StructField("IsExactDuplicate", T.BooleanType()),
    T.StructField("IsPotentialDuplicateLine", T.BooleanType()),
    T.StructField("duplicate_group_count", T.IntegerType()),
    T.StructField("OriginalType", T.StringType()),
    T.StructField("SignedQuantity", T.IntegerType()),
    T.StructField("sub_rank", T.IntegerType()),
    T.StructField("revenue", T.DoubleType()),
    T.StructField("kind", T.StringType()),
])

WAREHOUSE_SCHEMAS = {
    "dim_product": DIM_PRODUCT,
    "dim_customer": DIM_CUSTOMER,
    "dim_country": DIM_COUNTRY,
    "dim_date": DIM_DATE,
    "fact_sales": FACT_SALES,
    "fact_cancellations": FACT_CANCELLATIONS,
    "fact_adjustment": FACT_ADJUSTMENT,
    "fact_non_sale": FACT_NON_SALE,
    "data_quality_potential_duplicates": DQ_DUPLICATES,
}
