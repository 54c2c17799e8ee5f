"""Schemas and fixed domain values of the order-event pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results).
# Valid order statuses, in the reference's order:
VALID_STATUSES = ("PLACED", "PAID", "SHIPPED", "CANCELLED", "REFUNDED")
# Statuses that do not count as revenue:
NON_REVENUE_STATUSES = ("CANCELLED", "REFUNDED")
# Quality gate: share of NULL ids / non-positive totals tolerated in bronze:
GATE_THRESHOLD = 0.02
# Value of ``ingest_source`` written by the checkout service:
INGEST_SOURCE = "checkout-service-v2"
# Kafka topic of raw order events:
ORDERS_TOPIC = "orders.raw"
# ---------------------------------------------------------------------------

# Raw event as it arrives (JSON line or Kafka value); all fields nullable and
# ``event_ts`` still a string (ISO-8601 without zone).
EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("customer_region", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("product_category", T.StringType()),
    T.StructField("unit_price", T.DoubleType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("order_total", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("event_ts", T.StringType()),
    T.StructField("ingest_source", T.StringType()),
])

EVENT_COLUMNS = [f.name for f in EVENT_SCHEMA.fields]

# ``event_ts`` carries no zone, so it is typed as a wall-clock timestamp
# (TIMESTAMP_NTZ): its date and date_key never move with the session zone.
BRONZE_SCHEMA = T.StructType(
    [f if f.name != "event_ts" else T.StructField("event_ts", T.TimestampNTZType())
     for f in EVENT_SCHEMA.fields]
    + [T.StructField("_ingested_at", T.TimestampType())]
)
BRONZE_COLUMNS = [f.name for f in BRONZE_SCHEMA.fields]

DIM_CUSTOMER_SCHEMA = T.StructType([
    T.StructField("customer_key", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("customer_region", T.StringType()),
    T.StructField("start_date", T.DateType()),
    T.StructField("end_date", T.DateType()),
    T.StructField("is_current", T.BooleanType()),
])

DIM_PRODUCT_SCHEMA = T.StructType([
    T.StructField("product_key", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("product_category", T.StringType()),
])

DIM_DATE_SCHEMA = T.StructType([
    T.StructField("date_key", T.IntegerType()),
    T.StructField("full_date", T.DateType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("day_of_week", T.StringType()),
    T.StructField("is_weekend", T.BooleanType()),
    T.StructField("week_of_year", T.IntegerType()),
])

FACT_ORDERS_SCHEMA = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("customer_key", T.StringType()),
    T.StructField("product_key", T.StringType()),
    T.StructField("date_key", T.IntegerType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", T.DoubleType()),
    T.StructField("order_total", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("event_ts", T.TimestampNTZType()),
])

CONTRACTS = {
    "dim_customer": DIM_CUSTOMER_SCHEMA,
    "dim_product": DIM_PRODUCT_SCHEMA,
    "dim_date": DIM_DATE_SCHEMA,
    "fact_orders": FACT_ORDERS_SCHEMA,
}


class ContractError(ValueError):
    pass


def check_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Write-time schema enforcement: names and types must match the contract
    (order-insensitive); the frame is returned in contract column order."""
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in contract.fields if f.name not in have]
    wrong = [f"{f.name}: {have[f.name].simpleString()} != {f.dataType.simpleString()}"
             for f in contract.fields if f.name in have and have[f.name] != f.dataType]
    extra = [n for n in have if n not in {f.name for f in contract.fields}]
    if missing or wrong or extra:
        raise ContractError(f"schema mismatch: missing={missing} wrong={wrong} extra={extra}")
    return df.select(*[f.name for f in contract.fields])
