"""Order events derived from the driver's TPC-H-style tables.

One event per ``lineitem`` row (nothing is dropped or sampled).  The mapping
is deterministic; arithmetic rules on the keys plant the dirt every stage must
handle – NULL ids, negative totals, a status outside the domain, customers
whose name or region changes at a date, and redeliveries (``lineitem`` has
repeated ``(l_orderkey, l_linenumber)`` pairs, each with its own ship date
used as ingestion time).  The same mapping is written in SQL in
``starmart.plans.oracle.ORDER_EVENTS_SQL``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions.schemas import BRONZE_COLUMNS, INGEST_SOURCE
from starmart.operators.joins import bounded_broadcast

# ---------------------------------------------------------------------------
# Fixed values of the fixture mapping.
NULL_ORDER_ID_EVERY = 197        # (l_orderkey + l_linenumber) % 197 = 0 -> order_id NULL
NULL_CUSTOMER_ID_EVERY = 211     # (l_orderkey + l_linenumber) % 211 = 0 -> customer_id NULL
RENAMED_CUSTOMER_EVERY = 11      # c_custkey % 11 = 0: name + ' II' from RENAME_FROM
RENAME_FROM = dt.date(1999, 1, 1)
MOVED_CUSTOMER_EVERY = 7         # c_custkey % 7 = 0: next region from MOVE_FROM
MOVE_FROM = dt.date(1998, 7, 1)
NEGATIVE_TOTAL_EVERY = 101       # (l_orderkey * 7 + l_suppkey) % 101 = 0 -> total negated
TEST_ORDER_EVERY = 89            # o_orderkey % 89 = 0 -> status 'TEST'
REGION_COUNT = 5                 # TPC-H: 5 regions, 25 nations (fixed by the spec)
NATION_COUNT = 25
# ---------------------------------------------------------------------------


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation -> (region name, next region name); 25 rows by the TPC-H spec."""
    region = _read(spark, sf_dir, "region")
    nation = _read(spark, sf_dir, "nation")
    r = bounded_broadcast(region.select("r_regionkey", "r_name"), REGION_COUNT)
    r2 = r.select(F.col("r_regionkey").alias("r2_key"), F.col("r_name").alias("r2_name"))
    return (nation.select("n_nationkey", "n_regionkey")
            .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
            .join(r2, F.col("r2_key") == (F.col("r_regionkey") + 1) % REGION_COUNT)
            .select("n_nationkey", "r_name", "r2_name"))


ORDER_KEY = "_order"


PRODUCT_NAMES = ("product_name", "product_category")


def order_events(spark: SparkSession, sf_dir: str, with_order_key: bool = False, named_products: bool = True) -> DataFrame:
    """Bronze-shaped order events (``BRONZE_COLUMNS``) for one scale factor.
    ``with_order_key`` adds ORDER_KEY, the key of the last join: events of one
    order lie together, so a window per order and event needs no shuffle.
    Without ``named_products`` lines carry only the price of their part, not
    PRODUCT_NAMES; of parts that share a key only the one that the newest-first
    order, which ends with name, category and price, would pick is joined.

    Join order keeps the biggest input (lineitem) to two shuffles: orders are
    joined to customers first (orders-sized), lineitem to parts, then the two
    results meet on the order key; what lines alone decide (status, sign) is
    computed before they are shuffled.  Only the 25-row geography is broadcast
    (checked); every other join is left to Catalyst/AQE by measured size."""
    geo = bounded_broadcast(geography(spark, sf_dir), NATION_COUNT)
    customer = (_read(spark, sf_dir, "customer")
                .select("c_custkey", "c_name", "c_nationkey")
                .join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
                .drop("c_nationkey", "n_nationkey"))
    orders = (_read(spark, sf_dir, "orders")
              .select("o_orderkey", "o_custkey", "o_orderdate")
              .join(customer, F.col("o_custkey") == F.col("c_custkey")))
    part = _read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    if not named_products:
        part = (part.groupBy("p_partkey").agg(F.max(F.struct("p_name", "p_type", "p_retailprice")).alias("_p"))
                .select("p_partkey", F.col("_p.p_retailprice").alias("p_retailprice")))
    status = (F.when(F.col("l_orderkey") % TEST_ORDER_EVERY == 0, F.lit("TEST"))
              .when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), F.lit("REFUNDED"))
              .when(F.col("l_returnflag") == "R", F.lit("CANCELLED"))
              .when(F.col("l_returnflag") == "A", F.lit("SHIPPED"))
              .when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"), F.lit("PAID"))
              .when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), F.lit("PLACED")))
    total = (F.when((F.col("l_orderkey") * 7 + F.col("l_suppkey")) % NEGATIVE_TOTAL_EVERY == 0, -F.col("l_extendedprice"))
             .otherwise(F.col("l_extendedprice")))
    lines = (_read(spark, sf_dir, "lineitem")
             .select("l_orderkey", "l_partkey", "l_linenumber", F.col("l_quantity").cast("int").alias("quantity"),
                     total.alias("order_total"), status.alias("status"), "l_shipdate")
             .join(part, F.col("l_partkey") == F.col("p_partkey")))
    j = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    names = [F.col("p_name").alias("product_name"), F.col("p_type").alias("product_category")] if named_products else []
    line_no = F.col("l_orderkey") + F.col("l_linenumber")
    return j.select(
        F.col("l_orderkey").alias(ORDER_KEY),
        F.concat_ws("-", F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("event_id"),
        F.when(line_no % NULL_ORDER_ID_EVERY == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("O"), F.col("o_orderkey").cast("string"))).alias("order_id"),
        F.when(line_no % NULL_CUSTOMER_ID_EVERY == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("C"), F.col("c_custkey").cast("string"))).alias("customer_id"),
        F.when((F.col("c_custkey") % RENAMED_CUSTOMER_EVERY == 0)
               & (F.col("o_orderdate") >= F.lit(RENAME_FROM)),
               F.concat(F.col("c_name"), F.lit(" II"))).otherwise(F.col("c_name")).alias("customer_name"),
        F.when((F.col("c_custkey") % MOVED_CUSTOMER_EVERY == 0)
               & (F.col("o_orderdate") >= F.lit(MOVE_FROM)),
               F.col("r2_name")).otherwise(F.col("r_name")).alias("customer_region"),
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("product_id"),
        *names,
        F.col("p_retailprice").alias("unit_price"),
        "quantity", "order_total", "status",
        F.col("o_orderdate").cast("timestamp_ntz").alias("event_ts"),
        F.lit(INGEST_SOURCE).alias("ingest_source"),
        F.col("l_shipdate").cast("timestamp").alias("_ingested_at"),
    ).select(*([ORDER_KEY] if with_order_key else []), *[c for c in BRONZE_COLUMNS if named_products or c not in PRODUCT_NAMES])
