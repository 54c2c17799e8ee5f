"""Gold tables with a definition: typed columns, properties, buckets and order.

``create`` declares a table in the session's catalog over a folder of the lake;
``load`` inserts by position after a check of names, under ANSI store
assignment, so a column of the wrong type is refused when the plan is made.
Fact and customer dimension are clustered by the customer key into the same
number of buckets: their join, and aggregates by that key, read the buckets
side by side without shuffling the fact.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.exprs import MONEY, is_revenue
from starmart.functions.schemas import ContractError

BUCKETS = 16
STORE_POLICY = "spark.sql.storeAssignmentPolicy"


def create(spark: SparkSession, name: str, schema: T.StructType, location: str, cluster_by: str,
           buckets: int = BUCKETS, properties: Mapping[str, str] | None = None, comment: str = "") -> str:
    """Declare a bucketed, sorted Parquet table and return its name, which is
    made unique: a session may hold several lakes."""
    full = f"{name}_{uuid.uuid4().hex[:8]}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    quoted = ", ".join(f"'{k}' = '{v}'" for k, v in (properties or {}).items())
    spark.sql(f"CREATE TABLE {full} ({columns}) USING parquet CLUSTERED BY (`{cluster_by}`) SORTED BY (`{cluster_by}`) "
              f"INTO {int(buckets)} BUCKETS LOCATION '{location}' COMMENT '{comment}'"
              + (f" TBLPROPERTIES ({quoted})" if quoted else ""))
    return full


def load(df: DataFrame, name: str, cluster_by: str, buckets: int = BUCKETS) -> None:
    """Replace the rows of a declared table.  Names must be those of the table;
    types are checked by the store assignment.  Rows are dealt by the bucket
    key first, so every bucket is one file."""
    spark = df.sparkSession
    want = spark.table(name).columns
    if sorted(df.columns) != sorted(want):
        raise ContractError(f"columns of {name} are {want}, not {df.columns}")
    before = spark.conf.get(STORE_POLICY)
    spark.conf.set(STORE_POLICY, "ANSI")
    try:
        df.select(*want).repartition(buckets, cluster_by).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(STORE_POLICY, before)


def revenue_by_region(spark: SparkSession, fact: str, customers: str) -> DataFrame:
    """Revenue, orders and customers per region of the current versions, from
    the bucketed tables: one row per customer key is summed in its bucket."""
    sold = (spark.table(fact).where(is_revenue("status")).groupBy("customer_key")
            .agg(F.sum(F.col("order_total").cast(MONEY)).alias("amount"), F.count("*").alias("n")))
    current = spark.table(customers).where("is_current").select("customer_key", "customer_region")
    return (sold.join(current.hint("merge"), "customer_key").groupBy("customer_region")
            .agg(F.round(F.sum("amount").cast("double"), 2).alias("revenue"), F.sum("n").alias("order_count"), F.count("*").alias("customers")))
