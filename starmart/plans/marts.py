"""Serving queries over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions.exprs import MONEY, is_revenue
from starmart.operators.joins import bounded_broadcast, has_at_most

# A single customer's versions: far below this, checked before broadcasting.
MAX_VERSIONS_PER_CUSTOMER = 100_000
# Dimension projections (key + one attribute, ~60 bytes a row) up to this many
# rows are broadcast to the fact scan; larger ones take the shuffle plan.
MAX_BROADCAST_DIM_ROWS = 1_000_000
MAX_DAYS = 100_000   # days of a calendar that is broadcast: 270 years

GROUP = ("customer_region", "product_category")
# Columns of the customer version that a fact may carry from its own lookup:
# the marts then take no customer dimension (None) and do not join it again.
VERSION = ("customer_region", "is_current")


def _sold(fact: DataFrame) -> DataFrame:
    # status is the fact's partition column: this becomes a partition filter
    # on a partitioned fact table.
    return fact.where(is_revenue("status")).select("customer_key", "product_key", "order_total")


def _sold_versions(fact: DataFrame, current_only: bool) -> DataFrame:
    sold = fact.where(is_revenue("status"))
    if current_only:
        sold = sold.where(F.col("is_current"))
    return sold.select("customer_region", "product_key", "order_total")


def _per_category(per_region: DataFrame, dp: DataFrame, count_name: str) -> DataFrame:
    return (per_region.join(dp, "product_key")
            .groupBy(*GROUP)
            .agg(F.round(F.sum("_s").cast("double"), 2).alias("revenue"),
                 F.sum("_n").alias(count_name)))


def _by_region_category(fact: DataFrame, dim_customer: DataFrame | None, dim_product: DataFrame,
                        current_only: bool, count_name: str,
                        max_broadcast_rows: int | None = None) -> DataFrame:
    """Revenue and row count per (region, category).

    Dimensions proven small (row-count check) are broadcast to the fact
    scan.  Otherwise the aggregation is pushed below both joins:

    1. fact -> partial sums per (customer_key, product_key), combined map-side;
       the one fact-sized shuffle hashes the *pair*, so neither a hot customer
       nor a hot product lands in one task;
    2. join the customer dimension, re-aggregate per (region, product_key):
       a hot customer contributes at most one row per product it bought;
    3. join the product dimension: at most one row per (region, product) is
       left, so a hot product is a handful of rows; final sum per
       (region, category).

    A fact that carries VERSION (``dim_customer`` None) is summed per (region,
    product_key) at once: steps 1 and 2 and their two fact-sized shuffles fall away.

    Sums are exact (DECIMAL) at every level, so the result equals the
    row-level join + group by."""
    dp = dim_product.select("product_key", "product_category")
    bound = MAX_BROADCAST_DIM_ROWS if max_broadcast_rows is None else max_broadcast_rows
    if dim_customer is None:
        sold = _sold_versions(fact, current_only)
        if bound > 0 and has_at_most(dp, bound):
            return sold.join(F.broadcast(dp), "product_key").groupBy(*GROUP).agg(
                F.round(F.sum(F.col("order_total").cast(MONEY)).cast("double"), 2).alias("revenue"),
                F.count(F.lit(1)).alias(count_name))
        per_region = (sold.groupBy("customer_region", "product_key")
                      .agg(F.sum(F.col("order_total").cast(MONEY)).alias("_s"), F.count(F.lit(1)).alias("_n")))
        return _per_category(per_region, dp, count_name)
    dc = dim_customer
    if current_only:
        dc = dc.where(F.col("is_current"))
    dc = dc.select("customer_key", "customer_region")
    if bound > 0 and has_at_most(dc, bound) and has_at_most(dp, bound):
        # both dimensions proven small: broadcast them, no fact-sized shuffle
        # at all (hot keys cost nothing in a broadcast join); one partial +
        # final aggregate over the (region, category) groups
        j = _sold(fact).join(F.broadcast(dc), "customer_key").join(F.broadcast(dp), "product_key")
        return j.groupBy(*GROUP).agg(
            F.round(F.sum(F.col("order_total").cast(MONEY)).cast("double"), 2).alias("revenue"),
            F.count(F.lit(1)).alias(count_name))
    pairs = (_sold(fact).groupBy("customer_key", "product_key")
             .agg(F.sum(F.col("order_total").cast(MONEY)).alias("_s"),
                  F.count(F.lit(1)).alias("_n")))
    per_region = (pairs.join(dc, "customer_key")
                  .groupBy("customer_region", "product_key")
                  .agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n")))
    return _per_category(per_region, dp, count_name)


def revenue_top10(fact: DataFrame, dim_customer: DataFrame | None, dim_product: DataFrame,
                  k: int = 10) -> DataFrame:
    """Top-k (region, category) by revenue over current customer versions.
    Ties broken by region, category so the k rows are always the same."""
    agg = _by_region_category(fact, dim_customer, dim_product, True, "orders")
    return agg.orderBy(F.col("revenue").desc(), *GROUP).limit(k)


def sales_summary(fact: DataFrame, dim_customer: DataFrame | None, dim_product: DataFrame) -> DataFrame:
    """All (region, category) groups; revenue summed as decimal, rounded to cents once
    (presented as double), order_count as bigint."""
    agg = _by_region_category(fact, dim_customer, dim_product, True, "order_count")
    return agg.orderBy(F.col("revenue").desc(), *GROUP)


def revenue_as_was(fact: DataFrame, dim_customer: DataFrame | None, dim_product: DataFrame) -> DataFrame:
    """Revenue by the region a customer had when ordering: every version
    counts, not just the current one."""
    agg = _by_region_category(fact, dim_customer, dim_product, False, "order_count")
    return agg.orderBy(F.col("revenue").desc(), *GROUP)


# Revenue per (region, category) as SQL text, all regions or the bound one.
# Where both dimensions are measured small they are broadcast to the fact scan.
# Otherwise the fact is summed per (customer, product) pair before either join,
# so its one shuffle hashes the pair and no hot customer or product meets in
# one task.
SMALL_STAR_REVENUE_SQL = """
SELECT customer_region, product_category,
       ROUND(CAST(SUM(CAST(order_total AS DECIMAL(28,8))) AS DOUBLE), 2) AS revenue, COUNT(*) AS order_count
FROM {fact} JOIN {customers} USING (customer_key) JOIN {products} USING (product_key)
WHERE status NOT IN ('CANCELLED', 'REFUNDED') AND (:region IS NULL OR customer_region = :region)
GROUP BY customer_region, product_category
ORDER BY revenue DESC, customer_region, product_category
"""
STAR_REVENUE_SQL = """
WITH pair_totals AS (
  SELECT customer_key, product_key, SUM(CAST(order_total AS DECIMAL(28,8))) AS amount, COUNT(*) AS n
  FROM {fact} WHERE status NOT IN ('CANCELLED', 'REFUNDED') GROUP BY ALL
), current_customers AS (
  SELECT customer_key, customer_region FROM {customers}
  WHERE :region IS NULL OR customer_region = :region
), region_totals AS (
  SELECT customer_region, product_key, SUM(amount) AS amount, SUM(n) AS n
  FROM pair_totals JOIN current_customers USING (customer_key) GROUP BY ALL
)
SELECT customer_region, product_category,
       ROUND(CAST(SUM(amount) AS DOUBLE), 2) AS revenue, SUM(n) AS order_count
FROM region_totals JOIN {products} USING (product_key)
GROUP BY customer_region, product_category
ORDER BY revenue DESC, customer_region, product_category
"""
# The same over a fact that carries VERSION: the customers are not joined again.
SMALL_VERSION_REVENUE_SQL = """
SELECT customer_region, product_category,
       ROUND(CAST(SUM(CAST(order_total AS DECIMAL(28,8))) AS DOUBLE), 2) AS revenue, COUNT(*) AS order_count
FROM {fact} JOIN {products} USING (product_key)
WHERE status NOT IN ('CANCELLED', 'REFUNDED') AND is_current AND (:region IS NULL OR customer_region = :region)
GROUP BY customer_region, product_category
ORDER BY revenue DESC, customer_region, product_category
"""
VERSION_REVENUE_SQL = """
WITH region_totals AS (
  SELECT customer_region, product_key, SUM(CAST(order_total AS DECIMAL(28,8))) AS amount, COUNT(*) AS n
  FROM {fact}
  WHERE status NOT IN ('CANCELLED', 'REFUNDED') AND is_current AND (:region IS NULL OR customer_region = :region)
  GROUP BY ALL
)
SELECT customer_region, product_category,
       ROUND(CAST(SUM(amount) AS DOUBLE), 2) AS revenue, SUM(n) AS order_count
FROM region_totals JOIN {products} USING (product_key)
GROUP BY customer_region, product_category
ORDER BY revenue DESC, customer_region, product_category
"""


def _star_revenue_sql(fact: DataFrame, dim_customer: DataFrame | None, dim_product: DataFrame, region: str | None,
                      max_broadcast_rows: int | None) -> DataFrame:
    """The SQL text for the dimensions' measured sizes, over the given frames
    (no temp view is made or replaced)."""
    dp = dim_product.select("product_key", "product_category")
    bound = MAX_BROADCAST_DIM_ROWS if max_broadcast_rows is None else max_broadcast_rows
    if dim_customer is None:
        small = bound > 0 and has_at_most(dp, bound)
        text, dp = (SMALL_VERSION_REVENUE_SQL, F.broadcast(dp)) if small else (VERSION_REVENUE_SQL, dp)
        return fact.sparkSession.sql(text, args={"region": region}, fact=fact, products=dp)
    dc = dim_customer.where(F.col("is_current")).select("customer_key", "customer_region")
    text = STAR_REVENUE_SQL
    if bound > 0 and has_at_most(dc, bound) and has_at_most(dp, bound):
        text, dc, dp = SMALL_STAR_REVENUE_SQL, F.broadcast(dc), F.broadcast(dp)
    return fact.sparkSession.sql(text, args={"region": region}, fact=fact, customers=dc, products=dp)


def sales_summary_by_region(fact: DataFrame, dim_customer: DataFrame | None, dim_product: DataFrame,
                            region: str, max_broadcast_rows: int | None = None) -> DataFrame:
    """Sales summary of one region; the region is a bound SQL parameter,
    never pasted into the SQL text."""
    return _star_revenue_sql(fact, dim_customer, dim_product, region, max_broadcast_rows)


def revenue_by_week(fact_by_day: DataFrame, dim_date: DataFrame, year: int) -> DataFrame:
    """Revenue, orders and weekend orders per calendar week of one year, from a
    fact partitioned by status and ``event_day``.  The calendar is joined by
    day and filtered by its own attribute: which days those are is found at run
    time (dynamic partition pruning), and only their folders are read."""
    # no projection of its own: the pruning filter reuses the join's broadcast only while both have the same plan
    days = bounded_broadcast(dim_date.where(F.col("year") == year), MAX_DAYS)
    sold = fact_by_day.where(is_revenue("status")).select("event_day", "order_total")
    return (sold.join(days, F.col("event_day") == F.col("full_date")).groupBy("year", "week_of_year")
            .agg(F.round(F.sum(F.col("order_total").cast(MONEY)).cast("double"), 2).alias("revenue"), F.count("*").alias("order_count"),
                 F.count_if("is_weekend").alias("weekend_orders")))


def customer_ltv(fact: DataFrame, dim_customer: DataFrame, customer_id: str) -> DataFrame:
    """Lifetime value of one customer over all its versions; 0 when unknown.
    The id filter reaches the dimension scan; the customer's few versions are
    broadcast after a row-count check, so the fact is scanned (status
    partitions pruned) but never shuffled."""
    dc = bounded_broadcast(dim_customer.where(F.col("customer_id") == F.lit(customer_id))
                           .select("customer_key"), MAX_VERSIONS_PER_CUSTOMER)
    total = _sold(fact).join(dc, "customer_key").agg(
        F.sum(F.col("order_total").cast(MONEY)).alias("_s"))
    return total.select(F.lit(customer_id).alias("customer_id"),
                        F.round(F.coalesce(F.col("_s"), F.lit(0).cast(MONEY)).cast("double"), 2).alias("ltv"))


def customer_ltv_all(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Lifetime value of every customer of the dimension (0 when nothing was
    sold).  The fact is pre-aggregated per customer_key (partial aggregation
    before its shuffle), so the join to the dimension sees one row per key."""
    per_key = _sold(fact).groupBy("customer_key").agg(
        F.sum(F.col("order_total").cast(MONEY)).alias("_s"))
    j = dim_customer.select("customer_key", "customer_id").join(per_key, "customer_key", "left")
    return (j.groupBy("customer_id")
            .agg(F.round(F.coalesce(F.sum("_s"), F.lit(0).cast(MONEY)).cast("double"), 2).alias("ltv")))


def register_views(fact: DataFrame, dim_customer: DataFrame, dim_product: DataFrame,
                   dim_date: DataFrame | None = None) -> None:
    """Expose the gold tables to SQL as session temp views."""
    fact.createOrReplaceTempView("fact_orders")
    dim_customer.createOrReplaceTempView("dim_customer")
    dim_product.createOrReplaceTempView("dim_product")
    if dim_date is not None:
        dim_date.createOrReplaceTempView("dim_date")


def revenue_top10_sql(fact: DataFrame, dim_customer: DataFrame | None, dim_product: DataFrame,
                      max_broadcast_rows: int | None = None) -> DataFrame:
    """The flagship as SQL text over the gold frames."""
    return (_star_revenue_sql(fact, dim_customer, dim_product, None, max_broadcast_rows)
            .withColumnRenamed("order_count", "orders").limit(10))
