"""Type-1 dimensions: product and calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions.exprs import calendar_columns, event_date, first_key


def dim_product(silver: DataFrame) -> DataFrame:
    """One row per product id carrying its newest attributes (by event time,
    then event id), keyed by ``md5(product_id)``.  Latest-wins keeps the key
    unique even if a name or category drifts, so the fact join cannot fan out.
    A grouped aggregate: partial results are combined before the shuffle."""
    newest = F.max_by(F.struct("product_name", "product_category"),
                      F.struct("event_ts", "event_id"))
    return (silver.groupBy("product_id")
            .agg(newest.alias("_a"))
            .select(first_key("product_id").alias("product_key"), "product_id",
                    F.col("_a.product_name").alias("product_name"),
                    F.col("_a.product_category").alias("product_category")))


def dim_date(silver: DataFrame) -> DataFrame:
    """Calendar between the first and last event date of silver.

    The bounds stay inside the plan (a one-row global aggregate, computed
    from per-partition partials) – no driver round trip; NULL bounds (empty
    silver) yield no rows.  The date range is bounded by the calendar, not by
    the data volume."""
    bounds = silver.agg(F.min(event_date()).alias("lo"), F.max(event_date()).alias("hi"))
    days = bounds.select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("full_date"))
    return days.select(*calendar_columns("full_date"))
