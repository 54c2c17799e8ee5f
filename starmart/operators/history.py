"""Full attribute history of a customer from its events (one version per
real change of name or region), the documented goal of the type-2
dimension that a two-load MERGE only approximates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions.exprs import event_date, first_key
from starmart.operators.scd2 import DIM_COLUMNS, TRACKED
from starmart.operators.sequence import with_neighbor

ORDER = ("event_ts", "event_id")


def scd2_full_history(silver: DataFrame, partitions: int | None = None) -> DataFrame:
    """Versions ``[start_date, end_date)`` per customer.

    An event opens a version when its (name, region) is distinct (NULL-safe)
    from the customer's previous event under (event_ts, event_id).  A
    version ends where the next one starts; the last one is current.  Keys:
    the first version ``md5(customer_id)``, later ones
    ``md5(customer_id|start_date|first event id)`` (unique, deterministic)."""
    ev = (silver.where(F.col("customer_id").isNotNull())
          .select("customer_id", *ORDER, *TRACKED))
    ev = with_neighbor(ev, "customer_id", ORDER, TRACKED, "prev", "_prev", partitions)
    opens = (F.col("_prev").isNull()
             | ~F.col("customer_name").eqNullSafe(F.col("_prev.customer_name"))
             | ~F.col("customer_region").eqNullSafe(F.col("_prev.customer_region")))
    starts = (ev.where(opens)
              .select("customer_id", *ORDER, *TRACKED,
                      F.col("_prev").isNull().alias("_first"),
                      event_date().alias("start_date")))
    starts = with_neighbor(starts, "customer_id", ORDER, ["start_date"], "next", "_next", partitions)
    key = F.when(F.col("_first"), first_key("customer_id")).otherwise(
        F.md5(F.concat_ws("|", "customer_id", F.col("start_date").cast("string"), "event_id")))
    return starts.select(
        key.alias("customer_key"), "customer_id", *TRACKED, "start_date",
        F.col("_next.start_date").alias("end_date"),
        F.col("_next").isNull().alias("is_current"),
    ).select(*DIM_COLUMNS)
