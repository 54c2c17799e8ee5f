"""Fact table with point-in-time surrogate-key lookup."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions.exprs import date_key, event_date, first_key
from starmart.operators.intervals import as_of
from starmart.operators.joins import bounded_broadcast, has_at_most
from starmart.operators.skew import hot_keys, split_hot_join
from starmart.sources.buckets import cut

# Dimension projections up to this many rows (key + a few columns, < 100
# bytes a row) are broadcast after a row-count check.
MAX_BROADCAST_DIM_ROWS = 1_000_000
# Key sets of an increment (ids of ~20 bytes) broadcast after a row-count
# check; beyond this the semi / anti joins shuffle.
MAX_BROADCAST_KEYS = 5_000_000


def _join_dim(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
              cond: Callable[[], Column], small: bool, hot: Callable[[], list] | None) -> DataFrame:
    """Inner join of the (big) event side with a dimension: broadcast when
    the dimension is proven ``small``, else hot keys split off (``hot``
    finds them), else a plain equi-join (sort-merge, AQE-adjusted)."""
    if small:
        return left.join(F.broadcast(right), cond(), "inner")
    if hot is not None:
        return split_hot_join(left, right, left_key, right_key, cond, hot())
    return left.join(right, cond(), "inner")


def _small(dim: DataFrame, max_rows: int) -> bool:
    return max_rows > 0 and has_at_most(dim, max_rows)


def _hot(df: DataFrame, key: str, hot_share: float | None) -> Callable[[], list] | None:
    # hot relative to the whole input: no key brings more than
    # ``hot_share`` of silver into one task
    return (lambda: hot_keys(df, key, hot_share)) if hot_share else None


def _events(silver: DataFrame) -> DataFrame:
    return silver.select("order_id", "event_id", "customer_id", "product_id", "quantity",
                         "unit_price", "order_total", "status", "event_ts",
                         event_date().alias("_d"))


def with_versions(silver: DataFrame, dim_customer: DataFrame, hot_share: float | None = None,
                  max_broadcast_rows: int = MAX_BROADCAST_DIM_ROWS,
                  carry: Sequence[str] = ()) -> DataFrame:
    """Silver events (``_d``: the event's date) with the key of the customer
    version valid on that date, and the columns ``carry`` of that version: who
    needs them joins the dimension once instead of a second time by key."""
    s = _events(silver)
    dc = dim_customer.select(F.col("customer_id").alias("_dc_id"), "customer_key",
                             "start_date", "end_date", *carry)

    def on_customer():
        return ((F.col("customer_id") == F.col("_dc_id")) & (F.col("_d") >= F.col("start_date"))
                & (F.col("end_date").isNull() | (F.col("_d") < F.col("end_date"))))

    j = _join_dim(s, dc, "customer_id", "_dc_id", on_customer, _small(dc, max_broadcast_rows),
                  _hot(s, "customer_id", hot_share))
    return j.drop("_dc_id", "start_date", "end_date")


def with_own_products(events: DataFrame) -> DataFrame:
    """The product key where ``dim_product`` is made of these very events: it
    then has a row, keyed by md5 of the id, for every product id but NULL, so
    the join by id keeps the events that have an id and needs no shuffle."""
    return events.where(F.col("product_id").isNotNull()).withColumn("product_key", first_key("product_id"))


def fact_columns(events: DataFrame, *more: str) -> DataFrame:
    """The columns of the fact from events with both keys, and ``more``."""
    return events.select("order_id", "event_id", "customer_key", "product_key",
                         date_key("event_ts").alias("date_key"), "quantity", "unit_price",
                         "order_total", "status", "event_ts", *more)


def fact_orders(silver: DataFrame, dim_customer: DataFrame, dim_product: DataFrame,
                hot_share: float | None = None,
                max_broadcast_rows: int = MAX_BROADCAST_DIM_ROWS) -> DataFrame:
    """One row per silver order event with the customer version valid on the
    event's date (half-open ``[start_date, end_date)``) and the product key.

    Inner joins, as in the reference: events of customers without a valid
    version (or without a customer id) are not in the fact.  Both joins are
    equi-joins (customer_id, product_id) – the date range is a residual – so
    they are never nested loops.  Per dimension: broadcast when a row-count
    check proves it small; otherwise, with ``hot_share``, the customers /
    products holding at least that share of silver are joined on their own
    (their dimension rows broadcast after a check, or salted) – a hot key
    never lands in one task, even where AQE cannot split it (a dimension
    coming out of an aggregate already partitioned by its key has no shuffle
    stage of its own); the rest is a sort-merge join that AQE may still
    adjust at run time."""
    j = with_versions(silver, dim_customer, hot_share, max_broadcast_rows)
    dp = dim_product.select(F.col("product_id").alias("_dp_id"), "product_key")
    j = _join_dim(j, dp, "product_id", "_dp_id", lambda: F.col("product_id") == F.col("_dp_id"),
                  _small(dp, max_broadcast_rows), _hot(_events(silver), "product_id", hot_share))
    return fact_columns(j)


def fact_orders_sweep(silver: DataFrame, dim_customer: DataFrame, dim_product: DataFrame,
                      hot_share: float | None = None, partitions: int | None = None) -> DataFrame:
    """The same fact with the customer version found by a sorted sweep: linear
    in events plus versions, for customers of very many versions.  The product
    key is joined as in ``fact_orders``."""
    s = silver.select("order_id", "event_id", "customer_id", "product_id", "quantity", "unit_price", "order_total", "status",
                      "event_ts", event_date().alias("_d"))
    s = as_of(s, dim_customer, "customer_id", "_d", "start_date", "end_date", ["customer_key"], partitions=partitions)
    dp = dim_product.select(F.col("product_id").alias("_dp_id"), "product_key")
    hot = (lambda: hot_keys(s, "product_id", hot_share)) if hot_share else None
    j = _join_dim(s, dp, "product_id", "_dp_id", lambda: F.col("product_id") == F.col("_dp_id"), False, hot)
    return j.select("order_id", "event_id", "customer_key", "product_key", date_key("event_ts").alias("date_key"), "quantity",
                    "unit_price", "order_total", "status", "event_ts")


def changed_keys(current: DataFrame, previous: DataFrame, key: str) -> DataFrame:
    """Keys whose rows differ between two snapshots of a dimension (new,
    changed or removed rows) – one EXCEPT each way, dimension-sized."""
    return (current.subtract(previous).select(key)
            .unionByName(previous.subtract(current).select(key))
            .distinct())


def fact_orders_incremental(previous_fact: DataFrame, silver: DataFrame,
                            dim_customer: DataFrame, dim_product: DataFrame,
                            touched_events: DataFrame, changed_customers: DataFrame,
                            hot_share: float | None = None,
                            max_broadcast_rows: int = MAX_BROADCAST_DIM_ROWS) -> DataFrame:
    """Exact incremental form of ``fact_orders(silver, dim_customer, dim_product)``.

    A previous fact row can only change when its event was touched by the
    silver increment (added, replaced or removed) or when its customer's
    dimension rows changed (closed / new versions, inserted customers):
    product keys are md5 of the product id and never change.  Those events
    are rebuilt; every other row is kept as it is.  Matching on event id is
    NULL-safe (silver may hold one event without an id).  The id sets are
    broadcast after a row-count check, so neither silver nor the previous
    fact is shuffled for a small increment."""
    changed = bounded_broadcast(changed_customers, MAX_BROADCAST_KEYS)
    # the id set feeds a size check and two joins: written once instead of
    # scanning silver 3 times
    affected = bounded_broadcast(cut(
        touched_events.select(F.col("event_id").alias("_eid"))
        .unionByName(silver.join(changed, "customer_id", "left_semi")
                     .select(F.col("event_id").alias("_eid")))
        .distinct(), "affected"), MAX_BROADCAST_KEYS)
    keep = previous_fact.join(affected, previous_fact["event_id"].eqNullSafe(affected["_eid"]),
                              "left_anti")
    redo_input = silver.join(affected, silver["event_id"].eqNullSafe(affected["_eid"]),
                             "left_semi")
    redo = fact_orders(redo_input, dim_customer, dim_product, hot_share, max_broadcast_rows)
    return keep.select(*redo.columns).unionByName(redo)


def by_status_day(fact: DataFrame, partitions: int) -> DataFrame:
    """The fact with ``event_day``, dealt by ranges for a layout partitioned by
    status and day: a task writes few folders and a hot day has many tasks."""
    return fact.withColumn("event_day", event_date()).repartitionByRange(partitions, "status", "event_day", "event_id")
