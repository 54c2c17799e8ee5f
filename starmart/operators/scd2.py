"""Type-2 customer dimension: first load, change detection, close + insert,
a general conditional MERGE, full attribute history and as-of lookup.

No table format with row-level updates is needed: a MERGE is one DataFrame
plan (target left-joined with the change set, closed rows rewritten, new
versions unioned) whose result is published as a new snapshot, so closing
and inserting can never be half-applied."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions.exprs import differs, event_date, first_key, version_key
from starmart.functions.schemas import DIM_CUSTOMER_SCHEMA
from starmart.operators.joins import bounded_broadcast

DIM_COLUMNS = [f.name for f in DIM_CUSTOMER_SCHEMA.fields]
# Change sets up to this many customers are broadcast (after a row-count check).
MAX_BROADCAST_CHANGES = 5_000_000
TRACKED = ("customer_name", "customer_region")


def customer_latest_of(rows: DataFrame, loads: Mapping[str, Column]) -> DataFrame:
    """``customer_latest`` of several overlapping sets of rows by one grouped
    aggregate: per customer id and entry of ``loads`` (a condition on the rows)
    a struct column of its name, NULL where the set has no row of the customer."""
    cols = []
    for name, member in loads.items():
        newest = F.max_by(F.struct(F.col("event_ts"), *[F.col(c) for c in TRACKED]),
                          F.when(member, F.struct("event_ts", "event_id")))
        first = F.min(F.when(member, event_date()))
        cols.append(F.when(newest.isNotNull(), F.struct(newest.alias("n"), first.alias("first_seen_date"))).alias(name))
    return rows.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(*cols)


def latest_of(state: DataFrame, name: str) -> DataFrame:
    """Of ``customer_latest_of`` the rows of one set, as ``customer_latest`` has them."""
    return (state.where(F.col(name).isNotNull())
            .select("customer_id",
                    F.col(f"{name}.n.customer_name").alias("customer_name"),
                    F.col(f"{name}.n.customer_region").alias("customer_region"),
                    event_date(f"{name}.n.event_ts").alias("effective_date"),
                    F.col(f"{name}.first_seen_date").alias("first_seen_date")))


def customer_latest(silver: DataFrame) -> DataFrame:
    """Per customer id: newest name/region (by event time, then event id), the
    date of that newest event (``effective_date``) and the first event date.

    One grouped aggregate (partial per map task, final after one shuffle on
    customer_id) instead of a window plus a self-join: a hot customer costs
    one partial row per map task, never a whole group in one reducer.  Rows
    without a customer id are dropped, as the reference's inner join does."""
    return latest_of(customer_latest_of(silver, {"_all": F.lit(True)}), "_all")


def _dim_row(key: Column, start: Column) -> list[Column]:
    return [key.alias("customer_key"), F.col("customer_id"), F.col("customer_name"),
            F.col("customer_region"), start.alias("start_date"),
            F.lit(None).cast("date").alias("end_date"), F.lit(True).alias("is_current")]


def scd2_init(latest: DataFrame) -> DataFrame:
    """First load: one current version per customer with its newest
    attributes, valid from the first day the customer was seen."""
    return latest.select(*_dim_row(first_key("customer_id"), F.col("first_seen_date")))


def scd2_changes(latest: DataFrame, dim: DataFrame, null_safe: bool = False) -> DataFrame:
    """Customers whose newest name or region differs from their current
    version.  Default ``<>`` misses NULL -> value changes (reference
    behaviour); ``null_safe=True`` uses IS DISTINCT FROM."""
    cur = dim.where(F.col("is_current")).select(
        "customer_id", F.col("customer_name").alias("_cur_name"),
        F.col("customer_region").alias("_cur_region"))
    changed = (differs(F.col("customer_region"), F.col("_cur_region"), null_safe)
               | differs(F.col("customer_name"), F.col("_cur_name"), null_safe))
    return (latest.join(cur, "customer_id").where(changed)
            .select(*latest.columns))


def scd2_apply(dim: DataFrame, changes: DataFrame, latest: DataFrame | None = None,
               insert_new: bool = False, newcomers: DataFrame | None = None) -> DataFrame:
    """Close the current version of every changed customer (``end_date`` =
    the change's effective date, ``is_current`` false) and add the new
    current versions.  With ``insert_new`` (and ``latest``), customers that
    have no current version yet are inserted as well; the reference mode
    leaves them out.

    Only current rows take part in the join (closed history passes through
    without a shuffle).  The join is on customer_id, where both sides hold
    at most one row per key; a change set of at most
    ``MAX_BROADCAST_CHANGES`` rows is broadcast (row-count check), so the
    current dimension is scanned rather than shuffled."""
    is_current = F.coalesce(F.col("is_current"), F.lit(False))  # a NULL flag is history
    history = dim.where(~is_current)
    current = dim.where(is_current)
    # the change set is usually a small share of the customers: broadcast it
    # after a row-count check, so the current dimension is not shuffled
    eff = bounded_broadcast(changes.select("customer_id", F.col("effective_date").alias("_eff"),
                                           F.lit(True).alias("_matched")), MAX_BROADCAST_CHANGES)
    matched = F.col("_matched").isNotNull()
    current_after = (current.join(eff, "customer_id", "left")
                     .select("customer_key", "customer_id", "customer_name", "customer_region",
                             "start_date",
                             F.when(matched, F.col("_eff")).otherwise(F.col("end_date")).alias("end_date"),
                             F.when(matched, F.lit(False)).otherwise(F.col("is_current")).alias("is_current")))
    new_versions = changes.select(
        *_dim_row(version_key("customer_id", "effective_date"), F.col("effective_date")))
    out = history.select(*DIM_COLUMNS).unionByName(current_after).unionByName(new_versions)
    if insert_new:
        if newcomers is None:
            if latest is None:
                raise ValueError("insert_new needs the latest-per-customer frame")
            newcomers = scd2_newcomers(latest, dim)
        out = out.unionByName(scd2_init(newcomers))
    return out


def scd2_newcomers(latest: DataFrame, dim: DataFrame) -> DataFrame:
    """Latest attributes of customers without a current version."""
    current = dim.where(F.col("is_current")).select("customer_id")
    return latest.join(current, "customer_id", "left_anti")


def merge_into(target: DataFrame, source: DataFrame, key: str,
               target_filter: Column | None = None,
               matched_condition: Column | None = None,
               matched_set: Mapping[str, Column] | None = None,
               not_matched_insert: Mapping[str, Column] | None = None) -> DataFrame:
    """``MERGE INTO target USING source ON t.key = s.key [AND target_filter]
    WHEN MATCHED [AND cond] THEN UPDATE SET … WHEN NOT MATCHED THEN INSERT …``
    as a DataFrame transformation returning the target's new content.

    In conditions and expressions refer to target columns as ``t_<name>`` and
    to source columns as ``s_<name>``.  Target rows outside ``target_filter``
    bypass the join.  A source with several rows of one key fails, as a MERGE
    does; NULL keys match nothing.  One full outer join on ``key``."""
    t_cols, s_cols = target.columns, source.columns
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in t_cols], F.lit(True).alias("_in_t"))
    rows_of_key = F.count(F.col(key)).over(Window.partitionBy(key))
    once = F.when(rows_of_key <= 1, True).otherwise(F.raise_error(F.lit(f"MERGE source has several rows of one {key}")))
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in s_cols], once.alias("_in_s"))
    if target_filter is not None:
        keep = F.coalesce(target_filter, F.lit(False))
        passthrough = t.where(~keep)
        t = t.where(keep)
    else:
        passthrough = None
    j = t.join(s, F.col(f"t_{key}") == F.col(f"s_{key}"), "full_outer")
    in_t = F.col("_in_t").isNotNull()
    in_s = F.col("_in_s").isNotNull()
    update = in_t & in_s
    if matched_condition is not None:
        update = update & F.coalesce(matched_condition, F.lit(False))
    matched_set = dict(matched_set or {})
    insert = dict(not_matched_insert or {})
    cols = []
    for c in t_cols:
        tc = F.col(f"t_{c}")
        new = F.when(update, matched_set[c]).otherwise(tc) if c in matched_set else tc
        if insert:
            new = F.when(~in_t, insert.get(c, F.lit(None))).otherwise(new)
        cols.append(new.cast(target.schema[c].dataType).alias(c))
    keep_rows = in_t | (in_s & F.lit(bool(insert)))
    merged = j.where(keep_rows).select(*cols)
    if passthrough is not None:
        merged = passthrough.select(*[F.col(f"t_{c}").alias(c) for c in t_cols]).unionByName(merged)
    return merged


def scd2_merge_upsert(dim: DataFrame, latest: DataFrame) -> DataFrame:
    """The conditional MERGE of the table-format alternative: on a current
    version whose region differs, close it; insert customers with no current
    version.  (A MERGE updates or inserts per source row, so the new version
    of a changed customer is not written by this statement.)"""
    return merge_into(
        dim, latest, "customer_id",
        target_filter=F.col("t_is_current"),
        matched_condition=F.col("s_customer_region") != F.col("t_customer_region"),
        matched_set={"is_current": F.lit(False), "end_date": F.col("s_effective_date")},
        not_matched_insert={
            "customer_key": first_key("s_customer_id"),
            "customer_id": F.col("s_customer_id"),
            "customer_name": F.col("s_customer_name"),
            "customer_region": F.col("s_customer_region"),
            "start_date": F.col("s_effective_date"),
            "end_date": F.lit(None).cast("date"),
            "is_current": F.lit(True),
        })


def dim_as_of(dim: DataFrame, on_date) -> DataFrame:
    """Versions valid on ``on_date``: ``start <= d AND (end IS NULL OR d < end)``."""
    d = F.lit(on_date).cast("date")
    return dim.where((F.col("start_date") <= d)
                     & (F.col("end_date").isNull() | (d < F.col("end_date"))))
