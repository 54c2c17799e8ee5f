"""Data-quality gate on bronze and the row-level quarantine split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions.exprs import is_valid_status, is_valid_total
from starmart.functions.schemas import GATE_THRESHOLD

PROCEED = "proceed"
QUARANTINE = "quarantine"


def gate_metrics(bronze: DataFrame) -> DataFrame:
    """One pass over bronze: total rows, rows with a NULL order or customer
    id, rows with ``order_total <= 0`` (NULL totals are not counted)."""
    return bronze.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("order_id").isNull() | F.col("customer_id").isNull()).alias("nulls"),
        F.count_if(F.col("order_total") <= 0).alias("bad_totals"),
    ).select(
        "total",
        F.coalesce(F.col("nulls"), F.lit(0)).cast("long").alias("nulls"),
        F.coalesce(F.col("bad_totals"), F.lit(0)).cast("long").alias("bad_totals"),
    )


def gate_decision(metrics: DataFrame, thresholds: Sequence[float] = (GATE_THRESHOLD,)) -> DataFrame:
    """Decision per threshold: quarantine when ``null_rate > t`` or
    ``bad_totals > total * t`` (strict); an empty bronze has null_rate 1."""
    t = F.explode(F.array(*[F.lit(float(x)) for x in thresholds])).alias("threshold")
    m = metrics.select(t, "total", "nulls", "bad_totals")
    null_rate = (F.when(F.col("total") > 0, F.col("nulls") / F.col("total"))
                 .otherwise(F.lit(1.0)))
    return m.select(
        "threshold", "total", "nulls", "bad_totals", null_rate.alias("null_rate"),
        F.when((null_rate > F.col("threshold"))
               | (F.col("bad_totals") > F.col("total") * F.col("threshold")),
               F.lit(QUARANTINE)).otherwise(F.lit(PROCEED)).alias("decision"),
    )


def quality_gate(bronze: DataFrame, thresholds: Sequence[float] = (GATE_THRESHOLD,)) -> DataFrame:
    return gate_decision(gate_metrics(bronze), thresholds)


def reject_reason():
    """First failing rule, in the order silver applies them (total, status)."""
    return (F.when(~F.coalesce(is_valid_total(), F.lit(False)), F.lit("bad_total"))
             .when(~F.coalesce(is_valid_status(), F.lit(False)), F.lit("bad_status")))


def split_valid(deduped: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected-with-``reject_reason``) from deduplicated rows."""
    tagged = deduped.withColumn("reject_reason", reject_reason())
    accepted = tagged.where(F.col("reject_reason").isNull()).drop("reject_reason")
    rejected = tagged.where(F.col("reject_reason").isNotNull())
    return accepted, rejected
