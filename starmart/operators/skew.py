"""Explicit hot-key handling for joins (independent of AQE).

``hot_keys`` finds the keys holding at least ``min_share`` of the rows.
There can be at most ``1 / min_share`` of them, so the list brought to the
driver is bounded by the parameter, not by the data.  ``split_hot_join``
then joins the rows of those keys on their own:

* if the other side's rows for the hot keys pass a row-count check, they are
  broadcast – the hot rows are never shuffled at all;
* otherwise both sides are salted: each hot row of the big side gets one of
  ``buckets`` salts (a hash of the row), each matching row of the other side
  is copied once per salt, and the join runs on (key, salt) – the hot key is
  spread over ``buckets`` tasks.

Cold keys take the ordinary shuffle join.  Inner joins only: a NULL key
never matches, so dropping NULL keys from both branches is exact.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.operators.joins import has_at_most

DEFAULT_MIN_SHARE = 0.01
DEFAULT_BROADCAST_ROWS = 1_000_000
CELLS = 4096   # hash cells of a first count


def hot_keys(df: DataFrame, key: str, min_share: float = DEFAULT_MIN_SHARE) -> list:
    """Keys with at least ``min_share`` of ``df``'s rows (at most
    ``floor(1 / min_share)`` values).  A key that is hot lies in a hash cell that
    is: CELLS counts are made first, and keys are counted in the hot cells
    only, so no pass shuffles a row per key."""
    cell = F.when(F.col(key).isNotNull(), F.pmod(F.xxhash64(key), F.lit(CELLS)).cast("int"))
    counts = {r[0]: r[1] for r in df.groupBy(cell.alias("_cell")).count().collect()}
    threshold = max(1, math.ceil(min_share * sum(counts.values())))
    full = [c for c, n in counts.items() if c is not None and n >= threshold]
    if not full:
        return []
    keys = df.where(cell.isin(full)).groupBy(key).count().where(F.col("count") >= threshold)
    return [r[key] for r in keys.collect()]


def split_hot_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                   condition: Callable[[], Column], hot: list,
                   max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                   buckets: int | None = None) -> DataFrame:
    """Inner join of ``left`` (big, possibly skewed on ``left_key``) with
    ``right`` under ``condition()`` (which must include the key equality and
    refer to columns by unambiguous names)."""
    if not hot:
        return left.join(right, condition(), "inner")
    is_hot_l = F.col(left_key).isin(hot)
    is_hot_r = F.col(right_key).isin(hot)
    cold = left.where(~is_hot_l).join(right.where(~is_hot_r), condition(), "inner")
    hot_left, hot_right = left.where(is_hot_l), right.where(is_hot_r)
    if has_at_most(hot_right, max_broadcast_rows):
        hot_joined = hot_left.join(F.broadcast(hot_right), condition(), "inner")
    else:
        n = buckets or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salted_l = hot_left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(n)))
        salted_r = hot_right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        cond = condition() & (salted_l["_salt"] == salted_r["_salt"])
        hot_joined = salted_l.join(salted_r, cond, "inner").drop("_salt")
    return cold.unionByName(hot_joined)
