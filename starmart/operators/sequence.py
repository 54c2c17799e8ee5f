"""Previous/next row within a key's ordered sequence, safe for hot keys.

A plain ``lag() OVER (PARTITION BY key ORDER BY …)`` sends every row of a
key to one task; if one key holds a third of the data that task holds a
third of the data.  Here the rows are range-partitioned on
``(key, order…)`` – the sampled range bounds cut a hot key's sequence into
contiguous segments – and the window runs per ``(key, segment)``.  Only
the first (or last) row of a segment needs a neighbour from another
segment; those come from a per-segment summary (one row per key and
segment, at most ``partitions`` segments per key), so no group in any step
grows with the size of a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.sources.buckets import cut


def _partitions(df: DataFrame, partitions: int | None) -> int:
    if partitions:
        return partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def with_neighbor(df: DataFrame, key: str, order: Sequence[str], values: Sequence[str],
                  direction: str = "prev", out: str = "_neighbor",
                  partitions: int | None = None) -> DataFrame:
    """Add struct column ``out`` holding ``values`` of the previous
    (``direction='prev'``) or next (``'next'``) row of the same ``key`` under
    ``order`` ascending (NULLs first).  NULL when there is none.  The ordering
    must be total within a key (e.g. end with a unique id)."""
    if direction not in ("prev", "next"):
        raise ValueError("direction must be 'prev' or 'next'")
    n = _partitions(df, partitions)
    seg = "_seg"
    # The segment id comes from sampled range bounds and feeds two branches
    # (the per-segment window and the segment-edge summary); it is written
    # once to the shared folder, so both branches see the same segments
    # whether or not Spark reuses the exchange, and a lost executor re-reads
    # files instead of re-sampling.
    rp = cut(df.repartitionByRange(n, F.col(key), *[F.col(c) for c in order])
             .withColumn(seg, F.spark_partition_id()), "sequence")
    vals = F.struct(*[F.col(c) for c in values])
    w = Window.partitionBy(key, seg).orderBy(*order)
    local = F.lag(vals, 1).over(w) if direction == "prev" else F.lead(vals, 1).over(w)
    rows = rp.withColumn("_local", local)

    # Edge of every segment: last row (for 'prev' of the next segment) or
    # first row (for 'next' of the previous segment).
    ord_struct = F.struct(*[F.col(c) for c in order])
    edge = (F.max_by(vals, ord_struct) if direction == "prev" else F.min_by(vals, ord_struct))
    segs = rp.groupBy(key, seg).agg(edge.alias("_edge"))
    ws = Window.partitionBy(key).orderBy(seg)
    across = F.lag("_edge", 1).over(ws) if direction == "prev" else F.lead("_edge", 1).over(ws)
    segs = segs.select(key, seg, across.alias("_across"))

    return (rows.join(segs, [key, seg], "left")
            .withColumn(out, F.coalesce(F.col("_local"), F.col("_across")))
            .drop("_local", "_across", seg))
