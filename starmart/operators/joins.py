"""Join helpers: broadcast only behind a checked size bound."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What a broadcast may take in every executor, whatever its number of rows.
MAX_BROADCAST_BYTES = 100 * 1024 * 1024
ROW_BYTES, FIELD_BYTES = 32, 8   # a row's and a field's share beside the bytes of its texts


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows of ``df`` and about the bytes they take in memory.  One aggregate:
    each task sends two numbers, no rows meet in one task."""
    texts = [f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    lengths = [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)).cast("long") for c in texts]
    width = reduce(lambda x, y: x + y, lengths, F.lit(ROW_BYTES + FIELD_BYTES * len(df.columns)).cast("long"))
    rows, size = df.agg(F.count("*"), F.sum(width)).first()
    return rows, size or 0


def has_at_most(df: DataFrame, max_rows: int, max_bytes: int | None = None) -> bool:
    """True when ``df`` has no more than ``max_rows`` rows and, as far as measured,
    ``max_bytes`` bytes (MAX_BROADCAST_BYTES)."""
    rows, size = measured(df)
    return rows <= max_rows and size <= (MAX_BROADCAST_BYTES if max_bytes is None else max_bytes)


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Mark ``df`` for broadcast only if it is measured to have at most
    ``max_rows`` rows and MAX_BROADCAST_BYTES; beyond that the join is a
    sort-merge join, whatever Catalyst's estimate of ``df`` says."""
    return F.broadcast(df) if has_at_most(df, max_rows) else df.hint("merge")
