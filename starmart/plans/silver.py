"""Silver: newest version per event, then validation (in that order)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators import bloom
from starmart.operators.dedup import SILVER_ORDER, dedup_latest
from starmart.operators.joins import MAX_BROADCAST_BYTES, measured
from starmart.operators.quality import reject_reason, split_valid
from starmart.sources.bronze import BRONZE_READ_SCHEMA

VALID = "valid"
QUALITY = "quality"
# Ids touched by one increment (~20 bytes each) broadcast after a row-count
# check; beyond this the semi / anti joins shuffle.
MAX_BROADCAST_KEYS = 5_000_000


def silver_split(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(silver, rejected).  Deduplication comes first: if the newest version
    of an event is invalid the event disappears – there is no fallback to an
    older valid version.  NULL order/customer ids are not filtered here."""
    return split_valid(dedup_latest(bronze, ["event_id"], SILVER_ORDER))


def build_silver(bronze: DataFrame) -> DataFrame:
    return silver_split(bronze)[0]


def checked(bronze: DataFrame) -> DataFrame:
    """Newest version per event, tagged ``quality`` = 'valid' or the first
    failing rule.  Silver is the valid part; keeping the rejected winners
    lets a later incremental build know that an event's newest version was
    invalid."""
    return (dedup_latest(bronze, ["event_id"], SILVER_ORDER)
            .withColumn(QUALITY, F.coalesce(reject_reason(), F.lit(VALID))))


def files_of(spark: SparkSession, roots: list[str]) -> DataFrame:
    """(root, path) of the committed files under bronze folders: a listing, no
    file is opened."""
    listed = [spark.read.format("binaryFile").load(r).select(F.lit(r).alias("root"), "path") for r in roots]
    return reduce(DataFrame.unionByName, listed) if listed else spark.createDataFrame([], "root string, path string")


def unread(files: DataFrame, consumed: DataFrame) -> dict[str, list[str]]:
    """Paths not among ``consumed``, by root.  No clock decides: a file that
    becomes visible late, whatever its times, is still unread.  What comes to
    the driver is the increment's file list, which it needs to read them."""
    out: dict[str, list[str]] = {}
    for root, path in files.join(consumed, ["root", "path"], "left_anti").collect():
        out.setdefault(root, []).append(path)
    return out


def read_files(spark: SparkSession, files: dict[str, list[str]]) -> list[DataFrame]:
    """Bronze rows of the given files; no other file is opened."""
    return [spark.read.schema(BRONZE_READ_SCHEMA).option("basePath", root).parquet(*paths) for root, paths in files.items()]


def incremental_checked(previous: DataFrame, new_rows: DataFrame, max_broadcast_keys: int = MAX_BROADCAST_KEYS) -> DataFrame:
    """Exact incremental form of ``checked(all bronze)``.

    ``previous`` holds, per event, the newest version among all earlier
    bronze rows (valid or rejected); the newest version among *all* rows is
    therefore the newest of (previous winner, new versions).  Only events
    touched by ``new_rows`` are re-evaluated; matching is NULL-safe so all
    NULL ids still form one group.  Re-reading rows already consumed cannot
    change a winner (the build is idempotent).

    The touched id set is the small side of two joins (semi / anti): it is
    broadcast after a size check, so the previous table is scanned but not
    shuffled.  Beyond the bound a Bloom filter of the ids is broadcast instead
    (64 MB at most): previous rows that are surely untouched pass by, only the
    others shuffle on event_id."""
    touched = new_rows.select(F.col("event_id").alias("_tid")).distinct()
    rows, size = measured(touched)
    if rows <= max_broadcast_keys and size <= MAX_BROADCAST_BYTES:
        touched, passed = F.broadcast(touched), None
    else:
        blocks = bloom.blocks_for(rows)
        flagged = bloom.tested(previous, "event_id", bloom.build(touched, "_tid", blocks), blocks)
        passed, previous = (flagged.where(c).drop("_maybe") for c in (~F.col("_maybe"), F.col("_maybe")))
    match = F.col("event_id").eqNullSafe(F.col("_tid"))
    kept = previous.join(touched, match, "left_anti")
    if passed is not None:
        kept = kept.unionByName(passed)
    revisit = previous.join(touched, match, "left_semi").drop(QUALITY)
    redone = checked(revisit.unionByName(new_rows, allowMissingColumns=True))
    return kept.unionByName(redone, allowMissingColumns=True)
