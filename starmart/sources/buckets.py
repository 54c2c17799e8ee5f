"""Parquet tables in hash buckets, of which a load rewrites only the touched ones.

A table is one folder with a partition column ``_bucket``, a hash of its key
columns.  ``rewrite`` replaces whole buckets by dynamic partition overwrite:
the folders of all other buckets are neither read nor written.  The rows to
write are cut to the shared folder first, so the write never reads what it
replaces, and a write that broke off is done again from the same inputs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.session import scratch_dir, shuffles_freed
from starmart.sources import tables

BUCKET = "_bucket"
ROWS_PER_FILE = 1_000_000


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Bucket of a row; NULL keys have a bucket like any value."""
    return F.pmod(F.xxhash64(*[F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys]), F.lit(buckets)).cast("int")


def cut(df: DataFrame, name: str, partition_by: Sequence[str] = (), folder: str | None = None) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back: the
    lineage ends there, and a lost executor costs only its running tasks.  Its
    shuffle files go at once; with a ``folder`` it is written there, to be discarded."""
    path = f"{folder}/{name}" if folder else scratch_dir(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def values_of(df: DataFrame, column: str = BUCKET) -> list[int]:
    """The distinct buckets of ``df``: at most as many as the table has."""
    return sorted(r[0] for r in df.select(column).distinct().collect())


def read(spark: SparkSession, path: str, schema: T.StructType, buckets: list[int] | None = None) -> DataFrame:
    """Rows of the given buckets (all: None), a partition filter; no rows
    before the first write.  ``schema`` is that of the rows, ``_bucket`` is added."""
    whole = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
    if not tables.path_exists(spark, path):
        return spark.createDataFrame([], whole)
    df = spark.read.schema(whole).parquet(path)
    return df if buckets is None else df.where(F.col(BUCKET).isin(buckets))


def parts_of(n_rows: int, buckets: int) -> int:
    """Files of a bucket, of about ROWS_PER_FILE rows."""
    return max(1, -(-n_rows // (max(1, buckets) * ROWS_PER_FILE)))


def groups(values: list[int], n_rows: int, at_once: int) -> list[list[int]]:
    """The buckets in groups of about ``at_once`` of their ``n_rows`` rows: what
    is shuffled and written beside the table follows a group, not the table."""
    n = max(1, min(len(values), -(-n_rows // at_once)))
    return [values[i::n] for i in range(n)]


def rewrite(rows: DataFrame, path: str, buckets: list[int], n_rows: int | None) -> None:
    """Replace ``buckets`` by ``rows`` (already cut, with ``_bucket``).  Rows are
    dealt by bucket and file, so a bucket of many rows is written by many tasks.
    Without ``n_rows`` the cut is partitioned by bucket and is written file by
    file, without a shuffle."""
    if not buckets:
        return
    emptied = set(buckets) - set(values_of(rows))
    rows = rows.where(F.col(BUCKET).isin(buckets))
    if n_rows is not None:
        files = parts_of(n_rows, len(buckets))
        part = F.pmod(F.xxhash64(*[c for c in rows.columns if c != BUCKET]), F.lit(files))
        rows = rows.repartition(len(buckets) * files, BUCKET, part)
    with shuffles_freed(rows.sparkSession):
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    for bucket in emptied:  # nothing was written there, so nothing was replaced
        fs, folder = tables._fs(rows.sparkSession, f"{path}/{BUCKET}={bucket}")
        fs.delete(folder, True)
