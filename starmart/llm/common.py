"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.session import discard, scratch_dir, shuffles_freed

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Let Python workers started from another folder import this package (on a
    cluster ``--py-files`` does that; a path unknown there is ignored)."""
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if REPO not in have.split(":"):
        env["PYTHONPATH"] = f"{REPO}:{have}" if have else REPO


def cut(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: the lineage
    ends there, and a lost executor costs only its running tasks.  Its shuffle
    files go at once; with a ``folder`` it is written there, to be discarded."""
    path = f"{folder}/{name}" if folder else scratch_dir(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores in front until no column bears it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Arrow batches of at most ``rows`` rows for the actions inside: for rows
    that hold whole sets or blocks."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def fold(column: str, modulus: int) -> Column:
    """crc32 of the column as text, modulo ``modulus`` (null: null)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """Consecutive rows of equal ``keys`` of a sorted partition, as (key, rows);
    one run at a time is held, repeated rows once."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and row == rows[-1]:
                continue
            k = tuple(row[x] for x in keys)
            if k != key and rows:
                yield key, rows
                rows = []
            key = k
            rows.append(row)
    if rows:
        yield key, rows


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: (id, component), component the
    smallest id reachable; ids without an edge are absent.

    Contraction: each vertex points to its smallest neighbour if that is
    smaller, pointers are doubled twice, edges move to the roots, and edges
    that became loops or equal vanish.  Every round is written to the shared
    folder; nothing is gathered but the emptiness of the edge table.  Minima
    are pre-aggregated map-side, so a vertex of very many edges stays cheap.
    """
    spark = edges.sparkSession
    folder = scratch_dir(spark, "components")   # a folder a round: the last one's tables are its whole state
    edges = cut(edges.where("a <> b").select("a", "b").distinct(), "edges", folder)
    labels = None
    while not edges.isEmpty():
        last, folder = folder, scratch_dir(spark, "components")
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = cut(both.groupBy("a").agg(F.least("a", F.min("b")).alias("p")), "parent", last)
        for _ in range(2):
            up = parent.select(F.col("a").alias("q"), F.col("p").alias("pp"))
            parent = (parent.join(up, parent["p"] == up["q"], "left")
                      .select("a", F.coalesce("pp", "p").alias("p")))
        parent = cut(parent, "parents", last)
        pa_, pb = (parent.select(F.col("a").alias(x), F.col("p").alias(f"p_{x}")) for x in ("a", "b"))
        moved = (edges.join(pa_, "a").join(pb, "b")
                 .select(F.least("p_a", "p_b").alias("a"), F.greatest("p_a", "p_b").alias("b"))
                 .where("a <> b").distinct())
        step = parent.select(F.col("a").alias("root"), F.col("p").alias("component"))
        if labels is None:
            labels = step.withColumnRenamed("root", "id")
        else:
            labels = (labels.withColumnRenamed("component", "root").join(step, "root", "left")
                      .select("id", F.coalesce("component", "root").alias("component")))
        labels, edges = cut(labels, "labels", folder), cut(moved, "edges", folder)
        discard(spark, last)
    if labels is None:
        kind = edges.schema["a"].dataType
        labels = edges.select(F.col("a").alias("id"), F.col("b").cast(kind).alias("component"))
    return labels
