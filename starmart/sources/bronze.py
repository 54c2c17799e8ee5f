"""Bronze: raw order events (NDJSON files or Kafka values) -> typed,
append-only table partitioned by region."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.schemas import BRONZE_SCHEMA, EVENT_COLUMNS, EVENT_SCHEMA, ORDERS_TOPIC
from starmart.sources import tables

BRONZE_PARTITION = "customer_region"
# Bronze as stored: batch loads also record the source file; stream rows do not.
BRONZE_READ_SCHEMA = T.StructType(
    BRONZE_SCHEMA.fields + [T.StructField("_source_file", T.StringType())])


def bronze_parts(spark: SparkSession, batch_path: str,
                 stream_path: str | None = None) -> list[DataFrame]:
    """The bronze folders that exist, each read with its own listing and the
    explicit schema (a missing ``_source_file`` is NULL).

    Batch appends and the streaming sink live in separate folders on
    purpose: a folder written by a streaming file sink is listed through the
    sink's commit log, which would hide batch files appended next to it (and
    listing it as a plain folder could expose files of an uncommitted
    micro-batch)."""
    return [spark.read.schema(BRONZE_READ_SCHEMA).parquet(p)
            for p in (batch_path, stream_path) if p and tables.path_exists(spark, p)]


def union_all(spark: SparkSession, parts: list[DataFrame]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], BRONZE_READ_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_bronze(spark: SparkSession, batch_path: str, stream_path: str | None = None) -> DataFrame:
    """Bronze = batch appends ∪ streaming-sink output."""
    return union_all(spark, bronze_parts(spark, batch_path, stream_path))


def typed_events(df: DataFrame, with_source_file: bool = False, file_column: str = "_metadata.file_path") -> DataFrame:
    """Raw event columns -> bronze columns: ``event_ts`` parsed (a zone
    offset is applied, giving UTC under the pinned session zone; a bad value
    becomes NULL, never an error), ``_ingested_at`` = load time and, for file
    sources, ``_source_file`` (``file_column`` of ``df``)."""
    ts = F.try_to_timestamp("event_ts").cast("timestamp_ntz").alias("event_ts")
    cols = [ts if c == "event_ts" else F.col(c) for c in EVENT_COLUMNS]
    file = [F.col(file_column).alias("_source_file")] if with_source_file else []
    return df.select(*cols, F.current_timestamp().alias("_ingested_at"), *file)


def event_json(df: DataFrame) -> Column:
    """One JSON object per event (``event_ts`` as ISO-8601 without zone)."""
    cols = [F.col(c) for c in EVENT_COLUMNS if c != "event_ts"]
    ts = F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss").alias("event_ts")
    return F.to_json(F.struct(*cols, ts))


def parse_values(values: DataFrame, value_col: str = "value") -> DataFrame:
    """``value`` (binary or string JSON) -> raw event columns.  A malformed
    value gives a row of NULLs; a field of the wrong type gives NULL."""
    parsed = F.from_json(F.col(value_col).cast("string"), EVENT_SCHEMA).alias("e")
    return values.select(parsed).select("e.*")


# Drops are compressed; such a file is read by one task, so it is kept to so many lines.
DROP = {"compression": "gzip", "maxRecordsPerFile": "500000"}


def write_ndjson(events: DataFrame, path: str, files: int | None = None, **options: str) -> None:
    """Write events as newline-delimited JSON (the raw file drop format)."""
    out = events.select(event_json(events).alias("value"))
    if files:
        out = out.repartition(files)
    out.write.mode("errorifexists").options(**options).text(path)


def read_ndjson(spark: SparkSession, path: str) -> DataFrame:
    """Batch scan of NDJSON with the declared schema (PERMISSIVE, no inference)."""
    return spark.read.schema(EVENT_SCHEMA).json(path)


NOT_JSON, BAD_FIELD = "not_json", "bad_field"
_CORRUPT = "_corrupt_record"


def split_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, corrupt) of raw text lines (``value``, ``file``), blank lines left
    out.  Good lines parse whole under the event schema and come as raw event
    columns with ``file``; corrupt ones keep their text, file and reason:
    ``not_json`` (no JSON object) or ``bad_field`` (a field of the wrong type).
    Every other line is in exactly one of the two."""
    schema = T.StructType([*EVENT_SCHEMA.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json("value", schema, {"columnNameOfCorruptRecord": _CORRUPT})
    rows = lines.where(F.trim("value") != "").select("value", "file", parsed.alias("e"))
    whole = F.col("e").isNotNull() & F.col(f"e.{_CORRUPT}").isNull()
    is_object = F.col("value").rlike(r"^\s*\{") & F.get_json_object("value", "$").isNotNull()
    good = rows.where(whole).select(*[F.col(f"e.{c}").alias(c) for c in EVENT_COLUMNS], "file")
    corrupt = rows.where(~whole).select(F.col("value").alias("raw"), "file",
                                        F.when(is_object, BAD_FIELD).otherwise(NOT_JSON).alias("reason"))
    return good, corrupt


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines of the files under ``path`` with the file each comes from."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))


def ingest_batch(spark: SparkSession, raw_dir: str, bronze_path: str, corrupt_path: str | None = None) -> dict:
    """Append every file currently in ``raw_dir`` to bronze in one job.
    Re-running appends again (bronze is not idempotent; silver is).

    A malformed line comes into bronze as a row of NULLs, or, with
    ``corrupt_path``, is appended there with its text, file and reason and
    kept out of bronze."""
    if corrupt_path is None:
        df = typed_events(read_ndjson(spark, raw_dir), with_source_file=True)
        return tables.append(df, bronze_path, partition_by=[BRONZE_PARTITION], operation="WRITE")
    good, corrupt = split_lines(read_lines(spark, raw_dir))
    kept = tables.append(corrupt.withColumn("_ingested_at", F.current_timestamp()), corrupt_path, operation="WRITE")
    typed = typed_events(good, with_source_file=True, file_column="file")
    return tables.append(typed, bronze_path, partition_by=[BRONZE_PARTITION], operation="WRITE") | {"corrupt": kept["rows"]}


def kafka_records(events: DataFrame, topic: str = ORDERS_TOPIC) -> DataFrame:
    """Producer record per event: key = customer_id (per-customer ordering on
    the topic's partitions), value = JSON event, both binary."""
    return events.select(F.lit(topic).alias("topic"),
                         F.col("customer_id").cast("binary").alias("key"),
                         event_json(events).cast("binary").alias("value"))


def publish_to_kafka(records: DataFrame, bootstrap_servers: str) -> None:
    """Batch write of records to Kafka (needs the spark-sql-kafka package)."""
    (records.write.format("kafka")
     .option("kafka.bootstrap.servers", bootstrap_servers)
     .option("kafka.acks", "all")
     .save())


def decode_records(records: DataFrame) -> DataFrame:
    """Kafka record -> (key, raw event columns)."""
    parsed = F.from_json(F.col("value").cast("string"), EVENT_SCHEMA).alias("e")
    return records.select(F.col("key").cast("string").alias("key"), parsed).select("key", "e.*")
