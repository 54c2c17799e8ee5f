"""Always-on bronze ingest with Structured Streaming.

Exactly-once into bronze: the checkpoint records which files / offsets
each micro-batch consumed and the file sink commits every batch atomically
in its own log, so a restart after a crash neither loses nor repeats a
batch.  Deduplication of redelivered events stays in silver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starmart.functions.schemas import EVENT_SCHEMA, ORDERS_TOPIC
from starmart.sources.bronze import BRONZE_PARTITION, parse_values, typed_events

# ---------------------------------------------------------------------------
# Fixed values (stream settings to match): 5 s micro-batches, at most 1000
# offsets per batch, start at the latest offsets, run for 60 s.
TRIGGER_INTERVAL = "5 seconds"
MAX_OFFSETS_PER_TRIGGER = 1000
STARTING_OFFSETS = "latest"
RUN_SECONDS = 60
# ---------------------------------------------------------------------------


def file_source(spark: SparkSession, raw_dir: str, max_files_per_trigger: int | None = None,
                parsers: int | None = None) -> DataFrame:
    """New NDJSON files dropped into ``raw_dir`` -> bronze rows.  A compressed
    file is read by one task; with ``parsers`` its lines are dealt to so many
    tasks before they are parsed."""
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if parsers is None:
        return typed_events(r.schema(EVENT_SCHEMA).json(raw_dir))
    lines = r.text(raw_dir).select("value").where(F.trim("value") != "")
    return typed_events(parse_values(lines.repartition(parsers)))


KAFKA_PROVIDER = "org.apache.spark.sql.kafka010.KafkaSourceProvider"


def kafka_available(spark: SparkSession) -> bool:
    """True when the Kafka connector package is on the session's classpath."""
    try:
        spark.sparkContext._jvm.java.lang.Class.forName(KAFKA_PROVIDER)
        return True
    except Exception:
        return False


def kafka_source(spark: SparkSession, bootstrap_servers: str, topic: str = ORDERS_TOPIC,
                 starting_offsets: str = STARTING_OFFSETS,
                 max_offsets_per_trigger: int = MAX_OFFSETS_PER_TRIGGER) -> DataFrame:
    """Kafka topic -> bronze rows (needs the spark-sql-kafka package on the
    classpath).  Same parsing as the file source."""
    if not kafka_available(spark):
        raise RuntimeError("Kafka source needs the spark-sql-kafka connector package "
                           "(--packages org.apache.spark:spark-sql-kafka-0-10_<scala>:<spark>)")
    raw = (spark.readStream.format("kafka")
           .option("kafka.bootstrap.servers", bootstrap_servers)
           .option("subscribe", topic)
           .option("startingOffsets", starting_offsets)
           .option("maxOffsetsPerTrigger", max_offsets_per_trigger)
           .load())
    return typed_events(parse_values(raw, "value"))


def start_bronze_stream(events: DataFrame, bronze_path: str, checkpoint: str,
                        trigger_interval: str | None = TRIGGER_INTERVAL,
                        available_now: bool = False, fmt: str = "parquet") -> StreamingQuery:
    """Append the stream to bronze, partitioned by region.  ``available_now``
    processes what is there (in rate-limited batches) and stops."""
    w = (events.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint)
         .partitionBy(BRONZE_PARTITION))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger_interval)
    return w.start(bronze_path)


def run_for(query: StreamingQuery, seconds: float = RUN_SECONDS) -> None:
    """Bounded run: wait up to ``seconds``, then stop."""
    try:
        query.awaitTermination(seconds)
    finally:
        query.stop()
