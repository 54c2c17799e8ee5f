"""Redeliveries told apart in the stream, by state kept per event id.

Every delivery is tagged once: ``accepted`` (the id's first delivery within
the watermark), ``duplicate`` (the id is in the state), or ``late`` (its event
time is older than the watermark, so its id's state may be gone).  Nothing is
dropped: the three parts together are the input.  The tag is the sink's
partition column, so late rows are a side table of their own and accepted ones
a partition read.

The state of an id is one long, its greatest event time; it expires by event
time, when the watermark passes it – from then on every further delivery of
that event time is late anyway, so expiry changes no tag.  State size follows
the watermark's delay, not the length of the stream.  Ids are held CELLS to a
stream, by their hash: Python is called per cell and batch, not per id.

Spark drops rows that are older than the watermark before an operator with
event-time timeouts.  They are kept here by a second watermark, on the arrival
time (the batch's clock, never late): the query's watermark is the lesser of
the two, which is the event time's.  Spark allows a second watermark in a query
with one stateful operator only; ``start_redelivery_stream`` says so to the
query it starts.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starmart.session import shuffles_freed

ACCEPTED, DUPLICATE, LATE = "accepted", "duplicate", "late"
DELIVERY = "delivery"
# Which of an id's deliveries in one micro-batch counts: the newest, as in silver.
BATCH_ORDER = ("_ingested_at", "event_ts", "product_id", "quantity", "order_total", "status")
CELLS = 16_384   # fixed: the state in a checkpoint is keyed by cell
ONE_OPERATOR = "spark.sql.streaming.statefulOperator.allowMultiple"
# Row payload as JSON text: to the microsecond, in UTC.
JSON = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _tagged(key, frames, state):
    """Deliveries of a cell's ids in one micro-batch, tagged; then the expiry of
    its ids that the watermark has passed."""
    watermark = state.getCurrentWatermarkMs()
    held = dict(zip(*state.get, strict=True)) if state.exists else {}
    for rows in _batches(frames if not state.hasTimedOut else ()):
        tags, first = [], {}
        known = set(held)
        ids = rows["_key"].astype(object).where(rows["_key"].notna(), None).tolist()
        for i, (id_, t, rank) in enumerate(zip(ids, rows["_ms"].tolist(), rows["_rank"].tolist(), strict=True)):
            if watermark > 0 and t < watermark:            # a missing event time is never late
                tags.append(LATE)
                continue
            tags.append(DUPLICATE)
            newest = max(int(t), watermark) if t == t else watermark
            held[id_] = max(held[id_], newest) if id_ in held else newest
            if id_ not in known and (id_ not in first or rank > first[id_][0]):
                first[id_] = rank, i
        for _, i in first.values():
            tags[i] = ACCEPTED
        yield pd.DataFrame({"_row": rows["_row"].array, DELIVERY: tags})
    held = {id_: newest for id_, newest in held.items() if newest + 1 >= watermark}
    if held:
        state.update((list(held), list(held.values())))
        state.setTimeoutTimestamp(max(min(held.values()), 0) + 1)
    elif state.exists:
        state.remove()


def _batches(frames):
    frames = list(frames)
    if frames:
        yield frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)


def _rank(column: str, kind: T.DataType) -> Column:
    """Text that sorts as the column does, a missing value first: few columns
    reach Python, where every id is a frame of its own."""
    c = F.col(column)
    if kind.typeName().startswith("timestamp"):
        c = F.format_string("%020d", F.unix_micros(c.cast("timestamp")) + F.lit(1 << 60))
    elif isinstance(kind, T.IntegralType):
        c = F.format_string("%020d", c.cast("long") + F.lit(1 << 60))
    elif isinstance(kind, (T.DoubleType, T.DecimalType)):
        c = F.format_string("%034.8f", (c.cast("double") + F.lit(1e10)).cast("double"))
    return F.when(F.col(column).isNull(), "").otherwise(c)


def tag_deliveries(bronze: DataFrame, delay: str, key: str = "event_id", event_time: str = "event_ts",
                   order: Sequence[str] = BATCH_ORDER) -> DataFrame:
    """The streaming ``bronze`` with a column ``delivery``.  ``delay`` is how far
    event times may lag the newest one seen, as an interval."""
    schema = bronze.schema
    timed = (bronze.withColumn("_at", F.col(event_time).cast("timestamp"))
             .withWatermark("_at", delay)
             .withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", "0 seconds"))
    # dealt as they are, before each row is text beside its rank: so the shuffle is narrower
    dealt = timed.withColumn("_cell", F.pmod(F.xxhash64(key), F.lit(CELLS)).cast("int")).repartition("_cell")
    keyed = dealt.select("_cell", F.col(key).alias("_key"), "_arrived", F.unix_millis("_at").alias("_ms"),
                         F.concat_ws("|", *[_rank(c, schema[c].dataType) for c in order]).alias("_rank"), F.to_json(F.struct(*schema.names), JSON).alias("_row"))
    tagged = keyed.groupBy("_cell").applyInPandasWithState(
        _tagged, T.StructType([T.StructField("_row", T.StringType()), T.StructField(DELIVERY, T.StringType())]),
        T.StructType([T.StructField("ids", T.ArrayType(schema[key].dataType)), T.StructField("newest", T.ArrayType(T.LongType()))]), "append", "EventTimeTimeout")
    return tagged.select(F.from_json("_row", schema, JSON).alias("r"), DELIVERY).select("r.*", DELIVERY)


def start_redelivery_stream(bronze: DataFrame, out_path: str, checkpoint: str, delay: str,
                            available_now: bool = False, trigger_interval: str = "5 seconds") -> StreamingQuery:
    """Tagged deliveries into ``out_path``, partitioned by tag.  The checkpoint
    holds the state and the consumed input and the file sink commits a batch
    once, so a restart neither repeats nor loses a delivery."""
    w = (tag_deliveries(bronze, delay).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).partitionBy(DELIVERY))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger_interval)
    spark = bronze.sparkSession
    before = spark.conf.get(ONE_OPERATOR)
    spark.conf.set(ONE_OPERATOR, "false")  # a query keeps the settings it was started with
    try:
        with shuffles_freed(spark):
            return w.start(out_path)
    finally:
        spark.conf.set(ONE_OPERATOR, before)
