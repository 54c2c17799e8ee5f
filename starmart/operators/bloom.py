"""A Bloom filter built by aggregation, to cut a table before its shuffle.

Where an increment's id set is too large to broadcast, semi- and anti-joining
it shuffles the whole previous table.  The filter is blocked: an id's hash
picks one block of 32,768 bits and HASHES bits in it, so one broadcast join
and a few bit tests tell for every row whether its id may be in the set.  A
row that fails the test is surely not; only the others meet the set itself.

Blocks are bitmaps made by Spark's own bitmap aggregate, combined map-side.
The filter takes BITS_PER_ID bits an id and at most MAX_BLOCKS blocks (64 MB)
whatever the size of the set; beyond that it lets more rows through, never
fewer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 32_768       # bits of a block: what the bitmap aggregate holds
BITS_PER_ID, HASHES = 10, 4
MAX_BLOCKS = 16_384       # 4 KB each


def _text(key: str) -> Column:
    return F.coalesce(F.col(key).cast("string"), F.lit("\0"))


def _block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(_text(key), F.lit(0)), F.lit(blocks)).cast("int")


def _bits(key: str) -> list[Column]:
    return [F.pmod(F.xxhash64(_text(key), F.lit(i + 1)), F.lit(BLOCK_BITS)) for i in range(HASHES)]


def blocks_for(ids: int) -> int:
    return max(1, min(MAX_BLOCKS, -(-ids * BITS_PER_ID // BLOCK_BITS)))


def build(ids: DataFrame, key: str, blocks: int) -> DataFrame:
    """(_block, _bitmap) of the ids' set bits."""
    return (ids.select(_block(key, blocks).alias("_block"), F.explode(F.array(*_bits(key))).alias("_bit"))
            .groupBy("_block").agg(F.bitmap_construct_agg("_bit").alias("_bitmap")))


def tested(df: DataFrame, key: str, bitmaps: DataFrame, blocks: int) -> DataFrame:
    """``df`` with ``_maybe``: whether the id of the row may be in the set.  NULL
    is an id like any other.  The broadcast is bounded by MAX_BLOCKS."""
    def is_set(bit: Column) -> Column:
        byte = F.conv(F.hex(F.substring(F.col("_bitmap"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.pmod(F.floor(byte / F.pow(F.lit(2), bit % 8)), F.lit(2)) == 1

    hit = F.col("_bitmap").isNotNull()
    for bit in _bits(key):
        hit = hit & is_set(bit)
    joined = df.withColumn("_at", _block(key, blocks)).join(F.broadcast(bitmaps), F.col("_at") == F.col("_block"), "left")
    return joined.withColumn("_maybe", F.coalesce(hit, F.lit(False))).drop("_at", "_block", "_bitmap")
