"""Contiguous shards of nearly equal bytes by global prefix sums (native expressions only).

Documents are ordered by (bucket of the id's hash, id); buckets stand for partitions that every task agrees on,
also when a task is repeated. Totals per bucket, combined before the shuffle, give each bucket's start; a window
inside the bucket gives each document's. A document belongs to the shard in whose equal byte range its middle lies, so cuts fall at the document
boundary nearest to the equal target, shards are contiguous in that order, and differ from the target by one document at most.

Only ids, sizes and checksums are shuffled. The bucket table has ``n_buckets`` rows at most, which bounds its
single-task prefix sum and its broadcast; ``n_buckets`` follows the number of rows up to ``MAX_BUCKETS``.

Defined results: a null text counts ``overhead`` bytes and has the checksum of an empty one; null ids come first in their bucket;
repeated rows get neighbouring slots; fewer documents than shards leave shards empty; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.session import cut

BUCKET_ROWS = 50_000
MAX_BUCKETS = 100_000


def shards(docs: DataFrame, n_shards: int = 40, overhead: int = 16, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: slots are gapless from 0 inside each shard."""
    sized = cut(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + overhead).alias("size"),
            F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        ),
        "sizes",
    )
    n_buckets = max(1, min(MAX_BUCKETS, -(-sized.count() // bucket_rows)))
    placed = sized.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(n_buckets)).cast("int"))
    totals = placed.groupBy("bucket").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = totals.select(
        F.col("bucket").alias("_bucket"),
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("bytes").over(every).alias("_total"),
    )
    inside = Window.partitionBy("bucket").orderBy(F.col("doc_id").asc_nulls_first(), "size", "text_crc32")
    local = placed.select(
        "*",
        (F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("_local_bytes"),
        (F.row_number().over(inside) - 1).alias("_local_row"),
    )
    # At most n_buckets rows of four numbers are broadcast.
    ranged = local.join(F.broadcast(starts), F.col("bucket") == F.col("_bucket")).select(
        "doc_id", "size", "text_crc32", "_local_row", "_rows_before",
        F.expr(f"cast(((2 * (_bytes_before + _local_bytes) + size) * {int(n_shards)}L) div (2 * _total) as int)").alias("shard"),
    )
    numbered = cut(ranged.select("doc_id", "size", "text_crc32", "shard", (F.col("_rows_before") + F.col("_local_row")).alias("_row")), "numbered")
    first = numbered.groupBy("shard").agg(F.min("_row").alias("_first")).withColumnRenamed("shard", "_shard")
    # At most n_shards rows are broadcast.
    return numbered.join(F.broadcast(first), F.col("shard") == F.col("_shard")).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_row") - F.col("_first")).alias("slot")
    )
