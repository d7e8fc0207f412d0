"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with at least this many rows is served by broadcast, for at most the MAX_HOT most frequent keys.
# That bounds what is broadcast at any number of rows; all other keys are shuffled (adaptive execution splits large ones).
HOT_ROWS = 1_000_000
MAX_HOT = 10_000


def skew_lookup(
    rows: DataFrame,
    key: Column,
    spread: Column,
    table: DataFrame,
    table_key: str,
    count_col: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join of ``rows`` to a table with one row per key, whatever the key frequencies.

    ``count_col`` says how many rows carry each key (from the same partial aggregation that
    built the table). Frequent keys are broadcast, so their rows never meet in one task; the
    rest are shuffled by key. Rows already served, and rows with a null key, are spread over
    all partitions by ``spread`` instead of piling up on the null partition.
    """
    values = [c for c in table.columns if c not in (table_key, count_col)]
    side = table.select(
        F.col(table_key).alias("_table_key"), F.struct(*values).alias("_values"), F.col(count_col).alias("_rows")
    )
    hot = side.filter(F.col("_rows") >= hot_rows).orderBy(F.desc("_rows"), "_table_key").limit(MAX_HOT).select(
        F.col("_table_key").alias("_hot_key"), F.col("_values").alias("_hot")
    )
    # Rows that a hot key served no longer carry their key, so the whole table can serve the rest.
    cold = side.select("_table_key", F.col("_values").alias("_cold"))
    keyed = rows.withColumn("_probe", key)
    served = keyed.join(F.broadcast(hot), F.col("_probe") == F.col("_hot_key"), "left").drop("_hot_key")
    shuffled_key = F.coalesce(
        F.when(F.col("_hot").isNull(), F.col("_probe")), F.concat(F.lit("\x00"), spread.cast("string"))
    )
    joined = served.withColumn("_probe", shuffled_key).join(
        cold, F.col("_probe") == F.col("_table_key"), "left"
    )
    picked = F.coalesce("_hot", "_cold")
    return joined.select(*rows.columns, *[picked[v].alias(v) for v in values])
