"""Run counters as one-row (or one row per batch) tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def batch_counters(outcomes: DataFrame, by: list[str]) -> DataFrame:
    """received, stored, duplicate, rejected, failed; failures split by cause.

    ``outcomes``: one row per article or reject with kind (article or reject) and status
    (stored, duplicate, failed for articles; kept or failed for rejects).
    """
    article, reject = F.col("kind") == "article", F.col("kind") == "reject"
    failed = F.col("status") == "failed"
    return outcomes.groupBy(*by).agg(
        F.count("*").alias("total_received"),
        F.count_if(article & (F.col("status") == "stored")).alias("stored_count"),
        F.count_if(article & (F.col("status") == "duplicate")).alias("duplicate_count"),
        F.count_if(reject & ~failed).alias("rejected_count"),
        F.count_if(failed).alias("failed_count"),
        F.count_if(article & failed).alias("failed_articles"),
        F.count_if(reject & failed).alias("failed_rejects"),
    )


def dispatch_counters(outcomes: DataFrame, by: list[str]) -> DataFrame:
    """received, validated, queued, rejected, failed of a producer run.

    ``outcomes``: one row per record with status queued, publish_failed, rejected or
    reject_failed. Message ids stay a table of their own instead of a list in one row.
    """
    is_ = lambda *s: F.col("status").isin(*s)
    return outcomes.groupBy(*by).agg(
        F.count("*").alias("received_count"),
        F.count_if(is_("queued", "publish_failed")).alias("validated_count"),
        F.count_if(is_("queued")).alias("queued_count"),
        F.count_if(is_("rejected")).alias("rejected_count"),
        F.count_if(is_("publish_failed", "reject_failed")).alias("failed_count"),
    )


def feed_counters(entries: DataFrame, by: list[str]) -> DataFrame:
    """Counts per feed decision; received covers every entry, also the unread ones."""
    statuses = ("accepted", "duplicate", "rejected", "filtered", "unread")
    return entries.groupBy(*by).agg(
        F.count("*").alias("received"), *[F.count_if(F.col("status") == s).alias(s) for s in statuses]
    )


def consumer_summary(records: DataFrame, by: list[str]) -> DataFrame:
    """total, succeeded, failed per queue event; failed ids in record order.

    The id list is bounded: an event arrives as one JSON row, so its records fit in memory.
    """
    failed = F.col("status") == "failed"
    return records.groupBy(*by).agg(
        F.count("*").alias("total_count"),
        F.count_if(~failed).alias("succeeded_count"),
        F.transform(
            F.array_sort(F.collect_list(F.when(failed, F.struct("pos", "item_id")))), lambda r: r["item_id"]
        ).alias("failed_message_ids"),
    )


def failure_response(summary: DataFrame) -> DataFrame:
    """The partial-failure response per event: only failed ids return for another delivery."""
    items = F.transform("failed_message_ids", lambda i: F.struct(i.alias("itemIdentifier")))
    return summary.withColumn("response", F.to_json(F.struct(items.alias("batchItemFailures"))))
