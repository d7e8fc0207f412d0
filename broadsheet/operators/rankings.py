"""Top-ten snapshots: list rules, replacement, reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from broadsheet import fixed
from broadsheet.operators.mutations import replace_groups, replace_groups_at

SNAPSHOT = ["state_code", "ranking_date", "ranking_window", "category_filter"]


def snapshot_errors(rankings: DataFrame) -> DataFrame:
    """First broken rule per snapshot, in the order the rules are checked; null when valid."""
    stats = rankings.groupBy(*SNAPSHOT).agg(
        F.count("*").alias("n"),
        F.countDistinct("rank_position").alias("positions"),
        F.countDistinct("article_id").alias("articles"),
        F.min("rank_position").alias("lowest"),
        F.max("rank_position").alias("highest"),
        F.min("ranking_score").alias("worst"),
    )
    error = (
        F.when(F.col("n") > fixed.TOP_TEN, "too_many_articles")
        .when(F.col("positions") != F.col("n"), "repeated_position")
        .when(F.col("articles") != F.col("n"), "repeated_article")
        .when((F.col("lowest") < 1) | (F.col("highest") > fixed.TOP_TEN), "position_out_of_range")
        .when(F.col("worst") < 0, "negative_score")
        .when((F.col("lowest") != 1) | (F.col("highest") != F.col("n")), "positions_not_sequential")
        .when(F.trim("ranking_window") == "", "window_empty")
        .when(F.trim("category_filter") == "", "category_empty")
    )
    return stats.select(*SNAPSHOT, "n", error.alias("ranking_error"))


def good_snapshots(touched: DataFrame, fresh: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keys and rows of the touched snapshots without those that break a rule."""
    bad = snapshot_errors(fresh).filter(F.col("ranking_error").isNotNull()).select(*SNAPSHOT)
    return touched.select(*SNAPSHOT).distinct().join(bad, SNAPSHOT, "left_anti"), fresh.join(bad, SNAPSHOT, "left_anti")


def replace_top_ten(stored: DataFrame, touched: DataFrame, fresh: DataFrame) -> DataFrame:
    """Replace whole snapshots. ``touched`` lists the snapshot keys, so that an empty list
    still deletes; snapshots with a broken rule change nothing."""
    keys, rows = good_snapshots(touched, fresh)
    return replace_groups(stored, keys, rows, SNAPSHOT)


def replace_top_ten_at(path: str, schema: StructType, touched: DataFrame, fresh: DataFrame) -> None:
    """As :func:`replace_top_ten`, on a table of that schema partitioned by ``ranking_date``: only touched dates are rewritten."""
    keys, rows = good_snapshots(touched, fresh)
    replace_groups_at(path, schema, keys, rows, SNAPSHOT, "ranking_date")


def is_snapshot(state: str, date: str, window: str = "24h", category: str = "all") -> Column:
    return (
        (F.col("state_code") == state) & (F.col("ranking_date") == F.lit(date).cast("date"))
        & (F.col("ranking_window") == window) & (F.col("category_filter") == category)
    )


def list_rankings(rankings: DataFrame, state: str, date: str, window: str = "24h", category: str = "all") -> DataFrame:
    """One snapshot by position."""
    return rankings.filter(is_snapshot(state, date, window, category)).orderBy("rank_position").limit(fixed.TOP_TEN)


def list_ranked_articles(
    rankings: DataFrame, articles: DataFrame, state: str, date: str, window: str = "24h", category: str = "all"
) -> DataFrame:
    """One snapshot with its articles. At most ten ranking rows are broadcast; the article
    scan is filtered by them and nothing is shuffled."""
    top = list_rankings(rankings, state, date, window, category)
    return articles.join(F.broadcast(top), F.col("id") == F.col("article_id")).orderBy("rank_position")
