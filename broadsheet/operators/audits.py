"""Constraint audits: checks, unique keys and foreign keys as aggregate jobs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet import fixed

_SCORE_RULE = {"relevance_score_range": "relevance_score between 0 and 1"}

# Rules per table; a null passes, as in a database check.
CHECKS: dict[str, dict[str, str]] = {
    "news_sources": {
        "credibility_score_range": "credibility_score between 0 and 100",
        "country_code_length": "length(country_code) = 2",
    },
    "indian_states": {
        "region_type_values": "region_type in ('state', 'union_territory')",
        "country_code_india": "country_code = 'IN'",
        "display_order_positive": "display_order > 0",
    },
    "articles": {
        "language_code_length": "length(language_code) between 2 and 10",
        "content_hash_format": f"content_hash rlike '{fixed.HASH_PATTERN}'",
    },
    "article_countries": {"country_code_length": "length(country_code) = 2", **_SCORE_RULE},
    "article_states": _SCORE_RULE,
    "article_districts": _SCORE_RULE,
    "article_cities": _SCORE_RULE,
    "user_favorite_countries": {
        "favorite_country_priority_range": "priority between 1 and 2",
        "country_code_length": "length(country_code) = 2",
    },
    "state_news_rankings": {
        "rank_position_top_ten": "rank_position between 1 and 10",
        "ranking_score_nonnegative": "ranking_score >= 0",
    },
}

UNIQUE_KEYS: dict[str, list[list[str]]] = {
    "news_sources": [["id"], ["name", "source_type"]],
    "indian_states": [["code"], ["short_code"], ["name"]],
    "districts": [["id"], ["state_code", "name"], ["state_code", "slug"]],
    "cities": [["id"], ["state_code", "name"], ["state_code", "slug"]],
    "articles": [["id"], ["url"], ["canonical_url"], ["content_hash"]],
    "article_labels": [["article_id", "label"]],
    "article_countries": [["article_id", "country_code"]],
    "article_states": [["article_id", "state_code"]],
    "article_districts": [["article_id", "district_id"]],
    "article_cities": [["article_id", "city_id"]],
    "app_users": [["id"], ["email"]],
    "user_favorite_countries": [["user_id", "country_code"], ["user_id", "priority"]],
    "user_favorite_states": [["user_id", "state_code"]],
    "state_news_rankings": [
        ["state_code", "ranking_date", "ranking_window", "category_filter", "rank_position"],
        ["state_code", "ranking_date", "ranking_window", "category_filter", "article_id"],
    ],
}

# (child table, column, parent table, parent key)
FOREIGN_KEYS = (
    ("districts", "state_code", "indian_states", "code"), ("cities", "state_code", "indian_states", "code"),
    ("cities", "district_id", "districts", "id"), ("articles", "source_id", "news_sources", "id"),
    ("article_labels", "article_id", "articles", "id"), ("article_countries", "article_id", "articles", "id"),
    ("article_states", "article_id", "articles", "id"), ("article_states", "state_code", "indian_states", "code"),
    ("article_districts", "article_id", "articles", "id"), ("article_districts", "district_id", "districts", "id"),
    ("article_cities", "article_id", "articles", "id"), ("article_cities", "city_id", "cities", "id"),
    ("user_favorite_countries", "user_id", "app_users", "id"), ("user_favorite_states", "user_id", "app_users", "id"),
    ("user_favorite_states", "state_code", "indian_states", "code"),
    ("state_news_rankings", "state_code", "indian_states", "code"),
    ("state_news_rankings", "article_id", "articles", "id"),
)


def check_counts(df: DataFrame, rules: Mapping[str, str | Column]) -> DataFrame:
    """One row (rule, violations) per rule, all counted in a single scan."""
    as_column = lambda r: F.expr(r) if isinstance(r, str) else r
    counts = df.agg(*[F.count_if(~as_column(r)).alias(name) for name, r in rules.items()])
    pairs = [F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules]
    return counts.select(F.explode(F.array(*pairs)).alias("r")).select("r.*")


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once; keys with a null part never collide."""
    present = df
    for k in keys:
        present = present.filter(F.col(k).isNotNull())
    return present.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Distinct child values without a parent, with their row counts.

    Children are counted per value before the join, so a value shared by a third of the rows
    is one row in the shuffle.
    """
    values = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return values.join(parent.select(F.col(key).alias("value")), "value", "left_anti")
