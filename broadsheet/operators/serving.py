"""Read queries: recent, per state, per key set, favourites, locations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet import fixed
from broadsheet.operators.mutations import email_key


def check_limit(limit: int, maximum: int = fixed.MAX_RESULT_LIMIT) -> int:
    if limit < 1 or limit > maximum:
        raise ValueError(f"limit must be between 1 and {maximum}")
    return limit


def check_run(provider: str, max_records: int = 25, timespan: str = "24h") -> tuple[str, int, str]:
    """Arguments of an ingestion run, trimmed, or an error."""
    if not provider.strip():
        raise ValueError("provider must not be blank")
    if max_records < 1:
        raise ValueError("max_records must be at least 1")
    if not timespan.strip():
        raise ValueError("timespan must not be blank")
    return provider.strip(), max_records, timespan.strip()


def list_recent(articles: DataFrame, limit: int = 50, category: str | None = None, language_code: str | None = None) -> DataFrame:
    """Newest articles, optionally of one category and language (ties by id)."""
    check_limit(limit)
    if category is not None:
        articles = articles.filter(F.col("primary_category") == category)
    if language_code is not None:
        articles = articles.filter(F.col("language_code") == language_code)
    return articles.orderBy(F.col("published_at").desc(), "id").limit(limit)


def list_for_state(articles: DataFrame, article_states: DataFrame, state_code: str, limit: int = 50) -> DataFrame:
    """Most relevant, then newest articles of a state."""
    check_limit(limit)
    links = article_states.filter(F.col("state_code") == state_code).select("article_id", "relevance_score")
    joined = articles.join(links, F.col("id") == F.col("article_id")).drop("article_id")
    return joined.orderBy(F.col("relevance_score").desc(), F.col("published_at").desc(), "id").limit(limit)


def top_per_group(df: DataFrame, group: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows of every group.

    The row-number filter is applied before the shuffle as well (window group limit), so even
    a group with a third of all rows sends at most ``n`` rows per task.
    """
    check_limit(n)
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def list_active_sources(sources: DataFrame, limit: int = 100) -> DataFrame:
    check_limit(limit)
    return sources.filter("is_active").orderBy("name", "id").limit(limit)


def list_states(states: DataFrame, region_type: str | None = None, active_only: bool = True) -> DataFrame:
    if region_type is not None and region_type not in fixed.REGION_TYPES:
        raise ValueError("region type must be state or union_territory")
    if active_only:
        states = states.filter("is_active")
    if region_type is not None:
        states = states.filter(F.col("region_type") == region_type)
    return states.orderBy("display_order", "code")


def list_districts(districts: DataFrame, state_code: str, limit: int = 200) -> DataFrame:
    check_limit(limit)
    return (
        districts.filter(F.col("is_active") & (F.col("state_code") == state_code)).orderBy("name", "id").limit(limit)
    )


def list_cities(cities: DataFrame, state_code: str, district_id: str | None = None, limit: int = 200) -> DataFrame:
    check_limit(limit)
    found = cities.filter(F.col("is_active") & (F.col("state_code") == state_code))
    if district_id is not None:
        found = found.filter(F.col("district_id") == district_id)
    return found.orderBy("name", "id").limit(limit)


def by_keys(table: DataFrame, key: str, wanted: DataFrame, wanted_key: str) -> DataFrame:
    """Rows of a table for a set of keys (the set form of a lookup by id)."""
    keys = wanted.select(F.col(wanted_key).alias(key)).distinct()
    return table.join(keys, key, "left_semi")


def users_by_email(users: DataFrame, wanted: DataFrame, email: str = "email") -> DataFrame:
    keys = wanted.select(email_key(F.col(email)).alias("email")).distinct()
    return users.join(keys, "email", "left_semi")


def favorite_countries(favorites: DataFrame, user_id: str) -> DataFrame:
    return favorites.filter(F.col("user_id") == user_id).orderBy("priority")


def favorite_states(favorites: DataFrame, states: DataFrame, user_id: str | None = None) -> DataFrame:
    """Active favourite states, each user's together and in display order; the state dimension (a few dozen rows) is broadcast.

    Users are grouped by hash, not sorted among each other."""
    active = states.filter("is_active").withColumnRenamed("code", "state_code")
    if user_id is not None:
        return favorites.filter(F.col("user_id") == user_id).join(F.broadcast(active), "state_code").orderBy("display_order")
    return favorites.join(F.broadcast(active), "state_code").repartition("user_id").sortWithinPartitions("user_id", "display_order")
