"""Accepted articles to relational rows: source dimension, article row, relevance links."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet import fixed
from broadsheet.functions import codes
from broadsheet.operators import dedup, lake
from broadsheet.operators.skew import HOT_ROWS, skew_lookup


def default_country_scores(country: Column) -> Column:
    """The publisher's country at full relevance; an empty map when it is unknown."""
    code = F.upper(F.btrim(country))
    return F.when(
        F.coalesce(code, F.lit("")) != "", F.create_map(code, F.lit("1.0000").cast(codes.SCORE_TYPE))
    ).otherwise(F.create_map().cast(f"map<string,{codes.SCORE_TYPE}>"))


def country_link_scores(scores: Column, article_countries: Column | None = None) -> Column:
    """Given scores, plus the article's own countries at full relevance where none is given."""
    given = F.coalesce(scores, F.create_map().cast(f"map<string,{codes.SCORE_TYPE}>"))
    if article_countries is None:
        return given
    wanted = F.array_distinct(F.transform(article_countries, lambda c: F.upper(F.btrim(c))))
    missing = F.array_except(F.filter(wanted, lambda c: c != ""), F.map_keys(given))
    defaults = F.map_from_entries(
        F.transform(missing, lambda c: F.struct(c.alias("key"), F.lit("1.0000").cast(codes.SCORE_TYPE).alias("value")))
    )
    return F.when(article_countries.isNull(), given).otherwise(F.map_concat(given, defaults))


def country_links(accepted: DataFrame, use_topic_countries: bool = False) -> DataFrame:
    """article_countries rows of accepted articles."""
    own = F.col("country_codes") if use_topic_countries else None
    return accepted.select(
        "article_id", F.explode(country_link_scores(F.col("country_scores"), own)).alias("country_code", "relevance_score")
    )


def state_links(accepted: DataFrame) -> DataFrame:
    """article_states rows; the primary flag marks the request's primary state."""
    return accepted.select(
        "article_id", "primary_state_code", F.col("state_detection_method").alias("detection_method"),
        F.explode("state_scores").alias("state_code", "relevance_score"),
    ).select(
        "article_id", "state_code", "relevance_score",
        F.coalesce(F.col("state_code") == F.col("primary_state_code"), F.lit(False)).alias("is_primary"),
        "detection_method",
    )


def label_links(accepted: DataFrame) -> DataFrame:
    return accepted.select("article_id", F.explode(F.array_distinct("labels")).alias("label"))


def request_errors(known_states: Column) -> Column:
    """Rules that make a request fail on its own: scores, primary state, codes, widths.

    ``known_states`` is the array of state codes (a dimension of a few dozen rows).
    """
    states = F.map_keys("state_scores")
    return F.coalesce(
        F.when(
            F.col("primary_state_code").isNotNull()
            & ~F.coalesce(F.array_contains(states, F.col("primary_state_code")), F.lit(False)),
            "primary_state_missing",
        ),
        F.when(F.exists(F.map_keys("country_scores"), lambda c: F.length(c) != 2), "country_code_length"),
        F.when(F.size(F.array_except(states, known_states)) > 0, "state_unknown"),
        F.when(
            (F.length("url") > fixed.MAX_STORED_URL_LENGTH) | (F.length("canonical_url") > fixed.MAX_STORED_URL_LENGTH),
            "url_too_long",
        ),
    )


def source_key(name: Column, source_type: Column) -> Column:
    return F.sha2(F.concat_ws("|", name, source_type), 256)


def new_sources(accepted: DataFrame, sources: DataFrame | None) -> DataFrame:
    """Sources to create: the first accepted row per (name, type) sets the attributes.

    ``min_by`` combines on the map side, so a publisher with a third of all articles sends
    one row per task. Existing sources are never updated.
    """
    first = accepted.groupBy(
        F.col("source_name").alias("name"), "source_type"
    ).agg(
        F.min_by(F.struct("source_homepage_url", "source_country_code", "source_credibility"), "seq").alias("s")
    )
    if sources is not None:
        first = first.join(sources.select("name", "source_type"), ["name", "source_type"], "left_anti")
    return first.select(
        source_key(F.col("name"), F.col("source_type")).alias("id"), "name", "source_type",
        F.col("s.source_homepage_url").alias("homepage_url"), F.col("s.source_country_code").alias("country_code"),
        F.col("s.source_credibility").alias("credibility_score"), F.lit(True).alias("is_active"),
    )


def with_source_id(rows: DataFrame, sources: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left lookup of the source id by (name, type)."""
    key = lambda n, t: F.concat_ws("\x01", n, t)
    counts = rows.groupBy(key(F.col("source_name"), F.col("source_type")).alias("lookup")).agg(F.count("*").alias("n"))
    table = (
        sources.select(key(F.col("name"), F.col("source_type")).alias("lookup"), F.col("id").alias("source_id"))
        .join(counts, "lookup")
    )
    return skew_lookup(
        rows, key(F.col("source_name"), F.col("source_type")), F.col("article_id"), table, "lookup", "n", hot_rows
    )


def article_rows(accepted: DataFrame) -> DataFrame:
    """articles rows with the table's defaults; needs source_id, raw_s3_uri, processed_s3_uri."""
    blank = lambda c: F.nullif(F.btrim(c), F.lit(""))
    return accepted.select(
        F.col("article_id").alias("id"), "source_id", "title", "description", "content", "summary", "url",
        blank("canonical_url").alias("canonical_url"), blank("image_url").alias("image_url"), "author",
        "published_at", F.coalesce("collected_at", "published_at").alias("collected_at"),
        F.coalesce("primary_category", F.lit(fixed.DEFAULT_CATEGORY)).alias("primary_category"),
        F.coalesce("sentiment", F.lit(fixed.DEFAULT_SENTIMENT)).alias("sentiment"), "language_code",
        F.coalesce("ai_processed", F.lit(False)).alias("ai_processed"), "content_hash",
        F.coalesce("keywords", F.array().cast("array<string>")).alias("keywords"), "share_caption",
        F.col("social_card").alias("social_card_data"), "raw_s3_uri", "processed_s3_uri",
    )


@dataclass(frozen=True)
class Conformed:
    """Tables produced by one persisted batch."""

    results: DataFrame
    articles: DataFrame
    sources: DataFrame
    countries: DataFrame
    states: DataFrame
    labels: DataFrame
    accepted: DataFrame


def persist(
    requests: DataFrame,
    states: DataFrame,
    stored: DataFrame | None = None,
    sources: DataFrame | None = None,
    general: bool = True,
    use_topic_countries: bool = False,
    bucket: str = "news-lake",
    hot_rows: int = HOT_ROWS,
) -> Conformed:
    """Decide duplicates, then build every table the accepted articles need.

    ``requests`` holds the flat article columns plus seq, raw_s3_uri, country_scores,
    state_scores, primary_state_code and state_detection_method. With ``general`` off, the
    caller vouches that hashes and canonical urls are null (true for the built-in providers)
    and the single-pass decision by url is used; rows failing on their own content still need
    the general path, so pass only clean rows there.
    """
    results, accepted = decide(requests, states, stored, general, bucket, hot_rows)
    return build(results, accepted, sources, use_topic_countries)


def decide(
    requests: DataFrame,
    states: DataFrame,
    stored: DataFrame | None = None,
    general: bool = True,
    bucket: str = "news-lake",
    hot_rows: int = HOT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """The decisions of :func:`persist` (one narrow row per request), and the accepted requests with their source and document."""
    known = states.agg(F.collect_set("code").alias("codes")).scalar()
    checked = requests.withColumn("_known", known).withColumn("request_error", request_errors(F.col("_known"))).drop("_known")
    if general:
        narrow = checked.select(
            "seq", "article_id", "url", "canonical_url", "content_hash", F.col("request_error").isNotNull().alias("unfit"), "request_error"
        )
        judged = dedup.dedup_ordered(narrow, stored, hot_rows, ("article_id", "request_error"))
        # The wide side is shuffled but not sorted: decisions are narrow, one per request.
        taken = judged.filter(F.col("status") == dedup.STORED).drop("article_id").hint("shuffle_hash")
        accepted = requests.join(taken, "seq")
    else:
        judged = dedup.dedup_by_url(checked, stored, hot_rows)
        accepted = judged.filter(F.col("status") == dedup.STORED)
    results = judged.select(
        "seq", "status", "article_id", "duplicate_of", "duplicate_reason",
        F.when(F.col("status") == dedup.FAILED, F.coalesce("request_error", F.lit("unique_key"))).alias("failure_reason"),
    )
    located = accepted.withColumn(
        "source_id", source_key(F.col("source_name"), F.col("source_type"))
    ).withColumn("processed_s3_uri", lake.article_uri(bucket))
    return results, located


def build(results: DataFrame, located: DataFrame, sources: DataFrame | None = None, use_topic_countries: bool = False) -> Conformed:
    """Every table that accepted requests need; ``located`` as :func:`decide` gives it, or written and read back."""
    return Conformed(
        results=results,
        articles=article_rows(located),
        sources=new_sources(located, sources),
        countries=country_links(located, use_topic_countries),
        states=state_links(located),
        labels=label_links(located),
        accepted=located,
    )
