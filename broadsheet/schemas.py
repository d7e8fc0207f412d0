"""Table schemas (DDL strings) and the flat article layout shared by all jobs."""

from __future__ import annotations

PAYLOAD = (
    "payload_id string, provider string, source_id string, query string, max_records int, "
    "timespan string, collected_at timestamp, body string"
)

SOCIAL_CARD = (
    "struct<headline: string, summary: string, background_image_url: string, template_name: string, "
    "generated_image_path: string, is_generated: boolean>"
)

# Flat article layout: one column per field, the publisher as source_* columns.
ARTICLE_FIELDS = {
    "article_id": "string", "title": "string", "description": "string", "content": "string",
    "summary": "string", "url": "string", "canonical_url": "string", "image_url": "string",
    "source_name": "string", "source_type": "string", "source_homepage_url": "string",
    "source_country_code": "string", "source_credibility": "decimal(5,2)", "author": "string",
    "published_at": "timestamp", "collected_at": "timestamp", "primary_category": "string",
    "labels": "array<string>", "sentiment": "string", "country_codes": "array<string>",
    "keywords": "array<string>", "language_code": "string", "ai_processed": "boolean",
    "content_hash": "string", "share_caption": "string", "social_card": SOCIAL_CARD,
}

# Article document inside a queue message or a file.
ARTICLE_JSON = (
    "article_id string, title string, description string, content string, summary string, url string, "
    "canonical_url string, image_url string, source struct<name: string, source_type: string, "
    "homepage_url: string, country_code: string, credibility_score: string>, author string, "
    "published_at string, collected_at string, primary_category string, labels array<string>, "
    "sentiment string, country_codes array<string>, keywords array<string>, language_code string, "
    f"ai_processed boolean, content_hash string, share_caption string, social_card {SOCIAL_CARD}"
)

MESSAGE_JSON = (
    "schema_version string, message_id string, created_at string, message_type string, provider string, "
    "raw_s3_uri string, article_payload string, country_scores string, state_scores string, "
    "primary_state_code string, state_detection_method string, retry_count string"
)

REQUEST_JSON = (
    "schema_version string, message_id string, created_at string, message_type string, provider string, "
    "query string, max_records string, timespan string, source_id string, extra_partitions string"
)

QUEUE_EVENT_JSON = "Records array<string>"

FEED_ENTRY = (
    "struct<title: string, link: string, id: string, guid: string, summary: string, description: string, "
    "subtitle: string, author: string, authors: array<struct<name: string>>, "
    "content: array<struct<value: string>>, published: string, updated: string, created: string, "
    "media_content: array<struct<url: string, type: string, medium: string>>, "
    "media_thumbnail: array<struct<url: string>>, "
    "enclosures: array<struct<href: string, url: string, type: string>>>"
)
PARSED_FEED = f"struct<version: string, parse_error: string, entries: array<{FEED_ENTRY}>>"

# The fourteen relational tables.
TABLES = {
    "news_sources": (
        "id string, name string, source_type string, homepage_url string, country_code string, "
        "credibility_score decimal(5,2), is_active boolean, extra_metadata map<string,string>, "
        "created_at timestamp, updated_at timestamp"
    ),
    "indian_states": (
        "code string, short_code string, name string, region_type string, country_code string, "
        "capital string, display_order int, is_active boolean, created_at timestamp, updated_at timestamp"
    ),
    "districts": "id string, state_code string, name string, slug string, is_active boolean",
    "cities": "id string, state_code string, district_id string, name string, slug string, is_active boolean",
    "articles": (
        "id string, source_id string, title string, description string, content string, summary string, "
        "url string, canonical_url string, image_url string, author string, published_at timestamp, "
        "collected_at timestamp, primary_category string, sentiment string, language_code string, "
        "ai_processed boolean, content_hash string, keywords array<string>, share_caption string, "
        f"social_card_data {SOCIAL_CARD}, raw_s3_uri string, processed_s3_uri string"
    ),
    "article_labels": "article_id string, label string",
    "article_countries": "article_id string, country_code string, relevance_score decimal(5,4)",
    "article_states": (
        "article_id string, state_code string, relevance_score decimal(5,4), is_primary boolean, "
        "detection_method string"
    ),
    "article_districts": "article_id string, district_id string, relevance_score decimal(5,4)",
    "article_cities": "article_id string, city_id string, relevance_score decimal(5,4)",
    "app_users": "id string, email string, display_name string, is_active boolean",
    "user_favorite_countries": "user_id string, country_code string, priority smallint",
    "user_favorite_states": "user_id string, state_code string",
    "state_news_rankings": (
        "state_code string, ranking_date date, ranking_window string, category_filter string, "
        "article_id string, rank_position smallint, ranking_score decimal(12,4), "
        "score_components map<string,double>"
    ),
}
