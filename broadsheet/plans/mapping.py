"""Section C: record mapping, one query per mapped piece."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.functions import codes, text, urls
from broadsheet.operators import conform, lake
from broadsheet.plans.bindings import Tables, stamp
from broadsheet.plans.registry import query
from broadsheet.sources import feed_xml
from broadsheet.streaming import queue

TS = "strftime({0}, '%Y-%m-%d %H:%M:%S')"


@query("c1_api_record_to_article", "api_mapped", f"""
SELECT 'p' || payload AS payload_id, pos, url, title, source_name, homepage_url AS source_homepage_url, country_code AS source_country_code,
       image_url, {TS.format('published_at')} AS published_at, language_code, 'General' AS primary_category, 'GDELT' AS source_type
FROM api_mapped WHERE reject_reason IS NULL""")
def c1(t: Tables) -> DataFrame:
    return t.api_mapped.filter(F.col("reject_reason").isNull()).select(
        "payload_id", "pos", "url", "title", "source_name", "source_homepage_url", "source_country_code", "image_url",
        stamp(F.col("published_at")).alias("published_at"), "language_code", "primary_category", "source_type",
    )


@query("c2_feed_entry_to_article", "feed_mapped", f"""
SELECT 'f' || payload AS payload_id, pos, url, title, sha256(coalesce(description, '')) AS description_hash, sha256(coalesce(content, '')) AS content_hash,
       coalesce(author, '') AS author, coalesce(image_url, '') AS image_url, {TS.format('published_at')} AS published_at,
       'Energy' AS primary_category, 'en' AS language_code
FROM feed_mapped WHERE reject_reason IS NULL""")
def c2(t: Tables) -> DataFrame:
    blank = lambda c: F.coalesce(c, F.lit(""))
    return t.feed_mapped.filter(F.col("reject_reason").isNull()).select(
        "payload_id", "pos", "url", "title", F.sha2(blank("description"), 256).alias("description_hash"),
        F.sha2(blank("content"), 256).alias("content_hash"), blank("author").alias("author"),
        blank("image_url").alias("image_url"), stamp(F.col("published_at")).alias("published_at"), "primary_category", "language_code",
    )


@query("c3_required_text", "api_raw", """
SELECT 'p' || payload AS payload_id, count(*) FILTER (WHERE event_id % 50 <> 49 AND raw_url = '') AS url_empty,
       count(*) FILTER (WHERE event_id % 50 <> 49 AND raw_url <> '' AND event_id % 97 = 11) AS title_not_string,
       count(*) FILTER (WHERE event_id % 50 <> 49 AND raw_url <> '' AND event_id % 97 <> 11 AND title = '') AS title_empty
FROM api_raw WHERE usable GROUP BY ALL""")
def c3(t: Tables) -> DataFrame:
    return t.api_mapped.groupBy("payload_id").agg(
        *[F.count_if(F.col("reject_reason") == r).alias(r) for r in ("url_empty", "title_not_string", "title_empty")]
    )


@query("c4_required_clean_text", sql="""
SELECT page_id, CASE WHEN title = '' THEN 'title_empty' ELSE title END AS title FROM (
  SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(regexp_replace(regexp_extract(html, '<title>(.*?)</title>', 1), '<[^>]*>', ' ', 'g'),
    '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '\\s+', ' ', 'g')) AS title FROM pages)""")
def c4(t: Tables) -> DataFrame:
    title = F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1)
    cleaned = text.with_clean_text(t.base("pages"), {"title": title})
    return cleaned.select("page_id", F.coalesce("title", F.lit("title_empty")).alias("title"))


@query("c5_required_http_url", "feed_mapped", """
SELECT 'f' || payload AS payload_id, pos, coalesce(url, CASE WHEN title IS NULL THEN 'title_empty' ELSE 'link_invalid' END) AS outcome FROM feed_mapped""")
def c5(t: Tables) -> DataFrame:
    return t.feed_mapped.select("payload_id", "pos", F.coalesce("url", "reject_reason").alias("outcome"))


@query("c6_optional_http_url", "api_mapped", """
SELECT (payload * 100 + pos) % 3 AS kind, count(*) AS records, count(CASE WHEN event_id % 50 <> 49 THEN image_url END) AS with_image FROM api_mapped GROUP BY ALL""")
def c6(t: Tables) -> DataFrame:
    """Invalid image URLs become null and never reject the record."""
    kind = F.expr("(cast(substring(payload_id, 2) as bigint) * 100 + pos) % 3").alias("kind")
    return t.api_mapped.groupBy(kind).agg(F.count("*").alias("records"), F.count("image_url").alias("with_image"))


@query("c7_source_domain", "api_mapped", """
SELECT coalesce(CASE WHEN event_id % 50 <> 49 THEN source_name END, 'domain_missing') AS domain, count(*) AS n FROM api_mapped GROUP BY ALL""")
def c7(t: Tables) -> DataFrame:
    return t.api_mapped.groupBy(F.coalesce("source_name", F.lit("domain_missing")).alias("domain")).agg(F.count("*").alias("n"))


@query("c8_homepage_url", sql="""
SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS homepage FROM pages""")
def c8(t: Tables) -> DataFrame:
    return t.base("pages").select("page_id", urls.homepage(F.col("url")).alias("homepage"))


@query("c9_description_choice", sql="""
SELECT doc_id, sha256(CASE WHEN doc_id % 4 = 1 THEN body ELSE 'Subtitle ' || doc_id END) AS description_hash
FROM (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS body FROM documents)""")
def c9(t: Tables) -> DataFrame:
    """First cleanable of summary, description, subtitle."""
    docs = t.base("documents")
    cleaned = text.with_clean_text(docs, {
        "summary": F.lit("<p> </p>"),
        "description": F.when(F.expr("doc_id % 4 = 1"), F.concat(F.lit("<div>"), F.col("text"), F.lit("</div>"))),
        "subtitle": F.concat(F.lit("<i>Subtitle</i> "), F.col("doc_id").cast("string")),
    })
    return cleaned.select("doc_id", F.sha2(F.coalesce("summary", "description", "subtitle"), 256).alias("description_hash"))


@query("c10_content_choice", "feed_mapped", """
SELECT 'f' || payload AS payload_id, pos, length(content) AS n_chars FROM feed_mapped WHERE content IS NOT NULL""")
def c10(t: Tables) -> DataFrame:
    return t.feed_mapped.filter(F.col("content").isNotNull()).select(
        "payload_id", "pos", F.length("content").cast("bigint").alias("n_chars")
    )


@query("c11_author_choice", "feed_mapped", """
SELECT coalesce(author, '') AS author, count(*) AS n FROM feed_mapped GROUP BY ALL""")
def c11(t: Tables) -> DataFrame:
    return t.feed_mapped.groupBy(F.coalesce("author", F.lit("")).alias("author")).agg(F.count("*").alias("n"))


@query("c12_image_choice", "feed_mapped", """
SELECT 'f' || payload AS payload_id, pos, coalesce(image_url, '') AS image_url FROM feed_mapped""")
def c12(t: Tables) -> DataFrame:
    return t.feed_mapped.select("payload_id", "pos", F.coalesce("image_url", F.lit("")).alias("image_url"))


@query("c13_reject_source_id", "feed_mapped api_mapped", """
SELECT 'f' || payload AS payload_id, pos, 'doc-' || doc_id AS source_id FROM feed_mapped WHERE reject_reason IS NOT NULL
UNION ALL SELECT 'p' || payload, pos, CASE WHEN event_id % 50 = 49 OR raw_url = '' THEN '' ELSE raw_url END FROM api_mapped WHERE reject_reason IS NOT NULL""")
def c13(t: Tables) -> DataFrame:
    pick = lambda df: df.filter(F.col("reject_reason").isNotNull()).select(
        "payload_id", "pos", F.coalesce("reject_source_id", F.lit("")).alias("source_id")
    )
    return pick(t.feed_mapped).unionAll(pick(t.api_mapped))


@query("c14_article_row_defaults", "docs", f"""
SELECT article_id AS id, {TS.format('published_at')} AS collected_at, 'Unknown' AS sentiment, 0 AS n_keywords, FALSE AS ai_processed,
       TRUE AS empty_card, primary_category FROM docs""")
def c14(t: Tables) -> DataFrame:
    """Defaults of the article row: collection time, sentiment, keywords, flags."""
    bare = t.docs.withColumn("collected_at", F.lit(None).cast("timestamp")).withColumn(
        "keywords", F.lit(None).cast("array<string>")
    ).withColumn("ai_processed", F.lit(None).cast("boolean"))
    located = bare.withColumns({"source_id": F.lit("s"), "raw_s3_uri": F.lit(None).cast("string"), "processed_s3_uri": lake.article_uri("news-lake")})
    return conform.article_rows(located).select(
        "id", stamp(F.col("collected_at")).alias("collected_at"), "sentiment", F.size("keywords").alias("n_keywords"),
        "ai_processed", F.col("social_card_data").isNull().alias("empty_card"), "primary_category",
    )


@query("c15_flatten_helpers", sql="""
SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE 'https://s' || s_suppkey || '.example.com' END AS url,
       CASE WHEN s_suppkey % 5 = 2 THEN '-1.00' ELSE CAST(CAST(s_suppkey % 100 AS DECIMAL(5,2)) AS VARCHAR) END AS score,
       '{"s_name":"' || s_name || '","s_nationkey":' || s_nationkey || '}' AS metadata FROM supplier""")
def c15(t: Tables) -> DataFrame:
    """Blank URL to null, text to decimal or null, record to JSON object."""
    url = F.expr("if(s_suppkey % 3 = 0, '  ', concat(' https://s', s_suppkey, '.example.com '))")
    number = F.expr("if(s_suppkey % 5 = 2, 'n/a', cast(s_suppkey % 100 as string))")
    return t.base("supplier").select(
        "s_suppkey", F.coalesce(text.blank_to_null(url), F.lit("")).alias("url"),
        F.coalesce(codes.to_decimal(number).cast("decimal(5,2)"), F.lit(-1).cast("decimal(5,2)")).cast("string").alias("score"),
        F.to_json(F.struct("s_name", "s_nationkey")).alias("metadata"),
    )


@query("c16_json_safe_reject_payload", "feed_mapped", """
SELECT 'f' || payload AS payload_id, pos, link, 'doc-' || doc_id AS guid FROM feed_mapped WHERE reject_reason IS NOT NULL""")
def c16(t: Tables) -> DataFrame:
    """Reject payloads are JSON that reads back whatever the entry held."""
    rejected = t.feed_mapped.filter(F.col("reject_reason").isNotNull())
    return rejected.select(
        "payload_id", "pos", F.get_json_object("record_json", "$.link").alias("link"),
        F.get_json_object("record_json", "$.id").alias("guid"),
    )


@query("c17_default_country_score", "api_mapped", """
SELECT event_id, coalesce(country_code, '') AS code, CASE WHEN country_code IS NULL THEN 0 ELSE 1 END AS n FROM api_mapped WHERE reject_reason IS NULL""")
def c17(t: Tables) -> DataFrame:
    scores = conform.default_country_scores(F.col("source_country_code"))
    rows = t.api_mapped.filter(F.col("reject_reason").isNull()).select(
        F.expr("cast(substring(payload_id, 2) as bigint) * 100 + pos").alias("event_id"), scores.alias("m")
    )
    return rows.select("event_id", F.array_join(F.map_keys("m"), ",").alias("code"), F.size("m").alias("n"))


@query("c18_article_to_message", "docs", """
SELECT doc_id, '1.0' AS schema_version, 'article_processing' AS message_type, 'Wire' AS provider, 's3://news-lake/raw/' || doc_id || '.json' AS raw_s3_uri,
  regexp_replace(md5('s3://news-lake/raw/' || doc_id || '.json|' || article_id), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') AS message_id,
  strftime(published_at, '%Y-%m-%dT%H:%M:%S.000000Z') AS created_at, url, title, sha256(content) AS content_sha256, source_name, author, primary_category, language_code,
  strftime(published_at, '%Y-%m-%dT%H:%M:%S.000000Z') AS published_at, '["' || label || '"]' AS labels, '{"' || country_code || '":1.0}' AS country_scores FROM docs""")
def c18(t: Tables) -> DataFrame:
    """The producer's message of every article, its fields read back."""
    uri = F.concat(F.lit("s3://news-lake/raw/"), F.col("doc_id").cast("string"), F.lit(".json"))
    made = queue.default_message(t.docs.withColumns({"provider": F.lit("Wire"), "raw_s3_uri": uri}))
    read = lambda path, name=None: F.get_json_object("body", f"$.{path}").alias(name or path.split(".")[-1])
    article = ("url", "title", "author", "primary_category", "language_code", "published_at", "labels")
    rows = made.select(
        *[read(f) for f in ("schema_version", "message_type", "provider", "raw_s3_uri", "message_id", "created_at", "country_scores")],
        read("article_payload.source.name", "source_name"), F.sha2(F.get_json_object("body", "$.article_payload.content"), 256).alias("content_sha256"),
        *[read(f"article_payload.{f}") for f in article],
    )
    return rows.withColumn("doc_id", F.regexp_extract("raw_s3_uri", r"(\d+)\.json$", 1).cast("bigint"))


@query("c19_reject_to_ingestion_item", "api_mapped", """
SELECT 'p' || payload AS payload_id, reject_reason AS reason, count(*) AS n FROM api_mapped WHERE reject_reason IS NOT NULL GROUP BY ALL""")
def c19(t: Tables) -> DataFrame:
    from broadsheet.plans.sinks import api_rejects

    return api_rejects(t).groupBy("payload_id", "reason").agg(F.count("*").alias("n"))


@query("c20_feed_raw_envelope", "docs", """
SELECT payload_id, feed_version, query, timespan FROM (SELECT DISTINCT 'f' || (doc_id // 40) AS payload_id,
  CASE WHEN doc_id // 40 % 29 IN (5, 7) THEN '' WHEN doc_id // 40 % 3 = 0 THEN 'atom10' ELSE 'rss20' END AS feed_version,
  CASE WHEN doc_id // 40 % 5 = 2 THEN 'THE' ELSE '' END AS query, '7d' AS timespan FROM docs)""")
def c20(t: Tables) -> DataFrame:
    """The raw record of each fetch keeps version, query, size and the whole text."""
    envelope = feed_xml.raw_envelope(t.feed_parsed.withColumn("source_id", F.col("payload_id")))
    whole = F.octet_length("content") == F.col("content_length")
    return envelope.filter(whole).select(
        F.col("source_id").alias("payload_id"), "feed_version", text.strip(F.col("query")).alias("query"), "timespan"
    )
