"""Section B: lake layers, envelopes, paths and inserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.functions import text, times
from broadsheet.operators import conform, dedup, lake
from broadsheet.plans.bindings import Tables, stamp
from broadsheet.plans.registry import query
from broadsheet.session import scratch_path
from broadsheet.sources import api_json

SLUG = "coalesce(nullif(trim(regexp_replace(replace(lower(trim({0})), 'ß', 'ss'), '[^a-z0-9._-]+', '-', 'g'), '-._'), ''), 'unknown')"
TIME_PATH = "'year=' || strftime({0}, '%Y') || '/month=' || strftime({0}, '%m') || '/day=' || strftime({0}, '%d') || '/hour=' || strftime({0}, '%H')"


def slug_sql(c: str) -> str:
    return SLUG.format(c)


@query("b1_raw_layer_append", sql="""
SELECT 'search-api' AS p_provider, strftime(seen, '%Y') AS year, strftime(seen, '%m') AS month, strftime(seen, '%d') AS day,
       strftime(seen, '%H') AS hour, count(*) AS payloads
FROM (SELECT event_id // 100 AS payload, max(ts) AS seen FROM events GROUP BY 1) GROUP BY ALL""")
def b1(t: Tables) -> DataFrame:
    """Land raw payloads by provider and collection hour, then count what was committed."""
    path = lake.write_layer(lake.raw_envelopes(t.api_payloads), scratch_path(t.spark, "lake"), "raw", "collected_at")
    landed = t.spark.read.option("basePath", path).option("spark.sql.sources.partitionColumnTypeInference.enabled", "false").parquet(path)
    return landed.groupBy(*_padded(["p_provider"])).agg(F.count("*").alias("payloads"))


def _padded(names: list[str]) -> list:
    pad = lambda c, n: F.lpad(F.col(c).cast("string"), n, "0").alias(c)
    return [F.col(n) for n in names] + [pad("year", 4), pad("month", 2), pad("day", 2), pad("hour", 2)]


@query("b2_processed_layer_append", "docs", f"""
SELECT {slug_sql('source_name')} AS p_provider, {slug_sql('primary_category')} AS p_category, strftime(published_at, '%Y') AS year,
       strftime(published_at, '%m') AS month, strftime(published_at, '%d') AS day, strftime(published_at, '%H') AS hour, count(*) AS articles
FROM docs GROUP BY ALL""")
def b2(t: Tables) -> DataFrame:
    path = lake.write_articles(t.docs.drop("labels", "social_card"), scratch_path(t.spark, "lake"))
    return t.spark.read.parquet(path).groupBy(*_padded(["p_provider", "p_category"])).agg(F.count("*").alias("articles"))


def api_rejects(t: Tables) -> DataFrame:
    rejected = t.api_mapped.filter(F.col("reject_reason").isNotNull())
    return rejected.select(
        "payload_id", "pos", "provider", F.coalesce("reject_source_id", "source_id").alias("source_id"),
        F.col("reject_reason").alias("reason"), F.col("collected_at").alias("rejected_at"), F.col("record_json").alias("payload"),
    )


@query("b3_rejected_layer_append", "api_mapped", """
SELECT 'search-api' AS p_provider, reject_reason AS reason, count(*) AS n FROM api_mapped WHERE reject_reason IS NOT NULL GROUP BY ALL""")
def b3(t: Tables) -> DataFrame:
    path = lake.write_layer(lake.rejected_envelopes(api_rejects(t)), scratch_path(t.spark, "lake"), "rejected", "rejected_at")
    return t.spark.read.parquet(path).groupBy("p_provider", "reason").agg(F.count("*").alias("n"))


@query("b4_partition_path", "docs", f"""
SELECT doc_id, 'processed/news/provider=' || {slug_sql('source_name')} || '/category=' || {slug_sql('primary_category')} ||
       '/country=' || {slug_sql('country_code')} || '/language=' || {slug_sql('language_code')} || '/' || {TIME_PATH.format('published_at')} || '/' || article_id || '.json' AS path
FROM docs""")
def b4(t: Tables) -> DataFrame:
    path = lake.object_path(
        "processed", F.col("published_at"), F.col("article_id"), F.col("source_name"), F.col("primary_category"),
        {"language": F.col("language_code"), "country": F.col("source_country_code")},
    )
    return t.docs.select("doc_id", path.alias("path"))


@query("b5_partition_slug", sql=f"""
SELECT slug, count(*) AS n FROM (SELECT {slug_sql("o_orderpriority || ' / ' || o_orderstatus || ' '")} AS slug FROM orders
  UNION ALL SELECT {slug_sql("'  ' || p_name || ' & ' || p_type || '!'")} FROM part) GROUP BY slug""")
def b5(t: Tables) -> DataFrame:
    both = t.base("orders").select(F.expr("concat(o_orderpriority, ' / ', o_orderstatus, ' ')").alias("v")).unionAll(
        t.base("part").select(F.expr("concat('  ', p_name, ' & ', p_type, '!')"))
    )
    return both.select(text.slug(F.col("v")).alias("slug")).groupBy("slug").agg(F.count("*").alias("n"))


@query("b6_canonical_json", sql="""
SELECT o_orderkey, '{"day":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+00:00') || '","key":' || o_orderkey || ',"note":null,"priority":"' ||
       o_orderpriority || '","status":"' || o_orderstatus || '"}' AS document FROM orders""")
def b6(t: Tables) -> DataFrame:
    document = lake.canonical_json({
        "status": F.col("o_orderstatus"), "key": F.col("o_orderkey"), "priority": F.col("o_orderpriority"),
        "day": times.iso_text(F.col("o_orderdate").cast("timestamp")), "note": F.lit(None).cast("string"),
    })
    return t.base("orders").select("o_orderkey", document.alias("document"))


@query("b7_lineage_uri", "docs", f"""
SELECT doc_id, 's3://news-lake/raw/news/provider=wire/' || {TIME_PATH.format('published_at')} || '/' || doc_id || '.json' AS raw_uri,
  's3://news-lake/processed/news/provider=' || {slug_sql('source_name')} || '/category=' || {slug_sql('primary_category')} || '/' || {TIME_PATH.format('published_at')} || '/' || article_id || '.json' AS processed_uri
FROM docs""")
def b7(t: Tables) -> DataFrame:
    raw = lake.object_path("raw", F.col("published_at"), F.col("doc_id"), F.lit("Wire"))
    return t.docs.select(
        "doc_id", lake.storage_uri("news-lake", raw).alias("raw_uri"), lake.article_uri("news-lake").alias("processed_uri")
    )


@query("b8_raw_before_processing", "api_mapped", """
SELECT 'p' || payload AS payload_id, count(*) AS received, count(*) FILTER (WHERE reject_reason IS NULL) AS valid FROM api_mapped GROUP BY ALL""")
def b8(t: Tables) -> DataFrame:
    """Articles are read from the committed raw layer, never from the payload in flight."""
    path = lake.write_layer(lake.raw_envelopes(t.api_payloads), scratch_path(t.spark, "lake"), "raw", "collected_at")
    raw = t.spark.read.parquet(path).select("payload_id", F.col("payload").alias("body"))
    records = api_json.explode_records(api_json.parse_payloads(raw))
    mapped = api_json.map_records(records, t.countries, t.languages)
    return mapped.groupBy("payload_id").agg(
        F.count("*").alias("received"), F.count_if(F.col("reject_reason").isNull()).alias("valid")
    )


@query("b9_rejected_store_audit", "feed_mapped", """
SELECT coalesce(reject_reason, '') AS reason, reject_reason IS NOT NULL AS stored, count(*) AS n FROM feed_mapped GROUP BY ALL""")
def b9(t: Tables) -> DataFrame:
    """Rejects are stored with their reason; rows without a reason are refused and counted."""
    rows = t.feed_mapped.select(
        "payload_id", "pos", "provider", F.col("reject_source_id").alias("source_id"),
        F.coalesce("reject_reason", F.lit("")).alias("reason"), F.current_timestamp().alias("rejected_at"),
        F.col("record_json").alias("payload"),
    )
    stored = lake.rejected_envelopes(rows).select("reason", F.lit(True).alias("stored"))
    refused = lake.blank_reasons(rows).select("reason", F.lit(False).alias("stored"))
    return stored.unionAll(refused).groupBy("reason", "stored").agg(F.count("*").alias("n"))


def accepted_requests(t: Tables) -> DataFrame:
    decided = dedup.dedup_by_url(t.read_requests, None)
    return decided.filter(F.col("status") == dedup.STORED)


@query("b10_article_insert", "persisted", """
SELECT article_id AS id, url, sha256(source_name || '|RSS') AS source_id, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at,
       'General' AS primary_category, 'Unknown' AS sentiment, 'en' AS language_code FROM persisted WHERE status = 'stored'""")
def b10(t: Tables) -> DataFrame:
    accepted = accepted_requests(t).withColumn(
        "source_id", conform.source_key(F.col("source_name"), F.col("source_type"))
    ).withColumn("processed_s3_uri", lake.article_uri("news-lake"))
    rows = conform.article_rows(accepted)
    path = scratch_path(t.spark, "articles")
    rows.write.mode("append").parquet(path)
    return t.spark.read.schema(rows.schema).parquet(path).select(
        "id", "url", "source_id", stamp(F.col("published_at")).alias("published_at"), "primary_category", "sentiment", "language_code"
    )


@query("b11_source_insert", "persisted", """
SELECT source_name AS name, 'RSS' AS source_type, sha256(source_name || '|RSS') AS id, min_by(country_code, seq) AS country_code
FROM persisted WHERE status = 'stored' GROUP BY source_name""")
def b11(t: Tables) -> DataFrame:
    return conform.new_sources(accepted_requests(t), None).select("name", "source_type", "id", "country_code")
