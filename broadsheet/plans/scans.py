"""Section A: scans and sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet import fixed
from broadsheet.plans.bindings import Tables, pick, stamp
from broadsheet.plans.registry import query
from broadsheet.schemas import TABLES
from broadsheet.session import scratch_path
from broadsheet.sources import api_json, feed_xml, messages, registry


@query("a1_api_record_scan", "api_mapped", """
SELECT 'p' || payload AS payload_id, pos, CASE WHEN reject_reason IS NULL THEN 'article' ELSE 'rejected' END AS outcome,
       coalesce(reject_reason, '') AS reason FROM api_mapped""")
def a1(t: Tables) -> DataFrame:
    return t.api_mapped.select(
        "payload_id", "pos", F.when(F.col("reject_reason").isNull(), "article").otherwise("rejected").alias("outcome"),
        F.coalesce("reject_reason", F.lit("")).alias("reason"),
    )


@query("a2_payload_shape_gate", "api_raw", """
SELECT DISTINCT 'p' || payload AS payload_id, CASE payload % 23 WHEN 7 THEN 'top_level_not_object' WHEN 11 THEN 'articles_missing'
  WHEN 13 THEN 'articles_not_list' WHEN 17 THEN 'invalid_json' WHEN 19 THEN 'articles_missing' ELSE 'ok' END AS payload_error
FROM api_raw""")
def a2(t: Tables) -> DataFrame:
    return api_json.parse_payloads(t.api_payloads).select(
        "payload_id", F.coalesce("payload_error", F.lit("ok")).alias("payload_error")
    )


@query("a3_feed_entry_scan", "feed_decided", """
SELECT 'f' || payload AS payload_id, pos, status, coalesce(url, '') AS url FROM feed_decided""")
def a3(t: Tables) -> DataFrame:
    return t.feed_decided.select("payload_id", "pos", "status", F.coalesce("url", F.lit("")).alias("url"))


@query("a4_feed_usability_gate", "docs", """
SELECT 'f' || payload AS payload_id, CASE WHEN payload % 29 IN (5, 7) THEN 0 ELSE n END AS n_entries,
       CASE payload % 29 WHEN 5 THEN 'parse_error_without_entries' WHEN 7 THEN 'unknown_format_without_entries' ELSE 'ok' END AS payload_error,
       payload % 29 = 5 OR (payload % 29 = 3 AND payload % 3 = 0) AS parse_warning
FROM (SELECT doc_id // 40 AS payload, count(*) AS n FROM docs GROUP BY 1)""")
def a4(t: Tables) -> DataFrame:
    return t.feed_parsed.select(
        "payload_id", F.col("n_entries").cast("bigint").alias("n_entries"),
        F.coalesce("payload_error", F.lit("ok")).alias("payload_error"),
        F.col("parse_error").isNotNull().alias("parse_warning"),
    )


@query("a5_expected_format_audit", "docs", """
SELECT expected_format, count(*) AS feeds, count(*) FILTER (WHERE (expected_format = 'rss' AND atom) OR (expected_format = 'atom' AND rss)) AS mismatched
FROM (SELECT DISTINCT doc_id // 40 AS payload, (['rss', 'atom', 'auto'])[CAST(doc_id // 40 % 5 % 3 AS INTEGER) + 1] AS expected_format,
        doc_id // 40 % 3 = 0 AND doc_id // 40 % 29 NOT IN (5, 7) AS atom, doc_id // 40 % 3 <> 0 AND doc_id // 40 % 29 NOT IN (5, 7) AS rss FROM docs)
GROUP BY expected_format""")
def a5(t: Tables) -> DataFrame:
    return t.feed_parsed.groupBy("expected_format").agg(
        F.count("*").alias("feeds"), F.count_if(feed_xml.format_mismatch()).alias("mismatched")
    )


@query("a6_validated_only_envelope", "docs", """
SELECT doc_id // 50 AS batch, '{"provider_name":"Wire","articles":[' ||
       string_agg('{"article_id":"' || article_id || '","url":"' || url || '"}', ',' ORDER BY doc_id) || ']}' AS payload
FROM docs GROUP BY 1""")
def a6(t: Tables) -> DataFrame:
    """A batch of fifty articles gets a raw envelope of its own (fixed list size)."""
    article = F.struct("doc_id", F.struct("article_id", "url").alias("a"))
    batches = t.docs.groupBy(F.expr("doc_id div 50").alias("batch")).agg(F.array_sort(F.collect_list(article)).alias("items"))
    articles = F.transform("items", lambda i: i["a"])
    return batches.select(
        "batch", F.to_json(F.struct(F.lit("Wire").alias("provider_name"), articles.alias("articles"))).alias("payload")
    )


@query("a7_article_message_scan", "messages", """
SELECT event_id, CASE WHEN message_error IS NOT NULL THEN message_error WHEN article_error IS NOT NULL THEN article_error ELSE 'ok' END AS outcome FROM messages""")
def a7(t: Tables) -> DataFrame:
    articles = messages.parse_articles(t.messages, "article_payload", t.countries)
    return articles.select(
        "event_id", F.coalesce("message_error", "article_error", F.lit("ok")).alias("outcome")
    )


def queue_events(t: Tables) -> DataFrame:
    """Ten events per queue batch; some batches are malformed."""
    body = F.when(F.expr("event_id % 71 <> 3"), F.concat(F.lit("payload "), F.col("event_id").cast("string")))
    nameless = F.expr("event_id div 10 % 47 = 9 and event_id % 10 = 4")
    message_id = F.when(~nameless, F.concat(F.lit(" m-"), F.col("event_id").cast("string")))
    record = F.to_json(F.struct(message_id.alias("messageId"), body.alias("body")))
    batches = t.base("events").select(F.expr("event_id div 10").alias("batch"), "event_id", record.alias("r")).groupBy(
        "batch"
    ).agg(F.array_sort(F.collect_list(F.struct("event_id", "r"))).alias("items"))
    listed = F.array_join(F.transform("items", lambda i: i["r"]), ",")
    return batches.select(
        "batch",
        F.when(F.expr("batch % 47 = 5"), F.lit('{"records":[]}')).otherwise(
            F.concat(F.lit('{"Records":['), listed, F.lit("]}"))
        ).alias("body"),
    )


@query("a8_queue_event_scan", sql="""
SELECT event_id // 10 AS batch, event_id % 10 AS pos, 'm-' || event_id AS item_id,
       CASE WHEN event_id % 71 = 3 THEN 'failed' ELSE 'readable' END AS status
FROM events WHERE event_id // 10 % 47 NOT IN (5, 9)
UNION ALL
SELECT DISTINCT event_id // 10, -1, '', CASE event_id // 10 % 47 WHEN 5 THEN 'records_not_a_list' ELSE 'message_id_missing' END
FROM events WHERE event_id // 10 % 47 IN (5, 9)""")
def a8(t: Tables) -> DataFrame:
    records, errors = messages.parse_events(queue_events(t))
    return records.select(
        "batch", "pos", "item_id", F.when(F.col("body").isNull(), "failed").otherwise("readable").alias("status")
    ).unionByName(
        errors.select("batch", F.lit(-1).alias("pos"), F.lit("").alias("item_id"), F.col("event_error").alias("status"))
    )


REQUEST_ERROR = """CASE WHEN c_custkey % 31 = 6 THEN 'unknown_field' WHEN c_custkey % 29 = 3 THEN 'provider_invalid'
  WHEN c_custkey % 260 NOT BETWEEN 1 AND 250 THEN 'max_records_invalid' WHEN c_custkey % 8 IN (4, 5) THEN 'timespan_invalid' ELSE 'ok' END"""


@query("a9_ingestion_request_scan", sql=f"""
SELECT c_custkey, trim(CASE WHEN c_custkey % 29 = 3 THEN '' ELSE c_mktsegment END) AS provider,
  trim(lower((['24h', ' 7D ', '10min', '2weeks', '1month', '5x', '3months', '15min'])[CAST(c_custkey % 8 AS INTEGER) + 1])) AS timespan,
  {REQUEST_ERROR} AS request_error FROM customer""")
def a9(t: Tables) -> DataFrame:
    return messages.parse_requests(t.request_bodies).select(
        "c_custkey", "provider", "timespan", F.coalesce("request_error", F.lit("ok")).alias("request_error")
    )


def relational_tables(t: Tables) -> dict[str, DataFrame]:
    """All fourteen tables, bound to the given data."""
    docs = t.docs
    links = t.article_states
    place = lambda kind: docs.select(
        "article_id", F.expr(f"concat('{kind}-', doc_id % 50)").alias(f"{kind}_id"),
        F.lit("0.5000").cast("decimal(5,4)").alias("relevance_score"),
    )
    now = F.lit(None).cast("timestamp")
    parts = t.base("part")
    return {
        "news_sources": t.sources.select("*", F.lit(None).cast("map<string,string>").alias("extra_metadata"), now.alias("created_at"), now.alias("updated_at")),
        "indian_states": t.states,
        "districts": parts.select(
            F.expr("concat('district-', p_partkey)").alias("id"), F.expr("concat('N-', lpad(cast(p_partkey % 25 as string), 2, '0'))").alias("state_code"),
            F.expr("concat(p_name, ' ', p_partkey)").alias("name"), F.expr("concat(replace(p_name, ' ', '-'), '-', p_partkey)").alias("slug"),
            F.expr("p_size > 5").alias("is_active"), "p_partkey"),
        "cities": parts.select(
            F.expr("concat('city-', p_partkey)").alias("id"), F.expr("concat('N-', lpad(cast(p_partkey % 25 as string), 2, '0'))").alias("state_code"),
            F.expr("concat('district-', p_partkey - p_partkey % 50 + p_partkey % 25)").alias("district_id"),
            F.expr("concat(p_brand, ' ', p_partkey)").alias("name"), F.expr("concat('c-', p_partkey)").alias("slug"),
            F.expr("p_size > 10").alias("is_active"), "p_partkey"),
        "articles": t.articles.select("*", F.lit(None).cast("string").alias("description"), F.lit(None).cast("string").alias("image_url"),
                                      F.lit(None).cast("string").alias("raw_s3_uri"), F.lit(None).cast("string").alias("processed_s3_uri")),
        "article_labels": docs.select("article_id", F.explode("labels").alias("label")),
        "article_countries": t.article_countries,
        "article_states": links,
        "article_districts": place("district"),
        "article_cities": place("city"),
        "app_users": t.users,
        "user_favorite_countries": t.favorite_countries,
        "user_favorite_states": t.favorite_states,
        "state_news_rankings": t.rankings.withColumn("score_components", F.lit(None).cast("map<string,double>")),
    }


@query("a10_relational_table_scans", "docs article_states favorite_countries favorite_states rankings", """
SELECT 'news_sources' AS table_name, count(*) AS n FROM supplier UNION ALL SELECT 'indian_states', count(*) FROM nation
UNION ALL SELECT 'districts', count(*) FROM part UNION ALL SELECT 'cities', count(*) FROM part
UNION ALL SELECT 'articles', count(*) FROM docs UNION ALL SELECT 'article_labels', count(*) FROM docs
UNION ALL SELECT 'article_countries', count(*) FROM docs UNION ALL SELECT 'article_states', count(*) FROM article_states
UNION ALL SELECT 'article_districts', count(*) FROM docs UNION ALL SELECT 'article_cities', count(*) FROM docs
UNION ALL SELECT 'app_users', count(*) FROM customer UNION ALL SELECT 'user_favorite_countries', count(*) FROM favorite_countries
UNION ALL SELECT 'user_favorite_states', count(*) FROM favorite_states UNION ALL SELECT 'state_news_rankings', count(*) FROM rankings""")
def a10(t: Tables) -> DataFrame:
    """Write every table once, scan it back with its declared schema."""
    root = scratch_path(t.spark, "tables")
    counts = []
    for name, df in relational_tables(t).items():
        columns = [f.strip().split(" ")[0] for f in _top_level(TABLES[name])]
        df.select(*columns).write.mode("overwrite").parquet(f"{root}/{name}")
        scanned = registry.read_table(t.spark, f"{root}/{name}", name)
        counts.append(scanned.agg(F.lit(name).alias("table_name"), F.count("*").alias("n")))
    return reduce(DataFrame.unionByName, counts)


def _top_level(ddl: str) -> list[str]:
    fields, depth, word = [], 0, ""
    for ch in ddl + ",":
        depth += (ch in "<(") - (ch in ">)")
        if ch == "," and depth == 0:
            fields.append(word)
            word = ""
        else:
            word += ch
    return fields


FEED_IDS = ("nasa-recently-published", " NASA-News-Releases ", "nasa-technology", "nasa-jpl-news", "no-such-feed")


@query("a11_feed_registry_scan", sql="""
SELECT source_id, count(*) AS requests, CASE source_id WHEN 'no-such-feed' THEN 0 ELSE 50 END AS max_articles_per_fetch
FROM (SELECT (['nasa-recently-published', 'nasa-news-releases', 'nasa-technology', 'nasa-jpl-news', 'no-such-feed'])[CAST(c_custkey % 5 AS INTEGER) + 1] AS source_id FROM customer)
GROUP BY 1, 3""")
def a11(t: Tables) -> DataFrame:
    requests = t.base("customer").select(pick(FEED_IDS, "c_custkey % 5").alias("source_id"))
    feeds = registry.enabled_feeds(registry.feed_registry(t.spark))
    known, unknown = registry.resolve_feeds(requests, feeds)
    return (
        known.groupBy("feed.source_id", F.col("feed.max_articles_per_fetch").alias("max_articles_per_fetch"))
        .agg(F.count("*").alias("requests"))
        .unionByName(unknown.groupBy("source_id").agg(F.count("*").alias("requests"), F.lit(0).alias("max_articles_per_fetch")))
    )


REGION_SQL = "(VALUES " + ", ".join(
    f"({i}, '{s}', '{n}', '{kind}')"
    for i, (s, n, kind) in enumerate(
        [(s, n, "state") for s, n in fixed.REGION_STATES] + [(s, n, "union_territory") for s, n in fixed.REGION_TERRITORIES], 1
    )
) + ") AS r(display_order, short_code, name, region_type)"


@query("a12_region_catalog_lookup", sql=f"""
SELECT 'IN-' || short_code AS code, name, region_type, count(*) AS customers
FROM customer JOIN {REGION_SQL} ON c_custkey % 36 + 1 = display_order GROUP BY ALL""")
def a12(t: Tables) -> DataFrame:
    """Customers per region: the 36-row catalogue is broadcast, customers are counted first."""
    regions = registry.region_catalog(t.spark)
    counts = t.base("customer").groupBy(F.expr("cast(c_custkey % 36 + 1 as int)").alias("display_order")).agg(F.count("*").alias("customers"))
    return counts.join(F.broadcast(regions), "display_order").select("code", "name", "region_type", "customers")


@query("a13_provider_routing", "api_mapped feed_mapped docs", """
SELECT 'search api' AS provider, CASE WHEN reject_reason IS NULL THEN 'article' ELSE 'rejected' END AS outcome, count(*) AS n FROM api_mapped GROUP BY ALL
UNION ALL SELECT 'feed', CASE WHEN reject_reason IS NULL THEN 'article' ELSE 'rejected' END, count(*) FROM feed_mapped GROUP BY ALL
UNION ALL SELECT 'bulletin', 'unknown_provider', count(*) FROM (SELECT DISTINCT doc_id // 40 FROM docs)""")
def a13(t: Tables) -> DataFrame:
    mappers = registry.ProviderMappers()
    shape = lambda df: df.select(
        F.lower("provider").alias("provider"), F.when(F.col("reject_reason").isNull(), "article").otherwise("rejected").alias("outcome")
    )
    mappers.register("Search API", lambda raw: shape(api_json.map_records(
        api_json.explode_records(api_json.parse_payloads(raw.select(*search.columns))), t.countries, t.languages)))
    mappers.register("feed", lambda raw: shape(feed_xml.map_entries(feed_xml.explode_entries(feed_xml.parse_feeds(raw)))))
    feeds = t.feed_payloads
    search = t.api_payloads
    raw = search.unionByName(feeds, allowMissingColumns=True).unionByName(
        feeds.withColumn("provider", F.lit(" Bulletin ")), allowMissingColumns=True
    )
    unknown = mappers.unknown(raw).select(
        F.lower(F.trim("provider")).alias("provider"), F.lit("unknown_provider").alias("outcome")
    )
    return mappers.route(raw).unionByName(unknown).groupBy("provider", "outcome").agg(F.count("*").alias("n"))
