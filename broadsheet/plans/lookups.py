"""Sections E, F and G: joins and lookups, counters, order-dependent logic."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.functions import codes
from broadsheet.operators import conform, dedup, metrics, mutations, rankings, serving
from broadsheet.plans.bindings import COUNTRY_CODES, LANGUAGES, Tables, stamp
from broadsheet.plans.registry import query
from broadsheet.plans.scans import queue_events
from broadsheet.plans.validation import favorite_changes, proposed_rankings
from broadsheet.session import scratch_path
from broadsheet.sources import messages, registry
from broadsheet.streaming import queue

TS = "strftime({0}, '%Y-%m-%d %H:%M:%S')"
SNAPSHOT_DATE = "2026-06-01"


@query("e1_articles_for_state", "docs article_states", f"""
SELECT d.article_id AS id, s.relevance_score, {TS.format('d.published_at')} AS published_at FROM docs d JOIN article_states s USING (article_id)
WHERE s.state_code = 'N-03' ORDER BY s.relevance_score DESC, d.published_at DESC, d.article_id LIMIT 50""")
def e1(t: Tables) -> DataFrame:
    return serving.list_for_state(t.articles, t.article_states, "N-03").select(
        "id", "relevance_score", stamp(F.col("published_at")).alias("published_at")
    )


@query("e2_ranked_articles", "docs article_states rankings", f"""
SELECT r.rank_position, r.article_id, d.title, d.url FROM rankings r JOIN docs d USING (article_id)
WHERE state_code = 'N-07' AND ranking_date = '{SNAPSHOT_DATE}' ORDER BY rank_position LIMIT 10""")
def e2(t: Tables) -> DataFrame:
    top = rankings.list_ranked_articles(t.rankings, t.articles, "N-07", SNAPSHOT_DATE)
    return top.select(F.col("rank_position").cast("bigint").alias("rank_position"), "article_id", "title", "url")


@query("e3_favorite_states", "favorite_states states", """
SELECT f.user_id, s.code AS state_code, s.name, s.display_order FROM favorite_states f JOIN states s ON s.code = f.state_code WHERE s.is_active""")
def e3(t: Tables) -> DataFrame:
    return serving.favorite_states(t.favorite_states, t.states).select("user_id", "state_code", "name", "display_order")


def stored_and_incoming(t: Tables) -> tuple[DataFrame, DataFrame]:
    """documents as stored articles (some with a canonical url) and again as arrivals."""
    stored = t.articles.withColumn(
        "canonical_url", F.expr("if(doc_id % 4 = 0, concat('https://canon.example.com/', doc_id), null)")
    )
    incoming = t.docs.withColumn(
        "url", F.expr("case doc_id % 3 when 0 then url when 1 then concat('https://canon.example.com/', doc_id) else concat('https://new.example.com/', doc_id) end")
    ).withColumn("content_hash", F.expr("if(doc_id % 5 = 0, null, content_hash)"))
    return stored, incoming


@query("e4_duplicate_by_url", "docs", """
SELECT doc_id, CASE WHEN doc_id % 3 = 0 OR (doc_id % 3 = 1 AND doc_id % 4 = 0) THEN article_id ELSE '' END AS existing_id FROM docs""")
def e4(t: Tables) -> DataFrame:
    stored, incoming = stored_and_incoming(t)
    return dedup.url_hits(incoming, stored).select("doc_id", F.coalesce("existing_id", F.lit("")).alias("existing_id"))


@query("e5_duplicate_by_hash", "docs", """
SELECT d.doc_id, CASE WHEN d.doc_id % 5 = 0 THEN '' ELSE h.first_id END AS existing_id FROM docs d
JOIN (SELECT content_hash, min(article_id) AS first_id FROM docs GROUP BY 1) h USING (content_hash)""")
def e5(t: Tables) -> DataFrame:
    stored, incoming = stored_and_incoming(t)
    return dedup.hash_hits(incoming, stored).select("doc_id", F.coalesce("existing_id", F.lit("")).alias("existing_id"))


@query("e6_source_lookup", "docs", """
SELECT doc_id, CASE WHEN source_name IN ('src3', 'src7') THEN '' ELSE sha256(source_name || '|RSS') END AS source_id FROM docs""")
def e6(t: Tables) -> DataFrame:
    known = t.articles.filter("source_name not in ('src3', 'src7')").select(
        F.col("source_id").alias("id"), F.col("source_name").alias("name"), F.lit("RSS").alias("source_type")
    ).distinct()
    return conform.with_source_id(t.docs, known).select("doc_id", F.coalesce("source_id", F.lit("")).alias("source_id"))


@query("e7_country_name_to_code", "api_raw", """
SELECT event_id, coalesce(country_code, '') AS code FROM api_raw""")
def e7(t: Tables) -> DataFrame:
    return codes.with_country_code(t.api_raw_records, "sourcecountry", "code", t.countries).select(
        "event_id", F.coalesce("code", F.lit("")).alias("code")
    )


@query("e8_language_name_to_code", "api_raw", "SELECT event_id, language_code FROM api_raw")
def e8(t: Tables) -> DataFrame:
    return codes.with_language_code(t.api_raw_records, "language", "language_code", t.languages).select("event_id", "language_code")


@query("e9_lookup_by_key_set", "users docs", """
SELECT 'user' AS entity, email AS found FROM users WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
UNION ALL SELECT 'article', article_id FROM docs WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""")
def e9(t: Tables) -> DataFrame:
    """Users by a set of e-mail addresses and articles by a set of ids, as semi joins."""
    asked = t.base("orders").filter("o_orderstatus = 'P'").select(
        F.expr("concat(' CUSTOMER.', lpad(cast(o_custkey as string), 9, '0'), '@Example.com ')").alias("email")
    )
    users = serving.users_by_email(t.users, asked).select(F.lit("user").alias("entity"), F.col("email").alias("found"))
    wanted = t.base("labels").filter("quality = 1").join(t.articles.select("doc_id", "id"), "doc_id").select("id")
    articles = serving.by_keys(t.articles, "id", wanted, "id").select(F.lit("article").alias("entity"), F.col("id").alias("found"))
    return users.unionAll(articles)


@query("e10_article_id_carried", "persisted", """
SELECT article_id, country_code, state_code, score AS relevance_score FROM persisted WHERE status = 'stored'""")
def e10(t: Tables) -> DataFrame:
    """The id of the message's article reaches the row and both link tables."""
    accepted = dedup.dedup_by_url(t.read_requests, None).filter(F.col("status") == dedup.STORED)
    states = conform.state_links(accepted).select("article_id", "state_code", "relevance_score")
    return conform.country_links(accepted).select("article_id", "country_code").join(states, "article_id")


def run_outcomes(t: Tables) -> DataFrame:
    """Outcome rows of one run over the messages: articles by decision or failed by their contract, broken messages as rejects.

    A message that is no JSON has no payload to store, so its reject fails."""
    batch = (F.col("user_id") % 10).alias("batch")
    decided = dedup.dedup_by_url(t.read_requests, None).select(batch, F.lit("article").alias("kind"), "status")
    refused = t.read_messages.filter("message_error IS NULL AND article_error IS NOT NULL").select(batch, F.lit("article").alias("kind"), F.lit("failed").alias("status"))
    lost = F.col("message_error") == "invalid_json"
    bad = t.read_messages.filter(F.col("message_error").isNotNull()).select(
        batch, F.lit("reject").alias("kind"), F.when(lost, "failed").otherwise("kept").alias("status")
    )
    return decided.unionByName(refused).unionByName(bad)


@query("f1_batch_counters", "messages persisted", """
SELECT batch, count(*) AS total_received, count(*) FILTER (WHERE s = 'stored') AS stored_count, count(*) FILTER (WHERE s = 'duplicate') AS duplicate_count,
  count(*) FILTER (WHERE s = 'kept') AS rejected_count, count(*) FILTER (WHERE s IN ('refused', 'lost')) AS failed_count,
  count(*) FILTER (WHERE s = 'refused') AS failed_articles, count(*) FILTER (WHERE s = 'lost') AS failed_rejects
FROM (SELECT user_id % 10 AS batch, status AS s FROM persisted
      UNION ALL SELECT user_id % 10, CASE WHEN message_error IS NULL THEN 'refused' WHEN message_error = 'invalid_json' THEN 'lost' ELSE 'kept' END
      FROM messages WHERE message_error IS NOT NULL OR article_error IS NOT NULL) GROUP BY batch""")
def f1(t: Tables) -> DataFrame:
    return metrics.batch_counters(run_outcomes(t), ["batch"])


@query("f2_dispatch_counters", "api_mapped", """
SELECT 'p' || payload AS payload_id, count(*) AS received_count, count(*) FILTER (WHERE reject_reason IS NULL) AS validated_count,
  count(*) FILTER (WHERE reject_reason IS NULL AND pos % 17 <> 3) AS queued_count, count(*) FILTER (WHERE reject_reason <> 'url_empty') AS rejected_count,
  count(*) FILTER (WHERE reject_reason = 'url_empty' OR (reject_reason IS NULL AND pos % 17 = 3)) AS failed_count FROM api_mapped GROUP BY ALL""")
def f2(t: Tables) -> DataFrame:
    """Counters of a run in which some messages cannot be made and some rejects come without a reason."""
    unexplained = t.api_mapped.withColumn("reject_reason", F.when(F.col("reject_reason") == "url_empty", " ").otherwise(F.col("reject_reason")))
    factory = lambda df: queue.default_message(df).withColumn("body", F.when(F.expr("pos % 17 <> 3"), F.col("body")))
    status = queue.dispatch(t.api_payloads, unexplained, scratch_path(t.spark, "counters"), factory)
    return metrics.dispatch_counters(status, ["payload_id"])


def consumed_records(t: Tables) -> DataFrame:
    records, _ = messages.parse_events(queue_events(t))
    return records.withColumn("status", F.when(F.col("body").isNull(), "failed").otherwise("stored"))


@query("f3_consumer_summary", sql="""
SELECT batch, count(*) AS total_count, count(*) FILTER (WHERE NOT failed) AS succeeded_count,
  '{"batchItemFailures":[' || coalesce(string_agg('{"itemIdentifier":"m-' || event_id || '"}', ',' ORDER BY event_id) FILTER (WHERE failed), '') || ']}' AS response
FROM (SELECT event_id, event_id // 10 AS batch, event_id % 71 = 3 AS failed FROM events WHERE event_id // 10 % 47 NOT IN (5, 9)) GROUP BY batch""")
def f3(t: Tables) -> DataFrame:
    return metrics.failure_response(metrics.consumer_summary(consumed_records(t), ["batch"])).select(
        "batch", "total_count", "succeeded_count", "response"
    )


@query("f4_filtered_region_counts", "states", """
SELECT count(*) AS total, count(*) FILTER (WHERE is_active) AS active, count(*) FILTER (WHERE region_type = 'state') AS states,
  count(*) FILTER (WHERE region_type = 'union_territory') AS territories FROM states""")
def f4(t: Tables) -> DataFrame:
    return registry.region_audit(t.states).select("total", "active", "states", "territories")


@query("f5_provider_run_counters", "persisted", """
SELECT source_name AS provider, count(*) AS fetched, count(*) FILTER (WHERE status = 'stored') AS stored, count(*) FILTER (WHERE status = 'duplicate') AS duplicates FROM persisted GROUP BY ALL""")
def f5(t: Tables) -> DataFrame:
    return dedup.dedup_by_url(t.read_requests, None).groupBy(F.col("source_name").alias("provider")).agg(
        F.count("*").alias("fetched"), F.count_if(F.col("status") == "stored").alias("stored"),
        F.count_if(F.col("status") == "duplicate").alias("duplicates"),
    )


@query("f6_feed_counters", "feed_decided", """
SELECT 'f' || payload AS payload_id, count(*) AS received, count(*) FILTER (WHERE status = 'accepted') AS accepted, count(*) FILTER (WHERE status = 'duplicate') AS duplicate,
  count(*) FILTER (WHERE status = 'rejected') AS rejected, count(*) FILTER (WHERE status = 'filtered') AS filtered, count(*) FILTER (WHERE status = 'unread') AS unread FROM feed_decided GROUP BY ALL""")
def f6(t: Tables) -> DataFrame:
    return metrics.feed_counters(t.feed_decided, ["payload_id"])


@query("f7_distinct_set_checks", "rankings", """
SELECT state_code, ranking_date, count(*) AS n, count(*) = count(DISTINCT article_id) AS articles_distinct, count(*) = count(DISTINCT rank_position) AS positions_distinct
FROM (SELECT state_code, article_id, CASE WHEN CAST(substring(state_code, 3) AS INTEGER) % 6 = 1 AND rank_position = 2 THEN 1 ELSE rank_position END AS rank_position, ranking_date FROM rankings)
GROUP BY state_code, ranking_date""")
def f7(t: Tables) -> DataFrame:
    return proposed_rankings(t).groupBy("state_code", F.date_format("ranking_date", "yyyy-MM-dd").alias("ranking_date")).agg(
        F.count("*").alias("n"), (F.count("*") == F.countDistinct("article_id")).alias("articles_distinct"),
        (F.count("*") == F.countDistinct("rank_position")).alias("positions_distinct"),
    )


@query("g1_in_feed_dedup", "feed_decided", """
SELECT 'f' || payload AS payload_id, pos, status FROM feed_decided WHERE status IN ('accepted', 'duplicate')""")
def g1(t: Tables) -> DataFrame:
    return t.feed_decided.filter(F.col("status").isin("accepted", "duplicate")).select("payload_id", "pos", "status")


@query("g2_feed_cap", "feed_decided", """
SELECT 'f' || payload AS payload_id, any_value(cap) AS cap, count(*) FILTER (WHERE status = 'accepted') AS accepted, count(*) FILTER (WHERE status = 'unread') AS unread FROM feed_decided GROUP BY ALL""")
def g2(t: Tables) -> DataFrame:
    return t.feed_decided.groupBy("payload_id").agg(
        F.first("cap").alias("cap"), F.count_if(F.col("status") == "accepted").alias("accepted"),
        F.count_if(F.col("status") == "unread").alias("unread"),
    )


@query("g3_priority_from_order", sql="""
SELECT c_custkey::VARCHAR AS user_id, code AS country_code, priority FROM (
  SELECT c_custkey, unnest(CASE WHEN c_custkey % 6 = 0 THEN ['US', 'IN'] ELSE ['FR'] END) AS code,
         unnest(CASE WHEN c_custkey % 6 = 0 THEN [1, 2] ELSE [1] END) AS priority FROM customer WHERE c_custkey % 6 IN (0, 4))""")
def g3(t: Tables) -> DataFrame:
    valid = favorite_changes(t).filter(mutations.favorite_country_error(F.col("country_codes")).isNull())
    return mutations.favorite_country_rows(valid).withColumn("priority", F.col("priority").cast("int"))


@query("g4_position_sequence", "rankings", """
SELECT state_code, ranking_date, bool_and(proposed = expected) AS sequential FROM (
  SELECT *, row_number() OVER (PARTITION BY state_code, ranking_date ORDER BY proposed, article_id) AS expected FROM (
    SELECT *, CASE WHEN k % 6 = 1 AND rank_position = 2 THEN 1 WHEN k % 6 = 2 THEN rank_position + 1 ELSE rank_position END AS proposed
    FROM (SELECT *, CAST(substring(state_code, 3) AS INTEGER) AS k FROM rankings))) GROUP BY ALL""")
def g4(t: Tables) -> DataFrame:
    """Positions equal their row number; a snapshot has at most ten rows, so groups stay small."""
    order = Window.partitionBy(*rankings.SNAPSHOT).orderBy("rank_position", "article_id")
    return proposed_rankings(t).withColumn("expected", F.row_number().over(order)).groupBy(
        "state_code", F.date_format("ranking_date", "yyyy-MM-dd").alias("ranking_date")
    ).agg(F.min(F.col("rank_position") == F.col("expected")).alias("sequential"))


@query("g5_sequential_duplicates_across_batches", "persisted", """
SELECT seq, CASE WHEN seq % 2 = 0 THEN 'first' ELSE 'second' END AS batch, CASE WHEN seq = first_even OR (first_even IS NULL AND seq = first_odd) THEN 'stored' ELSE 'duplicate' END AS status
FROM persisted JOIN (SELECT url, min(seq) FILTER (WHERE seq % 2 = 0) AS first_even, min(seq) FILTER (WHERE seq % 2 = 1) AS first_odd FROM persisted GROUP BY url) USING (url)""")
def g5(t: Tables) -> DataFrame:
    """Even events arrive first, odd ones in a second batch that sees the first as stored."""
    first = dedup.dedup_by_url(t.read_requests.filter("seq % 2 = 0"), None)
    stored = first.filter(F.col("status") == dedup.STORED).select(F.col("article_id").alias("id"), "url", "canonical_url")
    second = dedup.dedup_by_url(t.read_requests.filter("seq % 2 = 1"), stored)
    show = lambda df, name: df.select("seq", F.lit(name).alias("batch"), "status")
    return show(first, "first").unionByName(show(second, "second"))
