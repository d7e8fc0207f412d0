"""Sections K and L: streaming and queue semantics, extension points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet import fixed
from broadsheet.operators import conform, metrics
from broadsheet.plans.bindings import Tables
from broadsheet.plans.registry import query
from broadsheet.plans.scans import REQUEST_ERROR
from broadsheet.session import cut, scratch_path
from broadsheet.sources import api_json, messages, registry
from broadsheet.streaming import queue


def publish(t: Tables, path: str, copies: int = 1, file_rows: int = 12_500) -> None:
    """Write the bound messages as queue files of about ``file_rows`` each, compressed, one message per line."""
    body = t.bodies_dealt(file_rows).select(F.col("body").alias("value"))
    for _ in range(copies):
        body.write.mode("append").text(path, compression="gzip")


def consumed(t: Tables) -> tuple[str, DataFrame]:
    """Run the consumer over all bound messages; (lake folder, outcomes)."""
    root = scratch_path(t.spark, "consumer")
    publish(t, f"{root}/queue")
    queue.prepare_lake(t.spark, root)
    queue.consume(t.spark, f"{root}/queue", root, t.states, t.countries)
    return root, queue.outcomes(t.spark, root)


def failing(records: str) -> queue.MessageFactory:
    """The default messages, without those of some records (a rule over their positions)."""
    return lambda df: queue.default_message(df).withColumn("body", F.when(~F.expr(records), F.col("body")))


DISPATCH_COUNTS = """count(*) AS received_count, count(*) FILTER (WHERE reject_reason IS NULL) AS validated_count,
  count(*) FILTER (WHERE reject_reason IS NULL AND NOT ({fails})) AS queued_count, count(reject_reason) AS rejected_count,
  count(*) FILTER (WHERE reject_reason IS NULL AND {fails}) AS failed_count"""


@query("k1_producer_dispatch", "api_mapped", f"""
SELECT 'p' || payload AS payload_id, {DISPATCH_COUNTS.format(fails="pos % 31 = 5")},
  count(*) FILTER (WHERE reject_reason IS NULL AND pos % 31 <> 5) AS messages, count(reject_reason) AS stored_rejects FROM api_mapped GROUP BY ALL""")
def k1(t: Tables) -> DataFrame:
    """Some messages cannot be made. The run is repeated: nothing is landed, published or stored twice, and the counters stay."""
    root = scratch_path(t.spark, "producer")
    # Both runs look at the payloads and their records several times: written once, read after that.
    payloads = cut(t.api_payloads, "payloads")
    mapped = cut(api_json.map_records(api_json.explode_records(api_json.parse_payloads(payloads)), t.countries, t.languages), "mapped")
    for _ in range(2):
        status = queue.dispatch(payloads, mapped, root, failing("pos % 31 = 5"))
    key = F.sha2(F.concat_ws("|", "provider", "payload_id"), 256)
    named = payloads.select("payload_id", key.alias("record_id"))
    uri = F.get_json_object("value", "$.raw_s3_uri")
    sent = t.spark.read.text(f"{root}/queue").groupBy(F.regexp_extract(uri, "([0-9a-f]{64})", 1).alias("record_id")).agg(F.count("*").alias("messages"))
    rejects = t.spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/{fixed.LAYER_PREFIXES['rejected']}")
    kept = status.filter("status = 'rejected'").select(
        F.sha2(F.concat_ws("|", "provider", "payload_id", F.col("pos").cast("string")), 256).alias("record_id"), "payload_id"
    ).join(rejects.select("record_id"), "record_id").groupBy("payload_id").agg(F.count("*").alias("stored_rejects"))
    counted = metrics.dispatch_counters(status, ["payload_id"]).join(named.join(sent, "record_id").drop("record_id"), "payload_id", "left").join(kept, "payload_id", "left")
    return counted.na.fill(0, ["messages", "stored_rejects"])


@query("k2_consumer_outcomes", "messages persisted", """
SELECT status, count(*) AS n FROM persisted GROUP BY ALL UNION ALL SELECT 'failed', count(*) FROM messages WHERE message_error IS NOT NULL OR article_error IS NOT NULL""")
def k2(t: Tables) -> DataFrame:
    return consumed(t)[1].groupBy("status").agg(F.count("*").alias("n"))


@query("k3_partial_failures", "messages", """
SELECT coalesce(message_error, article_error) AS reason, count(*) AS n FROM messages WHERE message_error IS NOT NULL OR article_error IS NOT NULL GROUP BY ALL""")
def k3(t: Tables) -> DataFrame:
    """Only failed messages are handed back for another delivery."""
    return consumed(t)[1].filter("status = 'failed'").groupBy("reason").agg(F.count("*").alias("n"))


@query("k4_retry_budget", "messages", """
SELECT CASE WHEN next_retry <= 5 THEN 'retry' ELSE 'dead_letter' END AS route, next_retry, count(*) AS n FROM (
  SELECT CASE WHEN message_error = 'invalid_json' THEN 1 ELSE event_id % 8 + 1 END AS next_retry FROM messages
  WHERE message_error IS NOT NULL OR article_error IS NOT NULL) GROUP BY ALL""")
def k4(t: Tables) -> DataFrame:
    """Every failed delivery of the consumer is routed; a body that cannot be read counts as a first attempt."""
    root, _ = consumed(t)
    return queue.routed(t.spark, root).groupBy("route", "next_retry").agg(F.count("*").alias("n"))


@query("k5_redelivery", "persisted", """
SELECT 0 AS delivery, status, count(*) AS n FROM persisted GROUP BY ALL UNION ALL SELECT 1, 'duplicate', count(*) FROM persisted""")
def k5(t: Tables) -> DataFrame:
    """Every message arrives again in a later batch: the second delivery only finds duplicates."""
    root, _ = consumed(t)
    publish(t, f"{root}/queue")
    queue.consume(t.spark, f"{root}/queue", root, t.states, t.countries)
    done = queue.outcomes(t.spark, root).filter("status <> 'failed'")
    return done.groupBy(F.col("ingest_batch").cast("int").alias("delivery"), "status").agg(F.count("*").alias("n"))


@query("k6_message_id_dedup", "messages", """
SELECT count(*) AS received, count(DISTINCT message_id) FILTER (WHERE message_error IS NULL OR message_error <> 'invalid_json') AS distinct_ids FROM messages""")
def k6(t: Tables) -> DataFrame:
    """Each message is published twice; one copy of each id, and of each body that cannot be read, passes."""
    root = scratch_path(t.spark, "fifo")
    # Every batch reads the keys that earlier ones kept, so their number counts: few large files.
    publish(t, f"{root}/queue", copies=2, file_rows=500_000)
    queue.deduplicate(t.spark, f"{root}/queue", root, files_per_batch=4)
    return queue.distinct_messages(t.spark, root).agg(F.count("*").alias("received"), F.countDistinct("message_id").alias("distinct_ids"))


@query("k7_scheduled_run", "messages persisted", """
SELECT 'completed' AS status, (SELECT count(*) FROM messages) AS received_count, count(*) FILTER (WHERE status = 'stored') AS stored_count, count(*) FILTER (WHERE status = 'duplicate') AS duplicate_count FROM persisted""")
def k7(t: Tables) -> DataFrame:
    """One available-now run and its one-row response."""
    return consumed(t)[1].agg(
        F.lit("completed").alias("status"), F.count("*").alias("received_count"),
        F.count_if(F.col("status") == "stored").alias("stored_count"), F.count_if(F.col("status") == "duplicate").alias("duplicate_count"),
    )


PROVIDERS = ("BUILDING", "HOUSEHOLD", "MACHINERY")


@query("k7_request_runs", "api_mapped", f"""
SELECT CAST(c_custkey AS VARCHAR) AS request_id, CASE WHEN reason IS NULL THEN 'completed' ELSE 'failed' END AS status, reason,
  CASE WHEN reason IS NULL THEN coalesce(received_count, 0) ELSE 0 END AS received_count, CASE WHEN reason IS NULL THEN coalesce(validated_count, 0) ELSE 0 END AS validated_count,
  CASE WHEN reason IS NULL THEN coalesce(queued_count, 0) ELSE 0 END AS queued_count, CASE WHEN reason IS NULL THEN coalesce(rejected_count, 0) ELSE 0 END AS rejected_count,
  CASE WHEN reason IS NULL THEN coalesce(failed_count, 0) ELSE 0 END AS failed_count
FROM (SELECT *, CASE WHEN request_error <> 'ok' THEN request_error WHEN c_mktsegment NOT IN {PROVIDERS} THEN 'provider_unknown'
                     WHEN c_custkey - 1 NOT IN (SELECT event_id // 100 FROM events) THEN 'no_payload' END AS reason
      FROM (SELECT *, {REQUEST_ERROR} AS request_error FROM customer)) r
LEFT JOIN (SELECT payload, {DISPATCH_COUNTS.format(fails="pos % 31 = 5")} FROM api_mapped GROUP BY payload) c ON c.payload = r.c_custkey - 1""")
def k7_request_runs(t: Tables) -> DataFrame:
    """Every request gets one response: run over the payload fetched for it, or why it failed. Run twice, answers stay the same."""
    root = scratch_path(t.spark, "requests")
    requests = messages.parse_requests(t.request_bodies).withColumn("request_id", F.col("c_custkey").cast("string"))
    fetched = t.api_payloads.withColumn("request_id", F.expr("cast(cast(substring(payload_id, 2) as bigint) + 1 as string)")).drop("payload_id", "provider")
    fetched = cut(fetched, "fetched")
    mappers = registry.ProviderMappers()
    columns = t.api_payloads.columns
    for provider in PROVIDERS:
        mappers.register(provider, lambda raw: api_json.map_records(
            api_json.explode_records(api_json.parse_payloads(raw.select(*columns))), t.countries, t.languages
        ))
    for _ in range(2):
        answers = queue.run_requests(requests, fetched, mappers, root, failing("pos % 31 = 5"))
    return answers


@query("k8_no_late_drop", "persisted", "SELECT count(*) AS n FROM persisted WHERE status = 'stored'")
def k8(t: Tables) -> DataFrame:
    """Messages up to a month old are all persisted: the consumer has no watermark."""
    root, _ = consumed(t)
    return t.spark.read.parquet(f"{root}/articles").agg(F.count("*").alias("n"))


@query("l1_custom_request_factory", "docs", """
SELECT article_id, 'N-' || lpad((doc_id % 25)::VARCHAR, 2, '0') AS state_code, CAST(0.75 AS DECIMAL(5,4)) AS relevance_score FROM docs""")
def l1(t: Tables) -> DataFrame:
    """A caller's own DataFrame step adds the scores of each article."""

    def tag_states(articles: DataFrame) -> DataFrame:
        code = F.expr("concat('N-', lpad(cast(doc_id % 25 as string), 2, '0'))")
        return articles.withColumns({
            "state_scores": F.create_map(code, F.lit("0.75").cast("decimal(5,4)")), "primary_state_code": code,
            "state_detection_method": F.lit("custom"),
        })

    return conform.state_links(t.docs.transform(tag_states)).select("article_id", "state_code", "relevance_score")


@query("l2_custom_message_factory", "docs", """
SELECT article_id, '{"schema_version":"1.0","provider":"Custom","article":"' || article_id || '"}' AS body FROM docs""")
def l2(t: Tables) -> DataFrame:
    def custom(articles: DataFrame) -> DataFrame:
        body = F.to_json(F.struct(F.lit("1.0").alias("schema_version"), F.lit("Custom").alias("provider"), F.col("article_id").alias("article")))
        return articles.select("article_id", body.alias("body"))

    return t.docs.transform(custom)


@query("l3_custom_provider", "docs", """
SELECT lang AS provider, count(*) AS records FROM (SELECT CASE language_code WHEN 'en' THEN 'english wire' ELSE 'world wire' END AS lang FROM docs) GROUP BY ALL""")
def l3(t: Tables) -> DataFrame:
    """Two providers registered by the caller, each with its own mapper."""
    raw = t.docs.withColumn("provider", F.when(F.col("language_code") == "en", "English Wire").otherwise("World Wire"))
    mappers = registry.ProviderMappers()
    mappers.register("English Wire", lambda df: df.select(F.lower("provider").alias("provider"), "article_id"))
    mappers.register("world wire", lambda df: df.select(F.lower("provider").alias("provider"), "article_id", "language_code"))
    return mappers.route(raw).groupBy("provider").agg(F.count("*").alias("records"))
