"""Producer and consumer over several micro-batches, and lineage of tables."""

import json
import os

from pyspark.sql import functions as F

from broadsheet import fixed
from broadsheet.functions import codes
from broadsheet.operators import mutations
from broadsheet.session import shared_root
from broadsheet.sources import registry
from broadsheet.streaming import queue

STATES = "code string"


def articles(spark, n):
    """Mapped records of one payload with everything an article carries."""
    rows = [
        (f"p{i // 5}", i % 5, f"Title {i}", f"Body of {i}", f"Writer {i % 3}", f"https://press.test/{i}", f"Paper {i % 4}", "RSS", f"https://paper{i % 4}.test/", "FR", ["One", "one", "Two"])
        for i in range(n)
    ]
    df = spark.createDataFrame(
        rows, "payload_id string, pos int, title string, content string, author string, url string, source_name string, source_type string, "
        "source_homepage_url string, source_country_code string, keywords array<string>",
    )
    return df.withColumns({
        "provider": F.lit("Wire"), "source_id": F.lit("s"), "query": F.lit(""), "body": F.lit("{}"), "language_code": F.lit("fr"),
        "collected_at": F.lit("2026-04-15 09:00:00").cast("timestamp"), "published_at": F.lit("2026-04-14 09:00:00").cast("timestamp"),
        "primary_category": F.lit("General"), "reject_reason": F.lit(None).cast("string"), "reject_source_id": F.lit(None).cast("string"),
        "record_json": F.lit("{}"), "content_hash": F.sha2("content", 256), "canonical_url": F.lit(None).cast("string"),
    })


def scratch(spark):
    folder = f"{shared_root(spark)}/broadsheet"
    return {d for d in os.listdir(folder) if d.startswith("run-")} if os.path.isdir(folder) else set()


def test_whole_articles_over_many_batches(spark, tmp_path):
    root = str(tmp_path)
    mapped = articles(spark, 20).repartition(6)
    raw = mapped.select("payload_id", "provider", "source_id", "query", "collected_at", "body").distinct()
    status = queue.dispatch(raw, mapped, root)
    assert {r["status"]: r["count"] for r in status.groupBy("status").count().collect()} == {"queued": 20}
    states, countries = spark.createDataFrame([("N-01",)], STATES), codes.country_catalog(spark)
    queue.prepare_lake(spark, root)
    before = scratch(spark)
    for _ in range(2):  # the second queue run finds nothing new
        queue.consume(spark, f"{root}/queue", root, states, countries, files_per_batch=2)
    stored = queue.stored_table(spark, root, "articles")
    assert stored.select("ingest_batch").distinct().count() > 2
    assert stored.count() == 20 and stored.filter("content is null or author is null or content_hash is null or size(keywords) <> 2").count() == 0
    assert queue.stored_table(spark, root, "news_sources").select("id").count() == 4
    assert spark.read.parquet(f"{root}/processed").count() == 20
    assert queue.stored_table(spark, root, "article_countries").count() == 20
    assert scratch(spark) == before
    # A new checkpoint delivers everything again under another name: duplicates, and nothing overwritten.
    queue.consume(spark, f"{root}/queue", root, states, countries, checkpoint=f"{root}/_again")
    done = {r["status"]: r["count"] for r in queue.outcomes(spark, root).groupBy("status").count().collect()}
    assert done == {"stored": 20, "duplicate": 20} and queue.stored_table(spark, root, "articles").count() == 20


def test_failed_publish_is_counted(spark, tmp_path):
    mapped = articles(spark, 10).withColumn("reject_reason", F.expr("case when pos = 1 then 'bad' when pos = 2 then ' ' end"))
    raw = mapped.select("payload_id", "provider", "source_id", "query", "collected_at", "body").distinct()

    def factory(df):
        return queue.default_message(df).withColumn("body", F.when(~F.col("body").contains("Title 3"), F.col("body")))

    status = queue.dispatch(raw, mapped, str(tmp_path), factory)
    got = {r["status"]: r["count"] for r in status.groupBy("status").count().collect()}
    assert got == {"queued": 5, "publish_failed": 1, "rejected": 2, "reject_failed": 2}


def test_rerun_of_a_producer_writes_nothing_twice(spark, tmp_path):
    """Two records of one article fail or pass apart; a record may give several messages; failed ones are tried again."""
    root = str(tmp_path)
    mapped = articles(spark, 6).withColumn("url", F.expr("if(pos in (1, 2), 'https://press.test/twin', url)")).withColumn("source_name", F.expr("if(pos in (1, 2), 'Paper', source_name)")).withColumn("reject_reason", F.expr("if(pos = 0, 'bad', null)"))
    raw = mapped.select("payload_id", "provider", "source_id", "query", "collected_at", "body").distinct()

    def factory(df):
        made = queue.default_message(df)
        body = F.when((F.col("payload_id") == last["payload_id"]) & (F.col("pos") == last["pos"]), None).otherwise(F.col("body"))
        return made.withColumn("body", body).withColumn("copy", F.explode(F.expr("if(pos = 3, array(1, 2), array(1))"))).drop("copy")

    last = mapped.filter("reject_reason IS NULL").orderBy("pos", "payload_id").select("payload_id", "pos").first()
    n = mapped.count()
    rejected, twice = mapped.filter("pos = 0").count(), mapped.filter("pos = 3").count()
    for _ in range(2):
        status = {r["status"]: r["count"] for r in queue.dispatch(raw, mapped, root, factory).groupBy("status").count().collect()}
        assert status == {"queued": n - rejected - 1, "publish_failed": 1, "rejected": rejected}
        assert spark.read.text(f"{root}/queue").count() == n - rejected - 1 + twice
    status = queue.dispatch(raw, mapped, root)
    assert {r["status"]: r["count"] for r in status.groupBy("status").count().collect()} == {"queued": n - rejected, "rejected": rejected}
    assert spark.read.text(f"{root}/queue").count() == n - rejected + twice
    stored = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/{fixed.LAYER_PREFIXES['raw']}")
    assert stored.count() == raw.count()
    assert spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/{fixed.LAYER_PREFIXES['rejected']}").count() == rejected


def test_requests_get_one_response_each(spark, tmp_path):
    mapped = articles(spark, 8)
    pool = mapped.select("payload_id", "provider").distinct().orderBy("payload_id").limit(2).collect()
    requests = spark.createDataFrame([(r["payload_id"], r["provider"], None) for r in pool] + [("x", pool[0]["provider"], None), ("y", "Elsewhere", None), ("z", pool[0]["provider"], "timespan_invalid")],
                                     "request_id string, provider string, request_error string")
    fetched = mapped.select(F.col("payload_id").alias("request_id"), "source_id", "query", "collected_at", "body").distinct()
    mappers = registry.ProviderMappers()
    mappers.register(pool[0]["provider"], lambda raw: mapped.join(raw.select("payload_id"), "payload_id", "left_semi"))
    for _ in range(2):
        got = {r["request_id"]: (r["status"], r["reason"], r["queued_count"]) for r in queue.run_requests(requests, fetched, mappers, str(tmp_path)).collect()}
        counts = {r["payload_id"]: r["count"] for r in mapped.groupBy("payload_id").count().collect()}
        assert got == {
            **{r["payload_id"]: ("completed", None, counts[r["payload_id"]]) for r in pool},
            "x": ("failed", "no_payload", 0), "y": ("failed", "provider_unknown", 0), "z": ("failed", "timespan_invalid", 0),
        }


def test_arrival_is_reading_order(spark):
    made = queue.default_message(articles(spark, 5).withColumns({"raw_s3_uri": F.lit("s3://b/k"), "article_id": F.col("url")}))
    created = {r["article_id"]: json.loads(r["body"])["created_at"] for r in made.collect()}
    assert [created[f"https://press.test/{i}"] for i in range(5)] == [f"2026-04-15T09:00:00.00000{i}Z" for i in range(5)]


def test_deduplicate_loses_nothing(spark, tmp_path):
    root, lines = str(tmp_path), lambda *m: spark.createDataFrame([(x,) for x in m], "value string").coalesce(1)
    message = lambda i, at: json.dumps({"message_id": i, "created_at": at})
    batches = [
        [message("a", "2026-04-15T09:00:00Z"), "{broken", message("b", None)],
        [message("a", "2026-04-15T09:00:00Z"), message("late", "2020-01-01T00:00:00Z"), "{other"],
        [message("late", "2020-01-01T00:00:00Z"), "{broken", message("b", None), message("new", "2026-05-01T00:00:00Z")],
    ]
    for messages in batches:
        lines(*messages).write.mode("append").text(f"{root}/queue")
        queue.deduplicate(spark, f"{root}/queue", root)
    got = [r["message_id"] or r["body"] for r in queue.distinct_messages(spark, root).collect()]
    assert sorted(got) == sorted(["a", "b", "late", "new", "{broken", "{other"])


def test_emptied_partitions_go(spark, tmp_path):
    path, keys = f"{tmp_path}/t", ["state", "day"]
    rows = spark.createDataFrame([("A b/c", "1", 1), ("A b/c", "2", 2), ("B", "1", 3)], "state string, day string, v int")
    rows.write.partitionBy(*keys).parquet(path)
    touched = spark.createDataFrame([("A b/c", "1"), ("B", "1")], "state string, day string")
    fresh = spark.createDataFrame([("B", "1", 9)], "state string, day string, v int")
    mutations.replace_partitions(path, touched, fresh, keys)
    assert sorted(tuple(r) for r in spark.read.schema(rows.schema).parquet(path).select("state", "day", "v").collect()) == [("A b/c", "2", 2), ("B", "1", 9)]
