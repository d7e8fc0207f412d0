"""Producer and consumer of article messages as Structured Streaming jobs.

Queue files may be compressed (one task reads a whole file then, so they should stay small).
Delivery is at least once. The consumer is idempotent: every micro-batch writes its own
``ingest_source`` and ``ingest_batch`` partition of each table and overwrites it when replayed, and duplicates are
decided against all other batches, so a redelivered message changes nothing. ``ingest_source`` names
the queue and the checkpoint, so a second queue or a new checkpoint never overwrites earlier data.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet import fixed
from broadsheet.functions import text
from broadsheet.operators import conform, lake, metrics
from broadsheet.schemas import ARTICLE_FIELDS, TABLES
from broadsheet.session import LEAN_CONF, cut, scratch_path, scratch_run, session_conf
from broadsheet.sources import messages, registry

MessageFactory = Callable[[DataFrame], DataFrame]
PARTS = "ingest_source string, ingest_batch bigint"
OUTCOMES = "message_id string, status string, reason string, retry_count int, body string"
RETRIES = f"{OUTCOMES}, next_retry int, route string"
#: Tables of the consumer and their full schemas.
STORE = {
    **{name: TABLES[name] for name in ("articles", "news_sources", "article_countries", "article_states", "article_labels")},
    "outcomes": OUTCOMES, "retries": RETRIES,
}


#: What names a record of a payload, and the outcomes of earlier runs that stand.
RECORD = ["provider", "payload_id", "pos"]
LEDGER = "kind string, provider string, payload_id string, pos int, status string"
#: Wide rows that are joined with their decisions at once; what the joins of a batch shuffle is bounded by it.
JOINED_ROWS = 4_000_000
#: Bytes of queue files a parsing task reads: messages are costly to parse, and compressed ones are many in few bytes.
QUEUE_TASK = {"spark.sql.files.maxPartitionBytes": "16m"}


def _iso(c: str) -> Column:
    return F.date_format(F.col(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def default_message(articles: DataFrame) -> DataFrame:
    """Article columns plus provider and raw_s3_uri to (article_id, message_id, body): one message each.

    The payload is the whole article: every field of the contract that ``articles`` carries. ``created_at`` is the time of
    collection plus one microsecond per position in the payload, so arrival order is reading order.
    """
    have = set(articles.columns)
    source = {"source_name": "name", "source_type": "source_type", "source_homepage_url": "homepage_url", "source_country_code": "country_code", "source_credibility": "credibility_score"}
    fields = []
    for name in ARTICLE_FIELDS:
        if name == "source_name":
            fields.append(F.struct(*[F.col(c).alias(n) for c, n in source.items() if c in have]).alias("source"))
        elif name in have and name not in source:
            fields.append(_iso(name).alias(name) if ARTICLE_FIELDS[name] == "timestamp" else F.col(name))
    message_id = F.regexp_replace(
        F.md5(F.concat_ws("|", "raw_s3_uri", "article_id")), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"
    )
    created = []
    if "collected_at" in have:
        ordinal = F.coalesce(F.col("pos"), F.lit(0)) if "pos" in have else F.lit(0)
        at = F.timestamp_micros(F.unix_micros("collected_at") + ordinal)
        created.append(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("created_at"))
    body = F.to_json(F.struct(
        F.lit(fixed.MESSAGE_SCHEMA_VERSION).alias("schema_version"), message_id.alias("message_id"), *created,
        F.lit(fixed.ARTICLE_MESSAGE_TYPE).alias("message_type"), "provider", "raw_s3_uri",
        F.struct(*fields).alias("article_payload"),
        conform.default_country_scores(F.col("source_country_code")).alias("country_scores"),
    ))
    return articles.select(*[c for c in RECORD if c in have], "article_id", message_id.alias("message_id"), body.alias("body"))


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """Payloads landed and records settled by the producer's runs under ``root``; one folder per run."""
    spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(f"{root}/dispatch_ledger/run=-1")
    return spark.read.schema(f"{LEDGER}, run bigint").parquet(f"{root}/dispatch_ledger")


def dispatch(
    raw: DataFrame, mapped: DataFrame, root: str, factory: MessageFactory = default_message, bucket: str = "news-lake"
) -> DataFrame:
    """Producer: land raw payloads first, then one message per valid article, then the rejects.

    ``factory`` passes the RECORD columns on, so each record has a status of its own, also where two are the same article: queued
    when the factory gave it a body (one or more), ``publish_failed`` when it gave none, ``reject_failed`` when a reject
    has no reason to store, else rejected. Returns one row per record with its status for the run counters.

    Only records of payloads that the raw layer holds are read. A ledger keeps what is done: a rerun lands no payload again and
    publishes and stores no settled record again; failed ones are tried again. A run that dies before its entries are written
    repeats them, which the consumer's message ids absorb.
    """
    spark, payload = raw.sparkSession, RECORD[:2]
    ours = cut(raw.select(*payload).distinct(), "payloads")
    done = cut(ledger(spark, root).join(ours, payload, "left_semi"), "done")
    run = 1 + (ledger(spark, root).agg(F.max("run")).first()[0] or 0)
    columns = [f.split()[0] for f in LEDGER.split(", ")]

    def note(rows: DataFrame, kind: str) -> None:
        rows.withColumn("kind", F.lit(kind)).select(*columns).write.mode("append").parquet(f"{root}/dispatch_ledger/run={run}")

    landed = done.filter("kind = 'payload'").select(*payload)
    fresh = cut(raw.join(landed, payload, "left_anti").select(*raw.columns), "raw")
    lake.write_layer(lake.raw_envelopes(fresh), root, "raw", "collected_at")
    note(fresh.select(*payload, F.lit(None).cast("int").alias("pos"), F.lit("landed").alias("status")), "payload")

    held = ledger(spark, root).filter("kind = 'payload'").select(*payload).join(ours, payload, "left_semi").distinct()
    settled = done.filter("kind = 'record' AND status IN ('queued', 'rejected')").select(*RECORD, "status")
    path = lake.object_path(
        "raw", F.col("collected_at"), F.sha2(F.concat_ws("|", "provider", "payload_id"), 256), F.col("provider")
    )
    new = mapped.join(held, payload, "left_semi").join(settled, RECORD, "left_anti").select(*mapped.columns)
    located = cut(new.withColumn("raw_s3_uri", lake.storage_uri(bucket, path)), "dispatch")
    valid = located.filter(F.col("reject_reason").isNull()).withColumn(
        "article_id", messages.article_key(F.col("source_name"), F.col("url"))
    )
    made = cut(factory(valid).filter(F.coalesce(F.col("body"), F.lit("")) != ""), "messages")
    made.select(F.col("body").alias("value")).write.mode("append").text(f"{root}/queue")
    rejected = located.filter(F.col("reject_reason").isNotNull()).select(
        "payload_id", "pos", "provider", F.coalesce("reject_source_id", "source_id").alias("source_id"),
        F.col("reject_reason").alias("reason"), F.col("collected_at").alias("rejected_at"),
        F.col("record_json").alias("payload"),
    )
    lake.write_layer(lake.rejected_envelopes(rejected), root, "rejected", "rejected_at")
    bodies = made.select(*RECORD).distinct().withColumn("_sent", F.lit(True))
    sent = valid.select(*RECORD).join(bodies, RECORD, "left").select(
        *RECORD, F.when(F.col("_sent").isNull(), "publish_failed").otherwise("queued").alias("status")
    )
    stored = F.when(text.strip(F.col("reason")) != "", "rejected").otherwise("reject_failed")
    now = cut(sent.unionByName(rejected.select(*RECORD, stored.alias("status"))), "statuses")
    note(now, "record")
    return now.unionByName(settled)


def run_requests(
    requests: DataFrame, fetched: DataFrame, mappers: registry.ProviderMappers, root: str, factory: MessageFactory = default_message
) -> DataFrame:
    """Scheduled requests to one response each; failed ones are named, not dropped.

    ``requests``: request_id (unique), provider and request_error of ``messages.parse_requests``. ``fetched``: the payload that a
    provider gave for a request, as request_id and the columns its mapper needs except provider and payload_id. Valid requests of
    registered providers are joined with their payload, which is named after the request, and go through ``dispatch``; so a rerun of
    the same requests publishes nothing twice and answers the same.
    """
    known = F.when(F.col("request_error").isNotNull(), F.col("request_error")).when(mappers.is_unknown(), "provider_unknown")
    judged = cut(requests.select("request_id", "provider", known.alias("reason")), "requests")
    wanted = judged.filter("reason IS NULL").select("request_id", "provider")
    payloads = cut(wanted.join(fetched, "request_id").withColumnRenamed("request_id", "payload_id"), "fetched")
    status = dispatch(payloads, mappers.route(payloads), root, factory)
    counts = metrics.dispatch_counters(status, ["payload_id"])
    names = [c for c in counts.columns if c != "payload_id"]
    given = payloads.select(F.col("payload_id").alias("request_id"), F.lit(True).alias("_given")).distinct()
    answered = judged.join(given, "request_id", "left").join(counts.withColumnRenamed("payload_id", "request_id"), "request_id", "left")
    reason = F.coalesce("reason", F.when(F.col("_given").isNull(), "no_payload"))
    return answered.select(
        "request_id", F.when(reason.isNull(), "completed").otherwise("failed").alias("status"), reason.alias("reason"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in names],
    )


def prepare_lake(spark: SparkSession, root: str) -> None:
    """Create the tables of the consumer, empty and with their full schemas."""
    for name, schema in STORE.items():
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{root}/{name}/ingest_source=none/ingest_batch=-1")


def stored_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the consumer over all batches, read with its declared schema."""
    return spark.read.schema(f"{STORE[name]}, {PARTS}").parquet(f"{root}/{name}")


def arrival_order() -> Column:
    """Sortable arrival key of a message: creation time, then message id."""
    micros = F.lpad(F.coalesce(F.unix_micros("created_at"), F.lit(0)).cast("string"), 20, "0")
    return F.concat(micros, F.lit("|"), F.col("message_id"))


def persist_batch(
    root: str, states: DataFrame, countries: DataFrame, source: str = "queue", joined_rows: int = JOINED_ROWS
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` step: parse, decide, and write one partition of each table.

    Processed documents come before the article rows that name them, outcomes last. Intermediates go with the batch, those of the decision
    and shuffle files before.
    """

    def persist(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = (F.col("ingest_source") != source) | (F.col("ingest_batch") < batch_id)
        parsed = messages.parse_messages(batch)
        unnamed = F.sha2("body", 256)
        with session_conf(spark, QUEUE_TASK):
            articles = cut(
                messages.parse_articles(parsed, "article_payload", countries).withColumn(
                    "message_id", F.coalesce("message_id", unnamed)
                ),
                "stream-parsed",
            )
        error = F.coalesce("message_error", "article_error")
        failed = articles.filter(error.isNotNull()).select(
            "message_id", F.lit("failed").alias("status"), error.alias("reason"), "retry_count", "body"
        )
        # Copies of one message inside a batch are one delivery: the first to arrive, by its own content. Only they are gathered whole.
        valid = articles.filter(error.isNull())
        copies = cut(valid.groupBy("message_id").agg(F.count("*").alias("n")).filter("n > 1").select("message_id"), "stream-copies")
        requests = valid.withColumn("seq", arrival_order())
        if not copies.isEmpty():
            first = valid.join(copies, "message_id", "left_semi").groupBy("message_id").agg(
                F.min_by(F.struct(*[c for c in valid.columns if c != "message_id"]), F.struct(arrival_order(), unnamed)).alias("first")
            ).select("message_id", "first.*")
            once = valid.join(copies, "message_id", "left_anti").unionByName(first)
            requests = cut(once.withColumn("seq", arrival_order()), "stream-requests")
        stored = stored_table(spark, root, "articles").filter(earlier).select("id", "url", "canonical_url", "content_hash")
        sources = stored_table(spark, root, "news_sources").filter(earlier).select("name", "source_type").distinct()

        def commit(name: str, table: DataFrame, mode: str = "overwrite") -> str:
            path = f"{root}/{name}/ingest_source={source}/ingest_batch={batch_id}"
            table.write.mode(mode).parquet(path)
            return path

        # The wide rows meet their decisions in parts, by the hash of their key.
        groups = max(1, -(-requests.count() // joined_rows))
        part = lambda df, g: df.filter(F.pmod(F.xxhash64("seq"), F.lit(groups)) == g) if groups > 1 else df
        kept = scratch_path(spark, "stream-results")
        with scratch_run(spark):  # the rounds of the decision go once it is written
            results, accepted = conform.decide(requests, states, stored)
            results.write.parquet(kept)
            judged = spark.read.schema(results.schema).parquet(kept)
            # The wide rows are joined with their decisions once; every other table reads the columns it needs from the documents written.
            for g in range(groups):
                documents = part(accepted, g).drop("ingest_batch", "ingest_source")
                processed = commit("processed", documents, "append" if g else "overwrite")
        written = spark.read.schema(documents.schema).parquet(processed)
        made = conform.build(judged, written, sources)
        reason = F.coalesce("failure_reason", "duplicate_reason").alias("reason")
        verdicts = made.results.select("seq", "status", reason)
        carried = requests.select("seq", "message_id", "retry_count", "body")
        lost = cut(verdicts.filter(F.col("status") == "failed"), "stream-lost")
        columns = ["message_id", "status", "reason", "retry_count", "body"]
        commit("news_sources", made.sources)
        commit("articles", made.articles)
        commit("article_countries", made.countries)
        commit("article_states", made.states)
        commit("article_labels", made.labels)
        commit("retries", retry_split(failed if lost.isEmpty() else failed.unionByName(carried.join(lost, "seq").select(*columns))))
        for g in range(groups):
            outcomes = part(carried, g).join(part(verdicts, g).hint("shuffle_hash"), "seq").select(*columns)
            commit("outcomes", outcomes if g else failed.unionByName(outcomes), "append" if g else "overwrite")

    def run(batch: DataFrame, batch_id: int) -> None:
        with session_conf(batch.sparkSession, LEAN_CONF), scratch_run(batch.sparkSession):
            persist(batch, batch_id)

    return run


def _run_queue(spark: SparkSession, queue: str, checkpoint: str, step, files_per_batch: int | None) -> None:
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    source = reader.load(queue).withColumnRenamed("value", "body")
    job = source.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    job.awaitTermination()


def _source_name(queue: str, checkpoint: str) -> str:
    return hashlib.sha256(f"{queue}|{checkpoint}".encode()).hexdigest()[:16]


def consume(
    spark: SparkSession, queue: str, root: str, states: DataFrame, countries: DataFrame, files_per_batch: int | None = None,
    checkpoint: str | None = None,
) -> None:
    """Process everything waiting in ``queue`` (text files, one message per line) and stop."""
    checkpoint = checkpoint or f"{root}/_checkpoint"
    _run_queue(spark, queue, checkpoint, persist_batch(root, states, countries, _source_name(queue, checkpoint)), files_per_batch)


def outcomes(spark: SparkSession, root: str) -> DataFrame:
    return stored_table(spark, root, "outcomes")


def routed(spark: SparkSession, root: str) -> DataFrame:
    """Failed deliveries with their route: another attempt, or the dead letters."""
    return stored_table(spark, root, "retries")


def retry_split(failed: DataFrame) -> DataFrame:
    """Failed messages with their next attempt, or the dead letters beyond the retry budget."""
    attempt = F.coalesce(F.col("retry_count"), F.lit(0)) + 1
    return failed.withColumn("next_retry", attempt).withColumn(
        "route", F.when(attempt <= fixed.MAX_RETRY_COUNT, "retry").otherwise("dead_letter")
    )


DISTINCT = "message_key string, message_id string, created_at timestamp, body string"


def deduplicate(spark: SparkSession, queue: str, root: str, files_per_batch: int | None = None, checkpoint: str | None = None) -> None:
    """One row per message id into ``root``/distinct, and per body where there is no id; nothing is lost.

    Repeats are decided against what earlier batches wrote, not against a watermark, so late, undated and
    broken messages all pass once. Of copies with one id the first by creation time, then by body, stays.
    Decisions look at keys only: a batch without news is read no further, and whole messages are gathered only where it holds copies, or some of its
    keys but not all were seen. Every batch reads the keys of those before it, so a long queue should be in large files.
    """
    checkpoint = checkpoint or f"{root}/_distinct_checkpoint"
    source = _source_name(queue, checkpoint)

    def decide(batch: DataFrame, batch_id: int) -> None:
        parsed = batch.select(
            F.get_json_object("body", "$.message_id").alias("message_id"),
            F.get_json_object("body", "$.created_at").try_cast("timestamp").alias("created_at"), "body",
        ).select(F.coalesce("message_id", F.sha2("body", 256)).alias("message_key"), "message_id", "created_at", "body")
        keys = cut(parsed.groupBy("message_key").agg(F.count("*").alias("n")), "distinct-keys")
        earlier = distinct_messages(batch.sparkSession, root).filter((F.col("ingest_source") != source) | (F.col("ingest_batch") < batch_id))
        seen = cut(earlier.select("message_key").join(keys.hint("shuffle_hash"), "message_key", "left_semi").distinct(), "distinct-seen")
        repeats, rest = seen.count(), keys.filter("n > 1").select("message_key")
        if repeats == keys.count():
            fresh = parsed.limit(0)
        else:
            fresh = parsed.join(seen, "message_key", "left_anti") if repeats else parsed
            copies = cut(rest.join(seen, "message_key", "left_anti") if repeats else rest, "distinct-copies")
            if not copies.isEmpty():
                order = F.struct(F.coalesce(F.unix_micros("created_at"), F.lit(0)), "body")
                first = fresh.join(copies, "message_key", "left_semi").groupBy("message_key").agg(
                    F.min_by(F.struct("message_id", "created_at", "body"), order).alias("m")
                ).select("message_key", "m.*")
                fresh = fresh.join(copies, "message_key", "left_anti").unionByName(first)
        fresh.write.mode("overwrite").parquet(f"{root}/distinct/ingest_source={source}/ingest_batch={batch_id}")

    def run(batch: DataFrame, batch_id: int) -> None:
        with session_conf(batch.sparkSession, LEAN_CONF), scratch_run(batch.sparkSession):
            decide(batch, batch_id)

    empty = spark.createDataFrame([], DISTINCT)
    empty.write.mode("overwrite").parquet(f"{root}/distinct/ingest_source=none/ingest_batch=-1")
    _run_queue(spark, queue, checkpoint, run, files_per_batch)


def distinct_messages(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(f"{DISTINCT}, {PARTS}").parquet(f"{root}/distinct")
