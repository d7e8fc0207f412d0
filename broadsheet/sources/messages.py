"""Queue messages, queue batch events and ingestion requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet import fixed
from broadsheet.functions import codes, text, times, urls
from broadsheet.functions.expr import fence
from broadsheet.schemas import ARTICLE_JSON, MESSAGE_JSON, QUEUE_EVENT_JSON, REQUEST_JSON


def _names(ddl: str) -> list[str]:
    depth, names, word = 0, [], ""
    for ch in ddl + ",":
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            names.append(word.strip().split(" ")[0])
            word = ""
        else:
            word += ch
    return names


def unknown_fields(json_text: Column, allowed: list[str]) -> Column:
    """Whether a JSON object has a key outside the contract."""
    return _has_other(F.json_object_keys(json_text), allowed)


def _has_other(items: Column, allowed: list[str]) -> Column:
    """Whether an array holds anything but ``allowed``; a null element is something else, a null array holds nothing."""
    return F.coalesce(F.exists(items, lambda i: F.coalesce(~i.isin(*allowed), F.lit(True))), F.lit(False))


def _is_object(json_text: Column) -> Column:
    return F.coalesce(F.startswith(F.ltrim(json_text), F.lit("{")), F.lit(False))


def _length_error(c: Column, name: str, low: int, high: int, required: bool = True) -> Column:
    size = F.length(text.strip(c))
    bad = F.coalesce((size < low) | (size > high), F.lit(required))
    return F.when(bad, f"{name}_invalid")


def _whole_number(c: Column, default: int) -> Column:
    return F.coalesce(F.when(c.isNull(), F.lit(default)), F.when(c.rlike(r"^\s*[+-]?\d+(\.0+)?\s*$"), c.try_cast("double")).cast("int"))


def _envelope_errors(m: Column, expected_type: str) -> list[Column]:
    return [
        _length_error(m["schema_version"], "schema_version", 1, 20, required=False),
        F.when(m["message_id"].isNotNull() & ~m["message_id"].rlike(fixed.UUID_PATTERN), "message_id_invalid"),
        F.when(m["created_at"].isNotNull() & times.iso_time(m["created_at"]).isNull(), "created_at_invalid"),
        F.when(F.coalesce(m["message_type"], F.lit(expected_type)) != expected_type, "message_type_invalid"),
    ]


def parse_messages(df: DataFrame, body: str = "body") -> DataFrame:
    """Article messages: typed columns and ``message_error`` (null when the contract holds)."""
    parsed = df.withColumn("_valid", F.expr(f"try_parse_json({body})").isNotNull()).withColumn(
        "_m", F.from_json(body, MESSAGE_JSON)
    )
    m = F.col("_m")
    coded = parsed.select("*", text.code(m["primary_state_code"]).alias("primary_state_code"), _whole_number(m["retry_count"], 0).alias("retry_count"))
    scored = codes.with_scores(coded, {n: F.from_json(m[n], "map<string,string>") for n in ("country_scores", "state_scores")})
    state_codes = F.map_keys("state_scores")
    no_codes = F.array().cast("array<string>")
    error = F.coalesce(
        F.when(~F.col("_valid"), "invalid_json"),
        F.when(~_is_object(F.col(body)), "not_an_object"),
        F.when(unknown_fields(F.col(body), _names(MESSAGE_JSON)), "unknown_field"),
        *_envelope_errors(m, fixed.ARTICLE_MESSAGE_TYPE),
        _length_error(m["provider"], "provider", 1, 100),
        F.when(~urls.is_storage_uri(m["raw_s3_uri"]), "raw_uri_invalid"),
        _length_error(m["raw_s3_uri"], "raw_uri", 6, 2048),
        F.when(~_is_object(m["article_payload"]), "article_payload_not_object"),
        F.when(m["country_scores"].isNotNull() & ~_is_object(m["country_scores"]), "country_scores_not_object"),
        F.col("_country_scores_error"),
        F.when(m["state_scores"].isNotNull() & ~_is_object(m["state_scores"]), "state_scores_not_object"),
        F.col("_state_scores_error"),
        F.when(F.length("primary_state_code") > 20, "primary_state_invalid"),
        F.when(
            F.col("primary_state_code").isNotNull()
            & ~F.array_contains(F.coalesce(state_codes, no_codes), F.col("primary_state_code")),
            "primary_state_missing",
        ),
        _length_error(m["state_detection_method"], "state_detection_method", 0, 100, required=False),
        F.when(~F.coalesce(F.col("retry_count").between(0, fixed.MAX_RETRY_COUNT), F.lit(False)), "retry_count_invalid"),
    )
    return fence(scored.select(
        *df.columns,
        F.coalesce(text.strip(m["schema_version"]), F.lit(fixed.MESSAGE_SCHEMA_VERSION)).alias("schema_version"),
        m["message_id"].alias("message_id"),
        times.iso_time(m["created_at"]).alias("created_at"),
        text.strip(m["provider"]).alias("provider"),
        text.strip(m["raw_s3_uri"]).alias("raw_s3_uri"),
        m["article_payload"].alias("article_payload"),
        "country_scores", "state_scores",
        "primary_state_code",
        text.strip(m["state_detection_method"]).alias("state_detection_method"),
        "retry_count",
        error.alias("message_error"),
    ))


def article_errors(iso: list[str]) -> Column:
    """First broken rule of the article contract over the flat columns and raw texts; ``iso`` lists the country codes."""
    a = F.col("_a")
    url_rule = lambda raw, ok, name: F.when(raw.isNotNull() & ok.isNull(), f"{name}_invalid")
    one_of = lambda c, allowed: F.coalesce(c.isin(*allowed), F.lit(True))
    return F.coalesce(
        F.when(a.isNull() | F.col("_a_extra"), "unknown_field"),
        _length_error(a["title"], "title", 1, fixed.TITLE_LENGTH),
        _length_error(a["description"], "description", 0, fixed.DESCRIPTION_LENGTH, required=False),
        F.when(F.col("url").isNull(), "url_invalid"),
        url_rule(a["canonical_url"], F.col("canonical_url"), "canonical_url"),
        url_rule(a["image_url"], F.col("image_url"), "image_url"),
        _length_error(a["source"]["name"], "source_name", 1, fixed.SOURCE_NAME_LENGTH),
        F.when(~F.coalesce(a["source"]["source_type"].isin(*fixed.SOURCE_TYPES), F.lit(False)), "source_type_invalid"),
        url_rule(a["source"]["homepage_url"], F.col("source_homepage_url"), "homepage_url"),
        F.when(F.col("source_country_code").isNotNull() & ~F.col("source_country_code").isin(*iso), "source_country_invalid"),
        F.when(
            a["source"]["credibility_score"].isNotNull()
            & ~F.coalesce(codes.to_decimal(a["source"]["credibility_score"]).between(0, 100), F.lit(False)),
            "credibility_invalid",
        ),
        _length_error(a["author"], "author", 0, fixed.AUTHOR_LENGTH, required=False),
        F.when(F.col("published_at").isNull(), "published_at_invalid"),
        F.when(a["collected_at"].isNotNull() & F.col("collected_at").isNull(), "collected_at_invalid"),
        F.when(~one_of(a["primary_category"], fixed.CATEGORIES), "category_invalid"),
        F.when(~one_of(a["sentiment"], fixed.SENTIMENTS), "sentiment_invalid"),
        F.when(_has_other(F.col("labels"), list(fixed.LABELS)), "label_invalid"),
        F.when(_has_other(F.col("country_codes"), iso), "country_code_invalid"),
        F.when(~F.coalesce(F.length(a["language_code"]).between(2, 10), F.lit(True)), "language_invalid"),
        F.when(~F.coalesce(a["content_hash"].rlike(fixed.HASH_PATTERN), F.lit(True)), "content_hash_invalid"),
    )


def parse_articles(df: DataFrame, payload: str, iso: DataFrame) -> DataFrame:
    """Article documents to the flat article columns and ``article_error``.

    ``iso`` is the country catalogue; its few hundred codes are read once and stand in the rules, no row carries them.
    """
    iso_list = sorted({row[0] for row in iso.select("country_code").collect()} - {None})
    a = F.col("_a")
    none, payload_text = F.array().cast("array<string>"), F.col(payload)
    sub_extra = lambda path, allowed: unknown_fields(F.get_json_object(payload, path), allowed)
    shaped = (
        df.withColumn("_a", F.from_json(payload, ARTICLE_JSON))
        .withColumn(
            "_a_extra",
            unknown_fields(F.col(payload), _names(ARTICLE_JSON))
            | sub_extra("$.source", ["name", "source_type", "homepage_url", "country_code", "credibility_score"])
            | (
                # A text that neither names a card nor escapes anything has none to look for.
                (F.contains(payload_text, F.lit("social_card")) | F.contains(payload_text, F.lit("\\")))
                & sub_extra("$.social_card", ["headline", "summary", "background_image_url", "template_name",
                                              "generated_image_path", "is_generated"])
            ),
        )
    )
    shaped = urls.with_normal_urls(shaped, {
        "url": a["url"], "canonical_url": a["canonical_url"], "image_url": a["image_url"], "source_homepage_url": a["source"]["homepage_url"],
    })
    stripped = lambda name: text.strip(a[name]).alias(name)
    card = a["social_card"]
    flat = shaped.select(
        "*",
        stripped("title"), stripped("description"), stripped("content"), stripped("summary"), stripped("author"),
        stripped("share_caption"), stripped("content_hash"),
        text.strip(a["source"]["name"]).alias("source_name"),
        a["source"]["source_type"].alias("source_type"),
        text.code(a["source"]["country_code"]).alias("source_country_code"),
        codes.to_decimal(a["source"]["credibility_score"]).try_cast("decimal(5,2)").alias("source_credibility"),
        times.iso_time(a["published_at"]).alias("published_at"),
        times.iso_time(F.coalesce(a["collected_at"], a["published_at"])).alias("collected_at"),
        F.coalesce(a["primary_category"], F.lit(fixed.DEFAULT_CATEGORY)).alias("primary_category"),
        F.array_distinct(F.coalesce(a["labels"], none)).alias("labels"),
        F.coalesce(a["sentiment"], F.lit(fixed.DEFAULT_SENTIMENT)).alias("sentiment"),
        text.code_list(F.coalesce(a["country_codes"], none)).alias("country_codes"),
        text.keyword_list(F.coalesce(a["keywords"], none)).alias("keywords"),
        F.coalesce(text.strip(a["language_code"]), F.lit(fixed.DEFAULT_LANGUAGE)).alias("language_code"),
        F.coalesce(a["ai_processed"], F.lit(False)).alias("ai_processed"),
        F.when(
            card.isNotNull(),
            F.struct(
                card["headline"].alias("headline"), card["summary"].alias("summary"),
                card["background_image_url"].alias("background_image_url"),
                F.coalesce(card["template_name"], F.lit(fixed.DEFAULT_CARD_TEMPLATE)).alias("template_name"),
                card["generated_image_path"].alias("generated_image_path"),
                F.coalesce(card["is_generated"], F.lit(False)).alias("is_generated"),
            ),
        ).alias("social_card"),
    )
    identified = flat.withColumn(
        "article_id", F.coalesce(a["article_id"], article_key(F.col("source_name"), F.col("url")))
    )
    return fence(identified.withColumn("article_error", article_errors(iso_list)).drop("_a", "_a_extra"))


def article_key(provider: Column, url: Column) -> Column:
    """Deterministic article id, so that reruns give the same rows."""
    return F.sha2(F.concat_ws("|", provider, url), 256)


def parse_events(events: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """Queue batch events to (records, event errors).

    One record without a usable id refuses its whole event before anything is processed; a
    body that is not text only fails its own record.
    """
    parsed = events.withColumn("_records", F.from_json(body, QUEUE_EVENT_JSON)["Records"])
    record_id = lambda r: F.get_json_object(r, "$.messageId")
    id_is_text = lambda r: F.coalesce(r.rlike(r'"messageId"\s*:\s*"'), F.lit(False))
    error = (
        F.when(F.col("_records").isNull(), "records_not_a_list")
        .when(F.exists("_records", lambda r: r.isNull() | ~_is_object(r)), "record_not_an_object")
        .when(F.exists("_records", lambda r: record_id(r).isNull() | ~id_is_text(r)), "message_id_missing")
        .when(F.exists("_records", lambda r: text.strip(record_id(r)) == ""), "message_id_empty")
    )
    checked = fence(parsed.withColumn("event_error", error))
    keep = [c for c in events.columns if c != body]
    records = checked.filter(F.col("event_error").isNull()).select(
        *keep, F.posexplode("_records").alias("pos", "_record")
    )
    body_type = F.schema_of_variant(F.expr("try_variant_get(try_parse_json(_record), '$.body', 'variant')"))
    records = records.select(
        *keep, "pos",
        text.strip(record_id(F.col("_record"))).alias("item_id"),
        F.when(body_type == "STRING", F.get_json_object("_record", "$.body")).alias("body"),
    )
    return records, checked.filter(F.col("event_error").isNotNull()).select(*keep, "event_error")


def parse_requests(df: DataFrame, body: str = "body") -> DataFrame:
    """Scheduled ingestion requests: typed columns and ``request_error``."""
    parsed = df.withColumn("_valid", F.expr(f"try_parse_json({body})").isNotNull()).withColumn(
        "_r", F.from_json(body, REQUEST_JSON)
    )
    r = F.col("_r")
    extra = F.from_json(r["extra_partitions"], "map<string,string>")
    shaped = parsed.select(
        "*",
        text.strip(r["provider"]).alias("provider"),
        text.strip(r["query"]).alias("query"),
        _whole_number(r["max_records"], fixed.DEFAULT_MAX_RECORDS).alias("max_records"),
        times.normalize_timespan(F.coalesce(r["timespan"], F.lit("24h"))).alias("timespan"),
        text.strip(r["source_id"]).alias("source_id"),
        F.coalesce(extra, F.create_map().cast("map<string,string>")).alias("extra_partitions"),
    )
    error = F.coalesce(
        F.when(~F.col("_valid"), "invalid_json"),
        F.when(~_is_object(F.col(body)), "not_an_object"),
        F.when(unknown_fields(F.col(body), _names(REQUEST_JSON)), "unknown_field"),
        *_envelope_errors(r, fixed.TRIGGER_MESSAGE_TYPE),
        *request_rules("scheduled"),
        _length_error(F.col("source_id"), "source_id", 0, 200, required=False),
    )
    return fence(shaped.withColumn("request_error", error).drop("_valid", "_r"))


# Fixed values: (shortest query, longest query, most records) per kind of request.
REQUEST_LIMITS = {"scheduled": (1, 1000, 250), "api": (3, 1000, 250), "feed": (0, 500, 200)}


def request_rules(kind: str) -> list[Column]:
    """Rule columns over provider/query/max_records/timespan for one kind of request."""
    low, high, most = REQUEST_LIMITS[kind]
    span = times.normalize_timespan(F.col("timespan"))
    rules = [] if kind != "scheduled" else [_length_error(F.col("provider"), "provider", 1, 100)]
    rules += [
        _length_error(F.col("query"), "query", low, high),
        F.when(~F.coalesce(F.col("max_records").between(1, most), F.lit(False)), "max_records_invalid"),
        F.when(~times.valid_request_timespan(F.col("timespan")), "timespan_invalid"),
    ]
    if kind == "api":
        minutes = F.regexp_extract(span, r"^(\d+)min$", 1).try_cast("bigint")
        rules.append(F.when(minutes < fixed.MIN_API_MINUTES, "timespan_too_short"))
    return rules
