"""Search-API payloads: one JSON text per payload, one row per element of ``articles``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet import fixed
from broadsheet.functions import codes, text, times, urls
from broadsheet.functions.expr import fence


def payload_error() -> Column:
    """Why a whole payload is unusable, null when its articles can be read."""
    articles = F.expr("try_variant_get(parsed, '$.articles', 'variant')")
    return (
        F.when(F.col("parsed").isNull(), "invalid_json")
        .when(~F.startswith(F.ltrim(F.col("body")), F.lit("{")), "top_level_not_object")
        .when(articles.isNull() | F.is_variant_null(articles), "articles_missing")
        .when(F.expr("try_variant_get(parsed, '$.articles', 'array<variant>')").isNull(), "articles_not_list")
    )


def parse_payloads(raw: DataFrame) -> DataFrame:
    """Raw payload rows with the parsed value and ``payload_error``."""
    parsed = raw.withColumn("parsed", F.expr("try_parse_json(body)"))
    return fence(parsed.withColumn("payload_error", payload_error()))


def explode_records(parsed: DataFrame) -> DataFrame:
    """One row per element of a usable payload, non-objects included, with its position."""
    usable = parsed.filter(F.col("payload_error").isNull())
    return usable.select(
        *[c for c in usable.columns if c not in ("body", "parsed", "payload_error")],
        F.posexplode(F.expr("try_variant_get(parsed, '$.articles', 'array<variant>')")).alias("pos", "record"),
    )


def payload_errors(parsed: DataFrame) -> DataFrame:
    """The payloads that fail as a whole."""
    return parsed.filter(F.col("payload_error").isNotNull()).drop("parsed")


def _leaf(name: str) -> tuple[Column, Column]:
    is_text = F.schema_of_variant(F.expr(f"try_variant_get(record, '$.{name}', 'variant')")) == "STRING"
    value = F.expr(f"try_variant_get(record, '$.{name}', 'string')")
    is_text = F.coalesce(is_text, F.lit(False))
    return is_text, F.when(is_text, text.strip(value))


def map_records(records: DataFrame, countries: DataFrame, languages: DataFrame) -> DataFrame:
    """Article columns and ``reject_reason`` for every record (first failing rule wins)."""
    required = ("url", "title", "seendate")
    optional = ("domain", "socialimage", "language", "sourcecountry")
    leaves = {name: _leaf(name) for name in required + optional}
    typed = records.select(
        "*",
        F.startswith(F.schema_of_variant("record"), F.lit("OBJECT")).alias("_is_object"),
        *[leaves[n][0].alias(f"_{n}_is_text") for n in required],
        *[leaves[n][1].alias(f"_{n}") for n in leaves],
    )
    coded = codes.with_country_code(typed, "_sourcecountry", "source_country_code", countries)
    coded = codes.with_language_code(coded, "_language", "language_code", languages)
    home = urls.homepage(F.col("_url"))
    coded = coded.withColumn("_home", home)
    coded = urls.with_normal_urls(coded, {"url": F.col("_url"), "image_url": F.col("_socialimage"), "source_homepage_url": F.col("_home")})
    shaped = coded.select(
        "*",
        F.col("_title").alias("title"),
        urls.source_domain(F.col("_domain"), F.col("_url")).alias("source_name"),
        F.col("_home").isNotNull().alias("_has_home"),
        times.api_time(F.col("_seendate")).alias("published_at"),
    )
    missing = [
        F.when(~F.col(f"_{n}_is_text"), f"{n}_not_string").when(F.col(f"_{n}") == "", f"{n}_empty")
        for n in required
    ]
    reason = F.coalesce(
        F.when(~F.col("_is_object"), "not_an_object"),
        *missing,
        F.when(F.col("source_name").isNull(), "domain_missing"),
        F.when(F.length("source_name") > fixed.SOURCE_NAME_LENGTH, "source_name_too_long"),
        F.when(F.col("_has_home") & F.col("source_homepage_url").isNull(), "homepage_url_invalid"),
        F.when(F.col("published_at").isNull(), "seendate_invalid"),
        F.when(F.col("url").isNull(), "url_invalid"),
        F.when(F.length("title") > fixed.TITLE_LENGTH, "title_too_long"),
    )
    return fence(shaped.select(
        "*",
        F.lit(fixed.API_SOURCE_TYPE).alias("source_type"),
        F.lit(fixed.DEFAULT_CATEGORY).alias("primary_category"),
        reason.alias("reject_reason"),
        F.nullif(F.col("_url"), F.lit("")).alias("reject_source_id"),
        F.to_json(F.struct(F.col("record"))).alias("record_json"),
    ).drop(*[c for c in shaped.columns if c.startswith("_")], "record"))


def newest_per_payload(mapped: DataFrame, limit_col: str = "max_records") -> DataFrame:
    """Replay of the upstream order: newest first, at most the requested number per payload.

    A limit outside the request contract is an error (``max_records_invalid``), never a silent cut.
    """
    asked = F.col(limit_col)
    limit = F.when(asked.between(1, fixed.MAX_API_RECORDS), asked).otherwise(F.raise_error(F.lit("max_records_invalid")).cast("int"))
    newest = Window.partitionBy("payload_id").orderBy(F.col("published_at").desc_nulls_last(), "pos")
    ranked = mapped.withColumn("_rank", F.row_number().over(newest))
    return ranked.filter(F.col("_rank") <= limit).drop("_rank")
