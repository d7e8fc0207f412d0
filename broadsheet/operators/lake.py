"""Lake layout: envelopes, partition columns, object paths and layer writes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet import fixed
from broadsheet.functions import text, times

TIME_PARTITIONS = ["year", "month", "day", "hour"]


def check_partition_names(extra: Mapping[str, object]) -> list[str]:
    """Sorted extra partition names; reserved names are refused."""
    names = sorted(extra)
    taken = [n for n in names if n.strip().lower() in fixed.RESERVED_PARTITIONS]
    if taken:
        raise ValueError(f"reserved partition name: {taken[0]}")
    return names


def object_path(
    layer: str,
    ts: Column,
    identifier: Column,
    provider: Column | None = None,
    category: Column | None = None,
    extra: Mapping[str, Column] | None = None,
) -> Column:
    """Hive-style path of one record: prefix, provider, category, extras by name, UTC hour."""
    parts = [F.lit(fixed.LAYER_PREFIXES[layer])]
    if provider is not None:
        parts.append(F.when(F.coalesce(provider, F.lit("")) != "", F.concat(F.lit("provider="), text.slug(provider))))
    if category is not None:
        parts.append(F.when(F.coalesce(category, F.lit("")) != "", F.concat(F.lit("category="), text.slug(category))))
    for name in check_partition_names(extra or {}):
        parts.append(F.concat(text.slug(F.lit(name)), F.lit("="), text.slug(extra[name])))
    parts += [F.concat(F.lit(f"{name}="), part) for name, part in times.utc_parts(ts).items()]
    parts.append(F.concat(text.slug(identifier), F.lit(".json")))
    return F.concat_ws("/", *parts)


def storage_uri(bucket: str, path: Column) -> Column:
    return F.concat(F.lit(f"s3://{bucket}/"), path)


def article_uri(bucket: str, layer: str = "processed") -> Column:
    """Lineage URI of an article document."""
    if layer not in fixed.ARTICLE_LAYERS:
        raise ValueError("articles belong to the processed or curated layer")
    path = object_path(
        layer, F.col("published_at"), F.col("article_id"), F.col("source_name"), F.col("primary_category")
    )
    return storage_uri(bucket, path)


def canonical_json(columns: Mapping[str, Column]) -> Column:
    """Compact JSON with keys in sorted order; nulls are kept. Times go in as ``iso_text``."""
    ordered = [columns[name].alias(name) for name in sorted(columns)]
    return F.to_json(F.struct(*ordered), {"ignoreNullFields": "false"})


def raw_envelopes(raw: DataFrame) -> DataFrame:
    """Raw-layer records; needs provider, source_id, query, collected_at, body."""
    record_id = F.sha2(F.concat_ws("|", "provider", "payload_id"), 256)
    return raw.select(
        F.lit(fixed.MESSAGE_SCHEMA_VERSION).alias("schema_version"),
        F.lit(fixed.RAW_RECORD_TYPE).alias("record_type"),
        record_id.alias("record_id"), "payload_id", "provider", "source_id", "query", "collected_at",
        F.col("body").alias("payload"),
    )


def rejected_envelopes(rejected: DataFrame) -> DataFrame:
    """Rejected-layer records; rows with a blank reason are refused (see :func:`blank_reasons`)."""
    record_id = F.sha2(F.concat_ws("|", "provider", "payload_id", F.col("pos").cast("string")), 256)
    return rejected.filter(text.strip(F.col("reason")) != "").select(
        F.lit(fixed.MESSAGE_SCHEMA_VERSION).alias("schema_version"),
        F.lit(fixed.REJECTED_RECORD_TYPE).alias("record_type"),
        record_id.alias("record_id"), "provider", "source_id", text.strip(F.col("reason")).alias("reason"),
        "rejected_at", "payload",
    )


def blank_reasons(rejected: DataFrame) -> DataFrame:
    return rejected.filter(F.coalesce(text.strip(F.col("reason")), F.lit("")) == "")


def write_layer(
    df: DataFrame,
    root: str,
    layer: str,
    time_col: str,
    category_col: str | None = None,
    provider_col: str = "provider",
    extra: Mapping[str, Column] | None = None,
) -> str:
    """Append to a lake layer, partitioned by provider, category, extras and UTC hour.

    The partition columns are slugs under their own names, so the row keeps its original
    provider and category. Returns the folder of the layer.
    """
    names = check_partition_names(extra or {})
    parts: dict[str, Column] = {"p_provider": text.slug(F.col(provider_col))}
    if category_col:
        parts["p_category"] = text.slug(F.col(category_col))
    parts.update({n: text.slug((extra or {})[n]) for n in names})
    parts.update(times.utc_parts(F.col(time_col)))
    path = f"{root}/{fixed.LAYER_PREFIXES[layer]}"
    # Rebalancing gathers each partition into few files and splits a hot one over many tasks.
    rebalanced = df.withColumns(parts).hint("rebalance", *parts)
    rebalanced.write.mode("append").partitionBy(*parts).parquet(path)
    return path


def write_articles(df: DataFrame, root: str, layer: str = "processed", extra: Mapping[str, Column] | None = None) -> str:
    """Append article documents, partitioned by publisher, category and publication hour."""
    if layer not in fixed.ARTICLE_LAYERS:
        raise ValueError("articles belong to the processed or curated layer")
    return write_layer(df, root, layer, "published_at", "primary_category", "source_name", extra)
