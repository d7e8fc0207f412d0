"""Feed registry, region catalogue, provider mappers, relational table scans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet import fixed
from broadsheet.functions import text
from broadsheet.schemas import TABLES


def feed_registry(spark: SparkSession) -> DataFrame:
    """The registered feeds as a small table."""
    rows = [{**fixed.FEED_DEFAULTS, **feed} for feed in fixed.FEED_REGISTRY]
    return spark.createDataFrame(
        rows,
        "source_id string, name string, feed_url string, homepage_url string, source_country_code string, "
        "default_category string, language_code string, expected_format string, is_official_source boolean, "
        "enabled boolean, max_articles_per_fetch int",
    )


def enabled_feeds(registry: DataFrame) -> DataFrame:
    return registry.filter("enabled")


def resolve_feeds(requests: DataFrame, registry: DataFrame, id_col: str = "source_id") -> tuple[DataFrame, DataFrame]:
    """(requests with their feed, requests naming an unknown feed); ids ignore case and blanks."""
    wanted = F.lower(text.strip(F.col(id_col)))
    feeds = F.broadcast(registry.select(F.struct(*registry.columns).alias("feed")))
    known = requests.join(feeds, wanted == F.col("feed.source_id"))
    unknown = requests.join(
        F.broadcast(registry.select(F.col("source_id").alias("_known"))), wanted == F.col("_known"), "left_anti"
    )
    return known, unknown


def feed_rule_errors() -> Column:
    """First broken field rule of a registry row."""
    return F.coalesce(
        F.when(~F.col("source_id").rlike(fixed.SOURCE_ID_PATTERN), "source_id_invalid"),
        F.when(~F.length("source_id").between(3, 100), "source_id_invalid"),
        F.when(~F.length(text.strip(F.col("name"))).between(2, 200), "name_invalid"),
        F.when(~F.col("language_code").rlike(fixed.FEED_LANGUAGE_PATTERN), "language_invalid"),
        F.when(~F.col("default_category").isin(*fixed.CATEGORIES), "category_invalid"),
        F.when(~F.col("expected_format").isin("auto", "rss", "atom"), "format_invalid"),
        F.when(~F.col("max_articles_per_fetch").between(1, fixed.MAX_FEED_RECORDS), "limit_invalid"),
    )


def region_catalog(spark: SparkSession) -> DataFrame:
    """States and union territories in display order."""
    rows = [(s, n, "state") for s, n in fixed.REGION_STATES]
    rows += [(s, n, "union_territory") for s, n in fixed.REGION_TERRITORIES]
    return spark.createDataFrame(
        [("IN-" + s, s, n, kind, "IN", i, True) for i, (s, n, kind) in enumerate(rows, 1)],
        "code string, short_code string, name string, region_type string, country_code string, "
        "display_order int, is_active boolean",
    )


def region_audit(regions: DataFrame) -> DataFrame:
    """Counts and uniqueness of a region catalogue in one pass."""
    return regions.agg(
        F.count("*").alias("total"),
        F.count_if("is_active").alias("active"),
        F.count_if(F.col("region_type") == "state").alias("states"),
        F.count_if(F.col("region_type") == "union_territory").alias("territories"),
        F.countDistinct("code").alias("codes"),
        F.countDistinct("short_code").alias("short_codes"),
        F.countDistinct("name").alias("names"),
    )


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Scan one of the fourteen relational tables with its declared schema."""
    return spark.read.schema(TABLES[table]).parquet(path)


Mapper = Callable[[DataFrame], DataFrame]


class ProviderMappers:
    """Provider name to mapper (raw payload rows to record rows); names ignore case."""

    def __init__(self) -> None:
        self._mappers: dict[str, Mapper] = {}

    def register(self, provider: str, mapper: Mapper) -> None:
        if not provider.strip():
            raise ValueError("provider must not be blank")
        self._mappers[provider.strip().lower()] = mapper

    def _name(self) -> Column:
        return F.lower(text.strip(F.col("provider")))

    def route(self, raw: DataFrame) -> DataFrame:
        """Every registered mapper over its own payloads, results united by column name."""
        if not self._mappers:
            raise ValueError("no provider registered")
        results = [mapper(raw.filter(self._name() == name)) for name, mapper in self._mappers.items()]
        routed = results[0]
        for more in results[1:]:
            routed = routed.unionByName(more, allowMissingColumns=True)
        return routed

    def is_unknown(self) -> Column:
        """Whether no mapper is registered for a row's provider."""
        return ~F.coalesce(self._name().isin(*self._mappers), F.lit(False))

    def unknown(self, raw: DataFrame) -> DataFrame:
        """Payloads no mapper is registered for."""
        return raw.filter(self.is_unknown())
