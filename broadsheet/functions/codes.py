"""Country, language and score columns, and the small catalogues behind them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.fixed import FORMAL_COUNTRY_NAMES, UNKNOWN_LANGUAGE
from broadsheet.functions.expr import let
from broadsheet.functions.text import fold, strip

SCORE_TYPE = "decimal(5,4)"
WIDE_DECIMAL = "decimal(38,18)"


_CATALOG_ROWS: dict[str, list[tuple]] = {}


def country_catalog(spark: SparkSession) -> DataFrame:
    """(country_code, country_name, lookup_key): ISO 3166 by code, three-letter code and names.

    The codes and English names come from the locale data on Spark's own class path; the formal
    ISO names that differ are added from a short fixed list. About 250 countries in total.
    """
    if "countries" not in _CATALOG_ROWS:
        locale = spark._jvm.java.util.Locale
        english, rows = locale("en"), []
        for code in locale.getISOCountries():
            place = locale("und", code)
            common = place.getDisplayCountry(english)
            formal = FORMAL_COUNTRY_NAMES.get(code, ())
            name = formal[0] if formal else common.replace(" & ", " and ")
            keys = {code, place.getISO3Country(), common, common.replace(" & ", " and "), *formal}
            rows += [(code, name, key.lower()) for key in sorted(keys) if key]
        _CATALOG_ROWS["countries"] = rows
    return spark.createDataFrame(
        _CATALOG_ROWS["countries"], "country_code string, country_name string, lookup_key string"
    )


def language_catalog(spark: SparkSession) -> DataFrame:
    """(language_code, lookup_key): ISO 639 two-letter code where one exists, else three-letter."""
    if "languages" not in _CATALOG_ROWS:
        locale = spark._jvm.com.ibm.icu.util.ULocale
        english, best = locale("en"), {}
        for code in sorted(locale.getISOLanguages(), key=lambda c: (len(c), c)):
            language = locale(code)
            for key in (code, language.getISO3Language(), language.getDisplayLanguage(english)):
                if key:
                    best.setdefault(key.lower(), code.lower())
        _CATALOG_ROWS["languages"] = [(code, key) for key, code in best.items()]
    return spark.createDataFrame(_CATALOG_ROWS["languages"], "language_code string, lookup_key string")


def with_country_code(df: DataFrame, name_col: str, out: str, catalog: DataFrame) -> DataFrame:
    """Add the alpha-2 code for a country name or code; unknown or blank gives null.

    The catalogue holds a fixed few hundred rows, so broadcasting it never grows with the data.
    """
    keys = catalog.groupBy(F.col("lookup_key").alias("_country_key")).agg(F.min("country_code").alias(out))
    return df.join(
        F.broadcast(keys), F.lower(strip(F.col(name_col))) == F.col("_country_key"), "left"
    ).drop("_country_key")


def with_language_code(df: DataFrame, name_col: str, out: str, catalog: DataFrame) -> DataFrame:
    """Add the language code for a language name or code; unknown or blank gives ``und``."""
    keys = catalog.select(F.col("lookup_key").alias("_language_key"), F.col("language_code").alias("_found_language"))
    joined = df.join(F.broadcast(keys), F.lower(strip(F.col(name_col))) == F.col("_language_key"), "left")
    return joined.withColumn(out, F.coalesce("_found_language", F.lit(UNKNOWN_LANGUAGE))).drop(
        "_language_key", "_found_language"
    )


def iso_codes(catalog: DataFrame) -> DataFrame:
    """The distinct two-letter codes of a country catalogue, with their names."""
    return catalog.groupBy("country_code").agg(F.first("country_name").alias("country_name"))


def to_decimal(c: Column) -> Column:
    """Numeric text to a wide decimal; null when it is not a number."""
    return strip(c.cast("string")).try_cast(WIDE_DECIMAL)


def score_in_range(wide: Column) -> Column:
    """Range rule for relevance, tested before any rounding."""
    return F.coalesce((wide >= 0) & (wide <= 1), F.lit(False))


def normalized_entries(scores: Column) -> Column:
    """Map entries as (code, wide score), in map order, codes trimmed and upper-cased."""
    return F.transform(
        F.map_entries(scores),
        lambda e: F.struct(F.upper(strip(e["key"])).alias("code"), to_decimal(e["value"]).alias("score")),
    )


def scores_error(scores: Column) -> Column:
    """Reason a relevance map is refused, null when it is fine (null maps are empty maps)."""
    return entries_error(normalized_entries(scores))


def entries_error(entries: Column) -> Column:
    """As :func:`scores_error`, of a map's normalised entries."""

    def rules(entries: Column) -> Column:
        return (
            F.when(F.exists(entries, lambda e: e["code"] == ""), "score_code_empty")
            .when(F.exists(entries, lambda e: e["score"].isNull()), "score_not_numeric")
            .when(F.exists(entries, lambda e: ~score_in_range(e["score"])), "score_out_of_range")
        )

    return F.when(entries.isNotNull(), let(entries, rules))


def normalized_scores(scores: Column) -> Column:
    """Upper-case codes to stored scores; of two spellings of a code the later one stays."""
    return entries_scores(normalized_entries(scores))


def entries_scores(entries: Column) -> Column:
    """As :func:`normalized_scores`, of a map's normalised entries."""

    def build(entries: Column) -> Column:
        repeated = F.size(F.array_distinct(F.transform(entries, lambda e: e["code"]))) < F.size(entries)
        last = F.filter(
            entries,
            lambda e, i: ~F.exists(
                F.slice(entries, i + 2, F.greatest(F.size(entries) - i - 1, F.lit(0))),
                lambda later: later["code"] == e["code"],
            ),
        )
        narrowed = F.transform(
            F.when(repeated, last).otherwise(entries),
            lambda e: F.struct(e["code"].alias("key"), e["score"].try_cast(SCORE_TYPE).alias("value")),
        )
        return F.map_from_entries(narrowed)

    return F.when(entries.isNotNull(), let(entries, build))


def with_scores(df: DataFrame, maps: dict[str, Column]) -> DataFrame:
    """Add per map its normalised scores under its name, and ``_<name>_error`` (see :func:`normalized_scores`, :func:`scores_error`).

    A map of one entry, as most are, is judged without a loop over its entries.
    """
    part = lambda n, what: F.col(f"_{n}_{what}")
    step = df.select("*", *[m.alias(f"_{n}_map") for n, m in maps.items()])
    alone = lambda n, c: F.when(F.size(part(n, "map")) == 1, c)
    step = step.select(
        "*",
        *[alone(n, F.upper(strip(F.get(F.map_keys(part(n, "map")), F.lit(0))))).alias(f"_{n}_code") for n in maps],
        *[alone(n, to_decimal(F.get(F.map_values(part(n, "map")), F.lit(0)))).alias(f"_{n}_wide") for n in maps],
        *[F.when(F.size(part(n, "map")) != 1, normalized_entries(part(n, "map"))).alias(f"_{n}_entries") for n in maps],
    )
    error = lambda n: (
        F.when(F.size(part(n, "map")) != 1, entries_error(part(n, "entries"))).when(part(n, "map").isNull(), None)
        .when(part(n, "code") == "", "score_code_empty").when(part(n, "wide").isNull(), "score_not_numeric")
        .when(~score_in_range(part(n, "wide")), "score_out_of_range")
    )
    stored = lambda n: alone(n, F.create_map(part(n, "code"), part(n, "wide").try_cast(SCORE_TYPE))).otherwise(entries_scores(part(n, "entries")))
    done = step.select("*", *[error(n).alias(f"_{n}_error") for n in maps], *[stored(n).alias(n) for n in maps])
    return done.drop(*[f"_{n}_{what}" for n in maps for what in ("map", "code", "wide", "entries")])


def matches_query(query: Column, *texts: Column) -> Column:
    """Case-folded substring test over the joined texts; a blank query matches everything."""
    wanted = fold(strip(query))
    return (wanted == "") | F.contains(fold(F.concat_ws(" ", *[F.coalesce(t, F.lit("")) for t in texts])), wanted)
