"""Section H: sorts, limits and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.functions import text, urls
from broadsheet.functions.expr import fence
from broadsheet.operators import dedup, rankings, serving
from broadsheet.plans.bindings import Tables, stamp
from broadsheet.plans.lookups import SNAPSHOT_DATE, TS
from broadsheet.plans.registry import query
from broadsheet.plans.scalars import PAGE_TEXT
from broadsheet.plans.scans import relational_tables
from broadsheet.sources import api_json


@query("h1_recent_articles", "docs", f"""
SELECT article_id AS id, title, {TS.format('published_at')} AS published_at FROM docs WHERE primary_category = 'Energy' AND language_code = 'en'
ORDER BY docs.published_at DESC, article_id LIMIT 50""")
def h1(t: Tables) -> DataFrame:
    return serving.list_recent(t.articles, 50, "Energy", "en").select("id", "title", stamp(F.col("published_at")).alias("published_at"))


@query("h2_active_sources", "sources", "SELECT id, name FROM sources WHERE is_active ORDER BY name, id LIMIT 100")
def h2(t: Tables) -> DataFrame:
    return serving.list_active_sources(t.sources).select("id", "name")


@query("h3_states_by_display_order", "states", "SELECT code, name, display_order FROM states WHERE is_active AND region_type = 'state'")
def h3(t: Tables) -> DataFrame:
    return serving.list_states(t.states, "state").select("code", "name", "display_order")


@query("h4_districts_of_state", sql="""
SELECT 'district-' || p_partkey AS id, p_name || ' ' || p_partkey AS name FROM part WHERE p_partkey % 25 = 4 AND p_size > 5 ORDER BY name, id LIMIT 200""")
def h4(t: Tables) -> DataFrame:
    return serving.list_districts(relational_tables(t)["districts"], "N-04").select("id", "name")


@query("h5_cities_of_state", sql="""
SELECT 'city-' || p_partkey AS id, p_brand || ' ' || p_partkey AS name FROM part WHERE p_partkey % 25 = 6 AND p_size > 10 ORDER BY name, id LIMIT 200""")
def h5(t: Tables) -> DataFrame:
    return serving.list_cities(relational_tables(t)["cities"], "N-06").select("id", "name")


@query("h6_ranking_snapshot", "rankings", f"""
SELECT state_code, rank_position, article_id, ranking_score FROM rankings WHERE state_code = 'N-11' AND ranking_date = '{SNAPSHOT_DATE}'""")
def h6(t: Tables) -> DataFrame:
    return rankings.list_rankings(t.rankings, "N-11", SNAPSHOT_DATE).select(
        "state_code", F.col("rank_position").cast("bigint").alias("rank_position"), "article_id", "ranking_score"
    )


@query("h7_favorite_countries", "favorite_countries", """
SELECT user_id, string_agg(country_code, ',' ORDER BY priority) AS countries FROM favorite_countries GROUP BY user_id""")
def h7(t: Tables) -> DataFrame:
    """Every user's countries in priority order (two at most, so the list is bounded)."""
    ordered = F.array_sort(F.collect_list(F.struct("priority", "country_code")))
    return t.favorite_countries.groupBy("user_id").agg(
        F.array_join(F.transform(ordered, lambda r: r["country_code"]), ",").alias("countries")
    )


@query("h8_newest_records_per_payload", "api_mapped", """
SELECT 'p' || payload AS payload_id, pos FROM (
  SELECT payload, pos, row_number() OVER (PARTITION BY payload ORDER BY CASE WHEN event_id % 50 = 49 THEN NULL ELSE published_at END DESC NULLS LAST, pos) AS rn FROM api_mapped)
WHERE rn <= payload % 60 + 20""")
def h8(t: Tables) -> DataFrame:
    return api_json.newest_per_payload(t.api_mapped).select("payload_id", "pos")


@query("h9_top_articles_per_source", sql=f"""
SELECT host, rank, page_id, title, content_hash FROM (
  SELECT *, row_number() OVER (PARTITION BY host ORDER BY page_id DESC) AS rank FROM (
    SELECT page_id, sha256({PAGE_TEXT}) AS content_hash, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host,
      trim(regexp_replace(replace(replace(replace(replace(regexp_replace(regexp_extract(html, '<title>(.*?)</title>', 1), '<[^>]*>', ' ', 'g'),
      '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '\\s+', ' ', 'g')) AS title FROM pages) WHERE title <> '') WHERE rank <= 10""")
def h9(t: Tables) -> DataFrame:
    """Flagship: pages cleaned, validated, deduplicated by url, newest ten per source host."""
    title = F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1)
    pages = t.base("pages").select("page_id", "url", "html", title.alias("raw_title"))
    entries = fence(text.with_clean_text(pages, {"title": F.col("raw_title"), "content": F.col("html")}).select(
        F.col("page_id").alias("seq"), urls.normalize_url(F.col("url")).alias("url"), "title", F.sha2("content", 256).alias("content_hash"),
        F.sha2(F.concat_ws("|", F.lit("page"), "url"), 256).alias("article_id"),
    ))
    valid = entries.filter(F.col("title").isNotNull() & F.col("url").isNotNull())
    # Only first copies are shown, so one aggregate per url decides and carries them: one scan, one shuffle.
    kept = valid.groupBy("url").agg(F.min_by(F.struct("seq", "title", "content_hash"), "seq").alias("first"))
    hosted = kept.select(F.col("first.seq").alias("page_id"), urls.url_netloc(F.col("url")).alias("host"), "first.title", "first.content_hash")
    return serving.top_per_group(hosted, ["host"], [F.col("page_id").desc()], 10)
