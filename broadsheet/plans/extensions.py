"""Queries on what is derived from articles: regions, scores, rankings, stories (inventory 2.M)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.operators import regions, stories, trending
from broadsheet.plans.bindings import AS_OF, Tables
from broadsheet.plans.registry import query
from broadsheet.session import cut, scratch_path


@query("m4_region_links", "mentions", """
SELECT doc_id, kind, code, state_code, count(*) AS mentions, min(start) AS first_word FROM mentions GROUP BY ALL""")
def m4_region_links(t: Tables) -> DataFrame:
    """States, districts and cities that every document names."""
    return regions.region_links(regions.find_mentions(t.base("documents"), t.gazetteer, "doc_id", "text"), "doc_id")


@query("m4_state_scores", "mentions", """
SELECT doc_id, state_code, mentions, CAST(round(CAST(mentions AS DOUBLE) / sum(mentions) OVER (PARTITION BY doc_id), 4) AS DECIMAL(5,4)) AS relevance_score,
       row_number() OVER (PARTITION BY doc_id ORDER BY mentions DESC, first_word, state_code) = 1 AS is_primary, 'keyword' AS detection_method
FROM (SELECT doc_id, state_code, count(*) AS mentions, min(start) AS first_word FROM mentions GROUP BY ALL)""")
def m4_state_scores(t: Tables) -> DataFrame:
    """Relevance of the states every document names, its primary state marked."""
    return regions.state_scores(regions.find_mentions(t.base("documents"), t.gazetteer, "doc_id", "text"), "doc_id")


# Ranking parts that the given tables have no column for, by document.
ENGAGEMENT, CREDIBILITY, BREAKING = "doc_id * 17 % 100 / 100.0", "doc_id * 7 % 101", "doc_id % 29 = 0"
BATCHES = 4
_SCORED = f"""
SELECT a.scope, a.code, a.article_id, d.doc_id, d.published_at, round(log2(35.0::DOUBLE + 30.0::DOUBLE * a.relevance_score::DOUBLE + 20.0::DOUBLE * ((d.{CREDIBILITY})::DOUBLE / 100)
         + 10.0::DOUBLE * (d.{ENGAGEMENT})::DOUBLE + CASE WHEN d.{BREAKING} THEN 5.0::DOUBLE ELSE 0.0::DOUBLE END) + (epoch_us(d.published_at) / 3.6e9 - 490896) / 12.0, 6) AS log_score
FROM (SELECT 'state' AS scope, state_code AS code, article_id, relevance_score FROM article_states
      UNION ALL SELECT 'country', country_code, article_id, 1.0 FROM docs) a JOIN docs d USING (article_id)"""
_VALUE = "CAST(round(pow(2.0::DOUBLE, log_score - (epoch_us({}) / 3.6e9 - 490896) / 12.0), 4) AS DECIMAL(12,4))"


def scored_articles(t: Tables) -> DataFrame:
    """Every article in each of its states and its country, with its parts and stored score."""
    states = t.article_states.select(F.lit("state").alias("scope"), F.col("state_code").alias("code"), "article_id", "relevance_score")
    countries = t.article_countries.select(F.lit("country").alias("scope"), F.col("country_code").alias("code"), "article_id", "relevance_score")
    about = t.docs.select(F.col("article_id").alias("_id"), "doc_id", "published_at")
    joined = states.unionByName(countries).join(about, F.col("article_id") == F.col("_id"))
    points = trending.parts(F.col("relevance_score"), F.expr(CREDIBILITY), F.expr(ENGAGEMENT), F.expr(BREAKING))
    return joined.withColumn("parts", points).select(
        "scope", "code", "article_id", "doc_id", "published_at", "parts", trending.log_score(F.col("parts"), F.col("published_at")).alias("log_score")
    )


@query("m2_ranking_scores", "docs article_states", f"""
SELECT scope, code, article_id, log_score, {_VALUE.format(f"TIMESTAMP '{AS_OF}'")} AS score_now, dense_rank() OVER (PARTITION BY scope, code ORDER BY log_score DESC) AS place
FROM ({_SCORED})""")
def m2_ranking_scores(t: Tables) -> DataFrame:
    """Stored scores, and that their order is the order of the decayed values: places are taken from the values now."""
    now = F.lit(AS_OF).cast("timestamp")
    left = F.col("log_score") - (trending.hours(now) - trending.LANDMARK_HOURS) / trending.HALF_LIFE_HOURS
    place = F.dense_rank().over(Window.partitionBy("scope", "code").orderBy(left.desc()))
    return scored_articles(t).select("scope", "code", "article_id", "log_score", trending.score_at(F.col("log_score"), now).alias("score_now"), place.cast("bigint").alias("place"))


@query("m3_top_ten", "docs article_states", f"""
SELECT scope, code AS state_code, strftime(ranking_date, '%Y-%m-%d') AS ranking_date, rank_position, article_id, {_VALUE.format("as_of")} AS ranking_score FROM (
  SELECT *, row_number() OVER (PARTITION BY scope, code, ranking_date ORDER BY log_score DESC, article_id) AS rank_position FROM (
    SELECT s.*, r.as_of, CAST(r.as_of AS DATE) AS ranking_date FROM (
      SELECT *, epoch_us(published_at) // 3600000000 AS hour, least({BATCHES - 1}, (epoch_us(published_at) // 3600000000 - h0) * {BATCHES} // n + CASE WHEN doc_id % 10 = 0 THEN 1 ELSE 0 END) AS batch
      FROM ({_SCORED}), (SELECT min(epoch_us(published_at) // 3600000000) AS h0, max(epoch_us(published_at) // 3600000000) - min(epoch_us(published_at) // 3600000000) + 1 AS n FROM docs)) s
    JOIN (SELECT as_of, k, end_hour FROM (
            SELECT *, row_number() OVER (PARTITION BY CAST(as_of AS DATE) ORDER BY k DESC) AS last FROM (
              SELECT k, h0 + ((k + 1) * n + {BATCHES - 1}) // {BATCHES} AS end_hour, make_timestamp((h0 + ((k + 1) * n + {BATCHES - 1}) // {BATCHES}) * 3600000000) AS as_of
              FROM (SELECT unnest(range({BATCHES})) AS k), (SELECT min(epoch_us(published_at) // 3600000000) AS h0, max(epoch_us(published_at) // 3600000000) - min(epoch_us(published_at) // 3600000000) + 1 AS n FROM docs)))
          WHERE last = 1) r ON s.batch <= r.k AND s.hour < r.end_hour AND s.hour >= r.end_hour - 24)) WHERE rank_position <= 10""")
def m3_top_ten(t: Tables) -> DataFrame:
    """State and country lists after several batches, a tenth of the articles one batch late: equal to a full recomputation.

    A batch ends every quarter of the time the articles span; its lists cover the 24 hours before."""
    root = scratch_path(t.spark, "trending")
    scored = scored_articles(t).withColumn("hour", F.floor(trending.hours(F.col("published_at"))))
    first, last = scored.agg(F.min("hour"), F.max("hour")).first()
    if first is None:
        first, last = 0, 0
    span = last - first + 1
    batch = F.least(F.lit(BATCHES - 1), F.floor((F.col("hour") - first) * BATCHES / span) + F.expr("if(doc_id % 10 = 0, 1, 0)"))
    scored = cut(scored.withColumn("batch", batch), "scored")
    lists = trending.TopLists(t.spark, f"{root}/lists")
    lists.create()
    for scope in ("state", "country"):
        trending.create_snapshots(t.spark, f"{root}/{scope}")
    for k in range(BATCHES):
        lists.merge(scored.filter(F.col("batch") == k).select("scope", "code", "article_id", "published_at", "log_score"))
        until = dt.datetime.fromtimestamp((first + -(-(k + 1) * span // BATCHES)) * 3600, dt.UTC).strftime("%Y-%m-%d %H:%M:%S")
        for scope in ("state", "country"):
            trending.publish(lists, scope, f"{root}/{scope}", until)
    read = [t.spark.read.schema(trending.SNAPSHOTS).parquet(f"{root}/{scope}").withColumn("scope", F.lit(scope)) for scope in ("state", "country")]
    return read[0].unionByName(read[1]).select(
        "scope", "state_code", F.date_format("ranking_date", "yyyy-MM-dd").alias("ranking_date"), F.col("rank_position").cast("bigint").alias("rank_position"), "article_id", "ranking_score",
    )


@query("m6_related_stories")
def m6_related_stories(t: Tables) -> DataFrame:
    """Every document's story, found in three batches; similarity is that to the story's leader. Candidates come from hashes that SQL does not have."""
    store = stories.StoryStore(t.spark, scratch_path(t.spark, "stories"))
    store.create()
    for batch in range(3):
        store.add(t.base("documents").filter(F.col("doc_id") % 3 == batch), batch, "doc_id", "text")
    return store.members().select(F.col("article_id").cast("long").alias("doc_id"), F.col("story_id").cast("long").alias("story_id"), F.round("similarity", 6).alias("similarity"))
