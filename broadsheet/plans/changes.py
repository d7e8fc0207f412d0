"""Section I: dedup, persistence and table mutations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.operators import conform, dedup, mutations, rankings
from broadsheet.plans.bindings import COUNTRY_CODES, Tables, _view, pick, stamp
from broadsheet.plans.registry import query
from broadsheet.plans.scans import relational_tables
from broadsheet.plans.validation import PROPOSED, favorite_changes, proposed_rankings
from broadsheet.session import cut, scratch_path

_view("arrivals", """
SELECT doc_id AS seq, CASE WHEN doc_id % 29 = 4 THEN 'id-' || (doc_id - 1) ELSE 'id-' || doc_id END AS article_id,
       CASE WHEN doc_id % 5 = 3 THEN 'u-' || (doc_id - 2) WHEN doc_id % 13 = 6 THEN 'c-' || (doc_id // 14) ELSE 'u-' || doc_id END AS url,
       CASE WHEN doc_id % 7 = 2 THEN 'c-' || (doc_id // 14) END AS canonical_url,
       CASE WHEN doc_id % 11 <> 0 THEN sha256(CASE WHEN doc_id % 10 = 9 THEN 'shared' ELSE text END) END AS content_hash, doc_id % 17 = 5 AS unfit
FROM documents""")
_view("sequential", """
SELECT CAST(-1 AS BIGINT) AS seq, CAST([] AS VARCHAR[]) AS u, CAST([] AS VARCHAR[]) AS ui, CAST([] AS VARCHAR[]) AS h, CAST([] AS VARCHAR[]) AS hi,
       CAST([] AS VARCHAR[]) AS c, CAST([] AS VARCHAR[]) AS i, '' AS status, '' AS duplicate_of, '' AS duplicate_reason
UNION ALL
SELECT seq, CASE WHEN ok THEN list_concat(u, CASE WHEN canonical_url IS NULL THEN [url] ELSE [url, canonical_url] END) ELSE u END,
       CASE WHEN ok THEN list_concat(ui, CASE WHEN canonical_url IS NULL THEN [article_id] ELSE [article_id, article_id] END) ELSE ui END,
       CASE WHEN ok AND content_hash IS NOT NULL THEN list_append(h, content_hash) ELSE h END,
       CASE WHEN ok AND content_hash IS NOT NULL THEN list_append(hi, article_id) ELSE hi END,
       CASE WHEN ok AND canonical_url IS NOT NULL THEN list_append(c, canonical_url) ELSE c END,
       CASE WHEN ok THEN list_append(i, article_id) ELSE i END,
       CASE WHEN pu > 0 OR ph > 0 THEN 'duplicate' WHEN ok THEN 'stored' ELSE 'failed' END,
       CASE WHEN pu > 0 THEN ui[pu] WHEN ph > 0 THEN hi[ph] ELSE '' END,
       CASE WHEN pu > 0 THEN 'url' WHEN ph > 0 THEN 'content_hash' ELSE '' END
FROM (SELECT *, pu = 0 AND ph = 0 AND NOT unfit AND pc = 0 AND pi = 0 AS ok FROM (
  SELECT n.*, r.u, r.ui, r.h, r.hi, r.c, r.i, coalesce(list_position(r.u, n.url), 0) AS pu, coalesce(list_position(r.h, n.content_hash), 0) AS ph,
         coalesce(list_position(r.c, n.canonical_url), 0) AS pc, coalesce(list_position(r.i, n.article_id), 0) AS pi
  FROM sequential r JOIN arrivals n ON n.seq = r.seq + 1))""", "arrivals")


def arrivals(t: Tables) -> DataFrame:
    """documents as arrivals with url, canonical, hash and id collisions."""
    return t.base("documents").select(
        F.col("doc_id").alias("seq"),
        F.expr("concat('id-', if(doc_id % 29 = 4, doc_id - 1, doc_id))").alias("article_id"),
        F.expr("case when doc_id % 5 = 3 then concat('u-', doc_id - 2) when doc_id % 13 = 6 then concat('c-', doc_id div 14) else concat('u-', doc_id) end").alias("url"),
        F.expr("case when doc_id % 7 = 2 then concat('c-', doc_id div 14) end").alias("canonical_url"),
        F.expr("case when doc_id % 11 <> 0 then sha2(if(doc_id % 10 = 9, 'shared', text), 256) end").alias("content_hash"),
        F.expr("doc_id % 17 = 5").alias("unfit"),
    )


@query("i1_ordered_dedup", "arrivals sequential", """
SELECT seq, status, duplicate_of, duplicate_reason FROM sequential WHERE seq >= 0""")
def i1(t: Tables) -> DataFrame:
    decided = dedup.dedup_ordered(arrivals(t))
    blank = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return decided.select("seq", "status", blank("duplicate_of"), blank("duplicate_reason"))


def persisted(t: Tables) -> conform.Conformed:
    return conform.persist(cut(t.message_requests, "requests"), t.states)


@query("i2_persist_articles", "persisted", """
SELECT seq, status, CASE WHEN status = 'duplicate' THEN first_id ELSE '' END AS duplicate_of FROM persisted""")
def i2(t: Tables) -> DataFrame:
    return persisted(t).results.select("seq", "status", F.coalesce("duplicate_of", F.lit("")).alias("duplicate_of"))


@query("i3_country_link_upsert", "docs", f"""
SELECT article_id, code AS country_code, CAST(score AS DECIMAL(5,4)) AS relevance_score FROM (
  SELECT article_id, code, arg_max(score, version) AS score FROM (
    SELECT article_id, country_code AS code, 1.0 AS score, -1 AS version FROM docs
    UNION ALL SELECT d.article_id, (['AR', d.country_code])[CAST(v AS INTEGER) + 1], ((d.doc_id + v * 7) % 100) / 100.0, v FROM docs d, (VALUES (0), (1)) AS x(v)
    UNION ALL SELECT d.article_id, d.country_code, 0.25, 2 FROM docs d WHERE d.doc_id % 2 = 0) GROUP BY ALL)""")
def i3(t: Tables) -> DataFrame:
    docs = t.docs
    change = lambda code, score, version, df=docs: df.select(
        "article_id", code.alias("country_code"), score.cast("decimal(5,4)").alias("relevance_score"), F.lit(version).alias("version")
    )
    own = F.col("source_country_code")
    changes = (
        change(F.lit("AR"), F.expr("doc_id % 100 / 100"), 0)
        .unionByName(change(own, F.expr("(doc_id + 7) % 100 / 100"), 1))
        .unionByName(change(own, F.lit(0.25), 2, docs.filter("doc_id % 2 = 0")))
    )
    return mutations.upsert_country_links(t.article_countries, changes)


@query("i4_state_link_upsert", "docs article_states", """
SELECT article_id, state_code, CASE WHEN doc_id % 2 = 0 THEN CAST(0.5 AS DECIMAL(5,4)) ELSE relevance_score END AS relevance_score,
  CASE WHEN doc_id % 2 = 0 THEN NOT is_primary ELSE is_primary END AS is_primary, CASE WHEN doc_id % 2 = 0 THEN 'manual' ELSE 'keyword' END AS detection_method FROM article_states""")
def i4(t: Tables) -> DataFrame:
    stored = t.article_states.select("article_id", "state_code", "relevance_score", "is_primary", "detection_method")
    changes = t.article_states.filter("doc_id % 2 = 0").select(
        "article_id", "state_code", F.lit("0.5").cast("decimal(5,4)").alias("relevance_score"), (~F.col("is_primary")).alias("is_primary"),
        F.lit("manual").alias("detection_method"), F.lit(1).alias("version"),
    )
    return mutations.upsert_state_links(stored, changes)


@query("i5_country_links_with_defaults", "docs", """
SELECT article_id, code AS country_code, CAST(score AS DECIMAL(5,4)) AS relevance_score FROM (
  SELECT article_id, country_code AS code, 0.5 AS score FROM docs UNION ALL SELECT article_id, 'US', 1.0 FROM docs WHERE country_code <> 'US')""")
def i5(t: Tables) -> DataFrame:
    """Given scores win; the article's own countries are added at full relevance."""
    scored = t.docs.withColumn("country_scores", F.create_map("source_country_code", F.lit("0.5").cast("decimal(5,4)")))
    return conform.country_links(scored, use_topic_countries=True)


@query("i6_state_links", "requests", """
SELECT article_id, state_code, score AS relevance_score, coalesce(primary_state_code = state_code, FALSE) AS is_primary FROM requests""")
def i6(t: Tables) -> DataFrame:
    return conform.state_links(t.message_requests).drop("detection_method")


@query("i7_bulk_enrichment", "docs", """
SELECT article_id AS id, coalesce(CASE WHEN doc_id % 3 = 0 THEN CASE WHEN doc_id % 2 = 0 THEN 'Summary ' || doc_id END END, '') AS summary,
  CASE WHEN doc_id % 3 = 0 THEN 'Positive' ELSE 'Unknown' END AS sentiment, CASE WHEN doc_id % 3 = 0 THEN 'a,b' ELSE '' END AS keywords, doc_id % 3 = 0 AS ai_processed FROM docs
UNION ALL SELECT 'missing-' || doc_id, 'unmatched', '', '', FALSE FROM docs WHERE doc_id % 50 = 1""")
def i7(t: Tables) -> DataFrame:
    """Enrichment replaces values, also with nulls; rows without an article are reported."""
    fields = [
        F.expr("if(doc_id % 2 = 0, concat('Summary ', doc_id), null)").alias("summary"), F.lit("Positive").alias("sentiment"),
        F.array(F.lit("a"), F.lit("b")).alias("keywords"), F.lit(None).cast("string").alias("share_caption"),
        F.lit(None).cast(t.articles.schema["social_card_data"].dataType).alias("social_card_data"),
    ]
    results = t.docs.filter("doc_id % 3 = 0").select("article_id", *fields).unionByName(
        t.docs.filter("doc_id % 50 = 1").select(F.expr("concat('missing-', doc_id)").alias("article_id"), *fields)
    )
    updated = mutations.apply_enrichment(t.articles, results).select(
        "id", F.coalesce("summary", F.lit("")).alias("summary"), "sentiment", F.array_join("keywords", ",").alias("keywords"), "ai_processed"
    )
    missing = mutations.unmatched_enrichment(t.articles, results).select(
        F.col("article_id").alias("id"), F.lit("unmatched").alias("summary"), F.lit("").alias("sentiment"), F.lit("").alias("keywords"),
        F.lit(False).alias("ai_processed"),
    )
    return updated.unionByName(missing)


@query("i8_replace_top_ten", "rankings", f"""
SELECT state_code, ranking_date, rank_position, article_id, CASE WHEN k % 6 = 0 THEN ranking_score + 1 ELSE ranking_score END AS ranking_score
FROM ({PROPOSED}) WHERE k % 6 <> 5""")
def i8(t: Tables) -> DataFrame:
    """Fresh snapshots replace old ones, empty ones delete, invalid ones change nothing.

    The stored table is partitioned by date and only touched dates are rewritten; the
    read-back shows the committed result.
    """
    stored = t.rankings
    proposed = proposed_rankings(t).filter("k % 6 <> 4").withColumn("ranking_score", F.expr("cast(ranking_score + 1 as decimal(12,4))"))
    touched = proposed.select(*rankings.SNAPSHOT).distinct()
    fresh = proposed.filter("k % 6 <> 5 and k % 6 <> 3").drop("k").unionByName(
        proposed.filter("k % 6 = 3").withColumn("ranking_score", F.expr("cast(ranking_score - 1 as decimal(12,4))")).drop("k")
    )
    path = scratch_path(t.spark, "rankings")
    stored.repartition("ranking_date").write.partitionBy("ranking_date").parquet(path)
    rankings.replace_top_ten_at(path, stored.schema, touched, fresh)
    return t.spark.read.schema(stored.schema).parquet(path).select(
        "state_code", F.date_format("ranking_date", "yyyy-MM-dd").alias("ranking_date"),
        F.col("rank_position").cast("bigint").alias("rank_position"), "article_id", "ranking_score",
    )


@query("i9_replace_favorite_countries", "favorite_countries", """
SELECT user_id, country_code, priority FROM favorite_countries WHERE CAST(user_id AS BIGINT) % 6 IN (1, 2, 3)
UNION ALL SELECT c_custkey::VARCHAR, 'US', 1 FROM customer WHERE c_custkey % 6 = 0 UNION ALL SELECT c_custkey::VARCHAR, 'IN', 2 FROM customer WHERE c_custkey % 6 = 0
UNION ALL SELECT c_custkey::VARCHAR, 'FR', 1 FROM customer WHERE c_custkey % 6 = 4""")
def i9(t: Tables) -> DataFrame:
    """Valid lists replace, an empty list clears, refused lists leave the old rows."""
    return mutations.replace_favorite_countries(t.favorite_countries, favorite_changes(t)).withColumn(
        "priority", F.col("priority").cast("int")
    )


def state_changes(t: Tables) -> DataFrame:
    return t.base("orders").select(
        F.expr("cast(o_custkey as string)").alias("user_id"),
        F.expr("concat('N-', lpad(cast((o_orderkey + 1) % 25 as string), 2, '0'))").alias("state_code"),
    )


@query("i10_add_favorite_state", "favorite_states", """
SELECT user_id, state_code FROM favorite_states UNION SELECT o_custkey::VARCHAR, 'N-' || lpad(((o_orderkey + 1) % 25)::VARCHAR, 2, '0') FROM orders""")
def i10(t: Tables) -> DataFrame:
    return mutations.add_missing(t.favorite_states, state_changes(t), ["user_id", "state_code"])


@query("i11_source_get_or_create", "sources", f"""
SELECT name, source_type, homepage_url, country_code FROM sources UNION ALL
SELECT 'Feed ' || (c_custkey % 40), 'RSS', 'https://feed' || min(c_custkey) || '.example.com/', min_by(([{", ".join(f"'{c}'" for c in COUNTRY_CODES)}])[CAST(c_nationkey AS INTEGER) + 1], c_custkey) FROM customer GROUP BY c_custkey % 40""")
def i11(t: Tables) -> DataFrame:
    """First request creates a source, later ones reuse it, existing ones are never updated."""
    fields = ["name", "source_type", "homepage_url", "country_code"]
    known = t.sources.select("id", *fields)
    new = t.base("customer").select(
        F.col("c_custkey").alias("seq"), F.expr("concat('Feed ', c_custkey % 40)").alias("name"), F.lit("RSS").alias("source_type"),
        F.expr("concat('https://feed', c_custkey, '.example.com/')").alias("homepage_url"), pick(COUNTRY_CODES, "c_nationkey").alias("country_code"),
    )
    again = t.sources.select(F.col("s_suppkey").alias("seq"), "name", "source_type", F.lit("https://changed.example.com/").alias("homepage_url"), F.lit("XX").alias("country_code"))
    return mutations.get_or_create_sources(known, new.unionByName(again)).select(*fields)


@query("i12_remove_favorite_state", "favorite_states", """
SELECT c.user_id, c.state_code, f.user_id IS NOT NULL AS removed FROM (
  SELECT DISTINCT o_custkey::VARCHAR AS user_id, 'N-' || lpad(((o_orderkey + 1) % 25)::VARCHAR, 2, '0') AS state_code FROM orders) c
LEFT JOIN favorite_states f ON f.user_id = c.user_id AND f.state_code = c.state_code
UNION ALL SELECT 'left', 'rows', count(*) > 0 FROM favorite_states""")
def i12(t: Tables) -> DataFrame:
    keys = ["user_id", "state_code"]
    left = mutations.remove(t.favorite_states, state_changes(t), keys)
    summary = left.agg(F.lit("left").alias("user_id"), F.lit("rows").alias("state_code"), (F.count("*") > 0).alias("removed"))
    return mutations.removal_report(t.favorite_states, state_changes(t), keys).unionByName(summary)


@query("i13_user_get_or_create", sql="""
SELECT lower('customer.' || lpad((c_custkey // 2)::VARCHAR, 9, '0') || '@example.com') AS email, c_custkey // 2 % 2 = 1 AS created,
  CASE WHEN c_custkey // 2 % 2 = 1 THEN 'Visitor ' || min(c_custkey) ELSE 'Customer#' || lpad((c_custkey // 2)::VARCHAR, 9, '0') END AS display_name
FROM customer WHERE c_custkey % 7 <> 3 GROUP BY c_custkey // 2""")
def i13(t: Tables) -> DataFrame:
    """E-mails are matched trimmed and in lower case; blank ones are refused; first wins."""
    requests = t.base("customer").select(
        F.col("c_custkey").alias("seq"),
        F.expr("if(c_custkey % 7 = 3, '  ', concat(' CUSTOMER.', lpad(cast(c_custkey div 2 as string), 9, '0'), '@Example.com'))").alias("email"),
        F.expr("concat('Visitor ', c_custkey)").alias("display_name"),
    )
    users = t.users.filter("c_custkey % 2 = 0")
    return mutations.get_or_create_users(users, requests).select("email", "created", "display_name")


@query("i14_region_catalog_upsert", "states", """
SELECT code, CASE WHEN display_order % 3 = 0 THEN name || ' (new)' ELSE name END AS name, display_order,
  CASE WHEN display_order % 3 = 0 THEN '2026-06-25 12:00:00' ELSE '2026-01-01 00:00:00' END AS updated_at, '2026-01-01 00:00:00' AS created_at FROM states
UNION ALL SELECT 'X-' || c_mktsegment, c_mktsegment, 100, '2026-06-25 12:00:00', '2026-06-25 12:00:00' FROM (SELECT DISTINCT c_mktsegment FROM customer)""")
def i14(t: Tables) -> DataFrame:
    columns = ["code", "short_code", "name", "region_type", "country_code", "display_order", "is_active"]
    changed = t.states.filter("display_order % 3 = 0").select(*columns).withColumn("name", F.concat("name", F.lit(" (new)")))
    added = t.base("customer").select("c_mktsegment").distinct().select(
        F.concat(F.lit("X-"), "c_mktsegment").alias("code"), F.col("c_mktsegment").alias("short_code"), F.col("c_mktsegment").alias("name"),
        F.lit("state").alias("region_type"), F.lit("IN").alias("country_code"), F.lit(100).alias("display_order"), F.lit(True).alias("is_active"),
    )
    now = F.expr("timestamp'2026-06-25 12:00:00'")
    merged = mutations.upsert_regions(t.states, changed.unionByName(added), now)
    return merged.select("code", "name", "display_order", stamp(F.col("updated_at")).alias("updated_at"), stamp(F.col("created_at")).alias("created_at"))


@query("i15_cascades", "docs article_states rankings", """
SELECT 'article_states' AS entity, count(*) AS n FROM article_states WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)
UNION ALL SELECT unnest(['article_labels', 'article_countries', 'article_districts', 'article_cities']), count(*) FROM docs WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)
UNION ALL SELECT 'state_news_rankings', count(*) FROM rankings WHERE article_id NOT IN (SELECT article_id FROM docs JOIN labels USING (doc_id) WHERE toxic = 1)
UNION ALL SELECT 'restricted_sources', count(DISTINCT source_name) FROM docs""")
def i15(t: Tables) -> DataFrame:
    """Deleting articles removes their links; deleting a used source is refused."""
    deleted = t.base("labels").filter("toxic = 1").join(t.docs.select("doc_id", "article_id"), "doc_id").select("article_id")
    tables = relational_tables(t)
    left = [
        mutations.cascade_articles(tables[name], deleted).agg(F.lit(name).alias("entity"), F.count("*").alias("n"))
        for name in ("article_states", "article_labels", "article_countries", "article_districts", "article_cities", "state_news_rankings")
    ]
    wanted = t.articles.select("source_id").distinct().unionByName(t.sources.select(F.col("id").alias("source_id")))
    refused = mutations.restricted_sources(t.articles, wanted).agg(F.lit("restricted_sources").alias("entity"), F.count("*").alias("n"))
    return reduce(DataFrame.unionByName, [*left, refused])
