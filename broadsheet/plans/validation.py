"""Section D: filters, predicates and validation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet import fixed
from broadsheet.functions import codes, text, times, urls
from broadsheet.operators import audits, mutations, rankings, serving
from broadsheet.plans.bindings import AS_OF, COUNTRY_CODES, Tables, pick
from broadsheet.plans.registry import query
from broadsheet.plans.scans import FEED_IDS, REQUEST_ERROR, relational_tables
from broadsheet.sources import messages, registry


@query("d1_time_cutoff", "feed_mapped", f"""
SELECT 'f' || payload AS payload_id, pos FROM feed_mapped WHERE reject_reason IS NULL AND published_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY""")
def d1(t: Tables) -> DataFrame:
    seconds = times.timespan_seconds(F.col("timespan"))
    cutoff = F.lit(AS_OF).cast("timestamp") - F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return t.feed_mapped.filter(F.col("reject_reason").isNull() & (F.col("published_at") >= cutoff)).select("payload_id", "pos")


@query("d2_text_filter", "docs", """
SELECT doc_id FROM docs WHERE contains(replace(lower(title || '  ' || content), 'ß', 'ss'), 'strasse') OR contains(replace(lower(title || '  ' || content), 'ß', 'ss'), 'und')""")
def d2(t: Tables) -> DataFrame:
    any_of = codes.matches_query(F.lit(" STRASSE "), F.col("title"), F.lit(""), F.col("content")) | codes.matches_query(
        F.lit("Und"), F.col("title"), F.lit(""), F.col("content")
    )
    return t.docs.filter(any_of).select("doc_id")


@query("d3_api_record_split", "api_mapped", """
SELECT coalesce(reject_reason, 'valid') AS outcome, count(*) AS n FROM api_mapped GROUP BY ALL""")
def d3(t: Tables) -> DataFrame:
    return t.api_mapped.groupBy(F.coalesce("reject_reason", F.lit("valid")).alias("outcome")).agg(F.count("*").alias("n"))


@query("d4_feed_entry_split", "feed_decided", """
SELECT status, coalesce(CASE WHEN status = 'rejected' THEN reject_reason END, '') AS reason, count(*) AS n FROM feed_decided GROUP BY ALL""")
def d4(t: Tables) -> DataFrame:
    reason = F.when(F.col("status") == "rejected", F.col("reject_reason"))
    return t.feed_decided.groupBy("status", F.coalesce(reason, F.lit("")).alias("reason")).agg(F.count("*").alias("n"))


@query("d5_fetch_result_check", "api_mapped", """
SELECT 'p' || payload AS payload_id, count(*) AS received, count(*) FILTER (WHERE reject_reason IS NULL) AS valid,
       count(reject_reason) AS rejected, TRUE AS consistent FROM api_mapped GROUP BY ALL""")
def d5(t: Tables) -> DataFrame:
    counts = t.api_mapped.groupBy("payload_id").agg(
        F.count("*").alias("received"), F.count_if(F.col("reject_reason").isNull()).alias("valid"),
        F.count("reject_reason").alias("rejected"), F.min(F.trim("provider") != "").alias("named"),
    )
    ok = F.col("named") & (F.col("received") >= 0) & (F.col("received") >= F.col("valid") + F.col("rejected"))
    return counts.withColumn("consistent", ok).drop("named")


def score_maps(t: Tables) -> DataFrame:
    """lineitem as relevance maps: two spellings of one code, sometimes out of range or blank."""
    number = lambda c: F.format_string("%.2f", F.col(c))
    scores = F.map_from_arrays(
        F.array(F.expr("concat(' s', l_suppkey % 25, ' ')"), F.expr("if(l_linenumber = 7, '  ', concat('S', l_suppkey % 25))")),
        F.array(number("l_discount"), F.when(F.col("l_quantity") > 48, F.format_string("%.2f", F.col("l_quantity"))).otherwise(number("l_tax"))),
    )
    return t.spread("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", scores.alias("scores"))


@query("d6_relevance_scores", sql="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber = 7 THEN 'score_code_empty' WHEN l_quantity > 48 THEN 'score_out_of_range'
  ELSE 'S' || (l_suppkey % 25) || '=' || CAST(CAST(l_tax AS DECIMAL(5,4)) AS VARCHAR) END AS outcome FROM lineitem""")
def d6(t: Tables) -> DataFrame:
    """Codes in upper case, range before rounding, the later spelling of a code wins."""
    shown = F.array_join(
        F.transform(F.map_entries(codes.normalized_scores(F.col("scores"))), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ","
    )
    return score_maps(t).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.coalesce(codes.scores_error(F.col("scores")), shown).alias("outcome")
    )


@query("d7_message_scores", "messages", """
SELECT event_id, state_code || '=' || CAST(score AS VARCHAR) AS states, country_code || '=1.0000' AS countries FROM messages WHERE message_error IS NULL""")
def d7(t: Tables) -> DataFrame:
    show = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return t.messages.filter(F.col("message_error").isNull()).select(
        "event_id", show("state_scores").alias("states"), show("country_scores").alias("countries")
    )


@query("d8_primary_state_rule", "messages", """
SELECT CASE WHEN message_error = 'invalid_json' THEN 'unreadable' WHEN event_id % 43 = 8 THEN 'missing' WHEN event_id % 2 = 0 THEN 'present' ELSE 'none' END AS primary_state, count(*) AS n
FROM messages GROUP BY ALL""")
def d8(t: Tables) -> DataFrame:
    """The rule on every message, whatever else is wrong with it."""
    primary = F.col("primary_state_code")
    named = F.coalesce(F.map_contains_key("state_scores", primary), F.lit(False))
    kind = F.when(F.col("message_error") == "invalid_json", "unreadable").when(primary.isNull(), "none").when(named, "present").otherwise("missing")
    return t.messages.groupBy(kind.alias("primary_state")).agg(F.count("*").alias("n"))


@query("d9_storage_uri_rule", sql="""
SELECT kind, count(*) AS n, kind IN (0, 1) AS valid FROM (SELECT o_orderkey % 6 AS kind FROM orders) GROUP BY ALL""")
def d9(t: Tables) -> DataFrame:
    uri = pick(["s3://lake/raw/", " s3://lake/", "s3://lake", "s3:///", "https://lake/", "s3:// /"], "o_orderkey % 6")
    full = F.when(F.expr("o_orderkey % 6 in (0, 1, 3, 4, 5)"), F.concat(uri, F.col("o_orderkey").cast("string"))).otherwise(uri)
    return t.base("orders").groupBy(F.expr("o_orderkey % 6").alias("kind"), urls.is_storage_uri(full).alias("valid")).agg(
        F.count("*").alias("n")
    )


@query("d10_message_contract", "messages", """
SELECT coalesce(message_error, 'ok') AS outcome, count(*) AS n FROM messages GROUP BY ALL""")
def d10(t: Tables) -> DataFrame:
    return t.messages.groupBy(F.coalesce("message_error", F.lit("ok")).alias("outcome")).agg(F.count("*").alias("n"))


@query("d11_scheduled_request_contract", sql=f"SELECT {REQUEST_ERROR} AS outcome, count(*) AS n FROM customer GROUP BY ALL")
def d11(t: Tables) -> DataFrame:
    parsed = messages.parse_requests(t.request_bodies)
    return parsed.groupBy(F.coalesce("request_error", F.lit("ok")).alias("outcome")).agg(F.count("*").alias("n"))


def _requests(t: Tables) -> DataFrame:
    return messages.parse_requests(t.request_bodies).select("c_custkey", "provider", "query", "max_records", "timespan")


@query("d12_api_request_rules", sql="""
SELECT c_custkey, CASE WHEN c_custkey % 11 = 4 THEN 'query_invalid' WHEN c_custkey % 260 NOT BETWEEN 1 AND 250 THEN 'max_records_invalid'
  WHEN c_custkey % 8 IN (4, 5) THEN 'timespan_invalid' WHEN c_custkey % 8 = 2 THEN 'timespan_too_short' ELSE 'ok' END AS outcome FROM customer""")
def d12(t: Tables) -> DataFrame:
    return _requests(t).select("c_custkey", F.coalesce(*messages.request_rules("api"), F.lit("ok")).alias("outcome"))


@query("d13_feed_request_rules", sql="""
SELECT c_custkey, CASE WHEN c_custkey % 260 NOT BETWEEN 1 AND 200 THEN 'max_records_invalid'
  WHEN c_custkey % 8 IN (4, 5) THEN 'timespan_invalid' ELSE 'ok' END AS outcome FROM customer""")
def d13(t: Tables) -> DataFrame:
    return _requests(t).select("c_custkey", F.coalesce(*messages.request_rules("feed"), F.lit("ok")).alias("outcome"))


def article_documents(t: Tables) -> DataFrame:
    """documents as article JSON with one broken rule in some of them."""
    document = F.struct(
        "title", F.expr("if(doc_id % 10 = 1, 'not-a-url', url)").alias("url"),
        F.struct(
            F.col("source_name").alias("name"), F.expr("if(doc_id % 10 = 2, 'Radio', 'RSS')").alias("source_type"),
            F.expr("if(doc_id % 10 = 3, 'IND', 'in')").alias("country_code"), F.expr("if(doc_id % 10 = 4, 101, 95)").alias("credibility_score"),
        ).alias("source"),
        F.expr("if(doc_id % 10 = 5, 'someday', date_format(published_at, \"yyyy-MM-dd'T'HH:mm:ss'+05:30'\"))").alias("published_at"),
        F.expr("if(doc_id % 10 = 6, 'Gossip', 'Energy')").alias("primary_category"),
        F.expr("if(doc_id % 10 = 7, 'abc', content_hash)").alias("content_hash"),
        F.expr("if(doc_id % 10 = 8, array('in', 'XX'), array('in', 'US', 'in'))").alias("country_codes"),
        F.array(F.lit("Energy"), F.lit(" energy "), F.lit("India"), F.lit("")).alias("keywords"),
        F.expr("if(doc_id % 10 = 9, 1, null)").alias("surprise"),
    )
    return t.docs.select("doc_id", F.to_json(document).alias("document"))


@query("d14_article_contract", "docs", """
SELECT doc_id, CASE doc_id % 10 WHEN 1 THEN 'url_invalid' WHEN 2 THEN 'source_type_invalid' WHEN 3 THEN 'source_country_invalid' WHEN 4 THEN 'credibility_invalid'
  WHEN 5 THEN 'published_at_invalid' WHEN 6 THEN 'category_invalid' WHEN 7 THEN 'content_hash_invalid' WHEN 8 THEN 'country_code_invalid' WHEN 9 THEN 'unknown_field' ELSE 'ok' END AS outcome,
  CASE WHEN doc_id % 10 = 8 THEN 'IN,XX' ELSE 'IN,US' END AS countries, 'Energy,India' AS keywords,
  CASE WHEN doc_id % 10 = 5 THEN '' ELSE strftime(published_at - INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S') END AS published_at FROM docs""")
def d14(t: Tables) -> DataFrame:
    parsed = messages.parse_articles(article_documents(t), "document", t.countries)
    return parsed.select(
        "doc_id", F.coalesce("article_error", F.lit("ok")).alias("outcome"), F.array_join("country_codes", ",").alias("countries"),
        F.array_join("keywords", ",").alias("keywords"),
        F.coalesce(F.date_format("published_at", "yyyy-MM-dd HH:mm:ss"), F.lit("")).alias("published_at"),
    )


@query("d15_source_contract", "sources", """
SELECT s_suppkey, CASE WHEN s_suppkey % 9 = 1 THEN 'homepage_url_invalid' WHEN s_suppkey % 9 = 2 THEN 'credibility_invalid' WHEN s_suppkey % 9 = 3 THEN 'name_invalid' ELSE 'ok' END AS outcome FROM sources""")
def d15(t: Tables) -> DataFrame:
    name = F.expr("if(s_suppkey % 9 = 3, '  ', name)")
    home = F.expr("if(s_suppkey % 9 = 1, 'ftp://x', homepage_url)")
    credibility = F.expr("if(s_suppkey % 9 = 2, 100.01, credibility_score)")
    known = F.array_contains(t.countries.agg(F.collect_set("country_code").alias("c")).scalar(), F.col("country_code"))
    error = F.coalesce(
        F.when(~F.length(text.strip(name)).between(1, fixed.SOURCE_NAME_LENGTH), "name_invalid"),
        F.when(urls.normalize_url(home).isNull(), "homepage_url_invalid"),
        F.when(~known, "source_country_invalid"), F.when(~credibility.between(0, 100), "credibility_invalid"),
    )
    return t.sources.select("s_suppkey", F.coalesce(error, F.lit("ok")).alias("outcome"))


@query("d16_country_code_validity", sql="""
SELECT code, code NOT IN ('XX', 'IND') AS valid, count(*) AS n FROM (
  SELECT (['IN', 'US', 'XX', 'IND', 'GB'])[CAST(c_custkey % 5 AS INTEGER) + 1] AS code FROM customer) GROUP BY ALL""")
def d16(t: Tables) -> DataFrame:
    given = t.base("customer").select(text.code(pick(["in", " us ", "XX", "IND", "gb"], "c_custkey % 5")).alias("code"))
    iso = codes.iso_codes(t.countries).select(F.col("country_code").alias("code"), F.lit(True).alias("known"))
    return given.groupBy("code").agg(F.count("*").alias("n")).join(F.broadcast(iso), "code", "left").select(
        "code", F.coalesce("known", F.lit(False)).alias("valid"), "n"
    )


@query("d17_column_checks", "", """
SELECT 'news_sources' AS table_name, 'credibility_score_range' AS rule, 0 AS violations UNION ALL SELECT 'news_sources', 'country_code_length', 0
UNION ALL SELECT 'indian_states', 'region_type_values', 0 UNION ALL SELECT 'indian_states', 'country_code_india', 0 UNION ALL SELECT 'indian_states', 'display_order_positive', 0
UNION ALL SELECT 'articles', 'language_code_length', 0 UNION ALL SELECT 'articles', 'content_hash_format', count(*) FILTER (WHERE doc_id % 10 = 7) FROM documents
UNION ALL SELECT 'article_countries', 'country_code_length', 0 UNION ALL SELECT 'article_countries', 'relevance_score_range', 0
UNION ALL SELECT 'article_states', 'relevance_score_range', 0 UNION ALL SELECT 'article_districts', 'relevance_score_range', 0
UNION ALL SELECT 'article_cities', 'relevance_score_range', 0 UNION ALL SELECT 'user_favorite_countries', 'favorite_country_priority_range', 0
UNION ALL SELECT 'user_favorite_countries', 'country_code_length', 0 UNION ALL SELECT 'state_news_rankings', 'rank_position_top_ten', 0
UNION ALL SELECT 'state_news_rankings', 'ranking_score_nonnegative', 0""")
def d17(t: Tables) -> DataFrame:
    """Every check constraint over its whole table, one scan per table."""
    tables = relational_tables(t)
    tables["articles"] = tables["articles"].withColumn("content_hash", F.expr("if(doc_id % 10 = 7, 'short', content_hash)"))
    results = [
        audits.check_counts(tables[name], rules).select(F.lit(name).alias("table_name"), "rule", "violations")
        for name, rules in audits.CHECKS.items()
    ]
    return reduce(DataFrame.unionByName, results)


@query("d18_unique_keys", "docs users", """
SELECT * FROM (WITH keys AS (SELECT unnest(['news_sources:id', 'news_sources:name,source_type', 'indian_states:code', 'indian_states:short_code', 'indian_states:name', 'districts:id',
  'districts:state_code,name', 'districts:state_code,slug', 'cities:id', 'cities:state_code,name', 'cities:state_code,slug', 'articles:id', 'articles:url', 'articles:canonical_url',
  'articles:content_hash', 'article_labels:article_id,label', 'article_countries:article_id,country_code', 'article_states:article_id,state_code',
  'article_districts:article_id,district_id', 'article_cities:article_id,city_id', 'app_users:id', 'app_users:email', 'user_favorite_countries:user_id,country_code',
  'user_favorite_countries:user_id,priority', 'user_favorite_states:user_id,state_code',
  'state_news_rankings:state_code,ranking_date,ranking_window,category_filter,rank_position',
  'state_news_rankings:state_code,ranking_date,ranking_window,category_filter,article_id']) AS k),
repeats AS (
  SELECT 'articles:content_hash' AS k, count(*) AS n FROM docs GROUP BY content_hash HAVING count(*) > 1
  UNION ALL SELECT 'app_users:email', count(*) FROM users GROUP BY CASE WHEN c_custkey % 10 = 3 THEN 'u' || c_custkey % 40 ELSE email END HAVING count(*) > 1)
SELECT split_part(k, ':', 1) AS table_name, split_part(k, ':', 2) AS key, count(n) AS repeated_values, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_involved
FROM keys LEFT JOIN repeats USING (k) GROUP BY k)""")
def d18(t: Tables) -> DataFrame:
    """Every unique key over its whole table; some e-mails are made to repeat."""
    tables = relational_tables(t)
    tables["app_users"] = tables["app_users"].withColumn("email", F.expr("if(c_custkey % 10 = 3, concat('u', c_custkey % 40), email)"))
    checks = [
        audits.repeated_keys(tables[name], keys).agg(
            F.lit(name).alias("table_name"), F.lit(",".join(keys)).alias("key"), F.count("*").alias("repeated_values"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows_involved"),
        )
        for name, all_keys in audits.UNIQUE_KEYS.items() for keys in all_keys
    ]
    return reduce(DataFrame.unionByName, checks)


@query("d19_foreign_keys", "docs article_states users states sources favorite_countries favorite_states rankings", """
SELECT * FROM (WITH districts AS (SELECT 'district-' || p_partkey AS id, 'N-' || lpad((p_partkey % 25)::VARCHAR, 2, '0') AS state_code FROM part WHERE p_size <> 7),
cities AS (SELECT 'city-' || p_partkey AS id, 'N-' || lpad((p_partkey % 25)::VARCHAR, 2, '0') AS state_code, 'district-' || (p_partkey - p_partkey % 50 + p_partkey % 25) AS district_id FROM part),
articles AS (SELECT article_id AS id, sha256(source_name || '|RSS') AS source_id FROM docs WHERE doc_id % 9 <> 4),
parents AS (
  SELECT 'indian_states' AS parent, code AS v FROM states WHERE n_nationkey <> 24 UNION ALL SELECT 'districts', id FROM districts UNION ALL SELECT 'cities', id FROM cities
  UNION ALL SELECT 'news_sources', id FROM sources UNION ALL SELECT 'articles', id FROM articles UNION ALL SELECT 'app_users', id FROM users WHERE c_custkey % 8 <> 1),
children AS (
  SELECT 'districts' AS child, 'state_code' AS col, 'indian_states' AS parent, state_code AS v FROM districts
  UNION ALL SELECT 'cities', 'state_code', 'indian_states', state_code FROM cities UNION ALL SELECT 'cities', 'district_id', 'districts', district_id FROM cities
  UNION ALL SELECT 'articles', 'source_id', 'news_sources', source_id FROM articles
  UNION ALL SELECT unnest(['article_labels', 'article_countries', 'article_districts', 'article_cities']), 'article_id', 'articles', article_id FROM docs
  UNION ALL SELECT 'article_states', 'article_id', 'articles', article_id FROM article_states UNION ALL SELECT 'article_states', 'state_code', 'indian_states', state_code FROM article_states
  UNION ALL SELECT 'article_districts', 'district_id', 'districts', 'district-' || doc_id % 50 FROM docs UNION ALL SELECT 'article_cities', 'city_id', 'cities', 'city-' || doc_id % 50 FROM docs
  UNION ALL SELECT 'user_favorite_countries', 'user_id', 'app_users', user_id FROM favorite_countries UNION ALL SELECT 'user_favorite_states', 'user_id', 'app_users', user_id FROM favorite_states
  UNION ALL SELECT 'user_favorite_states', 'state_code', 'indian_states', state_code FROM favorite_states
  UNION ALL SELECT 'state_news_rankings', 'state_code', 'indian_states', state_code FROM rankings UNION ALL SELECT 'state_news_rankings', 'article_id', 'articles', article_id FROM rankings),
judged AS (SELECT c.child, c.col, c.parent, c.v, p.v IS NULL AS orphan FROM children c LEFT JOIN (SELECT DISTINCT parent, v FROM parents) p ON c.parent = p.parent AND c.v = p.v)
SELECT child AS table_name, col AS column_name, parent AS parent_table, count(DISTINCT v) FILTER (WHERE orphan) AS orphan_values, count(*) FILTER (WHERE orphan) AS orphan_rows
FROM judged GROUP BY ALL)""")
def d19(t: Tables) -> DataFrame:
    """Every declared foreign key over its whole tables, with some parents taken away."""
    tables = relational_tables(t)
    tables["articles"] = tables["articles"].filter("doc_id % 9 <> 4")
    tables["districts"] = t.base("part").filter("p_size <> 7").select(
        F.expr("concat('district-', p_partkey)").alias("id"), F.expr("concat('N-', lpad(cast(p_partkey % 25 as string), 2, '0'))").alias("state_code")
    )
    tables["app_users"] = tables["app_users"].filter("c_custkey % 8 <> 1")
    tables["indian_states"] = tables["indian_states"].filter("code <> 'N-24'")
    checks = [
        audits.orphans(tables[child], column, tables[parent], key).agg(
            F.lit(child).alias("table_name"), F.lit(column).alias("column_name"), F.lit(parent).alias("parent_table"),
            F.count("*").alias("orphan_values"), F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"),
        )
        for child, column, parent, key in audits.FOREIGN_KEYS
    ]
    return reduce(DataFrame.unionByName, checks)


def proposed_rankings(t: Tables) -> DataFrame:
    """The bound rankings with one broken rule in some snapshots."""
    k = F.expr("cast(substring(state_code, 3) as int)")
    return t.rankings.withColumn("k", k).withColumn(
        "rank_position",
        F.expr("cast(case when k % 6 = 1 and rank_position = 2 then 1 when k % 6 = 2 then rank_position + 1 else rank_position end as smallint)"),
    ).withColumn(
        "ranking_score", F.expr("cast(if(k % 6 = 3, -ranking_score - 1, ranking_score) as decimal(12,4))")
    )


PROPOSED = """
SELECT *, CAST(substring(state_code, 3) AS INTEGER) AS k, count(*) OVER (PARTITION BY state_code, ranking_date) AS n FROM rankings"""


@query("d20_ranking_rules", "rankings", f"""
SELECT DISTINCT state_code, ranking_date, n, CASE WHEN k % 6 = 1 AND n > 1 THEN 'repeated_position' WHEN k % 6 = 2 AND n = 10 THEN 'position_out_of_range'
  WHEN k % 6 = 2 THEN 'positions_not_sequential' WHEN k % 6 = 3 THEN 'negative_score' ELSE 'ok' END AS outcome FROM ({PROPOSED})""")
def d20(t: Tables) -> DataFrame:
    return rankings.snapshot_errors(proposed_rankings(t)).select(
        "state_code", F.date_format("ranking_date", "yyyy-MM-dd").alias("ranking_date"), "n",
        F.coalesce("ranking_error", F.lit("ok")).alias("outcome"),
    )


def favorite_changes(t: Tables) -> DataFrame:
    """customer as favourite-country changes, some of them invalid, some empty."""
    lists = F.expr(
        "case c_custkey % 6 when 0 then array(' us ', 'in') when 1 then array('us', 'in', 'gb') when 2 then array('us', ' US') "
        "when 3 then array('USA') when 4 then array('fr') else cast(array() as array<string>) end"
    )
    return t.base("customer").select(F.expr("cast(c_custkey as string)").alias("user_id"), "c_custkey", lists.alias("country_codes"))


@query("d21_favorite_country_rules", sql="""
SELECT c_custkey, CASE c_custkey % 6 WHEN 1 THEN 'too_many_countries' WHEN 2 THEN 'repeated_country' WHEN 3 THEN 'country_code_invalid' ELSE 'ok' END AS outcome FROM customer""")
def d21(t: Tables) -> DataFrame:
    error = mutations.favorite_country_error(F.col("country_codes"))
    return favorite_changes(t).select("c_custkey", F.coalesce(error, F.lit("ok")).alias("outcome"))


@query("d22_result_limit", "docs", "SELECT article_id AS id FROM docs ORDER BY published_at DESC, article_id LIMIT 200")
def d22(t: Tables) -> DataFrame:
    return serving.list_recent(t.articles, serving.check_limit(200)).select("id")


@query("d23_region_type_rule", "states", "SELECT code, name FROM states WHERE region_type = 'union_territory'")
def d23(t: Tables) -> DataFrame:
    return serving.list_states(t.states, "union_territory", active_only=False).select("code", "name")


@query("d24_feed_registry_audit", "sources", """
SELECT 'source_id' AS check_name, count(*) AS problems FROM (SELECT 'feed-' || (s_suppkey // 2) AS k FROM sources GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'feed_url', 0 UNION ALL SELECT 'limit_invalid', count(*) FILTER (WHERE s_suppkey % 210 NOT BETWEEN 1 AND 200) FROM sources
UNION ALL SELECT 'language_invalid', count(*) FILTER (WHERE s_suppkey % 210 BETWEEN 1 AND 200 AND s_suppkey % 13 = 4) FROM sources""")
def d24(t: Tables) -> DataFrame:
    """supplier as feed registrations: repeated ids, repeated URLs, broken field rules."""
    feeds = t.sources.select(
        F.expr("concat('feed-', s_suppkey div 2)").alias("source_id"), "name", F.concat("homepage_url", F.lit("rss")).alias("feed_url"),
        F.expr("if(s_suppkey % 13 = 4, 'english', 'en-GB')").alias("language_code"), F.lit("Energy").alias("default_category"),
        F.lit("auto").alias("expected_format"), F.expr("cast(s_suppkey % 210 as int)").alias("max_articles_per_fetch"),
    )
    repeated = [
        audits.repeated_keys(feeds, [k]).agg(F.lit(k).alias("check_name"), F.count("*").alias("problems")) for k in ("source_id", "feed_url")
    ]
    # Language is checked before the limit, so count the limit problems among the others too.
    broken = feeds.agg(
        F.count_if(~F.col("max_articles_per_fetch").between(1, fixed.MAX_FEED_RECORDS)).alias("limit_invalid"),
        F.count_if((registry.feed_rule_errors() == "language_invalid") & F.col("max_articles_per_fetch").between(1, fixed.MAX_FEED_RECORDS)).alias("language_invalid"),
    )
    pairs = [F.struct(F.lit(n).alias("check_name"), F.col(n).alias("problems")) for n in ("limit_invalid", "language_invalid")]
    return reduce(DataFrame.unionByName, [*repeated, broken.select(F.explode(F.array(*pairs)).alias("r")).select("r.*")])


@query("d25_region_catalog_audit", "states", """
SELECT count(*) AS total, count(*) FILTER (WHERE is_active) AS active, count(*) FILTER (WHERE region_type = 'state') AS states,
  count(*) FILTER (WHERE region_type = 'union_territory') AS territories, count(DISTINCT code) AS codes, count(DISTINCT short_code) AS short_codes, count(DISTINCT name) AS names FROM states""")
def d25(t: Tables) -> DataFrame:
    return registry.region_audit(t.states)


@query("d26_run_arguments", "requests", "SELECT 'Wire' AS provider, count(*) AS n FROM requests")
def d26(t: Tables) -> DataFrame:
    provider, _, _ = serving.check_run(" Wire ", 25, " 24h ")
    return t.message_requests.filter(F.col("provider") == provider).groupBy("provider").agg(F.count("*").alias("n"))


@query("d27_active_filter", "sources states", """
SELECT 'sources' AS entity, count(*) AS n FROM sources WHERE is_active UNION ALL SELECT 'states', count(*) FROM states WHERE is_active""")
def d27(t: Tables) -> DataFrame:
    count = lambda df, name: df.filter("is_active").agg(F.lit(name).alias("entity"), F.count("*").alias("n"))
    return count(t.sources, "sources").unionByName(count(t.states, "states"))


@query("d28_queue_record_checks", sql="""
SELECT CASE event_id // 10 % 47 WHEN 5 THEN 'records_not_a_list' WHEN 9 THEN 'message_id_missing' ELSE 'ok' END AS event_status,
  count(DISTINCT event_id // 10) AS batches, count(*) FILTER (WHERE event_id // 10 % 47 NOT IN (5, 9) AND event_id % 71 = 3) AS failed_records FROM events GROUP BY ALL""")
def d28(t: Tables) -> DataFrame:
    from broadsheet.plans.scans import queue_events

    records, errors = messages.parse_events(queue_events(t))
    ok = records.agg(
        F.lit("ok").alias("event_status"), F.countDistinct("batch").alias("batches"), F.count_if(F.col("body").isNull()).alias("failed_records")
    )
    return ok.unionByName(
        errors.groupBy(F.col("event_error").alias("event_status")).agg(F.count("*").alias("batches"), F.lit(0).cast("bigint").alias("failed_records"))
    )
