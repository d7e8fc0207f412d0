"""Section J: scalar functions as column jobs over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.functions import codes, text, times, urls
from broadsheet.plans.bindings import NATION_COUNTRIES, TIMESPANS, Tables, pick, stamp
from broadsheet.plans.lookups import TS
from broadsheet.plans.registry import query

PAGE_TEXT = """trim(regexp_replace(replace(replace(replace(replace(
  regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', ' ', 'g'), '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', ' ', 'g'), '<[^>]*>', ' ', 'g'),
  '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '\\s+', ' ', 'g'))"""


@query("j1_html_to_text", sql=f"SELECT page_id, length(t) AS n_chars, sha256(t) AS text_hash FROM (SELECT page_id, {PAGE_TEXT} AS t FROM pages)")
def j1(t: Tables) -> DataFrame:
    """Whole pages to plain text."""
    cleaned = text.with_clean_text(t.base("pages"), {"plain": F.col("html")})
    return cleaned.select("page_id", F.length("plain").cast("bigint").alias("n_chars"), F.sha2("plain", 256).alias("text_hash"))


SPAN_SECONDS = "([86400, 604800, 600, 1209600, 2592000, -1, 7776000, 900])[CAST(c_custkey % 8 AS INTEGER) + 1]"


@query("j2_timespan_to_duration", sql=f"SELECT c_custkey, CAST({SPAN_SECONDS} AS BIGINT) AS seconds FROM customer")
def j2(t: Tables) -> DataFrame:
    seconds = times.timespan_seconds(pick(TIMESPANS, "c_custkey % 8"))
    return t.base("customer").select("c_custkey", F.coalesce(seconds, F.lit(-1)).alias("seconds"))


@query("j3_timespan_normalise", sql="""
SELECT span, span NOT IN ('1month', '5x') AS valid, count(*) AS n FROM (
  SELECT trim(lower((['24h', ' 7D ', '10min', '2weeks', '1month', '5x', '3months', '15min'])[CAST(c_custkey % 8 AS INTEGER) + 1])) AS span FROM customer) GROUP BY ALL""")
def j3(t: Tables) -> DataFrame:
    raw = t.base("customer").select(pick(TIMESPANS, "c_custkey % 8").alias("raw"))
    return raw.groupBy(times.normalize_timespan(F.col("raw")).alias("span"), times.valid_request_timespan(F.col("raw")).alias("valid")).agg(
        F.count("*").alias("n")
    )


@query("j4_api_date", "api_raw", f"SELECT event_id, coalesce({TS.format('published_at')}, '') AS published_at FROM api_raw")
def j4(t: Tables) -> DataFrame:
    parsed = stamp(times.api_time(F.col("seendate")))
    return t.api_raw_records.select("event_id", F.coalesce(parsed, F.lit("")).alias("published_at"))


@query("j5_feed_date", "docs", f"""
SELECT doc_id, CASE WHEN doc_id % 41 = 11 THEN '' ELSE strftime(TIMESTAMP '2026-06-25 12:00:00' - to_days(CAST(doc_id % 12 AS INTEGER)), '%Y-%m-%d %H:%M:%S') END AS published_at FROM docs""")
def j5(t: Tables) -> DataFrame:
    parsed = stamp(times.feed_time(F.col("published_text")))
    return t.feed_raw_entries.select("doc_id", F.coalesce(parsed, F.lit("")).alias("published_at"))


@query("j6_utc_datetime", sql="""
SELECT event_id, strftime(date_trunc('second', ts) - CASE WHEN event_id % 2 = 0 THEN INTERVAL 330 MINUTE ELSE INTERVAL 0 MINUTE END, '%Y-%m-%d %H:%M:%S') AS utc FROM events""")
def j6(t: Tables) -> DataFrame:
    """Zoned text is converted, text without a zone counts as UTC."""
    zoned = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.expr("if(event_id % 2 = 0, '+05:30', '')"))
    return t.base("events").select("event_id", stamp(times.iso_time(zoned)).alias("utc"))


@query("j7_casefold", sql="SELECT doc_id, sha256(replace(lower(text), 'ß', 'ss')) AS folded_hash FROM documents")
def j7(t: Tables) -> DataFrame:
    return t.base("documents").select("doc_id", F.sha2(text.fold(F.col("text")), 256).alias("folded_hash"))


@query("j8_url_normalise", sql="""
SELECT page_id, url AS plain, 'https://' || regexp_extract(url, '//([^/?#]*)', 1) || '/b/c%20d?q=%C3%A9' || coalesce(nullif(regexp_extract(url, '(#.*)$', 1), ''), '') AS rebuilt,
  page_id % 2 = 0 AS is_http FROM pages""")
def j8(t: Tables) -> DataFrame:
    host = urls.url_netloc(F.col("url"))
    messy = F.concat(F.lit(" HTTPS://"), F.upper(host), F.lit(":443/a/../b/./c d?q=é"), F.regexp_extract("url", "(#.*)$", 1))
    other = F.expr("if(page_id % 2 = 0, url, concat('ftp://', page_id))")
    return t.base("pages").select(
        "page_id", urls.normalize_url(F.col("url")).alias("plain"), urls.normalize_url(messy).alias("rebuilt"),
        urls.normalize_url(other).isNotNull().alias("is_http"),
    )


@query("j9_keyword_list", sql="""
SELECT c_custkey, CASE WHEN lower(c_mktsegment) = 'building' THEN c_mktsegment ELSE c_mktsegment || ',Building' END || ',' || c_name AS keywords FROM customer""")
def j9(t: Tables) -> DataFrame:
    words = F.array(F.col("c_mktsegment"), F.lit(""), F.lit(" Building "), F.lower("c_mktsegment"), F.col("c_name"), F.upper("c_name"))
    return t.base("customer").select("c_custkey", F.array_join(text.keyword_list(words), ",").alias("keywords"))


@query("j10_country_code_list", sql=f"""
SELECT c_custkey, CASE WHEN code = 'US' THEN 'US' ELSE code || ',US' END AS codes FROM (
  SELECT c_custkey, ([{", ".join(f"'{c}'" for c, _ in NATION_COUNTRIES)}])[CAST(c_nationkey AS INTEGER) + 1] AS code FROM customer)""")
def j10(t: Tables) -> DataFrame:
    own = pick([c for c, _ in NATION_COUNTRIES], "c_nationkey")
    return t.base("customer").select(
        "c_custkey", F.array_join(text.code_list(F.array(F.lower(own), F.lit(" us "), own)), ",").alias("codes")
    )


@query("j11_text_to_decimal", sql="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber = 7 THEN CAST(-1 AS DECIMAL(5,4)) ELSE CAST(l_discount AS DECIMAL(5,4)) END AS score FROM lineitem""")
def j11(t: Tables) -> DataFrame:
    number = F.when(F.col("l_linenumber") == 7, "n/a").otherwise(F.concat(F.lit(" "), F.col("l_discount").cast("string")))
    score = F.coalesce(codes.to_decimal(number).cast("decimal(5,4)"), F.lit(-1).cast("decimal(5,4)"))
    return t.base("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", score.alias("score"))


@query("j12_code_normalise", sql="""
SELECT coalesce(code, 'none') AS code, count(*) AS n FROM (SELECT CASE WHEN p_size % 10 = 0 THEN NULL ELSE upper(p_type) END AS code FROM part) GROUP BY ALL""")
def j12(t: Tables) -> DataFrame:
    given = F.expr("if(p_size % 10 = 0, '   ', concat(' ', lower(p_type), ' '))")
    return t.base("part").groupBy(F.coalesce(text.code(given), F.lit("none")).alias("code")).agg(F.count("*").alias("n"))


@query("j13_truncate", sql="SELECT doc_id, length(substring(text, 1, 2000)) AS n_chars, sha256(substring(text, 1, 2000)) AS cut_hash FROM documents")
def j13(t: Tables) -> DataFrame:
    cut_text = text.truncate(F.col("text"), 2000)
    return t.base("documents").select("doc_id", F.length(cut_text).cast("bigint").alias("n_chars"), F.sha2(cut_text, 256).alias("cut_hash"))


@query("j14_country_name", sql=f"""
SELECT c_custkey, ([{", ".join(f"'{n}'" for _, n in NATION_COUNTRIES)}])[CAST(c_nationkey AS INTEGER) + 1] AS country FROM customer""")
def j14(t: Tables) -> DataFrame:
    coded = t.base("customer").select("c_custkey", pick([c for c, _ in NATION_COUNTRIES], "c_nationkey").alias("country_code"))
    return coded.join(F.broadcast(codes.iso_codes(t.countries)), "country_code").select("c_custkey", F.col("country_name").alias("country"))


@query("j15_message_round_trip", sql="SELECT o_orderkey, o_orderstatus, TRUE AS same FROM orders")
def j15(t: Tables) -> DataFrame:
    schema = "o_orderkey bigint, o_orderstatus string, o_orderpriority string"
    body = F.to_json(F.struct("o_orderkey", "o_orderstatus", "o_orderpriority"))
    back = t.base("orders").select("o_orderkey", "o_orderpriority", F.from_json(body, schema).alias("m"))
    return back.select("o_orderkey", "m.o_orderstatus", (F.col("m.o_orderpriority") == F.col("o_orderpriority")).alias("same"))


@query("j16_bytes_to_text", sql="SELECT doc_id, sha256(text || CASE WHEN doc_id % 2 = 0 THEN '�' ELSE '' END) AS text_hash FROM documents")
def j16(t: Tables) -> DataFrame:
    """Bytes to text; a broken sequence becomes the replacement character."""
    raw = F.concat(F.encode("text", "UTF-8"), F.expr("if(doc_id % 2 = 0, X'FF', X'')"))
    return t.base("documents").select("doc_id", F.sha2(F.make_valid_utf8(raw.cast("string")), 256).alias("text_hash"))
