"""Fixture cases with known outcomes, run through the Spark jobs."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from broadsheet.functions import codes, text, times, urls
from broadsheet.operators import audits, conform, dedup, lake, mutations, rankings, serving
from broadsheet.sources import api_json, feed_xml, messages, registry


def values(spark, column, rows, schema="s string"):
    df = spark.createDataFrame([(r,) for r in rows], schema).coalesce(1)
    return [r[0] for r in df.select(column(F.col("s")).alias("v")).collect()]


HTML = {
    "plain  text": "plain text", "<p>Hello <b>x</b>y</p><script>bad('<p>')</script>": "Hello x y", "a &amp;lt; b": "a < b", "AT&T": "AT&T",
    "&eacute;t": "ét", "<p>x<br/>y": "x y", "a < b": "a < b", "a<3": "a < 3", "\xa0  ": None, "<!-- c -->z": "z", "<script>unclosed": None,
    '<a href="x>y">t</a>': "t", "&copy;2024 &amp;copy;": "©2024 ©", "": None, None: None, "<p": "< p", "x</scr": "x < /scr", "a\u2003b": "a b",
    "<style>p{}</style>t<title>u</title>": "t u", "&#8217;s": "’s", "&notit;": "¬it;", "<script/>y": "y", "x<script>1</style>2</script >3": "x 3",
    "a</script>b<style>c</STYLE >d": "a b d", "x<![CDATA[q>r]]>s": "x s", "x<?pi a?>z<!doctype html>": "x z", "x<!-- open": "x < !-- open",
    "x<!--y--!>z": "x <!--y--!> z", "x</>y</1>z": "x y z", "a<1b>c": "a < 1b>c", "<noscript><b>q</b></noscript>z": "q z", "a <i title='<b>'>c": "a c",
    "<a href=\"open": '< a href="open', "&ampamp; &#60;b>": "& <b>",
}


def test_html_to_text(spark):
    """The scanner and the native patterns before it give the stated texts."""
    assert {h: text.visible_text(h) for h in HTML} == HTML
    df = text.with_clean_text(spark.createDataFrame([(h,) for h in HTML], "s string").coalesce(1), {"v": F.col("s")})
    assert {r.s: r.v for r in df.collect()} == HTML


def test_native_patterns_agree_with_the_scanner(spark):
    pieces = ["<b>", "</b>", "<script>", "</script>", "<style a='x>y'>", "</style>", "<!-- c -->", "<!--", "<br/>", "<", " a", ">", "&amp;", "&lt;", "&#60;", "<3", "--!>", "<p class="]
    rnd = random.Random(8)
    made = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 6))) for _ in range(3_000)]
    df = spark.createDataFrame([(m,) for m in made], "s string").select("s", text.clean_html_native(F.col("s")).alias("n"), text.native_text(F.col("s")).isNull().alias("open"))
    rows = df.collect()
    assert [r.s for r in rows if not r.open and r.n != text.visible_text(r.s)] == []
    assert sum(not r.open for r in rows) > 400


def test_timespans(spark):
    got = values(spark, times.timespan_seconds, ["24h", "7D", "2weeks", "3months", "10min", "1m", "1month", "5x"])
    assert got == [86400, 604800, 1209600, 7776000, 600, 2592000, 2592000, None]
    assert values(spark, times.valid_request_timespan, ["7D", "24H", "1month", "0h"]) == [True, True, False, False]


def test_dates(spark):
    got = values(spark, times.feed_time, [
        "Wed, 24 Jun 2026 14:30:00 GMT", "24 Jun 26 1:02 EST", "Thu, 01 Jan 2026 10:00:00 +0530", "2026-06-25T14:30:00+05:30",
        "20260625T143000Z", "20260625123000", "2026-06-25", "yesterday", "2026-13-01", None,
    ])
    assert [v and v.strftime("%m-%d %H:%M") for v in got] == [
        "06-24 14:30", "06-24 06:02", "01-01 04:30", "06-25 09:00", "06-25 14:30", "06-25 12:30", "06-25 00:00", None, None, None,
    ]


def test_urls(spark):
    cases = {
        "HTTP://Example.COM": "http://example.com/", "https://example.com:443/a/../b/./c?x=1#f": "https://example.com/b/c?x=1#f",
        "http://ex.com/a b?q=é#ü": "http://ex.com/a%20b?q=%C3%A9#%C3%BC", "https://bücher.de/x": "https://xn--bcher-kva.de/x",
        "ftp://x": None, "not": None, "http://": None, "http://a.b:99999": None, "http://u:p@H.com:8080": "http://u:p@h.com:8080/",
        "https://example.com?x=1": "https://example.com/?x=1", "http://ex.com/a/..": "http://ex.com/", "http://ex ample.com": None,
        "https://x.com/" + "a" * 2083: None, "http://e.com/" + "../" * 400_000 + "x": "http://e.com/x",
    }
    assert values(spark, urls.normalize_url, list(cases)) == list(cases.values())
    uris = ["s3://b/k", " s3://b/k ", "s3://b", "s3://b/", "s3:///k", "http://b/k", "s3:// / "]
    assert values(spark, urls.is_storage_uri, uris) == [True, True, False, False, False, False, False]


def test_slug_and_paths(spark):
    assert values(spark, text.slug, ["Politics & Diplomacy", "  ", "Straße"]) == ["politics-diplomacy", "unknown", "strasse"]
    with pytest.raises(ValueError):
        lake.check_partition_names({"year": 1})
    with pytest.raises(ValueError):
        lake.article_uri("b", "raw")


def test_scores(spark):
    rows = [{" us ": "0.5", "US": "0.7", "in": "1"}, {"": "1"}, {"a": "1.00001"}, {"a": "x"}, {"a": "-0.01"}, None]
    assert values(spark, codes.scores_error, rows, "s map<string,string>") == [
        None, "score_code_empty", "score_out_of_range", "score_not_numeric", "score_out_of_range", None,
    ]
    first = values(spark, codes.normalized_scores, rows[:1], "s map<string,string>")[0]
    assert {k: str(v) for k, v in first.items()} == {"US": "0.7000", "IN": "1.0000"}


def test_api_payload(spark):
    articles = [
        {"url": "https://press.test/a", "title": "One", "seendate": "20260411T081500Z", "socialimage": "https://press.test/i.jpg",
         "domain": "press.test", "language": "English", "sourcecountry": "India"},
        {"url": "https://wire.gazette.test/b", "title": "Two", "seendate": "20260412060000", "socialimage": "no picture",
         "language": "English", "sourcecountry": "United States"},
        {"url": "", "title": "Three", "seendate": "20260413T000000Z"}, 42, {"url": "https://other.test/c", "title": " "},
    ]
    bodies = [json.dumps({"articles": articles}), "[]", "{}", '{"articles": {}}', '{"articles": null}', "nope"]
    raw = spark.createDataFrame([(str(i), b, "api") for i, b in enumerate(bodies)], "payload_id string, body string, provider string")
    parsed = api_json.parse_payloads(raw)
    errors = {r.payload_id: r.payload_error for r in api_json.payload_errors(parsed).collect()}
    assert errors == {"1": "top_level_not_object", "2": "articles_missing", "3": "articles_not_list", "4": "articles_missing", "5": "invalid_json"}
    mapped = api_json.map_records(api_json.explode_records(parsed), codes.country_catalog(spark), codes.language_catalog(spark))
    rows = mapped.orderBy("pos").collect()
    assert [r.reject_reason for r in rows] == [None, None, "url_empty", "not_an_object", "title_empty"]
    assert (rows[0].source_country_code, rows[0].language_code, rows[1].source_country_code) == ("IN", "en", "US")
    assert (rows[1].source_name, rows[1].image_url, rows[4].reject_source_id) == ("wire.gazette.test", None, "https://other.test/c")


FEED = """<?xml version="1.0"?><rss version="2.0" xmlns:media="http://search.yahoo.com/mrss/"><channel><title>T</title>
<item><title>Gap in link</title><link> https://press.test/a </link><description><![CDATA[<p>Harbour <b>test</b></p>]]></description>
<pubDate>Tue, 14 Apr 2026 07:10:00 GMT</pubDate><media:content url="https://press.test/i.jpg" type="image/jpeg"/></item>
<item><title>Again</title><link>https://press.test/a</link><pubDate>Tue, 14 Apr 2026 07:12:00 GMT</pubDate></item>
<item><title>Regatta</title><link>https://press.test/b</link><pubDate>Mon, 13 Apr 2026 21:00:00 GMT</pubDate>
<enclosure url="https://press.test/e.png" type="image/png"/></item>
<item><title></title><link>https://press.test/c</link><guid>g-3</guid><pubDate>Mon, 13 Apr 2026 20:00:00 GMT</pubDate></item>
<item><title>Old</title><link>https://press.test/d</link><pubDate>Sun, 01 Feb 2026 10:00:00 GMT</pubDate></item></channel></rss>"""


def feed(spark, rows):
    schema = "payload_id string, body string, query string, cap int"
    raw = spark.createDataFrame(rows, schema)
    for name, value in {
        "timespan": "7d", "provider": "feed", "source_id": "s", "source_name": "Feed", "source_homepage_url": "https://press.test/",
        "source_country_code": "US", "default_category": "General", "feed_language": "en", "expected_format": "atom",
    }.items():
        raw = raw.withColumn(name, F.lit(value))
    return feed_xml.parse_feeds(raw)


def test_feed_decisions(spark):
    parsed = feed(spark, [("all", FEED, "", 25), ("harbour", FEED, "HARBOUR", 25), ("one", FEED, "", 1), ("empty", "", "", 25), ("html", "<html/>", "", 25)])
    errors = {r.payload_id: r.payload_error for r in parsed.filter("payload_error is not null").collect()}
    assert errors == {"empty": "parse_error_without_entries", "html": "unknown_format_without_entries"}
    mapped = feed_xml.map_entries(feed_xml.explode_entries(parsed))
    as_of = F.lit("2026-04-15 09:00:00").cast("timestamp")
    rows = feed_xml.decide_entries(mapped, as_of).orderBy("payload_id", "pos").collect()
    status = {}
    for r in rows:
        status.setdefault(r.payload_id, []).append(r.status)
    assert status["all"] == ["accepted", "duplicate", "accepted", "rejected", "filtered"]
    assert status["harbour"] == ["accepted", "duplicate", "filtered", "rejected", "filtered"]
    assert status["one"] == ["accepted", "unread", "unread", "unread", "unread"]
    first = [r for r in rows if r.payload_id == "all"]
    assert (first[0].description, first[0].image_url, first[2].image_url) == ("Harbour test", "https://press.test/i.jpg", "https://press.test/e.png")
    assert first[3].reject_source_id == "g-3"
    assert parsed.filter(feed_xml.format_mismatch()).count() == 3


def test_message_rules(spark):
    good = {"provider": "p", "raw_s3_uri": "s3://b/k", "article_payload": {}, "country_scores": {"us": 1, " in ": 0.5}}
    cases = [
        (good, None), ({**good, "retry_count": 5}, None), ({**good, "retry_count": 6}, "retry_count_invalid"),
        ({**good, "extra": 1}, "unknown_field"), ({**good, "raw_s3_uri": "s3://b"}, "raw_uri_invalid"),
        ({**good, "country_scores": {"a": 2}}, "score_out_of_range"), ({**good, "primary_state_code": "x"}, "primary_state_missing"),
        ({**good, "primary_state_code": "x", "state_scores": {"X": 1}}, None), ({**good, "country_scores": None}, None),
        ({**good, "country_scores": []}, "country_scores_not_object"), ({**good, "provider": " "}, "provider_invalid"),
        ({**good, "message_type": "other"}, "message_type_invalid"),
    ]
    df = spark.createDataFrame([(i, json.dumps(c[0])) for i, c in enumerate(cases)], "i int, body string")
    rows = messages.parse_messages(df).orderBy("i").collect()
    assert [r.message_error for r in rows] == [c[1] for c in cases]
    assert sorted(rows[0].country_scores) == ["IN", "US"]
    broken = spark.createDataFrame([(0, "{oops"), (1, "[1]")], "i int, body string")
    assert [r.message_error for r in messages.parse_messages(broken).orderBy("i").collect()] == ["invalid_json", "not_an_object"]


def test_article_document(spark):
    doc = {
        "title": " T ", "url": "https://example.com/a", "source": {"name": "S", "source_type": "RSS", "country_code": "in"},
        "published_at": "2026-06-25T14:30:00+05:30", "country_codes": ["in", "US", "in"], "keywords": ["Energy", " energy ", "India", ""],
        "social_card": {"headline": "h"},
    }
    cases = [doc, {**doc, "url": "x"}, {**doc, "content_hash": "ab"}, {**doc, "country_codes": ["XX"]}, {**doc, "other": 1},
             {**doc, "source": {**doc["source"], "credibility_score": 101}}, {**doc, "source": {**doc["source"], "country_code": "IND"}}]
    df = spark.createDataFrame([(i, json.dumps(c)) for i, c in enumerate(cases)], "i int, document string")
    rows = messages.parse_articles(df, "document", codes.country_catalog(spark)).orderBy("i").collect()
    assert [r.article_error for r in rows] == [
        None, "url_invalid", "content_hash_invalid", "country_code_invalid", "unknown_field", "credibility_invalid", "source_country_invalid",
    ]
    r = rows[0]
    assert (r.title, r.country_codes, r.keywords, r.source_country_code) == ("T", ["IN", "US"], ["Energy", "India"], "IN")
    assert r.published_at == dt.datetime(2026, 6, 25, 9, 0) and r.social_card.template_name == "standard"


def test_favourites_rankings_regions(spark):
    lists = [[" us ", "in"], ["us", "in", "gb"], ["us", "US"], ["USA"], []]
    assert values(spark, mutations.favorite_country_error, lists, "s array<string>") == [
        None, "too_many_countries", "repeated_country", "country_code_invalid", None,
    ]
    key = ("S", dt.date(2026, 6, 25), "24h", "all")
    schema = "state_code string, ranking_date date, ranking_window string, category_filter string, article_id string, rank_position int, ranking_score double"
    make = lambda state, pairs: [(state, *key[1:], f"a{i}", p, s) for i, (p, s) in enumerate(pairs)]
    rows = make("ok", [(i, 1.0) for i in range(1, 11)]) + make("rep", [(1, 1.0), (1, 1.0)]) + make("two", [(2, 1.0)]) + make("neg", [(1, -1.0)])
    got = {r.state_code: r.ranking_error for r in rankings.snapshot_errors(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"ok": None, "rep": "repeated_position", "two": "positions_not_sequential", "neg": "negative_score"}
    audit = registry.region_audit(registry.region_catalog(spark)).first()
    assert (audit.total, audit.states, audit.territories, audit.codes, audit.names) == (36, 28, 8, 36, 36)
    feeds = registry.feed_registry(spark)
    assert feeds.filter(registry.feed_rule_errors().isNotNull()).count() == 0
    assert audits.repeated_keys(feeds, ["feed_url"]).count() == 0
    for bad in (0, 201):
        with pytest.raises(ValueError):
            serving.check_limit(bad)
    with pytest.raises(ValueError):
        serving.list_states(feeds, "province")


def test_empty_snapshot_still_deletes(spark):
    schema = "state_code string, ranking_date string, ranking_window string, category_filter string, article_id string, rank_position int, ranking_score double"
    stored = spark.createDataFrame([("A", "d", "24h", "all", "x", 1, 1.0), ("B", "d", "24h", "all", "y", 1, 1.0)], schema)
    touched = spark.createDataFrame([("A", "d", "24h", "all")], "state_code string, ranking_date string, ranking_window string, category_filter string")
    left = rankings.replace_top_ten(stored, touched, stored.limit(0)).collect()
    assert [r.state_code for r in left] == ["B"]


def test_failed_rows_write_nothing(spark):
    schema = (
        "seq bigint, article_id string, url string, canonical_url string, content_hash string, source_name string, source_type string, "
        "country_scores map<string,decimal(5,4)>, state_scores map<string,decimal(5,4)>, primary_state_code string"
    )
    rows = [
        (0, "a", "u0", None, None, "S", "RSS", {"USA": None}, {}, None), (1, "b", "u1", None, None, "S", "RSS", {}, {"ZZ": None}, None),
        (2, "c", "u2", None, None, "S", "RSS", {}, {}, "ZZ"), (3, "d", "u0", None, None, "S", "RSS", {}, {}, None),
    ]
    states = spark.createDataFrame([("N-01",)], "code string")
    df = spark.createDataFrame(rows, schema).withColumn("_e", conform.request_errors(states.agg(F.collect_set("code").alias("c")).scalar()))
    assert [r._e for r in df.orderBy("seq").collect()] == ["country_code_length", "state_unknown", "primary_state_missing", None]
    narrow = df.withColumn("unfit", F.col("_e").isNotNull())
    got = {r.seq: r.status for r in dedup.dedup_ordered(narrow).collect()}
    assert got == {0: "failed", 1: "failed", 2: "failed", 3: "stored"}


def test_limits_outside_the_contract_are_refused(spark):
    rows = [("p", i, i) for i in range(260)]
    mapped = spark.createDataFrame(rows, "payload_id string, pos int, n int").withColumn("published_at", F.timestamp_seconds("n"))
    kept = lambda most: api_json.newest_per_payload(mapped.withColumn("max_records", F.lit(most))).count()
    assert (kept(250), kept(3)) == (250, 3)
    for most in (251, 0):
        with pytest.raises(Exception, match="max_records_invalid"):
            kept(most)
    items = "".join(f"<item><title>T{i}</title><link>https://press.test/{i}</link><pubDate>14 Apr 2026 07:00:00 GMT</pubDate></item>" for i in range(260))
    body = f'<?xml version="1.0"?><rss version="2.0"><channel><title>T</title>{items}</channel></rss>'

    def accepted(cap):
        mapped = feed_xml.map_entries(feed_xml.explode_entries(feed(spark, [("all", body, "", cap)])))
        return feed_xml.decide_entries(mapped, F.lit("2026-04-15 09:00:00").cast("timestamp")).filter("status = 'accepted'").count()

    assert accepted(200) == 200
    with pytest.raises(Exception, match="max_records_invalid"):
        accepted(201)


def test_shared_folder_is_needed_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from broadsheet.session import shared_root

    context = SimpleNamespace(master="spark://head:7077", getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(SimpleNamespace(conf={}, sparkContext=context))
