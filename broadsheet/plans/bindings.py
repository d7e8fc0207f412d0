"""The given tables read as news entities.

``Tables`` exposes each entity as a lazy DataFrame; ``VIEWS`` holds the same bindings as SQL
for the side-by-side check. The rules only rename, combine and vary columns: every entity
covers its whole base table.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet import fixed
from broadsheet.functions import codes, text
from broadsheet.session import configure, cut

# Country of each nation key, in key order.
NATION_COUNTRIES = (
    ("AR", "Argentina"), ("AU", "Australia"), ("BR", "Brazil"), ("CA", "Canada"), ("CN", "China"),
    ("EG", "Egypt"), ("FR", "France"), ("DE", "Germany"), ("IN", "India"), ("ID", "Indonesia"),
    ("IT", "Italy"), ("JP", "Japan"), ("KE", "Kenya"), ("MX", "Mexico"), ("MA", "Morocco"),
    ("NG", "Nigeria"), ("NO", "Norway"), ("PE", "Peru"), ("PL", "Poland"), ("PT", "Portugal"),
    ("ES", "Spain"), ("SE", "Sweden"), ("TH", "Thailand"), ("GB", "United Kingdom"), ("US", "United States"),
)
TIMESPANS = ("24h", " 7D ", "10min", "2weeks", "1month", "5x", "3months", "15min")
LANGUAGES = ("English", "French", " german ", "", "Martian")
AS_OF = "2026-06-25 12:00:00"


def pick(values: tuple[str, ...] | list[str], index: str) -> Column:
    """Element ``index`` (an SQL expression, from 0) of a literal list."""
    return F.get(F.array(*[F.lit(v) for v in values]), F.expr(f"cast({index} as int)"))


def sql_pick(values: tuple[str, ...] | list[str], index: str) -> str:
    quoted = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"([{quoted}])[CAST({index} AS INTEGER) + 1]"


def stamp(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


COUNTRY_CODES = [c for c, _ in NATION_COUNTRIES]
COUNTRY_NAMES = [n for _, n in NATION_COUNTRIES]


class Tables:
    """Entities over one folder of parquet tables."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = configure(spark)
        self.folder = folder

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def spread(self, name: str) -> DataFrame:
        """A base table in partitions of even size, for costly work per row.

        Adaptive execution chooses their number from the measured size, at any scale alike.
        """
        return self.base(name).hint("rebalance")

    def dealt(self, name: str, rows: int = 50_000) -> DataFrame:
        """A base table in partitions of about ``rows`` rows (counted in the file footers): small rows that are costly to work on."""
        table = self.base(name)
        return table.repartition(max(1, -(-table.count() // rows)))

    @cached_property
    def countries(self) -> DataFrame:
        return codes.country_catalog(self.spark)

    @cached_property
    def languages(self) -> DataFrame:
        return codes.language_catalog(self.spark)

    @cached_property
    def states(self) -> DataFrame:
        return self.base("nation").select(
            F.expr("concat('N-', lpad(cast(n_nationkey as string), 2, '0'))").alias("code"),
            F.expr("concat('S', n_nationkey)").alias("short_code"),
            F.col("n_name").alias("name"),
            F.expr("if(n_nationkey % 2 = 0, 'state', 'union_territory')").alias("region_type"),
            F.lit("IN").alias("country_code"), F.lit(None).cast("string").alias("capital"),
            F.expr("cast(n_nationkey + 1 as int)").alias("display_order"),
            F.expr("n_nationkey % 5 <> 0").alias("is_active"),
            F.expr("timestamp'2026-01-01 00:00:00'").alias("created_at"),
            F.expr("timestamp'2026-01-01 00:00:00'").alias("updated_at"),
        )

    @cached_property
    def sources(self) -> DataFrame:
        """supplier as the source dimension."""
        return self.base("supplier").select(
            F.expr("sha2(concat(s_name, '|', " + self._types_sql("s_suppkey") + "), 256)").alias("id"),
            F.col("s_name").alias("name"),
            F.expr(self._types_sql("s_suppkey")).alias("source_type"),
            F.expr("concat('https://s', s_suppkey, '.example.com/')").alias("homepage_url"),
            pick(COUNTRY_CODES, "s_nationkey").alias("country_code"),
            F.expr("cast(floor((s_acctbal + 1000) / 110) as decimal(5,2))").alias("credibility_score"),
            F.expr("s_suppkey % 7 <> 0").alias("is_active"),
            "s_suppkey",
        )

    @staticmethod
    def _types_sql(key: str) -> str:
        quoted = ", ".join(f"'{v}'" for v in fixed.SOURCE_TYPES)
        return f"get(array({quoted}), cast({key} % 5 as int))"

    @cached_property
    def docs(self) -> DataFrame:
        """documents as articles (flat layout plus doc_id and seq)."""
        url = F.expr("concat('https://', source, '.example.com/', lang, '/', doc_id)")
        first = text.collapse(F.substring_index("text", ".", 1))
        title = F.coalesce(F.nullif(text.truncate(first, fixed.TITLE_LENGTH), F.lit("")), F.lit("Untitled"))
        published = F.expr(
            "timestamp'2026-06-01 00:00:00' + make_dt_interval(0, 0, cast(doc_id % 525600 as int), 0)"
        )
        return self.base("documents").select(
            "doc_id", F.col("doc_id").alias("seq"),
            F.sha2(F.concat(F.lit("docs|"), url), 256).alias("article_id"),
            title.alias("title"), F.lit(None).cast("string").alias("description"), F.col("text").alias("content"),
            F.lit(None).cast("string").alias("summary"), url.alias("url"),
            F.lit(None).cast("string").alias("canonical_url"), F.lit(None).cast("string").alias("image_url"),
            F.col("source").alias("source_name"), F.lit("RSS").alias("source_type"),
            F.expr("concat('https://', source, '.example.com/')").alias("source_homepage_url"),
            pick(COUNTRY_CODES, "doc_id % 25").alias("source_country_code"),
            F.lit(None).cast("decimal(5,2)").alias("source_credibility"),
            F.expr("if(doc_id % 3 = 0, null, concat('Reporter ', doc_id % 10))").alias("author"),
            published.alias("published_at"), published.alias("collected_at"),
            pick(fixed.CATEGORIES, "doc_id % 14").alias("primary_category"),
            F.array(pick(fixed.LABELS, "doc_id % 7")).alias("labels"),
            F.lit(None).cast("string").alias("sentiment"),
            F.array(F.lower(pick(COUNTRY_CODES, "doc_id % 25")), F.lit(" us ")).alias("country_codes"),
            F.array().cast("array<string>").alias("keywords"), F.col("lang").alias("language_code"),
            F.lit(False).alias("ai_processed"), F.sha2("text", 256).alias("content_hash"),
            F.lit(None).cast("string").alias("share_caption"),
            F.lit(None).cast(self._card_type()).alias("social_card"),
        )

    @staticmethod
    def _card_type() -> str:
        from broadsheet.schemas import SOCIAL_CARD

        return SOCIAL_CARD

    @cached_property
    def articles(self) -> DataFrame:
        """documents as stored article rows."""
        return self.docs.select(
            F.col("article_id").alias("id"),
            F.sha2(F.concat(F.col("source_name"), F.lit("|RSS")), 256).alias("source_id"),
            "doc_id", "title", "url", "canonical_url", "content", "summary", "author", "source_name", "published_at",
            "collected_at", "primary_category", F.lit("Unknown").alias("sentiment"), "language_code", "ai_processed",
            "content_hash", "keywords", "share_caption", F.col("social_card").alias("social_card_data"),
        )

    @cached_property
    def article_states(self) -> DataFrame:
        """Two state links per document (one where both fall on the same state)."""
        links = F.expr(
            "array_distinct(array(named_struct('k', doc_id % 25), named_struct('k', (doc_id * 7 + 3) % 25)))"
        )
        return (
            self.docs.select("doc_id", "article_id", F.posexplode(links).alias("pos", "link"))
            .select(
                "article_id",
                F.expr("concat('N-', lpad(cast(link.k as string), 2, '0'))").alias("state_code"),
                F.expr("cast(((doc_id * 13 + link.k * 29) % 101) / 100 as decimal(5,4))").alias("relevance_score"),
                (F.col("pos") == 0).alias("is_primary"), F.lit("keyword").alias("detection_method"), "doc_id",
            )
        )

    @cached_property
    def article_countries(self) -> DataFrame:
        return self.docs.select(
            "article_id", F.col("source_country_code").alias("country_code"),
            F.lit("1.0000").cast("decimal(5,4)").alias("relevance_score"),
        )

    @cached_property
    def users(self) -> DataFrame:
        return self.base("customer").select(
            F.expr("cast(c_custkey as string)").alias("id"),
            F.expr("lower(concat(replace(c_name, '#', '.'), '@example.com'))").alias("email"),
            F.col("c_name").alias("display_name"), F.lit(True).alias("is_active"), "c_custkey", "c_nationkey",
        )

    @cached_property
    def favorite_countries(self) -> DataFrame:
        """The two most ordered countries of each customer, in priority order."""
        from broadsheet.operators.serving import top_per_group

        orders = self.base("orders").groupBy(
            "o_custkey", F.expr("o_orderkey % 25").alias("k")
        ).agg(F.count("*").alias("n"))
        top = top_per_group(orders, ["o_custkey"], [F.col("n").desc(), F.col("k")], 2, "priority")
        return top.select(
            F.expr("cast(o_custkey as string)").alias("user_id"), pick(COUNTRY_CODES, "k").alias("country_code"),
            F.col("priority").cast("smallint").alias("priority"),
        )

    @cached_property
    def favorite_states(self) -> DataFrame:
        """Distinct states per customer, from the order keys."""
        return self.base("orders").select(
            F.expr("cast(o_custkey as string)").alias("user_id"),
            F.expr("concat('N-', lpad(cast(o_orderkey % 25 as string), 2, '0'))").alias("state_code"),
        ).distinct()

    @cached_property
    def rankings(self) -> DataFrame:
        """Top ten of each state and day over the state links."""
        from broadsheet.operators.serving import top_per_group

        dated = self.article_states.join(
            self.docs.select("article_id", F.to_date("published_at").alias("ranking_date")), "article_id"
        ).withColumn("ranking_score", F.expr("cast(relevance_score * 30 + doc_id % 36 as decimal(12,4))"))
        top = top_per_group(
            dated, ["state_code", "ranking_date"], [F.col("ranking_score").desc(), F.col("doc_id")], 10, "rank_position"
        )
        return top.select(
            "state_code", "ranking_date", F.lit("24h").alias("ranking_window"), F.lit("all").alias("category_filter"),
            "article_id", F.col("rank_position").cast("smallint").alias("rank_position"), "ranking_score",
        )

    @cached_property
    def gazetteer(self) -> DataFrame:
        """benchmark as places: a state of two words, a district that adds the third, a city that overlaps it, and short names.

        ``first`` holds the leading words of a passage."""
        first = F.slice(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), 1, 5)
        place = lambda kind, name: F.struct(F.lit(kind).alias("kind"), name.alias("name"))
        part = lambda a, n: F.array_join(F.slice("first", a, n), " ")
        places = F.array(
            place("state", part(1, 2)), place("district", part(1, 3)), place("city", part(3, 2)), place("city", F.concat(F.lit("- "), part(4, 1))), place("district", part(5, 1)),
        )
        return (
            self.base("benchmark").select("item_id", first.alias("first")).select("item_id", F.posexplode(places).alias("pos", "p"))
            .select(
                "p.kind", "p.name", F.expr("concat(substring(p.kind, 1, 1), item_id, '-', pos)").alias("code"),
                F.expr("concat('N-', lpad(cast(item_id % 25 as string), 2, '0'))").alias("state_code"),
            )
        )

    # ---- search-API payloads out of events ------------------------------------------------

    @cached_property
    def api_raw_records(self) -> DataFrame:
        return self.base("events").select(
            "event_id", "user_id", "event_type", "ts",
            F.expr("event_id div 100").alias("payload"), F.expr("cast(event_id % 100 as int)").alias("pos"),
            F.expr(
                "case when event_id % 13 = 5 then '' when event_id % 13 = 7 then concat('notaurl/', event_id) "
                "else concat(' https://News', user_id, '.Example.com/', event_type, '/', event_id, ' ') end"
            ).alias("url"),
            F.expr("if(event_id % 17 = 3, '   ', concat(event_type, ' report ', event_id))").alias("title"),
            F.expr(
                "case event_id % 6 when 0 then date_format(ts, \"yyyyMMdd'T'HHmmss'Z'\") "
                "when 1 then date_format(ts, 'yyyyMMddHHmmss') when 2 then date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") "
                "when 3 then date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'+05:30'\") "
                "when 4 then date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") "
                "else if(event_id % 12 = 5, 'yesterday', date_format(ts, 'yyyy-MM-dd')) end"
            ).alias("seendate"),
            F.expr(
                "case event_id % 3 when 0 then concat('https://img.example.com/', event_id, '.jpg') "
                "when 1 then 'not-a-valid-image-url' end"
            ).alias("socialimage"),
            F.expr(
                "case user_id % 4 when 0 then null when 1 then '  ' else concat(' News', user_id, '.Example.com ') end"
            ).alias("domain"),
            pick(LANGUAGES, "user_id % 5").alias("language"),
            F.when(F.expr("event_id % 26 = 25"), "Atlantis").when(
                F.expr("event_id % 2 = 1"), F.upper(pick(COUNTRY_NAMES, "event_id % 26"))
            ).otherwise(pick(COUNTRY_NAMES, "event_id % 26")).alias("sourcecountry"),
        )

    @cached_property
    def api_payloads(self) -> DataFrame:
        """One JSON payload per hundred events; some payloads are broken as a whole."""
        fields = ["url", "title", "seendate", "socialimage", "domain", "language", "sourcecountry"]
        as_number = [F.col("event_id").alias(f) if f == "title" else F.col(f) for f in fields]
        element = (
            F.when(F.expr("event_id % 50 = 49"), F.concat(F.lit('"stray text '), F.col("event_id"), F.lit('"')))
            .when(F.expr("event_id % 97 = 11"), F.to_json(F.struct(*as_number)))
            .otherwise(F.to_json(F.struct(*fields)))
        )
        # A payload is a hundred consecutive events, so this list has a fixed size.
        grouped = self.api_raw_records.select("payload", "pos", "ts", element.alias("e")).groupBy("payload").agg(
            F.array_sort(F.collect_list(F.struct("pos", "e"))).alias("items"), F.max("ts").cast("timestamp").alias("collected_at")
        )
        listed = F.concat(F.lit("["), F.array_join(F.transform("items", lambda i: i["e"]), ","), F.lit("]"))
        body = (
            F.when(F.expr("payload % 23 = 7"), listed)
            .when(F.expr("payload % 23 = 11"), F.concat(F.lit('{"items":'), listed, F.lit("}")))
            .when(F.expr("payload % 23 = 13"), F.lit('{"articles":{"a":1}}'))
            .when(F.expr("payload % 23 = 17"), F.lit("{oops"))
            .when(F.expr("payload % 23 = 19"), F.lit('{"articles":null}'))
            .otherwise(F.concat(F.lit('{"articles":'), listed, F.lit("}")))
        )
        return grouped.select(
            F.concat(F.lit("p"), F.col("payload")).alias("payload_id"), F.lit("Search API").alias("provider"),
            F.lit(None).cast("string").alias("source_id"), F.lit("energy").alias("query"),
            F.expr("cast(payload % 60 + 20 as int)").alias("max_records"), F.lit("24h").alias("timespan"),
            "collected_at", body.alias("body"),
        )

    @cached_property
    def api_mapped(self) -> DataFrame:
        from broadsheet.sources import api_json

        records = api_json.explode_records(api_json.parse_payloads(self.api_payloads))
        return api_json.map_records(records, self.countries, self.languages)

    # ---- feeds out of documents -----------------------------------------------------------

    @cached_property
    def feed_raw_entries(self) -> DataFrame:
        esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
        pub = F.expr(f"timestamp'{AS_OF}' - make_dt_interval(cast(doc_id % 12 as int))")
        return self.docs.select(
            "doc_id", F.expr("doc_id div 40").alias("payload"), F.expr("cast(doc_id % 40 as int)").alias("pos"),
            F.when(F.expr("doc_id % 19 = 7"), F.lit("")).otherwise(
                F.concat(F.lit("&lt;b&gt;"), esc(esc(F.col("title"))), F.lit("&lt;/b&gt; &amp;amp; more"))
            ).alias("title_xml"),
            F.expr(
                "case when doc_id % 31 = 9 then 'bad link' "
                "when doc_id % 13 = 5 then concat('https://Feed.example.com/story/', doc_id - 1) "
                "else concat('https://Feed.example.com/story/', doc_id) end"
            ).alias("link"),
            F.concat(F.lit("<![CDATA[<p>"), F.col("content"), F.lit("</p><script>x('</p>')</script>]]>")).alias("body_xml"),
            F.when(F.expr("doc_id % 41 = 11"), F.lit("soon"))
            .when(F.expr("doc_id % 3 = 0"), F.date_format(pub, "EEE, dd MMM yyyy HH:mm:ss 'GMT'"))
            .when(F.expr("doc_id % 3 = 1"), F.date_format(pub, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .otherwise(F.date_format(pub + F.expr("interval 330 minutes"), "dd MMM yyyy HH:mm:ss '+0530'"))
            .alias("published_text"),
            "author",
        )

    @cached_property
    def feed_payloads(self) -> DataFrame:
        """One feed per forty documents: RSS and Atom, some cut short, empty or not a feed."""
        media = F.expr(
            "case doc_id % 4 when 0 then concat('<media:content url=\"https://img.example.com/', doc_id, '.jpg\" type=\"image/jpeg\"/>') "
            "when 1 then concat('<media:content url=\"https://img.example.com/', doc_id, '.mp4\" type=\"video/mp4\"/><media:thumbnail url=\"https://img.example.com/', doc_id, '-t.png\"/>') "
            "else '' end"
        )
        tag = lambda name, c: F.when(c.isNull(), F.lit("")).otherwise(F.concat(F.lit(f"<{name}>"), c, F.lit(f"</{name}>")))
        guid = F.concat(F.lit("doc-"), F.col("doc_id").cast("string"))
        enclosure = F.expr(
            "if(doc_id % 4 = 2, concat('<enclosure url=\"https://img.example.com/', doc_id, '.png\" type=\"image/png\"/>'), '')"
        )
        atom_enclosure = F.expr(
            "if(doc_id % 4 = 2, concat('<link rel=\"enclosure\" href=\"https://img.example.com/', doc_id, '.png\" type=\"image/png\"/>'), '')"
        )
        rss = F.concat(
            F.lit("<item>"), tag("title", F.col("title_xml")), tag("link", F.col("link")),
            F.lit('<guid isPermaLink="false">'), guid, F.lit("</guid>"), tag("description", F.col("body_xml")),
            tag("content:encoded", F.col("body_xml")), tag("author", F.col("author")),
            tag("pubDate", F.col("published_text")), media, enclosure, F.lit("</item>\n"),
        )
        atom = F.concat(
            F.lit("<entry>"), tag("title", F.col("title_xml")), F.lit('<link rel="alternate" href="'), F.col("link"),
            F.lit('"/>'), tag("id", guid), tag("summary", F.col("body_xml")), tag("content", F.col("body_xml")),
            F.when(F.col("author").isNull(), F.lit("")).otherwise(
                F.concat(F.lit("<author><name>"), F.col("author"), F.lit("</name></author>"))
            ),
            tag("published", F.col("published_text")), media, atom_enclosure, F.lit("</entry>\n"),
        )
        element = F.when(F.expr("payload % 3 = 0"), atom).otherwise(rss)
        # A feed is forty consecutive documents, so this list has a fixed size.
        grouped = self.feed_raw_entries.select("payload", "pos", element.alias("e")).groupBy("payload").agg(
            F.array_sort(F.collect_list(F.struct("pos", "e"))).alias("items")
        )
        inner = F.array_join(F.transform("items", lambda i: i["e"]), "")
        spaces = 'xmlns:media="http://search.yahoo.com/mrss/" xmlns:content="http://purl.org/rss/1.0/modules/content/"'
        cut_short = F.expr("payload % 29 = 3")
        body = (
            F.when(F.expr("payload % 29 = 5"), F.lit(""))
            .when(F.expr("payload % 29 = 7"), F.lit("<html></html>"))
            .when(
                F.expr("payload % 3 = 0"),
                F.concat(
                    F.lit(f'<feed xmlns="http://www.w3.org/2005/Atom" {spaces}><title>Wire</title>'), inner,
                    F.when(cut_short, F.lit("<entry><title>cut")).otherwise(F.lit("</feed>")),
                ),
            )
            .otherwise(
                F.concat(
                    F.lit(f'<rss version="2.0" {spaces}><channel><title>Wire</title>'), inner, F.lit("</channel></rss>")
                )
            )
        )
        return grouped.select(
            F.concat(F.lit("f"), F.col("payload")).alias("payload_id"),
            F.lit("feed").alias("provider"), F.lit("wire-feed").alias("source_id"), F.lit("Wire Feed").alias("source_name"),
            F.lit("https://feed.example.com/rss").alias("feed_url"),
            F.lit("https://feed.example.com/").alias("source_homepage_url"), F.lit("GB").alias("source_country_code"),
            F.lit("Energy").alias("default_category"), F.lit("en").alias("feed_language"),
            F.expr("get(array('rss', 'atom', 'auto'), cast(payload % 5 as int) % 3)").alias("expected_format"),
            F.expr("if(payload % 5 = 2, ' THE ', '')").alias("query"), F.lit("7d").alias("timespan"),
            F.expr("cast(if(payload % 4 = 1, 5, 25) as int)").alias("cap"), body.alias("body"),
        )

    @cached_property
    def feed_parsed(self) -> DataFrame:
        from broadsheet.sources import feed_xml

        return feed_xml.parse_feeds(self.feed_payloads)

    @cached_property
    def feed_mapped(self) -> DataFrame:
        from broadsheet.sources import feed_xml

        return feed_xml.map_entries(feed_xml.explode_entries(self.feed_parsed))

    @cached_property
    def feed_decided(self) -> DataFrame:
        from broadsheet.sources import feed_xml

        return feed_xml.decide_entries(self.feed_mapped, F.lit(AS_OF).cast("timestamp"))

    # ---- queue messages out of events -----------------------------------------------------

    @cached_property
    def message_bodies(self) -> DataFrame:
        return self.bodies_dealt()

    def bodies_dealt(self, rows: int = 50_000) -> DataFrame:
        """``message_bodies`` in partitions of about ``rows`` rows."""
        return self._bodies(self.dealt("events", rows))

    @staticmethod
    def _bodies(events: DataFrame) -> DataFrame:
        digest = F.md5(F.expr("cast(event_id as string)"))
        uuid = F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
        country = pick(COUNTRY_CODES, "user_id % 25")
        payload = F.struct(
            F.expr("concat('Wire story ', event_id)").alias("title"),
            F.expr(
                "if(event_id % 61 = 9, 'nope', concat('https://Wire.example.com/', user_id, '/', cast(floor(value) as bigint)))"
            ).alias("url"),
            F.struct(
                F.expr("concat('Wire ', user_id % 10)").alias("name"), F.lit("RSS").alias("source_type"),
                F.lower(country).alias("country_code"),
            ).alias("source"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("published_at"),
            F.array(F.lit("Energy"), F.lit(" energy "), F.col("event_type")).alias("keywords"),
        )
        scores = F.create_map(F.expr("concat(' n-', lpad(cast(user_id % 25 as string), 2, '0'), ' ')"), F.expr("value / 300"))
        message = F.struct(
            F.lit("1.0").alias("schema_version"), uuid.alias("message_id"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
            F.lit("article_processing").alias("message_type"), F.lit(" Wire ").alias("provider"),
            F.expr("if(event_id % 37 = 5, 's3://onlybucket', concat('s3://news-lake/raw/', event_id, '.json'))").alias("raw_s3_uri"),
            payload.alias("article_payload"),
            F.create_map(F.lower(country), F.lit(1)).alias("country_scores"), scores.alias("state_scores"),
            F.expr("case when event_id % 43 = 8 then 'n-99' when event_id % 2 = 0 then concat('n-', lpad(cast(user_id % 25 as string), 2, '0')) end").alias("primary_state_code"),
            F.lit("keyword").alias("state_detection_method"), F.expr("cast(event_id % 8 as int)").alias("retry_count"),
            F.expr("if(event_id % 53 = 4, 1, null)").alias("surprise"),
        )
        body = F.to_json(message)
        return events.select(
            "event_id", "user_id", "ts", "value",
            F.when(F.expr("event_id % 59 = 7"), F.concat(F.lit("{"), body)).otherwise(body).alias("body"),
        )

    @cached_property
    def messages(self) -> DataFrame:
        from broadsheet.sources import messages

        return messages.parse_messages(self._bodies(self.dealt("events")))

    @cached_property
    def message_articles(self) -> DataFrame:
        """Valid messages with their flat article columns and article_error."""
        from broadsheet.sources import messages

        valid = self.messages.filter(F.col("message_error").isNull())
        return messages.parse_articles(valid, "article_payload", self.countries)

    @cached_property
    def message_requests(self) -> DataFrame:
        """Persist requests from the valid messages, in event order."""
        return self._requests(self.message_articles)

    @cached_property
    def read_messages(self) -> DataFrame:
        """Messages with their flat article columns, message_error and article_error: parsed once into a written table.

        For queries that look at the messages more than once; a parse costs far more than reading its result."""
        from broadsheet.sources import messages

        parsed = messages.parse_articles(self.messages, "article_payload", self.countries)
        return cut(parsed.drop("body", "article_payload"), "messages")

    @cached_property
    def read_requests(self) -> DataFrame:
        """As ``message_requests``, from the written table."""
        return self._requests(self.read_messages.filter("message_error IS NULL"))

    @staticmethod
    def _requests(articles: DataFrame) -> DataFrame:
        ok = articles.filter(F.col("article_error").isNull())
        return ok.withColumn("seq", F.col("event_id")).withColumn(
            "article_id", F.sha2(F.concat(F.lit("wire|"), F.col("event_id").cast("string")), 256)
        )

    @cached_property
    def request_bodies(self) -> DataFrame:
        """customer as scheduled ingestion requests."""
        request = F.struct(
            F.expr("if(c_custkey % 29 = 3, '  ', c_mktsegment)").alias("provider"),
            F.expr("if(c_custkey % 11 = 4, 'q', c_name)").alias("query"),
            F.expr("cast(c_custkey % 260 as int)").alias("max_records"),
            pick(TIMESPANS, "c_custkey % 8").alias("timespan"),
            F.expr("if(c_custkey % 31 = 6, 'x', null)").alias("surprise"),
        )
        return self.base("customer").select("c_custkey", F.to_json(request).alias("body"))


_S = "sha256"
VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {}


def _view(name: str, sql: str, *needs: str) -> None:
    VIEWS[name] = (sql, needs)


_view("states", """
SELECT 'N-' || lpad(n_nationkey::VARCHAR, 2, '0') AS code, 'S' || n_nationkey AS short_code, n_name AS name,
       CASE WHEN n_nationkey % 2 = 0 THEN 'state' ELSE 'union_territory' END AS region_type,
       n_nationkey + 1 AS display_order, n_nationkey % 5 <> 0 AS is_active, n_nationkey
FROM nation""")
_view("sources", f"""
SELECT sha256(s_name || '|' || {sql_pick(fixed.SOURCE_TYPES, 's_suppkey % 5')}) AS id, s_name AS name,
       {sql_pick(fixed.SOURCE_TYPES, 's_suppkey % 5')} AS source_type,
       'https://s' || s_suppkey || '.example.com/' AS homepage_url,
       {sql_pick(COUNTRY_CODES, 's_nationkey')} AS country_code,
       CAST(floor((s_acctbal + 1000) / 110) AS DECIMAL(5,2)) AS credibility_score,
       s_suppkey % 7 <> 0 AS is_active, s_suppkey
FROM supplier""")
_view("docs", f"""
SELECT doc_id, text AS content, lang AS language_code, source AS source_name,
       sha256('docs|https://' || source || '.example.com/' || lang || '/' || doc_id) AS article_id,
       'https://' || source || '.example.com/' || lang || '/' || doc_id AS url,
       coalesce(nullif(substring(trim(regexp_replace(split_part(text, '.', 1), '\\s+', ' ', 'g')), 1, 500), ''), 'Untitled') AS title,
       CASE WHEN doc_id % 3 = 0 THEN NULL ELSE 'Reporter ' || (doc_id % 10) END AS author,
       TIMESTAMP '2026-06-01 00:00:00' + to_minutes(doc_id % 525600) AS published_at,
       {sql_pick(fixed.CATEGORIES, 'doc_id % 14')} AS primary_category,
       {sql_pick(fixed.LABELS, 'doc_id % 7')} AS label,
       {sql_pick(COUNTRY_CODES, 'doc_id % 25')} AS country_code, sha256(text) AS content_hash
FROM documents""")
_view("article_states", """
SELECT article_id, doc_id, 'N-' || lpad(k::VARCHAR, 2, '0') AS state_code,
       CAST(((doc_id * 13 + k * 29) % 101) / 100.0 AS DECIMAL(5,4)) AS relevance_score, is_primary
FROM (SELECT article_id, doc_id, doc_id % 25 AS k, TRUE AS is_primary FROM docs
      UNION ALL
      SELECT article_id, doc_id, (doc_id * 7 + 3) % 25, FALSE FROM docs WHERE (doc_id * 7 + 3) % 25 <> doc_id % 25)""",
      "docs")
_view("gazetteer", r"""
SELECT kind, lower(name) AS name, substr(kind, 1, 1) || item_id || '-' || pos AS code, 'N-' || lpad((item_id % 25)::VARCHAR, 2, '0') AS state_code
FROM (SELECT item_id, unnest(range(5)) AS pos, unnest(['state', 'district', 'city', 'city', 'district']) AS kind,
             unnest([array_to_string(w[1:2], ' '), array_to_string(w[1:3], ' '), array_to_string(w[3:4], ' '), array_to_string(w[4:4], ' '), array_to_string(w[5:5], ' ')]) AS name
      FROM (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark)) WHERE name <> ''""")
_view("mentions", r"""
SELECT doc_id, start, size, kind, code, state_code FROM (
  SELECT *, max(start + size) OVER (PARTITION BY doc_id ORDER BY start, size DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM (
    SELECT doc_id, start, size, array_to_string(w[start + 1:start + size], ' ') AS name FROM (
      SELECT *, unnest(range(len(w) - size + 1)) AS start FROM (
        SELECT doc_id, unnest([1, 2, 3]) AS size, w FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents)) WHERE len(w) >= size))
  WHERE name IN (SELECT name FROM gazetteer)) JOIN gazetteer USING (name) WHERE reach IS NULL OR start + size > reach""", "gazetteer")
_view("users", """
SELECT c_custkey::VARCHAR AS id, lower(replace(c_name, '#', '.') || '@example.com') AS email,
       c_name AS display_name, c_custkey, c_nationkey FROM customer""")
_view("favorite_countries", f"""
SELECT o_custkey::VARCHAR AS user_id, {sql_pick(COUNTRY_CODES, 'k')} AS country_code, priority FROM (
  SELECT o_custkey, k, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, k) AS priority FROM (
    SELECT o_custkey, o_orderkey % 25 AS k, count(*) AS n FROM orders GROUP BY 1, 2)) WHERE priority <= 2""")
_view("favorite_states", """
SELECT DISTINCT o_custkey::VARCHAR AS user_id, 'N-' || lpad((o_orderkey % 25)::VARCHAR, 2, '0') AS state_code FROM orders""")
_view("rankings", """
SELECT state_code, strftime(ranking_date, '%Y-%m-%d') AS ranking_date, '24h' AS ranking_window, 'all' AS category_filter,
       article_id, rank_position, ranking_score FROM (
  SELECT *, row_number() OVER (PARTITION BY state_code, ranking_date ORDER BY ranking_score DESC, doc_id) AS rank_position FROM (
    SELECT s.state_code, s.article_id, s.doc_id, CAST(d.published_at AS DATE) AS ranking_date,
           CAST(s.relevance_score * 30 + s.doc_id % 36 AS DECIMAL(12,4)) AS ranking_score
    FROM article_states s JOIN docs d USING (article_id))) WHERE rank_position <= 10""", "docs", "article_states")
_view("api_raw", f"""
SELECT event_id, user_id, event_type, ts, event_id // 100 AS payload, event_id % 100 AS pos,
       CASE WHEN event_id % 13 = 5 THEN '' WHEN event_id % 13 = 7 THEN 'notaurl/' || event_id
            ELSE 'https://News' || user_id || '.Example.com/' || event_type || '/' || event_id END AS raw_url,
       CASE WHEN event_id % 17 = 3 THEN '' ELSE event_type || ' report ' || event_id END AS title,
       CASE WHEN event_id % 12 = 5 THEN NULL WHEN event_id % 6 = 5 THEN date_trunc('day', ts)
            WHEN event_id % 6 = 3 THEN date_trunc('second', ts) - INTERVAL 330 MINUTE ELSE date_trunc('second', ts) END AS published_at,
       CASE WHEN event_id % 3 = 0 THEN 'https://img.example.com/' || event_id || '.jpg' END AS image_url,
       CASE WHEN user_id % 4 >= 2 THEN 'news' || user_id || '.example.com' END AS domain,
       ([ 'en', 'fr', 'de', 'und', 'und' ])[CAST(user_id % 5 AS INTEGER) + 1] AS language_code,
       CASE WHEN event_id % 26 < 25 THEN {sql_pick(COUNTRY_CODES, 'event_id % 26')} END AS country_code,
       event_id // 100 % 23 NOT IN (7, 11, 13, 17, 19) AS usable
FROM events""")
_view("api_mapped", """
SELECT *, CASE WHEN event_id % 50 = 49 THEN 'not_an_object' WHEN raw_url = '' THEN 'url_empty'
               WHEN event_id % 97 = 11 THEN 'title_not_string' WHEN title = '' THEN 'title_empty'
               WHEN source_name IS NULL THEN 'domain_missing' WHEN published_at IS NULL THEN 'seendate_invalid'
               WHEN url IS NULL THEN 'url_invalid' END AS reject_reason
FROM (SELECT *, CASE WHEN raw_url LIKE 'https%' THEN 'https://news' || user_id || '.example.com/' || event_type || '/' || event_id END AS url,
             CASE WHEN raw_url LIKE 'https%' THEN 'https://news' || user_id || '.example.com/' END AS homepage_url,
             coalesce(domain, CASE WHEN raw_url LIKE 'https%' THEN 'news' || user_id || '.example.com' END) AS source_name
      FROM api_raw WHERE usable)""", "api_raw")
_view("feed_raw", f"""
SELECT doc_id, doc_id // 40 AS payload, doc_id % 40 AS pos, author,
       CASE WHEN doc_id % 19 = 7 THEN NULL ELSE substring(title || ' & more', 1, 500) END AS title,
       CASE WHEN doc_id % 31 = 9 THEN NULL WHEN doc_id % 13 = 5 THEN 'https://feed.example.com/story/' || (doc_id - 1)
            ELSE 'https://feed.example.com/story/' || doc_id END AS url,
       CASE WHEN doc_id % 31 = 9 THEN 'bad link' WHEN doc_id % 13 = 5 THEN 'https://Feed.example.com/story/' || (doc_id - 1)
            ELSE 'https://Feed.example.com/story/' || doc_id END AS link,
       CASE WHEN doc_id % 41 <> 11 THEN TIMESTAMP '{AS_OF}' - to_days(CAST(doc_id % 12 AS INTEGER)) END AS published_at,
       nullif(trim(regexp_replace(content, '\\s+', ' ', 'g')), '') AS content,
       CASE doc_id % 4 WHEN 0 THEN 'https://img.example.com/' || doc_id || '.jpg'
                       WHEN 1 THEN 'https://img.example.com/' || doc_id || '-t.png'
                       WHEN 2 THEN 'https://img.example.com/' || doc_id || '.png' END AS image_url
FROM docs WHERE doc_id // 40 % 29 NOT IN (5, 7)""", "docs")
_view("feed_mapped", """
SELECT *, CASE WHEN title IS NULL THEN 'title_empty' WHEN url IS NULL THEN 'link_invalid'
               WHEN published_at IS NULL THEN 'published_invalid' END AS reject_reason,
       substring(content, 1, 2000) AS description,
       CASE WHEN payload % 4 = 1 THEN 5 ELSE 25 END AS cap
FROM feed_raw""", "feed_raw")
_view("feed_decided", f"""
SELECT j.*, CASE WHEN pos > end_pos THEN 'unread' WHEN reject_reason IS NOT NULL THEN 'rejected'
                 WHEN pos > win THEN 'duplicate' WHEN candidate THEN 'accepted' ELSE 'filtered' END AS status
FROM (SELECT m.*, w.win, e.end_pos FROM feed_judged m
      LEFT JOIN feed_winners w ON w.payload = m.payload AND w.url = m.url AND m.reject_reason IS NULL
      LEFT JOIN (SELECT payload, win AS end_pos FROM (
          SELECT payload, win, cap, row_number() OVER (PARTITION BY payload ORDER BY win) AS rn FROM feed_winners)
        WHERE rn = cap) e ON e.payload = m.payload) j""", "feed_judged", "feed_winners")
_view("feed_judged", f"""
SELECT *, reject_reason IS NULL AND published_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY
          AND (payload % 5 <> 2 OR contains(replace(lower(title || ' ' || coalesce(description, '') || ' ' || coalesce(content, '')), 'ß', 'ss'), 'the')) AS candidate
FROM feed_mapped""", "feed_mapped")
_view("feed_winners", """
SELECT payload, url, any_value(cap) AS cap, min(pos) AS win FROM feed_judged WHERE candidate GROUP BY payload, url""",
      "feed_judged")
_view("messages", f"""
SELECT event_id, user_id, ts, value, regexp_replace(md5(event_id::VARCHAR), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5') AS message_id,
       {sql_pick(COUNTRY_CODES, 'user_id % 25')} AS country_code, 'N-' || lpad((user_id % 25)::VARCHAR, 2, '0') AS state_code,
       CAST(value / 300 AS DECIMAL(5,4)) AS score, CAST(floor(value) AS BIGINT) AS whole,
       CASE WHEN event_id % 59 = 7 THEN 'invalid_json' WHEN event_id % 53 = 4 THEN 'unknown_field'
            WHEN event_id % 37 = 5 THEN 'raw_uri_invalid' WHEN value > 300 THEN 'score_out_of_range'
            WHEN event_id % 43 = 8 THEN 'primary_state_missing' WHEN event_id % 8 > 5 THEN 'retry_count_invalid' END AS message_error,
       CASE WHEN event_id % 61 = 9 THEN 'url_invalid' END AS article_error
FROM events""")
_view("requests", f"""
SELECT event_id AS seq, sha256('wire|' || event_id) AS article_id, 'https://wire.example.com/' || user_id || '/' || whole AS url,
       'Wire ' || (user_id % 10) AS source_name, country_code, state_code, score,
       CASE WHEN event_id % 2 = 0 THEN state_code END AS primary_state_code, date_trunc('second', ts) AS published_at, user_id
FROM messages WHERE message_error IS NULL AND article_error IS NULL""", "messages")
_view("persisted", """
SELECT r.*, f.first_seq, f.first_id, CASE WHEN r.seq = f.first_seq THEN 'stored' ELSE 'duplicate' END AS status
FROM requests r JOIN (SELECT url, min(seq) AS first_seq, min_by(article_id, seq) AS first_id FROM requests GROUP BY url) f USING (url)""",
      "requests")


def oracle_text(sql: str, views: str) -> str:
    """Check SQL with the binding views it names (and theirs) in front."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in VIEWS[name][1]:
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in views.split():
        add(name)
    if not ordered:
        return sql.strip()
    with_list = ",\n".join(f"{name} AS ({VIEWS[name][0].strip()})" for name in ordered)
    return f"WITH RECURSIVE {with_list}\n{sql.strip()}"
