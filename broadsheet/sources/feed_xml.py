"""RSS and Atom payloads: tolerant XML reading, entry mapping and in-feed decisions."""

from __future__ import annotations

import json
import re
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from broadsheet import fixed
from broadsheet.functions import codes, text, times, urls
from broadsheet.functions.expr import fence
from broadsheet.operators.skew import skew_lookup
from broadsheet.schemas import PARSED_FEED
from broadsheet.session import cut

# Entry fields by element name (local name, lower case).
_TEXT_FIELDS = {
    "title": "title", "id": "id", "subtitle": "subtitle", "pubdate": "published", "published": "published",
    "issued": "published", "updated": "updated", "modified": "updated", "date": "updated", "created": "created",
}


def _local(tag: object) -> tuple[str, str]:
    space, _, name = str(tag).rpartition("}")
    return space.strip("{").lower(), name.lower()


def _inner(node: ElementTree.Element) -> str:
    inner = (node.text or "") + "".join(
        ElementTree.tostring(child, encoding="unicode") for child in node
    )
    return re.sub(r"(</?)ns\d+:", r"\1", inner).strip()


def _entry(node: ElementTree.Element) -> dict:
    entry: dict = {}
    for child in node:
        space, name = _local(child.tag)
        if "mrss" in space:
            if name in ("content", "thumbnail"):
                entry.setdefault(f"media_{name}", []).append(dict(child.attrib))
            continue
        value = _inner(child)
        if name == "link":
            href = child.get("href")
            if href is None:
                entry.setdefault("link", value)
            elif child.get("rel", "alternate") == "alternate":
                entry.setdefault("link", href.strip())
            elif child.get("rel") == "enclosure":
                entry.setdefault("enclosures", []).append({"href": href, "type": child.get("type")})
        elif name == "guid":
            entry["guid"] = entry["id"] = value
            if child.get("isPermaLink", "true").lower() != "false" and "://" in value:
                entry.setdefault("_permalink", value)
        elif name == "enclosure":
            entry.setdefault("enclosures", []).append(
                {"href": child.get("url") or child.get("href"), "type": child.get("type")}
            )
        elif name in ("description", "summary"):
            entry.setdefault("summary", value)
        elif name in ("encoded", "content"):
            entry.setdefault("content", []).append({"value": value})
        elif name in ("author", "creator"):
            names = [_inner(part) for part in child if _local(part.tag)[1] == "name"] or [value]
            entry.setdefault("author", names[0])
            entry.setdefault("authors", []).extend({"name": n} for n in names)
        elif name in _TEXT_FIELDS:
            entry.setdefault(_TEXT_FIELDS[name], value)
    permalink = entry.pop("_permalink", None)
    if permalink:
        entry.setdefault("link", permalink)
    return entry


def read_feed(body: object) -> str:
    """JSON of the format version, the parse error and the entries read before any error."""
    reader = ElementTree.XMLPullParser(("start", "end"))
    version, error, entries, data = "", None, [], body or ""

    def drain() -> None:
        nonlocal version
        for event, node in reader.read_events():
            space, name = _local(node.tag)
            if event == "start":
                if not version and name == "rss":
                    version = "rss" + node.get("version", "2.0").replace(".", "")
                elif not version and name == "rdf":
                    version = "rss10"
                elif not version and name == "feed":
                    version = "atom10" if "2005" in space else "atom"
            elif name in ("item", "entry"):
                entries.append(_entry(node))
                node.clear()

    try:
        reader.feed(data.lstrip() if isinstance(data, str) else bytes(data).lstrip())
        reader.close()
    except ElementTree.ParseError as exc:
        error = f"xml_error_{exc.code}"
    try:
        drain()
    except ElementTree.ParseError as exc:
        error = error or f"xml_error_{exc.code}"
    return json.dumps({"version": version, "parse_error": error, "entries": entries}, ensure_ascii=False)


@F.pandas_udf(StringType())
def _read_feeds(body: pd.Series) -> pd.Series:
    return body.map(read_feed)


def parse_feeds(raw: DataFrame) -> DataFrame:
    """Raw feed rows with version, parse error, entry count, entries and ``payload_error``."""
    parsed = raw.withColumn("_feed", F.from_json(_read_feeds("body"), PARSED_FEED))
    shaped = parsed.select(
        *raw.columns,
        F.lower(text.strip(F.col("_feed.version"))).alias("version"),
        F.col("_feed.parse_error").alias("parse_error"),
        F.size(F.coalesce("_feed.entries", F.array())).alias("n_entries"),
        F.col("_feed.entries").alias("entries"),
    )
    empty = F.col("n_entries") == 0
    return fence(shaped.withColumn(
        "payload_error",
        F.when(F.col("entries").isNull(), "entries_not_list")
        .when(F.col("parse_error").isNotNull() & empty, "parse_error_without_entries")
        .when((F.col("version") == "") & empty, "unknown_format_without_entries"),
    ))


def format_mismatch() -> Column:
    """Whether the registered format and the delivered one differ (a warning, not an error)."""
    expected, version = F.col("expected_format"), F.col("version")
    return F.coalesce(
        ((expected == "rss") & F.startswith(version, F.lit("atom")))
        | ((expected == "atom") & F.startswith(version, F.lit("rss"))),
        F.lit(False),
    )


def raw_envelope(parsed: DataFrame) -> DataFrame:
    """The raw record of a feed fetch; ``body`` may be bytes or text."""
    return parsed.select(
        "source_id", "source_name", "feed_url", F.col("version").alias("feed_version"), "query", "timespan",
        F.octet_length("body").alias("content_length"),
        F.make_valid_utf8(F.col("body").cast("string")).alias("content"),
    )


def explode_entries(parsed: DataFrame) -> DataFrame:
    """One row per entry of a usable feed, in feed order."""
    usable = parsed.filter(F.col("payload_error").isNull())
    keep = [c for c in usable.columns if c not in ("body", "entries", "parse_error", "payload_error")]
    return usable.select(*keep, F.posexplode("entries").alias("pos", "entry"))


def _image_candidates() -> Column:
    image_type = lambda t: F.startswith(F.lower(t), F.lit("image/"))
    blank = lambda c: F.coalesce(c, F.lit("")) == ""
    media = F.filter(
        "entry.media_content",
        lambda m: blank(m["type"]) | image_type(m["type"]) | (F.lower(m["medium"]) == "image"),
    )
    enclosures = F.filter("entry.enclosures", lambda e: blank(e["type"]) | image_type(e["type"]))
    none = F.array().cast("array<string>")
    return F.concat(
        F.coalesce(F.transform(media, lambda m: m["url"]), none),
        F.coalesce(F.transform("entry.media_thumbnail", lambda m: m["url"]), none),
        F.coalesce(
            F.transform(enclosures, lambda e: F.coalesce(F.nullif(e["href"], F.lit("")), e["url"])), none
        ),
    )


def map_entries(entries: DataFrame) -> DataFrame:
    """Article columns and ``reject_reason`` for every entry.

    Feed-level columns expected: source_name, source_country_code, source_homepage_url,
    default_category, feed_language.
    """
    e = F.col("entry")
    first = lambda arr: F.get(arr, F.lit(0))
    # A list is reduced to its first element with visible text; elements that native patterns
    # cannot prove blank count as visible.
    shown = lambda v: F.coalesce(v, F.lit("")).rlike(r"\S") & (F.coalesce(text.native_text(v), F.lit("?")) != "")
    valid_images = F.filter(F.transform("_images", lambda u: urls.normalize_url(u, idna=False)), lambda u: u.isNotNull())
    cleaned = text.with_clean_text(
        entries,
        {
            "_title": e["title"], "_summary": e["summary"], "_description": e["description"],
            "_subtitle": e["subtitle"], "_author": e["author"],
            "_content": first(F.filter(F.transform(e["content"], lambda c: c["value"]), shown)),
            "_author_name": first(F.filter(F.transform(e["authors"], lambda a: a["name"]), shown)),
        },
        {"_images": urls.ascii_hosts(_image_candidates()), "_hosts": urls.foreign_hosts(F.array(e["link"]))},
    )
    shaped = cleaned.select(
        *entries.columns, "_title",
        F.coalesce("_summary", "_description", "_subtitle").alias("_text"),
        F.coalesce("_author", "_author_name").alias("_by"),
        F.col("_content").alias("content"),
        urls.normalize_url(e["link"], foreign_host=first(F.col("_hosts"))).alias("url"),
        times.feed_time(e["published"], e["updated"], e["created"]).alias("published_at"),
        first(valid_images).alias("image_url"),
    )
    reason = F.coalesce(
        F.when(e["title"].isNull(), "title_not_string").when(F.col("_title").isNull(), "title_empty"),
        F.when(e["link"].isNull(), "link_not_string")
        .when(text.strip(e["link"]) == "", "link_empty")
        .when(F.col("url").isNull(), "link_invalid"),
        F.when(F.col("published_at").isNull(), "published_invalid"),
    )
    return fence(shaped.select(
        "*",
        text.truncate(F.col("_title"), fixed.TITLE_LENGTH).alias("title"),
        text.truncate(F.col("_text"), fixed.DESCRIPTION_LENGTH).alias("description"),
        text.truncate(F.col("_by"), fixed.AUTHOR_LENGTH).alias("author"),
        F.lit(fixed.FEED_SOURCE_TYPE).alias("source_type"),
        F.col("default_category").alias("primary_category"),
        F.col("feed_language").alias("language_code"),
        reason.alias("reject_reason"),
        F.coalesce(
            text.blank_to_null(e["id"]), text.blank_to_null(e["guid"]), text.blank_to_null(e["link"])
        ).alias("reject_source_id"),
        F.to_json(e).alias("record_json"),
    ).drop("_title", "_text", "_by", "entry"))


def decide_entries(mapped: DataFrame, as_of: Column) -> DataFrame:
    """Status of each entry: accepted, duplicate, rejected, filtered or unread.

    Follows the order of the feed without walking it: the first candidate of a URL is found
    with a partial ``min``, the end of reading is the position of the last accepted entry
    under the cap. Needs payload_id, pos, url, published_at, query, timespan, cap,
    reject_reason, title, description, content.
    """
    fresh = F.col("published_at") >= as_of - F.make_dt_interval(
        secs=times.timespan_seconds(F.col("timespan")).cast("decimal(18,6)")
    )
    matching = codes.matches_query(
        F.coalesce("query", F.lit("")), F.col("title"), F.col("description"), F.col("content")
    )
    judged = mapped.withColumn(
        "_candidate", F.coalesce(F.col("reject_reason").isNull() & fresh & matching, F.lit(False))
    ).withColumn("_key", F.when(F.col("reject_reason").isNull(), F.concat_ws("\x01", "payload_id", "url")))
    # Three passes follow; parsing and cleaning happen once, before them.
    judged = cut(judged, "feed-judged")
    winners = (
        judged.filter(F.col("_key").isNotNull())
        .groupBy("_key")
        .agg(
            F.first("payload_id").alias("payload_id"),
            F.first("cap").alias("cap"),
            F.min(F.when(F.col("_candidate"), F.col("pos"))).alias("_win"),
            F.count("*").alias("_n"),
        )
        .filter(F.col("_win").isNotNull())
    )
    order = Window.partitionBy("payload_id").orderBy("_win")
    # A cap outside the contract is an error, never another cap.
    cap = F.when(F.col("cap").between(1, fixed.MAX_FEED_RECORDS), F.col("cap")).otherwise(
        F.raise_error(F.lit("max_records_invalid")).cast("int")
    )
    ends = (
        winners.withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") == cap)
        .select(F.col("payload_id").alias("_lookup"), F.col("_win").alias("_end"))
    )
    sizes = judged.groupBy(F.col("payload_id").alias("_lookup")).agg(F.count("*").alias("_n"))
    ends = ends.join(sizes, "_lookup")
    spread = F.concat_ws("\x01", "payload_id", F.col("pos").cast("string"))
    found = skew_lookup(judged, F.col("_key"), spread, winners.select("_key", "_win", "_n"), "_key", "_n")
    found = skew_lookup(found, F.col("payload_id"), spread, ends, "_lookup", "_n")
    status = (
        F.when(F.col("pos") > F.col("_end"), "unread")
        .when(F.col("reject_reason").isNotNull(), "rejected")
        .when(F.col("pos") > F.col("_win"), "duplicate")
        .when(F.col("_candidate"), "accepted")
        .otherwise("filtered")
    )
    return found.withColumn("status", status).drop("_candidate", "_key", "_win", "_end")
