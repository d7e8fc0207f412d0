"""Order-dependent jobs against plain sequential models, also with every key treated as hot."""

import random

import pytest
from pyspark.sql import functions as F

from broadsheet.operators import dedup
from broadsheet.operators.skew import skew_lookup
from broadsheet.sources import feed_xml

SCHEMA = "seq bigint, article_id string, url string, canonical_url string, content_hash string, unfit boolean"


def sequential(rows, stored):
    """One article after another, as a single-threaded loop."""
    urls, hashes, canons, ids, out = {}, {}, set(), set(), {}

    def accept(article, url, canon, digest):
        urls.setdefault(url, article)
        if canon:
            urls.setdefault(canon, article)
            canons.add(canon)
        if digest:
            hashes.setdefault(digest, article)
        ids.add(article)

    for article, url, canon, digest in stored:
        accept(article, url, canon, digest)
    for seq, article, url, canon, digest, unfit in rows:
        if url in urls:
            out[seq] = ("duplicate", urls[url], "url")
        elif digest and digest in hashes:
            out[seq] = ("duplicate", hashes[digest], "content_hash")
        elif unfit or canon in canons or article in ids:
            out[seq] = ("failed", None, None)
        else:
            out[seq] = ("stored", None, None)
            accept(article, url, canon, digest)
    return out


@pytest.mark.parametrize("seed,hot_rows", [(1, 1_000_000), (2, 2)])
def test_ordered_dedup(spark, seed, hot_rows):
    rng = random.Random(seed)
    some = lambda kind, n: rng.choice([None] + [f"{kind}{i}" for i in range(n)])
    rows = []
    for i in range(160):
        digest = "h-hot" if rng.random() < 0.3 else some("h", 60)
        rows.append((i, f"a{rng.randrange(150)}", f"u{rng.randrange(90)}", some("u", 40), digest, rng.random() < 0.1))
    stored = [(f"s{i}", f"u{i * 9}", f"u{i * 9 + 1}", f"h{i}") for i in range(5)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    past = spark.createDataFrame(stored, "id string, url string, canonical_url string, content_hash string")
    got = {r.seq: (r.status, r.duplicate_of, r.duplicate_reason) for r in dedup.dedup_ordered(df, past, hot_rows).collect()}
    assert got == sequential(rows, stored)


def test_chain_case(spark):
    rows = [(0, "A", "u1", None, "h1", False), (1, "B", "u1", None, "h2", False), (2, "C", "u3", None, "h2", False)]
    got = {r.seq: r.status for r in dedup.dedup_ordered(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {0: "stored", 1: "duplicate", 2: "stored"}


@pytest.mark.parametrize("hot_rows", [1_000_000, 2])
def test_fast_path_equals_general(spark, hot_rows):
    rng = random.Random(7)
    rows = [(i, f"a{i}", "u-hot" if rng.random() < 0.4 else f"u{rng.randrange(80)}", None, None, False) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = {r.seq: (r.status, r.duplicate_of, r.duplicate_reason) for r in dedup.dedup_by_url(df, None, hot_rows).collect()}
    assert got == sequential(rows, [])


def test_skew_lookup_keeps_every_row(spark):
    rows = spark.range(300).select(F.col("id"), F.expr("case when id % 3 = 0 then 'hot' when id % 7 = 0 then null else concat('k', id % 40) end").alias("k"))
    table = rows.filter("k is not null").groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("low"))
    out = skew_lookup(rows, F.col("k"), F.col("id"), table, "k", "n", hot_rows=50)
    plain = rows.join(table.select("k", "low"), "k", "left").select("id", "k", "low")
    assert sorted(map(tuple, out.select("id", "k", "low").collect())) == sorted(map(tuple, plain.collect()))


def test_feed_decisions_against_loop(spark):
    rng = random.Random(3)
    rows = []
    for payload in range(6):
        for pos in range(40):
            old, bad, odd = rng.random() < 0.2, rng.random() < 0.15, rng.random() < 0.2
            rows.append((f"p{payload}", pos, f"u{rng.randrange(18)}", "bad" if bad else None, 30 if old else 1, "other" if odd else "wanted", 1 + payload * 2))
    schema = "payload_id string, pos int, url string, reject_reason string, age int, title string, cap int"
    df = spark.createDataFrame(rows, schema).repartition(3)
    for name in ("description", "content"):
        df = df.withColumn(name, F.lit(""))
    as_of = F.lit("2026-06-25 12:00:00").cast("timestamp")
    df = df.withColumns({"query": F.lit("WANT"), "timespan": F.lit("7d"), "published_at": as_of - F.make_dt_interval(days=F.col("age"))})
    got = {(r.payload_id, r.pos): r.status for r in feed_xml.decide_entries(df, as_of).collect()}
    expected = {}
    for payload in {r[0] for r in rows}:
        seen = set()
        for _, pos, url, reason, age, title, cap in sorted(r for r in rows if r[0] == payload):
            if len(seen) >= cap:
                status = "unread"
            elif reason:
                status = "rejected"
            elif url in seen:
                status = "duplicate"
            elif age > 7 or title != "wanted":
                status = "filtered"
            else:
                status = "accepted"
                seen.add(url)
            expected[payload, pos] = status
    assert got == expected
