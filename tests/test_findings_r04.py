"""Findings of round 4: what jobs keep on disk, and the number of their batches."""

from __future__ import annotations

import random
import time
from pathlib import Path

from pyspark.sql import functions as F

from broadsheet.operators import stories
from broadsheet.plans import queueing
from broadsheet.plans.bindings import Tables
from broadsheet.session import shared_root
from broadsheet.streaming import queue

FOLDER = "/root/testdata/sf0.001"


def _size(path) -> int:
    return sum(p.stat().st_size for p in Path(path).rglob("part-*"))


def _shuffles(spark) -> set[str]:
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(",")
    return {b for b in blocks.split(",") if b.startswith("shuffle")}


def test_queue_files_are_small(spark, tmp_path):
    """The queue holds every message whole."""
    tables = Tables(spark, FOLDER)
    queueing.publish(tables, f"{tmp_path}/queue")
    bytes_, n = tables.message_bodies.agg(F.sum(F.octet_length("body")), F.count("*")).first()
    assert _size(f"{tmp_path}/queue") < bytes_ / 3
    assert spark.read.text(f"{tmp_path}/queue").count() == n


def test_consumer_keeps_little_on_disk(spark, tmp_path):
    """Wide rows are joined in parts with the same tables, shuffle files go with their step."""
    tables = Tables(spark, FOLDER)
    bodies = tables.message_bodies.select("body")
    bodies = bodies.unionByName(bodies.limit(20))  # some messages twice
    known = _shuffles(spark)
    conf = spark.conf.get("spark.sql.parquet.compression.codec")
    for root, most in (("whole", 1_000_000), ("parts", 100)):
        queue.prepare_lake(spark, f"{tmp_path}/{root}")
        queue.persist_batch(f"{tmp_path}/{root}", tables.states, tables.countries, joined_rows=most)(bodies, 0)
    for _ in range(40):
        left = _shuffles(spark) - known
        if not left:
            break
        time.sleep(0.5)
    assert not left
    assert spark.conf.get("spark.sql.parquet.compression.codec") == conf
    for name in queue.STORE:
        one, two = (queue.stored_table(spark, f"{tmp_path}/{root}", name) for root in ("whole", "parts"))
        assert sorted(map(str, one.collect())) == sorted(map(str, two.collect())), name
    one, two = (spark.read.parquet(f"{tmp_path}/{root}/processed") for root in ("whole", "parts"))
    assert one.count() == two.count() > 100 and one.columns == two.columns
    assert {r["status"] for r in queue.outcomes(spark, f"{tmp_path}/parts").select("status").distinct().collect()} == {"stored", "duplicate", "failed"}


def test_few_large_queue_files(spark, tmp_path):
    """every batch reads the keys of all before it, so the dedup's queue must not be in many small files."""
    tables = Tables(spark, FOLDER)
    queueing.publish(tables, f"{tmp_path}/queue", copies=2, file_rows=500)
    files, n = [p for p in (tmp_path / "queue").iterdir() if p.name.startswith("part-")], tables.base("events").count()
    assert len(files) == 2 * -(-n // 500)


def test_dedup_decides_by_keys(spark, tmp_path, monkeypatch):
    """batches with news only, copies of their own, some or all keys seen before; whole messages are never cut."""
    cuts, real = [], queue.cut
    monkeypatch.setattr(queue, "cut", lambda df, name="stage": (cuts.append(df.columns), real(df, name))[1])
    message = lambda i, at: f'{{"message_id":"m{i}","created_at":"2026-01-01T00:00:{at:02d}Z"}}'
    files = [
        [message(i, 0) for i in range(10)],
        [message(i, 5) for i in range(10, 20)] + [message(11, 3), message(12, 7), "{broken", "{broken", '{"message_id":null}'],
        [message(i, 1) for i in range(15, 25)] + [message(24, 0), "{broken", "{other"],
        [message(i, 9) for i in range(25)] + ["{other"],
    ]
    (tmp_path / "queue").mkdir()
    for k, lines in enumerate(files):
        (tmp_path / "queue" / f"part-{k}.txt").write_text("\n".join(lines) + "\n")
        time.sleep(0.02)  # files come in the order of their time
    queue.deduplicate(spark, f"{tmp_path}/queue", str(tmp_path), files_per_batch=1)
    want, keys = [], set()
    for lines in files:
        least = {}
        for body in lines:
            id_ = body[15 : body.index('"', 15)] if body.startswith('{"message_id":"') else None
            at = int(body[-5:-3]) if id_ else -1
            least[id_ or body] = min(least.get(id_ or body, (99, "")), (at, body))
        want += [body for key, (_, body) in least.items() if key not in keys]
        keys |= least.keys()
    got = queue.distinct_messages(spark, str(tmp_path))
    assert sorted(r["body"] for r in got.collect()) == sorted(want)
    assert got.select("ingest_batch").distinct().count() == 3
    assert cuts and not any("body" in columns for columns in cuts)


def test_stories_write_shingles_once(spark, tmp_path, monkeypatch):
    """shingles of a batch are in one intermediate, which goes with the batch."""
    written, real = [], stories.cut
    monkeypatch.setattr(stories, "cut", lambda df, name: (written.append((name, df.columns)), real(df, name))[1])
    folder = Path(shared_root(spark).removeprefix("file://"))
    before = set(folder.rglob("*.parquet"))
    rnd = random.Random(4)
    base = [" ".join(f"w{rnd.randrange(300)}" for _ in range(120)) for _ in range(12)]
    rows = [(f"a{i:02}", base[i % 12] + (" end" if i % 3 else "")) for i in range(48)] + [("a00", base[0]), ("n", None)]
    store = stories.StoryStore(spark, str(tmp_path))
    store.create()
    for batch in range(2):
        store.add(spark.createDataFrame(rows[batch::2], "article_id string, content string"), batch)
    assert [name for name, columns in written if "shingles" in columns] == ["sets", "sets"]
    assert set(folder.rglob("*.parquet")) == before
    told = {(r.article_id, r.story_id) for r in store.members().collect()}
    assert len({s for _, s in told}) == 13 and all(rows[int(a[1:])][1][:300] == rows[int(s[1:])][1][:300] for a, s in told if a != "n")
    leaders = store.leaders().collect()
    assert len({r.set_id for r in leaders}) == len(leaders) == 12 and all(len(r.shingles) > 100 and len(r.bands) == stories.BANDS for r in leaders)
