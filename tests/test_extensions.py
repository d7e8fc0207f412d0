"""Region detection, ranking and stories against plain versions."""

import random
import re

import pytest
from pyspark.sql import functions as F

from broadsheet.operators import regions, stories

PLACES = [
    ("state", "Goa", "G", "G"), ("district", "North Goa", "NG", "G"), ("city", "Old Goa", "OG", "G"), ("state", "New Delhi", "D", "D"),
    ("city", "New  Delhi Cantonment", "DC", "D"), ("city", "Delhi-Gate", "DG", "D"), ("state", "Île-de-France", "F", "F"), ("city", "Gate", "GT", "F"),
    ("city", "Gate", "GT2", "G"), ("city", "a b c d", "ABCD", "X"), ("city", "b c", "BC", "X"), ("city", "c d e", "CDE", "X"), ("city", "..", "NONE", "X"), ("city", None, "NULL", "X"),
]


def plain_mentions(text, places):
    """Every name at word boundaries that no longer one covers."""
    words = re.findall(r"[^\W_]+", (text or "").lower())
    names = {tuple(re.findall(r"[^\W_]+", (name or "").lower())) for _, name, *_ in places} - {()}
    found = {(i, i + len(n)) for n in names for i in range(len(words)) if tuple(words[i : i + len(n)]) == n}
    kept = [(a, b) for a, b in found if not any(x <= a and b <= y and (x, y) != (a, b) for x, y in found)]
    return sorted((a, b - a, code) for a, b in kept for _, name, code, _ in places if tuple(re.findall(r"[^\W_]+", (name or "").lower())) == tuple(words[a:b]))


@pytest.fixture(scope="module")
def places(spark):
    return spark.createDataFrame(PLACES, "kind string, name string, code string, state_code string")


@pytest.fixture(scope="module")
def region_texts():
    rnd = random.Random(3)
    pieces = "goa north old new delhi cantonment gate île de france a b c d e x GOA Goan delhi_gate".split()
    made = [rnd.choice(["", " ", "- "]) + rnd.choice([" ", "-", ", ", "\n"]).join(rnd.choice(pieces) for _ in range(rnd.randint(1, 25))) for _ in range(400)]
    return [*made, None, "", "...", "goa " * 300, "NORTH GOA", "newdelhi", "a b c d e", "new delhi new delhi cantonment"]


@pytest.mark.parametrize("bound", [regions.MAX_NAME_BYTES, 1])
def test_mentions_by_automaton_and_by_join(spark, places, region_texts, bound):
    texts = spark.createDataFrame(list(enumerate(region_texts)), "id long, body string").repartition(4)
    got = {}
    for r in regions.find_mentions(texts, places, "id", "body", bound).collect():
        got.setdefault(r["id"], []).append((r["start"], r["size"], r["code"]))
    assert {i: sorted(v) for i, v in got.items()} == {i: m for i, t in enumerate(region_texts) if (m := plain_mentions(t, PLACES))}
    assert max(len(v) for v in got.values()) == 300


def test_longest_names_win_and_overlaps_both_count():
    finder = regions.NameFinder(["a b c d", "b c", "c d e", "d", "new delhi", "delhi gate"])
    assert finder.mentions("a b c d e".split()) == [(0, 4), (2, 5)]
    assert finder.mentions("b c x d new delhi gate".split()) == [(0, 2), (3, 4), (4, 6), (5, 7)]
    assert finder.mentions([]) == []


def test_mentions_without_names_or_texts(spark, places):
    texts = spark.createDataFrame([(1, "goa")], "id long, body string")
    assert regions.find_mentions(texts, places.limit(0), "id", "body").collect() == []
    assert regions.find_mentions(texts.limit(0), places, "id", "body").collect() == []


def test_state_scores(spark, places):
    texts = spark.createDataFrame([(1, "goa, new delhi, old goa, gate"), (2, "new delhi goa"), (3, "nowhere")], "id long, body string")
    scored = regions.state_scores(regions.find_mentions(texts, places, "id", "body"), "id")
    rows = {(r["id"], r["state_code"]): (r["mentions"], float(r["relevance_score"]), r["is_primary"]) for r in scored.collect()}
    # "gate" belongs to two states and counts for both
    assert rows == {(1, "G"): (3, 0.6, True), (1, "D"): (1, 0.2, False), (1, "F"): (1, 0.2, False), (2, "D"): (1, 0.5, True), (2, "G"): (1, 0.5, False)}
    assert dict(scored.dtypes)["relevance_score"] == "decimal(5,4)"
    assert [r[0] for r in regions.region_links(regions.find_mentions(texts, places, "id", "body"), "id").filter("id = 1 AND code = 'G'").select("mentions").collect()] == [1]
    assert scored.filter(F.col("is_primary")).count() == 2


def plain_shingles(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


def test_stories_over_batches(spark, tmp_path):
    """Members are similar to their leader, similar leaders are not missed, ids never change."""
    rnd = random.Random(12)
    words = [f"w{i}" for i in range(400)]
    base = [[rnd.choice(words) for _ in range(rnd.randint(40, 120))] for _ in range(25)]
    texts = [" ".join(b) for b in base]
    for b in base:
        for _ in range(8):
            copy = list(b)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 6])):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            texts.append(" ".join(copy))
    texts += ["", None, "...", "a b", "A  b!", "one two three four", texts[0].upper()]
    order = list(range(len(texts)))
    rnd.shuffle(order)
    store = stories.StoryStore(spark, str(tmp_path))
    store.create()
    before = {}
    for batch in range(3):
        part = [(f"a{i:04}", texts[i]) for i in order if i % 3 == batch]
        df = spark.createDataFrame(part, "article_id string, content string").repartition(3)
        store.add(df, batch)
        if batch == 1:
            store.add(df, batch)  # a batch again
        now = {r["article_id"]: (r["story_id"], r["similarity"]) for r in store.members().collect()}
        assert {a: now[a] for a in before} == before and len(now) == len(before) + len(part) == store.members().count()
        before = now
    sets = {f"a{i:04}": plain_shingles(t) for i, t in enumerate(texts)}
    for article, (story, found) in before.items():
        if sets[article]:
            assert found == pytest.approx(jaccard(sets[article], sets[story])) and found >= stories.SIMILARITY
        else:
            assert story == article
    led = sorted({story for story, _ in before.values() if sets[story]})
    missed = [(a, b) for a in led for b in led if a < b and jaccard(sets[a], sets[b]) >= stories.SIMILARITY]
    assert len(missed) <= 1 and len(led) < 150
    assert before["a0000"][0] == before[f"a{len(texts) - 1:04}"][0]


def test_one_bucket_of_many_classes(spark, tmp_path):
    """Copies that differ a little all join one story: candidates are one per class and band."""
    rnd = random.Random(1)
    base = [f"w{rnd.randrange(300)}" for _ in range(300)]
    rows = [(f"a{i:05}", " ".join([*base[: i % 290], f"x{i}", *base[i % 290 :]])) for i in range(600)]
    store = stories.StoryStore(spark, str(tmp_path))
    store.create()
    store.add(spark.createDataFrame(rows, "article_id string, content string").repartition(4), 0)
    assert store.members().select("story_id").distinct().count() <= 2 and store.members().count() == 600
