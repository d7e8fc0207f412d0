"""Related stories: articles whose texts share at least ``SIMILARITY`` of their five-word shingles with a story's leader.

Articles with the same shingles are one class. MinHash signatures, cut into ``BANDS`` bands of ``ROWS`` values, give candidates:
a pair at similarity 0.8 shares a band with probability 0.9996, and every candidate is verified by the exact Jaccard similarity of the shingle sets.

A story is led by one class, for ever: later batches are compared with the stored leaders first, so a story id never changes. What no leader
takes chooses new leaders in rounds. A class leads when it is similar to no smaller id that is still open and shares a bucket with it; others that
are similar to one of the round's leaders join the most similar. The first round looks at the smallest id of each bucket only (combined before the
shuffle), so a bucket with very many copies gives one candidate for each of them, never all pairs, and adaptive execution may split it. Later
rounds look at ``GROWTH`` times as many ids of a bucket each, so many classes that share a bucket but are not similar lead at once. Ids are
hashes, so rounds grow with the logarithm of the classes.

Shingles of a batch are written once (and once more with the leaders that stay); rounds work on ids and bands and look up the shingles of candidates
only. What a batch wrote besides its leaders and members goes with it, shuffle files go with the step that made them.

Defined results: words are runs of letters and digits, lower-cased; a text of fewer words is one shingle; texts without words, and null ones,
are stories of their own; an article added again keeps its story if its text is the same.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from broadsheet.functions.expr import fence
from broadsheet.session import LEAN_CONF, cut, scratch_run, session_conf

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 5
#: A round looks at that many times the ids of a bucket that the round before it looked at.
GROWTH = 4
#: Shingle values mixed at once.
_SLICE = 1 << 14
_WORD = re.compile(r"[^\W_]+")
#: Shingles (set_id, shingles) of the classes whose set_id a table lists.
Lookup = Callable[[DataFrame], DataFrame]
LEADERS = "set_id long, story_id string, shingles array<long>, bands array<long>, batch long"
MEMBERS = "article_id string, story_id string, similarity double, batch long"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _word_hash(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")


def shingles_of(text: str | None, known: dict[str, int]) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles of a lower-cased text."""
    words = _WORD.findall(text or "")
    for word in words:
        if word not in known:
            known[word] = _word_hash(word)
    hashes = np.array([known[w] for w in words], dtype=np.uint64)
    size = min(WORDS, len(hashes))
    if not size:
        return hashes
    run = hashes[: len(hashes) - size + 1].copy()
    for i in range(1, size):
        run = _mixed(run * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(hashes) - size + 1 + i])
    return np.unique(run)


def bands_of(sets: list[np.ndarray]) -> list[np.ndarray]:
    """One hash per band of the signature of every set; none for an empty set."""
    salts = _mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
    half, factor = np.uint64(32), np.uint64(0xD6E8FEB86659FD93)
    least = np.full((len(sets), BANDS * ROWS), np.iinfo(np.uint64).max, dtype=np.uint64)

    def mix(owners: list[int], parts: list[np.ndarray]) -> None:
        """Sets side by side: few calls, and all of them on what stays in the processor's memory."""
        flat, at = np.concatenate(parts), np.cumsum([0, *(len(p) for p in parts[:-1])])
        flat ^= flat >> half
        x, y = np.empty_like(flat), np.empty_like(flat)
        for i, salt in enumerate(salts):  # _mixed(flat ^ salt)
            np.bitwise_xor(flat, salt ^ (salt >> half), out=x)
            np.multiply(x, factor, out=x)
            np.right_shift(x, half, out=y)
            np.bitwise_xor(x, y, out=x)
            least[owners, i] = np.minimum(least[owners, i], np.minimum.reduceat(x, at))

    owners, parts, size = [], [], 0
    for owner, shingles in enumerate(sets):
        for start in range(0, len(shingles), _SLICE):
            part = shingles[start : start + _SLICE]
            if parts and (size + len(part) > _SLICE or owners[-1] == owner):
                mix(owners, parts)
                owners, parts, size = [], [], 0
            owners.append(owner)
            parts.append(part)
            size += len(part)
    if parts:
        mix(owners, parts)
    bands = np.tile(np.arange(BANDS, dtype=np.uint64), (len(sets), 1))
    for i in range(ROWS):
        bands = _mixed(bands * np.uint64(0x9E3779B97F4A7C15) + least[:, i::ROWS])
    return [b if len(s) else np.zeros(0, np.uint64) for b, s in zip(bands, sets)]


def shingle_sets(text: Column) -> Column:
    """Struct of set_id (null without words), shingles and bands of lower-cased texts."""

    @pandas_udf("struct<set_id:long,shingles:array<long>,bands:array<long>>")
    def made(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known: dict[str, int] = {}
        for batch in batches:
            if len(known) > 500_000:
                known.clear()
            sets = [shingles_of(t, known) for t in batch]
            ids = [int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) if len(s) else None for s in sets]
            yield pd.DataFrame({
                "set_id": pd.Series(ids, dtype="Int64"), "shingles": [s.view(np.int64) for s in sets],
                "bands": [b.view(np.int64) for b in bands_of(sets)],
            })

    return made(F.lower(text))


def similarity(a: str, b: str) -> Column:
    """Exact Jaccard similarity of two sets."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


class StoryStore:
    """Leaders and members of stories in a folder; every batch writes its own part."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root

    def create(self) -> None:
        for name, schema in (("leaders", LEADERS), ("members", MEMBERS)):
            self.spark.createDataFrame([], schema).write.mode("overwrite").partitionBy("batch").parquet(f"{self.root}/{name}")

    def _read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    def leaders(self) -> DataFrame:
        return self._read("leaders", LEADERS)

    def members(self) -> DataFrame:
        """article_id, story_id and similarity to the leader; an article of several batches once per batch."""
        return self._read("members", MEMBERS)

    def add(self, articles: DataFrame, batch: int, key: str = "article_id", text: str = "content") -> None:
        """Give every article of a batch its story. Run again with the same number, it replaces what it wrote."""
        with session_conf(self.spark, LEAN_CONF), scratch_run(self.spark):
            self._add(articles.select(F.col(key).cast("string").alias("article_id"), shingle_sets(F.col(text)).alias("s")), batch)

    def _add(self, articles: DataFrame, batch: int) -> None:
        told = cut(articles.select(F.monotonically_increasing_id().alias("row"), "article_id", "s.*"), "sets")
        classes = cut(
            told.filter("set_id IS NOT NULL").groupBy("set_id")
            .agg(F.min_by(F.struct("row", "bands"), F.struct("article_id", "row")).alias("f"), F.min("article_id").alias("first"))
            .select("set_id", "first", "f.row", "f.bands"), "classes"
        )
        earlier = self.leaders().filter(F.col("batch") < batch)

        def told_by(ids: DataFrame) -> DataFrame:
            return told.join(classes.join(ids, "set_id", "left_semi").select("row"), "row", "left_semi").select("set_id", "shingles")

        def known_by(ids: DataFrame) -> DataFrame:
            return earlier.join(ids, "set_id", "left_semi").select("set_id", "shingles")

        joined = [cut(self._joined(classes, earlier.select("set_id", "story_id", "bands"), told_by, known_by), "joined")]
        left = cut(classes.join(joined[0].select("set_id"), "set_id", "left_anti"), "open")
        new: list[DataFrame] = []
        depth = 1
        while not left.isEmpty():
            leads = cut(self._new_leaders(left, told_by, depth), "leaders")
            depth *= GROWTH
            new.append(leads)
            rest = left.join(leads.select("set_id"), "set_id", "left_anti")
            taken = cut(self._joined(rest, leads, told_by, told_by), "joined")
            joined.append(taken)
            left = cut(rest.join(taken.select("set_id"), "set_id", "left_anti"), "open")
        found = joined[0]
        for more in joined[1:]:
            found = found.unionByName(more)
        made = self.spark.createDataFrame([], "row long, story_id string")
        for leads in new:
            found = found.unionByName(leads.select("set_id", "story_id", F.lit(1.0).alias("similarity")))
            made = made.unionByName(leads.select("row", "story_id"))
        alone = told.filter("set_id IS NULL").select("article_id", F.col("article_id").alias("story_id"), F.lit(1.0).alias("similarity"))
        named = told.select("article_id", "set_id").join(found, "set_id").select("article_id", "story_id", "similarity").unionByName(alone)
        lead = told.join(made, "row").select("set_id", "story_id", "shingles", "bands")
        lead.write.mode("overwrite").parquet(f"{self.root}/leaders/batch={batch}")
        named.write.mode("overwrite").parquet(f"{self.root}/members/batch={batch}")

    @staticmethod
    def _alike(pairs: DataFrame, ours: Lookup, theirs: Lookup) -> DataFrame:
        """set_id, other, similarity of the pairs that are similar; shingles travel for classes in a pair only."""
        pairs = cut(pairs.distinct(), "pairs")
        one = ours(pairs.select("set_id").distinct()).withColumnRenamed("shingles", "_ours")
        two = theirs(pairs.select(F.col("other").alias("set_id")).distinct()).select(F.col("set_id").alias("other"), F.col("shingles").alias("_theirs"))
        sized = pairs.join(two, "other").join(one, "set_id").select("set_id", "other", similarity("_ours", "_theirs").alias("similarity"))
        return fence(sized).filter(F.col("similarity") >= SIMILARITY)

    @staticmethod
    def _joined(classes: DataFrame, leaders: DataFrame, ours: Lookup, theirs: Lookup) -> DataFrame:
        """set_id, story_id, similarity: the most similar leader of every class that has one."""
        mine = classes.select("set_id", F.explode("bands").alias("band"))
        other = leaders.select(F.col("set_id").alias("other"), F.explode("bands").alias("_band"))
        close = StoryStore._alike(mine.join(other, F.col("band") == F.col("_band")).select("set_id", "other"), ours, theirs)
        best = close.groupBy("set_id").agg(F.min(F.struct((-F.col("similarity")).alias("less"), "other")).alias("b"))
        named = leaders.select(F.col("set_id").alias("other"), "story_id")
        return best.select("set_id", "b.other", (-F.col("b.less")).alias("similarity")).join(named, "other").select("set_id", "story_id", "similarity")

    @staticmethod
    def _new_leaders(classes: DataFrame, told: Lookup, depth: int = 1) -> DataFrame:
        """Classes among the ``depth`` smallest ids in each of their buckets that are similar to no smaller one there; a story is named after
        its leader's first article. At depth 1 these are the smallest ids of all their buckets, and nothing is compared."""
        inside = classes.select("set_id", F.explode("bands").alias("band"))
        if depth == 1:
            least = inside.groupBy("band").agg(F.min("set_id").alias("_least")).withColumnRenamed("band", "_band")
            behind = inside.join(least, (F.col("band") == F.col("_band")) & (F.col("_least") < F.col("set_id"))).select("set_id").distinct()
        else:
            place = F.row_number().over(Window.partitionBy("band").orderBy("set_id"))
            front = cut(inside.withColumn("_place", place).filter(F.col("_place") <= depth).drop("_place"), "front")
            whole = front.groupBy("set_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == BANDS).select("set_id")
            first = front.select(F.col("set_id").alias("other"), F.col("band").alias("_band"))
            pairs = front.join(first, (F.col("band") == F.col("_band")) & (F.col("other") < F.col("set_id"))).select("set_id", "other")
            behind = StoryStore._alike(pairs, told, told).select("set_id").distinct()
            classes = classes.join(whole, "set_id", "left_semi")
        return classes.join(behind, "set_id", "left_anti").select("set_id", "row", F.col("first").alias("story_id"), "bands")
