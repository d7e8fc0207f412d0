"""Region detection: which states, districts and cities of a gazetteer a text names.

A text is read as lower-cased words (runs of letters and digits). A mention is a gazetteer name at word boundaries that no
longer mention covers, so ``new delhi`` inside ``new delhi cantonment`` does not count, while two names that only overlap both do.
Names with several regions give a mention of each.

Names of up to ``MAX_NAME_BYTES`` in all are one automaton over words (a trie with failure links) that every task reads its texts with,
once from left to right, whatever the number of names. A larger gazetteer is not broadcast: word n-grams of the texts are
joined with it instead, with the same mentions. The size is measured before the choice.

Null texts name nothing; empty names and names without a word are ignored.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.functions.expr import fence

#: Words of texts and names: letters and digits of any script.
JVM_WORD, WORD = r"[\p{L}\p{N}]+", re.compile(r"[^\W_]+")
MAX_NAME_BYTES = 32 << 20
#: Mentions that a task holds before it gives them away.
MAX_MENTIONS = 10_000
MENTIONS = "array<struct<name:string,start:long,size:long>>"


class NameFinder:
    """Longest names at every place of a word sequence."""

    def __init__(self, names: Iterable[str]) -> None:
        self.follow: list[dict[str, int]] = [{}]
        self.size, self.back = [0], [0]
        for name in names:
            at, words = 0, name.split()
            for word in words:
                if word not in self.follow[at]:
                    self.follow[at][word] = len(self.follow)
                    self.follow.append({})
                    self.size.append(0)
                    self.back.append(0)
                at = self.follow[at][word]
            self.size[at] = len(words)
        # Nearer nodes first: the failure link of a node is known when its children need it.
        near = deque(self.follow[0].values())
        while near:
            at = near.popleft()
            for word, child in self.follow[at].items():
                self.back[child] = self._step(self.back[at], word)
                near.append(child)
            if not self.size[at]:
                self.size[at] = self.size[self.back[at]]

    def _step(self, at: int, word: str) -> int:
        while at and word not in self.follow[at]:
            at = self.back[at]
        return self.follow[at].get(word, 0)

    def mentions(self, words: list[str]) -> list[tuple[int, int]]:
        """(start, end) of the names that no longer one covers, in order."""
        at, ends = 0, []
        follow, size = self.follow, self.size
        for i, word in enumerate(words):
            after = follow[at].get(word)
            at = self._step(self.back[at], word) if after is None and at else after or 0
            if size[at]:
                ends.append((i + 1 - size[at], i + 1))
        # The longest name at each end is known; one that a later end reaches over is covered.
        found: list[tuple[int, int]] = []
        for start, end in reversed(ends):
            if not found or start < found[-1][0]:
                found.append((start, end))
        return found[::-1]


def words(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(JVM_WORD), F.lit(0))


def normal_names(gazetteer: DataFrame) -> DataFrame:
    """``gazetteer`` with its name as lower-cased words joined by one space; rows without a word go."""
    return fence(gazetteer.withColumn("name", F.array_join(words(F.col("name")), " "))).filter("name <> ''")


def mention_batches(finder: NameFinder, batch: pa.RecordBatch, most: int = MAX_MENTIONS) -> Iterator[pa.RecordBatch]:
    """The mentions of a batch of (key, lower-case text), given away whenever a text brings them to ``most``."""
    rows: list[int] = []
    found: tuple[list, list, list] = ([], [], [])

    def given() -> pa.RecordBatch:
        columns = [batch.column(0).take(pa.array(rows, pa.int64())), *[pa.array(c, t) for c, t in zip(found, (pa.string(), pa.int64(), pa.int64()))]]
        return pa.RecordBatch.from_arrays(columns, [batch.schema.names[0], "name", "start", "size"])

    for row, text in enumerate(batch.column(1)):
        ws = WORD.findall(text.as_py() or "")
        for a, b in finder.mentions(ws):
            rows.append(row)
            for column, value in zip(found, (" ".join(ws[a:b]), a, b - a)):
                column.append(value)
        if len(rows) >= most:
            yield given()
            rows, found = [], ([], [], [])
    if rows:
        yield given()


def _by_automaton(texts: DataFrame, names: list[str], key: str) -> DataFrame:
    """Every task builds the automaton once from the broadcast names; its memory does not follow the number of mentions."""
    shared = texts.sparkSession.sparkContext.broadcast(names)

    def mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = NameFinder(shared.value)
        for batch in batches:
            yield from mention_batches(finder, batch)

    schema = T.StructType([texts.schema[key], *[T.StructField(n, t) for n, t in (("name", T.StringType()), ("start", T.LongType()), ("size", T.LongType()))]])
    return texts.select(key, F.lower("_text").alias("_text")).mapInArrow(mentions, schema)


def _by_join(texts: DataFrame, names: DataFrame, key: str, longest: int) -> DataFrame:
    """Word n-grams joined with the names (one row each); covered ones go by a window over the mentions of a text."""
    split = texts.select(key, words(F.col("_text")).alias("_words"))
    gram = lambda n: F.transform(
        F.sequence(F.lit(0), F.size("_words") - n),
        lambda i: F.struct(F.array_join(F.slice("_words", i + 1, F.lit(n)), " ").alias("name"), i.cast("long").alias("start"), F.lit(n).cast("long").alias("size")),
    )
    every = F.flatten(F.array(*[F.when(F.size("_words") >= n, gram(n)).otherwise(F.array().cast(MENTIONS)) for n in range(1, longest + 1)]))
    met = split.select(key, F.explode(every).alias("m")).select(key, "m.*").join(names.select("name"), "name")
    before = Window.partitionBy(key).orderBy("start", F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    reached = met.withColumn("_reach", F.max(F.col("start") + F.col("size")).over(before))
    return reached.filter("_reach IS NULL OR start + size > _reach").select(key, "name", "start", "size")


def find_mentions(texts: DataFrame, gazetteer: DataFrame, key: str, text: str, max_name_bytes: int = MAX_NAME_BYTES) -> DataFrame:
    """``key``, start (word number), size (words), and the other columns of ``gazetteer`` for every mention.

    ``key`` names one row of ``texts`` each. ``gazetteer`` has a column name; all its rows of a mentioned name are given."""
    known = normal_names(gazetteer)
    names = known.select("name").distinct()
    size, longest = names.agg(F.sum(F.octet_length("name")), F.max(F.size(F.split("name", " ")))).first()
    source = texts.select(key, F.col(text).alias("_text"))
    if not size:
        found = source.select(key, F.lit("").alias("name"), F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("size")).limit(0)
    elif size <= max_name_bytes:
        found = _by_automaton(source, [r[0] for r in names.collect()], key)
    else:
        found = _by_join(source, names, key, longest)
    return found.join(known, "name")


def region_links(mentions: DataFrame, key: str) -> DataFrame:
    """One row per text and region: number of mentions and the first place."""
    return mentions.groupBy(key, "kind", "code", "state_code").agg(F.count(F.lit(1)).alias("mentions"), F.min("start").alias("first_word"))


def state_scores(mentions: DataFrame, key: str) -> DataFrame:
    """Relevance of every state a text names, itself or by a district or city: its share of the text's mentions, to four places.

    The primary state has most mentions; of equal ones the first named, then the smallest code. A place whose name
    belongs to several states counts for each of them."""
    named = mentions.groupBy(key, "state_code").agg(F.count(F.lit(1)).alias("mentions"), F.min("start").alias("first_word"))
    text = Window.partitionBy(key)
    best = F.min(F.struct(-F.col("mentions"), "first_word", "state_code")).over(text)
    share = F.round(F.col("mentions") / F.sum("mentions").over(text), 4).cast("decimal(5,4)")
    return named.select(
        key, "state_code", "mentions", share.alias("relevance_score"),
        (best == F.struct(-F.col("mentions"), "first_word", "state_code")).alias("is_primary"), F.lit("keyword").alias("detection_method"),
    )
