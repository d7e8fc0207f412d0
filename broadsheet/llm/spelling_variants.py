"""Spelling variants: words at edit distance one, found by pivotal grams, and the frequent form each leads to.

Grams are the bigrams of a word at their positions, ordered over the whole vocabulary from rare to common. A word's prefix is its
three least grams and all that tie with the last. Dynamic programming picks two pivots of the prefix that share no letter and
are rarest together. One edit spoils at most one of two disjoint grams, so of two near words the one whose prefix ends no later
keeps a pivot in the other's prefix: pivots are looked up in an index of the prefixes.

Position limits: the edit lies behind the kept gram, which then has the same place from the start, and all before it is alike; or
before it, with the same place from the end, and all behind it is alike. What is left on the other side differs by one
edit, so one half of the pivot word's rest is also alike, at the same end of the other's rest (whose length may differ by one). An index
key is the hash of side, gram with the part alike, and that half. Pairs with a key in common are verified by edit
distance, so a key is a filter only; it holds over half of a word, so no key gathers the words of a common gram.

Words are counted per task before the shuffle. Grams number at most the square of the alphabet (about 8,100), the only table
that reaches driver and tasks whole. Roots are followed by doubling: a form has at least twice its word's count, so a
chain is no longer than the logarithm of the largest count and the rounds are its logarithm.

Defined results: null and empty texts have no words; a null id plants no misspelling; repeated rows count as often as they
occur; ties are broken by code points; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import in_small_batches
from broadsheet.session import cut

LEAST_CHARS, LEAST_COUNT = 5, 3
#: UTF-8 of the letters A-Z (lower-cased) and U+00C0 to U+00FF.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
_FLUSH = 300_000


def spoilt(doc_id: int, word: bytes, every: int) -> bytes:
    """``word`` of a document, without one letter when ``every`` divides the crc32 of ``<doc_id>:<word>``."""
    h = zlib.crc32(word, zlib.crc32(b"%d:" % doc_id))
    if h % every:
        return word
    letters = word.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def word_counts(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, misspell_every: int | None = None) -> DataFrame:
    """word and n: occurrences over all texts. ``misspell_every`` plants misspellings for measuring (see ``spoilt``)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "c"]
            )

        held: Counter[bytes] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for word, n in Counter(_RUN.findall((text.as_py() or b"").lower())).items():
                    if misspell_every is not None and doc_id is not None:
                        word = spoilt(doc_id, word, misspell_every)
                    if len(word) >= least_chars and (len(word) >= 2 * least_chars or len(word.decode()) >= least_chars):
                        held[word] += n
                if len(held) >= _FLUSH:
                    yield flush()
                    held = Counter()
        if held:
            yield flush()

    source = in_small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return source.mapInArrow(counted, "word string, c long").groupBy("word").agg(F.sum("c").alias("n")).filter(F.col("n") >= least_count)


def gram_order(words: DataFrame) -> dict[str, tuple[int, str]]:
    """Order of every bigram: number of words' grams, then the gram."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for word in batch.column(0).to_pylist():
                held.update(map("".join, zip(word, word[1:])))
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["gram", "c"])

    rows = words.select("word").mapInArrow(counted, "gram string, c long").groupBy("gram").agg(F.sum("c").alias("c")).collect()
    return {r["gram"]: (r["c"], r["gram"]) for r in rows}


def prefix_of(word: str, order: dict[str, tuple[int, str]]) -> list[int]:
    """Places of the three least grams and of all that tie with the last of them, ascending."""
    ranks = [order[word[i : i + 2]] for i in range(len(word) - 1)]
    last = sorted(ranks)[min(2, len(ranks) - 1)]
    return [i for i, rank in enumerate(ranks) if rank <= last]


def pivots_of(word: str, prefix: list[int], order: dict[str, tuple[int, str]]) -> tuple[int, int]:
    """Two places of ``prefix`` whose grams share no letter and have the least sum of frequencies.

    From left to right: the best pair ending at a gram is that gram with the cheapest one that ended before it."""
    best: tuple[int, int, int] | None = None
    cheapest: tuple[int, int] | None = None  # among grams that end before the present one
    before = 0
    for at in prefix:
        while before < len(prefix) and prefix[before] + 2 <= at:
            cost = order[word[prefix[before] : prefix[before] + 2]][0]
            if cheapest is None or cost < cheapest[0]:
                cheapest = (cost, prefix[before])
            before += 1
        if cheapest is not None:
            cost = cheapest[0] + order[word[at : at + 2]][0]
            if best is None or cost < best[0]:
                best = (cost, cheapest[1], at)
    assert best is not None  # three grams at different places hold two that are disjoint
    return best[1], best[2]


def _key(side: str, alike: str, half: str, rest: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{side}{half} {alike} {rest}") - (1 << 63)


def _sides(word: str, at: int) -> Iterable[tuple[str, str, str]]:
    yield "a", word[: at + 2], word[at + 2 :]
    yield "b", word[at:], word[:at]


def pivot_keys(word: str, places: Iterable[int]) -> set[int]:
    """Keys of a word's pivots: each side, with either half of the rest."""
    found = set()
    for at in places:
        for side, alike, rest in _sides(word, at):
            half = len(rest) // 2
            found |= {_key(side, alike, "1", rest[:half]), _key(side, alike, "2", rest[half:])}
    return found


def prefix_keys(word: str, places: Iterable[int]) -> set[int]:
    """Keys of a word's prefix grams: each side, with the halves that a rest one letter shorter, equal or longer has."""
    found = set()
    for at in places:
        for side, alike, rest in _sides(word, at):
            for size in {max(0, len(rest) - 1), len(rest), len(rest) + 1}:
                half = size // 2
                found |= {_key(side, alike, "1", rest[:half]), _key(side, alike, "2", rest[max(0, len(rest) - (size - half)) :])}
    return found


def near_pairs(words: DataFrame) -> DataFrame:
    """a, b, n_a, n_b: pairs of words at edit distance one, each once (a before b)."""
    order = gram_order(words)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 5_000):
                part = batch.slice(start, 5_000)
                keys, rows, pivot = [], [], []
                for row, word in enumerate(part.column(0).to_pylist()):
                    prefix = prefix_of(word, order)
                    chosen, index = pivot_keys(word, pivots_of(word, prefix, order)), prefix_keys(word, prefix)
                    keys += [*chosen, *index]
                    rows += [row] * (len(chosen) + len(index))
                    pivot += [True] * len(chosen) + [False] * len(index)
                at = pa.array(rows, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(pivot), part.column(0).take(at), part.column(1).take(at)], ["key", "pivot", "word", "n"]
                )

    keys = cut(words.select("word", "n").mapInArrow(keyed, "key long, pivot boolean, word string, n long"), "grams")
    chosen = keys.filter("pivot").select("key", F.col("word").alias("a"), F.col("n").alias("n_a"))
    index = keys.filter("NOT pivot").select(F.col("key").alias("_key"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    met = chosen.join(index, (F.col("key") == F.col("_key")) & (F.col("a") != F.col("b")) & (F.abs(F.length("a") - F.length("b")) <= 1))
    found = met.filter(F.levenshtein("a", "b", 1) == 1)
    ordered = F.col("a") < F.col("b")
    return found.select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
        F.when(ordered, F.col("n_a")).otherwise(F.col("n_b")).alias("n_a"), F.when(ordered, F.col("n_b")).otherwise(F.col("n_a")).alias("n_b"),
    ).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word and root over rows (word, form): the last word when following forms, by doubling."""
    now = cut(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        then = now.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        ahead = now.join(then, F.col("root") == F.col("_word"), "left")
        now = cut(ahead.select("word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("_moved")), "roots")
        if not now.filter("_moved").limit(1).count():
            return now.select("word", "root")
        now = now.select("word", "root")


def group_variants(docs: DataFrame, misspell_every: int | None = None) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of ``docs`` (doc_id, text)."""
    words = cut(word_counts(docs, misspell_every=misspell_every), "words")
    pairs = cut(near_pairs(words), "pairs")
    both = pairs.select(F.col("a").alias("_word"), F.col("b").alias("near"), F.col("n_b").alias("_n")).unionByName(
        pairs.select(F.col("b").alias("_word"), F.col("a").alias("near"), F.col("n_a").alias("_n"))
    )
    best = both.groupBy("_word").agg(F.count(F.lit(1)).alias("_near"), F.min(F.struct((-F.col("_n")).alias("less"), "near")).alias("_best"))
    frequent = -F.col("_best.less") >= 2 * F.col("n")
    found = words.join(best, F.col("word") == F.col("_word"), "left").select(
        "word", "n", F.coalesce("_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("_best.near")).alias("form"), F.when(frequent, -F.col("_best.less")).alias("form_n"),
    )
    found = cut(found, "forms")
    last = roots(found.filter("form IS NOT NULL")).select(F.col("word").alias("_word"), "root")
    return found.join(last, F.col("word") == F.col("_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
