"""Periodic runs of words: recursive frequency splitting, then a lag scan of the segments that survive.

A run is a stretch of consecutive words whose smallest period is q, at least ``max(LEAST_LENGTH, LEAST_COPIES * q)`` words
long, which no neighbouring word extends with that period. So every word of a run occurs at least ``LEAST_COPIES`` times in
it. A word that occurs more rarely in its segment (first: its text) is in no run of that segment and splits it; the parts
are judged again by their own counts, until no word goes. A run never loses a word this way, so it lies in one surviving
segment whole, and the words around a segment cannot extend it.

A surviving segment of m words is scanned lag by lag, to m / LEAST_COPIES. A stretch that repeats at lag q for 3q words or
more holds three multiples of q in a row where the words at i and i + q are equal, so a lag looks at every q-th word first
(m log m comparisons over all lags) and compares the whole segment only where these three agree. Agreements inside a known
run whose period divides the lag are that run's own and skipped.

Texts stay where they are read: nothing is shuffled, a task holds one Arrow batch and judges a megabyte of it at once. Defined results: a null or empty
text has no words, no runs and an empty collapsed text; null ids and repeated rows are judged like any other row;
extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.expr import let
from broadsheet.llm.common import in_small_batches

LEAST_LENGTH, LEAST_COPIES = 6, 4
#: Words numbered per task, then forgotten; bytes of texts judged at once (a longer text alone).
CACHE, AT_ONCE = 100_000, 1 << 20

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def segments(words: np.ndarray, text: np.ndarray) -> list[tuple[int, int]]:
    """Stable segments (start, end) of numbered ``words``; ``text`` is the number of each word's text, ascending."""
    done: list[np.ndarray] = []
    alive, label = np.arange(len(words)), text
    width = int(words.max()) + 1 if len(words) else 1
    while len(alive):
        _, which, times = np.unique(label * width + words[alive], return_inverse=True, return_counts=True)
        stay = times[which] >= LEAST_COPIES
        # A segment that loses no word is stable; only the others are counted again.
        stable = np.bincount(label, ~stay)[label] == 0
        done.append(alive[stable])
        left = stay & ~stable
        alive, label = alive[left], label[left]
        if len(alive):
            alive, label = _long_enough(alive, _labels(alive, label))
    found = []
    for part in done:
        # Stable words of one round: their segments are stretches of neighbours within one text.
        if len(part):
            part, label = _long_enough(part, _labels(part, text[part]))
            starts = np.flatnonzero(np.diff(label, prepend=-1))
            found += zip(part[starts].tolist(), (part[np.append(starts[1:], len(part)) - 1] + 1).tolist() if len(part) else [])
    return sorted(found)


def _labels(places: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Numbers of the stretches of neighbouring places with one label."""
    new = np.ones(len(places), dtype=bool)
    new[1:] = (places[1:] != places[:-1] + 1) | (label[1:] != label[:-1])
    return np.cumsum(new) - 1


def _long_enough(places: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    stay = np.bincount(label)[label] >= LEAST_LENGTH
    return places[stay], label[stay]


def scan(words: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of one segment."""
    found: dict[tuple[int, int], int] = {}
    wide: list[tuple[int, int, int]] = []  # runs that may hold three multiples of the lag
    for lag in range(1, len(words) // LEAST_COPIES + 1):
        every = words[::lag]
        same = every[1:] == every[:-1]
        hits = np.flatnonzero(same[:-2] & same[1:-1] & same[2:]) * lag
        if not len(hits):
            continue
        wide = [r for r in wide if r[1] - r[0] > 3 * lag]
        for start, end, period in wide:
            if lag % period == 0:
                hits = hits[(hits < start) | (hits + 3 * lag >= end)]
        if not len(hits):
            continue
        # Stretches of equal words at this lag lie between neighbouring places of different ones.
        breaks = np.concatenate([[-1], np.flatnonzero(words[lag:] != words[:-lag]), [len(words) - lag]])
        for at in np.unique(np.searchsorted(breaks, hits)).tolist():
            start, end = int(breaks[at - 1]) + 1, int(breaks[at]) + lag
            if end - start >= max(LEAST_LENGTH, LEAST_COPIES * lag) and (start, end) not in found:
                found[start, end] = lag
                wide.append((start, end, lag))
    return [(start, end - start, period) for (start, end), period in found.items()]


class Numbers(dict):
    """Numbers of words in order of their first sight."""

    def __missing__(self, word: bytes) -> int:
        self[word] = value = len(self)
        return value


def runs_of_texts(texts: list[bytes | None], known: Numbers | None = None) -> Iterator[tuple[int, list[tuple[int, int, int]], bytes]]:
    """Per text: number of words, runs by start and period, and the words that stay, joined by one space.

    A run keeps its first period; its other words go (``bytes.split`` splits at space and the codes 9 to 13 only)."""
    known = Numbers() if known is None else known
    split = [(t or b"").split() for t in texts]
    sizes = np.array([len(ws) for ws in split], dtype=np.int64)
    numbers = np.fromiter((known[w] for ws in split for w in ws), np.int64, int(sizes.sum()))
    first = np.cumsum(sizes) - sizes
    of = np.repeat(np.arange(len(split)), sizes)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in split]
    for start, end in segments(numbers, of):
        text = int(of[start])
        runs[text] += [(s + start - int(first[text]), length, period) for s, length, period in scan(numbers[start:end])]
    for ws, mine in zip(split, runs):
        mine.sort(key=lambda r: (r[0], r[2]))
        if mine:
            stay = np.ones(len(ws), dtype=bool)
            for start, length, period in mine:
                stay[start + period : start + length] = False
            yield len(ws), mine, b" ".join([ws[i] for i in np.flatnonzero(stay).tolist()])
        else:
            yield len(ws), mine, b" ".join(ws)


def find_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs and collapsed text of every row of ``docs`` (doc_id, text)."""

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Numbers()
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
            start = 0
            while start < batch.num_rows:
                done = sizes[start - 1] if start else 0
                end = max(start + 1, int(np.searchsorted(sizes, done + AT_ONCE, side="right")))
                if len(known) > CACHE:
                    known.clear()
                yield one(batch.slice(start, end - start), known)
                start = end

    def one(part: pa.RecordBatch, known: Numbers) -> pa.RecordBatch:
        sizes, runs, kept = [], [], []
        for n, mine, text in runs_of_texts(part.column(1).to_pylist(), known):
            sizes.append(n)
            runs.append([{"start": s, "length": length, "period": p} for s, length, p in mine])
            kept.append(text)
        return pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(sizes, pa.int64()), pa.array(runs, pa.list_(RUN)), pa.array(kept, pa.binary()).cast(pa.string())],
            ["doc_id", "n_words", "runs", "collapsed"],
        )

    source = in_small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return source.mapInArrow(judged, SCHEMA)


def highest(runs: Column) -> Column:
    """The run of greatest length / period, compared exactly; the first of equal ones; null where there is none."""
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    return F.aggregate(runs, none, lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r
    ).otherwise(best))


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text), a tenth of them (by id) with a periodic tail planted, for measuring the detection.

    With h the crc32 of the decimal id and g = h div 10, a text of n words with h mod 10 = 0 repeats its words from
    a = g mod n on with period 1 + (n - a) div (3 + g mod 8). Null ids and empty texts stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def tailed(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        period = 1 + F.floor((n - a) / (3 + g % 8))
        return F.when(n > 0, F.array_join(F.transform(
            F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % period).cast("int"))
        ), " ")).otherwise(F.lit(""))

    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return docs.select("doc_id", F.when((h % 10 == 0) & F.col("text").isNotNull(), let(words, tailed)).otherwise(F.col("text")).alias("text"))
