"""Reversible line dedup: cuckoo filters per shard in front of exact reference counts.

A line's key is the line without white space at its ends, A-Z lower-cased; keys under ``min_chars`` code
points are never touched. A key held by two documents or more stays only in the one with the smallest id.
Keys travel as 128-bit digests in two longs.

* ``references`` is one row per key and document, the exact base of everything.
* ``reference_counts`` holds per key the references and the smallest and largest id.
* ``build_filters`` puts keys into one cuckoo filter per shard (16-bit fingerprints, four slots a bucket,
  two candidate buckets), which support insertion and deletion without a rebuild.
* ``probe`` streams keys, sorted by shard, past their filter; only possible hits (all true ones and about one in
  eight thousand others) go on to the exact join, so most of a batch never touches the count table.

``LineStore`` keeps these tables for incremental use: inserting and later deleting the same documents
restores counts and membership. ``remove_repeats`` does one whole table.

Defined results: a null or empty text is one empty line and stays as it is; rows with a null id hold no keys and lose no lines; repeated rows of an id are
one document; texts of any length are split once; extra columns pass through ``remove_repeats`` (one named _lines is replaced).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from broadsheet.llm.common import SPACE, free_name, in_small_batches
from broadsheet.session import cut, scratch_path

MIN_CHARS = 10
#: Keys per filter shard; the number of shards follows the number of keys.
SHARD_KEYS = 250_000
#: A shard's keys are read by this many streams, each with a copy of its filter.
STREAMS = 4
_FLUSH = 100_000


def line_key(line: str, min_chars: int = MIN_CHARS) -> bytes | None:
    """128-bit digest of a line's key; None when the key is too short to count."""
    key = line.strip(SPACE)
    # Bytes lower-case A-Z only.
    return hashlib.blake2b(key.encode().lower(), digest_size=16).digest() if len(key) >= min_chars else None


def _longs(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def references(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """k1, k2, doc_id: one row per distinct key of each row of ``docs``."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(digests: list[bytes], ids: list[int]) -> pa.RecordBatch:
            k1, k2 = _longs(digests)
            return pa.RecordBatch.from_arrays([pa.array(k1), pa.array(k2), pa.array(ids, pa.int64())], ["k1", "k2", "doc_id"])

        digests: list[bytes] = []
        ids: list[int] = []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = {k for line in (text.as_py() or "").split("\n") if (k := line_key(line, min_chars))}
                digests += found
                ids += [doc_id] * len(found)
                if len(ids) >= _FLUSH:
                    yield flush(digests, ids)
                    digests, ids = [], []
        if ids:
            yield flush(digests, ids)

    named = in_small_batches(docs).filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return named.mapInArrow(keys, "k1 long, k2 long, doc_id long")


def reference_counts(refs: DataFrame) -> DataFrame:
    """Per key: references, smallest and largest document; combined before the shuffle."""
    return refs.groupBy("k1", "k2").agg(
        F.count(F.lit(1)).alias("n_refs"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc")
    )


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; a key may lie in either of two buckets. Bulk operations on arrays."""

    SLOTS = 4

    def __init__(self, capacity: int = 0, table: np.ndarray | None = None) -> None:
        if table is None:
            buckets = 1 << max(2, int(np.ceil(np.log2(max(1, capacity) / (0.84 * self.SLOTS)))))
            table = np.zeros((buckets, self.SLOTS), dtype=np.uint16)
        self.table = table

    @classmethod
    def from_bytes(cls, raw: bytes) -> CuckooFilter:
        return cls(table=np.frombuffer(raw, dtype="<u2").reshape(-1, cls.SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    def _place(self, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bits = k2.astype(np.int64).view(np.uint64)
        prints = (bits & np.uint64(0xFFFF)).astype(np.uint16)
        prints[prints == 0] = 1
        return ((bits >> np.uint64(16)) & np.uint64(len(self.table) - 1)).astype(np.int64), prints

    def _other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return bucket ^ ((prints.astype(np.int64) * 0x5BD1E995) & (len(self.table) - 1))

    def contains(self, k2: np.ndarray) -> np.ndarray:
        bucket, prints = self._place(k2)
        wide = prints[:, None]
        return (self.table[bucket] == wide).any(axis=1) | (self.table[self._other(bucket, prints)] == wide).any(axis=1)

    def insert(self, k2: np.ndarray, rounds: int = 300) -> bool:
        """Insert distinct keys; False when the filter is too full (the caller rebuilds a larger one)."""
        bucket, prints = self._place(k2)
        for turn in range(rounds):
            for _ in range(2):
                for slot in range(self.SLOTS):
                    if not len(bucket):
                        return True
                    free = np.flatnonzero(self.table[bucket, slot] == 0)
                    _, one = np.unique(bucket[free], return_index=True)
                    chosen = free[one]
                    self.table[bucket[chosen], slot] = prints[chosen]
                    bucket, prints = np.delete(bucket, chosen), np.delete(prints, chosen)
                bucket = self._other(bucket, prints)
            if not len(bucket):
                return True
            # Every full bucket gives up one fingerprint for a waiting one.
            _, chosen = np.unique(bucket, return_index=True)
            slot = turn % self.SLOTS
            out = self.table[bucket[chosen], slot].copy()
            self.table[bucket[chosen], slot] = prints[chosen]
            prints[chosen] = out
            bucket[chosen] = self._other(bucket[chosen], out)
        return not len(bucket)

    def delete(self, k2: np.ndarray) -> None:
        """Remove one fingerprint for each key, all of which were inserted before."""
        bucket, prints = self._place(k2)
        while len(bucket):
            before = len(bucket)
            for _ in range(2):
                for slot in range(self.SLOTS):
                    hit = np.flatnonzero(self.table[bucket, slot] == prints)
                    _, one = np.unique(bucket[hit], return_index=True)
                    chosen = hit[one]
                    self.table[bucket[chosen], slot] = 0
                    bucket, prints = np.delete(bucket, chosen), np.delete(prints, chosen)
                bucket = self._other(bucket, prints)
            if len(bucket) == before:
                raise ValueError("deleted keys were not in the filter")


def _filled(k2: np.ndarray, least: int = 16) -> CuckooFilter:
    capacity = max(least, len(k2))
    while not (made := CuckooFilter(capacity)).insert(k2):
        capacity *= 2
    return made


def build_filters(keys: DataFrame, n_shards: int, spare: bool = False) -> DataFrame:
    """shard, filter: one cuckoo filter per shard of the distinct keys k1, k2; ``spare``: with room for as many again."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        made = _filled(rows["k2"].to_numpy(), max(1024, 2 * len(rows)) if spare else 16)
        return pd.DataFrame({"shard": [int(rows["shard"].iloc[0])], "filter": [made.to_bytes()]})

    sharded = keys.select(F.pmod("k1", F.lit(n_shards)).cast("int").alias("shard"), "k2")
    return sharded.groupBy("shard").applyInPandas(build, "shard int, filter binary")


def probe(keys: DataFrame, filters: DataFrame, n_shards: int) -> DataFrame:
    """Rows k1, k2, doc_id whose key may be in its shard's filter; none that is in it is lost."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, now = None, None
        for batch in batches:
            shards = batch.column(0).to_numpy()
            k2 = batch.column(3).fill_null(0).to_numpy()
            keep = np.zeros(len(shards), dtype=bool)
            edges = [0, *(np.flatnonzero(shards[1:] != shards[:-1]) + 1), len(shards)]
            for a, b in zip(edges[:-1], edges[1:]):
                if a == b:
                    continue
                if shards[a] != shard:
                    shard, now = shards[a], None
                if batch.column(5)[a].is_valid:  # the filter comes before the shard's keys
                    now = CuckooFilter.from_bytes(batch.column(5)[a].as_py())
                    a += 1
                if now is not None and a < b:
                    keep[a:b] = now.contains(k2[a:b])
            if keep.any():
                kept = batch.filter(pa.array(keep))
                yield pa.RecordBatch.from_arrays([kept.column(i) for i in (2, 3, 4)], ["k1", "k2", "doc_id"])

    shard = F.pmod("k1", F.lit(n_shards)).cast("int").alias("shard")
    none = F.lit(None)
    rows = keys.select(shard, F.pmod(F.xxhash64("doc_id"), F.lit(STREAMS)).cast("int").alias("stream"), "k1", "k2", "doc_id", none.cast("binary").alias("filter"))
    heads = filters.select(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(STREAMS - 1))).alias("stream"),
        none.cast("long").alias("k1"), none.cast("long").alias("k2"), none.cast("long").alias("doc_id"), "filter",
    )
    both = rows.unionByName(heads).repartition("shard", "stream")
    return both.sortWithinPartitions("shard", "stream", F.col("filter").isNull()).mapInArrow(stream, "k1 long, k2 long, doc_id long")


def _shards(n_keys: int) -> int:
    return max(1, -(-n_keys // SHARD_KEYS))


def drops(refs: DataFrame, shared: DataFrame) -> DataFrame:
    """doc_id and the array ``_keys`` of struct(k1, k2) that it loses. ``shared``: counts of keys in two documents or more."""
    n_shards = _shards(shared.count())
    filters = cut(build_filters(shared, n_shards), "filters")
    maybe = probe(refs, filters, n_shards)
    lost = maybe.join(shared.select("k1", "k2", "first_doc"), ["k1", "k2"]).filter("doc_id <> first_doc")
    return lost.groupBy("doc_id").agg(F.collect_set(F.struct("k1", "k2")).alias("_keys"))


def _kept_lines(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """Text without the lines of the given keys, and how many lines there were and went."""
    for texts, keys, least in batches:
        out, n_lines, n_dropped = [], [], []
        for text, lost, min_chars in zip(texts, keys, least):
            lines = (text or "").split("\n")
            n_lines.append(len(lines))
            if lost is not None and len(lost):
                gone = {int(k["k1"]).to_bytes(8, "little", signed=True) + int(k["k2"]).to_bytes(8, "little", signed=True) for k in lost}
                kept = [line for line in lines if line_key(line, min_chars) not in gone]
                text = "\n".join(kept)
                n_dropped.append(len(lines) - len(kept))
            else:
                n_dropped.append(0)
            out.append(text)
        yield pd.DataFrame({"text": out, "n_lines": n_lines, "n_dropped": n_dropped})


def _without(docs: DataFrame, lost: DataFrame, min_chars: int) -> DataFrame:
    """``docs`` with the struct ``_lines`` (text, n_lines, n_dropped)."""
    id_name, keys_name = free_name(docs, "_lost_id"), free_name(docs, "_keys")
    named = lost.select(F.col("doc_id").alias(id_name), F.col("_keys").alias(keys_name))
    kept_lines = pandas_udf(_kept_lines, "text string, n_lines long, n_dropped long")
    joined = docs.join(named.hint("shuffle_hash"), F.col("doc_id").cast("long") == F.col(id_name), "left").drop(id_name)
    return joined.withColumn("_lines", kept_lines("text", keys_name, F.lit(min_chars))).drop(keys_name)


def remove_repeats(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with the struct ``_lines``: the text kept (null stays null), n_lines before and n_dropped."""
    refs = cut(references(docs, min_chars), "refs")
    shared = cut(reference_counts(refs).filter("first_doc <> last_doc"), "shared")
    return _without(docs, drops(refs, shared), min_chars)


class LineStore:
    """Incremental line dedup over tables in a folder that all executors share.

    Every change writes a new generation of the tables and only then names it in ``generation``; a failed
    change leaves the old one. Documents of a batch must be new to the store (insert) or in it (delete).
    A shard whose filter is full is rebuilt from the exact counts, with room for as many keys again; when shards would hold more than
    ``SHARD_KEYS`` keys on average their number doubles, so the store grows without a limit.
    """

    def __init__(self, spark: SparkSession, n_shards: int = 16, min_chars: int = MIN_CHARS) -> None:
        self.spark, self.n_shards, self.min_chars = spark, n_shards, min_chars
        empty = spark.createDataFrame([], "k1 long, k2 long, doc_id long")
        self.generation = ""
        self._write(empty, reference_counts(empty), spark.createDataFrame([], "shard int, filter binary"))

    def _write(self, refs: DataFrame, counts: DataFrame, filters: DataFrame) -> None:
        path = scratch_path(self.spark, "lines")
        for name, df in (("refs", refs), ("counts", counts), ("filters", filters)):
            df.write.parquet(f"{path}/{name}")
        self.generation = path

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.generation}/{name}")

    def _merge_filters(self, added: DataFrame, gone: DataFrame) -> DataFrame:
        """Filters after inserting and deleting distinct keys; only shards with changes run code."""

        def change(old: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            shard = int(old["shard"].iloc[0] if len(old) else rows["shard"].iloc[0])
            new, out = rows.loc[rows["new"], "k2"].to_numpy(), rows.loc[~rows["new"], "k2"].to_numpy()
            made = CuckooFilter.from_bytes(old["filter"].iloc[0]) if len(old) else CuckooFilter(max(1024, 2 * len(new)))
            made.delete(out)
            # A null filter is full.
            return pd.DataFrame({"shard": [shard], "filter": [made.to_bytes() if made.insert(new) else None]})

        shard = F.pmod("k1", F.lit(self.n_shards)).cast("int").alias("shard")
        changes = added.select(shard, "k2", F.lit(True).alias("new")).unionByName(gone.select(shard, "k2", F.lit(False).alias("new")))
        return self.read("filters").groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(change, "shard int, filter binary")

    def _grown_filters(self, counts: DataFrame, added: DataFrame, n_shards: int) -> DataFrame:
        """Filters after inserting the distinct keys ``added``; ``counts`` holds all keys, these included."""
        if n_shards != self.n_shards:
            return build_filters(counts, n_shards, spare=True)
        merged = cut(self._merge_filters(added, added.limit(0)), "filters")
        full = [r["shard"] for r in merged.filter("filter IS NULL").select("shard").collect()]
        if not full:
            return merged
        again = counts.filter(F.pmod("k1", F.lit(n_shards)).isin(full))
        return merged.filter("filter IS NOT NULL").unionByName(build_filters(again, n_shards, spare=True))

    def _touched(self, batch: DataFrame) -> DataFrame:
        """Stored counts of the keys of ``batch``: filter first, exact join for possible hits only."""
        maybe = probe(batch.select("k1", "k2", F.lit(0).cast("long").alias("doc_id")).distinct(), self.read("filters"), self.n_shards)
        return self.read("counts").join(maybe.select("k1", "k2"), ["k1", "k2"], "left_semi")

    def insert(self, docs: DataFrame) -> None:
        refs = cut(references(docs, self.min_chars).distinct(), "refs")
        fresh = reference_counts(refs)
        old = cut(self._touched(fresh), "touched")
        merged = fresh.unionByName(old).groupBy("k1", "k2").agg(
            F.sum("n_refs").alias("n_refs"), F.min("first_doc").alias("first_doc"), F.max("last_doc").alias("last_doc")
        )
        counts = cut(self.read("counts").join(old.select("k1", "k2"), ["k1", "k2"], "left_anti").unionByName(merged), "counts")
        n_keys, n_shards = counts.count(), self.n_shards
        while n_keys > n_shards * SHARD_KEYS:
            n_shards *= 2
        added = fresh.join(old, ["k1", "k2"], "left_anti")
        self._write(self.read("refs").unionByName(refs), counts, self._grown_filters(counts, added, n_shards))
        self.n_shards = n_shards

    def delete(self, docs: DataFrame) -> None:
        ids = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
        gone = cut(self.read("refs").join(ids, "doc_id", "left_semi").select("k1", "k2", "doc_id"), "gone")
        keys = gone.select("k1", "k2").distinct()
        left = cut(self.read("refs").join(ids, "doc_id", "left_anti").select("k1", "k2", "doc_id"), "left")
        again = reference_counts(left.join(keys, ["k1", "k2"], "left_semi"))
        counts = self.read("counts").join(keys, ["k1", "k2"], "left_anti").unionByName(again)
        ended = keys.join(again, ["k1", "k2"], "left_anti")
        self._write(left, counts, self._merge_filters(ended.limit(0), ended))

    def kept(self, docs: DataFrame) -> DataFrame:
        """As :func:`remove_repeats`, against everything in the store; ``docs`` are stored documents."""
        shared = cut(self.read("counts").filter("first_doc <> last_doc"), "shared")
        return _without(docs, drops(references(docs, self.min_chars).distinct(), shared), self.min_chars)
