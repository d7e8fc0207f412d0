"""SimHash near-duplicates: pigeonhole blocks, verified Hamming distance, linked groups.

A fingerprint has 64 bits; a bit is set when it is set in over half of the XXH64 values of the text's
word shingles. Two fingerprints link when at most ``max_bits`` bits differ. Split into ``max_bits + 3``
blocks, such a pair agrees on three whole blocks at least, so joining on every choice of three blocks
misses no pair, and a bucket of about 27 bits stays small as the corpus grows.

Equal fingerprints are first merged into one row with the smallest id. Inside a bucket distances are
verified and the linked fingerprints spanned by a star per linked set, found by elimination: whatever
links to a visited fingerprint leaves the unvisited ones. So a bucket of g near copies gives g - 1 rows,
not all pairs, and no link is lost: two linked fingerprints always meet in a bucket, where they fall into one
set. Buckets are read as a sorted stream, not collected by key.

Defined results: a null or empty text has fingerprint zero and links like any other; a text with fewer
words than the shingle has one shingle of all its words; a row with a null id is a document of its own without links;
repeated rows are judged alike, and an id with two texts per row. Extra columns are ignored or passed through.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from broadsheet.llm.common import free_name, in_small_batches
from broadsheet.llm.components import components
from broadsheet.session import cut

AGREE = 3
#: Shingle values counted at once.
_SLICE = 1 << 16


def fingerprint(text: str | None, words_per_shingle: int = 4, seed: int = 42) -> int:
    """Unsigned fingerprint of one text (``bytes.split`` splits at space and the codes 9 to 13 only)."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    run, size = b" ".join(words), min(words_per_shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words]).tolist()
    ends = (ends - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(run[a:b], seed) for a, b in zip(starts, ends[size - 1 :])], dtype=np.uint64)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _SLICE):
        part = hashes[at : at + _SLICE].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.flatnonzero(counts * 2 > len(hashes))
    return sum(1 << int(b) for b in bits)


def fingerprint_column(text: str = "text", words_per_shingle: int = 4, seed: int = 42):
    """Fingerprints as signed longs."""

    @pandas_udf("long")
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, words_per_shingle, seed) for t in texts], dtype=np.uint64).astype(np.int64))

    return simhash(F.col(text))


def linked_sets(prints: np.ndarray, max_bits: int) -> np.ndarray:
    """Index of the first member of each fingerprint's linked set (links: at most ``max_bits`` bits differ)."""
    first, left = np.arange(len(prints)), np.arange(len(prints))
    while len(left) > 1:
        seed, left = left[0], left[1:]
        front = [seed]
        while front and len(left):
            # One fingerprint at a time keeps memory at the size of the bucket.
            near = np.bitwise_count(prints[left] ^ prints[front.pop()]) <= max_bits
            found = left[near]
            first[found] = seed
            front += found.tolist()
            left = left[~near]
    return first


def _bucket_edges(max_bits: int):
    def edges(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            if rest is not None:
                frame = pd.concat([rest, frame], ignore_index=True)
            table, bucket = frame["table"].to_numpy(), frame["bucket"].to_numpy()
            new = np.flatnonzero((table[1:] != table[:-1]) | (bucket[1:] != bucket[:-1])) + 1
            cuts = np.concatenate([[0], new])
            rest = frame.iloc[cuts[-1] :]
            yield from _spans(frame, cuts, max_bits)
        if rest is not None and len(rest) > 1:
            yield from _spans(rest, np.array([0, len(rest)]), max_bits)

    return edges


def _spans(frame: pd.DataFrame, cuts: np.ndarray, max_bits: int) -> Iterator[pd.DataFrame]:
    prints, ids = frame["print"].to_numpy().astype(np.uint64), frame["id"].to_numpy()
    a, b = [], []
    for start, end in zip(cuts[:-1], cuts[1:]):
        if end - start > 1:
            first = linked_sets(prints[start:end], max_bits)
            moved = np.flatnonzero(first != np.arange(end - start))
            a.append(ids[start:end][moved])
            b.append(ids[start:end][first[moved]])
    if a:
        yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})


def link_fingerprints(prints: DataFrame, max_bits: int = 4) -> DataFrame:
    """Columns node and component over rows (print long, id long) with distinct prints."""
    n_blocks = max_bits + AGREE
    edges = [round(64 * i / n_blocks) for i in range(n_blocks + 1)]
    masks = []
    for chosen in combinations(range(n_blocks), AGREE):
        mask = sum(((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in chosen)
        masks.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
    tables = F.explode(F.array(*[
        F.struct(F.lit(i).cast("short").alias("table"), F.col("print").bitwiseAND(F.lit(m).cast("long")).alias("bucket")) for i, m in enumerate(masks)
    ]))
    buckets = (
        prints.select("print", "id", tables.alias("t")).select("t.table", "t.bucket", "print", "id")
        .repartition("table", "bucket").sortWithinPartitions("table", "bucket", "id")
    )
    return components(buckets.mapInPandas(_bucket_edges(max_bits), "a long, b long"), "a", "b")


def groups(docs: DataFrame, max_bits: int = 4, words_per_shingle: int = 4, seed: int = 42) -> DataFrame:
    """doc_id, fingerprint (long) and component_id of every row."""
    prints = cut(in_small_batches(docs).select("doc_id", fingerprint_column("text", words_per_shingle, seed).alias("print")), "prints")
    named = prints.filter("doc_id IS NOT NULL")
    merged = cut(named.groupBy("print").agg(F.min("doc_id").alias("id")), "merged")
    linked = link_fingerprints(merged, max_bits)
    of_print = merged.join(linked, F.col("id") == F.col("node"), "left").select(
        F.col("print").alias("_print"), F.coalesce("component", "id").alias("component_id")
    )
    found = prints.join(of_print, F.col("print") == F.col("_print"), "left")
    return found.select("doc_id", F.col("print").alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def keep_first(docs: DataFrame, max_bits: int = 4) -> DataFrame:
    """The documents without those whose group has a smaller id; rows with a null id stay."""
    gone = free_name(docs, "_gone")
    out = groups(docs.filter("doc_id IS NOT NULL"), max_bits).filter("doc_id <> component_id").select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(out, F.col("doc_id") == F.col(gone), "left_anti")
