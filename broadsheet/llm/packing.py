"""Packing of token sequences into fixed windows by best-fit decreasing.

A document longer than a window is first cut into full windows; what is left of it, and every shorter
document, goes to the open window with the least remaining room that still holds it. A segment tree over
the remaining capacities finds that window in a logarithm of the window size.

Packing is done per group of about ``GROUP_PIECES`` pieces (by the hash of the document id and start), whose number
follows the input: each group wastes at most a few windows. The pieces are written once before they are
grouped, so a lost executor repeats a group with the same result.

Token ids come from a public tokenizer whose words are separated by ASCII white space; words are encoded
once per task and remembered (bounded), which gives the same ids as encoding the text.

Defined results: a null or empty text is its end token alone; null ids and repeated rows are packed like any
other row; extra columns are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import gc
import os
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import Remembered, in_small_batches
from broadsheet.session import cut

WINDOW = 2048
END_ID = 1
GROUP_PIECES = 100_000
#: Words remembered per task (and as many set aside), and the largest word remembered.
CACHE, CACHE_WORD = 400_000, 64
_TAIL = b".,!?;:%&*$#|"
#: Texts encoded at once.
_TEXTS = 1_000


@contextmanager
def _without_gc() -> Iterator[None]:
    """No search for reference cycles: for code that makes none, beside large memories that every search would walk through."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


class WordEncoder:
    """Token ids of texts as little-endian unsigned 32-bit integers.

    ``bytes.split`` separates at space and the codes 9 to 13, where the tokenizer also separates. A word is a stem and a tail
    of punctuation, between which the tokenizer's pattern always splits; it lower-cases, so stems are lower-cased
    first. Stems of plain letters are one pattern match each and are encoded many in one call: the last
    token of a match is marked as the end of a word, which gives the ids of each stem back.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known, self.stems = Remembered(CACHE), Remembered(CACHE)

    def _stems(self, stems: set[bytes]) -> dict[bytes, bytes]:
        made = {}
        texts = {s: s.decode() for s in stems}
        # U+0130 lower-cases to two characters; ``bytes.isalpha`` holds for ASCII letters only.
        plain = [s for s, t in texts.items() if s.isalpha() or (t.isalpha() and max(t) < "\u0250" and "\u0130" not in t)]
        for at in range(0, len(plain), 2_000):
            part = plain[at : at + 2_000]
            # The fast form gives the same ids without offsets, which nothing here looks at.
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join([texts[s] for s in part])], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(part):
                raw, before = ids.tobytes(), 0
                for stem, end in zip(part, (4 * cuts).tolist()):
                    made[stem] = raw[before:end]
                    before = end
        rest = [s for s in stems if s not in made]
        for at in range(0, len(rest), 10_000):
            part = rest[at : at + 10_000]
            for stem, e in zip(part, self.tokenizer.encode_batch_fast([texts[s] for s in part], add_special_tokens=False)):
                made[stem] = np.array(e.ids, dtype="<u4").tobytes()
        return made

    def encode(self, texts: list[str | None]) -> list[bytes]:
        with _without_gc():
            return self._encode(texts)

    def _encode(self, texts: list[str | None]) -> list[bytes]:
        split, known = [(t or "").encode().split() for t in texts], self.known
        missing: set[bytes] = set()
        for words in split:
            missing.update(words)
        parts = {}
        for word in known.unknown(missing):
            stem, tail = word, b""
            if b"<|" not in word:  # the written form of a special token is kept as it is
                stem = word.lower()
                short = stem.rstrip(_TAIL)
                if len(short) < len(stem) and _ends_plainly(short):
                    stem, tail = short, stem[len(short) :]
            parts[word] = (stem, tail)
        stems = self.stems
        wanted = {pair[0] for pair in parts.values()}
        wanted.update([pair[1] for pair in parts.values()])
        wanted.discard(b"")
        fresh = self._stems(stems.unknown(wanted))
        stems.update(fresh)
        stems[b""] = b""
        now: dict[bytes, bytes] = {}
        for word, (stem, tail) in parts.items():
            value = stems[stem] + stems[tail] if tail else stems[stem]
            if len(word) <= CACHE_WORD:
                known[word] = value
            else:
                now[word] = value
        for long in [s for s in fresh if len(s) > CACHE_WORD]:
            del stems[long]
        if now:
            return [b"".join([known[w] if w in known else now[w] for w in words]) for words in split]
        return [b"".join(map(known.__getitem__, words)) for words in split]


def _ends_plainly(stem: bytes) -> bool:
    """Whether a stem ends in a letter or digit, behind which the tokenizer splits punctuation off."""
    if not stem or stem[-1] < 128:
        return stem[-1:].isalnum()
    last = stem.decode()[-1]
    return last.isalnum() and last < "\u0250" and last != "\u0130"


def pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens: full windows and one remainder per document."""

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = WordEncoder(tokenizer), int(end_id).to_bytes(4, "little")
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

        for batch in batches:
            for at in range(0, batch.num_rows, _TEXTS):
                part, rows = batch.slice(at, _TEXTS), []
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist())):
                    ids += end
                    total = len(ids) // 4
                    for start in range(0, total, window):
                        piece = ids[4 * start : 4 * (start + window)]
                        rows.append((doc_id, start, len(piece) // 4, zlib.crc32(piece), total))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)

    source = in_small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(cut_up, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


class OpenWindows:
    """Open windows by remaining capacity under a segment tree; ``take`` is a best fit."""

    def __init__(self, window: int) -> None:
        self.base = 1 << window.bit_length()
        self.tree = [0] * (2 * self.base)  # open windows under each node
        self.at: list[list[int]] = [[] for _ in range(window + 1)]
        self.window, self.made = window, 0

    def _count(self, capacity: int, step: int) -> None:
        node = self.base + capacity
        while node:
            self.tree[node] += step
            node >>= 1

    def _tightest(self, need: int) -> int:
        """Smallest capacity of an open window that is at least ``need``, or -1."""
        tree, node = self.tree, self.base + need
        if tree[node]:
            return need
        while node > 1:
            if not node & 1 and tree[node + 1]:
                node += 1
                while node < self.base:
                    node = 2 * node if tree[2 * node] else 2 * node + 1
                return node - self.base
            node >>= 1
        return -1

    def take(self, size: int) -> tuple[int, int]:
        """Window and offset for a piece of ``size`` tokens."""
        capacity = self._tightest(size)
        if capacity < 0:
            capacity, number = self.window, self.made
            self.made += 1
        else:
            number = self.at[capacity].pop()
            self._count(capacity, -1)
        if capacity > size:
            self.at[capacity - size].append(number)
            self._count(capacity - size, 1)
        return number, self.window - capacity


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """The pieces with sequence_id and offset; sequence ids are unique, group by group."""
    cut_pieces = cut(pieces(docs, tokenizer, window, end_id), "pieces")
    n_groups = max(1, -(-cut_pieces.count() // group_pieces))

    def best_fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
        windows = OpenWindows(window)
        placed = np.array([windows.take(int(n)) for n in rows["length"]], dtype=np.int64).reshape(-1, 2)
        rows["sequence_id"] = placed[:, 0] + (rows["_group"].to_numpy().astype(np.int64) << 32)
        rows["offset"] = placed[:, 1]
        return rows.drop(columns="_group")

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    group = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(n_groups)).alias("_group")
    return cut_pieces.select("*", group).groupBy("_group").applyInPandas(best_fit, schema)
