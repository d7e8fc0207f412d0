"""Byte-level BPE by merge replay over a corpus of words, and decoding.

Each task gathers the distinct words (matches of the split pattern) that it has not met yet and replays the merges
over all of them at once: an inverted index leads from the token a pair would make to the positions of such pairs
in the words, the lowest rank is applied at all its positions, left to right, and only the two neighbours of a
merged position are looked at again. If a merge makes a pair of lower rank, that one goes first, as a
word-by-word encoder would do. A word that is a token itself is that token.

Texts are put together from remembered words. Those in use stay remembered, others are replayed again: an
exchange of all words between tasks would write more than the disk that the check allows. What is remembered is bounded per task.

Defined results: a null or empty text has no ids; ids decode to the exact bytes of the text; null ids, repeated rows and texts of any
length are encoded like any other; extra columns are ignored; an id outside the ranks raises an error in decoding.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import Remembered, in_small_batches

#: Words remembered per task (and as many set aside), and the longest (characters) remembered.
CACHE, CACHE_WORD = 400_000, 64
#: Letters and numbers under U+0250, as character classes of the standard library's matcher.
_NUMBER = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
_LETTER = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
#: Characters that the standard library's matcher may class differently: other white space, and from U+0250 on.
_SPECIAL = re.compile("[\x1c-\x1f\x85\xa0]|[^\x00-\u024f]")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Replay:
    """Merges of one rank table over many words at once."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.single = [ranks[bytes([b])] for b in range(256)]
        self.base = max(self.tokens) + 1
        self.made: dict[int, int] = {}  # pair (as left * base + right) to the token it makes, or -1

    def _make(self, pair: int) -> int:
        if len(self.made) > 1_000_000:
            self.made.clear()
        left, right = divmod(pair, self.base)
        made = self.made[pair] = self.ranks.get(self.tokens[left] + self.tokens[right], -1)
        return made

    def encode(self, words: Iterable[str]) -> dict[str, list[int]]:
        out: dict[str, list[int]] = {}
        token: list[int] = []  # by position; words lie one after the other, parted by -1
        starts: list[tuple[str, int]] = []
        where: defaultdict[int, list[int]] = defaultdict(list)  # token that a pair makes to the pair's positions
        single, ranks, base, make, made_of = self.single, self.ranks, self.base, self._make, self.made.get
        for word in words:
            raw = word.encode()
            whole = ranks.get(raw)
            if whole is not None:
                out[word] = [whole]
                continue
            out[word] = []
            at = len(token)
            starts.append((word, at))
            ids = [single[b] for b in raw]
            token += ids
            token.append(-1)
            for left, right in zip(ids, ids[1:]):
                made = made_of(left * base + right)
                if made is None:
                    made = make(left * base + right)
                if made >= 0:
                    where[made].append(at)
                at += 1
        after = list(range(1, len(token) + 1))
        before = list(range(-1, len(token) - 1))
        heap = list(where)
        heapq.heapify(heap)
        while heap:
            rank = heapq.heappop(heap)
            positions = where.pop(rank, None)
            if positions is None:
                continue
            positions.sort()
            for i, at in enumerate(positions):
                now = token[at]
                right = after[at]
                beside = token[right]
                if now < 0 or beside < 0:
                    continue
                made = made_of(now * base + beside)
                if made is None:
                    made = make(now * base + beside)
                if made != rank:  # one of the two has changed since the position was entered
                    continue
                token[at], token[right] = rank, -2
                follower = after[at] = after[right]
                before[follower] = at
                lower = False
                left = before[at]
                if left >= 0 and (now := token[left]) >= 0:
                    made = made_of(now * base + rank)
                    if made is None:
                        made = make(now * base + rank)
                    if made >= 0:
                        if made not in where:
                            heapq.heappush(heap, made)
                        where[made].append(left)
                        lower = made < rank
                beside = token[follower]
                if beside >= 0:
                    made = made_of(rank * base + beside)
                    if made is None:
                        made = make(rank * base + beside)
                    if made >= 0:
                        if made not in where:
                            heapq.heappush(heap, made)
                        where[made].append(at)
                        lower = lower or made < rank
                if lower and i + 1 < len(positions):
                    where[rank] += positions[i + 1 :]
                    heapq.heappush(heap, rank)
                    break
        for word, at in starts:
            ids = out[word]
            while token[at] >= 0:
                ids.append(token[at])
                at = after[at]
        return out


class TextEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import regex

        self.find = regex.compile(pattern).findall
        # In texts of characters under U+0250 the standard library's matcher finds the same words, faster.
        plain = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^\\s{_LETTER}{_NUMBER}]").replace(r"\p{L}", f"[{_LETTER}]").replace(r"\p{N}", f"[{_NUMBER}]")
        self.find_plain = self.find if r"\p" in plain else re.compile(plain).findall
        self.replay = Replay(ranks)
        self.words = Remembered(CACHE)

    def _words(self, text: str | None) -> list[str]:
        if not text:
            return []
        return self.find(text) if _SPECIAL.search(text) else self.find_plain(text)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        words, split = self.words, [self._words(t) for t in texts]
        met: set[str] = set()
        for part in split:
            met.update(part)
        fresh = {w: np.array(ids, dtype="<u4").tobytes() for w, ids in self.replay.encode(words.unknown(met)).items()}
        words.update((w, v) for w, v in fresh.items() if len(w) <= CACHE_WORD)
        out = []
        for part in split:
            try:
                out.append(b"".join(map(words.__getitem__, part)))
            except KeyError:
                out.append(b"".join([words[w] if w in words else fresh[w] for w in part]))
        return out


#: Texts encoded at once: bounds what is held beside the batch.
_TEXTS = 500


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and ids (array<int>) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(load_ranks(ranks_path), pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, _TEXTS):
                part = batch.slice(at, _TEXTS)
                ids = encoder.encode(part.column(1).to_pylist())
                ends = np.cumsum([0] + [len(x) // 4 for x in ids]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(ends), values)], ["doc_id", "ids"])

    source = in_small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with the bytes they stand for: doc_id, ids, decoded binary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: token for token, rank in load_ranks(ranks_path).items()}
        for batch in batches:
            out = [b"".join(map(tokens.__getitem__, ids.values.to_numpy().tolist())) if ids.is_valid else None for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def digests(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, n_tokens, SHA-256 of the decimal ids joined by spaces, SHA-256 of the decoded bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: token for token, rank in load_ranks(ranks_path).items()}
        decimal = {rank: b"%d" % rank for rank in tokens}
        for batch in batches:
            counts, of_ids, of_bytes = [], [], []
            for ids in batch.column(1):
                ids = ids.values.to_numpy().tolist()
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(b" ".join(map(decimal.__getitem__, ids))).hexdigest())
                of_bytes.append(hashlib.sha256(b"".join(map(tokens.__getitem__, ids))).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
