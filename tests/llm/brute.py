"""Plain single-machine versions of the training-data operators, for comparison on small tables."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

SPACE = " \t\n\x0b\x0c\r"


def words(text):
    return [w.decode() for w in (text or "").encode().split()]


def quality_base(text):
    text = text or ""
    ws = words(text)
    windows = Counter(zip(ws, ws[1:], ws[2:]))
    covered = {i + k for i in range(len(ws) - 2) if windows[tuple(ws[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    return (
        len(ws), sum(map(len, ws)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
        len(ws) < 50 or 100 * len(covered) > 50 * len(ws),
    )


def binomial_tail(k, n, p):
    return sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))


def lower_az(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def line_dedup(docs, min_chars=10):
    """docs: (doc_id, text). Per row: lines, dropped, text."""
    holders = defaultdict(set)
    for doc_id, text in docs:
        if doc_id is not None:
            for line in (text or "").split("\n"):
                holders[lower_az(line.strip(SPACE))].add(doc_id)
    out = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            key = lower_az(line.strip(SPACE))
            if doc_id is None or len(key) < min_chars or len(holders[key]) < 2 or min(holders[key]) == doc_id:
                kept.append(line)
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def fingerprint(text):
    ws = [lower_az(w) for w in words(text)]
    if not ws:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(ws[i : i + 4]).encode(), 42) for i in range(max(1, len(ws) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def simhash_groups(docs, max_bits=4):
    """docs: (doc_id, text) with ids. doc_id to (fingerprint, component)."""
    docs = sorted(docs, key=lambda d: d[0])
    prints = [fingerprint(t) for _, t in docs]
    pairs = [(i, j) for i in range(len(docs)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= max_bits]
    return {docs[i][0]: (prints[i], docs[r][0]) for i, r in enumerate(linked(len(docs), pairs))}


def vector_groups(vectors, threshold=0.9):
    """vectors: (vec_id, list or None). vec_id to (links, component)."""
    vectors = sorted(vectors, key=lambda v: v[0])
    good = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in vectors]

    def cosine(a, b):
        a, b = np.array(a, dtype=np.float32).astype(float), np.array(b, dtype=np.float32).astype(float)
        return a @ b / math.sqrt(a @ a) / math.sqrt(b @ b)

    pairs = [
        (i, j) for i in range(len(vectors)) for j in range(i)
        if good[i] and good[j] and len(vectors[i][1]) == len(vectors[j][1]) and cosine(vectors[i][1], vectors[j][1]) >= threshold
    ]
    links = Counter(x for p in pairs for x in p)
    return {vectors[i][0]: (links[i], vectors[r][0]) for i, r in enumerate(linked(len(vectors), pairs))}


def base_scores(docs, held):
    """docs: (doc_id, text). Per row (n_tokens, n_known, N, base score)."""
    tokens = [[lower_az(w) for w in words(t)] + ["\n"] for _, t in docs]
    counts = Counter(w for (d, _), ws in zip(docs, tokens) if not held(d) for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    return [
        (len(ws), sum(counts[w] > 0 for w in ws), total, sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in ws))
        for ws in tokens
    ]


def remainder(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus
