"""Toxic spans by a linear-chain conditional random field with two tags.

Only documents are labelled, so token labels are derived from them: a token of a toxic document is
labelled toxic when one of its features (the word, or one of its prefixes) marks toxicity: it is far more
frequent, by documents, in toxic than in clean ones, and either occurs in a good part of the toxic documents or
explains toxic documents that no stronger mark explains. All other tokens are labelled clean. The field has a bias,
one weight per selected feature, and the tag transitions. It is fitted by gradient ascent with exact
forward-backward sums over sentences of at most ``WINDOW`` tokens; sentences with the same features and
tags are alike and enter once, with their count as weight.

Scoring runs forward-backward over each whole text. Tokens without a selected feature all have the same
factor, so a run of them is one power of the transition matrix and costs one step. Marginals give the
offending spans (code point offsets in the text) and the score, the largest marginal of any token.

The fit takes a bounded sample: at most ``max_toxic`` and ``max_clean`` labelled documents, by the
hash of their id; whole texts are used, exact and near copies count once. Everything else runs over all rows.

Defined results: null and empty texts have no tokens, no spans, and the score of a single clean
background token; without labels of both classes the field is empty and all texts score alike, low. Extra columns are
ignored or passed through; repeated rows score alike.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from broadsheet.llm.common import in_small_batches

WORD = re.compile(r"\w+")
PREFIXES = (3, 4, 5, 6)
WINDOW = 16
SPAN_LEVEL = 0.5
MAX_TOXIC, MAX_CLEAN = 1_500, 2_500
#: Known words are remembered per task up to this many, then forgotten.
CACHE = 150_000


def features(word: str) -> list[str]:
    """The word itself and its prefixes, of a lower-cased word."""
    return [f"={word}", *(word[:n] for n in PREFIXES if len(word) >= n)]


def sample(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> list[tuple[str, int]]:
    """Texts and labels of at most ``max_toxic + max_clean`` labelled documents, chosen by the hash of the id."""
    marked = (
        labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("_toxic"))
    )
    chosen = None
    for value, bound in ((1, max_toxic), (0, max_clean)):
        part = marked.filter(F.col("_toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most max_toxic + max_clean ids of a few bytes each are broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).orderBy("doc_id")
    return [(row["text"] or "", row["_toxic"]) for row in rows.collect()]


def _fixed_hash(words: Iterable[str]) -> int:
    """The same in every process, unlike ``hash``."""
    return xxhash.xxh3_64_intdigest(" ".join(words).encode())


def _without_copies(texts: list[tuple[str, int]]) -> list[tuple[list[str], int]]:
    """Lower-cased words of the texts; a text whose sampled three-word windows were mostly seen before is left out."""
    seen: set[int] = set()
    out = []
    for text, toxic in texts:
        words = [w.lower() for w in WORD.findall(text)]
        prints = {h for h in map(_fixed_hash, zip(words, words[1:], words[2:])) if h % 8 == 0} or {_fixed_hash(words)}
        if len(prints & seen) * 3 < len(prints):
            out.append((words, toxic))
        seen |= prints
    return out


def _document_counts(docs: Iterable[list[str]], known: set[str] | None = None) -> Counter:
    counts: Counter = Counter()
    for words in docs:
        found = {f for word in set(words) for f in features(word)}
        counts.update(found if known is None else found & known)
    return counts


def _evidence(n: int, m: int, n_all: int, m_all: int) -> float:
    """Likelihood ratio G2 of n of n_all toxic against m of m_all clean documents."""
    share, total = n_all / (n_all + m_all), n + m
    return 2 * (n * math.log(n / (total * share)) + (m * math.log(m / (total * (1 - share))) if m else 0))


def select_features(
    docs: list[tuple[list[str], int]], min_docs: int = 3, min_evidence: float = 15.0, min_ratio: float = 2.5, common: float = 0.03
) -> tuple[set[str], set[str]]:
    """Features of the field, and those among them that mark a token of a toxic document as toxic."""
    toxic, clean = [w for w, y in docs if y], [w for w, y in docs if not y]
    if not toxic or not clean:
        return set(), set()
    a = {f: n for f, n in _document_counts(toxic).items() if n >= min_docs}
    b = _document_counts(clean, set(a))
    chosen, strong = set(), set()
    for f, n in a.items():
        ratio = math.log((n + 0.5) / (len(toxic) + 1)) - math.log((b.get(f, 0) + 0.5) / (len(clean) + 1))
        if ratio > 1 and _evidence(n, b.get(f, 0), len(toxic), len(clean)) >= min_evidence:
            chosen.add(f)
            if ratio >= min_ratio:
                strong.add(f)
    marks = {f for f in strong if a[f] >= common * len(toxic)}
    left = [found for w in toxic if not (found := {f for x in set(w) for f in features(x)} & strong) & marks]
    while left:
        support = Counter(f for found in left for f in found)
        best = max(support, key=lambda f: (_evidence(support[f], b.get(f, 0), len(toxic), len(clean)), f), default=None)
        if best is None or support[best] < min_docs or _evidence(support[best], b.get(best, 0), len(toxic), len(clean)) < min_evidence:
            break
        marks.add(best)
        left = [found for found in left if best not in found]
    return chosen, marks


def fit(texts: list[tuple[str, int]], steps: int = 80, rate: float = 0.25, penalty: float = 0.02) -> dict:
    """Weights of the field: bias, start, trans (2 x 2) and one weight per feature."""
    docs = _without_copies(texts)
    chosen, marks = select_features(docs)
    index = {f: i for i, f in enumerate(sorted(chosen))}
    of_word: dict[str, tuple[int, ...]] = {}
    alike: Counter = Counter()  # (length, ((position, feature ids, tag), ...)) of sentences
    for words, toxic in docs:
        for start in range(0, len(words), WINDOW):
            part, hits = words[start : start + WINDOW], []
            for t, word in enumerate(part):
                ids = of_word.get(word)
                if ids is None:
                    ids = of_word[word] = tuple(index[f] for f in features(word) if f in index)
                if ids:
                    label = int(toxic and not marks.isdisjoint(features(word)))
                    hits.append((t, ids, label))
            alike[len(part), tuple(hits)] += 1
    if not index:
        return {"bias": -6.0, "trans": [[0.0, 0.0], [0.0, 0.0]], "weights": {}}
    lengths = np.array([n for n, _ in alike])
    counts = np.array(list(alike.values()), dtype=float)
    n, tags = len(lengths), np.zeros((WINDOW, len(lengths)), dtype=np.int8)
    at, feature = [], []
    for s, (_, hits) in enumerate(alike):
        for t, ids, label in hits:
            tags[t, s] = label
            at += [t * n + s] * len(ids)
            feature += ids
    at, feature = np.array(at), np.array(feature)
    times = counts[at % n]
    inside = np.arange(WINDOW)[:, None] < lengths
    observed_weight = np.bincount(feature, tags.ravel()[at] * times, len(index))
    observed_bias = float((tags * inside * counts).sum())
    pair = (inside[1:] * counts).astype(float)
    observed_trans = np.array([[((tags[:-1] == i) & (tags[1:] == j)).astype(float).ravel() @ pair.ravel() for j in (0, 1)] for i in (0, 1)])
    size = 1 + 4 + len(index)
    x = np.zeros(size)
    x[0] = -4.0
    slope, square = np.zeros(size), np.zeros(size)
    scale = 1.0 / counts.sum()
    for step in range(1, steps + 1):
        bias, trans, weight = x[0], np.exp(x[1:5].reshape(2, 2)), x[5:]
        factor = np.exp(bias + np.bincount(at, weight[feature], WINDOW * n).clip(-40, 40)).reshape(WINDOW, n)
        alpha, beta = np.empty((WINDOW, 2, n)), np.ones((WINDOW, 2, n))
        norm = np.ones((WINDOW, n))
        for t in range(WINDOW):
            if t == 0:
                zero, one = np.ones(n), factor[0].copy()
            else:
                zero = alpha[t - 1, 0] * trans[0, 0] + alpha[t - 1, 1] * trans[1, 0]
                one = (alpha[t - 1, 0] * trans[0, 1] + alpha[t - 1, 1] * trans[1, 1]) * factor[t]
            norm[t] = zero + one
            alpha[t, 0], alpha[t, 1] = zero / norm[t], one / norm[t]
        expected_trans = np.zeros((2, 2))
        for t in range(WINDOW - 2, -1, -1):
            ahead0, ahead1 = beta[t + 1, 0] / norm[t + 1], beta[t + 1, 1] * factor[t + 1] / norm[t + 1]
            live = inside[t + 1]
            for i in (0, 1):
                expected_trans[i, 0] += (alpha[t, i] * trans[i, 0] * ahead0 * live) @ counts
                expected_trans[i, 1] += (alpha[t, i] * trans[i, 1] * ahead1 * live) @ counts
                beta[t, i] = np.where(live, trans[i, 0] * ahead0 + trans[i, 1] * ahead1, 1.0)
        toxic = alpha[:, 1] * beta[:, 1]
        toxic /= toxic + alpha[:, 0] * beta[:, 0]
        toxic *= inside
        gradient = np.concatenate([
            [observed_bias - (toxic * counts).sum()],
            (observed_trans - expected_trans).ravel(),
            observed_weight - np.bincount(feature, toxic.ravel()[at] * times, len(index)),
        ]) - penalty * np.concatenate([[0.0], x[1:]])
        gradient *= scale
        slope = 0.9 * slope + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        x += rate * (slope / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-10) * min(1.0, 2 * (1 - step / (steps + 1)))
    return {
        "bias": float(x[0]), "trans": x[1:5].reshape(2, 2).tolist(),
        "weights": {f: float(x[5 + i]) for f, i in index.items() if abs(x[5 + i]) > 1e-3},
    }


class Tagger:
    """Marginals of whole texts under one model."""

    def __init__(self, model: dict) -> None:
        self.weights, self.bias = model["weights"], math.exp(model["bias"])
        self.trans = tuple(math.exp(v) for row in model["trans"] for v in row)
        self.known: dict[str, float] = {}
        # Powers of one background step: a vector (zero, one) moves over a run of tokens without features.
        a, b, c, d = self.trans
        step = np.array([[a, b * self.bias], [c, d * self.bias]])
        self.powers = [np.eye(2)]
        for _ in range(256):  # later powers are proportional to the last one up to rounding
            power = self.powers[-1] @ step
            self.powers.append(power / power.sum())
        self.powers = [tuple(p.ravel().tolist()) for p in self.powers]
        row = np.array([1.0, self.bias]) @ np.array(self.powers[256]).reshape(2, 2)
        column = np.array(self.powers[256]).reshape(2, 2) @ np.ones(2)
        self.background = float(row[1] * column[1] / (row @ column))

    def gain(self, word: str) -> float:
        if len(self.known) > CACHE:
            self.known.clear()
        low = word.lower()
        found = self.known[word] = sum(self.weights.get(f, 0.0) for f in features(low))
        return found

    def marginals(self, text: str) -> tuple[list[str], list[tuple[int, float]]]:
        """Words of the text; index and toxic marginal of every token that has a feature."""
        words, known, gain = WORD.findall(text), self.known, self.gain
        hits = []
        for t, word in enumerate(words):
            value = known.get(word)
            if value is None:
                value = gain(word)
            if value:
                hits.append((t, math.exp(max(-40.0, min(40.0, value))) * self.bias))
        if not hits:
            return words, hits
        a, b, c, d = self.trans
        forward, zero, one, before = [], 1.0, 0.0, -1
        for t, factor in hits:
            gap = t - before - 1
            if before < 0 and gap == 0:
                zero, one = 1.0, factor
            else:
                if before < 0:
                    zero, one, gap = 1.0, self.bias, gap - 1
                p = self.powers[min(gap, 256)]
                zero, one = zero * p[0] + one * p[2], zero * p[1] + one * p[3]
                zero, one = zero * a + one * c, (zero * b + one * d) * factor
            total = zero + one
            zero, one, before = zero / total, one / total, t
            forward.append((zero, one))
        out = []
        back0, back1, after = 1.0, 1.0, len(words)
        next_factor = None
        for (t, factor), (zero, one) in zip(reversed(hits), reversed(forward)):
            if next_factor is not None:
                back0, back1 = a * back0 + b * next_factor * back1, c * back0 + d * next_factor * back1
            p = self.powers[min(after - t - 1, 256)]
            back0, back1 = p[0] * back0 + p[1] * back1, p[2] * back0 + p[3] * back1
            total = back0 + back1
            back0, back1 = back0 / total, back1 / total
            out.append((t, one * back1 / (zero * back0 + one * back1)))
            after, next_factor = t, factor
        return words, out[::-1]

    def score(self, text: str | None) -> tuple[float, list[dict]]:
        """Largest marginal, and the spans of neighbouring tokens over ``SPAN_LEVEL``."""
        words, found = self.marginals(text or "")
        if not found:
            return self.background, []
        score = min(1.0, max(0.0, self.background, max(p for _, p in found)))
        flagged = {t: p for t, p in found if p >= SPAN_LEVEL}
        spans: list[dict] = []
        if flagged:
            last = -2
            for t, match in enumerate(WORD.finditer(text)):
                if t in flagged:
                    if last == t - 1:
                        spans[-1] |= {"end": match.end(), "marginal": max(spans[-1]["marginal"], flagged[t])}
                    else:
                        spans.append({"start": match.start(), "end": match.end(), "marginal": flagged[t]})
                    last = t
        return score, spans


def scorer(model: dict):
    """Column function: text to struct(score, spans); the model is small and travels with the function."""

    @pandas_udf("score double, spans array<struct<start: int, end: int, marginal: double>>")
    def toxicity(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tagger = Tagger(model)
        for texts in batches:
            rows = [tagger.score(text) for text in texts]
            yield pd.DataFrame({"score": [r[0] for r in rows], "spans": [r[1] for r in rows]})

    return toxicity


def train(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> dict:
    return fit(sample(docs, labels, max_toxic, max_clean))


def toxic_column(docs: DataFrame, labels: DataFrame, text: str = "text") -> Column:
    """Fit on the labelled documents given and return the struct(score, spans) column of ``text``."""
    return scorer(train(in_small_batches(docs), labels))(F.col(text))
