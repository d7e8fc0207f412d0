"""Language-model scores by a weighted backoff automaton.

Counts are taken over all training documents, whatever their number; every n-gram of one to three words that occurs is in the model.
A word has the smoothed probability ``(c + 0.5) / (N + 0.5 * (V + 1))``. Bigrams and trigrams are smoothed towards the
shorter history with a prior of ``PRIOR`` occurrences: ``p(w | h) = (n(h w) + prior * p(w | shorter h)) / (n(h) + prior)``. Every history
that occurs is a state, every n-gram an arc with its probability, and a state's failure arc leads to the shorter history with the
weight ``prior / (n(h) + prior)``; so the probabilities of a state sum to one. A text is scored in one traversal from left to right
that carries the state and adds up log probabilities (``Automaton``).

The automaton of a corpus does not fit one task, but a text only follows arcs of its own n-grams. So texts are written in groups of about
``GROUP_BYTES`` each, and a group gets the part of the automaton that its texts can use:

1. Every group sends its distinct n-grams, as 56-bit hashes in sorted blocks with its own counts, to the hash range of each.
2. A range adds up the counts and answers every group with the places in its block whose total differs from its own count.
3. Every group is joined with its answers, builds states, arcs and failure arcs, and its texts are walked.

A group has one block per range, however often an n-gram occurs, and ranges follow the number of tokens, so no n-gram makes
a task large. Hashes of different n-grams may meet (some hundred pairs in thirty gigabytes of text); their counts are then added.

Defined results: a null or empty text is the end token alone; null ids are scored, not learnt from and not held out; repeated rows
are scored alike and counted as often as they occur; extra columns are ignored; without training documents no word is known and
all scores follow the formula with N = V = 0; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import in_small_batches
from broadsheet.session import cut

#: Occurrences that the shorter history counts for, behind one word and behind two.
PRIOR = (60.0, 12.0)
#: Bytes of text in a group (a longer text is a group of its own) and n-grams in a hash range, about.
GROUP_BYTES, RANGE_GRAMS = 4 << 20, 3_000_000
BEGIN, END = 0, 1  # numbers of the marks around a text
#: Tokens walked in a row; the state before any token follows from the two before it.
STRETCH = 512
_KINDS = ("word", "longer")


def words_of(text: bytes | None) -> list[bytes]:
    """A-Z lower-cased; ``bytes.split`` separates at space and the codes 9 to 13 only."""
    return (text or b"").lower().split()


class Automaton:
    """States, weighted arcs and failure arcs over numbered words; all weights are log10 probabilities.

    State 0 is the root, ``1 + u`` the history of word u, ``1 + W + i`` that of pair i. Words, pairs and triples have
    counts; what has a count of zero is no arc, and no state. ``p``: probability of every word at the root."""

    def __init__(
        self, p: np.ndarray, c: np.ndarray, pairs: tuple[np.ndarray, np.ndarray, np.ndarray],
        triples: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray], prior: tuple[float, float] = PRIOR,
    ) -> None:
        """``c``: occurrences of every word as a history. ``pairs``: first word, second word, count. ``triples``: number of the pair
        of the first two words, last word, number of the pair of the last two, count."""
        self.width = width = len(p)
        u, v, n2 = pairs
        first, w, low, n3 = triples
        self.root_weight = np.log10(p)
        self.root_next = np.where(c > 0, 1 + np.arange(width), 0)
        p2 = (n2 + prior[0] * p[v]) / (c[u] + prior[0])
        p3 = (n3 + prior[1] * p2[low]) / (n2[first] + prior[1])
        pair_state = 1 + width + np.arange(len(u))
        two, three = n2 > 0, n3 > 0
        keys = np.concatenate([(1 + u[two]) * width + v[two], pair_state[first[three]] * width + w[three]])
        order = np.argsort(keys)
        self.keys = keys[order]
        self.weight = np.log10(np.concatenate([p2[two], p3[three]]))[order]
        self.next = np.concatenate([pair_state[two], pair_state[low[three]]])[order]
        none = np.zeros(1)
        self.fail = np.concatenate([none, np.zeros(width), 1 + v]).astype(np.int64)
        self.fail_weight = np.log10(np.concatenate([none + 1, prior[0] / (c + prior[0]), prior[1] / (n2 + prior[1])]))

    def walk(self, words: np.ndarray, start: np.ndarray, end: np.ndarray, state: np.ndarray, silent: np.ndarray) -> np.ndarray:
        """Log probability of ``words[start:end]`` of every stretch from its state on, without its first ``silent`` words.

        All stretches advance by one word at a time."""
        order = np.argsort(start - end, kind="stable")
        start, state, silent, size = start[order], state[order].copy(), silent[order], (end - start)[order]
        total = np.zeros(len(order))
        for step in range(int(size[0]) if len(size) else 0):
            active = int(np.searchsorted(-size, -step))
            word, now, gain = words[start[:active] + step], state[:active], np.zeros(active)
            todo = np.arange(active)
            while len(todo):
                at, w = now[todo], word[todo]
                key = at * self.width + w
                place = np.minimum(np.searchsorted(self.keys, key), max(0, len(self.keys) - 1))
                arc = (self.keys[place] == key) & (at > 0) if len(self.keys) else np.zeros(len(todo), dtype=bool)
                root = at == 0
                gain[todo[arc]] += self.weight[place[arc]]
                now[todo[arc]] = self.next[place[arc]]
                gain[todo[root]] += self.root_weight[w[root]]
                now[todo[root]] = self.root_next[w[root]]
                todo = todo[~(arc | root)]
                gain[todo] += self.fail_weight[now[todo]]
                now[todo] = self.fail[now[todo]]
            total[:active] += np.where(step >= silent[:active], gain, 0.0)
        out = np.zeros(len(order))
        out[order] = total
        return out

    def scores(self, words: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Log probability of the texts ``words[first:last]``, each with its begin mark.

        Long texts are walked as several stretches at once: one starts at the root two words early, which leads to the state
        that the whole walk has there."""
        n = np.maximum(1, -(-(last - first - 1) // STRETCH))
        text = np.repeat(np.arange(len(first)), n)
        part = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
        begin = first[text] + 1 + part * STRETCH
        inner = part > 0
        got = self.walk(
            words, begin - 2 * inner, np.minimum(begin + STRETCH, last[text]),
            np.where(inner, 0, self.root_next[BEGIN]), 2 * inner.astype(np.int64),
        )
        return np.bincount(text, got, len(first))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Grams:
    """Numbered words and n-grams of a group of texts, with their counts in the training texts among them."""

    def __init__(self, texts: list[bytes | None], train: np.ndarray) -> None:
        number: dict[bytes, int] = {b"": BEGIN, b"\n": END}  # no word is empty or holds white space
        flat: list[int] = []
        sizes = []
        for text in texts:
            before = len(flat)
            flat.append(BEGIN)
            for word in words_of(text):
                found = number.get(word)
                if found is None:
                    number[word] = found = len(number)
                flat.append(found)
            flat.append(END)
            sizes.append(len(flat) - before)
        self.words, self.width = np.array(flat, dtype=np.int64), len(number)
        size = np.array(sizes, dtype=np.int64)
        self.last = np.cumsum(size)
        self.first = self.last - size
        text = np.repeat(np.arange(len(texts)), size)
        learnt = np.repeat(train, size)
        self.c1 = np.bincount(self.words[learnt], minlength=self.width)
        inside = text[1:] == text[:-1]  # an n-gram may not reach over the end of its text
        self.pair_at = np.flatnonzero(inside)
        keys, pair, self.c2 = self._numbered(self.words[:-1][inside] * self.width + self.words[1:][inside], learnt[1:][inside])
        self.u, self.v = np.divmod(keys, self.width)
        of = np.full(len(self.words), -1)
        of[self.pair_at] = pair
        deep = np.flatnonzero(inside[1:] & inside[:-1])
        keys, triple, self.c3 = self._numbered(of[deep] * self.width + self.words[deep + 2], learnt[deep])
        self.opening, self.w = np.divmod(keys, self.width)
        self.low = np.zeros(len(keys), dtype=np.int64)
        self.low[triple] = of[deep + 1]
        hashed = np.array([xxhash.xxh3_64_intdigest(word) for word in number], dtype=np.uint64)
        two = _mixed(hashed[self.u] * np.uint64(0x9E3779B97F4A7C15) + hashed[self.v])
        three = _mixed(two[self.opening] * np.uint64(0xC2B2AE3D27D4EB4F) + hashed[self.w])
        #: Sent of each kind: hashes in order, and which n-gram each is.
        self.sent = {}
        for kind, values in (("word", hashed[1:]), ("longer", np.concatenate([two, three]) >> np.uint64(8))):
            order = np.argsort(values, kind="stable")
            self.sent[kind] = (values[order], order)

    @staticmethod
    def _numbered(keys: np.ndarray, learnt: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found, number = np.unique(keys, return_inverse=True)
        return found, number, np.bincount(number[learnt], minlength=len(found))

    def counts(self, kind: str) -> np.ndarray:
        """Counts in the order of what is sent."""
        return (self.c1[1:] if kind == "word" else np.concatenate([self.c2, self.c3]))[self.sent[kind][1]]

    def add_up(self, kind: str, totals: np.ndarray) -> None:
        """Take over the counts of the whole corpus, in the order of what was sent."""
        mine = np.zeros(len(totals), dtype=np.int64)
        mine[self.sent[kind][1]] = totals
        if kind == "word":
            self.c1[1:] = mine
            self.c1[BEGIN] = self.c1[END]
        else:
            self.c2, self.c3 = mine[: len(self.c2)], mine[len(self.c2) :]

    def automaton(self, total: int, distinct: int) -> Automaton:
        below = total + 0.5 * (distinct + 1)
        history = self.c1.copy()
        history[END] = 0
        return Automaton((self.c1 + 0.5) / below, history, (self.u, self.v, self.c2), (self.opening, self.w, self.low, self.c3))


def _packed(values: np.ndarray) -> bytes:
    """Non-negative integers, the equal bytes of all together and compressed."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    planes = pa.decompress(data[8:], decompressed_size=8 * size, codec="zstd", asbytes=True)
    return np.frombuffer(planes, dtype=np.uint8).reshape(8, size).T.copy().view("<u8").reshape(-1).astype(np.uint64)


def _packed_sorted(values: np.ndarray) -> bytes:
    return _packed(np.diff(values, prepend=values.dtype.type(0)))


def _unpacked_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data), dtype=np.uint64)


def text_groups(docs: DataFrame, training: Column) -> DataFrame:
    """grp, tokens, learnt (training tokens) and the texts of a group, compressed; no row is moved."""

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 33
        held: list[pa.RecordBatch] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal key, held, size
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, whole.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(whole)
            tokens = [len((t or b"").split()) + 1 for t in whole.column("text").to_pylist()]
            learnt = sum(n for n, mine in zip(tokens, whole.column("train").to_pylist()) if mine)
            key, held, size = key + 1, [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array([key], pa.int64()), pa.array([sum(tokens)], pa.int64()), pa.array([learnt], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                ["grp", "tokens", "learnt", "texts"],
            )

        for batch in batches:
            start = 0
            lengths = batch.column("text").fill_null(b"").to_pylist()
            for row, text in enumerate(lengths):
                if size and size + len(text) > GROUP_BYTES:
                    if row > start:
                        held.append(batch.slice(start, row - start))
                    start = row
                    yield flush()
                size += len(text) + 16
            if batch.num_rows > start:
                held.append(batch.slice(start))
        if held:
            yield flush()

    source = in_small_batches(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(training, F.lit(False)).alias("train"), F.col("text").cast("string").cast("binary").alias("text")
    )
    return source.mapInArrow(grouped, "grp long, tokens long, learnt long, texts binary")


def _grams(texts: bytes) -> tuple[pa.RecordBatch, Grams]:
    rows = pa.ipc.open_stream(texts).read_next_batch()
    return rows, Grams(rows.column("text").to_pylist(), rows.column("train").to_numpy(zero_copy_only=False))


def _ranges(values: np.ndarray, kind: str, n_ranges: int) -> np.ndarray:
    """Places in the sorted hashes where each range begins, and the end."""
    top = 1 << (64 if kind == "word" else 56)
    edges = np.array([top * i // n_ranges for i in range(1, n_ranges)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(values, edges), [len(values)]]).astype(np.int64)


def _totals(rows: pd.DataFrame) -> tuple[list[tuple[int, bytes, bytes]], int]:
    """Answers (group, places, totals) to the blocks of one range, and the number of n-grams with a count."""
    hashes = [_unpacked_sorted(x) for x in rows["grams"]]
    own = [_unpacked(x).astype(np.int64) for x in rows["counts"]]
    every = np.concatenate(hashes)
    order = np.argsort(every, kind="stable")
    new = np.ones(len(every), dtype=bool)
    new[1:] = every[order][1:] != every[order][:-1]
    total = np.add.reduceat(np.concatenate(own)[order], np.flatnonzero(new))
    of = np.empty(len(every), dtype=np.int64)
    of[order] = total[np.cumsum(new) - 1]
    answers, at = [], 0
    for grp, mine in zip(rows["grp"], own):
        right = of[at : at + len(mine)]
        at += len(mine)
        other = np.flatnonzero(right != mine)
        if len(other):
            answers.append((grp, _packed_sorted(other.astype(np.uint64)), _packed(right[other])))
    return answers, int((total > 0).sum())


def score(docs: DataFrame, training: Column) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row; ``training`` marks the rows to learn from."""
    groups = cut(text_groups(docs, training), "texts")
    tokens, learnt, n_groups = groups.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("learnt"), F.lit(0)), F.count(F.lit(1))).first()
    ranges = {"word": 1 + tokens // (8 * RANGE_GRAMS), "longer": 1 + 2 * tokens // RANGE_GRAMS}

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for grp, texts in zip(batch.column("grp").to_pylist(), batch.column("texts")):
                grams = _grams(texts.as_py())[1]
                out: list[tuple] = []
                for kind in _KINDS:
                    values, counts = grams.sent[kind][0], grams.counts(kind)
                    cuts = _ranges(values, kind, ranges[kind])
                    out += [
                        (kind, i, grp, _packed_sorted(values[a:b]), _packed(counts[a:b]))
                        for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if b > a
                    ]
                types = (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], ["kind", "part", "grp", "grams", "counts"])

    def answered(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        answers, distinct = _totals(rows)
        out = pd.DataFrame([(grp, places, totals, 0) for grp, places, totals in answers] + [(-1, None, None, distinct)], columns=["grp", "places", "totals", "n"])
        return out.assign(kind=key[0], part=key[1])

    sent = groups.select("grp", "texts").mapInArrow(blocks, "kind string, part long, grp long, grams binary, counts binary")
    # Tasks follow the input: one per range, and one for some groups.
    answers = cut(sent.repartition(sum(ranges.values()), "kind", "part").groupBy("kind", "part").applyInPandas(answered, "kind string, part long, grp long, places binary, totals binary, n long"), "answers")
    distinct = answers.filter("grp = -1 AND kind = 'word'").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def scored(texts: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        parts = [walked(x, told) for x in texts["texts"]]
        return pd.concat(parts) if parts else pd.DataFrame({"doc_id": [], "n_tokens": [], "n_known": [], "base_score": [], "score": []})

    def walked(texts: bytes, told: pd.DataFrame) -> pd.DataFrame:
        rows, grams = _grams(texts)
        for kind in _KINDS:
            totals = grams.counts(kind)
            cuts = _ranges(grams.sent[kind][0], kind, ranges[kind])
            for part, places, right in told.loc[told["kind"] == kind, ["part", "places", "totals"]].itertuples(index=False):
                totals[cuts[part] + _unpacked_sorted(places).astype(np.int64)] = _unpacked(right).astype(np.int64)
            grams.add_up(kind, totals)
        model = grams.automaton(learnt, distinct)
        text = np.repeat(np.arange(rows.num_rows), grams.last - grams.first)
        spoken = grams.words != BEGIN
        return pd.DataFrame({
            "doc_id": rows.column("doc_id").to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get),
            "n_tokens": grams.last - grams.first - 1,
            "n_known": np.bincount(text[spoken], grams.c1[grams.words[spoken]] > 0, rows.num_rows).astype(np.int64),
            "base_score": np.bincount(text[spoken], model.root_weight[grams.words[spoken]], rows.num_rows),
            "score": model.scores(grams.words, grams.first, grams.last),
        })

    told = answers.filter("grp >= 0").select("grp", "kind", "part", "places", "totals")
    tasks = 1 + n_groups // 4
    found = groups.select("grp", "texts").repartition(tasks, "grp").groupBy("grp").cogroup(told.repartition(tasks, "grp").groupBy("grp")).applyInPandas(
        scored, "doc_id long, n_tokens long, n_known long, base_score double, score double"
    )
    return found.select("doc_id", "n_tokens", "n_known", F.lit(int(learnt)).cast("long").alias("train_tokens"), "base_score", "score")
