"""Every operator against a plain version: awkward rows, empty tables, clashing columns, round trips."""

from __future__ import annotations

import base64
import hashlib
import os
import random
import subprocess
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
import brute  # noqa: E402

from broadsheet.llm import byte_bpe, embedding_dedup, line_dedup, lm_scoring, packing, quality_rules, sharding, simhash, toxicity, warc  # noqa: E402
from broadsheet.llm.common import id_remainder, tokenizer_path, tokenizer_pattern  # noqa: E402
from broadsheet.llm import components as components_module  # noqa: E402
from broadsheet.llm.components import components  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, shard int, ids array<int>, _keys string"
VOCABULARY = ["the", "Of", "and", "Rain", "été", "straße", "river", "cloud", "Stone", "walks", "far", "home", "#tag", "a|b", "x", "中文"]


def _prose(rnd, n):
    return " ".join(rnd.choice(VOCABULARY) + rnd.choice(["", "", "", ".", ",", "\n"]) for _ in range(n))


def documents():
    rnd = random.Random(3)
    texts = [_prose(rnd, rnd.randint(1, 150)) for _ in range(40)]
    texts += [texts[0]] * 4 + [texts[1] + " end", texts[2].replace("river", "lake")]
    shared = "This line is shared by many documents"
    texts += [f"{shared}\n{_prose(rnd, 20)}\n  {shared.upper()}\t\nshort", f"\t{shared}\r\n{shared}\nown line number two", f"{_prose(rnd, 8)}\n{shared}"]
    texts += [None, "", None, "", "\n", "\n\n \t", " ", "word", "a b c", "a a a a", "same line here\nsame line here\nsame line here"]
    texts += ["long " * 30_000, _prose(rnd, 6_000), "x" * 50_000, "   odd　space\x1c\x85 end ", "<|endoftext|> it's we'll 123 ４５"]
    rows = [(i * 7 % 101, t, rnd.choice(["en", "fr", None]), "s", None, 0.5, 1, [1], "k") for i, t in enumerate(texts)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def odd_docs(spark):
    """With null ids and repeated rows."""
    rows = documents()
    return spark.createDataFrame([*rows, *rows[:3], (None, rows[0][1], *rows[0][2:]), (None, None, *rows[0][2:])], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# quality rules

LABELS = "doc_id long, quality int, toxic int"


def test_quality_measures(spark, docs):
    labels = spark.createDataFrame([(0, 1, 0), (None, 1, 1), (7, None, None), (999, 1, 0)], LABELS)
    texts = dict(pairs(docs))
    for r in quality_rules.judge_ids(docs, labels).collect():
        q = r["_quality"]
        assert (q["n_words"], q["word_chars"], q["n_symbols"], q["n_dup_lines"], q["n_repeat_words"], q["base_failed"]) == brute.quality_base(texts[r["doc_id"]])
        assert r["_kept"] == (not q["base_failed"])  # so few labels admit no cutoff


def test_repeated_windows(spark):
    rnd = random.Random(1)
    texts = [" ".join(rnd.choice("aab") for _ in range(rnd.randint(0, 14))) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r[0]: r[1] for r in df.select("doc_id", quality_rules.measures(F.col("text"))["n_repeat_words"]).collect()}
    assert got == {i: brute.quality_base(t)[4] for i, t in enumerate(texts)}


def test_binomial_tail(spark):
    cases = [(k, n) for n in (1, 10, 300, 2000, 20_000) for k in (0, 1, 2, 5, 30, 150) if k <= n]
    df = spark.createDataFrame(cases, "k int, n int")
    for k, n, tail in df.select("k", "n", quality_rules.binomial_tail(F.col("k"), F.col("n"), 0.0125)).collect():
        exact = brute.binomial_tail(k, n, 0.0125) if n <= 2000 else None
        if k >= n * 0.0125:
            assert tail == 1.0
        elif exact is not None:
            assert tail == pytest.approx(exact, rel=1e-9)
        else:
            assert 0 <= tail <= 1


def test_quality_cutoffs(spark):
    """A cutoff that rejects good documents is not admitted; a stratum with few labels gets none."""
    rows = [(i, 1.0 * (i % 10 == 0 and 0.12) if lang == "en" else 0.0, lang) for i, lang in ((i, "en" if i < 3000 else "fr") for i in range(3030))]
    measured = spark.createDataFrame(rows, "doc_id long, ratio double, _stratum string").withColumn(
        "_quality", F.struct(*[F.col("ratio").alias(s) for s in quality_rules.SIGNALS], F.lit(False).alias("base_failed"))
    )
    labels = spark.createDataFrame([(i, 1, 0) for i in range(3030)], LABELS)
    got = {r["_stratum"]: r["_cut_symbol_ratio"] for r in quality_rules.thresholds(measured, labels).collect()}
    assert got == {"en": 0.15}


def test_quality_empty(spark, no_docs, odd_docs):
    labels = spark.createDataFrame([], LABELS)
    assert quality_rules.judge(no_docs, labels).count() == 0
    judged = quality_rules.judge(odd_docs, labels)
    assert judged.count() == odd_docs.count() and set(odd_docs.columns) < set(judged.columns)


# line dedup

def test_line_dedup(docs, odd_docs):
    for df in (docs, odd_docs):
        got = line_dedup.remove_repeats(df)
        assert set(df.columns) < set(got.columns)
        rows = sorted(((r["doc_id"], r["_lines"]["n_lines"], r["_lines"]["n_dropped"], r["_lines"]["text"] or "") for r in got.collect()), key=str)
        assert rows == sorted(brute.line_dedup(pairs(df)), key=str)
        assert any(r[2] for r in rows)


def test_line_dedup_empty(no_docs):
    assert line_dedup.remove_repeats(no_docs).count() == 0


def test_cuckoo_filter():
    rnd = np.random.default_rng(5)
    keys = rnd.integers(-(2**63), 2**63 - 1, 40_000)
    made = line_dedup.CuckooFilter(60_000)
    assert made.insert(keys)
    assert made.contains(keys).all()
    assert made.contains(rnd.integers(-(2**63), 2**63 - 1, 40_000)).mean() < 0.002
    before = line_dedup.CuckooFilter(60_000)
    before.insert(keys[:20_000])
    made.delete(keys[20_000:])
    assert made.contains(keys[:20_000]).all() and (made.table > 0).sum() == 20_000 == (before.table > 0).sum()
    assert line_dedup.CuckooFilter.from_bytes(made.to_bytes()).contains(keys[:20_000]).all()
    small = line_dedup.CuckooFilter(16)
    assert not small.insert(keys[:1000])


def test_line_store_is_reversible(spark, docs):
    one, two = docs.filter("doc_id % 2 = 0"), docs.filter("doc_id % 2 = 1")

    def state(store):
        counts = {(r["k1"], r["k2"]): (r["n_refs"], r["first_doc"], r["last_doc"]) for r in store.read("counts").collect()}
        sizes = {r["shard"]: int((line_dedup.CuckooFilter.from_bytes(bytes(r["filter"])).table > 0).sum()) for r in store.read("filters").collect()}
        return counts, {s: n for s, n in sizes.items() if n}

    store = line_dedup.LineStore(spark, n_shards=3)
    store.insert(one)
    first = state(store)
    store.insert(two)
    got = sorted((r["doc_id"], r["_lines"]["text"] or "") for r in store.kept(docs).collect())
    assert got == sorted((d, t) for d, _, _, t in brute.line_dedup(pairs(docs)))
    store.delete(two)
    assert state(store) == first
    got = sorted((r["doc_id"], r["_lines"]["text"] or "") for r in store.kept(one).collect())
    assert got == sorted((d, t) for d, _, _, t in brute.line_dedup(pairs(one)))


def test_line_store_grows(spark, monkeypatch):
    """Many equal batches after a small first one: full filters are rebuilt, shards split."""
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 4_000)
    store = line_dedup.LineStore(spark, n_shards=1)
    lines = [f"line number {i} of the store" for i in range(4_510)]
    batches = [lines[:10], lines[10:1_510], lines[1_510:3_010], lines[3_010:]]
    shards = []
    for i, batch in enumerate(batches):
        store.insert(spark.createDataFrame([(i, "\n".join(batch))], "doc_id long, text string"))
        shards.append(store.n_shards)
    assert shards == [1, 1, 1, 2]
    assert store.read("counts").count() == len(lines)
    filters = {r["shard"]: line_dedup.CuckooFilter.from_bytes(bytes(r["filter"])) for r in store.read("filters").collect()}
    k1, k2 = line_dedup._longs([line_dedup.line_key(line) for line in lines])
    assert all(filters[s].contains(k2[k1 % 2 == s]).all() for s in (0, 1))


# WARC

def test_warc(spark):
    rows = [
        (1, "http://a/", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "http://b c/\r\nX: y", None), (4, "u", ""), (9, "u", "\r\n\r\nWARC/1.1"),
        (5, "u", "é" * 70_000), (7, "u", "é" * 70_000), (None, "u", "<p>x</p>"), (None, "u", "alone"), (8, "u", "twice"), (8, "u", "twice"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"digest": F.lit(1), "record": F.lit("r"), "header": F.lit(2)})
    for least in (0, 5):
        want = []
        for page, _, html in rows:
            payload = (html or "").encode()
            first = min((p for p, _, h in rows if (h or "") == (html or "") and p is not None), default=None)
            again = page is not None and page != first and len(payload) >= least
            want.append((page, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "revisit" if again else "response", first if again else None))
        got = [tuple(r) for r in warc.archived(pages, least).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert warc.archived(pages.limit(0)).count() == 0


def test_warc_stores_once_and_notices_damage(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"page {i % 3}") for i in range(30)], "page_id long, url string, html string")
    warc.write_archive(pages, f"{tmp_path}/a")
    payloads = spark.read.parquet(f"{tmp_path}/a/payloads")
    assert payloads.count() == 3
    records = {r["page_id"]: bytes(r["record"]) for r in warc.read_records(spark, f"{tmp_path}/a").collect()}
    assert records[0].startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and records[0].endswith(b"\r\n\r\npage 0\r\n\r\n")
    assert b"page 0" not in records[3].split(b"\r\n\r\n", 1)[1]
    spark.read.parquet(f"{tmp_path}/a/records").write.parquet(f"{tmp_path}/b/records")
    payloads.withColumn("payload", F.lit(b"page X")).write.parquet(f"{tmp_path}/b/payloads")
    with pytest.raises(Exception, match="payload differs"):
        warc.read_archive(spark, f"{tmp_path}/b").collect()


# toxicity

def toxic_corpus(spark):
    rnd = random.Random(9)
    stems = ["vexor", "blarg"]
    rows, labels = [], []
    for i in range(600):
        words = [rnd.choice("lorem ipsum dolor sit amet consectetur elit sed do".split()) + rnd.choice(["", "a", "um"]) for _ in range(rnd.randint(5, 80))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(rnd.randint(1, 4)):
                words.insert(rnd.randrange(len(words)), rnd.choice(stems) + rnd.choice("abcdefghijklm") + rnd.choice("xyz"))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)


def test_toxicity_held_out(spark):
    docs, labels = toxic_corpus(spark)
    model = toxicity.train(docs, labels.filter(id_remainder(F.col("doc_id"), 3) != 1))
    tagger = toxicity.Tagger(model)
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [(d, t) for d, t in pairs(docs) if brute.remainder(d, 3) == 1]
    right = sum((tagger.score(t)[0] >= 0.7) == bool(truth[d]) for d, t in held)
    assert right / len(held) > 0.98
    for d, t in held:
        for span in tagger.score(t)[1]:
            assert t[span["start"] : span["end"]].split()[0].startswith(("vexor", "blarg"))
    got = docs.select("doc_id", toxicity.scorer(model)("text").alias("t")).collect()
    assert all(r["t"]["score"] == pytest.approx(tagger.score(dict(held)[r["doc_id"]])[0]) for r in got if r["doc_id"] in dict(held))


def test_marginals_match_enumeration():
    """Forward-backward with powers for runs gives what summing over every tag sequence gives."""
    model = {"bias": -1.3, "trans": [[0.4, -0.2], [-0.5, 0.9]], "weights": {"=bad": 2.0, "bad": 0.7, "=odd": -0.8}}
    tagger = toxicity.Tagger(model)
    trans = np.exp(np.array(model["trans"]))
    for text in ("bad", "a bad", "a b c bad d odd e", "bad bad", "x y odd z bad w v", "badly a a a bad"):
        words, found = tagger.marginals(text)
        factor = [np.exp(-1.3 + sum(model["weights"].get(f, 0) for f in toxicity.features(w))) for w in words]
        mass = np.zeros((len(words), 2))
        for code in range(2 ** len(words)):
            tags = [code >> i & 1 for i in range(len(words))]
            value = np.prod([f if t else 1.0 for f, t in zip(factor, tags)]) * np.prod([trans[a, b] for a, b in zip(tags, tags[1:])])
            for i, t in enumerate(tags):
                mass[i, t] += value
        for t, p in found:
            assert p == pytest.approx(mass[t, 1] / mass[t].sum(), rel=1e-9)


def test_toxicity_awkward(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], LABELS)
    for df in (odd_docs, no_docs):
        got = df.select("doc_id", "text", toxicity.toxic_column(df, none).alias("t")).collect()
        assert len(got) == df.count() and all(0 <= r["t"]["score"] < 0.7 for r in got)
    docs, labels = toxic_corpus(spark)
    tagger = toxicity.Tagger(toxicity.train(docs, labels))
    assert 0 <= tagger.score(None)[0] == tagger.score("")[0] < 0.7
    score, spans = tagger.score("lorem " * 50_000 + "vexoraz" + " lorem" * 50_000)
    assert score >= 0.7 and [s["start"] for s in spans] == [300_000]


# packing

def test_packing(spark, docs, odd_docs, no_docs):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    for df in (docs, odd_docs):
        got = packing.pack(df, path, group_pieces=20 if df is odd_docs else 100_000).collect()
        windows: dict = {}
        for r in got:
            windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for parts in windows.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= 2048
        want = []
        for doc_id, text in pairs(df):
            ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
            want += [(doc_id, s, min(2048, len(ids) - s), zlib.crc32(ids[s : s + 2048].tobytes()), len(ids)) for s in range(0, len(ids), 2048)]
        assert sorted([tuple(r)[:5] for r in got], key=str) == sorted(want, key=str)
        if df is docs:
            assert len(windows) <= sum(w[2] for w in want) / 2048 * 1.05 + 1
    assert packing.pack(no_docs, path).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_best_fit(sizes):
    windows, room = packing.OpenWindows(64), {}
    for size in sorted(sizes, reverse=True):
        number, offset = windows.take(size)
        fitting = [c for c in room.values() if c >= size]
        if fitting:
            assert room[number] == min(fitting)
        else:
            assert number not in room
            room[number] = 64
        assert offset == 64 - room[number]
        room[number] -= size


def test_double_vectors_keep_their_precision(spark):
    """Cosines a hair apart, on both sides of the threshold: not to be told apart in single precision."""
    c = 0.9
    other = lambda cosine: [cosine, float(np.sqrt(1 - cosine * cosine))]
    rows = [(1, [1.0, 0.0]), (2, other(c + 1e-10)), (3, [0.0, 0.0, 1.0, 0.0]), (4, [0.0, 0.0, *other(c - 1e-10)]), (5, [1e200, 0.0, 0.0]), (6, [1e-200, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(df).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (0, 4), 5: (1, 5), 6: (1, 5)}


# language model

def test_lm_scores(docs, odd_docs, no_docs):
    for df in (docs, odd_docs):
        source = pairs(df)
        want = brute.base_scores(source, lambda d: d is None or brute.remainder(d, 5) == 1)
        got = lm_scoring.score(df, id_remainder(F.col("doc_id"), 5) != 1).collect()
        rows = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got), key=str)
        assert rows == sorted(((d, *w[:3], round(w[3], 6)) for (d, _), w in zip(source, want)), key=str)
        assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)
    assert lm_scoring.score(no_docs, F.lit(True)).count() == 0
    assert lm_scoring.score(docs, F.lit(False)).count() == docs.count()


def plain_scores(learnt, texts):
    """Backoff by the formula, n-gram by n-gram, from counts of all training n-grams."""
    lines = [[b"", *lm_scoring.words_of(t.encode()), b"\n"] for t in learnt]
    n = [Counter(g for line in lines for g in zip(*[line[k:] for k in range(size)])) for size in (1, 2, 3)]
    total, distinct = sum(len(line) - 1 for line in lines), len({w for line in lines for w in line[1:]})

    def p(history, w):
        if not history:
            return (n[0][(w,)] + 0.5) / (total + 0.5 * (distinct + 1))
        prior = lm_scoring.PRIOR[len(history) - 1]
        followed = sum(line.count(history[0]) for line in lines) if len(history) == 1 else n[1][history]
        return (n[len(history)][(*history, w)] + prior * p(history[1:], w)) / (followed + prior)

    out = []
    for text in texts:
        line = [b"", *lm_scoring.words_of((text or "").encode()), b"\n"]
        out.append(sum(np.log10(p(tuple(line[max(0, i - 2) : i]), line[i])) for i in range(1, len(line))))
    return out


def test_automaton_sums_to_one():
    """Over all known words, the end and one unknown word, after any history."""
    grams = lm_scoring.Grams([b"a b c a b", b"b b a", b"", b"c z"], np.array([True, True, True, False]))
    grams.c1[lm_scoring.BEGIN] = 3
    total, distinct = int(grams.c1[1:].sum()), int((grams.c1[1:] > 0).sum())
    model = grams.automaton(total, distinct)
    def probability(history, w):
        line = np.array([0, *history, w])
        whole = model.scores(line, np.array([0]), np.array([len(line)]))[0]
        before = model.scores(line, np.array([0]), np.array([len(line) - 1]))[0] if history else 0.0
        return 10 ** (whole - before)

    a, b, c, z = 2, 3, 4, 5  # z is in no training text
    assert (grams.c1[[a, b, c, z]] > 0).tolist() == [True, True, True, False]
    for history in ([], [a], [a, b], [b], [b, b], [c], [c, a], [a, c, b], [z], [a, z]):
        assert sum(probability(history, w) for w in (lm_scoring.END, a, b, c, z)) == pytest.approx(1.0)


def test_all_ngrams_are_arcs(spark, monkeypatch):
    """The distributed automaton equals the formula, however texts fall into groups and hashes into ranges."""
    rnd = random.Random(8)
    texts = [" ".join(f"w{int(rnd.paretovariate(0.6)) % 30_000}" for _ in range(60)) for _ in range(120)]
    texts += [f"once{i} seldom{i % 40} rare{i % 40} odd{i % 40}" for i in range(80)] + ["", "w1", "A a A a\x1cb", None]
    texts += [" ".join(rnd.choice("abcde") for _ in range(2_000)), " ".join(rnd.choice("abcde") for _ in range(lm_scoring.STRETCH + 1))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = plain_scores([t or "" for i, t in enumerate(texts) if i % 5], texts)
    for group_bytes, range_grams in ((lm_scoring.GROUP_BYTES, lm_scoring.RANGE_GRAMS), (700, 500)):
        monkeypatch.setattr(lm_scoring, "GROUP_BYTES", group_bytes)
        monkeypatch.setattr(lm_scoring, "RANGE_GRAMS", range_grams)
        got = {r["doc_id"]: r["score"] for r in lm_scoring.score(df, F.col("doc_id") % 5 != 0).collect()}
        assert got == {i: pytest.approx(x) for i, x in enumerate(want)}


def test_packed_integers():
    rnd = np.random.default_rng(1)
    for values in (np.zeros(0, np.uint64), np.array([0], np.uint64), np.array([2**64 - 1], np.uint64), np.sort(rnd.integers(0, 2**64, 999, np.uint64))):
        assert (lm_scoring._unpacked(lm_scoring._packed(values)) == values).all()
        assert (lm_scoring._unpacked_sorted(lm_scoring._packed_sorted(values)) == values).all()


def test_copies_left_out_are_the_same_in_every_process():
    code = (
        "import random; from broadsheet.llm import toxicity; r = random.Random(4); base = [f'w{i}' for i in range(40)];"
        "texts = [(' '.join(w if r.random() > 0.12 else 'x' for w in base), i) for i in range(300)];"
        "print([n for _, n in toxicity._without_copies(texts)])"
    )
    root = Path(__file__).resolve().parents[2]
    said = {subprocess.run([sys.executable, "-c", code], cwd=root, env=os.environ | {"PYTHONHASHSEED": seed}, capture_output=True, text=True, check=True).stdout for seed in "123"}
    assert len(said) == 1


# sharding

def test_sharding(spark, docs, odd_docs, no_docs):
    for df, rows_per_bucket in ((docs, 50_000), (odd_docs, 7)):
        got = sharding.shards(df, n_shards=6, bucket_rows=rows_per_bucket).collect()
        want = sorted(((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in pairs(df)), key=str)
        assert sorted([tuple(r)[:3] for r in got], key=str) == want
        total, largest = sum(r["size"] for r in got), max(r["size"] for r in got)
        for shard in {r["shard"] for r in got}:
            mine = [r for r in got if r["shard"] == shard]
            assert 0 <= shard < 6 and sorted(r["slot"] for r in mine) == list(range(len(mine)))
            assert abs(sum(r["size"] for r in mine) - total / 6) <= largest
    assert sharding.shards(no_docs).count() == 0
    assert {r["shard"] for r in sharding.shards(docs.limit(1)).collect()} <= set(range(40))


# embeddings

def test_embeddings(spark):
    rnd = np.random.default_rng(2)
    centres = rnd.normal(size=(30, 16))
    rows = [(int(i), (centres[i % 30] + rnd.normal(size=16) * rnd.choice([0.05, 0.3, 1.0])).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(5)] + [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [float("nan")] * 16), (2004, [float("inf")] + [1.0] * 15), (2005, [None] + [1.0] * 15)]
    rows += [(2006, [1.0, 2.0]), (2007, [2.0, 4.0]), (2008, [1e-30] * 16)]
    schema = "vec_id long, embedding array<float>"
    df = spark.createDataFrame(rows, schema).withColumns({"n_links": F.lit(7), "id": F.lit("x"), "cell": F.lit(1)})
    want = brute.vector_groups(rows)
    for block in (1_000, 40):
        got = embedding_dedup.near_duplicates(df, block=block).collect()
        assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == want
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    again = embedding_dedup.near_duplicates(df.unionByName(df.limit(50)).unionByName(df.limit(1).withColumn("vec_id", F.lit(None).cast("long")))).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in again if r["vec_id"] is not None} == want
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_embedding_links_without_clusters(spark):
    """Links near the threshold between cells of spread vectors: none is lost, at any number of cells."""
    rnd = np.random.default_rng(6)
    one = rnd.normal(size=(250, 24))
    two = rnd.normal(size=(250, 24))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    two -= (two * one).sum(axis=1, keepdims=True) * one
    two /= np.linalg.norm(two, axis=1, keepdims=True)
    cosine = rnd.uniform(0.88, 0.93, size=(250, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([one, cosine * one + np.sqrt(1 - cosine**2) * two]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want = brute.vector_groups(rows)
    assert sum(n for n, _ in want.values()) > 200
    for sample in (embedding_dedup.SAMPLE, 60):
        got = embedding_dedup.near_duplicates(df, block=200, sample=sample).collect()
        assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == want


# byte-level BPE

def test_byte_bpe(docs, odd_docs, no_docs):
    import tiktoken

    path = tokenizer_path("byte_bpe_50k.tiktoken")
    encoding = tiktoken.Encoding("own", pat_str=tokenizer_pattern(), mergeable_ranks=byte_bpe.load_ranks(path), special_tokens={})
    encoded = byte_bpe.encode(odd_docs, path, tokenizer_pattern())
    want = []
    for d, t in pairs(odd_docs):
        ids = encoding.encode_ordinary(t or "")
        want.append((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted([tuple(r) for r in byte_bpe.digests(encoded, path).collect()], key=str) == sorted(want, key=str)
    decoded = [(r["doc_id"], bytes(r["decoded"]).decode()) for r in byte_bpe.decode(encoded, path).collect()]
    assert sorted(decoded, key=str) == sorted([(d, t or "") for d, t in pairs(odd_docs)], key=str)
    assert byte_bpe.encode(no_docs, path, tokenizer_pattern()).count() == 0


def test_replay_goes_back_to_lower_ranks():
    """A merge that makes a pair of lower rank: that pair is next in its word."""
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 300, b"abc": 256, b"cd": 301, b"aa": 302, b"aaaa": 303, b"bcd": 299, b"dab": 258}
    replay = byte_bpe.Replay(ranks)

    def plain(word):
        parts = [bytes([b]) for b in word]
        while True:
            best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
            if best is None:
                return [ranks[p] for p in parts]
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

    rnd = random.Random(4)
    words = {"".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 14))) for _ in range(3000)}
    words = {w for w in words if w.encode() not in ranks}
    got = replay.encode(words)
    assert all(got[w] == plain(w.encode()) for w in words)


# SimHash and components

def test_simhash(docs, odd_docs, no_docs):
    want = brute.simhash_groups(pairs(docs))
    got = simhash.groups(docs).collect()
    assert {r["doc_id"]: (r["fingerprint"] % 2**64, r["component_id"]) for r in got} == want
    odd = simhash.groups(odd_docs).collect()
    assert len(odd) == odd_docs.count()
    assert {r["doc_id"]: (r["fingerprint"] % 2**64, r["component_id"]) for r in odd if r["doc_id"] is not None} == want
    assert all(r["component_id"] is None for r in odd if r["doc_id"] is None)
    kept = simhash.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, (_, c) in want.items() if d == c} | {None}
    assert simhash.groups(no_docs).count() == 0


def test_simhash_links(spark):
    """Planted fingerprints: every pair of at most four differing bits is linked, chains and large groups included."""
    rnd = random.Random(8)
    prints = [rnd.getrandbits(64) for _ in range(300)]
    for p in prints[:60]:
        for _ in range(4):
            prints.append(p := p ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 5))))
    prints += [prints[0] ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)]
    prints = list(dict.fromkeys(prints))
    near = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    root = brute.linked(len(prints), near)
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p, i) for i, p in enumerate(prints)], "print long, id long")
    got = {r["node"]: r["component"] for r in simhash.link_fingerprints(df).collect()}
    assert {i: got.get(i, i) for i in range(len(prints))} == dict(enumerate(root))


def test_edges_of_a_hub_stay_spread(spark):
    """A third of all edges at one vertex: the lookup of its minimum leaves them on all partitions."""
    edges = spark.range(1, 100_001).select(F.lit(0).cast("long").alias("_u"), F.col("id").alias("_v"))
    edges = edges.unionByName(spark.range(200_000, 400_000).select(F.col("id").alias("_u"), (F.col("id") + 1_000_000).alias("_v")))
    least = edges.groupBy("_u").agg(F.min("_v").alias("_m"), F.count(F.lit(1)).alias("_n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = components_module._with_least(edges, least)
        rows = found.groupBy(F.spark_partition_id().alias("p")).agg(F.count_if(F.col("_u") == 0).alias("hub"), F.count(F.lit(1)).alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(r["n"] for r in rows) == 300_000 and sum(r["hub"] for r in rows) == 100_000
    assert max(r["n"] for r in rows) < 2 * 300_000 / len(rows) and max(r["hub"] for r in rows) < 2 * 100_000 / 8
    linked = components(edges, "_u", "_v")
    assert linked.filter("component = 0").count() == 100_001 and linked.count() == 500_001


def test_components(spark):
    rnd = random.Random(6)
    edges = [(i, i + 1) for i in range(1, 200)] + [(1000, i) for i in range(1001, 1400)] + [(rnd.randint(2000, 2300), rnd.randint(2000, 2300)) for _ in range(200)]
    edges += [(5, 5), (None, 3), (3, None), (1, 2), (2, 1)]
    nodes = sorted({x for e in edges for x in e if x is not None and None not in e and e[0] != e[1]})
    number = {x: i for i, x in enumerate(nodes)}
    root = brute.linked(len(nodes), [(number[a], number[b]) for a, b in edges if a is not None and b is not None and a != b])
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {x: nodes[root[number[x]]] for x in nodes}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0
