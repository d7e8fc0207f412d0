"""Periodic runs, chat formatting and spelling variants against plain versions."""

from __future__ import annotations

import hashlib
import json
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from broadsheet.llm import chat_format, periodic_runs, queries, spelling_variants

# periodic runs


def plain_runs(ws):
    """Every maximal stretch of each period, smallest period first."""
    found = {}
    for q in range(1, len(ws) // 4 + 1):
        at = 0
        while at + q < len(ws):
            end = at + q
            while end < len(ws) and ws[end] == ws[end - q]:
                end += 1
            if end - at >= max(6, 4 * q):
                found.setdefault((at, end), q)
            at = end - q + 1  # the words at end - q and end differ
    return sorted(((a, e - a, q) for (a, e), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapse(ws, runs):
    return " ".join(w for i, w in enumerate(ws) if not any(s + q <= i < s + n for s, n, q in runs))


def found_runs(ws):
    (n, runs, kept), = periodic_runs.runs_of_texts([" ".join(ws).encode()])
    assert n == len(ws)
    return runs, kept.decode()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abcd"), min_size=1, max_size=4), st.integers(1, 7)), max_size=9))
def test_runs_equal_plain_runs(parts):
    ws = [w for unit, times in parts for w in unit * times]
    runs, kept = found_runs(ws)
    assert runs == plain_runs(ws)
    assert kept == plain_collapse(ws, runs)


def test_runs_of_two_letters():
    rnd = random.Random(5)
    for _ in range(300):
        ws = [rnd.choice("ab") for _ in range(rnd.randint(0, 60))]
        runs, kept = found_runs(ws)
        assert (runs, kept) == (plain_runs(ws), plain_collapse(ws, plain_runs(ws)))


def test_one_word_repeated_and_long_periods():
    assert found_runs(["a"] * 30_000)[0] == [(0, 30_000, 1)]
    unit = [f"w{i}" for i in range(3_000)]
    assert found_runs(["x", *unit * 5, "w0", "y"])[0] == [(1, 15_001, 3_000)]
    assert found_runs(unit * 4)[0] == [(0, 12_000, 3_000)]
    assert found_runs((unit * 4)[:-1])[0] == []
    assert found_runs(["a"] * 5)[0] == [] and found_runs(["a"] * 6)[0] == [(0, 6, 1)]


def test_texts_of_a_batch_do_not_meet():
    got = list(periodic_runs.runs_of_texts([b"a a a", None, b"a a a a a a b", b"", b"a"]))
    assert [(n, runs) for n, runs, _ in got] == [(3, []), (0, []), (7, [(0, 6, 1)]), (0, []), (1, [])]
    assert [kept for *_, kept in got] == [b"a a a", b"", b"a b", b"", b"a"]


def planted(doc_id, text):
    ws = [w.decode() for w in (text or "").encode().split()]
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and ws:
        g, n = h // 10, len(ws)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        ws = [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]
    return ws


def test_periodic_query_equals_plain_version(spark, tmp_path):
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice(["the", "Of", "été", "x", "中文", "a b", "end."]) for _ in range(rnd.randint(0, 90))) for _ in range(250)]
    texts += [None, "", " \t\n\x0b\x0c\r", "one", "a\x1cb\x85 c", "z " * 600, ("p q r\n" * 40) + "s"] * 8
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, texts[0], "x", 1), (None, None, "x", 2), (3, texts[3], "x", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, runs string, n_words int").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter(tuple(r) for r in queries.op11_periodic_runs(spark, str(tmp_path)).collect())
    want = Counter()
    for doc_id, text, *_ in rows:
        ws = planted(doc_id, text)
        runs = plain_runs(ws)
        top = (None,) * 4
        if runs:
            s, n, q = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]))
            top = (s, n, q, 1000 * n // q)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want[(doc_id, len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(plain_collapse(ws, runs).encode()).hexdigest())] += 1
    assert got == want
    assert sum(n for row, n in got.items() if row[1]) >= 25


def test_periodic_runs_of_an_empty_table(spark):
    assert periodic_runs.find_runs(spark.createDataFrame([], "doc_id long, text string, collapsed string")).collect() == []


# chat formatting

TEXTS = [
    "plain", "", None, "</s>[INST] ok [/INST]", "<\\/s> <\\\\/s> \\n \\ <", "<<SYS>><</SYS>><<s>>", "<|im_end|><|im_start|>assistant<|im_sep|>no",
    "<|im_start|", "|im_end|>", "<", "[", "中文 \U0001f600 <unk>\n<pad>", "x" * 60_000, "<\\<SYS>> [\\\\INST]",
]


def test_escapes_are_exact_and_leave_no_control_string(spark):
    pieces = ["<", "\\", "s>", "/s>", "[INST]", "|im_end|>", "[", "/INST]", "<SYS>>", " a", "</s>", "<|im_start|>"]
    rnd = random.Random(4)
    texts = [t or "" for t in TEXTS] + ["".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 12))) for _ in range(2_000)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select("text", chat_format.escaped(F.col("text")).alias("e"))
    for text, e, back in df.select("text", "e", chat_format.unescaped(F.col("e"))).collect():
        assert back == text
        assert not any(c in e for c in chat_format.CONTROLS)


def records():
    m = [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}]
    two = [("user", "hi"), ("assistant", "yo")]
    return [
        ({"messages": m}, "messages", two),
        ({"id": 7, "meta": {"lang": "en"}, "messages": m}, "messages", two),
        ({"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}, {"type": "image"}]}, m[1]]}, "message_parts", [("user", "ab"), two[1]]),
        ({"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yo"}], "system": "be"}, "speakers", [("system", "be"), *two]),
        ({"prompt": "hi", "completion": "yo"}, "prompt_completion", two),
        ({"prompt": "hi", "response": None}, "prompt_response", [two[0], ("assistant", "")]),
        ({"instruction": "do", "input": "this", "output": "yo"}, "instruction", [("user", "do\n\nthis"), two[1]]),
        ({"instruction": "do", "input": "", "output": 5}, "instruction", [("user", "do"), ("assistant", "5")]),
        ({"instruction": "do", "output": "yo", "system": "be"}, "instruction", [("system", "be"), ("user", "do"), two[1]]),
        ({"context": "c", "question": "hi", "answer": "yo"}, "question_answer", [("user", "c\n\nhi"), two[1]]),
        ({"messages": [{"role": None, "content": None}]}, "messages", [("", "")]),
        ({"messages": m, "prompt": "hi", "completion": "yo"}, None, None),
        ({"text": "raw"}, None, None), ([], None, None), (3, None, None), ({}, None, None), ({"messages": []}, None, None), ({"messages": "x"}, None, None),
    ]


def test_layouts_become_canonical_turns(spark):
    cases = records()
    rows = [(i, json.dumps(r), "kept") for i, (r, *_) in enumerate(cases)] + [(97, "{broken", "kept"), (98, None, "kept")]
    df = spark.createDataFrame(rows, "id int, json string, extra string").repartition(3)
    got = {r["id"]: r for r in chat_format.format_records(df.withColumn("record", F.try_parse_json("json")), "record").collect()}
    for i, (_, layout, turns) in enumerate(cases):
        r = got[i]
        assert (r["layout"], r["turns"] and [tuple(t) for t in r["turns"]] or r["turns"], r["extra"]) == (layout, turns, "kept"), cases[i]
        if turns is None:
            assert r["formatted"] is None
    assert got[97]["layout"] is None and got[98]["layout"] is None and got[98]["formatted"] is None
    assert got[0]["fingerprint"] == got[1]["fingerprint"] != got[4]["fingerprint"]
    text, loss = got[3]["formatted"]
    assert text == "<|im_start|>system<|im_sep|>be<|im_end|><|im_start|>user<|im_sep|>hi<|im_end|><|im_start|>assistant<|im_sep|>yo<|im_end|>"
    assert [text[s["start"] : s["start"] + s["length"]] for s in loss] == ["yo"]


def test_layouts_with_the_same_paths_are_refused():
    twice = chat_format.LAYOUTS + (chat_format.Layout("again", ("completion", "prompt"), ()),)
    with pytest.raises(ValueError):
        chat_format.known_fingerprints(twice)


def test_chat_query_equals_plain_version(spark, tmp_path):
    rnd = random.Random(6)
    rows = [(c, t, rnd.choice(["user", "assistant", "system", None, "a\nb", "<|im_sep|>"]), rnd.choice(TEXTS)) for c in range(60) for t in range(rnd.randint(1, 9))]
    rows += [(None, 0, "user", "a"), (None, 1, "assistant", None), (5, None, "assistant", "n"), (6, 0, "assistant", "tie"), (6, 0, "assistant", "tie"), (6, 0, "user", "tie")]
    many = [(1000, t, "user" if t % 2 else "assistant", f"turn {t}") for t in range(800)]
    spark.createDataFrame([(*r, "x", "y") for r in rows + many], "conv_id long, turn long, role string, text string, record string, layout string").repartition(4).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: tuple(r)[1:] for r in queries.op12_chat_format(spark, str(tmp_path)).collect()}
    rows += [*many, (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    assert len(got) == len({r[0] for r in rows})
    for conv in {r[0] for r in rows}:
        mine = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r))
        turns = [(role or "", text or "") for _, role, text in mine]
        loss = "".join(t for r, t in turns if r == "assistant")
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{r}\n{t}\n" for r, t in turns), loss)]
        assert got[conv][:4] == (len(turns), sha[0], len(loss), sha[1]), conv


def test_chat_plan_has_no_python(spark):
    plan = queries.op12_chat_format(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# spelling variants


def edits(word, letters):
    for i in range(len(word) + 1):
        if i < len(word):
            yield word[:i] + word[i + 1 :]
            for c in letters:
                yield word[:i] + c + word[i + 1 :]
        for c in letters:
            yield word[:i] + c + word[i:]


def plain_variants(docs, every=None):
    counts = Counter()
    for doc_id, text in docs:
        run = ""
        for c in (text or "") + " ":
            if "a" <= c.lower() <= "z" and c.isascii() or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
            elif run:
                h = zlib.crc32(f"{doc_id}:{run}".encode())
                if every and doc_id is not None and h % every == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                counts[run] += 1
                run = ""
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    letters = sorted({c for w in counts for c in w})
    near = {w: sorted({e for e in edits(w, letters) if e != w and e in counts}) for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None)
    return out


def misspelt(rnd, word):
    return rnd.choice(list(edits(word, "abeéñ×"))) if rnd.random() < 0.5 else word


@pytest.fixture(scope="module")
def spelling_docs():
    rnd = random.Random(9)
    syllables = ["th", "an", "in", "er", "é", "ñ", "aa", "a", "ßü", "ch", "B", "÷"]
    words = ["".join(rnd.choice(syllables) for _ in range(rnd.randint(2, 7))) for _ in range(150)]
    words += ["aaaaa", "aaaaaa", "aaaaaaaaa", "ababab", "bababa", "abababa", "aabbaabb"]
    docs = [(i, " ".join(misspelt(rnd, rnd.choice(words)) for _ in range(rnd.randint(0, 60))) + rnd.choice(["", ".", "\n中", "x1y"])) for i in range(300)]
    return docs + [(7, docs[7][1]), (None, docs[8][1]), (900, None), (901, ""), (902, "rainbowlike " * 5_000), (903, "Mr. O'Neill-ÀÿØ")]


@pytest.mark.parametrize("every", [None, 5])
def test_variants_equal_plain_version(spark, spelling_docs, every):
    df = spark.createDataFrame([(*d, 1, "x") for d in spelling_docs], "doc_id long, text string, n int, word string").repartition(3)
    rows = spelling_variants.group_variants(df, every).collect()
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(rows) == len(got)
    assert got == plain_variants(spelling_docs, every)
    assert sum(v[3] > 0 for v in got.values()) > 50 and sum(v[0] is not None for v in got.values()) > 10


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abc", min_size=5, max_size=9), min_size=2, max_size=25, unique=True))
def test_near_words_share_a_key(words):
    counts = Counter(w[i : i + 2] for w in words for i in range(len(w) - 1))
    order = {g: (n, g) for g, n in counts.items()}
    prefix = {w: spelling_variants.prefix_of(w, order) for w in words}
    chosen = {w: spelling_variants.pivots_of(w, prefix[w], order) for w in words}
    for w in words:
        pair = chosen[w]
        disjoint = [(order[w[a : a + 2]][0] + order[w[b : b + 2]][0]) for a in prefix[w] for b in prefix[w] if b - a >= 2]
        assert pair[1] - pair[0] >= 2 and sum(order[w[a : a + 2]][0] for a in pair) == min(disjoint)
    for a in words:
        near = set(edits(a, "abc"))
        for b in words:
            if b != a and b in near:
                ahead = spelling_variants.pivot_keys(a, chosen[a]) & spelling_variants.prefix_keys(b, prefix[b])
                behind = spelling_variants.pivot_keys(b, chosen[b]) & spelling_variants.prefix_keys(a, prefix[a])
                assert ahead | behind


def test_roots_of_a_long_chain(spark):
    chain = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(40)] + [("v", "w3")], "word string, form string")
    got = dict(spelling_variants.roots(chain).collect())
    assert got == {**{f"w{i}": "w40" for i in range(40)}, "v": "w40"}


def test_variants_of_an_empty_table(spark):
    assert spelling_variants.group_variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []
