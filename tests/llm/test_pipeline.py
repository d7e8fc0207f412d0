"""The pipeline against a plain version of its stages."""

from __future__ import annotations

import sys
import zlib
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).resolve().parent))
import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from broadsheet.llm import toxicity  # noqa: E402
from broadsheet.llm.common import table, tokenizer_path  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def test_pipeline(spark):
    from tokenizers import Tokenizer

    docs = table(spark, FOLDER, "documents")
    tagger = toxicity.Tagger(toxicity.train(docs, table(spark, FOLDER, "labels")))
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    clean = [(d, t) for d, t in rows if tagger.score(t)[0] < 0.7]
    good = [(d, t) for d, t in clean if not brute.quality_base(t)[5]]  # so few labels admit no cutoff
    lines = [(d, t) for d, _, _, t in brute.line_dedup(good)]
    groups = brute.simhash_groups(lines)
    kept = [(d, t) for d, t in lines if groups[d][1] == d]
    assert len(rows) > len(clean) > len(good) > len(kept) > 0
    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want = []
    for d, t in kept:
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], dtype="<u4")
        want += [(d, s, min(2048, len(ids) - s), zlib.crc32(ids[s : s + 2048].tobytes())) for s in range(0, len(ids), 2048)]
    got = corpus_pipeline.run(spark, FOLDER).select("doc_id", "start", "length", "ids_crc32").collect()
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_stages_keep_columns_and_take_empty_tables(spark):
    docs = table(spark, FOLDER, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(0), FOLDER)
        assert out.columns == docs.columns, name
        assert out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), FOLDER).count() == 0


def test_clashing_columns_survive(spark):
    from pyspark.sql import functions as F

    docs = table(spark, FOLDER, "documents").limit(30).withColumns({c: F.lit(5) for c in ("_toxicity", "_gone", "_lost_id", "score", "print")})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns, name
        assert {r["_toxicity"] for r in out.collect()} <= {5}
