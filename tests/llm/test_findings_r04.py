"""Finding F1 of round 4: what op8 stores grows with the vectors, not with the cells they may have links in."""

from __future__ import annotations

from pathlib import Path

import numpy as np

from broadsheet.llm import embedding_dedup
from broadsheet.session import shared_root


def _stored(spark) -> int:
    return sum(p.stat().st_size for p in Path(shared_root(spark).removeprefix("file://")).rglob("*.parquet"))


def test_vectors_are_not_copied_per_visit(spark):
    rnd = np.random.default_rng(9)
    base = rnd.normal(size=(1500, 64))
    vectors = np.concatenate([base, base + rnd.normal(size=base.shape) * 0.2])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors.astype(np.float32))], "vec_id long, embedding array<float>")
    before = _stored(spark)
    got = embedding_dedup.near_duplicates(df, block=300).collect()
    assert _stored(spark) - before < 4 * vectors.size * 4
    units = vectors.astype(np.float32).astype(np.float64)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    links = units @ units.T >= 0.9
    assert {r["vec_id"]: r["n_links"] for r in got} == dict(enumerate((links.sum(axis=1) - 1).tolist()))
    assert links.sum() > 2 * len(base)
