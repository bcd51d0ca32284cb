"""op6: chunks of vectors meet without being shuffled, whatever their size."""

import numpy as np
import pytest
from test_dedup import brute_cosine, vectors

from termweave.llm import embed_dedup


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("chunk, kind", [(1, "float"), (7, "double"), (4096, "float")])
def test_meetings_shuffle_no_vectors(spark, monkeypatch, chunk, kind):
    plans, staged = {}, embed_dedup.staged
    monkeypatch.setattr(embed_dedup, "staged", lambda df, tag: plans.update({tag: _plan(df)}) or staged(df, tag))
    some = vectors(3)[::5 if chunk == 1 else 1]
    rows = [(f"v{i:03}", [float(x) for x in v]) for i, v in enumerate(some)]
    df = spark.createDataFrame(rows, f"vec_id string, embedding array<{kind}>")
    got = embed_dedup.near_duplicates(df, block_width=6, home_chunk=chunk, visit_chunk=chunk)
    assert "CartesianProduct" in plans["vector-links"] and "Exchange" not in plans["vector-links"]
    # Rows and classes meet by a digest.
    assert "vector" not in "".join(x for x in _plan(got).split("\n") if "Exchange" in x)
    assert sorted(tuple(x) for x in got.collect()) == brute_cosine(rows)


def test_blocks_far_apart_are_left_out_and_pairs_at_the_limit_found():
    """Pairs on both sides of the cosine, differing in one block, in all, or in a single coordinate."""
    geo = embed_dedup.geometry(32, 0.9, 8, embed_dedup.SEED)
    g = np.random.default_rng(5)
    base = g.standard_normal((300, 32))
    base /= np.sqrt((base * base).sum(1))[:, None]
    away = g.standard_normal((300, 32))
    away -= (away * base).sum(1)[:, None] * base
    away /= np.sqrt((away * away).sum(1))[:, None]
    c = 0.9 + np.where(np.arange(300) % 2, 1e-5, -1e-5)
    other = c[:, None] * base + np.sqrt(1 - c * c)[:, None] * away
    i, j = embed_dedup.linked(geo, embed_dedup.Side(geo, base), embed_dedup.Side(geo, other))
    want = np.argwhere(base @ other.T / np.sqrt((other * other).sum(1)) >= 0.9)
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == sorted(map(tuple, want.tolist()))
    assert len(want) >= 150
    far = [embed_dedup.Side(geo, s * np.abs(base[:9]) @ geo.turn.T) for s in (1, -1)]
    assert all(embed_dedup._gap(*[f.boxes[b] for f in far]) >= 0 for b in range(4))
    assert len(embed_dedup.linked(geo, *far)[0]) == 0
