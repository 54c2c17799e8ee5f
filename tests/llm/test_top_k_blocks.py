"""Exact top-k over many blocks: thresholds from the first ones lose nothing."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import topk


def brute(ids, x, own, k):
    score = x @ x[own]
    order = [i for i in np.lexsort((ids, -score)).tolist() if i != own][:k]
    return [(int(ids[i]), int(score[i])) for i in order]


@pytest.mark.parametrize("spread", [3, 400, 60_000])
def test_block_search_under_a_threshold(spread):
    rng = np.random.default_rng(spread)
    ids, x = rng.permutation(900), np.floor(rng.standard_normal((900, 24)) * spread).astype(np.int64)
    block = topk.Block(ids, x)
    for own in range(0, 900, 60):
        want = brute(ids, x, own, 10)
        for least in (-np.inf, float(want[-1][1]), float(want[4][1]), float(want[0][1]) + 1):
            rows, scores = block.search(x[own], ids[own], 10, least)
            got = dict(zip(ids[rows].tolist(), scores.tolist(), strict=True))
            assert {i: s for i, s in got.items() if s >= least} == {i: s for i, s in want if s >= least}
    if spread > 32:  # else a dimension has one or two steps only
        assert block.read < 900 * 24 * 15 * 4  # thresholds end some searches early


def test_many_blocks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "QUERIES", 8)
    rng = np.random.default_rng(8)
    x = np.round(rng.standard_normal((700, 6)), 1)
    x[40:80] = x[0]  # ties
    df = spark.createDataFrame([(i, v.tolist(), "own") for i, v in enumerate(x)], "vec_id long, embedding array<double>, least string")
    got = {}
    for r in topk.top_k(topk.scaled(df), F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    whole = np.floor(1024 * x).astype(np.int64)
    assert got == {i: brute(np.arange(700), whole, i, 10) for i in range(0, 700, 20)}
