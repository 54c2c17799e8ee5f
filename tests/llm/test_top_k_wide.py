"""Finite vectors of any size take part in the exact top-k."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import topk

VECTORS = "vec_id long, embedding array<float>"


def test_large_components_are_queries_and_candidates(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((260, 6)).astype(np.float32)
    x[[7, 100, 150]] *= np.float32(3e5)
    x[200] *= np.float32(3e4)  # long, but within the blocks
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], VECTORS)
    z = [[int(np.floor(1024 * float(v))) for v in r] for r in x]
    got = {}
    for r in topk.top_k(topk.scaled(df), F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = {}
    for i in range(0, len(z), 50):
        scores = [(j, sum(a * b for a, b in zip(z[i], z[j], strict=True))) for j in range(len(z)) if j != i]
        want[i] = sorted(scores, key=lambda s: (-s[1], s[0]))[:10]
    assert got == want


def test_score_beyond_a_long_fails(spark):
    df = spark.createDataFrame([(0, [3e30]), (1, [2e30])], VECTORS)
    with pytest.raises(Exception, match="exceeds a long"):
        topk.top_k(topk.scaled(df), F.col("vec_id") == 0).collect()
