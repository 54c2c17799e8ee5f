"""Graph build and search go on until they have converged."""

import numpy as np

from starmart.llm import ann


def test_search_ends_only_where_nothing_is_left_to_open(spark, monkeypatch):
    monkeypatch.setattr(ann, "LANDMARKS", 4)
    n = 120
    code = lambda x: ann.encode(np.array([[x]], np.float32))[0]
    graph = spark.createDataFrame(
        [(i, code(i), near, [1.0] * len(near), [False] * len(near)) for i in range(n) for near in [[j for j in (i - 1, i + 1) if 0 <= j < n]]],
        f"id long, code binary, {ann._LISTS}")
    asked = [10, 40, 70, 110]
    queries = spark.createDataFrame([(q, code(q + 0.25), None) for q in asked], "query long, q binary, node long")
    found = {}
    for r in ann.search(graph, queries, ef=2).collect():
        found.setdefault(r.query, set()).add(r.node)
    assert found == {q: {q, q + 1} for q in asked}


def test_descent_ends_by_its_updates(spark, monkeypatch):
    monkeypatch.setattr(ann, "CHUNK", 64)
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in x]) for i, x in enumerate(rng.standard_normal((1500, 24)))]
    nodes = spark.createDataFrame(rows, "id long, f array<float>")
    assert ann.build(nodes).selectExpr("sum(size(filter(fresh, x -> x)))").first()[0] <= ann.DELTA * ann.K * len(rows)


def test_orders_grow_with_the_logarithm():
    assert [ann.orders(n) for n in (0, 1, 51_282, 1 << 16, 1 << 19, 1 << 22)] == [8, 8, 8, 8, 11, 14]


def test_codes_hold_vectors_to_a_step():
    x = np.random.default_rng(3).standard_normal((50, 20)).astype(np.float32)
    x[0], x[1, 3] = 0, np.inf
    back = ann.decode(ann.encode(x))
    assert (np.abs(back - x)[2:] <= np.abs(x[2:]).max(1, keepdims=True) / 253).all()
    assert not back[0].any() and back[1, 0] > 1e17 and np.isfinite(back).all()
