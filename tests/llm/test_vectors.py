"""Nearest vectors: several lengths in one table, recall above the sample's size."""

import numpy as np

from carelens.llm.op07_ann import SAMPLE, nearest


def brute(vectors, k=5, every=50):
    """{query: ids of the k nearest among the other ids with a vector of its length}."""
    out = {}
    for q, v in vectors.items():
        if q % every == 0:
            close = sorted((-float(np.dot(v, w) / np.sqrt(np.dot(v, v) * np.dot(w, w))), i) for i, w in vectors.items()
                           if i != q and len(w) == len(v))
            out[q] = [i for _, i in close[:k]]
    return out


def test_every_length_is_searched(spark):
    """Two lengths with a tree of their own, one in few rows, one in the query alone."""
    r = np.random.default_rng(5)
    dims = [8] * 300 + [5] * 200 + [3] * 40 + [2]
    r.shuffle(dims)
    dims[50], dims[100], dims[150] = 3, 5, 8
    lone = dims.index(2)
    dims[lone], dims[200] = dims[200], 2
    vectors = {i: r.normal(size=d) for i, d in enumerate(dims)}
    df = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "vec_id long, embedding array<double>")
    got = {}
    for x in nearest(df).orderBy("query_id", "rank").collect():
        got.setdefault(x.query_id, []).append(x.vec_id)
    want = brute(vectors)
    assert 200 not in got and want[200] == []  # no other row of its length
    assert got[50] == want[50]  # exact without a tree
    hits = sum(len(set(got.get(q, [])) & set(ids)) for q, ids in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert all(len(vectors[v]) == len(vectors[q]) for q, ids in got.items() for v in ids)
    assert all(len(got.get(q, [])) == len(ids) for q, ids in want.items())


def test_recall_beyond_the_sample(spark):
    r = np.random.default_rng(9)
    n = SAMPLE + 10_000
    centres = r.normal(size=(300, 32))
    x = (centres[r.integers(0, 300, n)] + 0.6 * r.normal(size=(n, 32))).astype(np.float64)
    import pandas as pd
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(n), "embedding": list(x)}), "vec_id long, embedding array<double>")
    got = {}
    for row in nearest(df).collect():
        got.setdefault(row.query_id, set()).add(row.vec_id)
    u = x / np.sqrt((x * x).sum(1, keepdims=True))
    hits = 0
    for q in range(0, n, 50):
        close = u @ u[q]
        close[q] = -2
        hits += len(got[q] & set(np.argsort(-close)[:5].tolist()))
    recall = hits / (5 * len(range(0, n, 50)))
    print(f"recall {recall:.4f}")
    assert recall >= 0.95
