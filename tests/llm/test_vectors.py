"""Vector searches against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from layerloom.llm.cross_polytope import hadamard, neighbours, rotate
from layerloom.llm.topk import read_lists, top_k

NAN, INF = float("nan"), float("inf")


def brute(rows, divisor, k, value=lambda x: x, nonzero=False):
    valid = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or nonzero and not any(v):
            continue
        valid.append((i, [float(np.float32(x)) for x in v]))
    width = max((len(v) for _, v in valid), default=0)
    full = [(i, np.array([value(x) for x in v] + [0.0] * (width - len(v)))) for i, v in valid]
    out = {}
    for at, (q, x) in enumerate(full):
        if q % divisor == 0:
            out[q] = sorted((-(x @ y), c) for j, (c, y) in enumerate(full) if j != at)[:k]
    return {q: [(c, -s) for s, c in x] for q, x in out.items()}


def found(df):
    """Results by query id; rows of one id that are queries have equal vectors here, so equal results."""
    out = {}
    for r in df.collect():
        assert out.setdefault(r["query_id"], {}).setdefault(r["rank"], (r["vec_id"], r["score"])) == (r["vec_id"], r["score"])
    for ranks in out.values():
        assert sorted(ranks) == list(range(1, len(ranks) + 1))
    return {q: [ranks[r] for r in sorted(ranks)] for q, ranks in out.items()}


def odd_rows():
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(60)]
    rows += [(100, None), (None, [1.0] * 8), (101, [NAN] + [1.0] * 7), (102, [None] + [1.0] * 7), (103, [INF] * 8), (104, [0.0] * 8), (105, [])]
    rows += [(i, [0.25] * 8) for i in range(200, 240)] + [(200, [0.25] * 8), (106, [0.5, -0.5])]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1.0, 2) for i, v in rows], "vec_id long, embedding array<float>, score double, rank int")


def test_top_k_equals_brute_force_on_odd_rows(spark):
    df = frame(spark, odd_rows())
    want = brute(odd_rows(), 10, 10, lambda x: np.floor(x * 1024))
    assert found(top_k(df, F.col("vec_id") % 10 == 0)) == want


def test_rows_of_one_id_find_each_other(spark):
    df = frame(spark, [(10, [1.0, 0.0]), (10, [1.0, 0.0]), (11, [0.5, 0.0])])
    rows = sorted(tuple(r) for r in top_k(df, F.col("vec_id") == 10).collect())
    assert rows == sorted([(10, 1, 10, 1 << 20), (10, 2, 11, 1 << 19)] * 2)
    near = sorted(tuple(r) for r in neighbours(df, F.col("vec_id") == 10).collect())
    assert near == sorted([(10, 1, 10, 1.0), (10, 2, 11, 0.5)] * 2)


@pytest.mark.parametrize("size", [1 << 20, 1 << 27, 1 << 57])
def test_large_components_are_exact(spark, size):
    rng = np.random.default_rng(size)
    x = rng.integers(-3, 4, (60, 4)).astype(float)
    x[::7] *= size  # products of two are beyond doubles, or, with the last, of one with a small number
    x[::7] += rng.integers(0, 2, (9, 4))
    ids = np.arange(60)
    whole = [[int(v) for v in r] for r in x]
    queries = ids if size < 1 << 31 else ids[ids % 7 > 0]
    q, v, s = read_lists(x, ids, x[queries], queries, 10)
    for i in queries:
        want = sorted((-sum(a * b for a, b in zip(whole[j], whole[i], strict=True)), j) for j in ids if j != i)[:10]
        assert [(-int(b), int(a)) for a, b in zip(v[q == i], s[q == i], strict=True)] == want
    df = frame(spark, [(1, [1e9, 1.0]), (2, [1.0, 2.0]), (4, [0.5, 0.5])])
    assert found(top_k(df, F.col("vec_id") == 1))[1] == [(2, int(1e9) * 1024 * 1024 + 2 * 1024 * 1024), (4, int(1e9) * 512 * 1024 + 512 * 1024)]


@pytest.mark.parametrize("n", [1, 2, 9, 50, 300])
def test_lists_equal_brute_force(n):
    rng = np.random.default_rng(n)
    x = rng.integers(-3, 4, (n, 6)).astype(float)
    ids = rng.permutation(n) + 7
    q, v, s = read_lists(x, ids, x[:20], ids[:20], 10)
    for i, asked in enumerate(ids[:20]):
        want = sorted((-(x[j] @ x[i]), ids[j]) for j in range(n) if ids[j] != asked)[:10]
        assert [(-b, a) for a, b in zip(v[q == asked], s[q == asked], strict=True)] == want


def test_neighbours_on_odd_rows(spark):
    got = found(neighbours(frame(spark, odd_rows()), F.col("vec_id") % 20 == 0))
    want = brute(odd_rows(), 20, 20, nonzero=True)
    assert got.keys() == want.keys()
    hit = sum(len({c for c, _ in got[q]} & {c for c, _ in want[q]}) for q in want)
    assert hit >= 0.9 * sum(map(len, want.values()))
    for q, rows in got.items():
        assert rows == sorted(rows, key=lambda x: (-x[1], x[0])) and len(rows) == 20


def test_recall_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], list(r["embedding"])) for r in df.collect()]
    want = brute(rows, 20, 20)
    got = found(neighbours(df, F.col("vec_id") % 20 == 0))
    hit = sum(len({c for c, _ in got[q]} & {c for c, _ in want[q]}) for q in want)
    assert hit >= 0.9 * sum(map(len, want.values()))
    exact = {q: dict(brute_row) for q, brute_row in brute(rows, 20, 500).items()}
    assert all(abs(s - exact[q][c]) < 1e-12 for q, x in got.items() for c, s in x)


def test_rotation_keeps_inner_products():
    x = np.random.default_rng(0).normal(size=(16, 5))
    y = rotate(x, 3)
    assert np.allclose(x.T @ x, y.T @ y, atol=1e-5)
    assert np.allclose(hadamard(hadamard(x)), x, atol=1e-5)


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert top_k(empty, F.col("vec_id") % 10 == 0).collect() == []
    assert neighbours(empty, F.col("vec_id") % 10 == 0).collect() == []
