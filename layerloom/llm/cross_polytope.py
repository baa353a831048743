"""Approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation (three rounds of random signs and a fast Hadamard transform) turns a unit vector,
and the signed axis nearest to the result is its bucket. Each block of vectors keeps ``TABLES``
tables of such buckets. A query probes, in each table, its ``PROBES`` nearest signed axes; the union of
those buckets is reranked by exact inner products. Every vector is in every table; buckets have no cap,
and a bucket that is large because many vectors are equal is split over the blocks like all rows.

Largest inner product becomes smallest angle by one more component, which gives all vectors the
greatest norm; original vectors decide the scores.

Defined cases are those of ``vectors``; zero vectors take no part either; a query's own row is no
candidate; a query that probes fewer than k vectors in a block gets all of the block's as candidates.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.llm.common import written
from layerloom.llm.vectors import best_of, search_blocks, valid_vectors

K = 20
TABLES = 24
PROBES = 6
BLOCK_ROWS = 8192
QUERY_ROWS = 4096
SEED = 20240117


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform along the first axis, whose length is a power of two."""
    d, n = x.shape
    h = 1
    while h < d:
        y = x.reshape(d // (2 * h), 2, h, n)
        z = np.empty_like(y)
        np.add(y[:, 0], y[:, 1], out=z[:, 0])
        np.subtract(y[:, 0], y[:, 1], out=z[:, 1])
        x = z.reshape(d, n)
        h *= 2
    return x / np.float32(np.sqrt(d))


def rotate(x: np.ndarray, table: int, seed: int = SEED) -> np.ndarray:
    """The pseudo-rotation of one table, of vectors in columns."""
    signs = np.random.default_rng((seed, table)).choice(np.array([-1.0, 1.0], x.dtype), (3, len(x), 1))
    for s in signs:
        x = hadamard(x * s)
    return x


def buckets(x: np.ndarray) -> np.ndarray:
    """The nearest signed axis of each column: the axis, plus their number if negative."""
    axis = np.abs(x).argmax(axis=0)
    return axis + len(x) * (x[axis, np.arange(x.shape[1])] < 0)


def probe(x: np.ndarray, count: int) -> np.ndarray:
    """Boolean rows over buckets: the ``count`` nearest signed axes of each column."""
    near = np.concatenate((x, -x)).T
    at = np.argpartition(-near, count - 1, axis=1)[:, :count]
    found = np.zeros(near.shape, bool)
    np.put_along_axis(found, at, True, axis=1)
    return found


def padded(x: np.ndarray, extra: np.ndarray) -> np.ndarray:
    """Vectors in columns, with the extra component, up to a power of two of rows."""
    out = np.zeros((1 << x.shape[1].bit_length(), len(x)), np.float32)
    out[: x.shape[1]], out[x.shape[1]] = x.T, extra
    return out


def nearest(x, ids, queries, asked, largest: float, k: int = K, tables: int = TABLES, probes: int = PROBES, rows=None):
    """The k best probed vectors of the block for each query, and their exact inner products."""
    rows = ids if rows is None else rows
    norms = (x**2).sum(axis=1)
    points = padded(x, np.sqrt(np.maximum(largest - norms, 0)))
    asks = padded(queries / np.linalg.norm(queries, axis=1, keepdims=True), np.zeros(len(queries)))
    near = np.zeros((len(queries), len(x)), bool)
    for t in range(tables):
        near |= probe(rotate(asks, t), min(probes, 2 * len(asks)))[:, buckets(rotate(points, t))]
    out = []
    for j, q in enumerate(queries):
        found = np.flatnonzero(near[j] & (rows != asked[j]))
        if len(found) < k:
            found = np.flatnonzero(rows != asked[j])
        scores = x[found] @ q
        best = best_of(scores, ids[found], k)
        out.append((np.full(len(best), asked[j]), ids[found][best], scores[best]))
    q, v, s = (np.concatenate(c) for c in zip(*out, strict=True))
    return q.astype(np.int64), v.astype(np.int64), s


def neighbours(df: DataFrame, query: Column, k: int = K, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """``query_id, rank, vec_id, score``: largest inner products found."""
    vectors = written(valid_vectors(df, lambda x: x, nonzero=True), "neighbours")
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    largest = vectors.agg(F.max(norm).alias("m")).head()["m"] or 0.0

    def search(x, ids, rows, queries, asked):
        return nearest(x, ids, queries, asked, largest, k, tables, probes, rows)

    return search_blocks(vectors, query, search, k, BLOCK_ROWS, QUERY_ROWS, "double")
