"""Exact top-k search by no-random-access aggregation over sorted lists.

The score is an inner product of integers, so each component is a list of a block's vectors by
value, read from the top where the query's weight is positive and from the bottom where it is negative.
All lists are read in step, an eighth at a time. What a vector has shown so far plus
the worst and the best that unread entries can add bounds its score from below and above. A
query stops reading when few outsiders can still reach its k-th lower bound; the scores of those that
are left are then resolved exactly. Ties survive, as a candidate stays while its upper bound equals the bound.

Defined cases are those of ``vectors``; a query's own row is no candidate; with fewer than k
candidates all are returned; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.llm.vectors import best_of, search_blocks, valid_vectors

K = 10
SCALE = 1024
ROUNDS = 8
RESOLVE = 64
BLOCK_ROWS = 4096
QUERY_ROWS = 512


def read_lists(x: np.ndarray, ids: np.ndarray, queries: np.ndarray, asked: np.ndarray, k: int = K, rounds: int = ROUNDS, rows: np.ndarray | None = None):
    """The k best vectors of the block for each query: arrays of query, vector id and score.

    ``asked`` names queries as ``rows``, by default ``ids``, names vectors; a query is no candidate of its own. Sums beyond 2**53 are no
    longer exact in doubles: bounds are widened by what they can be wrong, and scores come from integers.
    """
    n, width = x.shape
    rows = ids if rows is None else rows
    most = width * float(np.abs(x).max(initial=0)) * float(np.abs(queries).max(initial=0))
    slack = 0.0 if most < 2**53 else most * (width + 2) * 2.0**-51
    whole = (lambda a: a) if most < 2**53 else (lambda a: a.astype(np.int64)) if most < 2**62 else (lambda a: np.array([[int(v) for v in r] for r in np.atleast_2d(a)], object).reshape(a.shape))
    order = np.argsort(-x, axis=0, kind="stable")  # list d: order[:, d], highest value first
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(n)[:, None], axis=0)
    lists = np.take_along_axis(x, order, axis=0)
    up, down = np.maximum(queries, 0).T, np.minimum(queries, 0).T  # weights of lists read from the top, from the bottom
    open_ = np.arange(len(queries))
    partial = np.zeros((n, len(queries)))
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    keep = min(k + 1, n)  # one more, as the query itself may be in the block
    read = 0
    for step in range(1, rounds + 1):
        until = -(-n * step // rounds)
        top, bottom = place, n - 1 - place
        fresh = lambda at, lo=read, hi=until: np.where((at >= lo) & (at < hi), x, 0)
        partial += fresh(top) @ up + fresh(bottom) @ down
        read = until
        unread_top, unread_bottom = (top >= read).astype(float), (bottom >= read).astype(float)
        low = partial + (unread_top * lists[-1]) @ up + (unread_bottom * lists[0]) @ down
        high = partial + (unread_top * lists[read - 1]) @ up + (unread_bottom * lists[n - read]) @ down
        bound = np.partition(low, n - keep, axis=0)[n - keep]
        can = high + 2 * slack >= bound
        done = (can.sum(axis=0) <= max(RESOLVE, keep)) | (read == n)
        for j in np.flatnonzero(done):
            q = open_[j]
            left = np.flatnonzero(can[:, j] & (rows != asked[q]))
            scores = whole(x[left]) @ whole(queries[q]) if len(left) else np.zeros(0, np.int64)
            best = best_of(scores, ids[left], k)
            out.append((np.full(len(best), asked[q]), ids[left][best], scores[best]))
        if done.all():
            break
        partial, up, down, open_ = partial[:, ~done], up[:, ~done], down[:, ~done], open_[~done]
    return tuple(np.concatenate(c).astype(np.int64) for c in zip(*out, strict=True))


def top_k(df: DataFrame, query: Column, k: int = K, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score`` over components floor(scale * x).

    Scores are exact; one that does not fit a long is an error.
    """
    vectors = valid_vectors(df, lambda x: F.floor(x * scale).cast("double"))

    def search(x, ids, rows, queries, asked):
        return read_lists(x, ids, queries, asked, k, rows=rows)

    return search_blocks(vectors, query, search, k, BLOCK_ROWS, QUERY_ROWS, "long")
