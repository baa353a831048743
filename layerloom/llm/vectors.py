"""Blocks of queries against blocks of vectors, shared by both vector searches.

Vectors are dealt by id hash into blocks of about ``block_rows``, queries into blocks of
``query_rows``. Each pair of blocks is one task of bounded memory; it returns its best
candidates for each query, and a window of k rows per block and query keeps the best of all.

Defined cases: rows without id or vector, or with null or non-finite components take no part. Rows with the same id are
rows of their own: each is a candidate of all others, also of those with its id, and a query if its id is one. Shorter vectors are filled up with
zeros; an empty table gives no rows; extra columns are ignored, and none can clash, as two are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerloom.llm.common import written

#: f(vectors n*d, vector ids, row numbers, queries m*d, row numbers of queries) -> arrays (row number of query, vector id, score)
Search = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def valid_vectors(df: DataFrame, value: Callable[[Column], Column], nonzero: bool = False) -> DataFrame:
    """``vec_id, v``; components are ``value`` of the double component."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite)
    if nonzero:
        rows = rows.filter(F.exists("v", lambda x: x != 0))
    return rows.select("vec_id", F.transform("v", value).alias("v"))


def matrix(values: pd.Series, width: int) -> np.ndarray:
    if values.map(len).eq(width).all():
        return np.stack(values.to_numpy()) if len(values) else np.zeros((0, width))
    out = np.zeros((len(values), width))
    for i, v in enumerate(values):
        out[i, : len(v)] = v
    return out


def search_blocks(vectors: DataFrame, query: Column, search: Search, k: int, block_rows: int, query_rows: int, score: str) -> DataFrame:
    """``query_id, rank, vec_id, score``: for rows with ``query``, their k best other rows."""
    vectors = written(vectors.withColumn("row", F.monotonically_increasing_id()), "vectors")  # numbers are written, so they stay
    facts = vectors.agg(F.count("*").alias("n"), F.count(F.when(query, 1)).alias("q"), F.max(F.size("v")).alias("d")).head()
    blocks, query_blocks = max(1, math.ceil(facts["n"] / block_rows)), max(1, math.ceil(facts["q"] / query_rows))
    width = facts["d"] or 1
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("vec_id", "row"), F.lit(n)).cast("int")
    left = vectors.select(dealt(blocks).alias("b"), every(query_blocks).alias("g"), "vec_id", "row", "v")
    right = vectors.filter(query).select(every(blocks).alias("b"), dealt(query_blocks).alias("g"), "vec_id", "row", "v")

    def best(one: pd.DataFrame, many: pd.DataFrame) -> pd.DataFrame:
        ids, rows, asked = one["vec_id"].to_numpy(np.int64), one["row"].to_numpy(np.int64), many["row"].to_numpy(np.int64)
        if len(ids) and len(asked):
            q, v, s = search(matrix(one["v"], width), ids, rows, matrix(many["v"], width), asked)
        else:
            q = v = s = np.zeros(0, np.int64)
        id_of = dict(zip(asked.tolist(), many["vec_id"].tolist(), strict=True))
        return pd.DataFrame({"query": q, "query_id": [id_of[i] for i in q.tolist()], "vec_id": v, "score": s})

    found = left.groupBy("b", "g").cogroup(right.groupBy("b", "g")).applyInPandas(best, f"query long, query_id long, vec_id long, score {score}")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k highest scores, ties to the smaller id."""
    if scores.dtype == object:
        return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i]))[:k], int)
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= least)
        return keep[np.lexsort((ids[keep], -scores[keep]))[:k]]
    return np.lexsort((ids, -scores))[:k]
