"""Quality classifier: ordinal cumulative-link regression on hashed text.

Graded ratings are 0 (poor), 1 (fair but toxic) and 2 (good). One weight vector over hashed features is shared
by all grades, and ordered thresholds cut its score: P(grade > j) = logistic(w.x - threshold j). Expected grade
and tail probability P(grade = 2) follow for every row.

Features of a whole text: its distinct words, and buckets of its share of each symbol, of repeated words,
of distinct words, and of its mean word length. The model is fitted on the ``SAMPLE`` labelled rows with
the smallest id hash (the bound is a parameter); their hashed features, not their texts, reach the driver. Features in
fewer than ``LEAST_ROWS`` of them keep weight 0. The least tail of rows that are kept comes from halves of these rows,
each rated by a model of the other: the cut that costs ``MOST_LOST`` of the good ones, though at least ``LEAST_TAIL``.

Defined cases: null text counts as empty; rows with null quality are no labels, null toxic counts as
0, and of repeated labels the lowest quality and the highest toxicity hold. Without any labels nothing is rejected and
scores are null. Repeated rows are scored each; empty tables give no rows; extra columns stay in ``select_quality``.
"""

from __future__ import annotations

import math
from collections import Counter
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 18
SAMPLE = 6000
LEAST_ROWS = 5
GRADES = 3
LEAST_TAIL = 0.5
MOST_LOST, LEAST_HELD = 0.02, 50
STEPS, SPARSITY = 800, 1e-3
SYMBOLS = "%|*#&$@^~<>{}[]\\/=+_;:!?()\"'-0123456789"
EDGES = ".,;:!?()\"'%|*#&$@^~<>{}[]\\/=+_-"
CACHED_WORDS = 400_000


def _slot(feature: str) -> int:
    return crc32(feature.encode("utf-8", "replace")) & ((1 << BITS) - 1)


def _share(part: float, whole: float) -> int:
    """Bucket of a share: 0 for none, then one per halving."""
    return 0 if part <= 0 else max(1, 12 + int(math.floor(math.log2(part / whole))))


def word_slot(word: str) -> int:
    return _slot("w:" + word.strip(EDGES).lower())


def shape_slots(text: str, words: list[str], distinct: int) -> list[int]:
    """Slots of the buckets that describe the whole text."""
    n = max(1, len(words))
    size = int(math.log2(n))
    found = [_slot(f"s:{c}:{_share(text.count(c), len(text) or 1)}") for c in SYMBOLS]
    repeats = sum(map(str.__eq__, words, words[1:]))
    length = sum(map(len, words)) / n
    found += [_slot(f"r:{_share(repeats, n)}"), _slot(f"d:{size}:{int(10 * distinct / n)}"), _slot(f"l:{int(2 * length)}"), _slot(f"n:{size}")]
    return found


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values; a word counts once for each form in which the text has it."""
    words = (text or "").split()
    distinct = set(words)
    counts = Counter(map(word_slot, distinct))
    counts.update(shape_slots(text or "", words, len(distinct)))
    return np.fromiter(counts.keys(), np.int32, len(counts)), np.fromiter(counts.values(), np.float32, len(counts))


class Ordinal:
    """Weights and thresholds; ``tails`` gives P(grade > j) for j = 0, 1."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray, cut: float = LEAST_TAIL):
        self.weights, self.thresholds, self.cut = weights, thresholds, cut
        self._cache: dict[str, float] = {}

    def score(self, text: str | None) -> float:
        words = (text or "").split()
        distinct = set(words)
        cache, weights = self._cache, self.weights
        fresh = [w for w in distinct if w not in cache]
        if fresh:
            if len(cache) + len(fresh) > CACHED_WORDS:
                cache.clear()
                fresh = distinct
            for w in fresh:
                cache[w] = float(weights[word_slot(w)])
        return math.fsum(map(cache.__getitem__, distinct)) + float(weights[shape_slots(text or "", words, len(distinct))].sum())

    def tails(self, score):
        return 1 / (1 + np.exp(-np.clip(np.asarray(score)[..., None] - self.thresholds, -500, 500)))

    def __getstate__(self):
        return {"weights": self.weights, "thresholds": self.thresholds, "cut": self.cut, "_cache": {}}


Rows = list[tuple[np.ndarray, np.ndarray, int]]


def fit_rows(rows: Rows, least_rows: int = LEAST_ROWS) -> Ordinal:
    """Maximum likelihood with a sparse penalty, by accelerated proximal gradient; thresholds stay ordered."""
    slots = np.concatenate([r[0] for r in rows]).astype(np.int64)
    values = np.concatenate([r[1] for r in rows]).astype(float)
    sizes = np.array([len(r[0]) for r in rows])
    row = np.repeat(np.arange(len(rows)), sizes)
    grade = np.array([r[2] for r in rows])
    used, where = np.unique(slots, return_inverse=True)
    common = np.bincount(where) >= least_rows
    keep = common[where]
    new = np.cumsum(common) - 1
    where, values, row, used = new[where[keep]], values[keep], row[keep], used[common]
    # parameters: weights, first threshold, log of the gap
    p = np.zeros(len(used) + 2)
    share = np.clip([(grade > 0).mean(), (grade > 1).mean()], 1e-3, 1 - 1e-3)
    first, second = -np.log(share / (1 - share))
    p[-2:] = first, math.log(max(second - first, 1e-2))
    n = len(rows)
    rate = 1 / _curvature(row, where, values, n, len(used))
    ahead, pace = p.copy(), 1.0
    for _ in range(STEPS):
        s = np.bincount(row, values * ahead[where], n)
        t0, gap = ahead[-2], math.exp(ahead[-1])
        up0, up1 = (1 / (1 + np.exp(-np.clip(s - t, -500, 500))) for t in (t0, t0 + gap))
        mid = np.maximum(up0 - up1, 1e-12)
        # derivatives of -log P by each threshold; the score moves against both
        by0 = np.where(grade == 0, -up0, np.where(grade == 1, up0 * (1 - up0) / mid, 0.0))
        by1 = np.where(grade == 1, -up1 * (1 - up1) / mid, np.where(grade == 2, 1 - up1, 0.0))
        g = np.empty_like(p)
        g[:-2] = np.bincount(where, values * -(by0 + by1)[row], len(used)) / n
        g[-2:] = (by0 + by1).sum() / n, by1.sum() / n * gap
        new = ahead - rate * g
        new[:-2] = np.sign(new[:-2]) * np.maximum(np.abs(new[:-2]) - rate * SPARSITY, 0)
        faster = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        ahead, p, pace = new + (pace - 1) / faster * (new - p), new, faster
    weights = np.zeros(1 << BITS, np.float32)
    weights[used] = p[:-2]
    return Ordinal(weights, np.array([p[-2], p[-2] + math.exp(p[-1])]))


def _curvature(row: np.ndarray, where: np.ndarray, values: np.ndarray, n: int, width: int) -> float:
    """Upper bound of the loss's curvature: largest eigenvalue by power iteration, thresholds included."""
    v = np.full(width, 1 / math.sqrt(max(1, width)))
    norm = 1.0
    for _ in range(20):
        v = np.bincount(where, values * np.bincount(row, values * v[where], n)[row], width)
        norm = float(np.linalg.norm(v)) or 1.0
        v = v / norm
    return 0.5 * (norm / n + 1)


def choose_cut(rows: Rows) -> float:
    """The least tail, from two halves that rate each other; the default where good or toxic rows are few."""
    grade = np.array([r[2] for r in rows])
    if min((grade == 1).sum(), (grade == 2).sum()) < LEAST_HELD:
        return LEAST_TAIL
    tails = np.empty(len(rows))
    for half in (0, 1):
        model = fit_rows(rows[1 - half :: 2])
        tails[half::2] = [model.tails(float((model.weights[slots] * counts).sum()))[1] for slots, counts, _ in rows[half::2]]
    return max(LEAST_TAIL, float(np.quantile(tails[grade == 2], MOST_LOST)))


def grade_of() -> Column:
    return F.when(F.col("quality") < 1, 0).when(F.col("toxic") > 0, 1).otherwise(2)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ordinal | None:
    """The model from at most ``sample`` labelled rows of ``docs``, or None without labels."""
    graded = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id")
    graded = graded.agg(F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    chosen = graded.select("doc_id", grade_of().alias("grade")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * sample)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most 2 * sample ids

    def extract(batches):
        for pdf in batches:
            found = [features(t) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "grade": pdf["grade"], "slots": [f[0].tobytes() for f in found], "counts": [f[1].tobytes() for f in found]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    sparse = texts.mapInPandas(extract, f"doc_id {kind}, grade int, slots binary, counts binary")
    rows = sparse.orderBy(F.xxhash64("doc_id"), "doc_id", "slots").limit(sample).collect()
    if not rows:
        return None
    rows = [(np.frombuffer(r["slots"], np.int32), np.frombuffer(r["counts"], np.float32), r["grade"]) for r in rows]
    model = fit_rows(rows)
    model.cut = choose_cut(rows)
    return model


def with_quality(docs: DataFrame, model: Ordinal | None, out: str = "quality") -> DataFrame:
    """``docs`` with a struct column ``out``: expected_grade, tail."""
    shape = "struct<expected_grade:double,tail:double>"
    if model is None:
        return docs.withColumn(out, F.lit(None).cast(shape))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(shape)
    def rate(texts: pd.Series) -> pd.DataFrame:
        tails = shared.value.tails([shared.value.score(t) for t in texts])
        return pd.DataFrame({"expected_grade": tails.sum(axis=-1), "tail": tails[..., -1]})

    return docs.withColumn(out, rate("text"))


def _cut(model: Ordinal | None, least_tail: float | None) -> float:
    return least_tail if least_tail is not None else model.cut if model else LEAST_TAIL


def rate_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, least_tail: float | None = None) -> DataFrame:
    """``doc_id, expected_grade, tail, keep`` of every row."""
    narrow = docs.select("doc_id", "text")
    model = fit(docs, labels, sample)
    rated = with_quality(narrow, model, "q")
    keep = F.coalesce(F.col("q.tail") >= _cut(model, least_tail), F.lit(True))
    return rated.select("doc_id", F.col("q.expected_grade").alias("expected_grade"), F.col("q.tail").alias("tail"), keep.alias("keep"))


def select_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, least_tail: float | None = None) -> DataFrame:
    """The rows of ``docs`` whose tail probability is high enough, all columns kept."""
    model = fit(docs, labels, sample)
    rated = with_quality(docs, model, "__quality")
    return rated.filter(F.coalesce(F.col("__quality.tail") >= _cut(model, least_tail), F.lit(True))).drop("__quality")
