"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a key from a hash of its id, which orders each source at random but
repeatably. Prefix sums of word counts run over the key order of a source: sums per key range (two
levels of hex prefixes of the key), then within a range, so that no task sees a whole source. A source's
budget is its target, rounded: it is taken as whole epochs plus the documents up to the rest of the
budget in key order. ``mix`` counts the first words of the document at the cut, so budgets are met exactly;
``mix_documents`` takes it whole or not at all.

Defined cases: a null text has size 0; a null source is a source of its own, last in order;
rows without an id share one key and are told apart by size. Equal rows are one group that
is taken copy by copy, so a repeated row never gathers in one task. No rows give no rows. Extra
columns are ignored by ``mix`` and kept by ``mix_documents``. A source without words has target 0.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerloom.llm.common import WORD, written

WEIGHTS = (5, 2, 1)
MOST = 3
RANGE_ROWS = 1024
BLOCK = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row per source: ``source, source_size, target``.

    Weights repeat over the sources in code-point order, null last. Targets share all words by
    weight; none exceeds ``MOST`` times its source, and the excess goes to the others by weight.
    That is one level for all uncapped sources: sorted by the level at which a source is full, the
    first source that the level of the remaining words does not fill decides it. The windows run
    over one row per source.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weighted = sources.select("*", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("long").alias("weight"))
    full = F.col("source_size").cast("double") * MOST / F.col("weight")
    order = Window.orderBy("full", F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - MOST * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(after)
    filled = weighted.withColumn("full", full).withColumn("level", level)
    decided = filled.withColumn("level", F.min(F.when(F.col("level") <= F.col("full"), F.struct("full", "level"))).over(everything)["level"])
    target = F.when(F.col("full") <= F.col("level"), F.col("source_size").cast("double") * MOST).otherwise(F.col("level") * F.col("weight"))
    return decided.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: int = 0, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for every row of ``docs``.

    ``taken`` counts the words that the mix takes of the row, repeats included.
    """
    sizes = written(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size")),
        "mix-sizes",
    )
    rows = sizes.groupBy("source", "doc_id", "size").agg(F.count("*").alias("copies")).withColumn("key", _key(seed))
    met = _rests(rows, sizes, weights, range_rows)
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(BLOCK).cast("long")))
    first = met.withColumn("first", blocks)
    each = first.withColumn("copy", F.explode(F.sequence(F.col("first"), F.least(F.col("first") + (BLOCK - 1), F.col("copies") - 1))))
    taken = F.col("epochs") * F.col("size") + F.greatest(F.lit(0).cast("long"), F.least("size", F.col("rest") - F.col("copy") * F.col("size")))
    return each.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def _key(seed: int, *more: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), *more))


def _rests(groups: DataFrame, sizes: DataFrame, weights: tuple[int, ...], range_rows: int) -> DataFrame:
    """``groups`` with ``source_size, target, epochs`` and ``rest``: the words of the last epoch that are left where the group begins.

    ``groups`` has ``source, doc_id, size, copies, key``; columns beyond these only break ties of the order.
    """
    digits = max(2, math.ceil(math.log(max(2, sizes.count() / range_rows), 16)))
    coarse = digits // 2
    keyed = groups.select("*", F.substring("key", 1, coarse).alias("hi"), F.substring("key", coarse + 1, digits - coarse).alias("lo"))

    ranges = keyed.groupBy("source", "hi", "lo").agg(F.sum(F.col("size") * F.col("copies")).alias("words"))
    upper = ranges.groupBy("source", "hi").agg(F.sum("words").alias("words"))
    prefix = (Window.unboundedPreceding, -1)
    upper = upper.select("source", "hi", _before("words", Window.partitionBy("source").orderBy("hi").rowsBetween(*prefix)).alias("hi_before"))
    lower = ranges.select("source", "hi", "lo", _before("words", Window.partitionBy("source", "hi").orderBy("lo").rowsBetween(*prefix)).alias("lo_before"))
    start = _join(_join(lower, upper, "hi"), source_targets(sizes, weights))
    start = start.select("source", "hi", "lo", "source_size", "target", (F.col("hi_before") + F.col("lo_before")).alias("start"))

    ties = [c for c in groups.columns if c not in ("source", "doc_id", "size", "copies", "key")]
    inside = Window.partitionBy("source", "hi", "lo").orderBy("key", F.col("doc_id").asc_nulls_first(), "size", *ties).rowsBetween(*prefix)
    placed = keyed.withColumn("within", _before(F.col("size") * F.col("copies"), inside))
    budget = F.least(F.round("target").cast("long"), MOST * F.col("source_size"))
    met = _join(placed, start, "hi", "lo").withColumn("budget", budget)
    epochs = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0))
    rest = F.col("budget") - F.col("epochs") * F.col("source_size") - (F.col("start") + F.col("within"))
    return met.withColumn("epochs", epochs).withColumn("rest", rest).drop("hi", "lo", "start", "within", "budget")


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: int = 0, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with the columns of ``docs``, whatever their names.

    Rows stay whole: the row at a source's cut is taken if at least half of it lies in the budget, so a source misses its target by half
    of that row at most. Keys come from id and row hash, so rows that share an id, or have none, are spread like all others. Equal rows
    are one group; where the cut divides a group, its rows are numbered partition by partition. Rows without words are never taken.
    """
    size, tell, row = (_free(docs, name) for name in ("size", "tell", "row"))
    plain = [f.name for f in docs.schema if f.dataType.typeName() != "map"]
    marks = {size: word_count(F.col("text")), tell: F.xxhash64(*[F.col(f"`{c}`") for c in plain]), row: F.monotonically_increasing_id()}
    rows = written(docs.withColumns(marks), "mix-rows")
    narrow = rows.select("doc_id", "source", F.col(size).alias("size"), F.col(tell).alias("tell"), F.col(row).alias("row")).filter("size > 0")
    same = ("source", "doc_id", "size", "tell")
    groups = narrow.groupBy(*same).agg(F.count("*").alias("copies")).withColumn("key", _key(seed, F.hex("tell")))
    whole = F.least(F.col("copies"), F.greatest(F.lit(0).cast("long"), F.expr("(2 * rest + size) div (2 * size)")))
    met = _rests(groups, narrow, weights, range_rows).withColumn("more", whole)
    met = written(met.select(*same, "copies", "epochs", "more").filter("epochs + more > 0"), "mix-groups")

    uniform = _same(narrow, met.filter("more = 0 or more = copies"), same)
    times = uniform.select("row", (F.col("epochs") + F.when(F.col("more") > 0, 1).otherwise(0)).alias("times"))
    divided = _same(narrow, met.filter("more > 0 and more < copies"), same).withColumn("part", F.shiftright("row", 33))
    parts = divided.groupBy(*same, "part").agg(F.count("*").alias("n"))
    parts = parts.withColumn("before", _before("n", Window.partitionBy(*same).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    turn = F.row_number().over(Window.partitionBy(*same, "part").orderBy("row"))
    numbered = _same(divided.withColumn("turn", turn), parts.select(*same, F.col("part").alias("__part"), "before"), same).filter("part = __part")
    extra = F.when(F.col("before") + F.col("turn") <= F.col("more"), 1).otherwise(0)
    times = times.unionByName(numbered.select("row", (F.col("epochs") + extra).alias("times"))).filter("times > 0")
    count = _free(docs, "times")
    times = times.select(F.col("row").alias(row), F.col("times").alias(count))
    each = rows.join(times, row).select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col(count).cast("int"))).alias(_free(docs, "copy")))
    return each.select(*[F.col(f"`{c}`") for c in docs.columns])


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have, in any case."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = f"_{name}"
    return name


def _same(left: DataFrame, right: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Inner equi-join on ``names``, nulls equal; Spark splits a hot group of the left side."""
    right = right.withColumnsRenamed({k: f"__{k}" for k in names})
    met = reduce(and_, [left[k].eqNullSafe(right[f"__{k}"]) for k in names])
    return left.join(right, met).drop(*[f"__{k}" for k in names])


def _before(value, window: Window) -> Column:
    return F.coalesce(F.sum(value).over(window), F.lit(0).cast("long"))


def _join(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Inner equi-join on ``source``, nulls equal, and ``keys``."""
    names = ("source", *keys)
    right = right.withColumnsRenamed({k: f"__{k}" for k in names})
    same = left["source"].eqNullSafe(right["__source"])
    for k in keys:
        same = same & (left[k] == right[f"__{k}"])
    return left.join(right, same).drop(*[f"__{k}" for k in names])
