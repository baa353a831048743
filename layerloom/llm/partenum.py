"""N-gram Jaccard join by PartEnum signatures, and its components.

Documents are sets of distinct five-word shingles (64-bit hashes). Two sets whose Jaccard similarity is at
least 0.8 differ in at most a ninth of their summed sizes. For each band of set sizes the feature domain is cut into
first-level partitions of three cells. If two sets of the band differ in at most k elements, at most k/2 partitions
hold two or more differences, so in each other partition two of the three cells agree: the set's
signatures are the hashes of all two-cell subsets of its partitions, and similar sets share one.
A set near the upper end of its band is signed in the next band too.

Three facts keep signatures few and still lose no link. A set of size s has no partner that differs in more than
(s + min(1.25 s, band end)) / 9 elements, so its first m partitions do, once m exceeds half of that; of two sets the one with the smaller m
decides. Subsets without elements say nothing and are left out; m grows by each partition that has one. A set for
which the band has too few partitions for that signs all of them, empty subsets too.

Equal sets are one class, known by a 64-bit hash of the whole set, so copies never meet. Signatures travel as
packed blobs of 4 bytes each to buckets, where equal ones form groups. A group gives its leader's
pairs first; when those are verified and their components known, only pairs across components remain: of small
groups as rows, of large ones in blocks of bounded size. Signatures that are frequent within one task are combined there, and only
their leader travels on. A pair is checked by a parity sketch (a lower bound of the difference; it
drops no link), then exactly on the whole sets.

Defined cases: null or wordless texts have an empty set, link with nothing and are their own component; fewer than five
words are one shingle; rows of one id are compared each, and a row without id has the least id of its component
(null if there is none); empty tables give no rows; extra columns are ignored by ``join_documents``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.llm.common import WORD, shuffle_partitions, written
from layerloom.llm.components import components

WORDS = 5
#: Similarity as a fraction: 100 * intersection >= 80 * union.
PART, WHOLE = 80, 100
BAND = 1.5
SPARE = 1.06
CACHED_WORDS = 400_000
CHUNK_CHARS = 1 << 21
U64 = np.uint64
M1, M2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], U64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> U64(30))) * M1
    x = (x ^ (x >> U64(27))) * M2
    return x ^ (x >> U64(31))


@dataclass(frozen=True)
class Limits:
    """Sizes that bound memory, not results.

    flush: signatures held by a task; hot: members from which a task combines a group;
    small: members up to which a group gives its pairs; block: members compared at once.
    """

    flush: int = 1_000_000
    hot: int = 64
    small: int = 16
    block: int = 256


class WordHashes(dict):
    """64-bit hashes of words, computed when first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingles(text: str | None, hashes: WordHashes) -> np.ndarray:
    """The sorted distinct shingles of a whole text; A-Z count as a-z."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, U64)
    if len(hashes) > CACHED_WORDS:
        hashes.clear()
    h = np.fromiter(map(hashes.__getitem__, words), U64, n)
    size = min(n, WORDS)
    sums = np.full(n - size + 1, U64(size), U64)
    for i in range(size):
        sums += h[i : n - size + 1 + i] * ODD[i]
    return np.unique(mix(sums))


def class_key(shingle_set: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(shingle_set.tobytes()) - (1 << 63)


def similar(both: int, one: int, two: int) -> bool:
    return WHOLE * both >= PART * (one + two - both)


def most_different(one, two):
    """The most elements in which linked sets of these sizes differ."""
    return ((WHOLE - PART) * (one + two)) // (WHOLE + PART)


@lru_cache(maxsize=1)
def bands() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last set size, and number of first-level partitions, of each band."""
    first, last, parts = [], [], []
    low = 1
    while low < 1 << 40:
        high = max(low, int(BAND * low))
        least = most_different(high, high) // 2 + 1
        first.append(low)
        last.append(high)
        parts.append(0 if most_different(high, high) == 0 else least if least < 4 else int(SPARE * least) + 1)
        low = high + 1
    return np.array(first), np.array(last), np.array(parts)


def signatures(flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of many sets, laid end to end: ``(hash, number of the set)``."""
    first, last, parts = bands()
    own = np.searchsorted(first, sizes, "right") - 1
    largest_partner = sizes * WHOLE // PART
    number = np.arange(len(sizes))
    upper = (largest_partner > last[own]) & (parts[own + 1] > 0)
    lower = parts[own] > 0
    sets = np.concatenate((number[lower], number[upper]))
    band = np.concatenate((own[lower], own[upper] + 1))
    if not len(sets):
        return np.zeros(0, U64), np.zeros(0, np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    s, n1 = sizes[sets], parts[band]
    # every element of every instance: where it lies in flat, and its cell
    total = int(s.sum())
    begin = np.cumsum(s) - s
    element = flat[np.arange(total) + np.repeat(starts[sets] - begin, s)]
    offset = np.cumsum(n1) - n1
    place = mix(element + np.repeat(band.astype(U64) * ODD[0], s))
    part = ((place >> U64(33)) * np.repeat(n1.astype(U64), s)) >> U64(31)
    cell = (np.repeat(offset, s) + part.astype(np.int64)) * 3 + (place % U64(3)).astype(np.int64)
    cells = int(n1.sum()) * 3
    count = np.bincount(cell, minlength=cells).reshape(-1, 3)
    sums = np.zeros(cells, U64)
    np.add.at(sums, cell, mix(element + ODD[1]))
    sums = sums.reshape(-1, 3)
    # how many partitions each set needs
    full = count.sum(axis=1)
    blank = full[:, None] == count  # the subset without cell j has no element
    hollow = blank.any(axis=1)
    instance = np.repeat(np.arange(len(sets)), n1)
    order = np.arange(len(instance)) - offset[instance]
    passed = np.cumsum(hollow)
    passed = passed - (passed[offset] - hollow[offset])[instance]
    differ = most_different(s, np.minimum(s * WHOLE // PART, last[band]))
    enough = order + 1 - passed > (differ // 2)[instance]
    needed = np.add.reduceat(~enough, offset) + 1
    sure = needed <= n1
    use = ((order < needed[instance])[:, None] & ~blank) | ~sure[instance][:, None]
    seed = mix(band[instance].astype(U64) * ODD[2] + order.astype(U64) * ODD[3])
    found = np.empty(sums.shape, U64)
    for j in range(3):
        a, b = (j + 1) % 3, (j + 2) % 3
        found[:, j] = mix(mix(sums[:, a] + ODD[a]) + mix(sums[:, b] + ODD[b]) * ODD[4] + seed + U64(j))
    return found[use], np.repeat(sets[instance][:, None], 3, axis=1)[use]


# Parity sketches


def sketch(shingle_set: np.ndarray) -> bytes:
    """Parities of hashed counts, at least four bits an element, a power of two of bytes."""
    bits = max(64, 1 << int(4 * len(shingle_set) - 1).bit_length())
    odd = np.bincount((shingle_set & U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def fold(bits: np.ndarray, size: int) -> np.ndarray:
    while len(bits) > size:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def may_link(one: bytes, two: bytes, n_one: int, n_two: int) -> bool:
    """False only if the parities alone show more differences than a link allows."""
    a, b = np.frombuffer(one, np.uint8), np.frombuffer(two, np.uint8)
    size = min(len(a), len(b))
    return int(np.bitwise_count(fold(a, size) ^ fold(b, size)).sum()) <= most_different(n_one, n_two)


# Groups of equal signatures


def sizes_fit(one, two):
    return WHOLE * np.minimum(one, two) >= PART * np.maximum(one, two)


def group(sig: np.ndarray, key: np.ndarray, size: np.ndarray, hot: np.ndarray, small: int):
    """Leader pairs, pairs of small groups, and members of large or hot groups.

    Returns arrays ``(a, b)``, ``(a, b)`` and ``(group, member)``, each without repeats.
    """
    order = np.argsort(sig, kind="stable")
    sig, key, size, hot = sig[order], key[order], size[order], hot[order]
    same = sig[1:] == sig[:-1]
    shared = np.zeros(len(sig), bool)
    shared[1:] |= same
    shared[:-1] |= same
    sig, key, size, hot = sig[shared], key[shared], size[shared], hot[shared]
    order = np.lexsort((~hot, key, sig))
    sig, key, size, hot = sig[order], key[order], size[order], hot[order]
    fresh = np.ones(len(sig), bool)
    fresh[1:] = (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])
    sig, key, size, hot = sig[fresh], key[fresh], size[fresh], hot[fresh]
    begin = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1]))) if len(sig) else np.zeros(0, int)
    count = np.diff(np.append(begin, len(sig)))
    which = np.repeat(np.arange(len(begin)), count)
    lead = begin[which]
    star = (lead != np.arange(len(sig))) & sizes_fit(size, size[lead])
    stars = _distinct(key[lead[star]], key[star])
    heated = np.bincount(which, hot, len(begin)) > 0 if len(begin) else np.zeros(0, bool)
    pairs_a, pairs_b = [], []
    for m in range(3, small + 1):
        at = begin[(count == m) & ~heated]
        if len(at):
            i, j = np.triu_indices(m, 1)
            i, j = i[i > 0], j[i > 0]
            a, b = (at[:, None] + i).ravel(), (at[:, None] + j).ravel()
            fit = sizes_fit(size[a], size[b])
            pairs_a.append(key[a[fit]])
            pairs_b.append(key[b[fit]])
    small_pairs = _distinct(np.concatenate([*pairs_a, np.zeros(0, np.int64)]), np.concatenate([*pairs_b, np.zeros(0, np.int64)]))
    # a large group goes by its members, so equal groups are one; a hot one by its signature
    members = np.zeros(len(begin), U64)
    np.add.at(members, which, mix(key.view(U64)))
    name = np.where(heated, sig[begin].view(np.int64), members.view(np.int64)) if len(begin) else np.zeros(0, np.int64)
    large = (heated | (count > small))[which] if len(begin) else np.zeros(0, bool)
    return stars, small_pairs, _distinct(name[which[large]], key[large])


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    fresh = np.ones(len(a), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[fresh], b[fresh]


# Spark: from texts to documents, pairs and groups

DOC, STAR, PAIR, MEMBER, BLOB, HOT_BLOB = range(6)
ROW = "__row_hash"
FIELDS = "kind int, bucket int, doc_id {id}, a long, b long, n long, sketch binary, keys binary, sizes binary, counts binary, sigs binary"


def _batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    arrays = []
    for f in schema:
        c = columns.get(f.name)
        arrays.append(pa.nulls(n, f.type) if c is None else c.cast(f.type) if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _ints(x) -> np.ndarray:
    return np.ascontiguousarray(x)


def _rows(schema: pa.Schema, kind: int, pairs, buckets: int) -> Iterator[pa.RecordBatch]:
    a, b = pairs
    if len(a):
        bucket = (mix(a.view(U64)) % U64(buckets)).astype(np.int32)
        yield _batch(schema, kind=np.full(len(a), kind, np.int32), bucket=bucket, a=a, b=b)


def _flush(schema, sig, owner, keys, sizes, buckets: int, limits: Limits) -> Iterator[pa.RecordBatch]:
    """Signatures of one flush as a blob per bucket; frequent ones are combined first."""
    size, key = sizes[owner], keys[owner]
    order = np.argsort(sig, kind="stable")
    ordered = sig[order]
    begin = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    count = np.diff(np.append(begin, len(ordered)))
    hot = np.zeros(len(sig), bool)
    many = count > limits.hot
    kept = np.ones(len(sig), bool)
    if many.any():
        inside = np.zeros(len(sig), bool)
        inside[order] = np.repeat(many, count)
        picked = np.flatnonzero(inside)
        # named as the bucket side names it: bucket, then the low half
        names = _short(sig[picked], buckets)
        stars, _, members = group(names, key[picked], size[picked], np.ones(len(picked), bool), limits.small)
        yield from _rows(schema, STAR, stars, buckets)
        yield from _rows(schema, MEMBER, members, buckets)
        by = np.lexsort((key[picked], sig[picked]))
        first = np.ones(len(by), bool)
        first[1:] = sig[picked][by][1:] != sig[picked][by][:-1]
        kept[picked] = False
        kept[picked[by[first]]] = hot[picked[by[first]]] = True
    for kind, mask in ((BLOB, kept & ~hot), (HOT_BLOB, hot)):
        at = np.flatnonzero(mask)
        if len(at):
            yield _blobs(schema, kind, sig[at], owner[at], keys, sizes, buckets)


def _short(sig: np.ndarray, buckets: int) -> np.ndarray:
    return (((sig >> U64(32)) % U64(buckets)) << U64(32)) | (sig & U64(0xFFFFFFFF))


def _blobs(schema, kind, sig, owner, keys, sizes, buckets) -> pa.RecordBatch:
    short = _short(sig, buckets)
    bucket = (short >> U64(32)).astype(np.int32)
    order = np.lexsort((owner, bucket))
    bucket, owner, low = bucket[order], owner[order], (short[order] & U64(0xFFFFFFFF)).astype(np.uint32)
    run = np.flatnonzero(np.concatenate(([True], (bucket[1:] != bucket[:-1]) | (owner[1:] != owner[:-1]))))
    counts = np.diff(np.append(run, len(owner))).astype(np.uint32)
    edge = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    ends, run_edge = np.append(edge, len(bucket)), np.searchsorted(run, edge)
    run_ends = np.append(run_edge, len(run))
    run_keys, run_sizes = keys[owner[run]], sizes[owner[run]].astype(np.int64)
    cut = lambda x, e: [_ints(x[e[i] : e[i + 1]]).tobytes() for i in range(len(edge))]
    return _batch(
        schema,
        kind=np.full(len(edge), kind, np.int32),
        bucket=bucket[edge],
        keys=cut(run_keys, run_ends),
        sizes=cut(run_sizes, run_ends),
        counts=cut(counts, run_ends),
        sigs=cut(low, ends),
    )


def _sign(schema: pa.Schema, buckets: int, limits: Limits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        known: set[int] = set()
        held, held_n = [], 0

        def flush():
            sig, owner = (np.concatenate(x) for x in zip(*[h[:2] for h in held], strict=True))
            keys, sizes = (np.concatenate(x) for x in zip(*[h[2:] for h in held], strict=True))
            return _flush(schema, sig, owner, keys, sizes, buckets, limits)

        for batch in batches:
            chars = [x or 0 for x in pa.compute.utf8_length(batch["text"]).to_pylist()]
            begin = end = total = 0
            for c in [*chars, None]:
                if c is not None:
                    total += c
                    end += 1
                if end == begin or c is not None and total < CHUNK_CHARS:
                    continue
                part = batch.slice(begin, end - begin)
                begin, total = end, 0
                sets = [shingles(t, hashes) for t in part["text"].to_pylist()]
                keys = [class_key(x) if len(x) else None for x in sets]
                bucket = np.array([(k or 0) % buckets for k in keys], np.int32)
                yield _batch(
                    schema,
                    kind=np.full(len(sets), DOC, np.int32),
                    bucket=bucket,
                    doc_id=part["doc_id"],
                    a=keys,
                    b=part["row"] if "row" in part.schema.names else None,
                    n=np.array([len(x) for x in sets], np.int64),
                    sketch=[sketch(x) if len(x) else None for x in sets],
                )
                fresh = []
                for x, k in zip(sets, keys, strict=True):
                    if k is not None and k not in known:
                        known.add(k)
                        fresh.append((x, k))
                if len(known) > CACHED_WORDS:
                    known.clear()
                if not fresh:
                    continue
                sizes = np.array([len(x) for x, _ in fresh], np.int64)
                sig, owner = signatures(np.concatenate([x for x, _ in fresh]), sizes)
                held.append((sig, owner + sum(len(h[2]) for h in held), np.array([k for _, k in fresh], np.int64), sizes))
                held_n += len(sig)
                if held_n >= limits.flush:
                    yield from flush()
                    held, held_n = [], 0
        if held_n:
            yield from flush()

    return run


def _meet(schema: pa.Schema, limits: Limits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            kind = batch["kind"].to_numpy()
            packed = kind >= BLOB
            if not packed.all():
                yield batch.filter(pa.array(~packed))
            for i in np.flatnonzero(packed):
                read = lambda c, t, i=i: np.frombuffer(batch[c][int(i)].as_py(), t)
                counts = read("counts", np.uint32)
                sig = read("sigs", np.uint32).astype(U64) | (U64(batch["bucket"][int(i)].as_py()) << U64(32))
                key, size = np.repeat(read("keys", np.int64), counts), np.repeat(read("sizes", np.int64).astype(np.int32), counts)
                held.append((sig, key, size, np.full(len(sig), kind[i] == HOT_BLOB)))
        if held:
            stars, pairs, members = group(*(np.concatenate(x) for x in zip(*held, strict=True)), limits.small)
            for k, rows in ((STAR, stars), (PAIR, pairs), (MEMBER, members)):
                yield from _rows(schema, k, rows, 1 << 20)

    return run


def _signed(docs: DataFrame, limits: Limits) -> DataFrame:
    spark = docs.sparkSession
    buckets = shuffle_partitions(spark)
    narrow = docs.select("doc_id", "text", *(c for c in docs.columns if c == ROW)).withColumnRenamed(ROW, "row")
    fields = FIELDS.format(id=narrow.schema["doc_id"].dataType.simpleString())
    schema = _arrow(spark, fields)
    signed = narrow.mapInArrow(_sign(schema, buckets, limits), fields)
    met = signed.repartition(buckets, "bucket").mapInArrow(_meet(schema, limits), fields)
    return written(met.select("kind", "doc_id", "a", "b", "n", "sketch"), "partenum")


def _arrow(spark, fields: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], fields).schema)


# Spark: verification


def _sketched(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs ``a, b`` that their sketches allow."""

    @F.pandas_udf("boolean")
    def allowed(one: pd.Series, two: pd.Series, n_one: pd.Series, n_two: pd.Series) -> pd.Series:
        return pd.Series([may_link(*x) for x in zip(one, two, n_one, n_two, strict=True)], dtype=bool)

    side = lambda c: classes.select(F.col("key").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}"))
    met = pairs.join(side("a"), "a").join(side("b"), "b")
    return met.filter(allowed("sketch_a", "sketch_b", "n_a", "n_b")).select("a", "b", "n_a", "n_b")


def _linked(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose whole sets are similar enough."""
    pairs = written(_sketched(pairs.distinct(), classes), "pairs")
    needed = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    found = needed.join(classes, "key").select("key", F.col("min_row").alias("__row"))

    def sets(batches):
        hashes = WordHashes()
        for batch in batches:
            made = [shingles(t, hashes) for t in batch["text"].to_pylist()]
            hit = [k == class_key(x) for k, x in zip(batch["key"].to_pylist(), made, strict=True)]
            kept = [x for x, h in zip(made, hit, strict=True) if h]
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in kept]))).astype(np.int32)
            flat = np.concatenate([*kept, np.zeros(0, U64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch["key"].filter(pa.array(hit, pa.bool_())), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["key", "shingles"])

    texts = docs.select("doc_id", "text").join(found, F.col("doc_id").eqNullSafe(F.col("__row"))).select("key", "text")
    whole = written(texts.mapInArrow(sets, "key long, shingles array<long>").dropDuplicates(["key"]), "sets")
    side = lambda c: whole.select(F.col("key").alias(c), F.col("shingles").alias(f"set_{c}"))
    both = F.size(F.array_intersect("set_a", "set_b")).cast("long")
    enough = WHOLE * both >= PART * (F.col("n_a") + F.col("n_b") - both)
    return pairs.join(side("a"), "a").join(side("b"), "b").filter(enough).select("a", "b")


def _allowed_pairs(key, root, n, bits, at, lists, name: int, inner: bool) -> tuple[list[int], list[int]]:
    """Pairs of one block of a group, across roots, that sketches allow.

    Groups overlap, so a pair is given only where ``name`` is the least group that both have.
    """
    size = np.array([len(b) for b in bits])
    folded = {}
    for m in np.unique(size):
        folded[m] = np.zeros((len(size), m // 8), U64)
        for i in np.flatnonzero(size >= m):
            folded[m][i] = fold(np.frombuffer(bits[i], np.uint8), m).view(U64)
    one, two = [], []
    for x in range(len(key)):
        rest = np.arange(x + 1, len(key))
        rest = rest[(root[rest] != root[x]) & sizes_fit(n[rest], n[x]) & (inner | (at[rest] != at[x]))]
        shared = np.minimum(size[rest], size[x])
        for m in np.unique(shared):
            some = rest[shared == m]
            apart = np.bitwise_count(folded[m][some] ^ folded[m][x]).sum(axis=1)
            for y in some[apart <= most_different(n[some], n[x])]:
                if np.intersect1d(lists[x], lists[y])[0] == name:
                    one.append(min(key[x], key[y]))
                    two.append(max(key[x], key[y]))
    return one, two


def _across(groups: DataFrame, classes: DataFrame, block: int) -> DataFrame:
    """Sketch-allowed pairs ``a, b`` of different components in large groups, by blocks, each once.

    ``groups`` has ``g, key, root``; only groups with two or more components are given. A set's
    list of groups is no longer than its list of signatures.
    """
    sizes = groups.groupBy("g").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    lists = groups.groupBy("key").agg(F.sort_array(F.collect_list("g")).alias("lists"))
    rows = groups.join(sizes, "g").join(classes.select("key", "n", "sketch").join(lists, "key"), "key")
    mine = rows.withColumn("at", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    mine = mine.select("g", F.least("at", "other").alias("i"), F.greatest("at", "other").alias("j"), "at", "key", "root", "n", "sketch", "lists")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        columns = (pdf[c].to_numpy() for c in ("key", "root", "n", "sketch", "at", "lists"))
        a, b = _allowed_pairs(*columns, pdf["g"].iat[0], pdf["i"].iat[0] == pdf["j"].iat[0])
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    return mine.groupBy("g", "i", "j").applyInPandas(compare, "a long, b long")


def _rooted(docs: DataFrame, limits: Limits) -> tuple[DataFrame, DataFrame]:
    """``doc_id, key, n, row`` of every row, and ``key, min_row, root`` of every class.

    ``row`` is the column ``ROW`` of ``docs``, if there is one.
    """
    signed = _signed(docs, limits)
    rows = signed.filter(F.col("kind") == DOC).select("doc_id", F.col("a").alias("key"), "n", "sketch", F.col("b").alias("row"))
    classes = written(
        rows.filter("key is not null").groupBy("key").agg(F.min("doc_id").alias("min_row"), F.first("n").alias("n"), F.first("sketch").alias("sketch")),
        "classes",
    )
    pick = lambda k: signed.filter(F.col("kind") == k).select("a", "b")
    links = written(_linked(pick(STAR), classes, docs), "links")
    edges = lambda df: df.select(F.col("a").alias("u"), F.col("b").alias("v"))
    roots = components(edges(links))

    rooted = lambda df, c: df.join(roots.select(F.col("u").alias(c), F.col("root").alias(f"root_{c}")), c, "left").withColumn(f"root_{c}", F.coalesce(f"root_{c}", c))
    split = rooted(rooted(pick(PAIR).distinct(), "a"), "b").filter("root_a <> root_b").select("a", "b")
    members = rooted(pick(MEMBER).distinct().select(F.col("a").alias("g"), F.col("b").alias("key")), "key").withColumnRenamed("root_key", "root")
    members = written(members, "members")
    mixed = members.groupBy("g").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("g")
    more = written(split.unionByName(_across(members.join(mixed, "g"), classes, limits.block)).distinct(), "split")
    if not more.isEmpty():
        late = written(_linked(more, classes, docs), "links")
        roots = components(edges(links.unionByName(late)))

    least = classes.join(roots, classes["key"] == roots["u"], "left").select("key", "min_row", F.coalesce("root", "key").alias("root"))
    return rows.drop("sketch"), least


def join_documents(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row: components over all links."""
    rows, least = _rooted(docs.select("doc_id", "text"), limits)
    names = least.groupBy("root").agg(F.min("min_row").alias("component_id"))
    of_class = least.join(names, "root").select(F.col("key").alias("__key"), "component_id")
    placed = rows.join(of_class, F.col("key") == F.col("__key"), "left")
    return placed.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def drop_copies(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``docs`` with one row of each component: that with its least id, rows without id last.

    Of rows with that id one stays, the same in every run. Rows without words link with nothing: one of each id
    stays, and all that have no id.
    """
    plain = [f.name for f in docs.schema if f.dataType.typeName() != "map"]
    marked = docs.withColumn(ROW, F.xxhash64(*plain))
    worded = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    rows, roots = _rooted(marked.filter(worded), limits)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    of_root = rows.join(roots.select("key", "root"), "key").groupBy("root").agg(F.min(order).alias("lead"))
    leads = of_root.select(F.col("lead.id").alias("__id"), F.col("lead.row").alias("__row"))
    named = marked.filter(worded).join(leads, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col(ROW) == F.col("__row")), "left_semi")
    wordless = marked.filter(~worded)
    firsts = wordless.filter("doc_id is not null").groupBy("doc_id").agg(F.min(ROW).alias("__row")).withColumnRenamed("doc_id", "__id")
    empty = wordless.join(firsts, (F.col("doc_id") == F.col("__id")) & (F.col(ROW) == F.col("__row")), "left_semi")
    # rows of one id and one hash are equal
    kept = named.dropDuplicates(["doc_id", ROW]).unionByName(empty.dropDuplicates(["doc_id", ROW]))
    return kept.select(docs.columns).unionByName(docs.filter(~worded & F.col("doc_id").isNull()))
