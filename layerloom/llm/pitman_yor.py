"""LM scoring with a hierarchical Pitman-Yor model, seated by Gibbs sampling.

Tokens are words and one end per text. Each context (the token before, by its whole 64-bit hash) is a restaurant
whose customers are training tokens and whose tables are customers of the one parent restaurant, over a uniform base
of all known tokens and one unknown. No number of words or contexts is fixed.

Texts are tokenised once, into blocks: the hashes of a block's distinct words, and its tokens as places among them. Pairs of word and
context are made from a block where they are needed. For their totals a block sends the hashes of its distinct pairs, packed
by slice of the hash range, to the task of that slice, which sums them and answers each block; one block owns each pair. A pair
with one customer has one table and needs no seating, so only its share in the restaurants is kept, in the ``lexicon``: one row for each
word or context with what it has as a word (occurrences, customers and tables in the parent) and as a context (customers, tables). Pairs
with more customers are the ``state``, a distributed table.

A sweep joins the state to the lexicon and resamples the number of tables of each pair from its conditional distribution
given all others (generalised Stirling numbers up to ``EXACT`` customers; beyond that, customers are seated one by
one, then in growing groups, by approximate conditionals: measured at 300 and 1,000 customers, the mean number of tables is within 5 % of
the exact one for parent probabilities up to 0.02 and discounts up to 0.8, and up to a third too high at 0.3), then those of the parent. All pairs of a sweep see the totals of the sweep before: that
is not a sequential Gibbs sampler, which would update totals after each pair. Each seating is written, so it is drawn once, and the
one before is removed. Seatings after burn-in are averaged in the predictive probabilities: a block asks for the tables of its pairs
with more customers and for the lexicon rows of its words, again by slices, and adds up its own texts.

A pair or word that every text has is one key per ``BLOCK_TOKENS`` tokens in these exchanges. Slices hold about ``SLICE_TOKENS`` tokens'
pairs, whatever the input. Discounts are estimated from counts of counts of all training tokens. Only sums over all rows reach the driver.

Defined cases: null text counts as empty: its end alone is scored; a row without id hashes as an empty id; repeated
rows train and are scored each; without training rows every probability is 1; empty tables give no rows; extra columns are ignored
and cannot clash, as two are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.session import scratch_path

HELD_OUT, MODULUS = 2, 7
SWEEPS, BURN_IN = 3, 1
STRENGTH = 1.0
EXACT = 1000
BLOCK_TOKENS = 750_000
SLICE_TOKENS = 1_500_000
ROWS = 50_000
TEXTS = 1_000
CELLS = 200_000
SEED = 7
END = xxhash.xxh64_intdigest(b"")
START_CONTEXT = 0  # sorts before all hashes
U64 = np.uint64


class TokenHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def batch_hashes(texts: pa.Array) -> list[np.ndarray]:
    """Hashes of the tokens of each text, A-Z in lower case, the end last. Every distinct spelling of the texts is hashed once."""
    # the bytes start anew, and A-Z are lowered in the distinct words: Arrow's own lowering takes other bytes where texts are a slice
    lists = pc.ascii_split_whitespace(pc.fill_null(pa.concat_arrays([texts.slice(0, 0), texts]).cast(pa.large_string()), ""))
    parts = lists.flatten().dictionary_encode()
    _, cuts, data = parts.dictionary.buffers()
    at, data = np.frombuffer(cuts, np.int64, len(parts.dictionary) + 1).tolist() if cuts else [0], data.to_pybytes().lower() if data else b""
    known = np.fromiter((xxhash.xxh64_intdigest(data[i:j]) for i, j in zip(at, at[1:], strict=False)), U64, len(parts.dictionary))
    places = parts.indices.to_numpy()
    sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
    words = (np.diff(at) > 0)[places]  # white space at an end of a text gives an empty part there, which is no word
    if not words.all():
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[words], minlength=len(sizes))
        places = places[words]
    ends = np.cumsum(sizes + 1)
    out = np.full(len(places) + len(sizes), END, U64)
    inner = np.ones(len(out), bool)
    inner[ends - 1] = False
    out[inner] = known[places]
    return [out[i:j] for i, j in zip([0, *ends.tolist()], ends.tolist(), strict=False)]


def token_hashes(text: str | None, hashes: TokenHashes) -> np.ndarray:
    """``batch_hashes`` of one text, word by word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    out = np.empty(len(words) + 1, U64)
    out[:-1] = np.fromiter(map(hashes.__getitem__, words), U64, len(words))
    out[-1] = END
    return out


# Sampling


@lru_cache(maxsize=4)
def log_stirling(discount: float, largest: int = EXACT) -> np.ndarray:
    """Logs of generalised Stirling numbers: row c, column t."""
    s = np.full((largest + 1, largest + 1), -np.inf)
    s[0, 0] = 0.0
    for c in range(largest):
        t = np.arange(1, c + 2)
        stay = c - discount * t
        with np.errstate(divide="ignore", invalid="ignore"):
            s[c + 1, 1 : c + 2] = np.logaddexp(s[c, t - 1], np.where(stay > 0, np.log(np.maximum(stay, 1e-300)) + s[c, t], -np.inf))
    return s


class Draws:
    """Random numbers of rows: those of a row follow from its key and the sweep, whatever batch it is in."""

    def __init__(self, keys: np.ndarray, at: int):
        self.keys = keys ^ U64(xxhash.xxh64_intdigest(f"{SEED}:{at}"))
        self.rng = np.random.default_rng((SEED, at, int(np.bitwise_xor.reduce(keys)) if len(keys) else 0))  # of batches

    def gumbel(self, rows: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The ``j``-th number (from 0) of each row."""
        with np.errstate(over="ignore"):
            z = self.keys[rows] + (j + 1).astype(U64) * U64(0x9E3779B97F4A7C15)
            z = (z ^ z >> U64(30)) * U64(0xBF58476D1CE4E5B9)
            z = (z ^ z >> U64(27)) * U64(0x94D049BB133111EB)
        return -np.log(-np.log(((z ^ z >> U64(31)) >> U64(11)).astype(float) * 2.0**-53 + 2.0**-54))


def sample_tables(count, others, base, discount: float, strength: float, stirling, draws: Draws) -> np.ndarray:
    """Tables of each dish given its customers, the restaurant's other tables, and the base probability of a table.

    ``base`` is a probability for each dish, or ``f(places, j)`` for the table after ``j`` tables of its own.
    """
    chance = base if callable(base) else lambda at, j: base[at]
    tables = np.minimum(count, 1).astype(np.int64)
    some = np.flatnonzero((count > 1) & (count <= EXACT))
    cells = np.cumsum(count[some])
    # numbers of tables of all dishes stand in one row of cells, dish by dish
    for part in np.split(some, np.searchsorted(cells, np.arange(CELLS, cells[-1], CELLS)) if len(some) else []):
        size = count[part].astype(np.int64)
        begin = np.cumsum(size) - size
        at = np.repeat(part, size)
        j = np.arange(len(at)) - np.repeat(begin, size)
        steps = np.log((strength + discount * (others[at] + j)) * chance(at, j))
        so_far = np.cumsum(steps)
        weight = so_far - np.repeat(so_far[begin] - steps[begin], size) + stirling[np.repeat(size, size), j + 1] + draws.gumbel(at, j)
        best = np.flatnonzero(weight == np.repeat(np.maximum.reduceat(weight, begin), size)) if len(at) else begin
        tables[at[best]] = j[best] + 1
    many = np.flatnonzero(count > EXACT)
    seated = 1
    while len(many):
        group = np.minimum(max(1, seated // 16), count[many] - seated)
        open_ = chance(many, tables[many])
        # a table that is opened early lowers the weight of all customers after it: by about this power
        ahead = (seated / count[many]) ** (discount * (1 - open_))
        fresh = (strength + discount * (others[many] + tables[many])) * open_ * ahead
        share = fresh / (fresh + seated - discount * tables[many])
        tables[many] += draws.rng.binomial(group, share)
        seated += max(1, seated // 16)
        many = many[count[many] > seated]
    return tables


def parent_of(customers, top, everyone: float, top_tables: int, known: int, discount: float):
    """The parent's predictive probability of words with these customers and tables."""
    new = (STRENGTH + discount * top_tables) / (known + 1)
    return (customers - discount * top + new) / (STRENGTH + everyone)


def own_parent(tables, customers, top, sums: Sums):
    """``f(places, j)``: the parent's probability of a word for a pair's next table, without the pair's tables but with ``j`` of them."""
    high = sums.discounts[1]
    new = (STRENGTH + high * sums.top_tables) / (sums.known + 1)
    rest = customers - tables

    def chance(at, j):
        served = rest[at] + j
        return (served - high * np.minimum(top[at], served) + new) / (STRENGTH + sums.tables - tables[at] + j)

    return chance


# Packed texts


def packed_numbers(x: np.ndarray) -> bytes:
    """Whole numbers in the least width that holds them, byte by byte (all lowest bytes first), compressed.

    Width and size stand before them.
    """
    width = next(w for w in (1, 2, 4, 8) if w == 8 or not len(x) or x.max() < 1 << 8 * w)
    planes = np.ascontiguousarray(x.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T).tobytes()
    return bytes([width]) + len(x).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def numbers(data: bytes) -> np.ndarray:
    width, size = data[0], int.from_bytes(data[1:9], "little")
    planes = pa.decompress(data[9:], decompressed_size=width * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, size).T).view(f"<u{width}").reshape(-1).astype(np.int64)


def packed_hashes(ordered: np.ndarray) -> bytes:
    """Sorted hashes as packed differences, whose upper bytes are mostly 0."""
    return packed_numbers(np.diff(ordered, prepend=U64(0)))


def hashes(data: bytes) -> np.ndarray:
    return np.cumsum(numbers(data).view(U64), dtype=U64)


def pair_hash(word: np.ndarray, context: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = word * U64(0x9E3779B97F4A7C15) ^ (context << U64(31) | context >> U64(33)) * U64(0xC2B2AE3D27D4EB4F)
        h = (h ^ h >> U64(29)) * U64(0x165667B19E3779F9)
        return h ^ h >> U64(32)


def sorted_order(h: np.ndarray) -> np.ndarray:
    """The stable order of hashes, by one plain sort of their upper bits with their places in the lower ones.

    Where the upper bits do not tell hashes apart, their own order is taken.
    """
    bits = U64(len(h).bit_length())
    places = (U64(1) << bits) - U64(1)
    order = (np.sort((h & ~places) | np.arange(len(h), dtype=U64)) & places).astype(np.int64)
    found = h[order]
    return order if (found[1:] >= found[:-1]).all() else np.argsort(h, kind="stable")


def distinct(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted numbers: where each distinct one begins, and the number of each entry among them."""
    first = np.ones(len(ordered), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    return np.flatnonzero(first), np.cumsum(first) - 1


def slice_of(h: np.ndarray, slices: int) -> np.ndarray:
    """Equal ranges of hashes, numbered in their order."""
    return ((h >> U64(32)) * U64(slices) >> U64(32)).astype(np.int64)


def _slices(h: np.ndarray, slices: int) -> Iterator[tuple[int, int, int]]:
    """``slice, begin, end`` of sorted hashes."""
    found, begin = np.unique(slice_of(h, slices), return_index=True)
    if len(h):
        yield from zip(found.tolist(), begin.tolist(), [*begin[1:].tolist(), len(h)], strict=True)


def pack_block(tokens: list[np.ndarray], flags: list[int]) -> dict[str, bytes]:
    """``a`` sorted hashes of distinct words as packed differences, ``b`` tokens as places among them, ``c`` tokens per text, ``d`` held out or not."""
    found = pa.array(np.concatenate([np.array([START_CONTEXT], U64), *tokens])).dictionary_encode()
    words = found.dictionary.to_numpy()
    order = sorted_order(words)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    words, place = words[order], rank[found.indices.to_numpy()]
    sizes = np.array([len(t) for t in tokens])
    return {"a": packed_hashes(words), "b": packed_numbers(place[1:]), "c": packed_numbers(sizes), "d": packed_numbers(np.array(flags))}


class Block:
    """The pairs of a packed block, sorted by hash: places of word and context, training tokens; and the pair of each token."""

    def __init__(self, a: bytes, b: bytes, c: bytes, d: bytes):
        self.words, place, self.sizes, self.held = hashes(a), numbers(b), numbers(c), numbers(d)
        before = np.concatenate(([0], place[:-1]))
        before[np.cumsum(self.sizes) - self.sizes] = 0  # the start, whose hash is least
        bits = len(self.words).bit_length()
        pairs = place << bits | before
        by_pair = sorted_order(pairs.astype(U64) << U64(64 - 2 * bits))
        first, number = distinct(pairs[by_pair])
        pair = pairs[by_pair[first]]
        word, context = pair >> bits, pair & (1 << bits) - 1
        hashed = pair_hash(self.words[word], self.words[context])
        order = sorted_order(hashed)
        self.hash, self.word, self.context = hashed[order], word[order], context[order]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.pair = np.empty(len(place), np.int64)
        self.pair[by_pair] = rank[number]

    def train(self) -> np.ndarray:
        return np.bincount(self.pair, np.repeat(1 - self.held, self.sizes), len(self.hash)).astype(np.int64)


PARTS = "block long, part int, slice long, a binary, b binary, c binary, d binary, e binary"
PACKED, TOTALS, LEXICON, TABLES = range(4)


def _schema(spark: SparkSession, fields: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], fields).schema)


def _rows(schema: pa.Schema, rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in schema], schema=schema)


def _packer(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        tokens, flags, ids, total = [], [], [], 0
        for batch in batches:
            texts = (found for i in range(0, len(batch), TEXTS) for found in batch_hashes(batch["text"].slice(i, TEXTS)))
            for doc_id, found, flag in zip(batch["doc_id"].to_pylist(), texts, batch["held"].to_pylist(), strict=True):
                tokens.append(found)
                ids.append(doc_id)
                flags.append(int(flag))
                total += len(tokens[-1])
                if total >= BLOCK_TOKENS:
                    yield _rows(schema, [{"block": block, "part": PACKED, "doc_ids": ids, "n": total} | pack_block(tokens, flags)])
                    tokens, flags, ids, total = [], [], [], 0
                    block += 1
        if tokens:
            yield _rows(schema, [{"block": block, "part": PACKED, "doc_ids": ids, "n": total} | pack_block(tokens, flags)])

    return run


class Store:
    """Tables of one run in the shared scratch folder. A shuffle that a table came from goes as soon as the table is written."""

    CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def write(self, df: DataFrame, name: str, by: tuple[str, ...] = ()) -> str:
        path, kept = scratch_path(self.spark, name), self.spark.conf.get(self.CLEANUP, "false")
        self.spark.conf.set(self.CLEANUP, "true")
        try:
            df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
        finally:
            self.spark.conf.set(self.CLEANUP, kept)
        return path

    def read(self, path: str, fields: str) -> DataFrame:
        return self.spark.read.schema(fields).parquet(path)

    def drop(self, path: str) -> None:
        handle = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        handle.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(handle, True)


# Exchanges of blocks with slices

ASKED = "slice long, block long, keys binary, counts binary"


def ask(packed: DataFrame, slices: int, kind: str) -> DataFrame:
    """``slice, block, keys, counts`` of every block: its ``pairs`` with their training tokens, its ``words``, or keys given in ``a``."""
    schema = _schema(packed.sparkSession, ASKED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = None
                if kind == "pairs":
                    block = Block(row["a"], row["b"], row["c"], row["d"])
                    keys, counts = block.hash, block.train()
                else:
                    keys = hashes(row["a"])
                rows = [
                    {"slice": s, "block": row["block"], "keys": keys[i:j].tobytes(), "counts": None if counts is None else packed_numbers(counts[i:j])}
                    for s, i, j in _slices(keys, slices)
                ]
                for i in range(0, len(rows), 256):
                    yield _rows(schema, rows[i : i + 256])

    columns = ["block", "a", "b", "c", "d"] if kind == "pairs" else ["block", "a"]
    return packed.select(columns).mapInArrow(run, ASKED)


def _keys(table: pa.Table) -> tuple[list[dict], np.ndarray, list[int]]:
    rows = sorted(table.to_pylist(), key=lambda r: r["block"])
    sizes = [len(r["keys"]) // 8 for r in rows]
    return rows, np.frombuffer(b"".join(r["keys"] for r in rows), U64), np.cumsum([0, *sizes]).tolist()


def pair_totals(asked: DataFrame) -> DataFrame:
    """Answers by slice: ``a`` the training tokens of each pair in all blocks, ``b`` whether the asking block owns it."""
    schema = _schema(asked.sparkSession, PARTS)

    def total(table: pa.Table) -> pa.Table:
        rows, keys, cuts = _keys(table)
        order = sorted_order(keys)  # stable: the first entry of a pair is that of the least block
        first, number = distinct(keys[order])
        sums, own = np.empty(len(keys), np.int64), np.zeros(len(keys), bool)
        sums[order] = np.bincount(number, np.concatenate([numbers(r["counts"]) for r in rows])[order])[number].astype(np.int64)
        own[order[first]] = True
        out = [
            {"block": r["block"], "part": TOTALS, "slice": r["slice"], "a": packed_numbers(sums[i:j]), "b": np.packbits(own[i:j]).tobytes()}
            for r, i, j in zip(rows, cuts, cuts[1:], strict=False)
        ]
        return pa.Table.from_batches([_rows(schema, out)])

    return asked.groupBy("slice").applyInArrow(total, PARTS)


def look_up(asked: DataFrame, table: DataFrame, part: int, columns: list[str]) -> DataFrame:
    """Answers by slice: ``columns`` of the rows of ``table(slice, h, ...)`` with the asked keys as packed numbers, 0 where there is none."""
    schema = _schema(asked.sparkSession, PARTS)

    def find(wanted: pa.Table, known: pa.Table) -> pa.Table:
        rows, keys, cuts = _keys(wanted)
        h = known["h"].to_numpy().view(U64)
        order = sorted_order(h)
        h = h[order]
        at = np.minimum(np.searchsorted(h, keys), max(len(h) - 1, 0))
        hit = h[at] == keys if len(h) else np.zeros(len(keys), bool)
        values = [np.where(hit, known[c].to_numpy()[order][at], 0) if len(h) else np.zeros(len(keys), np.int64) for c in columns]
        out = []
        for r, i, j in zip(rows, cuts, cuts[1:], strict=False):
            out.append({"block": r["block"], "part": part, "slice": r["slice"], "a": b"".join(map(_framed, (v[i:j] for v in values)))})
        return pa.Table.from_batches([_rows(schema, out)])

    return asked.groupBy("slice").cogroup(table.groupBy("slice")).applyInArrow(find, PARTS)


def _framed(x: np.ndarray) -> bytes:
    data = packed_numbers(x)
    return len(data).to_bytes(8, "little") + data


def _unframed(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        size = int.from_bytes(data[at : at + 8], "little")
        out.append(numbers(data[at + 8 : at + 8 + size]))
        at += 8 + size
    return out


def _answers(rows: Iterable[dict], part: int) -> list[dict]:
    return sorted((r for r in rows if r["part"] == part), key=lambda r: r["slice"])


# Seating

FACTS = "kind string, block long, a binary, b binary, c binary, d binary, e binary"
STATE = "word long, context long, count long, tables long, kept long"
WORDS = "h long, n long, dish1 long, guests long, laid1 long, dish long, laid long, top long"


def block_facts(packed: DataFrame, totals: DataFrame) -> DataFrame:
    """What each block contributes. ``state``: its own pairs with several customers; ``lexicon``: the shares of its own pairs in their words and
    contexts; ``asks``: all its pairs with several customers; ``totals`` of all its pairs."""
    schema = _schema(packed.sparkSession, FACTS)

    def facts(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        (row,) = _answers(rows, PACKED)
        block, answers = Block(row["a"], row["b"], row["c"], row["d"]), _answers(rows, TOTALS)
        total = np.concatenate([numbers(r["a"]) for r in answers])
        own = np.concatenate([np.unpackbits(np.frombuffer(r["b"], np.uint8), count=len(numbers(r["a"]))) for r in answers]).astype(bool)
        several, words = total > 1, len(block.words)
        mine = own & several
        share = lambda place, value: np.bincount(place, value, words).astype(np.int64)
        counted, single = np.where(own, total, 0), (own & (total == 1)).astype(np.int64)
        columns = share(block.word, counted), share(block.word, single), share(block.context, counted), share(block.context, single)
        used = np.flatnonzero(columns[0] + columns[2])
        out = [
            {"kind": "state", "a": block.words[block.word[mine]].tobytes(), "b": block.words[block.context[mine]].tobytes(), "c": packed_numbers(total[mine])},
            {"kind": "lexicon", "a": block.words[used].tobytes()} | {k: packed_numbers(c[used]) for k, c in zip("bcde", columns, strict=True)},
            {"kind": "asks", "a": packed_hashes(block.hash[several])},
            {"kind": "totals", "a": packed_numbers(total)},
        ]
        return pa.Table.from_batches([_rows(schema, [r | {"block": row["block"]} for r in out])])

    both = packed.select("block", "part", F.lit(None).cast("long").alias("slice"), "a", "b", "c", "d")
    return both.unionByName(totals.select(both.columns)).groupBy("block").applyInArrow(facts, FACTS)


def _unpacked(facts: DataFrame, hashes: list[str], counts: list[str], names: list[str]) -> DataFrame:
    """One row for each entry of the packed columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                columns = [np.frombuffer(row[c], np.int64) for c in hashes] + [numbers(row[c]) for c in counts]
                for i in range(0, len(columns[0]), ROWS):
                    yield pa.RecordBatch.from_arrays([pa.array(c[i : i + ROWS]) for c in columns], names=names)

    return facts.select(*hashes, *counts).mapInArrow(run, ", ".join(f"{n} long" for n in names))


@dataclass(frozen=True)
class Sums:
    """What the driver knows: sums over all rows, and discounts."""

    tokens: int
    known: int
    discounts: tuple[float, float]
    tables: int
    top_tables: int


def _discount(once: int, twice: int) -> float:
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once + twice else 0.5


def _replaced(batch: pa.RecordBatch, names: list[str], **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[c]) if c in columns else batch[c] for c in names], names=names)


def seat_pairs(state: DataFrame, lexicon: DataFrame, sums: Sums, at: int, keep: bool) -> DataFrame:
    """The state with the next seating of each pair, added to ``kept`` if it counts."""
    low = sums.discounts[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stirling = log_stirling(low)
        for batch in batches:
            if not len(batch):
                continue
            word, context, count, tables, kept, dish, top, laid = (
                batch[c].to_numpy(zero_copy_only=False) for c in ("word", "context", "count", "tables", "kept", "dish", "top", "laid")
            )
            draws = Draws(pair_hash(word.view(U64), context.view(U64)), at)
            parent = own_parent(tables, dish, top, sums)
            tables = sample_tables(count, np.maximum(laid - tables, 0), parent, low, STRENGTH, stirling, draws)
            yield _replaced(batch, ["word", "context", "count", "tables", "kept"], tables=tables, kept=kept + keep * tables)

    words = lexicon.select(F.col("h").alias("word"), "dish", "top")
    met = state.join(words, "word").join(lexicon.select(F.col("h").alias("context"), "laid"), "context")
    return met.mapInArrow(run, STATE)


def seat_words(state: DataFrame, lexicon: DataFrame, sums: Sums | None, at: int) -> DataFrame:
    """The lexicon with the tables that the state has now, and the parent's next seating of them (none without ``sums``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stirling = log_stirling(sums.discounts[1])
        for batch in batches:
            if not len(batch):
                continue
            h, dish, top = (batch[c].to_numpy(zero_copy_only=False) for c in ("h", "dish", "top"))
            flat = np.full(len(top), 1.0 / (sums.known + 1))
            top = sample_tables(dish, np.maximum(sums.top_tables - top, 0), flat, sums.discounts[1], STRENGTH, stirling, Draws(h.view(U64), at))
            yield _replaced(batch, batch.schema.names, top=top)

    zero = F.lit(0).cast("long")
    of_word, of_context = state.select(F.col("word").alias("h"), F.col("tables").alias("d"), zero.alias("l")), state.select(F.col("context").alias("h"), zero.alias("d"), F.col("tables").alias("l"))
    now = of_word.unionByName(of_context).groupBy("h").agg(F.sum("d").alias("d"), F.sum("l").alias("l"))
    met = lexicon.join(now, "h", "left").withColumns({"dish": F.col("dish1") + F.coalesce("d", zero), "laid": F.col("laid1") + F.coalesce("l", zero)})
    met = met.select(lexicon.columns)
    if sums is None:
        return met
    return met.mapInArrow(run, lexicon.schema)


def kept_columns(k: int) -> list[str]:
    return [f"{c}_{k}" for c in ("dish", "laid", "top")]


def facts_of(store: Store, facts: str, kind: str) -> DataFrame:
    return store.read(facts, FACTS).filter(F.col("kind") == kind).drop("kind")


def seatings(store: Store, facts: str, sweeps: int, burn_in: int) -> tuple[str, str, list[Sums]]:
    """Paths of state and lexicon after all sweeps, and the sums of the seatings that count (``dish_k, laid_k, top_k`` of the lexicon)."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    rows = _unpacked(facts_of(store, facts, "state"), ["a", "b"], ["c"], ["word", "context", "count"])
    state = store.write(rows.select("*", F.lit(1).cast("long").alias("tables"), F.lit(1 if burn_in < 0 else 0).cast("long").alias("kept")), "state")
    parts = _unpacked(facts_of(store, facts, "lexicon"), ["a"], list("bcde"), ["h", "n", "dish1", "guests", "laid1"])
    base = parts.groupBy("h").agg(*[F.sum(c).alias(c) for c in ("n", "dish1", "guests", "laid1")])
    base = base.select("*", F.lit(0).cast("long").alias("dish"), F.lit(0).cast("long").alias("laid"), (F.col("n") > 0).cast("long").alias("top"))
    words = WORDS

    def read() -> tuple[DataFrame, DataFrame]:
        return store.read(state, STATE), store.read(lexicon, words)

    def kept(df: DataFrame, k: int) -> DataFrame:
        return df.select("*", *[F.col(c.split("_")[0]).alias(c) for c in kept_columns(k)])

    found: list[Sums] = []
    start = seat_words(store.read(state, STATE), base, None, 0)
    if burn_in < 0:
        start, words = kept(start, 0), words + "".join(f", {c} long" for c in kept_columns(0))
    lexicon = store.write(start, "lexicon")
    for kind in ("state", "lexicon"):
        store.drop(f"{facts}/kind={kind}")
    s, w = read()
    number = lambda c, k: F.coalesce(F.sum((F.col(c) == k).cast("long")), F.lit(0))
    tokens, known, once, tables, top_tables, *few = w.agg(
        total("n"), total("top"), total("dish1"), total("dish"), total("top"), number("dish", 1), number("dish", 2)
    ).head()
    twice = s.agg(number("count", 2)).head()[0]
    sums = Sums(tokens, known, (_discount(once, twice), _discount(*few)), tables, top_tables)
    if burn_in < 0:
        found.append(sums)
    for at in range(sweeps):
        counts = at + 1 > burn_in
        old = state, lexicon
        s, w = read()
        state = store.write(seat_pairs(s, w, sums, at, counts), "state")
        after = seat_words(store.read(state, STATE), w, sums, at)
        if counts:
            after, words = kept(after, at + 1), words + "".join(f", {c} long" for c in kept_columns(at + 1))
        lexicon = store.write(after, "lexicon")
        for path in old:
            store.drop(path)
        tables, top_tables = read()[1].agg(total("dish"), total("top")).head()
        sums = Sums(tokens, known, sums.discounts, tables, top_tables)
        if counts:
            found.append(sums)
    return state, lexicon, found


# Scoring


def score_documents(docs: DataFrame, sweeps: int = SWEEPS, burn_in: int = BURN_IN, slices: int | None = None) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity`` of every row.

    ``slices`` of the hash range, by default one for each ``SLICE_TOKENS`` tokens.
    """
    spark = docs.sparkSession
    store = Store(spark)
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    narrow = docs.select("doc_id", "text", (crc % MODULUS == HELD_OUT).alias("held"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    fields = f"block long, part int, n long, doc_ids array<{kind}>, a binary, b binary, c binary, d binary"
    packed = store.read(store.write(narrow.mapInArrow(_packer(_schema(spark, fields)), fields), "packed"), fields)
    slices = slices or 1 + (packed.agg(F.sum("n")).head()[0] or 0) // SLICE_TOKENS

    totals = store.write(pair_totals(ask(packed, slices, "pairs")), "totals")
    facts = store.write(block_facts(packed, store.read(totals, PARTS)), "facts", ("kind",))
    store.drop(totals)
    totals = facts_of(store, facts, "totals")
    state, lexicon, found = seatings(store, facts, sweeps, burn_in)
    first = burn_in + 1
    kept = [c for k in range(first, sweeps + 1) for c in kept_columns(k)]
    of_words = store.read(lexicon, WORDS + "".join(f", {c} long" for c in kept))
    slice_number = lambda h: F.shiftrightunsigned(F.shiftrightunsigned(h, 32) * slices, 32)
    names = ["n", "guests", *kept]
    lexicon_rows = of_words.select(slice_number(F.col("h")).alias("slice"), "h", *names)
    answers = store.write(look_up(ask(packed, slices, "words"), lexicon_rows, LEXICON, names), "words")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = pair_hash(*(batch[c].to_numpy().view(U64) for c in ("word", "context")))
            yield pa.RecordBatch.from_arrays([pa.array(slice_of(h, slices)), pa.array(h.view(np.int64)), batch["kept"]], names=["slice", "h", "kept"])

    pairs = store.read(state, STATE).mapInArrow(hashed, "slice long, h long, kept long")
    tables = store.write(look_up(ask(facts_of(store, facts, "asks"), slices, "given"), pairs, TABLES, ["kept"]), "tables")
    for path in (state, lexicon, f"{facts}/kind=asks"):
        store.drop(path)

    def add_up(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        (row,), (known,) = _answers(rows, PACKED), _answers(rows, TOTALS)
        block, total = Block(row["a"], row["b"], row["c"], row["d"]), numbers(known["a"])
        looked = [_unframed(r["a"]) for r in _answers(rows, LEXICON)]
        n, guests, *seated = (np.concatenate(x) for x in zip(*looked, strict=True))
        laid_tables = len(found) * np.minimum(total, 1)
        if several := _answers(rows, TABLES):
            laid_tables[total > 1] = np.concatenate([_unframed(r["a"])[0] for r in several])
        low, high = found[0].discounts
        p = len(found) * total - low * laid_tables
        for sums, dish, laid, top in zip(found, seated[::3], seated[1::3], seated[2::3], strict=True):
            parent = parent_of(dish, top, sums.tables, sums.top_tables, sums.known, high)
            p = p + (STRENGTH + low * laid[block.context]) * parent[block.word]
        log = np.log10(p / (len(found) * (STRENGTH + guests[block.context])))
        base = np.log10((n + 1) / (found[0].tokens + found[0].known + 1))
        owner = np.repeat(np.arange(len(block.sizes)), block.sizes)
        add = lambda x: np.bincount(owner, x[block.pair], len(block.sizes))
        out = [
            pa.array(row["doc_ids"], table.schema.field("doc_ids").type.value_type),
            block.held.astype(bool),
            block.sizes,
            add((n > 0).astype(float)[block.word]).astype(np.int64),
            np.full(len(block.sizes), found[0].tokens),
            add(base[block.word]),
            add(log),
        ]
        names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        return pa.table([x if isinstance(x, pa.Array) else pa.array(x) for x in out], names=names)

    nothing = lambda *names: [F.lit(None).cast(t).alias(c) for c, t in names]
    ids = ("doc_ids", f"array<{kind}>")
    texts = packed.select("block", "part", *nothing(("slice", "long")), "doc_ids", "a", "b", "c", "d")
    others = [
        totals.select("block", F.lit(TOTALS).alias("part"), *nothing(("slice", "long"), ids), "a", *nothing(*((c, "binary") for c in "bcd"))),
        *(store.read(path, PARTS).select("block", "part", "slice", *nothing(ids), "a", "b", "c", "d") for path in (answers, tables)),
    ]
    for other in others:
        texts = texts.unionByName(other)
    shape = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    out = texts.groupBy("block").applyInArrow(add_up, shape)
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
