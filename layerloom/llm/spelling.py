"""Spelling variants by a bit-sliced position index.

Words that occur often enough are grouped with those one edit away. A block of words is indexed by one bitset for each
(position, letter): bit i says that word i has the letter there. A query reads its letters once. One set holds the words that
match so far without an error; three more hold those with one error: a replaced letter, a letter that only the
word has (its later positions are shifted by one) or a letter that only the query has (shifted back). Each step is a few
operations on whole bitsets, so all words of the block are compared at once.

Blocks keep that from being vocabulary times vocabulary. One edit leaves one half of a word as it is: words of
length L and L + 1 that are near share the first L // 2 letters or the last L - L // 2. So each word goes to four blocks, by
(L, half): two as a word of length L, two as one of length L + 1 that is only looked up. A pair that shares both halves is
taken from the block of first halves alone, so each pair is found once. A half that very many words share is cut
into blocks of at most ``BLOCK`` words, which meet pair by pair in tasks of bounded size; no pair of words is
listed but those that are near.

Occurrences are counted per worker in a dictionary of bounded size before the shuffle, over all texts. Forms are chosen
by an aggregate that combines before the shuffle. A form occurs ``RATIO`` times as often as its word, so chains are short and are
followed by doubling.

Defined cases: a null text has no words; a null id counts as the empty text in the hash; repeated rows count again; ties go to the
smaller word in code-point order; very long texts are read whole; an empty table gives no rows; extra columns are
ignored, and none can clash, as two are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import groupby
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.llm.common import LOWER, UPPER, written

LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
MODULUS = 199
BLOCK = 32_768
PAIR_ROWS = 20_000
COUNTED = 200_000
RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWERED = str.maketrans(UPPER, LOWER)


class PositionIndex:
    """Bitsets over a block of words, by position and letter."""

    def __init__(self, words: list[str]):
        self.words = words
        has: dict[int, defaultdict[str, bytearray]] = {}
        lengths: defaultdict[int, bytearray] = defaultdict(lambda: bytearray(size))
        size = len(words) // 8 + 1
        for i, word in enumerate(words):
            byte, bit = i >> 3, 1 << (i & 7)
            lengths[len(word)][byte] |= bit
            for j, letter in enumerate(word):
                has.setdefault(j, defaultdict(lambda: bytearray(size)))[letter][byte] |= bit
        whole = lambda sets: {k: int.from_bytes(v, "little") for k, v in sets.items()}
        self.has = [whole(has[j]) for j in sorted(has)]
        self.lengths = whole(lengths)
        self.everything = (1 << len(words)) - 1

    def near_bits(self, query: str) -> int:
        """The set of words exactly one inserted, deleted or replaced letter away."""
        none: dict[str, int] = {}
        at = lambda j: self.has[j] if 0 <= j < len(self.has) else none
        exact, replaced, longer, shorter = self.everything, 0, 0, 0
        for j, letter in enumerate(query):
            here, next_, back = at(j).get(letter, 0), at(j + 1).get(letter, 0), at(j - 1).get(letter, 0)
            shorter = shorter & back | exact  # the word lacks this letter
            longer = (longer | exact) & next_  # the word has another letter before this one
            replaced = replaced & here | exact & ~here
            exact &= here
        n = len(query)
        length = self.lengths.get
        return replaced & length(n, 0) | (longer | exact) & length(n + 1, 0) | shorter & length(n - 1, 0)

    def near(self, query: str) -> list[int]:
        """Places of those words."""
        bits, out = self.near_bits(query), []
        while bits:
            low = bits & -bits
            out.append(low.bit_length() - 1)
            bits ^= low
        return out


# Counting


def occurrences(docs: DataFrame, least_length: int = LEAST_LENGTH, modulus: int = MODULUS, counted: int = COUNTED) -> DataFrame:
    """``word, n``: lower-cased runs of letters in all texts, some of which lose a letter.

    The crc32 of ``<doc_id>:<run>`` decides both: where ``modulus`` divides it, the letter at its remainder by the length is deleted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        raw: dict[str, bytes] = {}

        def flush() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return rows

        for batch in batches:
            for doc_id, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                if not text:
                    continue
                start = crc32(f"{doc_id}:".encode())
                if len(raw) > counted:
                    raw.clear()
                for word, n in Counter(RUN.findall(text.translate(_LOWERED))).items():
                    if (spelled := raw.get(word)) is None:
                        spelled = raw[word] = word.encode()
                    if not (h := crc32(spelled, start)) % modulus:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    if len(word) >= least_length:
                        total[word] += n
                if len(total) > counted:
                    yield flush()
        if total:
            yield flush()

    narrow = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    return narrow.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# Blocks


def blocks(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """``key, cut, asks, looks, word, n``: every word in its four blocks.

    A half with more than ``block`` words is cut by a hash of the word; pieces meet in pairs, keyed by ``cut``. In a piece's
    own row (``asks``) its words of length L are queries; ``looks`` marks the words that are indexed there.
    """
    size = F.length("word")
    half = lambda n: F.floor(n / 2).cast("int")
    key = lambda side, n, text: F.struct(F.lit(side).alias("side"), n.alias("length"), text.alias("half"))
    own, less = size, size - 1
    keys = F.array(
        key("first", own, F.substring("word", 1, half(own))),
        key("last", own, F.right("word", own - half(own))),
        key("first", less, F.substring("word", 1, half(less))),
        key("last", less, F.right("word", less - half(less))),
    )
    rows = words.select("word", "n", F.explode(keys).alias("key")).select("word", "n", "key.*")
    found = rows.groupBy("side", "length", "half").agg(F.count("*").alias("g")).filter(F.col("g") > 1)
    cuts = F.ceil(F.col("g") / block).cast("int")
    many = rows.join(found.withColumn("cuts", cuts).drop("g"), ["side", "length", "half"])
    piece = F.pmod(F.xxhash64("word"), F.col("cuts")).cast("int")
    dealt = many.withColumn("piece", piece)
    # as a query a word meets every piece, as an indexed word every query piece
    every = F.sequence(F.lit(0), F.col("cuts") - 1)
    asks = dealt.filter(F.length("word") == F.col("length")).select("*", F.explode(every).alias("other"))
    asks = asks.select("side", "length", "half", F.col("piece").alias("q"), F.col("other").alias("v"), F.lit(True).alias("asks"), "word", "n")
    looks = dealt.select("*", F.explode(every).alias("other"))
    looks = looks.select("side", "length", "half", F.col("other").alias("q"), F.col("piece").alias("v"), F.lit(False).alias("asks"), "word", "n")
    return asks.unionByName(looks)


def near_pairs(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """``word, n, other, other_n``: both directions of every pair of near words.

    Blocks are many and mostly small: a task streams the sorted rows of its partition and holds one block at a time.
    """

    def compare(side: str, length: int, rows: list[tuple]) -> Iterator[tuple[str, int, str, int]]:
        looked, asked = [(w, n) for asks, w, n in rows if not asks], [(w, n) for asks, w, n in rows if asks]
        if not asked or len(looked) < 2:
            return
        index, cut = PositionIndex([w for w, _ in looked]), length // 2
        for word, n in asked:
            for i in index.near(word):
                other, other_n = looked[i]
                if side == "last" and other[:cut] == word[:cut]:
                    continue  # found by their first halves
                yield word, n, other, other_n
                if len(other) > len(word):  # of equal length, the other one asks as well
                    yield other, other_n, word, n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b[c].to_pylist() for c in (*key, "asks", "word", "n")), strict=True))
        out: list[tuple] = []
        for (side, length, *_), block_rows in groupby(rows, lambda r: r[:5]):
            for pair in compare(side, length, [r[5:] for r in block_rows]):
                out.append(pair)
                if len(out) == PAIR_ROWS:
                    yield _pair_batch(out)
                    out = []
        if out:
            yield _pair_batch(out)

    key = ["side", "length", "half", "q", "v"]
    dealt = blocks(words, block).repartition(*key).sortWithinPartitions(*key)
    return dealt.mapInArrow(run, "word string, n long, other string, other_n long")


def _pair_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["word", "n", "other", "other_n"])


# Forms


def roots(forms: DataFrame, ratio: int = RATIO, most: int = 1) -> DataFrame:
    """``word, root`` for rows of ``word, form`` that give every form: forms followed to the last, by doubling.

    ``most`` is the largest count: each step of a chain has ``ratio`` times the count of the one before, which bounds its length.
    """
    if ratio < 2:
        raise ValueError("a form must occur at least twice as often, or chains could be cycles")
    rounds = max(1, math.ceil(math.log2(max(2, math.log(max(most, 2), ratio) + 1))))
    now = forms.select("word", F.col("form").alias("root"))
    for _ in range(rounds):
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = written(now.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    return now


def spelling_variants(docs: DataFrame, least_count: int = LEAST_COUNT, least_length: int = LEAST_LENGTH, ratio: int = RATIO, modulus: int = MODULUS, block: int = BLOCK) -> DataFrame:
    """``word, form, root, n, n_near, form_n``, one row for each word with enough letters and occurrences."""
    counts = occurrences(docs, least_length, modulus).filter(F.col("n") >= least_count)
    return group_variants(counts, ratio, block)


def group_variants(counts: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """The same for given ``word, n``, one row a word; a word shorter than two letters has no near words."""
    words = written(counts, "words")
    pairs = near_pairs(words.filter(F.length("word") > 1), block)
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word")))
    found = written(pairs.groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best")), "variants")
    chosen = F.when(-F.col("best.n") >= ratio * F.col("n"), F.col("best.word"))
    formed = found.select("word", chosen.alias("form"), "n_near", F.when(chosen.isNotNull(), -F.col("best.n")).alias("form_n"))
    most = words.agg(F.max("n")).head()[0] or 1
    ends = roots(formed.filter(F.col("form").isNotNull()), ratio, most)
    out = words.join(formed, "word", "left").join(ends, "word", "left")
    return out.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"
    )
