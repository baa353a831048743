"""Token ids in Parquet files, for selective reads of tokens and of metadata.

A table is a folder with two parts. ``tokens`` holds ``doc_id, start, n_tokens, ids`` in ascending order of ``doc_id``
over its files; ``start`` counts from the first token of its file. ``files`` holds one row for each of those files: its place
in the order, the tokens before it (``base``), its rows, and its least and greatest ``doc_id``. Starts in the whole corpus are
``base + start``, so a file can be written without waiting for those before it.

Ids are a list column, dictionary-encoded (each row group numbers the ids it has, and packs the numbers in as many bits as they
need) or delta-encoded; ids of documents, starts and counts are always delta-encoded, as they rise slowly. Row groups
and pages have set sizes, and each file ends with a page index. So a reader of metadata skips all pages of ids, and a range of documents
or of positions reads the row groups and pages that can hold it. Documents are encoded after the one shuffle, by range of id.

The tokenizer is a file of the tokenizers library. Its pre-tokenizer never joins what a space or a line feed
separates, so texts are cut there and each distinct unit of a worker is encoded once while it stays in a bounded
cache; for a tokenizer of which that is not known, ``whole=True`` encodes texts whole. A unit of Latin letters goes to
the tokenizer's model without its normaliser and splitter, if these only lower-case it.

Defined cases: a null text is empty and has the end id alone; rows without id come first; rows with equal id are ordered by a
hash of their text; a repeated row is written again; very long texts are one row; an empty table gives a table without
rows; extra columns are ignored, and none can clash, as two are read.
"""

from __future__ import annotations

import json
import os
import re
import string
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerloom.session import scratch_path

END = 1
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 1024
CACHED_UNITS = 400_000
CHUNK_BYTES = 4 << 20
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
MARKS = string.punctuation.replace("'", "")  # an apostrophe can begin a word


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Ids of texts; its cache has those of a unit as bytes of little-endian 32-bit integers."""

    def __init__(self, definition: str, whole: bool = False, cached: int = CACHED_UNITS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core for each task
        from tokenizers import Tokenizer

        self.tokenizer, self.whole, self.cached = Tokenizer.from_str(definition), whole, cached
        self.cache: dict[str, bytes] = {}
        self.spelling = self._letters(json.loads(definition))

    @staticmethod
    def _letters(definition: dict) -> dict[int, str] | None:
        """How the model spells letters, if a run of them is one word in lower case for this tokenizer."""
        from tokenizers.pre_tokenizers import ByteLevel

        kinds = lambda part, steps: [step["type"] for step in (definition[part] or {}).get(steps, ())]
        if kinds("normalizer", "normalizers") != ["NFC", "Replace", "Lowercase"] or kinds("pre_tokenizer", "pretokenizers") != ["Split", "ByteLevel"]:
            return None
        split, level = definition["pre_tokenizer"]["pretokenizers"]
        if r"|[\p{L}]+|" not in split["pattern"].get("Regex", "") or not split["invert"] or level["add_prefix_space"] or level["use_regex"]:
            return None
        spelled = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        return {ord(c): spelled(c.lower())[0][0] for c in map(chr, range(256)) if LETTERS.fullmatch(c)}

    def _ids(self, units: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(units, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _solve(self, units: list[str]) -> list[bytes]:
        """Ids of units: a word of Latin letters, alone or before marks, goes to the model at once, in lower case."""
        if len(self.cache) > self.cached:
            self.cache = {}  # one chunk can go beyond the bound, until the next
        known, tokenize, out, others = self.cache, self.tokenizer.model.tokenize, [], []
        for unit in units:
            word = unit.rstrip(MARKS)
            if self.spelling is None or not (word.isascii() and word.isalpha() or LETTERS.fullmatch(word)):
                if unit not in known:
                    others.append(unit)
                out.append(None)
                continue
            lower = word.lower()
            if (ids := known.get(lower)) is None:
                spelled = lower if lower.isascii() else lower.translate(self.spelling)
                ids = known[lower] = array("I", [t.id for t in tokenize(spelled)]).tobytes()
            if word != unit:
                marks = unit[len(word) :]
                if marks not in known:
                    known[marks] = self._ids([marks])[0]
                ids += known[marks]
            out.append(ids)
        known.update(zip(others, self._ids(others), strict=True))
        return [known[u] if x is None else x for u, x in zip(units, out, strict=True)]

    def encode(self, texts: pa.Array, *after: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of texts without nulls, one text after the other, each with ``after`` behind it; and how many each has."""
        tail = np.array(after, "<u4").tobytes()
        if self.whole:
            rows = [ids + tail for ids in self._ids(texts.to_pylist())]
            return np.frombuffer(b"".join(rows), "<i4"), np.array([len(r) // 4 for r in rows], np.int64)
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")  # a text has one unit at least
        codes = cut.flatten().dictionary_encode()
        units = codes.dictionary.to_pylist()
        solved = [*self._solve(units), tail]
        flat = np.frombuffer(b"".join(solved), "<i4")
        sizes = np.fromiter(map(len, solved), np.int64, len(solved)) // 4
        ends = np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64))
        order = np.insert(codes.indices.to_numpy().astype(np.int64), ends, len(units))
        size = sizes[order]
        until = np.cumsum(size)
        at = np.arange(until[-1]) + np.repeat((np.cumsum(sizes) - sizes)[order] - (until - size), size)
        return flat[at], np.diff(until[ends + np.arange(len(ends))], prepend=0)


@lru_cache(maxsize=1)
def _encoder(definition: str, whole: bool) -> Encoder:
    """One encoder a worker, which later tasks find with its cache."""
    return Encoder(definition, whole)


def _chunks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``CHUNK_BYTES``."""
    begin = total = 0
    for end, size in enumerate(sizes, 1):
        total += size
        if total >= CHUNK_BYTES:
            yield begin, end
            begin, total = end, 0
    if begin < len(sizes):
        yield begin, len(sizes)


def encode(docs: DataFrame, tokenizer: str | None = None, end: int = END, whole: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids``: texts with the end id; ``start`` counts within a partition."""
    with open(tokenizer or default_tokenizer(), encoding="utf-8") as file:  # a few MB whatever the input
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, start = _encoder(shared.value, whole), 0
        for batch in batches:
            texts = pc.fill_null(batch["text"], "")
            for a, b in _chunks(pc.binary_length(texts).to_pylist()):
                ids, sizes = encoder.encode(texts.slice(a, b - a), end)
                until = np.cumsum(sizes)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], until)).astype(np.int32)), pa.array(ids))
                columns = [batch["doc_id"].slice(a, b - a), pa.array(start + until - sizes), pa.array(sizes), lists]
                start += int(until[-1])
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids array<int>")


def layout(encoding: str = "dictionary", row_group: int = ROW_GROUP_BYTES, page: int = PAGE_BYTES, page_rows: int = PAGE_ROWS) -> dict[str, str]:
    """Options of the Parquet writer; version 2 pages are those that have delta encodings."""
    if encoding not in ("dictionary", "delta"):
        raise ValueError("encoding is 'dictionary' or 'delta'")
    return {
        "compression": "zstd",
        "parquet.writer.version": "PARQUET_2_0",
        "parquet.block.size": str(row_group),
        "parquet.page.size": str(page),
        "parquet.page.row.count.limit": str(page_rows),
        "parquet.enable.dictionary": "false",
        "parquet.enable.dictionary#ids.list.element": str(encoding == "dictionary").lower(),
    }


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str | None = None, end: int = END, files: int | None = None, whole: bool = False, **options
) -> None:
    """Write the table of ``docs`` at ``path``; ``files`` by default as many as Spark chooses, ``options`` are those of ``layout``."""
    spark = docs.sparkSession
    # Equal ids, and rows that are equal in all, are told apart, so that many of them need not share a file.
    order = [F.col("doc_id").asc_nulls_first(), F.col("h"), F.col("m")]
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("m"))
    dealt = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
    encoded = encode(dealt.sortWithinPartitions(*order).select("doc_id", "text"), tokenizer, end, whole)
    encoded.write.options(**layout(**options)).parquet(f"{path}/tokens")
    written = spark.read.schema(encoded.schema).parquet(f"{path}/tokens").select(_file(), "doc_id", "n_tokens")
    facts = written.groupBy("file").agg(
        F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_rows"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")
    )
    # one row for each file
    turn = F.regexp_extract("file", r"part-(\d+)", 1).cast("long")
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = facts.withColumn("place", turn).withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))
    placed.write.parquet(f"{path}/files")


def _file():
    return F.col("_metadata.file_name").alias("file")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """``file, n_tokens, n_rows, first_id, last_id, place, base``, one row for each file of tokens."""
    return spark.read.parquet(f"{path}/files")


def _read(spark: SparkSession, path: str, *columns: str, first=None, last=None) -> DataFrame:
    rows = spark.read.parquet(f"{path}/tokens").select(_file(), *columns)
    if first is not None:
        rows = rows.filter(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.filter(F.col("doc_id") <= last)
    placed = rows.join(read_files(spark, path).select("file", "base"), "file")
    return placed.select(*[(F.col("base") + F.col(c)).alias(c) if c == "start" else F.col(c) for c in columns])


def read_index(spark: SparkSession, path: str, first=None, last=None) -> DataFrame:
    """``doc_id, start, n_tokens`` of all documents, or of those with an id from ``first`` to ``last``; no page of ids is read."""
    return _read(spark, path, "doc_id", "start", "n_tokens", first=first, last=last)


def read_tokens(spark: SparkSession, path: str, first=None, last=None) -> DataFrame:
    """``doc_id, start, n_tokens, ids``, likewise; row groups and pages without such ids are skipped."""
    return _read(spark, path, "doc_id", "start", "n_tokens", "ids", first=first, last=last)


def read_span(spark: SparkSession, path: str, begin: int, end: int) -> DataFrame:
    """``doc_id, position, ids``: the tokens at corpus positions ``begin`` to ``end`` (exclusive), cut at both ends.

    The few files that hold them are found in ``files`` first; in a file, ``start`` prunes row groups and pages.
    """
    within = read_files(spark, path).filter((F.col("base") < end) & (F.col("base") + F.col("n_tokens") > begin))
    parts = []
    for row in within.select("file", "base").toLocalIterator():  # as many as the span covers
        rows = spark.read.parquet(f"{path}/tokens/{row['file']}").filter((F.col("start") < end - row["base"]) & (F.col("start") + F.col("n_tokens") > begin - row["base"]))
        parts.append(rows.select("doc_id", (F.col("start") + row["base"]).alias("at"), "n_tokens", "ids"))
    if not parts:
        parts = [read_tokens(spark, path).limit(0).select("doc_id", F.col("start").alias("at"), "n_tokens", "ids")]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    skipped = F.greatest(F.lit(begin) - F.col("at"), F.lit(0)).cast("int")
    taken = (F.least(F.lit(end), F.col("at") + F.col("n_tokens")) - F.col("at")).cast("int") - skipped
    return rows.select("doc_id", (F.col("at") + skipped).alias("position"), F.slice("ids", skipped + 1, taken).alias("ids"))


def token_digest(tokens: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of rows with ``ids``: crc32 of all ids as little-endian 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["ids"]
            flat, offsets = np.asarray(ids.values).astype("<u4", copy=False).view(np.uint8), ids.offsets.to_numpy() * 4
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            columns = [batch["doc_id"], batch["start"], batch["n_tokens"], pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def token_index(docs: DataFrame, tokenizer: str | None = None, encoding: str = "dictionary") -> DataFrame:
    """Write the token files of ``docs`` and give the digest of what is read back."""
    path = scratch_path(docs.sparkSession, "token-files")
    write_token_files(docs, path, tokenizer, encoding=encoding)
    return token_digest(read_tokens(docs.sparkSession, path))
