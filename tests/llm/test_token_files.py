"""Token files: equal ids, places and checksums, the encodings on disk, and selective reads."""

import glob
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from layerloom.llm.token_files import (
    Encoder,
    default_tokenizer,
    read_files,
    read_index,
    read_span,
    read_tokens,
    token_digest,
    write_token_files,
)

SF = "/root/testdata/sf0.001/documents.parquet"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_tokenizer())


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tokens"))
    write_token_files(spark.read.parquet(SF), path, files=3, row_group=64 << 10, page=4 << 10, page_rows=8)
    return path


def definition():
    with open(default_tokenizer(), encoding="utf-8") as file:
        return file.read()


def encoded(encoder, texts, *after):
    ids, sizes = encoder.encode(pa.array(texts, pa.string()), *after)
    return [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def test_units_give_the_ids_of_whole_texts(tokenizer):
    encoder = Encoder(definition(), cached=50)
    rng = random.Random(3)
    signs = ["a", "B", "'s", "'", "é", "é", "́", " ", "  ", "\n", "\t", " ", " ", "\x1c", "1", "23", "ß", "İ", "Σ", "中文", "😀", "<|endoftext|>", "…", "don't", "\r\n", "‍", "ﬁ"]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 30))) for _ in range(2000)]
    for i in range(0, len(texts), 100):
        assert encoded(encoder, texts[i : i + 100], 1) == [ids_of(tokenizer, t) for t in texts[i : i + 100]]
    whole = Encoder(definition(), whole=True)
    assert encoded(whole, texts[:50]) == [ids_of(tokenizer, t)[:-1] for t in texts[:50]]


def test_words_give_the_ids_of_the_tokenizer(spark, tokenizer):
    encoder = Encoder(definition())
    assert encoder.spelling is not None
    units = {u for r in spark.read.parquet(SF).collect() for u in (r["text"] or "").split()}
    units |= {"É", "ÀÖØßÿ", "Straße!?", "a.,;", "...", "x'", "'s", "don't.", "ÅNGSTRÖM", "×", "a×b", "﻿a", "aª", "º"}
    units = sorted(units)
    assert encoded(encoder, units) == [e.ids for e in tokenizer.encode_batch(units, add_special_tokens=False)]


def test_digest_equals_plain_encoding(spark, stored, tokenizer):
    docs = sorted(((r["doc_id"], r["text"]) for r in spark.read.parquet(SF).collect()))
    at, want = 0, []
    for doc_id, text in docs:
        ids = ids_of(tokenizer, text)
        want.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = sorted(tuple(r) for r in token_digest(read_tokens(spark, stored)).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == want
    assert sorted(tuple(r) for r in read_index(spark, stored).collect()) == [w[:3] for w in want]


@pytest.mark.parametrize("encoding, found", [("dictionary", "RLE_DICTIONARY"), ("delta", "DELTA_BINARY_PACKED")])
def test_encodings_row_groups_and_page_indexes(spark, tmp_path, encoding, found):
    write_token_files(spark.read.parquet(SF), str(tmp_path), encoding=encoding, files=1, row_group=32 << 10, page=2 << 10, page_rows=8)
    (file,) = glob.glob(f"{tmp_path}/tokens/*.parquet")
    meta = pq.ParquetFile(file).metadata
    assert meta.num_row_groups > 1
    for g in range(meta.num_row_groups):
        columns = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c) for c in range(4)}
        assert found in columns["ids.list.element"].encodings
        for name in ("doc_id", "start", "n_tokens"):
            assert "DELTA_BINARY_PACKED" in columns[name].encodings
        assert all(c.has_offset_index and c.has_column_index for c in columns.values())


def test_metadata_reads_skip_ids(spark, stored):
    plan = read_index(spark, stored, first=10, last=20)._jdf.queryExecution().executedPlan().toString()
    tokens = next(line for line in plan.splitlines() if "/tokens]" in line)
    assert "ids" not in tokens.split("ReadSchema")[1] and "GreaterThanOrEqual(doc_id,10)" in tokens
    ids = sorted(r["doc_id"] for r in read_tokens(spark, stored, first=10, last=20).collect())
    assert ids == [r["doc_id"] for r in spark.read.parquet(SF).filter("doc_id between 10 and 20").orderBy("doc_id").collect()]


def test_spans_cut_documents(spark, stored):
    rows = sorted((r["start"], r["ids"]) for r in read_tokens(spark, stored).collect())
    flat = [i for _, ids in rows for i in ids]
    assert read_files(spark, stored).count() == 3
    for begin, end in ((0, 5), (100, 90_000), (len(flat) - 3, len(flat) + 10), (7, 7), (len(flat) + 5, len(flat) + 9)):
        parts = sorted((r["position"], r["ids"]) for r in read_span(spark, stored, begin, end).collect())
        assert [i for _, ids in parts for i in ids] == flat[begin:end]


def test_defined_cases(spark, tmp_path):
    rows = [(2, "b", 1), (None, "a a", 2), (2, "c c c", 3), (1, None, 4), (1, "", 5), (3, "x " * 100_000, 6)] + [(9, "same", 7)] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(4)
    write_token_files(docs, str(tmp_path / "t"), files=4)
    got = sorted((tuple(r) for r in read_index(spark, str(tmp_path / "t")).collect()), key=lambda r: r[1])
    assert [r[0] for r in got][:6] == [None, 1, 1, 2, 2, 3] and len(got) == 56
    assert [r[2] for r in got][:3] == [3, 1, 1]
    assert [r[1] for r in got] == [sum(r[2] for r in got[:i]) for i in range(56)]
    write_token_files(docs.limit(0), str(tmp_path / "none"))
    assert token_digest(read_tokens(spark, str(tmp_path / "none"))).collect() == []
    with pytest.raises(ValueError):
        write_token_files(docs, str(tmp_path / "x"), encoding="plain")
