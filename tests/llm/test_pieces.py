"""Viterbi against brute force, against the public library run as a unigram model, and round trips."""

import itertools
import random

import duckdb
import numpy as np
import pytest
import sentencepiece

from layerloom.llm.pieces import MARK, VOCABULARY, DoubleArray, Encoder, Vocabulary, decode, decode_documents, encode_documents, load, solve_many, solve_one

TEXTS = [None, "", " ", "  two  spaces ", "line\n\nfeeds\n", "é🙂 ▁ a▁b\x00", "▁", "日本語 text", "x" * 5000 + " y", " " * 3000, "the quick brown fox " * 500]


def toy(scores):
    pieces = [("<unk>", 0.0)] + [(f"<0x{b:02X}>", 0.0) for b in range(256)] + scores
    return Vocabulary(pieces, list(range(1, 257)))


def brute(vocabulary, unit, table):
    """Best score over every segmentation."""
    best = -np.inf
    text = "".join(MARK if c == " " else c for c in unit)
    for cuts in itertools.product([0, 1], repeat=len(text) - 1):
        parts, at = [], 0
        for i, c in enumerate(cuts, 1):
            if c:
                parts.append(text[at:i])
                at = i
        parts.append(text[at:])
        score = 0.0
        for p in parts:
            score += table[p] if p in table else vocabulary.unknown_score if len(p) == 1 else -np.inf
        best = max(best, score)
    return best


def test_viterbi_finds_the_best_score():
    rng = random.Random(1)
    words = {"".join(rng.choice("abc" + MARK) for _ in range(1)) for _ in range(3)} | {MARK + "a", "ab", "abc", "bca", "cc", "aa", MARK + MARK}
    table = {w: round(-rng.random() * 9, 2) for w in sorted(words)}
    vocabulary = toy(list(table.items()))
    units = ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 9))) for _ in range(200)] + [" a", "  ab", " d", "d"]
    solved = solve_many(vocabulary, units)
    for unit, got in zip(units, solved, strict=True):
        assert got == solve_one(vocabulary, unit)
        ids = np.frombuffer(got, np.int32)
        assert vocabulary.cost[ids].sum() == pytest.approx(brute(vocabulary, unit, table))
        assert decode(vocabulary, np.frombuffer(solve_one(vocabulary, " ") + got, np.int32)) == unit


def test_double_array_holds_exactly_its_words():
    rng = random.Random(2)
    words = {"".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))): i for i in range(500)}
    trie = DoubleArray(words)

    def find(word):
        at = 0
        for c in word:
            step = trie.base[at] + trie.code[c]
            if trie.check[step] != at:
                return -1
            at = step
        return trie.value[at]

    assert all(find(w) == v for w, v in words.items())
    others = {"".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(2000)} - words.keys()
    assert all(find(w) == -1 for w in others)


def as_unigram():
    """The vocabulary file with its model type set to unigram."""
    raw = open(VOCABULARY, "rb").read()
    at = raw.rindex(b"\x18\x02 \x80\xfa\x01")  # model_type = 2, then vocab_size = 32000
    return sentencepiece.SentencePieceProcessor(model_proto=raw[: at + 1] + b"\x01" + raw[at + 2 :])


def test_ids_equal_the_library():
    """Its lattice search on short texts; its fast search prunes, so ours is never worse than that."""
    docs = duckdb.sql("select text from '/root/testdata/sf0.001/documents.parquet'").fetchall()
    texts = [t for (t,) in docs if t and MARK not in t]
    library, encoder = as_unigram(), Encoder(load())
    cost = encoder.vocabulary.cost
    short = [" ".join(w[i : i + 8]) for t in texts for w in [t.split(" ")[:40]] for i in range(0, len(w), 8)]
    # a marker alone, or a character in bytes, costs 1e9: beyond it, single-precision sums cannot tell pieces apart
    exact = 0
    for text, ids in zip(short, encoder.encode(short), strict=True):
        want = library.nbest_encode(text, nbest_size=2)[0]
        mine, its = cost[ids].sum(), cost[want].sum()
        assert mine == its if min(mine, its) > -1e6 else mine >= its
        exact += ids.tolist() == want
    assert exact > 0.8 * len(short)
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert cost[ids].sum() >= cost[library.encode(text)].sum()


def test_round_trip_and_cache_limit():
    for cached in (400_000, 3):
        encoder = Encoder(load(), cached)
        for _ in range(2):
            got = encoder.encode(TEXTS)
            assert [None if x is None else decode(encoder.vocabulary, x) for x in got] == TEXTS


def test_documents(spark):
    rows = [(i, t, 1) for i, t in enumerate(TEXTS)] + [(1, "", 2), (None, "a b", 3)]
    encoded = encode_documents(spark.createDataFrame(rows, "doc_id long, text string, ids int"))
    got = encoded.collect()
    assert len(got) == len(rows)
    for r in got:
        text = "a b" if r["doc_id"] is None else TEXTS[r["doc_id"]]
        assert r["round_trip"] is (None if text is None else True)
        assert (r["ids"] is None) == (text is None)
        assert text is None or r["n_pieces"] == len(r["ids"])
    back = {r["doc_id"]: r["text"] for r in decode_documents(encoded).collect()}
    assert back == {None: "a b"} | dict(enumerate(TEXTS))
    assert encode_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []
