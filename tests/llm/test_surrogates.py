"""Surrogates: detection, formats, distinctness and coreference."""

import re

import pytest
from pyspark.sql import functions as F

from layerloom.llm import surrogates
from layerloom.llm.surrogates import GIVEN, alike, detect, iban_check, luhn, permute, rendered, replace_documents, replace_entities, settle, surrogate

IBAN = "DE" + iban_check("DE", "370400440532013000") + "370400440532013000"
TEXTS = {
    "mail Ann.Lee+x@Mail.Example.com, and ann.lee+x@mail.example.COM.": ["email", "email"],
    "host 42.144.35.254. and 1.2.3.4.5 and 300.1.1.1 version 2.0.": ["ip"],
    "card 4041894974608795 or 4041-8949-7460-8795, not 4041894974608794": ["card", "card"],
    "call +1 (974) 555-3436 or 030-123-4567%%% or 078-05-1120": ["phone", "phone", "ssn"],
    f"to {IBAN} and {IBAN[:4]} {IBAN[4:8]} {IBAN[8:]} not DE00370400440532013000": ["iban", "iban"],
    "Mr. John Smith met Mrs Smith, Dr Иван Петров and Frau müller": ["person", "person", "person"],
    "clean words, 12 of them, in 2024-01-15 at 10:30": [],
    "@ a@ @b a@b a@b.c1 " + "x" * 3000 + "@example.org": ["email"],
}


def test_detection():
    for text, kinds in TEXTS.items():
        assert [k for _, _, k, _ in detect(text)] == kinds, text
    assert detect(None) == detect("") == []


@pytest.mark.parametrize("size", [1, 2, 3, 10, 26, 1000])
def test_permutations_are_one_to_one(size):
    assert sorted(permute(i, size, b"k", "t") for i in range(size)) == list(range(size))


def test_formats_are_kept():
    for text in ("ab1-X", "Ж9ё", "日本a", "éü", "a" * 300):
        new = alike(text, b"k", "t")
        assert len(new) == len(text)
        for a, b in zip(text, new, strict=True):
            assert a.isdigit() == b.isdigit() and a.isupper() == b.isupper() and a.isalpha() == b.isalpha()
            assert ord(a) < 128 or ord(a) >> 8 == ord(b) >> 8
    card = surrogate("card", "4041894974608795")
    assert card[0] == "4" and luhn(card) and len(card) == 16
    new = surrogate("iban", IBAN)
    assert new[:2] == "DE" and new[2:4] == iban_check("DE", new[4:])
    assert all(0 <= int(x) < 256 for x in surrogate("ip", "1.2.3.4").split("."))
    assert surrogate("email", "a.b1@x.example.com").endswith(".com")
    assert rendered("phone", "+1 (974) 555-3436", "+1:1234567890") == "+1 (123) 456-7890"
    for (gender, script), names in GIVEN.items():
        for name in names:
            first, last = surrogate("person", f"{gender}:{name} {names[0]}").split(":")[1].split(" ")
            assert first in GIVEN[gender, script] and last[0].isupper()
    assert surrogate("card", "4041894974608795", b"other") != card


def replaced(spark, texts, **more):
    rows = [(i, t, 0, "x") for i, t in enumerate(texts)]
    df = replace_entities(spark.createDataFrame(rows, "doc_id long, text string, n_chars int, entity string"), **more)
    return {r["doc_id"]: r for r in df.collect()}


def test_replacement_is_consistent_and_distinct(spark):
    texts = [*TEXTS, None, ""] + [f"write to user{i:02d}@mail.example.com and user{i:02d}@MAIL.example.com" for i in range(60)] + [f"from {a}@b.co" for a in "abcdefghijklmnopqrstuvwxyz"]
    for most_shared in (100_000, 0):
        got = replaced(spark, texts, most_shared=most_shared)
        assert len(got) == len(texts)
        real = {e for t in texts for *_, e in detect(t)}
        new = {}
        for i, text in enumerate(texts):
            old, now = detect(text), detect(got[i]["text"])
            assert got[i]["__n_entities"] == len(old)
            if not old:
                assert got[i]["text"] == text
                continue
            assert got[i]["n_chars"] == len(got[i]["text"])
            assert [k for _, _, k, _ in now] == [k for _, _, k, _ in old]
            for (*_, kind, a), (*_, b) in zip(old, now, strict=True):
                assert b not in real and new.setdefault((kind, a), b) == b
            keep = lambda t, spans: re.sub("\0+", "\0", "".join("\0" if any(s <= j < e for s, e, *_ in spans) else c for j, c in enumerate(t)))
            assert keep(text, old) == keep(got[i]["text"], now)
        assert len(set(new.items())) == len({(k[0], v) for k, v in new.items()})


def test_collisions_are_drawn_again(spark):
    found = spark.createDataFrame([("email", f"{a}@b.co") for a in "abcdefghijklmnopqrstuvwxyz"], "kind string, entity string")
    late = {r["entity"]: r["attempt"] for r in settle(found).collect()}
    host = surrogate("email", "a@b.co").split("@")[1]
    real = {f"{a}@b.co" for a in "abcdefghijklmnopqrstuvwxyz"}
    new = [surrogate("email", e, attempt=late.get(e, 0)) for e in real]
    assert len(set(new)) == 26 and not real & set(new) and host
    assert settle(found.limit(0)).collect() == []


def test_the_table_keeps_clean_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = replace_documents(docs).collect()
    assert len(got) == len(texts)
    changed = 0
    real = {(k, e) for t in texts.values() for _, _, k, e in detect(t)}
    for r in got:
        if detect(texts[r["doc_id"]]):
            changed += 1
            assert not real & {(k, e) for _, _, k, e in detect(r["text"])}
        else:
            assert r["text"] == texts[r["doc_id"]]
    assert changed > 20
    assert replace_documents(docs.filter(F.lit(False))).collect() == []
    assert surrogates.KEY
