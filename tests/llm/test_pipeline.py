"""The pipeline's stages, each held against brute force on its own input."""

import re
from collections import Counter

import corpus_pipeline
from layerloom.llm.common import table, written
from layerloom.llm.mixing import mix, mix_documents
from layerloom.llm.partenum import drop_copies
from layerloom.llm.pieces import decode, load
from layerloom.llm.quality import rate_documents
from tests.llm.test_partenum import brute
from tests.llm.test_secrets import plain

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()} if name != "sentencepiece_encoding" else docs.collect()
        out = written(stage(spark, docs, SF), name)
        rows = out.collect()
        kept[name] = len(rows)
        if name != "sentencepiece_encoding":
            assert out.columns == columns
        if name == "quality_classifier":
            rated = {r["doc_id"]: r["keep"] for r in rate_documents(docs, table(spark, SF, "labels")).collect()}
            assert sorted(r["doc_id"] for r in rows) == sorted(d for d, k in rated.items() if k)
            assert all(r == before[r["doc_id"]] for r in rows)
        elif name == "ngram_jaccard_join":
            leads = {c for _, _, c in brute([(r["doc_id"], r["text"]) for r in before.values()])}
            assert sorted(r["doc_id"] for r in rows) == sorted(leads)
            assert all(r == before[r["doc_id"]] for r in rows)
        elif name == "secret_scans":
            assert len(rows) == len(before)
            for r in rows:
                assert plain(r["text"]) == "" and r["n_chars"] == len(r["text"])
                if not plain(before[r["doc_id"]]["text"]) and "[format]" not in r["text"]:
                    assert r == before[r["doc_id"]]
            assert sum("[" in r["text"] for r in rows) > 0
        elif name == "mixing_sources":
            assert all(r == before[r["doc_id"]] for r in rows)
            times = Counter(r["doc_id"] for r in rows)
            words = {d: len(WORD.findall(r["text"] or "")) for d, r in before.items()}
            targets = {before[r["doc_id"]]["source"]: r["target"] for r in mix(docs).collect()}
            for source, target in targets.items():
                mine = [d for d, r in before.items() if r["source"] == source]
                epochs = target // max(1, sum(words[d] for d in mine))
                assert all(epochs <= times[d] <= min(3, epochs + 1) or not words[d] for d in mine)
                assert abs(sum(words[d] * times[d] for d in mine) - target) <= max(words[d] for d in mine) / 2 + 1
        else:
            texts = sorted((r["doc_id"], r["text"]) for r in before)
            assert texts == sorted((r["doc_id"], decode(load(), __import__("numpy").array(r["ids"], "int32"))) for r in rows)
            assert all(r["round_trip"] for r in rows)
        docs = out
    assert 0 < kept["ngram_jaccard_join"] <= kept["quality_classifier"] < 200


def test_run_equals_the_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns[0] == "doc_id" and got.count() > 50


def test_stages_on_odd_rows(spark):
    shape = "doc_id long, text string, source string, n_chars long, size long, kind int"
    rows = [(1, "a b c d e f", "s", 11, 0, 0), (1, "a b c d e f", "s", 11, 0, 0), (2, "a b c d e f", None, 11, 0, 0), (None, "x", None, 1, 0, 0), (3, None, "s", None, None, None), (4, "", "t", 0, 0, 0)]
    docs = spark.createDataFrame(rows, shape)
    one = drop_copies(docs)
    assert one.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in one.collect()) == [0, 1, 3, 4]
    mixed = mix_documents(docs)
    assert mixed.columns == docs.columns
    sizes = sum(len(WORD.findall(r["text"])) for r in mixed.collect())
    assert abs(sizes - 19) <= 6 and sum(r["taken"] for r in mix(docs).collect()) == 19
    empty = spark.createDataFrame([], shape)
    assert drop_copies(empty).collect() == [] and mix_documents(empty).collect() == []
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).collect() == [], name
        assert stage(spark, docs, SF).count() >= 1, name


def test_copies_are_dropped_by_row_and_component(spark):
    copy, other = "a copy of the text of three", "a text that nothing else is like"
    rows = [(3, copy), (5, copy), (5, other), (6, other), (6, other), (None, copy), (None, "only here and without id"), (None, "only here and without id"), (7, "x"), (7, ""), (7, ""), (None, "")]
    kept = drop_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(3, copy), (5, other), (None, "only here and without id"), (7, "x"), (7, ""), (None, "")]
    assert sorted(map(repr, map(tuple, kept))) == sorted(map(repr, want))
