"""Spelling variants against plain comparisons of all words."""

import random
import re
import zlib
from collections import Counter

from layerloom.llm.spelling import PositionIndex, group_variants, near_pairs, occurrences, spelling_variants


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def some_words(rng, n, letters, longest=9, shortest=1):
    return sorted({"".join(rng.choices(letters, k=rng.randint(shortest, longest))) for _ in range(n)})


def plain(counts, ratio=5):
    form, out = {}, {}
    for w, n in counts.items():
        others = [o for o in counts if near(w, o)]
        best = min(((-counts[o], o) for o in others), default=None)
        form[w] = best[1] if best and -best[0] >= ratio * n else None
        out[w] = (len(others), form[w], -best[0] if form[w] else None)
    rows = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, out[w][1], root, n, out[w][0], out[w][2]))
    return sorted(rows)


def test_index_equals_comparison():
    rng = random.Random(0)
    for letters in ("ab", "abcé", "aàÿ÷"):
        words = some_words(rng, 300, letters, 7, 0)
        index = PositionIndex(words)
        for query in words + some_words(rng, 100, letters, 9, 0) + [""]:
            assert [words[i] for i in index.near(query)] == [w for w in words if near(w, query)]


def test_pairs_once_in_any_block_size(spark):
    rng = random.Random(2)
    words = some_words(rng, 600, "abcd", 8, 2)
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long")
    want = sorted((a, b) for a in words for b in words if near(a, b))
    for block in (16, 10**6):
        rows = near_pairs(df, block).collect()
        assert sorted((r["word"], r["other"]) for r in rows) == want
        assert all(words[r["n"]] == r["word"] and words[r["other_n"]] == r["other"] for r in rows)


def test_forms_and_roots(spark):
    rng = random.Random(4)
    words = some_words(rng, 400, "abc", 7, 3)
    counts = {w: rng.choice([1, 2, 5, 10, 25, 50, 125, 625]) for w in words}
    chain = {"zzzzzzzz" + "y" * i: 5**i for i in range(9)}
    counts |= chain
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = group_variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert sorted((tuple(r) for r in got)) == plain(counts)
    assert {r["root"] for r in got if r["word"] in chain} == {"zzzzzzzz" + "y" * 8}


def test_ties_go_to_the_smaller_word(spark):
    df = spark.createDataFrame([("abcdef", 1), ("abcdeg", 50), ("abcdeé", 50), ("abcdea", 50)], "word string, n long")
    got = {r["word"]: r for r in group_variants(df).collect()}
    assert (got["abcdef"]["form"], got["abcdef"]["n_near"], got["abcdef"]["form_n"]) == ("abcdea", 3, 50)
    assert got["abcdea"]["form"] is None and got["abcdea"]["root"] == "abcdea"


def test_occurrences_and_defined_cases(spark):
    rng = random.Random(6)
    words = ["Straße", "ÉCOLE", "letters", "x", "naïve" * 40, "a×b÷cdef", "Ünder"]
    docs = [(i if i % 7 else None, " ".join(rng.choices(words, k=40)) + rng.choice(["", "-1", "😀end"]), i) for i in range(300)]
    docs += [(5, None, 0), (6, "", 0), (8, "repeat " * 50_000, 0)]
    want = Counter()
    for doc_id, text, _ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            word = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run
            if len(word) >= 6:
                want[word] += 1
    df = spark.createDataFrame(docs, "doc_id long, text string, n int")
    assert {r["word"]: r["n"] for r in occurrences(df, counted=20).collect()} == want
    got = sorted(tuple(r) for r in spelling_variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect())
    assert got == plain({w: n for w, n in want.items() if n >= 5})
    assert spelling_variants(df.limit(0)).collect() == []
