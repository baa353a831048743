"""The shingle join against brute force over all pairs."""

import random

import numpy as np
import pytest

from layerloom.llm.components import components
from layerloom.llm.partenum import Limits, WordHashes, join_documents, may_link, shingles, signatures, similar, sketch

DOCS = "doc_id long, text string, key long, n int"


def plain_set(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else " " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """(doc_id, set size, least id reachable) per row, by all pairs that share a shingle."""
    sets = [plain_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    pairs = {(a, b) for w in where.values() for k, a in enumerate(w) for b in w[k + 1 :]}
    for a, b in pairs:
        if root(a) != root(b) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at, kind = rng.randrange(len(words)), rng.random()
        if kind < 0.4:
            words[at] = f"new{rng.randrange(10**6)}"
        elif kind < 0.7:
            words.insert(at, f"add{rng.randrange(10**6)}")
        elif len(words) > 6:
            del words[at]
    return " ".join(words)


def made_rows(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for size in (1, 2, 4, 5, 6, 7, 9, 12, 20, 33, 60, 100, 250, 700):
        base = rng.choices(vocabulary, k=size)
        rows += [" ".join(base)] * rng.randint(1, 3)
        rows += [edited(rng, base, rng.randint(0, 1 + size // 25)) for _ in range(12)]
    hub = rng.choices(vocabulary, k=120)
    rows += [edited(rng, hub, rng.randint(0, 6)) for _ in range(150)]
    passage = " ".join(rng.choices(vocabulary, k=60))
    rows += [passage + " " + " ".join(rng.choices(vocabulary, k=rng.randint(3, 40))) for _ in range(80)]
    rows += [None, "", " \t\n", "One TWO three", "one two\tthree", "É a b c d e", "é a b c d e", "word " * 9000]
    ids = rng.sample(range(10_000), len(rows))
    return list(zip(ids, rows, strict=True)) + [(ids[0], rows[3]), (None, rows[5]), (None, None), (None, "lonely words that nobody else has here")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in rows], DOCS)


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1])
def test_components_equal_brute_force(spark, seed):
    rows = made_rows(seed)
    assert result(join_documents(frame(spark, rows))) == brute(rows)


def test_combined_and_blocked_groups_equal_brute_force(spark):
    rows = made_rows(3)
    assert result(join_documents(frame(spark, rows), Limits(flush=2000, hot=3, small=3, block=4))) == brute(rows)


def test_the_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert result(join_documents(docs)) == brute(rows)


def test_empty_table(spark):
    assert join_documents(frame(spark, [])).collect() == []


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(0)
    seen = 0
    for _ in range(1500):
        one = np.unique(rng.integers(0, 2**63, int(np.exp(rng.uniform(np.log(4), np.log(2000)))), dtype=np.uint64))
        kept = one[rng.integers(0, len(one) // 5 + 1) :]
        room = int(len(kept) / 0.8) - len(one)
        two = np.unique(np.concatenate([kept, rng.integers(0, 2**63, rng.integers(0, room + 1) if room > 0 else 0, dtype=np.uint64)]))
        if np.array_equal(one, two) or not similar(len(np.intersect1d(one, two)), len(one), len(two)):
            continue
        seen += 1
        found, owner = signatures(np.concatenate([one, two]), np.array([len(one), len(two)]))
        assert np.intersect1d(found[owner == 0], found[owner == 1]).size
        assert may_link(sketch(one), sketch(two), len(one), len(two))
    assert seen > 1000


def test_shingles_are_told_apart():
    h = WordHashes()
    assert len(shingles("a b c d e f", h)) == 2
    assert len(shingles("A b", h)) == 1 and shingles("A b", h)[0] == shingles("a\nB", h)[0] != shingles("b a", h)[0]
    assert len(shingles("a a a a a a a a", h)) == 1 != len(shingles(None, h))
    assert shingles("x x x x", h)[0] != shingles("x x x x x", h)[0]


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, 1000 + i) for i in range(50)] + [(2000, 1003), (5, 2000), (9, 9)]
    edges = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in chain + star]
    got = {r["u"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 100 for i in range(101, 161)} | {i: 5 for i in [7, 2000, *range(1000, 1050)]}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
