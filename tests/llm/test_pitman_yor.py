"""The language model: base scores, normalised predictions, sampling, perplexity."""

import collections
import itertools
import math
import zlib

import numpy as np
import pytest

from layerloom.llm import pitman_yor as P
from layerloom.llm.pitman_yor import log_stirling, parent_of, sample_tables, score_documents

DOCS = "doc_id long, text string, score double, held boolean"


def tokens(text):
    return (text or "").encode().lower().split() + [None]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def check_base(rows, got):
    count = collections.Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(count.values()), len(count)
    want = []
    for i, t in rows:
        w = tokens(t)
        want.append((repr(i), held(i), len(w), sum(count[x] > 0 for x in w), n, math.fsum(math.log10((count[x] + 1) / (n + v + 1)) for x in w)))
    have = [(repr(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got]
    for a, b in zip(sorted(want), sorted(have), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-9, rel=1e-9)


def test_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = score_documents(docs).collect()
    check_base(rows, got)
    out = [r for r in got if r["held_out"]]
    n = sum(r["n_tokens"] for r in out)
    base, model = (10 ** (-sum(r[c] for r in out) / n) for c in ("base_score", "score"))
    assert model < 0.6 * base
    again = {r["doc_id"]: r["score"] for r in score_documents(docs.repartition(3)).collect()}
    assert len(again) == len(got)


def test_odd_rows(spark):
    rows = [(i, t) for i, t in enumerate([None, "", " ", "A b a B", "É é", "x " * 30_000, "a b", "unseen words only here"])]
    rows += [(None, "a b"), (3, "A b a B"), (3, "other text")] + [(100 + i, "hot pair " * 20) for i in range(60)]
    for slices in (None, 7):
        got = score_documents(spark.createDataFrame([(i, t, 0.0, True) for i, t in rows], DOCS), slices=slices).collect()
        check_base(rows, got)
        assert all(math.isfinite(r["score"]) and r["score"] <= 1e-9 for r in got)
    assert score_documents(spark.createDataFrame([], DOCS)).collect() == []
    only = next(i for i in range(100) if held(i))
    (r,) = score_documents(spark.createDataFrame([(only, "a b", 0.0, True)], DOCS)).collect()
    assert (r["n_known"], r["train_tokens"], r["base_score"], r["score"]) == (0, 0, 0.0, 0.0)


def plain_counts(rows):
    train = [t for i, t in rows if not held(i)]
    return collections.Counter(p for t in train for p in itertools.pairwise([0, *tokens(t)]))


def token_hash(token):
    return 0 if token == 0 else P.TokenHashes()[token or b""]


def kept_seatings(spark, monkeypatch, rows, sweeps, burn_in):
    """Scores, and the state, lexicon and sums that they come from."""
    seen = {}
    real = P.seatings

    def spy(store, facts, *args):
        state, lexicon, found = real(store, facts, *args)
        kept = [c for k in range(burn_in + 1, sweeps + 1) for c in P.kept_columns(k)]
        seen["state"] = store.read(state, P.STATE).collect()
        seen["lexicon"] = store.read(lexicon, P.WORDS + "".join(f", {c} long" for c in kept)).collect()
        seen["sums"] = found
        return state, lexicon, found

    monkeypatch.setattr(P, "seatings", spy)
    got = score_documents(spark.createDataFrame(rows, "doc_id long, text string"), sweeps, burn_in, slices=3).collect()
    return {r["doc_id"]: r["score"] for r in got}, seen


@pytest.mark.parametrize("sweeps, burn_in", [(1, 0), (3, 1)])
def test_scores_follow_from_the_seatings(spark, monkeypatch, sweeps, burn_in):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{j}" for j in rng.zipf(1.4, 60) % 40)) for i in range(80)]
    pairs = plain_counts(rows)
    scores, seen = kept_seatings(spark, monkeypatch, rows, sweeps, burn_in)
    kept = range(burn_in + 1, sweeps + 1)
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    state = {(r["word"], r["context"]): r for r in seen["state"]}
    words = {r["h"]: r for r in seen["lexicon"]}
    assert {k: r["count"] for k, r in state.items()} == {(signed(token_hash(w)), signed(token_hash(c))): n for (c, w), n in pairs.items() if n > 1}
    for r in seen["state"]:
        assert 1 <= r["tables"] <= r["count"] and len(kept) <= r["kept"] <= len(kept) * r["count"]
    assert seen["sums"][0].tokens == sum(pairs.values())
    # the last seating's tables are what the lexicon has
    dish = collections.Counter()
    for (c, w), n in pairs.items():
        dish[signed(token_hash(w))] += state[signed(token_hash(w)), signed(token_hash(c))]["tables"] if n > 1 else 1
    assert all(words[h]["dish"] == n for h, n in dish.items())
    assert sum(r["top"] for r in words.values()) == seen["sums"][-1].top_tables
    low, high = seen["sums"][0].discounts
    for i, t in rows:
        log = 0.0
        for c, w in itertools.pairwise([0, *tokens(t)]):
            hw, hc, n = signed(token_hash(w)), signed(token_hash(c)), pairs[c, w]
            laid = state[hw, hc]["kept"] if n > 1 else len(kept) * min(n, 1)
            p = len(kept) * n - low * laid
            for k, sums in zip(kept, seen["sums"], strict=True):
                word = words.get(hw)
                parent = parent_of(word[f"dish_{k}"] if word else 0, word[f"top_{k}"] if word else 0, sums.tables, sums.top_tables, sums.known, high)
                p += (1 + low * (words[hc][f"laid_{k}"] if hc in words else 0)) * parent
            log += math.log10(p / len(kept) / (1 + (words[hc]["guests"] if hc in words else 0)))
        assert scores[i] == pytest.approx(log, rel=1e-9)


def test_predictions_sum_to_one(spark, monkeypatch):
    # held-out texts "w3 x" for every known word x and an unknown one; "w3" alone is followed by the end
    vocabulary = [f"w{j}" for j in range(12)]
    rng = np.random.default_rng(0)
    out, kept = (i for i in range(100_000) if held(i)), (i for i in range(100_000) if not held(i))
    rows = [(next(kept), " ".join(rng.choice(vocabulary, 30))) for _ in range(40)]
    asked = {(a, b): (next(out), f"{a} {b}") for a in ["w3"] for b in [*vocabulary, "unknown"]}
    singles = {w: (next(out), w) for w in [*vocabulary, "unknown"]}
    scores, seen = kept_seatings(spark, monkeypatch, rows + list(asked.values()) + list(singles.values()), 2, 0)
    words = {r["h"]: r for r in seen["lexicon"]}
    known = len([r for r in words.values() if r["n"] > 0])
    assert known == 13  # with the end
    # P(x | w3) P(end | x) from "w3 x", P(x | start) P(end | x) from "x": their ratio times P(x | start) is P(x | w3)
    ratios = {b: 10 ** (scores[i] - scores[singles[b][0]]) for (_, b), (i, _) in asked.items()}
    low, high = seen["sums"][0].discounts
    pairs = plain_counts(rows)
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    state = {(r["word"], r["context"]): r for r in seen["state"]}

    def p(c, w):
        hw, hc, n = signed(token_hash(w)), signed(token_hash(c)), pairs[c, w]
        total = 2 * n - low * (state[hw, hc]["kept"] if n > 1 else 2 * min(n, 1))
        for k, sums in zip((1, 2), seen["sums"], strict=True):
            word = words.get(hw)
            parent = parent_of(word[f"dish_{k}"] if word else 0, word[f"top_{k}"] if word else 0, sums.tables, sums.top_tables, sums.known, high)
            total += (1 + low * words[hc][f"laid_{k}"]) * parent
        return total / 2 / (1 + words[hc]["guests"])

    tokens_ = [*(w.encode() for w in vocabulary), None, b"unknown"]
    for context in (0, b"w3"):
        assert sum(p(context, w) for w in tokens_) == pytest.approx(1)
    for b, ratio in ratios.items():  # "w3 x" against "x": P(w3 | start) P(x | w3) / P(x | start)
        assert ratio == pytest.approx(p(0, b"w3") * p(b"w3", b.encode()) / p(0, b.encode()))


def plain_sampler(pairs, discounts, sweeps, rng):
    """A sequential Gibbs sampler over all customers: each leaves and is seated again, given all others as they are now."""
    low, high = discounts
    known = len({w for _, w in pairs})
    tables = {p: [n] for p, n in pairs.items()}
    top = collections.defaultdict(list)
    for _, w in pairs:
        top[w] = [top[w][0] + 1] if top[w] else [1]
    laid, guests = collections.Counter(c for c, _ in pairs), collections.Counter()
    for (c, _), n in pairs.items():
        guests[c] += n
    sizes = lambda: (sum(map(len, top.values())), sum(map(sum, top.values())))
    top_tables, everyone = sizes()
    means = []
    for sweep in range(sweeps):
        for (c, w), n in pairs.items():
            for _ in range(n):
                own, up = tables[c, w], top[w]
                at = rng.choice(len(own), p=np.array(own) / sum(own))
                own[at] -= 1
                if not own[at]:
                    own.pop(at)
                    laid[c] -= 1
                    j = rng.choice(len(up), p=np.array(up) / sum(up))
                    up[j] -= 1
                    everyone -= 1
                    if not up[j]:
                        up.pop(j)
                        top_tables -= 1
                fresh_top = (1 + high * top_tables) / (known + 1)
                parent = (sum(up) - high * len(up) + fresh_top) / (1 + everyone)
                weights = np.array([k - low for k in own] + [(1 + low * laid[c]) * parent])
                at = rng.choice(len(weights), p=weights / weights.sum())
                if at < len(own):
                    own[at] += 1
                    continue
                own.append(1)
                laid[c] += 1
                weights = np.array([k - high for k in up] + [fresh_top])
                j = rng.choice(len(weights), p=weights / weights.sum())
                everyone += 1
                if j < len(up):
                    up[j] += 1
                else:
                    up.append(1)
                    top_tables += 1
        if sweep >= sweeps // 2:
            means.append((everyone, top_tables))
    return np.mean(means, axis=0)


def test_seating_is_near_a_sequential_sampler(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{j}" for j in rng.zipf(1.5, 40) % 20)) for i in range(40)]
    pairs = plain_counts(rows)
    _, seen = kept_seatings(spark, monkeypatch, rows, 8, 3)
    everyone, top = plain_sampler(pairs, seen["sums"][0].discounts, 40, rng)
    mine = np.mean([(s.tables, s.top_tables) for s in seen["sums"]], axis=0)
    assert mine[0] == pytest.approx(everyone, rel=0.15)
    assert mine[1] == pytest.approx(top, rel=0.25)


def test_stirling_numbers_count_seatings():
    d = 0.3
    table = np.exp(log_stirling(d, 6))

    def partitions(n):
        if n == 0:
            yield []
            return
        for p in partitions(n - 1):
            for i in range(len(p)):
                yield [*p[:i], p[i] + 1, *p[i + 1 :]]
            yield [*p, 1]

    for n, t in itertools.product(range(1, 7), range(1, 7)):
        weight = sum(math.prod(math.prod(k - d for k in range(1, size)) for size in p) for p in partitions(n) if len(p) == t)
        assert table[n, t] == pytest.approx(weight, abs=1e-12)


def test_samples_follow_the_conditional():
    d, strength, base, others, c, m = 0.5, 1.0, 0.2, 4.0, 5, 20_000
    stirling = log_stirling(d)
    got = np.bincount(sample_tables(np.full(m, c), np.full(m, others), np.full(m, base), d, strength, stirling, P.Draws(np.arange(m, dtype=np.uint64), 0)), minlength=c + 1)[1:] / m
    want = np.array([math.exp(stirling[c, t]) * base**t * math.prod(strength + d * (others + j) for j in range(t)) for t in range(1, c + 1)])
    assert np.allclose(got, want / want.sum(), atol=0.015)


@pytest.mark.parametrize("discount", [0.3, 0.5, 0.8])
def test_many_customers_are_near_the_conditional(monkeypatch, discount):
    c, m = 300, 2000
    stirling = log_stirling(discount, c)
    monkeypatch.setattr(P, "EXACT", 100)
    for base, others in itertools.product((0.0005, 0.02), (1.0, 60.0, 1000.0)):
        t = np.arange(1, c + 1)
        log = stirling[c, 1:] + np.cumsum(np.log(1 + discount * (others + np.arange(c)))) + t * math.log(base)
        weight = np.exp(log - log.max())
        got = sample_tables(np.full(m, c), np.full(m, others), np.full(m, base), discount, 1.0, stirling, P.Draws(np.arange(m, dtype=np.uint64), 0))
        assert got.min() >= 1 and got.max() <= c
        assert got.mean() == pytest.approx((weight * t).sum() / weight.sum(), rel=0.08)


def test_every_context_is_its_own_restaurant(spark):
    # more contexts than 16 bits tell apart; before any sweep all is exact: a table for each pair
    rows = [(i, " ".join(f"c{j} w{j % 7}" for j in range(1000 * i, 1000 * i + 1000))) for i in range(90)]
    rows += [(1000 + i, "hot " * 200) for i in range(20)]  # a word that holds much of all tokens
    train = [t for i, t in rows if not held(i)]
    pairs = collections.Counter(p for t in train for p in itertools.pairwise([0, *tokens(t)]))
    words, guests, laid, customers = (collections.Counter() for _ in range(4))
    for (c, w), k in pairs.items():
        words[w] += k
        guests[c] += k
        laid[c] += 1
        customers[w] += 1
    assert len(guests) > 1 << 16
    rate = lambda x: min(0.95, max(0.05, x[1] / (x[1] + 2 * x[2])))
    low, high = rate(collections.Counter(pairs.values())), rate(collections.Counter(customers.values()))

    def p(c, w):
        parent = (customers[w] - high * (w in words) + (1 + high * len(words)) / (len(words) + 1)) / (1 + len(pairs))
        return (pairs[c, w] - low * ((c, w) in pairs) + (1 + low * laid[c]) * parent) / (1 + guests[c])

    got = score_documents(spark.createDataFrame(rows, "doc_id long, text string"), sweeps=0, burn_in=-1)
    got = {r["doc_id"]: r["score"] for r in got.collect()}
    for i, t in rows:
        assert got[i] == pytest.approx(math.fsum(math.log10(p(*x)) for x in itertools.pairwise([0, *tokens(t)])), rel=1e-9), i


def test_a_hot_word_travels_once_per_block():
    texts = [P.token_hashes("hot pair " * 500, P.TokenHashes()) for _ in range(300)]
    row = P.pack_block(texts, [i % 3 == 0 for i in range(300)])
    block = P.Block(row["a"], row["b"], row["c"], row["d"])
    assert len(block.words) == 4 and len(block.hash) == 4  # four distinct pairs, however many texts have them
    assert sorted(block.train()) == [200, 200, 200 * 499, 200 * 500]
    assert np.bincount(block.pair).sum() == 300 * 1001
    assert sum(j - i for _, i, j in P._slices(block.hash, 1000)) == 4


def test_numbers_come_back():
    for top in (0, 255, 256, 65_535, 65_536, 1 << 32, 1 << 40):
        x = np.array([0, top // 2, top])
        assert P.numbers(P.packed_numbers(x)).tolist() == x.tolist()
    assert P.numbers(P.packed_numbers(np.zeros(0, int))).tolist() == []
    frames = [np.arange(5), np.zeros(0, int), np.array([1 << 20])]
    assert [x.tolist() for x in P._unframed(b"".join(map(P._framed, frames)))] == [f.tolist() for f in frames]


def test_words_of_a_batch_are_hashed_once(monkeypatch):
    texts = [None, "", " ", "A b a B", "\tÉ é\x0b x\n", "one " + "two three " * 50, " end\r\f", "a\x1cb c d"] * 20
    plain = [P.token_hashes(t, P.TokenHashes()) for t in texts]
    asked, real = [], P.xxhash.xxh64_intdigest
    monkeypatch.setattr(P, "CACHED_WORDS", 2, raising=False)
    monkeypatch.setattr(P.xxhash, "xxh64_intdigest", lambda word: asked.append(word) or real(word))
    monkeypatch.setattr(P, "TaskContext", type("Task", (), {"get": staticmethod(lambda: type("T", (), {"partitionId": lambda self: 0})())}))
    schema = P.pa.schema([("block", P.pa.int64()), ("doc_ids", P.pa.list_(P.pa.int64())), *((c, P.pa.binary()) for c in "abcd")])
    batch = P.pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts, "held": [False] * len(texts)})
    (block,) = (r for b in P._packer(schema)(iter([batch.slice(0, 0), batch])) for r in b.to_pylist())
    spellings = {w for t in texts for w in (t or "").encode().split()}
    assert len(asked) <= len(spellings) + 1 and {*asked} - {b""} == {w.lower() for w in spellings}
    for n in (0, 3, 7, 100):  # slices of a column
        assert [x.tolist() for x in P.batch_hashes(batch["text"].slice(n, 40))] == [x.tolist() for x in plain[n : n + 40]]
    made = P.Block(block["a"], block["b"], block["c"], block["d"])
    assert made.sizes.tolist() == [len(t) for t in plain]
    flat = np.concatenate(plain)
    assert (made.words[made.word][made.pair] == flat).all()
    assert (made.hash[:-1] <= made.hash[1:]).all() and (made.hash == P.pair_hash(made.words[made.word], made.words[made.context])).all()


def test_orders_where_upper_bits_do_not_tell_hashes_apart():
    rng = np.random.default_rng(3)
    for h in (rng.integers(0, 9, 500, dtype=np.uint64), rng.integers(0, 2**64, 5000, dtype=np.uint64), np.array([], np.uint64), np.repeat(rng.integers(0, 2**64, 50, dtype=np.uint64), 7)):
        order = P.sorted_order(h)
        assert (order == np.argsort(h, kind="stable")).all()
        first, number = P.distinct(h[order])
        assert (h[order][first] == np.unique(h)).all() and (h[order][first][number] == h[order]).all()


def test_words_of_a_block_take_less_than_their_hashes():
    rng = np.random.default_rng(5)
    words = rng.integers(1, 2**64, 100_000, dtype=np.uint64)
    row = P.pack_block([words], [0])
    assert len(row["a"]) < 7 * len(words)
    for h in (np.sort(words), np.array([], np.uint64), np.array([0, 0, 2**64 - 1], np.uint64)):
        assert (P.hashes(P.packed_hashes(h)) == h).all()
