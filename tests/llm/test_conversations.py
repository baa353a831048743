"""Audits against a search over all edits, and the defined cases."""

import hashlib
import itertools
import random
import re

import pytest

from layerloom.llm.conversations import Nodes, Repair, audit_conversations, damage, repaired_rows

GOOD = re.compile("(s?(ua)+)?")


def plain(rows, inserts=3):
    """Cheapest, then ASCII-least audit by trying everything; rows of (role, text, required, truncated)."""
    best = None
    for letters in itertools.product("KRD", repeat=len(rows)):
        if any(r[2] and c != "D" for r, c in zip(rows, letters, strict=True)):
            continue
        cost = sum({"K": 0, "R": 1, "D": 2}[c] + (5 if r[3] and c != "D" else 0) for r, c in zip(rows, letters, strict=True))
        for k in range(inserts + 1):
            if best and cost + 5 * k > best[0]:
                break
            for places in itertools.combinations_with_replacement(range(len(rows) + 1), k):
                audit, kept = "", []
                for i in range(len(rows) + 1):
                    for _ in range(places.count(i)):
                        audit, kept = audit + "I", kept + [("I", "", "")]
                    if i < len(rows):
                        audit += letters[i]
                        if letters[i] != "D":
                            kept.append((letters[i], *rows[i][:2]))
                initials = _initials(kept)
                if initials is not None and (best is None or (cost + 5 * k, audit) < best[:2]):
                    out = [(r if c == "K" else {"u": "user", "a": "assistant"}[x], t) for (c, r, t), x in zip(kept, initials, strict=True)]
                    best = (cost + 5 * k, audit, out)
    return best


def _initials(kept):
    for first in ("", "s"):
        want = first + "ua" * len(kept)
        want = want[: len(kept)]
        if GOOD.fullmatch(want) and all(
            (r[:1] == w) if c == "K" else w in "ua" for (c, r, _), w in zip(kept, want, strict=True)
        ):
            return want
    return None


def repaired(rows, **options):
    out = []
    repair = Repair(lambda *row: out.append(row), **options)
    for row in rows:
        repair.add(*row)
    cost = repair.finish()
    return cost, "".join(e for e, _, _ in out), [(r, t) for e, r, t in out if e != "D"]


@pytest.mark.parametrize("seed", range(60))
def test_audit_equals_search(seed):
    rng = random.Random(seed)
    rows = [
        (rng.choice(["user", "assistant", "system", "tool", "", "umpire"]), f"t{i}", rng.random() < 0.2, rng.random() < 0.2)
        for i in range(rng.randint(0, 5))
    ]
    assert repaired(rows) == plain(rows)


def test_settled_prefixes_change_nothing():
    rng = random.Random(5)
    rows = [(rng.choice(["user", "assistant", "system"]), str(i), rng.random() < 0.1, rng.random() < 0.1) for i in range(3000)]
    held = []
    out = []
    repair = Repair(lambda *row: out.append(row), nodes=64)
    for row in rows:
        repair.add(*row)
        held.append(len(repair.rows))
    assert (repair.finish(), "".join(e for e, _, _ in out)) == repaired(rows, nodes=10**9)[:2]
    assert max(held) < 200  # only the unresolved end is held


def test_colliding_hashes_are_verified():
    rng = random.Random(1)
    for base, prime in ((1, 2), (0, 5), (1_000_003, (1 << 61) - 1)):
        nodes = Nodes(base, prime)
        audits = {0: ""}
        for _ in range(400):
            parent = rng.choice(list(audits))
            letter = rng.choice("DIKR")
            audits[nodes.add(parent, letter)] = audits[parent] + letter
        for _ in range(2000):
            a, b = rng.choice(list(audits)), rng.choice(list(audits))
            assert nodes.less(a, b) == (audits[a] < audits[b])
            depth = rng.randint(0, nodes.depth[a])
            assert audits[nodes.ancestor(a, depth)] == audits[a][:depth]


def test_defined_cases(spark):
    rows = [
        (1, 0, "user", "Hi.", 0), (1, 2, "user", "Hi.", 0), (1, None, "system", "Be good!", 0), (1, 5, "assistant", "yes", 0),
        (None, 1, "user", "a?", 0), (None, 2, "assistant", "b" * 200_000 + ".", 0), (2, 1, None, None, 0), (3, 1, "", "x.", 0),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit int")
    got = {r["conv_id"]: r for r in audit_conversations(df).collect()}
    one = got[1]
    assert (one["gaps"], one["blank"], one["duplicate"], one["truncated"], one["illegal"]) == (3, 0, 1, 1, 1)
    assert (one["cost"], one["audit"]) == (6, "RRDD")
    assert one["repaired_sha256"] == hashlib.sha256(b"user:Be good!\nassistant:Hi.").hexdigest()
    assert got[None]["audit"] == "KK" and got[None]["cost"] == 0
    assert (got[2]["blank"], got[2]["audit"], got[2]["cost"]) == (1, "D", 2)
    assert got[2]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    assert (got[3]["audit"], got[3]["illegal"]) == ("D", 0)
    fixed = repaired_rows(df).filter("conv_id = 1").orderBy("position").collect()
    assert [(r["role"], r["edit"]) for r in fixed] == [("user", "R"), ("assistant", "R")]
    assert audit_conversations(df.limit(0)).collect() == []


def test_damage_keeps_every_conversation(spark):
    df = spark.range(400).selectExpr("id as conv_id", "0L as turn", "'user' as role", "'Hello. You!' as text")
    rows = damage(df)
    gone = {r["conv_id"] for r in rows.filter("gone").collect()}
    audits = {r["conv_id"]: r for r in audit_conversations(rows).collect()}
    assert len(audits) == 400 and gone
    for conv_id in gone:
        r = audits[conv_id]
        assert (r["audit"], r["cost"], r["gaps"], r["repaired_sha256"]) == ("", 0, 0, hashlib.sha256(b"").hexdigest())
    assert {r["text"] for r in rows.collect()} == {"Hello. You!", "Hello You", ""}


def test_a_conversation_with_a_third_of_all_rows(spark):
    many = spark.range(3000).selectExpr("7L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "concat('m', id, '.') as text")
    few = spark.range(6000).selectExpr("id + 10 as conv_id", "0L as turn", "'user' as role", "'q?' as text")
    got = audit_conversations(many.union(few)).filter("conv_id = 7").head()
    assert got["audit"] == "K" * 3000 and got["cost"] == 0
