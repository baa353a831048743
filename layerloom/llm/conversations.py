"""Conversation structure repair by a persistent audit DP.

A repaired conversation has role initials ``(s?(ua)+)?``. A row is kept (K, cost 0), given the role user or assistant
(R, 1) or deleted (D, 2; required for blank and duplicate rows); rows without text can be inserted anywhere (I, 5); a
truncated row that stays costs 5 more. The audit is the cheapest string of these letters, the ASCII-least of equal ones.

The DP keeps the best audit for each of four states: nothing yet, or the last row is system, user or assistant. Audits
are linked nodes, one per letter, that share their prefixes. A node knows its depth, the rolling hash of its prefix and
its ancestors 1, 2, 4, ... letters back. Two audits of equal cost are compared at their longest common prefix, found by
binary lifting over hashes; a prefix that hashes alike but is another node is read letter by letter, so a collision
costs time and never a wrong answer. Two audits of one state and row differ before either ends (an audit that
continues another by insertions costs more), so the smaller stays smaller however both go on.

Rows are dealt by conversation, sorted, and stream through a task: no conversation is held whole. States that cannot
win any more are dropped, and what all others share is final: its letters are written out, its rows hashed and its
nodes forgotten. So memory follows the unresolved end of a conversation, plus one byte a row for its audit. Sorting
and the search for earlier equal rows are Spark's and spill. SHA-256 of one conversation has to be computed in sequence.

Defined cases: null id, turn, role and text; an empty role has no initial and is never a legal neighbour; the null id
is a conversation of its own; rows of one turn are ordered by role, then text; a repeated row is a duplicate; very
long texts are read whole; an empty table gives no rows; extra columns are ignored, and none can clash, as four are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerloom.llm.common import WORD

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
#: Nodes that a conversation may have before those that are final are looked for.
NODES = 4096
BASE, PRIME = 1_000_003, (1 << 61) - 1


class Nodes:
    """Audits as linked letters; node 0 is the empty audit."""

    def __init__(self, base: int = BASE, prime: int = PRIME):
        self.base, self.prime = base, prime
        self.letter, self.depth, self.hash, self.up = [""], [0], [0], [()]

    def add(self, parent: int, letter: str) -> int:
        at = len(self.letter)
        self.letter.append(letter)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * self.base + ord(letter)) % self.prime)
        up, k = [parent], 0
        while k < len(self.up[up[k]]):
            up.append(self.up[up[k]][k])
            k += 1
        self.up.append(tuple(up))
        return at

    def parent(self, node: int) -> int:
        return self.up[node][0]

    def ancestor(self, node: int, depth: int) -> int:
        back, k = self.depth[node] - depth, 0
        while back:
            if back & 1:
                node = self.up[node][k]
            back >>= 1
            k += 1
        return node

    def _equal(self, a: int, b: int) -> bool:
        """Whether two prefixes of one length are the same, whatever their hashes say."""
        if self.hash[a] != self.hash[b]:
            return False
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = self.parent(a), self.parent(b)
        return True

    def parting(self, a: int, b: int) -> tuple[int, int]:
        """The first letters in which two audits of one length differ, as nodes; equal ones give one node twice."""
        if self._equal(a, b):
            return a, a
        for k in range(len(self.up[a]) - 1, -1, -1):
            if k < len(self.up[a]) and not self._equal(self.up[a][k], self.up[b][k]):
                a, b = self.up[a][k], self.up[b][k]
        return a, b

    def less(self, a: int, b: int) -> bool:
        """Whether audit ``a`` sorts before ``b``."""
        if a == b:
            return False
        depth = min(self.depth[a], self.depth[b])
        x, y = self.parting(self.ancestor(a, depth), self.ancestor(b, depth))
        return self.letter[x] < self.letter[y] if x != y else self.depth[a] < self.depth[b]

    def shared(self, nodes: Iterable[int]) -> int:
        """The deepest node that all these have behind them."""
        first, *rest = nodes
        for node in rest:
            depth = min(self.depth[first], self.depth[node])
            first, node = self.ancestor(first, depth), self.ancestor(node, depth)
            if first != node:
                for k in range(len(self.up[first]) - 1, -1, -1):
                    if k < len(self.up[first]) and self.up[first][k] != self.up[node][k]:
                        first, node = self.up[first][k], self.up[node][k]
                first = self.parent(first)
        return first

    def letters(self, node: int, stop: int = 0) -> list[int]:
        """The nodes after ``stop`` up to ``node``, in order."""
        out = []
        while node != stop:
            out.append(node)
            node = self.parent(node)
        return out[::-1]


class Repair:
    """The DP over one conversation, row by row; ``write(edit, role, text)`` takes each repaired or deleted row."""

    def __init__(self, write: Callable[[str, str, str], None], nodes: int = NODES):
        self.write, self.limit = write, nodes
        self.nodes = Nodes()
        self.best: dict[int, tuple[int, int]] = {NOTHING: (0, 0)}  # state -> cost, node
        self.rows: list[tuple[str, str]] = []  # not yet written
        self.last = NOTHING  # of the rows written

    def _offer(self, best: dict[int, tuple[int, int]], state: int, cost: int, parent: int, letter: str) -> None:
        known = best.get(state)
        if known is None or cost < known[0]:
            best[state] = (cost, self.nodes.add(parent, letter))
        elif cost == known[0]:
            node = self.nodes.add(parent, letter)
            if self.nodes.less(node, known[1]):
                best[state] = (cost, node)

    def _inserted(self) -> dict[int, tuple[int, int]]:
        """States before the next row, after insertions."""
        best = dict(self.best)
        for state in (NOTHING, SYSTEM, ASSISTANT):
            if state in self.best:
                cost, node = self.best[state]
                self._offer(best, USER, cost + INSERT, node, "I")
        if USER in best:
            cost, node = best[USER]
            self._offer(best, ASSISTANT, cost + INSERT, node, "I")
        return best

    def add(self, role: str, text: str, required: bool, truncated: bool) -> None:
        before, after = self._inserted(), {}
        initial, more = role[:1], TRUNCATED if truncated else 0
        for state, (cost, node) in before.items():
            self._offer(after, state, cost + DELETE, node, "D")
            if required:
                continue
            follows = ASSISTANT if state == USER else USER
            if initial == ("a" if follows == ASSISTANT else "u"):
                self._offer(after, follows, cost + KEEP + more, node, "K")
            elif initial == "s" and state == NOTHING:
                self._offer(after, SYSTEM, cost + KEEP + more, node, "K")
            self._offer(after, follows, cost + REROLE + more, node, "R")
        self.rows.append((role, text))
        self.best = self._hopeful(after)
        if len(self.nodes.letter) > self.limit:
            self._settle()

    @staticmethod
    def _hopeful(best: dict[int, tuple[int, int]]) -> dict[int, tuple[int, int]]:
        """Without states that another one beats however the conversation goes on.

        After an assistant row all can follow that can after a system row; nothing yet differs only by a kept system
        row, which could be deleted instead; an insertion leads from a user to an assistant row and back.
        """
        if ASSISTANT in best:
            least = best[ASSISTANT][0]
            spare = {SYSTEM: 0, NOTHING: DELETE, USER: INSERT}
            best = {s: x for s, x in best.items() if s == ASSISTANT or x[0] <= least + spare[s]}
            if USER in best and least > best[USER][0] + INSERT:
                del best[ASSISTANT]
        return best

    def _settle(self) -> None:
        """Write what all states share, and keep only the nodes after it."""
        old, root = self.nodes, self.nodes.shared(n for _, n in self.best.values())
        self._emit(old.letters(root))
        self.nodes, moved = Nodes(old.base, old.prime), {root: 0}
        for state, (cost, node) in self.best.items():
            for n in old.letters(node, root):
                if n not in moved:
                    moved[n] = self.nodes.add(moved[old.parent(n)], old.letter[n])
            self.best[state] = (cost, moved[node])
        self.limit = max(self.limit, 2 * len(self.nodes.letter))

    def _emit(self, path: list[int]) -> None:
        done = 0
        for node in path:
            letter = self.nodes.letter[node]
            role, text = ("", "") if letter == "I" else self.rows[done]
            done += letter != "I"
            if letter != "D":
                self.last = SYSTEM if letter == "K" and role[:1] == "s" else ASSISTANT if self.last == USER else USER
                role = role if letter == "K" else ROLE_OF[self.last]
            self.write(letter, role, text)
        del self.rows[:done]

    def finish(self) -> int:
        """Write the rest; returns the cost."""
        ends = self._inserted()
        ended = [ends[s] for s in (NOTHING, ASSISTANT) if s in ends]
        cost, node = ended[0]
        for other, n in ended[1:]:
            if other < cost or other == cost and self.nodes.less(n, node):
                cost, node = other, n
        self._emit(self.nodes.letters(node))
        return cost


# Spark


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, gone``: rows with faults planted by the crc32 of ``conv_id:turn``, modulo 20.

    Nulls are one space, in the key too. 0 drops the row (``gone``), 1 empties its text, 2 removes ``.``, ``!`` and
    ``?``, 3 repeats it, 4 gives it the role user.
    """
    words = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(words("conv_id"), F.lit(":"), words("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", words("role").alias("role"), words("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") == 0).alias("gone"), times.alias("times")).select(
        "conv_id", "turn", "role", "text", "gone", F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("each")
    ).drop("each")


def sorted_rows(rows: DataFrame) -> DataFrame:
    """Rows dealt by conversation and sorted, with the flags ``blank, duplicate, truncated``: each row's first fault.

    One shuffle by conversation serves both the search for earlier equal rows and the order.
    """
    gone = F.col("gone") if "gone" in rows.columns else F.lit(False)
    words = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    dealt = rows.select("conv_id", "turn", words("role").alias("role"), words("text").alias("text"), gone.alias("gone")).repartition("conv_id")
    same = Window.partitionBy("conv_id", "gone", "role", F.sha2(F.col("text"), 256)).orderBy(F.col("turn").asc_nulls_first())
    faults = _faults(F.col("text"), F.col("earlier") > 1)
    flagged = dealt.withColumn("earlier", F.row_number().over(same)).withColumns(faults)
    return flagged.sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "earlier"
    ).drop("earlier")


def _faults(text: Column, repeated: Column) -> dict[str, Column]:
    blank = ~text.rlike(WORD)
    ended = text.rlike(r"[.!?][\x20\x09-\x0D]*\z")
    return {"blank": blank, "duplicate": ~blank & repeated, "truncated": ~blank & ~repeated & ~ended}


FIELDS = ("conv_id", "turn", "role", "text", "gone", "blank", "duplicate", "truncated")


def _stream(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch[c].to_pylist() for c in FIELDS), strict=True)


class _Facts:
    """Counts of one conversation's rows as they are."""

    def __init__(self):
        self.least = self.most = self.turn = None
        self.distinct = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.initial: str | None = None

    def add(self, turn, role: str, blank: bool, duplicate: bool, truncated: bool) -> None:
        if turn is not None and turn != self.turn:
            self.least = turn if self.least is None else self.least
            self.most = self.turn = turn
            self.distinct += 1
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        if self.initial is not None and self.initial + role[:1] not in LEGAL:
            self.illegal += 1
        self.initial = role[:1]

    @property
    def gaps(self) -> int:
        return 0 if self.least is None else self.most - self.least + 1 - self.distinct


_NONE = object()


def _conversations(batches: Iterable[pa.RecordBatch], begin: Callable[[object], Callable[[str, str, str], None]]) -> Iterator[tuple]:
    """``conv_id, facts, cost`` of each conversation of sorted rows, once its rows went to ``begin(conv_id)``."""
    current, repair, facts = _NONE, None, None
    for conv_id, turn, role, text, gone, blank, duplicate, truncated in _stream(batches):
        if current is _NONE or conv_id != current:
            if current is not _NONE:
                yield current, facts, repair.finish()
            current, repair, facts = conv_id, Repair(begin(conv_id)), _Facts()
        if not gone:
            facts.add(turn, role, blank, duplicate, truncated)
            repair.add(role, text, blank or duplicate, truncated)
    if current is not _NONE:
        yield current, facts, repair.finish()


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _arrow(df: DataFrame, fields: str) -> tuple[str, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = df.schema["conv_id"].dataType.simpleString()
    fields = f"conv_id {kind}, {fields}"
    return fields, to_arrow_schema(df.sparkSession.createDataFrame([], fields).schema)


def audit_conversations(rows: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``, one row per conversation.

    ``rows`` has ``conv_id, turn, role, text`` and may have ``gone``, for rows that only name their conversation.
    """
    counted = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    fields, schema = _arrow(rows, counted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit: bytearray = bytearray()
        digest = hashlib.sha256()
        first = True

        def begin(conv_id) -> Callable[[str, str, str], None]:
            nonlocal audit, digest, first
            audit, digest, first = bytearray(), hashlib.sha256(), True

            def write(edit: str, role: str, text: str) -> None:
                nonlocal first
                audit.append(ord(edit))
                if edit != "D":
                    digest.update(("" if first else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
                    first = False

            return write

        out: list[tuple] = []
        for conv_id, f, cost in _conversations(batches, begin):
            out.append((conv_id, f.gaps, f.blank, f.duplicate, f.truncated, f.illegal, cost, audit.decode(), digest.hexdigest()))
            if len(out) == 1000:
                yield _batch(out, schema)
                out = []
        if out:
            yield _batch(out, schema)

    return sorted_rows(rows).mapInArrow(run, fields)


def repaired_rows(rows: DataFrame) -> DataFrame:
    """``conv_id, position, role, text, edit``: the repaired conversations, row by row; deleted rows are left out."""
    fields, schema = _arrow(rows, "position long, role string, text string, edit string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def begin(conv_id) -> Callable[[str, str, str], None]:
            position = 0

            def write(edit: str, role: str, text: str) -> None:
                nonlocal position
                if edit != "D":
                    out.append((conv_id, position, role, text, edit))
                    position += 1

            return write

        for _ in _conversations(batches, begin):
            if len(out) >= 1000:
                yield _batch(out, schema)
                out.clear()
        if out:
            yield _batch(out, schema)

    return sorted_rows(rows).mapInArrow(run, fields)


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """The audits of damaged conversations: every original ``conv_id``, also where no row is left."""
    return audit_conversations(damage(conversations))
