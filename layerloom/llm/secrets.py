"""Secret scans: fixed credential patterns, and formats inferred from what they find.

Three base patterns find labelled credentials. From a bounded sample of distinct labelled
values, one automaton per kind is inferred (state merging after ALERGIA): a prefix tree with counts,
whose well visited states are merged while a Hoeffding test cannot tell their continuations and remaining lengths apart, and whose
rarely visited ones only at equal depth and remaining length, so that prefixes and lengths stay. Every other
run of 12 or more of the characters that labelled values have, and its parts between dots and equals signs of that
length, is then scored by its mean log likelihood per character under each automaton; of nested ones the outermost that fits counts.
A token is a finding of kind ``format`` if it fits a kind as well as all but the worst hundredth of the labelled values (each scored
without its own counts), and better than it fits the character pairs of all tokens that fit no kind.

Texts are scanned once by partition; spans and tokens are written, the sample (``SAMPLE``
values a kind, smallest hash first, of any length) and the counts of character pairs (at most 69 times 69) are all that reaches the driver.

Defined cases: null text counts as empty; texts are scanned whole; repeated rows and rows without id are scanned
each; extra columns are ignored by ``scan_secrets`` and kept by ``redact_secrets``. Without labelled values there
is no automaton and no ``format`` span; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from heapq import heappop, heappush
from itertools import pairwise

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.llm.common import written

KINDS = ("assign", "access", "hex", "format")
# Fixed patterns of the base kinds; the second number is the least length of what is measured.
ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18

# Candidates have the alphabet and the least length of labelled values.
TOKEN_LEAST = ASSIGN_LEAST
RUN = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % TOKEN_LEAST)
PARTS = re.compile(r"[^=]+=*"), re.compile(r"[^.=]+=*"), re.compile(r"[^.=]+")
SAMPLE = 1000
ALPHA = 0.05
LEAST_VISITS = 32
PRIOR = 2.0
SMOOTHING = 1e-3
WORST = 0.01
#: Characters of a symbol class, as what its likelihood loses when they share it.
CLASS_LOGS = {"U": math.log(26), "d": math.log(10), "h": math.log(6), "l": math.log(20)}

SCAN = "base array<struct<kind:int,start:int,end:int,value:string>>, tokens array<struct<start:int,end:int,value:string>>"


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """``(kind, start, end, credential)`` of the base kinds, leftmost and non-overlapping within a kind."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(0, m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(1, m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [(2, m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return found


def nested(run: str) -> list[tuple[int, int]]:
    """The run, and its parts: without the marks around it, between equals signs, and between dots; outer ones first."""
    found = {(0, len(run))}
    if "=" in run or "." in run:
        spans = [(0, len(run)), *(m.span() for parts in PARTS for m in parts.finditer(run))]
        for s, e in spans:
            s += len(run[s:e]) - len(run[s:e].lstrip(".="))
            found.add((s, s + len(run[s:e].rstrip("."))))
    return sorted((x for x in found if x[1] - x[0] >= TOKEN_LEAST), key=lambda x: (x[0], -x[1]))


def other_tokens(text: str, taken: list[tuple[int, int, int, str]]) -> list[tuple[int, int, str]]:
    """Runs of the labelled values' characters, and their parts, that touch no base span."""
    found = []
    spans = sorted((s, e) for _, s, e, _ in taken)
    starts = [s for s, _ in spans]
    reach, far = [], 0
    for _, e in spans:
        far = max(far, e)
        reach.append(far)
    for m in RUN.finditer(text):
        for s, e in nested(m[0]):
            start, at = m.start() + s, m.start() + e
            before = bisect_right(starts, at - 1)  # spans that begin before the token's end
            if not before or reach[before - 1] <= start:
                found.append((start, at, text[start:at]))
    return found


def scan_text(text: str | None) -> tuple[list, list]:
    base = base_spans(text or "")
    return base, other_tokens(text or "", base)


# Grammar inference


def symbols(value: str) -> str:
    """Character classes: U upper, d digit, h a-f, l g-z; other characters stand for themselves."""
    return "".join("d" if "0" <= c <= "9" else "U" if "A" <= c <= "Z" else "h" if "a" <= c <= "f" else "l" if "g" <= c <= "z" else c for c in value)


class Automaton:
    """A probabilistic automaton: per state its visits, ends, counted transitions, and remaining lengths.

    States are merged outwards from the root. Two states that at least ``LEAST_VISITS`` values visit are merged if a Hoeffding test
    tells neither their ends, transitions and remaining lengths apart nor, step by step, those of their successors. Such a test
    accepts everything for states with few visits, which would melt prefixes and lengths; these are merged only with a state of
    the same depth with mostly the same remaining lengths, and stay by themselves where there is none.
    """

    def __init__(self, values: list[str], alpha: float = ALPHA):
        self.visits, self.ends, self.next, self.left, self.depth = [0], [0], [{}], [Counter()], [0]  # next: symbol -> [state, count]
        self._spread = math.sqrt(0.5 * math.log(2 / alpha))
        for value in values:
            self._add(symbols(value))
        self.states = self._merge_states()
        self.overall = Counter()
        for state in self.states:
            for a, (_, count) in self.next[state].items():
                self.overall[a] += count
        self.steps = sum(self.overall.values())
        # if every step goes one deeper, only fitted lengths can end
        deeper = all(self.depth[to] == self.depth[p] + 1 for p in self.states for to, _ in self.next[p].values())
        self.lengths = {self.depth[p] for p in self.states if self.ends[p]} if deeper else None
        # where a symbol goes that a state has not seen: the way of its most frequent one
        self.usual = {p: self.next[p][max(sorted(self.next[p]), key=lambda a: self.next[p][a][1])][0] for p in self.states if self.next[p]}

    def _add(self, word: str) -> None:
        at = 0
        for i, a in enumerate(word):
            self._visit(at, len(word) - i)
            if a not in self.next[at]:
                self.next[at][a] = [len(self.next), 0]
                self.visits.append(0)
                self.ends.append(0)
                self.next.append({})
                self.left.append(Counter())
                self.depth.append(i + 1)
            arc = self.next[at][a]
            arc[1] += 1
            at = arc[0]
        self._visit(at, 0)
        self.ends[at] += 1

    def _visit(self, state: int, remaining: int) -> None:
        self.visits[state] += 1
        self.left[state][length_class(remaining)] += 1

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        return abs(f1 / n1 - f2 / n2) > self._spread * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def _compatible(self, p: int, q: int) -> bool:
        todo = [(p, q)]
        while todo:
            p, q = todo.pop()
            n1, n2 = self.visits[p], self.visits[q]
            if min(n1, n2) < LEAST_VISITS:
                continue
            one, two = self.next[p], self.next[q]
            counts = [(self.ends[p], self.ends[q])]
            counts += [(self.left[p][x], self.left[q][x]) for x in self.left[p].keys() | self.left[q].keys()]
            for a in one.keys() | two.keys():
                x, y = one.get(a), two.get(a)
                counts.append((x[1] if x else 0, y[1] if y else 0))
                if x and y:
                    todo.append((x[0], y[0]))
            if any(self._differ(f1, n1, f2, n2) for f1, f2 in counts):
                return False
        return True

    def _overlap(self, p: int, q: int) -> float:
        """How far the remaining lengths of two states agree, from 0 to 1."""
        return sum(min(n / self.visits[q], self.left[p][x] / self.visits[p]) for x, n in self.left[q].items())

    def _match(self, q: int, kept: list[int], by_depth: dict[int, list[int]]) -> int | None:
        if self.visits[q] >= LEAST_VISITS:
            return next((p for p in kept if self.visits[p] >= LEAST_VISITS and self._compatible(p, q)), None)
        level = by_depth.get(self.depth[q], [])
        best = max(level, key=lambda p: (self._overlap(p, q), -p), default=None)
        return best if best is not None and self._overlap(best, q) > 0.5 else None

    def _fold(self, p: int, q: int) -> list[int]:
        """Add the tree under ``q`` to the automaton at ``p``; returns the states that it met."""
        todo, met = [(p, q)], []
        while todo:
            p, q = todo.pop()
            met.append(p)
            self.visits[p] += self.visits[q]
            self.ends[p] += self.ends[q]
            self.left[p].update(self.left[q])
            for a, (state, count) in self.next[q].items():
                if a in self.next[p]:
                    self.next[p][a][1] += count
                    todo.append((self.next[p][a][0], state))
                else:
                    self.next[p][a] = [state, count]
        return met

    def _merge_states(self) -> list[int]:
        """Merge from the root outwards, well visited states of a depth first; returns the states that stay."""
        kept, inside, by_depth, queue = [0], {0}, {0: [0]}, []

        def look(state: int) -> None:
            for a, (child, _) in self.next[state].items():
                if child not in inside:
                    heappush(queue, (self.depth[child], -self.visits[child], child, state, a))

        look(0)
        while queue:
            _, visits, child, parent, a = heappop(queue)
            arc = self.next[parent][a]
            if arc[0] != child or child in inside:
                continue
            if -visits != self.visits[child]:  # it has grown since
                heappush(queue, (self.depth[child], -self.visits[child], child, parent, a))
                continue
            match = self._match(child, kept, by_depth)
            if match is None:
                kept.append(child)
                inside.add(child)
                by_depth.setdefault(self.depth[child], []).append(child)
                look(child)
            else:
                arc[0] = match
                for state in self._fold(match, child):
                    if state in inside:
                        look(state)
        return kept

    def score(self, value: str, own: int = 0) -> float:
        """Mean natural-log likelihood per character, the end included; minus infinity where no fitted value ends.

        A class's likelihood is shared by its characters. Steps are smoothed by the symbols of the whole automaton. ``own``
        is how often the value itself was counted; leaving it out makes scores of fitted values comparable to those of others.
        """
        if self.lengths is not None and len(value) not in self.lengths:
            return -math.inf
        at, total = 0, 0.0
        word = symbols(value)
        mine = Counter(word) if own else Counter()
        steps = self.steps - own * len(word)
        for a in word:
            if at is None:
                return -math.inf
            overall = (self.overall[a] - own * mine[a] + SMOOTHING) / (steps + 68 * SMOOTHING)
            arc = self.next[at].get(a)
            total += math.log(((arc[1] if arc else own) - own + PRIOR * overall) / (self.visits[at] - own + PRIOR)) - CLASS_LOGS.get(a, 0.0)
            at = arc[0] if arc else self.usual.get(at)
        ends = self.ends[at] - own if at is not None else 0
        return (total + math.log(ends / (self.visits[at] - own))) / (len(word) + 1) if ends > 0 else -math.inf


def length_class(remaining: int) -> int:
    """Lengths up to 64 as they are, longer ones in steps of a quarter."""
    return remaining if remaining <= 64 else 64 + int(math.log(remaining / 64) / math.log(1.25)) + 1


def transitions(value: str) -> Iterator[tuple[str, str]]:
    """Pairs of neighbouring characters, with an empty one for start and end."""
    return pairwise(["", *value, ""])


class Background:
    """Character pairs of tokens that fit no format, as a likelihood to compare with."""

    def __init__(self, counts: Mapping[tuple[str, str], int]):
        self.pairs = Counter(counts)
        self.before, self.after = Counter(), Counter()
        for (a, b), n in self.pairs.items():
            self.before[a] += n
            self.after[b] += n
        self.total = sum(self.after.values())

    def score(self, value: str) -> float:
        """Mean natural-log likelihood per character, the end included."""
        total = 0.0
        for a, b in transitions(value):
            single = (self.after[b] + 1) / (self.total + 69)
            total += math.log((self.pairs[a, b] + PRIOR * single) / (self.before[a] + PRIOR))
        return total / (len(value) + 1)


class Formats:
    """Automata of the base kinds, their thresholds, and the background of tokens that fit none."""

    def __init__(self, samples: Mapping[str, Iterable[str]], background: Background | None = None):
        self.kinds = {}
        for kind in KINDS[:3]:
            values = sorted(samples.get(kind, []))
            if values:
                automaton = Automaton(values)
                scores = sorted(automaton.score(v, own=1) for v in values)
                self.kinds[kind] = (automaton, scores[int(WORST * len(scores))])
        if background is None:
            background = Background(Counter(pair for v in samples.get("other", []) if self.fit(v) is None for pair in transitions(v)))
        self.background = background

    def fit(self, value: str) -> float | None:
        """The best format likelihood among the kinds that the value fits, else None."""
        return max((s for automaton, least in self.kinds.values() if (s := automaton.score(value)) >= least), default=None)

    def likelihood(self, value: str) -> float | None:
        """``fit``, where it is more than that of the background, else None."""
        score = self.fit(value)
        return None if score is None or self.background.score(value) > score else score

    def added(self, tokens) -> list[tuple[int, int, int, float]]:
        """Findings among tokens in order; what lies in one is not another."""
        found, reach = [], 0
        for s, e, v in tokens:
            if s >= reach and (score := self.likelihood(v)) is not None:
                found.append((3, s, e, score))
                reach = e
        return found


# Spark


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        found = [scan_text(t) for t in pdf.pop("text")]
        keys = ("kind", "start", "end", "value")
        pdf["base"] = [[dict(zip(keys, x, strict=True)) for x in base] for base, _ in found]
        pdf["tokens"] = [[dict(zip(keys[1:], x, strict=True)) for x in tokens] for _, tokens in found]
        yield pdf


def fit_formats(scanned: DataFrame, sample: int = SAMPLE) -> Formats:
    """Automata from at most ``sample`` distinct values of each kind, and the background from all tokens that fit none of them."""
    kind = F.element_at(F.array(*map(F.lit, KINDS)), F.col("x.kind") + 1)
    values = scanned.select(F.explode("base").alias("x")).select(kind.alias("kind"), F.col("x.value").alias("value")).distinct()
    samples = {}
    for name in KINDS[:3]:
        rows = values.filter(F.col("kind") == name).orderBy(F.xxhash64("value"), "value").limit(sample).collect()
        samples[name] = [r["value"] for r in rows]
    fitted = Formats(samples, Background({}))
    if not fitted.kinds:
        return fitted

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[tuple[str, str]] = Counter()  # at most one entry for each pair of the alphabet
        for pdf in batches:
            for tokens in pdf["tokens"]:
                for t in tokens:
                    if fitted.fit(t["value"]) is None:
                        counts.update(transitions(t["value"]))
        text = [pd.Series([pair[i] for pair in counts], dtype=object) for i in range(2)]
        yield pd.DataFrame({"a": text[0], "b": text[1], "n": pd.Series(list(counts.values()), dtype="int64")})

    counted = scanned.filter(F.size("tokens") > 0).select("tokens").mapInPandas(pairs, "a string, b string, n long")
    rows = counted.groupBy("a", "b").agg(F.sum("n").alias("n")).collect()
    fitted.background = Background({(r["a"], r["b"]): r["n"] for r in rows})
    return fitted


def scan_secrets(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, base, added``: spans of the base kinds and of inferred formats of every row."""
    narrow = docs.select("doc_id", "text")
    kind = narrow.schema["doc_id"].dataType.simpleString()
    scanned = written(narrow.mapInPandas(_scan, f"doc_id {kind}, {SCAN}"), "secrets")
    formats = fit_formats(scanned, sample)

    @F.pandas_udf("array<struct<kind:int,start:int,end:int,score:double>>")
    def added(tokens: pd.Series) -> pd.Series:
        keys = ("kind", "start", "end", "score")
        triples = ([(t["start"], t["end"], t["value"]) for t in x] for x in tokens)
        return pd.Series([[dict(zip(keys, y, strict=True)) for y in formats.added(x)] for x in triples], dtype=object)

    none = F.lit(None).cast("array<struct<kind:int,start:int,end:int,score:double>>")
    met = scanned.filter(F.size("tokens") > 0).select("doc_id", "base", added("tokens").alias("added"))
    return met.unionByName(scanned.filter(F.size("tokens") == 0).select("doc_id", "base", F.coalesce(none, F.array()).alias("added")))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"], x["kind"], x["end"])))
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(ordered, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def secret_digest(found: DataFrame) -> DataFrame:
    """Counts per kind, the digest of the base spans, and all spans as text."""
    number = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    pick = lambda c: F.transform(c, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    return found.select(
        "doc_id",
        *[number(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:3])],
        F.sha2(spans_text(pick("base")), 256).alias("base_sha256"),
        spans_text(F.concat(pick("base"), pick("added"))).alias("spans"),
        F.size("added").cast("long").alias("n_format"),
    )


def redact_secrets(docs: DataFrame, sample: int = SAMPLE, mark: str = "[{}]") -> DataFrame:
    """``docs`` with each secret in ``text`` replaced by its kind; ``n_chars`` follows if there is one.

    Overlapping spans are replaced together, under the kind of the first.
    """
    scanned = written(docs.select(F.lit(0).alias("doc_id"), "text").mapInPandas(_scan, f"doc_id int, {SCAN}").filter("size(base) > 0 or size(tokens) > 0"), "secrets")
    formats = fit_formats(scanned, sample)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None else _replace(t, formats, mark))

    out = docs.withColumn("text", clean("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def _replace(text: str, formats: Formats, mark: str) -> str:
    base, tokens = scan_text(text)
    spans = sorted([(s, k, e) for k, s, e, _ in base] + [(s, k, e) for k, s, e, _ in formats.added(tokens)])
    parts, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            parts += [text[at:start], mark.format(KINDS[kind])]
        at = max(at, end)
    return "".join([*parts, text[at:]]) if spans else text
