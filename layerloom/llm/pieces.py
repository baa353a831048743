"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

A vocabulary file gives pieces, log scores and byte pieces; it is read, never trained. White space is
marked by U+2581 and a text starts with one marker. The best segmentation maximises the sum of scores; of equal
ones the one whose last piece begins first wins, position by position. A character that no single piece spells costs the
lowest score minus 10 and is written as its UTF-8 bytes. A literal U+2581 in a text is
written as bytes too, so decoding gives every text back.

No piece has the marker after another character, so segmentation splits exactly before each run of spaces
(and around line feeds, which no piece holds). Vocabularies for which that is not so are segmented
whole. Distinct units of a batch are solved together: one vectorised step per start and length for
all of them. Solved units are kept in a bounded cache per worker.

The vocabulary (one double array and two tables, a few MB whatever the input) is what is sent to executors.

Defined cases: null text gives null ids, an empty text no ids; repeated rows are encoded each; empty tables
give no rows; extra columns are ignored by ``encode_documents`` and never clash, as it reads two.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHED_UNITS = 400_000
CHUNK_CHARS = 1 << 20
SHORT_UNIT = 64
VOCABULARY = os.environ.get("PIECE_VOCABULARY", "/opt/tokenizers/piece_bpe_32k.model")


class DoubleArray:
    """Trie in two arrays: from state s, symbol c leads to ``base[s] + c`` if ``check`` there is s."""

    def __init__(self, words: dict[str, int]):
        symbols = sorted({c for w in words for c in w})
        heavy: dict[str, int] = {}
        for w in words:
            for c in w:
                heavy[c] = heavy.get(c, 0) + 1
        ranked = sorted(symbols, key=lambda c: (-heavy[c], c))
        self.code = {c: i + 1 for i, c in enumerate(ranked)}
        tree: list[dict[int, int]] = [{}]
        values = [-1]
        for w, v in sorted(words.items()):
            at = 0
            for c in w:
                k = self.code[c]
                if k not in tree[at]:
                    tree[at][k] = len(tree)
                    tree.append({})
                    values.append(-1)
                at = tree[at][k]
            values[at] = v
        self._place(tree, values)
        self.longest = max(map(len, words), default=0)

    def _place(self, tree: list[dict[int, int]], values: list[int]) -> None:
        room = len(tree) * 2 + 2 * len(self.code) + 2
        base, check, value = [0] * room, [-1] * room, [-1] * room
        used = bytearray(room)
        used[0] = 1
        todo, first = [(0, 0)], 1
        for node, slot in todo:  # grows while it is read: breadth first
            value[slot] = values[node]
            codes = sorted(tree[node])
            if not codes:
                continue
            at = max(first, codes[0])
            while True:
                at = used.find(b"\0", at)
                if at < 0 or at + codes[-1] - codes[0] >= len(used) - len(self.code) - 1:
                    more = len(used)
                    used.extend(bytes(more))
                    base += [0] * more
                    check += [-1] * more
                    value += [-1] * more
                    at = max(at, 0) if at >= 0 else more - 1
                    continue
                if all(not used[at - codes[0] + c] for c in codes):
                    break
                at += 1
            base[slot] = at - codes[0]
            for c in codes:
                used[base[slot] + c] = 1
                check[base[slot] + c] = slot
                todo.append((tree[node][c], base[slot] + c))
            first = used.find(b"\0", first)
        self.base, self.check, self.value = (np.array(a, np.int32) for a in (base, check, value))


class Vocabulary:
    """Pieces, log scores, byte pieces and the trie; ``scores`` replaces those of the file."""

    def __init__(self, pieces: list[tuple[str, float]], bytes_at: list[int], controls: Iterable[int] = (), unknown: int = 0):
        skipped = {*bytes_at, *controls, unknown}
        normal = {p: i for i, (p, _) in enumerate(pieces) if i not in skipped}
        self.trie = DoubleArray(normal)
        self.scores = np.array([s for _, s in pieces])
        self.bytes_at = np.array(bytes_at, np.int32)
        self.unknown_score = min((pieces[i][1] for i in normal.values()), default=0.0) - UNKNOWN_PENALTY
        lead = [self.unknown_score if b < 0x80 or b >= 0xC0 else 0.0 for b in range(256)]
        self.cost = self.scores.copy()
        self.cost[self.bytes_at] = lead  # a character in bytes costs once
        marked = any(MARK in p.lstrip(MARK) for p in normal)
        lines = any("\n" in p for p in normal)
        self.split = re.compile(r"(?s).+" if marked else r"(?s) +[^ ]*|[^ ]+" if lines else r"\n| +[^ \n]*|[^ \n]+")
        spelled = [b"" if i in skipped else p.replace(MARK, " ").encode() for i, (p, _) in enumerate(pieces)]
        for b, i in enumerate(bytes_at):
            spelled[i] = bytes([b])
        spelled[unknown] = " ⁇ ".encode()
        self.lengths = np.array([len(s) for s in spelled])
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        self.spelling = np.frombuffer(b"".join(spelled), np.uint8)

    def codes(self, unit: str) -> list[int]:
        """Symbols of the trie, 0 where no piece has the character; spaces are markers."""
        code = self.trie.code
        return [code.get(MARK, 0) if c == " " else 0 if c == MARK else code.get(c, 0) for c in unit]


@lru_cache(maxsize=4)
def load(path: str = VOCABULARY) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    pieces = [(model.id_to_piece(i), model.get_score(i)) for i in ids]
    bytes_at = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    return Vocabulary(pieces, bytes_at, [i for i in ids if model.is_control(i) or model.is_unused(i)], model.unk_id())


# Viterbi


def _spell(vocabulary: Vocabulary, unit: str, pieces: list[tuple[int, int]]) -> bytes:
    """Ids as int32 bytes from ``(start, id)``; id -1 is one character in bytes."""
    out: list[int] = []
    for start, piece in pieces:
        if piece >= 0:
            out.append(piece)
        else:
            out += vocabulary.bytes_at[list(unit[start].encode())].tolist()
    return np.array(out, np.int32).tobytes()


def solve_one(vocabulary: Vocabulary, unit: str) -> bytes:
    """The best segmentation of one unit, position by position."""
    trie, codes, n = vocabulary.trie, vocabulary.codes(unit), len(unit)
    base, check, value, scores = trie.base, trie.check, trie.value, vocabulary.scores
    best, back = [-np.inf] * (n + 1), [(0, -1)] * (n + 1)
    best[0] = 0.0
    for i in range(n):
        state, here, single = 0, best[i], False
        for j in range(i, n):
            c = codes[j]
            if not c:
                break
            step = base[state] + c
            if check[step] != state:
                break
            state = step
            piece = value[state]
            if piece >= 0:
                single |= j == i
                score = here + scores[piece]
                if score > best[j + 1]:
                    best[j + 1], back[j + 1] = score, (i, int(piece))
        if not single and here + vocabulary.unknown_score > best[i + 1]:
            best[i + 1], back[i + 1] = here + vocabulary.unknown_score, (i, -1)
    path, at = [], n
    while at:
        path.append(back[at])
        at = back[at][0]
    return _spell(vocabulary, unit, path[::-1])


def solve_many(vocabulary: Vocabulary, units: list[str]) -> list[bytes]:
    """The best segmentations of short units of about one length, all at once."""
    trie = vocabulary.trie
    m, n = len(units), max(map(len, units))
    codes = np.zeros((n, m), np.int32)
    for k, unit in enumerate(units):
        codes[: len(unit), k] = vocabulary.codes(unit)
    best = np.full((n + 1, m), -np.inf)
    start, piece_at = np.zeros((n + 1, m), np.int32), np.full((n + 1, m), -1, np.int32)
    best[0] = 0.0
    lengths = np.array([len(u) for u in units])
    for i in range(n):
        rows = np.flatnonzero(lengths > i)
        state = np.zeros(len(rows), np.int32)
        single = np.zeros(m, bool)
        for j in range(i, n):
            c = codes[j, rows]
            step = trie.base[state] + c
            ok = (c > 0) & (trie.check[step] == state)
            rows, state = rows[ok], step[ok]
            if not len(rows):
                break
            piece = trie.value[state]
            hit = piece >= 0
            at, found = rows[hit], piece[hit]
            if j == i:
                single[at] = True
            score = best[i, at] + vocabulary.scores[found]
            more = score > best[j + 1, at]
            at = at[more]
            best[j + 1, at], start[j + 1, at], piece_at[j + 1, at] = score[more], i, found[more]
        alone = np.flatnonzero(~single & (lengths > i))
        score = best[i, alone] + vocabulary.unknown_score
        more = score > best[i + 1, alone]
        at = alone[more]
        best[i + 1, at], start[i + 1, at], piece_at[i + 1, at] = score[more], i, -1
    out_start, out_piece = np.zeros((n, m), np.int32), np.zeros((n, m), np.int32)
    at, used, cols = lengths.copy(), np.zeros(m, int), np.arange(m)
    while len(cols):
        here = at[cols]
        out_start[used[cols], cols], out_piece[used[cols], cols] = start[here, cols], piece_at[here, cols]
        used[cols] += 1
        at[cols] = start[here, cols]
        cols = cols[at[cols] > 0]
    solved = []
    for k, unit in enumerate(units):
        pieces = out_piece[: used[k], k][::-1]
        if pieces.min() >= 0:
            solved.append(pieces.astype(np.int32).tobytes())
        else:
            solved.append(_spell(vocabulary, unit, list(zip(out_start[: used[k], k][::-1].tolist(), pieces.tolist(), strict=True))))
    return solved


class Encoder:
    """Encodes texts with a bounded cache of solved units."""

    def __init__(self, vocabulary: Vocabulary, cached: int = CACHED_UNITS):
        self.vocabulary, self.cached = vocabulary, cached
        self.cache: dict[str, bytes] = {}

    def _solve(self, units: set[str]) -> None:
        if len(self.cache) + len(units) > self.cached:
            self.cache.clear()
        short = sorted((u for u in units if len(u) <= SHORT_UNIT), key=lambda u: (len(u), u))
        for i in range(0, len(short), 4096):
            part = short[i : i + 4096]
            self.cache.update(zip(part, solve_many(self.vocabulary, part), strict=True))
        for u in units:
            if len(u) > SHORT_UNIT:
                self.cache[u] = solve_one(self.vocabulary, u)

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        find = self.vocabulary.split.findall
        units = [find(" " + t) if t else [] for t in texts]
        wanted = set().union(*units)
        if not wanted <= self.cache.keys():
            fresh = wanted - self.cache.keys()
            if len(self.cache) + len(fresh) > self.cached:
                fresh = wanted
            self._solve(fresh)
        get = self.cache.__getitem__
        return [None if t is None else np.frombuffer(b"".join(map(get, x)), np.int32) for t, x in zip(texts, units, strict=True)]


def decode(vocabulary: Vocabulary, ids: np.ndarray) -> str:
    """The text of one row of ids: spelled bytes in order, without the first marker."""
    lengths = vocabulary.lengths[ids]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total) + np.repeat(vocabulary.starts[ids] - (ends - lengths), lengths)
    text = vocabulary.spelling[at].tobytes().decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


# Spark


def _chunks(sizes: Iterable[int]) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``CHUNK_CHARS`` characters."""
    begin = end = total = 0
    for size in sizes:
        total += size
        end += 1
        if total >= CHUNK_CHARS:
            yield begin, end
            begin, total = end, 0
    if end > begin:
        yield begin, end


def encode_documents(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``doc_id, ids, n_pieces, n_byte_pieces, log_score, round_trip`` of every row.

    ``round_trip`` says that decoding the ids gives the whole text back.
    """
    narrow = docs.select("doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(load(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        encoder = Encoder(vocabulary)
        is_byte = np.zeros(len(vocabulary.scores), bool)
        is_byte[vocabulary.bytes_at] = True
        for batch in batches:
            sizes = [s or 0 for s in pa.compute.utf8_length(batch["text"]).to_pylist()]
            for begin, end in _chunks(sizes):
                part = batch.slice(begin, end - begin)
                texts = part["text"].to_pylist()
                ids = encoder.encode(texts)
                none = [x is None for x in ids]
                rows = [np.zeros(0, np.int32) if x is None else x for x in ids]
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in rows]))).astype(np.int32)
                flat = np.concatenate(rows)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()), mask=pa.array(none))
                known = lambda f: [None if n else f(x) for n, x in zip(none, rows, strict=True)]
                back = [None if t is None else decode(vocabulary, x) == t for t, x in zip(texts, rows, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        lists,
                        pa.array(known(len), pa.int64()),
                        pa.array(known(lambda x: int(is_byte[x].sum())), pa.int64()),
                        pa.array(known(lambda x: float(vocabulary.cost[x].sum())), pa.float64()),
                        pa.array(back, pa.bool_()),
                    ],
                    names=["doc_id", "ids", "n_pieces", "n_byte_pieces", "log_score", "round_trip"],
                )

    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, ids array<int>, n_pieces long, n_byte_pieces long, log_score double, round_trip boolean")


def decode_documents(encoded: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``doc_id, text`` from rows of ``doc_id, ids``; null ids give null text."""
    narrow = encoded.select("doc_id", "ids")
    shared = encoded.sparkSession.sparkContext.broadcast(load(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = (batch["ids"][i] for i in range(len(batch)))
            texts = [decode(shared.value, np.array(x.values, np.int32)) if x.is_valid else None for x in ids]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, text string")
