"""PII: keyed surrogates of the same type, gender, script and format.

Emails, IPv4 addresses, payment cards (with a right check digit), phone numbers, social security numbers, account numbers (with right
check digits) and titled names are detected in whole texts. A surrogate comes from a keyed permutation of
the entity's own format: every letter stays a letter of its script and case, every digit a digit,
separators stay; top-level domains, country codes and a card's first digit stay, check digits are made right; a given
name goes to another of its gender and script. The permutation is one to one, so different entities of one format
get different surrogates, and one entity gets the same in every text, however it is written.

Collisions are still checked over all entities: a surrogate that is shared, equals the entity, or is a real entity of
the corpus is drawn again with the next attempt, until none is left. Entities that needed another attempt
are exceptions: up to ``MOST_SHARED`` of them are sent to all tasks; more are joined to the texts that hold them.

Defined cases: null text stays null, texts without entities stay as they are; overlapping finds are resolved by start,
then length; repeated rows get the same replacements; an empty table gives no rows; extra columns stay in
``replace_entities``.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.llm.common import written

TYPES = ("email", "ip", "card", "phone", "ssn", "iban", "person")
KEY = b"surrogates of the query"
MOST_SHARED = 100_000
MOST_ATTEMPTS = 64
EXTEND_FROM = 8
CACHED_ENTITIES = 200_000

# Titles with gender, and given names by gender and script.
TITLES = {
    "Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Dr": "n", "Prof": "n", "Herr": "m", "Frau": "f", "Monsieur": "m", "Madame": "f", "Mme": "f",
    "Señor": "m", "Señora": "f", "Господин": "m", "Госпожа": "f", "Κύριος": "m", "Κυρία": "f",
}
GIVEN = {
    ("m", "LATIN"): ("Adam", "Albert", "Anton", "Carlos", "Daniel", "David", "Emil", "Felix", "Frank", "George", "Henry", "Hugo", "Jack", "James", "Jean", "John", "Juan", "Karl", "Louis", "Luis", "Marc", "Martin", "Michael", "Oscar", "Paul", "Peter", "Pierre", "Robert", "Thomas", "William"),
    ("f", "LATIN"): ("Alice", "Amelia", "Ana", "Anna", "Carmen", "Clara", "Claire", "Elena", "Elise", "Emma", "Eva", "Grace", "Hannah", "Helen", "Ines", "Jane", "Julia", "Laura", "Lena", "Lucia", "Marie", "Martha", "Mary", "Nina", "Nora", "Olivia", "Paula", "Rosa", "Sarah", "Sophie"),
    ("m", "CYRILLIC"): ("Алексей", "Андрей", "Борис", "Виктор", "Дмитрий", "Иван", "Николай", "Олег", "Павел", "Сергей"),
    ("f", "CYRILLIC"): ("Анна", "Вера", "Галина", "Елена", "Ирина", "Мария", "Наталья", "Ольга", "Светлана", "Татьяна"),
}

EMAIL_LOCAL, EMAIL_HOST = re.compile(r"[A-Za-z0-9._%+-]+\Z"), re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![A-Za-z0-9])")
DIGIT = re.compile(r"[0-9]")
IP = re.compile(r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])")
CARD = re.compile(r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])")
PHONE = re.compile(r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z])|(?<![0-9A-Za-z+])\+[0-9]{8,15}(?![0-9A-Za-z])")
SSN = re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])")
IBAN = re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![0-9A-Za-z])")
PERSON = re.compile(r"(?<!\w)(" + "|".join(TITLES) + r")(\.? )([^\W\d_][^\W\d_'-]+)(?: ([^\W\d_][^\W\d_'-]+))?(?!\w)")


def luhn(digits: str) -> bool:
    total = sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 * (c > "4")) for i, c in enumerate(reversed(digits)))
    return total % 10 == 0


def iban_check(country: str, account: str) -> str:
    """The two check digits."""
    number = int("".join(str(int(c, 36)) for c in account + country + "00"))
    return f"{98 - number % 97:02d}"


def _emails(text: str):
    at = text.find("@")
    while at >= 0:
        # the local part is matched in pieces of growing size, as it has no length limit
        size = 64
        while True:
            low = max(0, at - size)
            local = EMAIL_LOCAL.search(text[low:at])
            if not local or low == 0 or local.start() > 0:
                break
            size *= 4
        host = EMAIL_HOST.match(text, at + 1)
        if local and host:
            yield low + local.start(), host.end(), "email", text[low + local.start() : host.end()].lower()
        at = text.find("@", at + 1)


def detect(text: str | None) -> list[tuple[int, int, str, str]]:
    """``(start, end, type, canonical form)`` of all entities, without overlaps."""
    text = text or ""
    found = list(_emails(text)) if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(int(x) < 256 for x in m[0].split(".")):
                found.append((m.start(), m.end(), "ip", ".".join(str(int(x)) for x in m[0].split("."))))
        for m in CARD.finditer(text):
            digits = re.sub("[ -]", "", m[0])
            if luhn(digits) and digits.strip("0"):
                found.append((m.start(), m.end(), "card", digits))
        for m in SSN.finditer(text):
            found.append((m.start(), m.end(), "ssn", m[0].replace("-", "")))
        for m in PHONE.finditer(text):
            digits = re.sub(r"[^0-9]", "", m[0])
            country = re.match(r"\+([0-9]{1,3})[ .(-]", m[0])
            found.append((m.start(), m.end(), "phone", (f"+{country[1]}:{digits[len(country[1]) :]}" if country else ("+:" if m[0][0] == "+" else ":") + digits)))
        for m in IBAN.finditer(text):
            flat = m[0].replace(" ", "")
            if flat[2:4] == iban_check(flat[:2], flat[4:]):
                found.append((m.start(), m.end(), "iban", flat))
    if any(t in text for t in TITLES):
        for m in PERSON.finditer(text):
            names = [n for n in m.groups()[2:] if n]
            if names[0][0].isupper():
                kept = names if names[-1][0].isupper() else names[:1]
                end = m.end(3) if len(kept) == 1 else m.end(4)
                found.append((m.start(3), end, "person", f"{TITLES[m[1]]}:{' '.join(kept)}"))
    out, at = [], 0
    for x in sorted(found, key=lambda x: (x[0], -x[1], TYPES.index(x[2]))):
        if x[0] >= at:
            out.append(x)
            at = x[1]
    return out


# Keyed permutations


@lru_cache(maxsize=4096)
def alphabet(c: str) -> str:
    """Characters of the same script, case and block; one character if it is no letter or digit."""
    kind = unicodedata.category(c)
    if kind[0] != "L" and kind != "Nd":
        return c
    script = unicodedata.name(c, "").split(" ")[0]
    block = range(128) if c < "\x80" else range(max(128, ord(c) & ~255), (ord(c) | 255) + 1)
    return "".join(d for d in map(chr, block) if unicodedata.category(d) == kind and unicodedata.name(d, "").split(" ")[0] == script)


def permute(n: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of 0 .. size - 1: a Feistel network, walked until it is back in range."""
    if size < 2:
        return n
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    name = f"{tweak}|{size}".encode()
    while True:
        left, right = n >> half, n & mask
        for i in range(8):
            data = i.to_bytes(1) + right.to_bytes(half // 8 + 1) + name
            word = b"".join(hashlib.blake2b(data + j.to_bytes(4), key=key).digest() for j in range(half // 512 + 1))
            left, right = right, left ^ (int.from_bytes(word) & mask)
        n = left << half | right
        if n < size:
            return n


def alike(text: str, key: bytes, tweak: str) -> str:
    """Another text of the same format: letters and digits permuted together, the rest kept."""
    sets = [alphabet(c) for c in text]
    n = size = 0
    size = 1
    for c, s in zip(text, sets, strict=True):
        n, size = n * len(s) + s.index(c), size * len(s)
    n = permute(n, size, key, tweak + "|" + "".join(s[0] for s in sets))
    out = []
    for s in reversed(sets):
        n, i = divmod(n, len(s))
        out.append(s[i])
    return "".join(reversed(out))


def _extension(attempt: int) -> str:
    """Letters that lengthen a name once its own format is used up."""
    n, out = attempt - EXTEND_FROM, ""
    while n >= 0:
        out += chr(97 + n % 26)
        n = n // 26 - 1
    return out


def surrogate(kind: str, entity: str, key: bytes = KEY, attempt: int = 0) -> str:
    """The canonical form of the surrogate."""
    tweak = f"{kind}|{attempt}"
    if kind == "email":
        local, host = entity.split("@")
        *labels, top = host.split(".")
        return alike(local, key, tweak) + _extension(attempt) + "@" + ".".join([*(alike(x, key, "host") for x in labels), top])
    if kind == "ip":
        a, b, c, d = map(int, entity.split("."))
        n = permute(((a * 256 + b) * 256 + c) * 256 + d, 1 << 32, key, tweak)
        return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))
    if kind == "card":
        body = entity[0] + alike(entity[1:-1], key, tweak)
        return next(body + c for c in "0123456789" if luhn(body + c))
    if kind == "phone":
        country, digits = entity.split(":")
        return country + ":" + alike(digits, key, tweak)
    if kind == "iban":
        account = alike(entity[4:], key, tweak)
        return entity[:2] + iban_check(entity[:2], account) + account
    if kind == "person":
        gender, names = entity.split(":")
        *given, last = names.split(" ")
        return gender + ":" + " ".join([*(_given(g, gender, key, attempt) for g in given), alike(last, key, tweak) + _extension(attempt)])
    return alike(entity, key, tweak)


def _given(name: str, gender: str, key: bytes, attempt: int) -> str:
    script = unicodedata.name(name[0], "").split(" ")[0]
    for g in (gender, "m", "f"):
        names = GIVEN.get((g, script), ())
        if name in names:
            return names[permute(names.index(name), len(names), key, f"given|{g}|{attempt}")]
    names = GIVEN.get((gender if gender != "n" else "m", script))
    return names[int.from_bytes(hashlib.blake2b(f"{name}|{attempt}".encode(), key=key, digest_size=8).digest()) % len(names)] if names else alike(name, key, f"given|{attempt}")


def rendered(kind: str, original: str, new: str) -> str:
    """The surrogate in the format of one occurrence: its case, separators and spelling."""
    if kind == "email":
        return "".join(n.upper() if o.isupper() else n for o, n in zip(original, new, strict=False)) + new[len(original) :] if len(new) == len(original) else new
    if kind == "person":
        return new.split(":")[1]
    if kind == "ip":
        return new
    flat = iter(new.replace(":", "").replace("+", ""))
    return "".join(next(flat) if c.isalnum() else c for c in original)


class Replacer:
    """Replaces entities of texts; ``attempts`` has the exceptions."""

    def __init__(self, key: bytes = KEY, attempts: dict[tuple[str, str], int] | None = None):
        self.key, self.attempts = key, attempts or {}
        self.cache: dict[tuple[str, str, int], str] = {}

    def replace(self, text: str | None, more: dict[tuple[str, str], int] | None = None) -> tuple[str | None, int]:
        found = detect(text)
        if not found:
            return text, 0
        parts, at = [], 0
        for start, end, kind, entity in found:
            attempt = (more or self.attempts).get((kind, entity), 0)
            new = self.cache.get((kind, entity, attempt))
            if new is None:
                if len(self.cache) >= CACHED_ENTITIES:
                    self.cache.clear()
                new = self.cache[kind, entity, attempt] = surrogate(kind, entity, self.key, attempt)
            parts += [text[at:start], rendered(kind, text[start:end], new)]
            at = end
        return "".join([*parts, text[at:]]), len(found)


# Spark


def entities(docs: DataFrame) -> DataFrame:
    """Distinct ``kind, entity`` of all texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = {(k, e) for t in pdf["text"] for _, _, k, e in detect(t)}
            yield pd.DataFrame(sorted(found), columns=["kind", "entity"])

    return docs.select("text").mapInPandas(run, "kind string, entity string").distinct()


def settle(found: DataFrame, key: bytes = KEY) -> DataFrame:
    """``kind, entity, attempt``: entities whose first surrogate collided, with the attempt that is free."""

    def draw(attempt: int):
        @F.pandas_udf("string")
        def drawn(kind: pd.Series, entity: pd.Series) -> pd.Series:
            return pd.Series([surrogate(k, e, key, attempt) for k, e in zip(kind, entity, strict=True)], dtype=object)

        return drawn("kind", "entity")

    real = found.select("kind", F.col("entity").alias("new"))
    open_, settled, late = found, None, None
    for attempt in range(MOST_ATTEMPTS):
        drawn = open_.select("kind", "entity", F.lit(attempt).alias("attempt"), draw(attempt).alias("new"))
        free = drawn.join(real, ["kind", "new"], "left_anti")
        if settled is not None:
            free = free.join(settled.select("kind", "new"), ["kind", "new"], "left_anti")
        first = written(free.groupBy("kind", "new").agg(F.min("entity").alias("entity")).withColumn("attempt", F.lit(attempt)), "surrogates")
        settled = first if settled is None else settled.unionByName(first)
        if attempt:
            late = first if late is None else late.unionByName(first)
        open_ = written(open_.join(first.select("kind", "entity"), ["kind", "entity"], "left_anti"), "open")
        if open_.isEmpty():
            break
    else:
        raise RuntimeError("some formats have fewer surrogates than entities")
    return found.select("kind", "entity", F.lit(0).alias("attempt")).limit(0) if late is None else late.select("kind", "entity", "attempt")


def replace_entities(docs: DataFrame, key: bytes = KEY, most_shared: int = MOST_SHARED) -> DataFrame:
    """``docs`` with surrogates in ``text`` and their number in ``__n_entities``."""
    exceptions = written(settle(written(entities(docs), "entities"), key), "exceptions")
    shared = exceptions.limit(most_shared + 1).collect()
    shape = "struct<text:string,n:long>"
    if len(shared) <= most_shared:
        replacer = docs.sparkSession.sparkContext.broadcast(Replacer(key, {(r["kind"], r["entity"]): r["attempt"] for r in shared}))

        @F.pandas_udf(shape)
        def replace(texts: pd.Series) -> pd.DataFrame:
            return pd.DataFrame([replacer.value.replace(t) for t in texts], columns=["text", "n"])

        done = docs.withColumn("__new", replace("text"))
    else:

        def holders(batches):
            for pdf in batches:
                rows = {(h, k, e) for h, t in zip(pdf["h"], pdf["text"], strict=True) for _, _, k, e in detect(t)}
                yield pd.DataFrame(sorted(rows), columns=["h", "kind", "entity"])

        held = docs.select(F.xxhash64("text").alias("h"), "text").mapInPandas(holders, "h long, kind string, entity string").distinct()
        odd = held.join(exceptions, ["kind", "entity"]).groupBy("h").agg(F.collect_list(F.struct("kind", "entity", "attempt")).alias("__odd"))

        @F.pandas_udf(shape)
        def replace_with(texts: pd.Series, odd: pd.Series) -> pd.DataFrame:
            one = Replacer(key)
            more = ({(x["kind"], x["entity"]): x["attempt"] for x in o} if o is not None else None for o in odd)
            return pd.DataFrame([one.replace(t, m) for t, m in zip(texts, more, strict=True)], columns=["text", "n"])

        met = docs.withColumn("__h", F.xxhash64("text")).join(odd.withColumnRenamed("h", "__h"), "__h", "left")
        done = met.withColumn("__new", replace_with("text", "__odd")).drop("__h", "__odd")
    out = done.withColumns({"text": F.col("__new.text"), "__n_entities": F.coalesce("__new.n", F.lit(0).cast("long"))}).drop("__new")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__n_entities") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out


def replace_documents(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """``doc_id, n_entities, text`` of every row."""
    done = replace_entities(docs.select("doc_id", "text"), key)
    return done.select("doc_id", F.col("__n_entities").alias("n_entities"), "text")
