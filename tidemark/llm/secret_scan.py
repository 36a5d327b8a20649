"""Secrets in texts: fixed patterns, and strings that compress badly where a secret is expected.

The base patterns are ``assign`` (a sensitive name, a sign, a value), ``access`` (access key ids) and
``hex`` (long hexadecimal runs).

The novelty method looks at strings of at least ``LEAST_LENGTH`` token characters within ``CONTEXT``
characters of a sensitive word on either side, across line ends. They mix two or more of lower case,
upper case (but for a word's capital) and digits, or hold an unbroken run of one of these: ``LEAST_LETTERS``
letters or ``LEAST_DIGITS`` digits, longer than nearly all words, times and card numbers, which no
dictionary here tells from random strings of their length. A string is a whole run of token characters, or the part of one after its first
sensitive word, or before, after or between such words. zstandard, primed with a dictionary of identifiers and the code
around the string, compresses what stands before it with and without it; the difference, in bytes per
character, is the string's novelty. Names and paths are in the dictionary or the surroundings and cost
little; a random key costs most of its length. Other copies of the string are blanked out of its
surroundings, so a repeated key is as novel as a single one. The limit is ``LEAST_NOVELTY`` of what a
random string of the same length and alphabet costs at the same place. A string is measured where it
first stands near a sensitive word; all its places in the text are reported as ``novel`` unless they
lie inside a base span or a longer novel one.

Defined cases: NULL or empty text has no spans; a row with a NULL id is scanned like any other;
repeated rows give equal results; spans are code points, end exclusive; other columns do not matter.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, table

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
# A maximal run long enough is what the shorter run patterns keep after the length check.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

SENSITIVE_WORDS = (
    "password", "passwd", "pwd", "passphrase", "secret", "token", "apikey", "api_key", "api key",
    "credential", "private key", "private_key", "access key", "access_key", "bearer", "authorization",
)
SENSITIVE = re.compile("|".join(map(re.escape, SENSITIVE_WORDS)), re.IGNORECASE | re.ASCII)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
LEAST_LENGTH = 12
LEAST_LETTERS = 20
LEAST_DIGITS = 18
CONTEXT = 80
SURROUNDINGS = 1_000
LEAST_NOVELTY = 0.7

_PARTS = (
    "get set is has new old default current user client server session request response config "
    "access refresh private public secret token password key value name id path file url host port "
    "string number list map index count size length type class object function return import from "
    "example sample test dummy placeholder change your this that here none null true false undefined"
).split()


def identifier_dictionary() -> bytes:
    """Names as they occur in code, made of common parts in the usual spellings."""
    joined = ["".join([a, b.title()]) for a in _PARTS[:24] for b in _PARTS[8:36]]
    snake = ["_".join([a, b]) for a in _PARTS[:24] for b in _PARTS[8:36]]
    upper = [name.upper() for name in snake[:200]]
    digits = ["0123456789", "1234567890", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "x" * 32, "0" * 32]
    return " ".join([*joined, *snake, *upper, *_PARTS, *digits]).encode()


class Novelty:
    """Marginal compressed bytes of a string, given the code around it."""

    def __init__(self, dictionary: bytes):
        self.dictionary = dictionary

    def __call__(self, text: str, start: int, end: int) -> tuple[float, float]:
        """Bytes a character of the string, and of a random one of its length and alphabet."""
        found = text[start:end]
        size = end - start
        blank = lambda part: part.replace(found, " " * size)
        # Wider by one string, so that a copy across the border is blanked as well.
        before = blank(text[max(0, start - SURROUNDINGS - size) : start])[-SURROUNDINGS:]
        after = blank(text[end : end + SURROUNDINGS + size])[:SURROUNDINGS]
        primed = zstandard.ZstdCompressionDict(
            self.dictionary + (after + before).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT
        )
        squeeze = zstandard.ZstdCompressor(level=19, dict_data=primed, write_content_size=False, write_checksum=False)
        lead = before[-CONTEXT:].encode()
        alone = len(squeeze.compress(lead))
        other = "".join(random.Random(found).choices(alphabet(found), k=size))
        return tuple((len(squeeze.compress(lead + s.encode())) - alone) / size for s in (found, other))


_HEX_LETTERS = set("abcdefABCDEF")
_CAPITAL = re.compile(r"(?<![A-Za-z0-9])[A-Z](?=[a-z])")
_LONG_RUN = re.compile(f"[a-z]{{{LEAST_LETTERS}}}|[A-Z]{{{LEAST_LETTERS}}}|[0-9]{{{LEAST_DIGITS}}}")


def alphabet(found: str) -> str:
    """The classes of characters that occur in a string; of its letters a to f, if it has no others."""
    letters = {c for c in found if c.isalpha()}
    size = 6 if letters <= _HEX_LETTERS else 26
    classes = (string.ascii_lowercase[:size], string.ascii_uppercase[:size], string.digits, "+/_=-")
    return "".join(one for one in classes if not set(one).isdisjoint(found))


def _measured(found: str) -> bool:
    """Whether a string mixes classes of characters or holds a long run of one; a word's capital counts as lower case."""
    found = _CAPITAL.sub("a", found)
    classes = any(map(str.isdigit, found)) + any(map(str.islower, found)) + any(map(str.isupper, found))
    return classes > 1 or _LONG_RUN.search(found) is not None


def _strings(text: str, words: list[tuple[int, int]]) -> Iterator[tuple[int, int, bool]]:
    """``start, end, near`` of the strings of a text; ``words``: places of its sensitive words, in order."""
    starts, ends = [a for a, _ in words], [b for _, b in words]
    for run in CANDIDATE.finditer(text):
        a, b = run.span()
        # Words that overlap the run, and whether one stands outside it but within the context.
        first, last = bisect_right(ends, a), bisect_left(starts, b)
        outside = (first > 0 and a - ends[first - 1] < CONTEXT) or (last < len(words) and starts[last] - b < CONTEXT)
        if _measured(text[a:b]):
            yield a, b, outside or first < last
        if first < last:
            cuts = [a, *[min(max(place, a), b) for word in words[first:last] for place in word], b]
            tail = [(cuts[2], b)] if last - first > 1 else []
            for x, y in [*tail, *zip(cuts[::2], cuts[1::2])]:
                if LEAST_LENGTH <= y - x < b - a and _measured(text[x:y]):
                    yield x, y, True


def spans(text: str | None, novelty: Novelty) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` in order."""
    if not text:
        return []
    lower = text.lower()
    found: list[tuple[int, int, int]] = []
    if any(word in lower for word in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if any(word in lower for word in SENSITIVE_WORDS):
        places = sorted(_strings(text, [m.span() for m in SENSITIVE.finditer(text)]), key=lambda p: (p[0], -p[1]))
        novel: dict[str, bool] = {}
        for a, b, near in places:
            if near and text[a:b] not in novel:
                cost, random_cost = novelty(text, a, b)
                novel[text[a:b]] = cost >= LEAST_NOVELTY * random_cost
        # By start, the longer first: a place inside an earlier novel one ends within its reach.
        base = sorted((a, b) for a, _, b in found)
        starts, ends = [a for a, _ in base], list(accumulate((b for _, b in base), max))
        reach = 0
        for a, b, _ in places:
            if b > reach and novel.get(text[a:b]):
                reach = b
                before = bisect_right(starts, a)
                if not before or ends[before - 1] < b:
                    found.append((a, 3, b))
    return sorted(found)


def secret_spans(docs: DataFrame, dictionary: bytes | None = None) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id`` and ``spans``, an array of kind, start, end."""
    primed = dictionary or identifier_dictionary()

    def scan(columns: dict[str, list]) -> dict[str, list]:
        novelty = Novelty(primed)
        found = [spans(text, novelty) for text in columns["text"]]
        return {
            "doc_id": columns["doc_id"],
            "spans": [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in one] for one in found],
        }

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, spans array<struct<kind: string, start: bigint, end: bigint>>"
    return map_rows(docs.select("doc_id", F.col("text").cast("string")), scan, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(table(spark, sf_dir, "documents"))

    def line(chosen):
        parts = F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(parts, ",")

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("spans", lambda s: s["kind"] != "novel")
    return found.select(
        "doc_id",
        number("assign").alias("n_assign"),
        number("access").alias("n_access"),
        number("hex").alias("n_hex"),
        F.sha2(line(base), 256).alias("base_sha256"),
        line(F.col("spans")).alias("spans"),
    )
