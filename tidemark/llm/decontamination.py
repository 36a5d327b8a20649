"""Documents that contain benchmark items, up to a number of edits.

An item of n characters may differ in ``k = floor(error_rate * n)`` characters. Cut into ``k + 1``
pieces, at least one piece must then occur unchanged, so one scan of each whole text for all pieces
(an Aho-Corasick automaton) misses nothing. Each hit says where the item would begin; Myers'
bit-parallel edit distance over that stretch decides.

Texts and items are compared in lower case with every blank character as a space; positions are code
points of the text. Items come to the tasks in blocks of bounded size; a larger benchmark takes more
passes.

An item of fewer than ``EDITED_CHARS`` characters (without outer blanks) has no edits and must stand
between characters that are no letters or digits. Matches carry the item's length, ``chars``.

Defined cases: NULL and blank texts and items match nothing; items of equal text are reported each,
repeated benchmark rows once; repeated document rows give repeated matches; empty tables give no
rows; texts of any length are searched whole; extra columns do not matter.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

import ahocorasick
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, matched, stored, table, text_hash

ERROR_RATE = 0.05
# Shorter items occur with a few edits by chance; they are searched as they are, at word bounds.
EDITED_CHARS = 40
# A document goes for items of so many characters; shorter ones are a word or two, and only reported.
CLEAN_CHARS = 20
# Items that one pass looks for, and their characters.
BLOCK_ITEMS = 20_000
BLOCK_CHARS = 16_000_000


def folded(text: str) -> str:
    """Lower case with spaces for blanks, at unchanged positions."""
    lower = text.lower()
    if len(lower) != len(text):
        lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    for blank in "\t\n\x0b\x0c\r":
        if blank in lower:
            lower = lower.replace(blank, " ")
    return lower


def myers(pattern: str, text: str, anchored: bool = False) -> tuple[int, int]:
    """Least edits of ``pattern`` against a substring of ``text``, and the first end that has it.

    With ``anchored`` the substring must begin at the beginning of the text.
    """
    size = len(pattern)
    full, top = (1 << size) - 1, 1 << (size - 1)
    where: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        where[c] |= 1 << i
    plus, minus, score = full, 0, size
    best, end = size, 0
    for i, c in enumerate(text, 1):
        equal = where.get(c, 0)
        vertical = equal | minus
        diagonal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (full & ~(diagonal | plus))
        down = plus & diagonal
        score += bool(up & top) - bool(down & top)
        up = up << 1 | anchored
        plus = ((down << 1) | ~(vertical | up)) & full
        minus = up & vertical & full
        if score < best:
            best, end = score, i
    return best, end


class ItemSearch:
    """Finds the items ``(item_id, text)`` in texts."""

    def __init__(self, items: list[tuple], error_rate: float):
        self.items = []
        self.automaton = ahocorasick.Automaton()
        pieces = defaultdict(set)
        for item_id, text in items:
            pattern = folded(text or "").strip()
            if not pattern:
                continue
            edits = int(error_rate * len(pattern)) if len(pattern) >= EDITED_CHARS else 0
            number = len(self.items)
            self.items.append((item_id, pattern, edits))
            ends = [len(pattern) * i // (edits + 1) for i in range(edits + 2)]
            for a, b in zip(ends, ends[1:]):
                pieces[pattern[a:b]].add((number, b))
        for piece, uses in pieces.items():
            self.automaton.add_word(piece, tuple(uses))
        if pieces:
            self.automaton.make_automaton()

    def matches(self, text: str | None) -> list[tuple]:
        """``(item_id, start, end, edits, chars)``: the best place of each item that occurs."""
        if not text or not len(self.automaton):
            return []
        text = folded(text)
        starts: dict[int, set[int]] = defaultdict(set)
        for end, uses in self.automaton.iter(text):
            for number, offset in uses:
                starts[number].add(end + 1 - offset)
        found = []
        for number, places in starts.items():
            item_id, pattern, edits = self.items[number]
            best = None
            if len(pattern) < EDITED_CHARS:
                best = self._between_words(pattern, text, sorted(places))
                places = ()
            for first, last in self._stretches(sorted(places), edits):
                low, high = max(0, first - edits), last + len(pattern) + edits
                place = self._verify(pattern, text[low:high], edits)
                if place and (best is None or place[2] < best[2]):
                    best = (place[0] + low, place[1] + low, place[2])
            if best:
                found.append((item_id, *best, len(pattern)))
        return found

    @staticmethod
    def _between_words(pattern: str, text: str, places: list[int]) -> tuple[int, int, int] | None:
        for start in places:
            end = start + len(pattern)
            if not (text[max(0, start - 1) : start].isalnum() or text[end : end + 1].isalnum()):
                return start, end, 0
        return None

    @staticmethod
    def _stretches(places: list[int], edits: int) -> list[tuple[int, int]]:
        joined: list[tuple[int, int]] = []
        for place in places:
            if joined and place - joined[-1][1] <= 2 * edits:
                joined[-1] = (joined[-1][0], place)
            else:
                joined.append((place, place))
        return joined

    @staticmethod
    def _verify(pattern: str, text: str, edits: int) -> tuple[int, int, int] | None:
        at = text.find(pattern)
        if at >= 0:
            return at, at + len(pattern), 0
        distance, end = myers(pattern, text)
        if distance > edits:
            return None
        _, length = myers(pattern[::-1], text[:end][::-1], anchored=True)
        return end - length, end, distance


_SEARCHES: dict[str, ItemSearch] = {}


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    error_rate: float = ERROR_RATE,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """``doc_id, text_hash, item_id, start, end, edits, chars``: one row for each document and item in it."""
    doc_kind, item_kind = dict(docs.dtypes)["doc_id"], dict(benchmark.dtypes)["item_id"]
    schema = f"doc_id {doc_kind}, text_hash bigint, found array<struct<item_id: {item_kind}, start: bigint, end: bigint, edits: bigint, chars: bigint>>"
    source = docs.select("doc_id", text_hash().alias("text_hash"), F.col("text").cast("string"))
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text"))
    items = items.distinct()
    number, chars = items.agg(F.count("*"), F.sum(F.char_length("text"))).first()
    blocks = max(1, -(-number // block_items), -(-(chars or 0) // BLOCK_CHARS))
    passes = []
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        passes.append(_one_pass(source, [tuple(r) for r in part.collect()], error_rate, schema))
    found = reduce(DataFrame.unionByName, passes)
    rows = found.select("doc_id", "text_hash", F.explode("found").alias("f"))
    return rows.select("doc_id", "text_hash", "f.*")


def _one_pass(source: DataFrame, items: list[tuple], error_rate: float, schema: str) -> DataFrame:
    shipped = source.sparkSession.sparkContext.broadcast(items)
    key = f"{id(shipped)}-{len(items)}-{hash(tuple(items))}"

    def search(columns: dict[str, list]) -> dict[str, list]:
        if key not in _SEARCHES:
            _SEARCHES.clear()
            _SEARCHES[key] = ItemSearch(shipped.value, error_rate)
        one = _SEARCHES[key]
        found = [one.matches(text) for text in columns["text"]]
        names = ("item_id", "start", "end", "edits", "chars")
        hits = [i for i, f in enumerate(found) if f]
        return {
            "doc_id": [columns["doc_id"][i] for i in hits],
            "text_hash": [columns["text_hash"][i] for i in hits],
            "found": [[dict(zip(names, row)) for row in found[i]] for i in hits],
        }

    return map_rows(source, search, schema)


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    error_rate: float = ERROR_RATE,
    least_chars: int = CLEAN_CHARS,
) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item of ``least_chars`` characters or more."""
    found = contaminated(docs, benchmark, error_rate)
    found = found.filter(F.col("chars") >= least_chars)
    dirty = stored(found.select("doc_id", "text_hash").distinct(), "dirty")
    return matched(docs, dirty, "left_anti", "doc_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "start", "end", "edits", "chars")
