"""Removing word passages that occur anywhere else, by compacting a de Bruijn graph of the corpus.

An edge of the graph is a window of ``WINDOW`` consecutive words; it joins the node of its first
words to the node of its last. An edge that starts at two places or more is *repeated*, and every word
under a repeated edge goes, in all its occurrences; edges are judged on the input.

Edges are far too many to shuffle one by one. Each has a *minimizer*, the least hash among its runs of
``ANCHOR`` words, and consecutive edges with the same minimizer occurrence form a nonbranching path
that is written as one row: minimizer, hash of the path's words, place and length (about one row for
fifteen words). Equal edges have equal minimizers, so joins on the minimizer decide everything:

* a minimizer that occurs once: none of its edges is repeated;
* all its paths have the same words: all their edges are repeated, and each path compacts as it is;
* its paths differ: only there the single edges are written out, counted, and joined again.

Last, the repeated paths of each document are merged by their coordinates into maximal spans, and the
words of each document are cut there. Counting combines before each shuffle, so a passage that a
third of all documents share costs a row per task and path; the joins bring paths to counts, one row
a key, and AQE splits what is skewed.

Defined cases: NULL text has no words; fewer words than a window have no edge; rows equal in id and
text are different documents, so all their windows repeat; a NULL id is an id of its own; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, same, small_enough, stored, table, text_hash

WINDOW = 35
ANCHOR = 8
# Words of a text handled at once; longer texts take overlapping pieces.
PIECE_WORDS = 1 << 20
# Word hashes that a Python worker remembers.
CACHE_ENTRIES = 100_000
# Bytes of texts or paths that a Python worker turns into rows at once.
SLICE_BYTES = 2 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_POSITIONS = np.uint64(PIECE_WORDS * 2 - 1)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _Hashes()
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(count: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if len(_POWERS[0]) < count:
        size = max(count, 2 * len(_POWERS[0]))
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for i, base in enumerate((_BASE, inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * _M1
    values = (values ^ (values >> np.uint64(27))) * _M2
    return values ^ (values >> np.uint64(31))


class _Piece:
    """Hashes of runs of words; equal runs have equal hashes wherever they stand."""

    def __init__(self, words: list[bytes]):
        hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
        up, self.down = _powers(len(words) + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[: len(words)], dtype=np.uint64)])

    def runs(self, starts: np.ndarray, widths) -> np.ndarray:
        return _mixed((self.sums[starts + widths] - self.sums[starts]) * self.down[starts])


def paths(words: list[bytes], window: int, anchor: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``minimizer, path hash, first edge, number of edges`` of the nonbranching paths, by piece."""
    for begin in range(0, max(0, len(words) - window + 1), PIECE_WORDS):
        part = words[begin : begin + PIECE_WORDS + window - 1]
        edges = len(part) - window + 1
        piece = _Piece(part)
        grams = piece.runs(np.arange(len(part) - anchor + 1), anchor)
        # The high bits rank the runs, the low ones say where: the first of equal runs is taken.
        least = (grams & ~_POSITIONS) | np.arange(len(grams), dtype=np.uint64)
        reach, need = 1, window - anchor + 1
        while reach < need:
            step = min(reach, need - reach)
            least = np.minimum(least[:-step], least[step:])
            reach += step
        at = (least[:edges] & _POSITIONS).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        count = np.diff(np.append(first, edges))
        yield grams[at[first]], piece.runs(first, count + window - 1), first + begin, count


def edge_hashes(words: list[bytes], starts: np.ndarray, window: int) -> np.ndarray:
    """Hashes of the windows at ``starts``; pieces only bound the memory."""
    out = np.empty(len(starts), np.uint64)
    for begin in range(0, len(words), PIECE_WORDS):
        mine = (starts >= begin) & (starts < begin + PIECE_WORDS)
        if mine.any():
            piece = _Piece(words[begin : begin + PIECE_WORDS + window - 1])
            out[mine] = piece.runs(starts[mine] - begin, window)
    return out


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.empty(0, np.int64), *parts])


def _source(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", text_hash().alias("text_hash"), F.col("text").cast("string"))


def path_table(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id, text_hash, minimizer, path, first, edges`` of all documents."""

    def cut(columns: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {n: [] for n in ("doc_id", "text_hash", "minimizer", "path", "first", "edges")}
        for doc_id, key, text in zip(columns["doc_id"], columns["text_hash"], columns["text"]):
            for minimizer, path, first, edges in paths(_words(text), window, anchor):
                out["doc_id"] += [doc_id] * len(first)
                out["text_hash"] += [key] * len(first)
                out["minimizer"].append(minimizer.view(np.int64))
                out["path"].append(path.view(np.int64))
                out["first"].append(first)
                out["edges"].append(edges)
        return out | {n: _joined(out[n]) for n in ("minimizer", "path", "first", "edges")}

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, text_hash bigint, minimizer bigint, path bigint, first int, edges int"
    return map_rows(_source(docs), cut, schema, SLICE_BYTES)


def _edges_of(docs: DataFrame, mixed: DataFrame, window: int, anchor: int) -> DataFrame:
    """``doc_id, text_hash, minimizer, edge, first`` for the single edges of paths in ``mixed``."""
    lists = mixed.groupBy("doc_id", "text_hash").agg(F.collect_set("first").alias("firsts"))
    lists = stored(lists, "mixed-paths").withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    match = same(F.col("doc_id"), F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    joined = _source(docs).join(small_enough(lists), match).select("doc_id", "text_hash", "text", "firsts")

    def write(columns: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {n: [] for n in ("doc_id", "text_hash", "minimizer", "edge", "first")}
        for doc_id, key, text, firsts in zip(*(columns[n] for n in ("doc_id", "text_hash", "text", "firsts"))):
            words = _words(text)
            for minimizer, _, first, count in paths(words, window, anchor):
                mine = np.isin(first, firsts)
                first, count = first[mine], count[mine]
                # The edges of all chosen paths: each path's first, plus 0, 1, ... within the path.
                inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                starts = np.repeat(first, count) + inside
                out["doc_id"] += [doc_id] * len(starts)
                out["text_hash"] += [key] * len(starts)
                out["minimizer"].append(np.repeat(minimizer[mine], count).view(np.int64))
                out["edge"].append(edge_hashes(words, starts, window).view(np.int64))
                out["first"].append(starts)
        return out | {n: _joined(out[n]) for n in ("minimizer", "edge", "first")}

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, text_hash bigint, minimizer bigint, edge bigint, first int"
    return map_rows(joined, write, schema, SLICE_BYTES)


def repeated_spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id, text_hash, spans``: merged word spans (start, end) of what occurs elsewhere too."""
    table_ = stored(path_table(docs, window, anchor), "paths")
    kinds = table_.groupBy("minimizer").agg(
        F.count("*").alias("n"), (F.min("path") < F.max("path")).alias("mixed")
    )
    kinds = stored(kinds.filter("n > 1").select("minimizer", "mixed"), "repeated-minimizers")
    shared = stored(table_.join(kinds, "minimizer"), "shared-paths")
    whole = shared.filter("not mixed").select("doc_id", "text_hash", "first", "edges")

    edges = stored(_edges_of(docs, shared.filter("mixed"), window, anchor), "single-edges")
    often = edges.groupBy("minimizer", "edge").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    often = stored(often, "repeated-edges")
    single = edges.join(often, ["minimizer", "edge"])
    single = single.select("doc_id", "text_hash", "first", F.lit(1).alias("edges"))

    places = whole.unionByName(single).groupBy("doc_id", "text_hash")
    # A set: rows equal in id (or without one) and text bring the same paths, once a task. Both numbers
    # of a path are in one, since a set of structs takes several times the memory.
    path = F.shiftleft(F.col("first").cast("bigint"), 32) + F.col("edges")
    listed = places.agg(F.collect_set(path).alias("paths"))

    def merge(columns: dict[str, list]) -> dict[str, list]:
        merged = []
        for found in columns["paths"]:
            spans: list[dict[str, int]] = []
            for path in sorted(found):
                first, edges = divmod(path, 1 << 32)
                end = first + edges + window - 1
                if spans and first <= spans[-1]["end"]:
                    spans[-1]["end"] = max(spans[-1]["end"], end)
                else:
                    spans.append({"start": first, "end": end})
            merged.append(spans)
        return {"doc_id": columns["doc_id"], "text_hash": columns["text_hash"], "spans": merged}

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, text_hash bigint, spans array<struct<start: int, end: int>>"
    return stored(map_rows(listed, merge, schema, SLICE_BYTES), "repeated-spans")


def without_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` for each row of ``docs``."""
    spans = repeated_spans(docs, window, anchor)
    spans = spans.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    match = same(F.col("doc_id"), F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    joined = _source(docs).join(small_enough(spans), match, "left").select("doc_id", "text", "spans")

    def cut(columns: dict[str, list]) -> dict[str, list]:
        total, kept_text, removed = [], [], []
        for text, found in zip(columns["text"], columns["spans"]):
            words = _words(text)
            kept, at = [], 0
            for span in found or ():
                kept += words[at : span["start"]]
                at = span["end"]
            kept += words[at:]
            total.append(len(words))
            removed.append(len(words) - len(kept))
            kept_text.append(b" ".join(kept).decode())
        return {"doc_id": columns["doc_id"], "n_words": total, "n_removed": removed, "kept_text": kept_text}

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_words bigint, n_removed bigint, kept_text string"
    return map_rows(joined, cut, schema, SLICE_BYTES)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256")
    )
