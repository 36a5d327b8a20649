"""Prefix trie of conversations: double-array tries per prefix shard, merged at the shared top.

A turn is its role and text; equal turns share a digest, and a conversation is the sequence of its
turns' digests. Equal conversations are counted as one *sequence* first. The distinct sequences are
dealt to shards by ranges of their digests: a shard is a run of whole subtrees, whatever share of the
conversations begins alike, and only nodes on its two edges also occur in the shards beside it.

In a shard, turns get dense codes and the sequences are packed into a double-array trie
(``DoubleArray``): the child of slot ``s`` by code ``c`` is ``BASE[s] + c``, and ``CHECK`` there is
``s``. Walking all sequences through the arrays gives each node's aggregates. A shard knows the
sequences beside its edges, so that it counts a shared node's own share only once: all aggregates
of the nodes that shards have in common then simply add up by node, in one small grouping.

Texts leave their row as digest and word count only. One task holds one shard, or one conversation's
digests (36 bytes a turn); the ids that end at a node pass through a task as a stream.

Defined cases: turns of a conversation stand by turn number (NULL first), then role, then digest; so
repeated turns stay, side by side. NULL roles and texts are empty. Rows without ``conv_id`` belong to
no conversation and are left out. An empty table has no node, not even the root. Texts of any length
count whole. Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import as_text, crc32_sql, remainder, small_enough, stored, table, word_count
from tidemark.session import SHUFFLE_TASKS

DIGEST = 32
# Turns of distinct sequences in a shard; more only beyond SHUFFLE_TASKS shards.
SHARD_TURNS = 1 << 17
# Ids that travel as one text, on their way to the digest of a node's ends.
BLOCK_IDS = 4096
# Free places tried for a family of children before it goes to the end of the arrays.
TRIES = 64
FREE = -1

SEQUENCE = "path binary, words array<int>, n bigint, least bigint, ends string"
NODE = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends_sha256 string, node_key binary, parent_key binary"
)


class DoubleArray:
    """A trie of code sequences in two arrays, with its nodes level by level."""

    def __init__(self, sequences: Sequence[np.ndarray], codes: int):
        self.codes = codes
        self.base = np.zeros(1, np.int64)
        self.check = np.full(1, FREE, np.int64)
        self.check[0] = 0
        self._used = 1
        self.levels = [np.zeros(1, np.int64)]
        lengths = np.array([len(s) for s in sequences], np.int64)
        starts = np.cumsum(lengths) - lengths
        flat = np.concatenate(sequences) if len(sequences) else np.zeros(0, np.int64)
        slot = np.zeros(len(sequences), np.int64)
        going = np.flatnonzero(lengths > 0)
        while len(going):
            depth = len(self.levels) - 1
            code = flat[starts[going] + depth]
            pairs = np.unique(slot[going] * codes + code)
            self._place(pairs // codes, pairs % codes)
            slot[going] = self.base[slot[going]] + code
            self.levels.append(self.base[pairs // codes] + pairs % codes)
            going = going[lengths[going] > depth + 1]

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.append(self.base, np.zeros(more, np.int64))
            self.check = np.append(self.check, np.full(more, FREE, np.int64))

    def _place(self, parents: np.ndarray, codes: np.ndarray) -> None:
        """Finds a base for each parent, its children given side by side: families, then only children."""
        starts = np.flatnonzero(np.append(True, parents[1:] != parents[:-1]))
        sizes = np.diff(np.append(starts, len(parents)))
        for start, size in zip(starts[sizes > 1], sizes[sizes > 1]):
            family = codes[start : start + size]
            span = int(family[-1] - family[0]) + 1
            self._grow(self._used + span)
            free = np.flatnonzero(self.check[: self._used] == FREE)[:TRIES]
            places = np.append(free, self._used)[:, None] + (family - family[0])
            fits = (self.check[np.minimum(places, len(self.check) - 1)] == FREE).all(axis=1)
            place = places[np.argmax(fits)]
            self.base[parents[start]] = place[0] - family[0]
            self.check[place] = parents[start]
            self._used = max(self._used, int(place[-1]) + 1)
        only = starts[sizes == 1]
        self._grow(self._used + len(only))
        place = np.flatnonzero(self.check == FREE)[: len(only)]
        self.base[parents[only]] = place - codes[only]
        self.check[place] = parents[only]
        if len(place):
            self._used = max(self._used, int(place[-1]) + 1)

    def child(self, slot: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The slots one turn further; ``FREE`` where there is none."""
        to = self.base[slot] + code
        inside = (to > 0) & (to < len(self.check))
        found = inside & (self.check[np.where(inside, to, 0)] == slot)
        return np.where(found, to, FREE)

    def find(self, sequence: Sequence[int]) -> int:
        slot = np.zeros(1, np.int64)
        for code in sequence:
            slot = self.child(slot, np.array([code]))
            if slot[0] == FREE:
                return FREE
        return int(slot[0])


def _shared_turns(a: bytes | None, b: bytes | None) -> int:
    """Number of turns that two sequences begin with alike; -1 if there is no second one."""
    if a is None or b is None:
        return -1
    turns = min(len(a), len(b)) // DIGEST
    return next(
        (i for i in range(turns) if a[i * DIGEST : (i + 1) * DIGEST] != b[i * DIGEST : (i + 1) * DIGEST]),
        turns,
    )


def shard_nodes(
    sequences: Sequence[tuple[bytes, Sequence[int], int, int, str]],
    before: bytes | None,
    after: bytes | None,
) -> dict[str, list]:
    """The nodes of one shard; ``before`` and ``after`` are the sequences beside it.

    A node that other shards may have as well has a ``node_key``, and a node below one a
    ``parent_key`` instead of its parent's id. Of such a node only the first shard counts it as a
    child and takes off its one necessary reading.
    """
    sequences = sorted(sequences)
    paths = [s[0] for s in sequences]
    lengths = np.array([len(p) // DIGEST for p in paths], np.int64)
    dense: dict[bytes, int] = {}
    coded = [np.zeros(n, np.int64) for n in lengths]
    going, depth = list(range(len(paths))), 0
    while going := [i for i in going if lengths[i] > depth]:
        for i in going:
            turn = paths[i][depth * DIGEST : (depth + 1) * DIGEST]
            coded[i][depth] = dense.setdefault(turn, len(dense))
        depth += 1
    trie = DoubleArray(coded, max(1, len(dense)))

    size = len(trie.check)
    convs, words, children, leaves, saved = (np.zeros(size, np.int64) for _ in range(5))
    least = np.full(size, np.iinfo(np.int64).max)
    owned = np.ones(size, bool)
    ends: dict[int, str] = {}
    keys: dict[int, bytes] = {}
    count = np.array([s[2] for s in sequences], np.int64)
    smallest = np.array([s[3] for s in sequences], np.int64)

    # Walk all sequences a turn at a time; note the shared nodes at both edges on the way.
    last, first_shared = len(paths) - 1, _shared_turns(before, paths[0])
    edges = {0: first_shared}
    edges[last] = max(edges.get(last, -1), _shared_turns(paths[-1], after))
    hashes = {i: hashlib.sha256() for i in edges}
    slot = np.zeros(len(paths), np.int64)
    going, depth = np.arange(len(paths)), 0
    while len(going):
        np.add.at(convs, slot[going], count[going])
        np.minimum.at(least, slot[going], smallest[going])
        for i, shared in edges.items():
            if depth <= shared:
                keys[int(slot[i])] = hashes[i].digest()
        if depth <= first_shared:
            owned[slot[0]] = False
        for i in going[lengths[going] == depth]:
            ends[int(slot[i])] = sequences[i][4]
        going = going[lengths[going] > depth]
        code = np.array([coded[i][depth] for i in going], np.int64)
        slot[going] = trie.child(slot[going], code)
        words[slot[going]] = [sequences[i][1][depth] for i in going]
        for i in edges:
            hashes[i].update(paths[i][depth * DIGEST : (depth + 1) * DIGEST])
        depth += 1

    # Up from the deepest nodes, whose parents stand in CHECK.
    for nodes in reversed(trie.levels[1:]):
        np.add.at(children, trie.check[nodes], owned[nodes])
    nodes = np.concatenate(trie.levels)
    inner = np.zeros(size, bool)
    inner[trie.check[nodes[1:]]] = True
    leaves[nodes] = ~inner[nodes]
    if after is not None and after.startswith(paths[last]):
        leaves[slot[last]] = 0
    saved[nodes] = (convs[nodes] - owned[nodes]) * words[nodes]
    for level in reversed(trie.levels[1:]):
        np.add.at(leaves, trie.check[level], leaves[level])
        np.add.at(saved, trie.check[level], saved[level])

    depths = np.repeat(np.arange(len(trie.levels)), [len(level) for level in trie.levels])
    parents = [None if s == 0 else int(trie.check[s]) for s in nodes.tolist()]
    return {
        "conv_id": least[nodes],
        "depth": depths,
        "parent_conv_id": [None if p is None or p in keys else int(least[p]) for p in parents],
        "n_convs": convs[nodes],
        "n_children": children[nodes],
        "n_leaves": leaves[nodes],
        "saved_tokens": saved[nodes],
        "ends_sha256": [ends.get(s) for s in nodes.tolist()],
        "node_key": [keys.get(s) for s in nodes.tolist()],
        "parent_key": [keys.get(p) for p in parents],
    }


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def turn_lists(turns: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """One row per conversation: ``conv_id, turns`` with the digest and word count of each turn."""
    said = turns.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("bigint").alias("conv_id"),
        F.struct(
            F.col("turn"),
            as_text("role").alias("role"),
            F.unhex(
                F.sha2(
                    F.concat(F.octet_length(as_text("role")), F.lit(":"), as_text("role"), as_text()),
                    256,
                )
            ).alias("digest"),
            word_count().cast("int").alias("words"),
        ).alias("turn"),
    )
    ordered = F.sort_array(F.collect_list("turn"))
    return said.groupBy("conv_id").agg(
        F.transform(ordered, lambda t: F.struct(t["digest"], t["words"])).alias("turns")
    )


def _stream_ends(ids: DataFrame) -> DataFrame:
    """``seq, n, least, ends`` of rows ``seq, conv_id``: count, smallest, digest of the sorted ids.

    The digest of a sequence's ids has to be computed in order. Ids, dealt by ranges of both columns,
    become texts of up to BLOCK_IDS ids; a task streams a sequence's texts through one hash.
    """
    block = _arrow("seq binary, least bigint, n bigint, ids string")
    result = _arrow("seq binary, n bigint, least bigint, ends string")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seqs, convs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows, begin = [], 0
            for i in range(1, len(seqs) + 1):
                if i == len(seqs) or seqs[i] != seqs[begin] or i - begin == BLOCK_IDS:
                    rows.append((seqs[begin], convs[begin], i - begin, ",".join(map(str, convs[begin:i]))))
                    begin = i
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), block)] if rows
                else [pa.array([], f.type) for f in block],
                schema=block,
            )

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = state = None

        def done(rows):
            return pa.RecordBatch.from_pylist(rows, schema=result)

        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if own is None or own["seq"] != row["seq"]:
                    if own is not None:
                        rows.append(own | {"ends": state.hexdigest()})
                    own = {"seq": row["seq"], "n": 0, "least": row["least"]}
                    state = hashlib.sha256()
                elif own["n"]:
                    state.update(b",")
                own["n"] += row["n"]
                state.update(row["ids"].encode())
            yield done(rows)
        if own is not None:
            yield done([own | {"ends": state.hexdigest()}])

    dealt = ids.repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    texts = dealt.mapInArrow(blocks, "seq binary, least bigint, n bigint, ids string")
    together = texts.repartition("seq").sortWithinPartitions("seq", "least")
    return together.mapInArrow(hashes, "seq binary, n bigint, least bigint, ends string")


def sequences(lists: DataFrame) -> DataFrame:
    """The distinct sequences of ``conv_id, turns`` with members, smallest member and digest of ids."""
    path = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), ""))
    rows = lists.select("conv_id", path.alias("path"), F.col("turns.words").alias("words"))
    rows = stored(rows.withColumn("seq", F.unhex(F.sha2("path", 256))), "trie-sequences")
    ends = _stream_ends(rows.select("seq", "conv_id"))
    distinct = rows.groupBy("seq").agg(F.first("path").alias("path"), F.first("words").alias("words"))
    return distinct.join(ends, "seq").select("path", "words", "n", "least", "ends")


def trie(lists: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """All nodes of the prefix trie of ``conv_id, turns``; a conversation may have no turns."""
    distinct = stored(sequences(lists), "trie-distinct")
    turns = distinct.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    shards = min(SHUFFLE_TASKS, max(1, math.ceil(turns / shard_turns)))
    dealt = distinct.repartitionByRange(shards, "path")
    dealt = stored(dealt.withColumn("shard", F.spark_partition_id()), "trie-shards")

    # One row a shard; the sequences beside it become marked rows of the shard.
    along = Window.orderBy("shard")
    edges = dealt.groupBy("shard").agg(F.min("path").alias("low"), F.max("path").alias("high"))
    edges = edges.select(
        "shard", F.lag("high").over(along).alias("before"), F.lead("low").over(along).alias("after")
    )
    kind = F.lit(0).alias("kind")
    marked = dealt.select("shard", kind, "path", "words", "n", "least", "ends")
    for number, name in ((1, "before"), (2, "after")):
        beside = edges.filter(F.col(name).isNotNull())
        marker = beside.select("shard", F.lit(number).alias("kind"), F.col(name).alias("path"))
        marked = marked.unionByName(marker, allowMissingColumns=True)
    target = _arrow(NODE)

    def packed(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        beside = {r["kind"]: r["path"] for r in rows if r["kind"]}
        own = [tuple(r[c] for c in ("path", "words", "n", "least", "ends")) for r in rows if not r["kind"]]
        nodes = shard_nodes(own, beside.get(1), beside.get(2))
        return pa.table([pa.array(nodes[f.name], f.type) for f in target], schema=target)

    found = stored(marked.groupBy("shard").applyInArrow(packed, NODE), "trie-nodes")
    own = found.filter("node_key IS NULL").drop("node_key")
    summed = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    shared = found.filter("node_key IS NOT NULL").groupBy("node_key", "depth")
    shared = shared.agg(
        F.min("conv_id").alias("conv_id"),
        *[F.sum(name).alias(name) for name in summed],
        F.max("ends_sha256").alias("ends_sha256"),
        F.max("parent_key").alias("parent_key"),
        F.lit(None).cast("bigint").alias("parent_conv_id"),
    )
    shared = stored(shared, "trie-shared")
    above = shared.select(F.col("node_key").alias("parent_key"), F.col("conv_id").alias("_above"))
    nodes = own.unionByName(shared.drop("node_key")).join(small_enough(above), "parent_key", "left")
    return nodes.select(
        "conv_id",
        "depth",
        F.coalesce("parent_conv_id", "_above").alias("parent_conv_id"),
        *summed,
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def rebuilt(lists: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """Conversations whose first turns are those of their family's first conversation.

    A conversation c takes the first h of c - c % family, then its own after its first h, where h is
    the crc32 of c modulo ``most``.
    """
    lists = stored(
        lists.withColumns(
            {"h": remainder(most, "conv_id").cast("int"), "first": F.expr(f"conv_id - conv_id % {family}")}
        ),
        "trie-lists",
    )
    heads = lists.filter("conv_id = first").select(
        "first", F.slice("turns", 1, most - 1).alias("head")
    )
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    none = F.array().cast(lists.schema["turns"].dataType)
    head = F.slice(F.coalesce("head", none), F.lit(1), F.col("h"))
    return lists.join(heads, "first", "left").select("conv_id", F.concat(head, own).alias("turns"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations."""
    return trie(rebuilt(turn_lists(table(spark, sf_dir, "conversations"))))


def sql() -> str:
    """The same in SQL, by all prefixes of every conversation."""
    return f"""
    WITH said AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL),
    lists AS (
        SELECT conv_id, {crc32_sql('conv_id::VARCHAR')} % 4 AS h, conv_id - conv_id % 20 AS base,
            list({{'key': key, 'words': words}} ORDER BY turn NULLS FIRST, role, key) AS turns
        FROM (SELECT conv_id, turn, role, sha256(strlen(role) || ':' || role || text) AS key,
            len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words FROM said)
        GROUP BY conv_id),
    rebuilt AS (
        SELECT own.conv_id AS c, list_concat(coalesce(b.turns, [])[:own.h], own.turns[own.h + 1:]) AS turns
        FROM lists own LEFT JOIN lists b ON b.conv_id = own.base),
    prefixes AS (
        SELECT c, len(turns) AS size, d, [t.key for t in turns[:d]] AS path,
            CASE WHEN d > 0 THEN turns[d].words ELSE 0 END AS words
        FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM rebuilt)),
    nodes AS (
        SELECT path, d, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
            sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (size = d), '')) AS ends_sha256
        FROM prefixes GROUP BY path, d),
    families AS (SELECT path[:d - 1] AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
    below AS (
        SELECT path[:unnest(range(d + 1))] AS path, (n_convs - 1) * words AS saved,
            (path NOT IN (SELECT path FROM families))::BIGINT AS leaf FROM nodes),
    sums AS (SELECT path, sum(saved)::BIGINT AS saved, sum(leaf)::BIGINT AS leaves FROM below GROUP BY path)
    SELECT v.conv_id, v.d AS depth, p.conv_id AS parent_conv_id, v.n_convs,
        coalesce(f.n, 0) AS n_children, s.leaves AS n_leaves, s.saved AS saved_tokens, v.ends_sha256
    FROM nodes v LEFT JOIN nodes p ON v.d > 0 AND p.path = v.path[:v.d - 1]
    LEFT JOIN families f ON f.path = v.path JOIN sums s ON s.path = v.path"""
