"""Merkle manifest of a dataset: slot pivots up to one root, sibling paths down to every row.

A *digest* is ``H``: the SHA-256 of concatenated inputs, in which digests stand as lowercase hex text;
tables hold it as 32 bytes. Rows are leaves of one tree per group. In a tree, leaves stand in order,
every ``fanout`` consecutive nodes (a last run may have fewer, even one) become one parent, and a
tree ends with its single node, the *subroot*; a lone leaf is its own. The subroots of the groups,
ordered by group, are the leaves of the top tree, which ends with the root.

One conditional aggregate per level spreads each parent's children into ``fanout`` slot columns
(``_slots``). Concatenating the columns hashes the parent; leaving out a node's own column gives its
siblings. A level has an eighth of the rows of the one below, and no key has more than ``fanout``
rows, however many rows a group holds; positions come from ranges, see ``numbered``.

Defined cases: NULL groups and ids come first; a NULL field is hashed as ``-`` and an empty one as
``0:``, so that they differ. Leaves of one group and id stand in the order of their digests; repeated
rows are leaves of their own, with equal digests. A text of any length is hashed whole and goes no
further than its row. An empty table has no rows and no root. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import crc32_sql, remainder, stored, table
from tidemark.operators.skew import numbered, same_keys

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def as_hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def hashed(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of a row: each field as its UTF-8 length, a colon and its text, or ``-`` for NULL."""
    texts = [field.cast("string") for field in fields]
    marked = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return hashed(F.concat(*[F.coalesce(m, F.lit("-")) for m in marked]))


@dataclass(frozen=True)
class Tree:
    """The parents of each height, bottom up, as stored tables, and the one top of each group."""

    levels: list[DataFrame]
    tops: DataFrame
    fanout: int


def _slots(nodes: DataFrame, group: Sequence[str], carried: Sequence[str], fanout: int) -> DataFrame:
    """One row per parent: ``c0, c1, ...`` hold its children in order, ``digest`` its hash."""
    child = ", ".join(["digest", *carried])
    parents = nodes.groupBy(
        *group, F.expr(f"pos div {fanout} AS pos"), F.expr(f"(size + {fanout - 1}) div {fanout} AS size")
    ).agg(
        *[F.expr(f"max(CASE WHEN pos % {fanout} = {k} THEN struct({child}) END) AS c{k}") for k in range(fanout)]
    )
    return parents.withColumn("digest", hashed(as_hex(F.expr(_joined(range(fanout))))))


def _joined(slots: range) -> str:
    """SQL for the digests of these slots, one after the other; empty slots give nothing."""
    return f"concat({', '.join(['binary(\'\')', *[f'coalesce(c{k}.digest, binary(\'\'))' for k in slots]])})"


def build(
    leaves: DataFrame, group: Sequence[str], order: Sequence[str], fanout: int = FANOUT
) -> Tree:
    """The trees over ``leaves``, one per ``group``; their columns besides ``digest`` are carried.

    Rows that agree in ``order`` and digest may be many: a running number deals them to tasks.
    """
    carried = [name for name in leaves.columns if name not in (*group, "digest")]
    # Stored first: ranges are sampled in a pass of their own, which must not hash the texts again.
    tied = stored(leaves.withColumn("_tie", F.monotonically_increasing_id()), "manifest-digests")
    placed = stored(numbered(tied, group, [*order, "digest", "_tie"], "_place"), "manifest-leaves")
    sizes = placed.groupBy(*group).agg(F.max("_place").alias("size"))
    sizes = stored(sizes.withColumnsRenamed({g: f"_of_{g}" for g in group}), "manifest-sizes")
    grouped = [f"_of_{g}" for g in group]
    nodes = placed.withColumn("pos", F.col("_place") - 1).join(sizes, same_keys(group, grouped))
    largest = sizes.agg(F.max("size")).first()[0] or 0

    levels, found = [], [nodes.filter("size = 1").withColumn("height", F.lit(0))]
    kept = [*group, "height", "digest", *carried]
    while largest > 1:
        parents = _slots(nodes.filter("size > 1"), group, carried if not levels else (), fanout)
        levels.append(stored(parents, f"manifest-level-{len(levels) + 1}"))
        nodes = levels[-1].select(*group, "pos", "size", "digest")
        found.append(nodes.filter("size = 1").withColumn("height", F.lit(len(levels))))
        largest = -(-largest // fanout)
    tops = found[0].select(*kept)
    for top in found[1:]:
        tops = tops.unionByName(top.select(*[c for c in kept if c not in carried]), True)
    return Tree(levels, stored(tops, "manifest-tops"), fanout)


def _children(fanout: int) -> str:
    """SQL for a parent's children, each with what stands left and right of it in the run."""
    slots = [
        f"struct(pos * {fanout} + {k} AS pos, c{k} AS child, struct({_joined(range(k))} AS left, "
        f"{_joined(range(k + 1, fanout))} AS right) AS beside)"
        for k in range(fanout)
    ]
    return f"explode(array({', '.join(slots)})) AS _slot"


def paths(
    tree: Tree, above: DataFrame, group: Sequence[str], passed: Sequence[str] = ()
) -> DataFrame:
    """Every leaf with its ``path``: the siblings ``(left, right)`` of each height, bottom up.

    ``above`` gives each group's path above its top, and columns to pass on to all its leaves.
    """
    grouped = [f"_of_{g}" for g in group]
    names = {g: f"_of_{g}" for g in group} | {"pos": "_of_pos"}
    above = above.withColumnsRenamed({g: f"_of_{g}" for g in group})
    tops = tree.tops.join(above, same_keys(group, grouped)).drop(*grouped)
    carried = [c for c in tree.tops.columns if c not in (*group, "height", "digest")]
    going = [*group, "pos", "path", *passed]

    reached = None
    for height in range(len(tree.levels), 0, -1):
        begun = tops.filter(F.col("height") == height).withColumn("pos", F.lit(0).cast("bigint"))
        reached = begun.select(going) if reached is None else reached.select(going).union(
            begun.select(going)
        )
        parents = tree.levels[height - 1].drop("size", "digest")
        on = same_keys([*group, "pos"], [*grouped, "_of_pos"])
        joined = parents.join(reached.withColumnsRenamed(names), on)
        spread = joined.select(*group, "path", *passed, F.expr(_children(tree.fanout)))
        own = carried if height == 1 else []
        reached = spread.filter("_slot.child IS NOT NULL").select(
            *group,
            "_slot.pos",
            F.concat(F.array("_slot.beside"), F.col("path")).alias("path"),
            *passed,
            "_slot.child.digest",
            *[F.col(f"_slot.child.{name}").alias(name) for name in own],
        )
    columns = [*group, "digest", *carried, "path", *passed]
    alone = tops.filter("height = 0").select(columns)
    return alone if reached is None else alone.unionByName(reached.select(columns))


def sibling_text(path: Column) -> Column:
    """All siblings from the leaf's run to the root, left to right, as hex text."""
    return F.aggregate(
        path, F.lit(""), lambda text, at: F.concat(text, as_hex(at["left"]), as_hex(at["right"]))
    )


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf with this digest gives along ``path``."""
    return F.unhex(
        F.aggregate(
            path,
            as_hex(digest),
            lambda own, at: F.sha2(F.concat(as_hex(at["left"]), own, as_hex(at["right"])), 256),
        )
    )


def with_proofs(
    leaves: DataFrame, group: str, order: Sequence[str], fanout: int = FANOUT
) -> DataFrame:
    """``leaves`` with ``path, subroot, root``: all that proves a row to be part of the dataset."""
    lower = build(leaves, [group], order, fanout)
    subroots = lower.tops.select(F.lit(0).alias("whole"), F.col(group).alias("_group"), "digest")
    upper = build(subroots, ["whole"], ["_group"], fanout)
    root = upper.tops.select(
        "whole", F.col("digest").alias("root"), F.array().cast(_PATH).alias("path")
    )
    tops = paths(upper, root, ["whole"], ["root"]).select(
        F.col("_group").alias(group), F.col("digest").alias("subroot"), "root", "path"
    )
    return paths(lower, stored(tops, "manifest-subroots"), [group], ["subroot", "root"])


_PATH = "array<struct<left: binary, right: binary>>"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof of each document, and whether it still verifies after a third lost their capitals."""
    fields = [F.col(name) for name in FIELDS]
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = [lowered if name == "text" else F.col(name) for name in FIELDS]
    leaves = table(spark, sf_dir, "documents").select(
        "lang",
        "doc_id",
        leaf_digest(fields).alias("digest"),
        F.when(remainder(3) == 0, leaf_digest(changed)).alias("tampered"),
    )
    proofs = with_proofs(leaves, "lang", ["doc_id"]).withColumn(
        "folded", folded(F.coalesce("tampered", "digest"), F.col("path"))
    )
    return proofs.select(
        "doc_id",
        as_hex(F.col("digest")).alias("leaf"),
        as_hex(F.col("subroot")).alias("subroot"),
        as_hex(F.col("root")).alias("root"),
        F.sha2(sibling_text(F.col("path")), 256).alias("proof_sha256"),
        as_hex(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def sql(fanout: int = FANOUT, levels: int = 10) -> str:
    """The same in SQL, for groups of up to ``fanout ** levels`` documents.

    Its levels go on past a tree's top unchanged.
    """
    def leaf(text: str) -> str:
        parts = [
            f"coalesce(strlen({x}::VARCHAR) || ':' || {x}::VARCHAR, '-')"
            for x in ("doc_id", "source", "lang", "n_chars", text)
        ]
        return f"sha256({' || '.join(parts)})"

    steps = [
        f"""docs AS (SELECT *, coalesce(doc_id::VARCHAR, '') AS id FROM documents),
        leaves AS (SELECT doc_id, lang, {leaf('text')} AS leaf,
            CASE WHEN {crc32_sql('id')} % 3 = 0 THEN {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
            ELSE {leaf('text')} END AS own FROM docs),
        a0 AS (SELECT *, leaf AS node, own AS fold, '' AS proof,
            row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
            count(*) OVER (PARTITION BY lang) AS n FROM leaves)"""
    ]

    def climb(start: str, name: str, tree: str) -> str:
        """Each row climbs: runs are read from the distinct nodes of the level."""
        for k in range(levels):
            here, after = (start if k == 0 else f"{name}{k}"), f"{name}{k + 1}"
            steps.append(
                f"""{after}_runs AS (SELECT {tree}, pos // {fanout} AS run,
                    list(node ORDER BY pos) AS nodes FROM (SELECT DISTINCT {tree}, pos, node FROM {here})
                    GROUP BY ALL),
                {after} AS (SELECT h.* REPLACE (
                    CASE WHEN n > 1 THEN sha256(array_to_string(nodes, '')) ELSE node END AS node,
                    CASE WHEN n > 1 THEN sha256(array_to_string(nodes[:pos % {fanout}], '') || fold
                        || array_to_string(nodes[pos % {fanout} + 2:], '')) ELSE fold END AS fold,
                    CASE WHEN n > 1 THEN proof || array_to_string(nodes[:pos % {fanout}], '')
                        || array_to_string(nodes[pos % {fanout} + 2:], '') ELSE proof END AS proof,
                    pos // {fanout} AS pos, (n + {fanout - 1}) // {fanout} AS n)
                FROM {here} h JOIN {after}_runs r
                ON h.{tree} IS NOT DISTINCT FROM r.{tree} AND h.pos // {fanout} = r.run)"""
            )
        return f"{name}{levels}"

    last = climb("a0", "a", "lang")
    steps.append(
        f"""b0 AS (SELECT * REPLACE (dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos),
            node AS subroot, 0 AS whole FROM {last}),
        c0 AS (SELECT * REPLACE (max(pos) OVER () + 1 AS n) FROM b0)"""
    )
    last = climb("c0", "c", "whole")
    return (
        f"WITH {', '.join(steps)} SELECT doc_id, leaf, subroot, node AS root, "
        f"sha256(proof) AS proof_sha256, fold AS folded_root, fold = node AS verified FROM {last}"
    )
