"""Near-duplicate documents by SimHash fingerprints of 64 bits.

A document's fingerprint sums up the hashes of its word shingles; a bit is set if it is set in more
than half of the hashes. Documents are *linked* if their fingerprints differ in at most ``max_bits``
bits, and a document's component is what it reaches over links.

Linking works on distinct fingerprints, so copies cost nothing. The 64 bits are cut into
``max_bits // 2 + 1`` segments: of two linked fingerprints, at least one segment differs in one bit at
most. Each fingerprint is indexed under every segment with one bit left out (64 signatures in all);
an equality join on signatures finds the candidates, and counting the differing bits verifies them.

A signature that more than ``pairs_within`` fingerprints share is not paired up. Its fingerprints go
to their surroundings instead: every value within half of ``max_bits`` of a fingerprint becomes a
meeting place, and whoever reaches one is linked to the least fingerprint there. This takes 65 rows
a fingerprint for ``max_bits`` 2 however many share a signature, every such link is a true one, and
any two linked fingerprints share a meeting place, so components are the same as with all pairs.

Defined cases: NULL or empty text (and text of blanks) has fingerprint zero and is linked like any
other; fewer words than a shingle give one shingle of all words; a component of documents without
ids has a NULL component id; repeated rows are copies of each other.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, matched, same, stored, table, text_hash, unused
from tidemark.llm.components import connected_components

SHINGLE = 3
MAX_BITS = 2
PAIRS_WITHIN = 16

_hash = partial(xxhash.xxh64_intdigest, seed=42)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit number."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
    count = max(1, len(words) - shingle + 1)
    hashes = np.fromiter(map(_hash, shingles), dtype="<u8", count=count)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    majority = 2 * bits.sum(axis=0, dtype=np.int64) > count
    return int(np.packbits(majority, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, text_hash, fp`` for each row of ``docs``."""

    def compute(columns: dict[str, list]) -> dict[str, list]:
        prints = [fingerprint(text, shingle) for text in columns["text"]]
        return {"doc_id": columns["doc_id"], "text_hash": columns["text_hash"], "fp": prints}

    kind = dict(docs.dtypes)["doc_id"]
    source = docs.select("doc_id", text_hash().alias("text_hash"), F.col("text").cast("string"))
    return map_rows(source, compute, f"doc_id {kind}, text_hash bigint, fp bigint")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _segments(max_bits: int) -> list[range]:
    count = max_bits // 2 + 1
    ends = [64 * i // count for i in range(count + 1)]
    return [range(a, b) for a, b in zip(ends, ends[1:])]


def _signatures(prints: DataFrame, max_bits: int) -> DataFrame:
    """Rows ``sig, bit, fp``: one for each bit left out of its segment."""
    masks = [
        F.lit(_signed(sum(1 << b for b in bits if b != left))) for bits in _segments(max_bits) for left in bits
    ]
    spread = prints.select("fp", F.posexplode(F.array(*masks)).alias("bit", "mask"))
    sig = F.xxhash64("bit", F.col("fp").bitwiseAND(F.col("mask")))
    return spread.select(sig.alias("sig"), "bit", "fp")


def _distance(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _meeting_places(prints: DataFrame, max_bits: int) -> DataFrame:
    near, far = max_bits // 2, max_bits - max_bits // 2
    rows = [
        F.struct(
            F.lit(_signed(sum(1 << b for b in bits))).alias("flip"), F.lit(n <= near).alias("near")
        )
        for n in range(far + 1)
        for bits in combinations(range(64), n)
    ]
    reached = prints.select("fp", F.explode(F.array(*rows)).alias("f")).select(
        F.col("fp").bitwiseXOR(F.col("f.flip")).alias("place"), F.col("f.near").alias("near"), "fp"
    )
    hubs = reached.groupBy("place").agg(
        F.min(F.when(F.col("near"), F.col("fp"))).alias("hub"), F.count("*").alias("n")
    )
    hubs = hubs.filter("n > 1 and hub is not null").select("place", "hub")
    met = reached.join(hubs, "place").filter("fp <> hub")
    return met.select(F.col("hub").alias("u"), F.col("fp").alias("v"))


def links(
    prints: DataFrame, max_bits: int = MAX_BITS, pairs_within: int = PAIRS_WITHIN
) -> DataFrame:
    """Edges ``u, v`` between distinct fingerprints ``fp``, each true, with all components whole."""
    if not 0 <= max_bits <= 4:
        raise ValueError("max_bits must be 0 to 4")
    signatures = _signatures(prints, max_bits)
    shared = signatures.groupBy("sig").agg(F.count("*").alias("n")).filter("n > 1")
    # Both sides grow with the corpus, so the join is a sort-merge join at every size.
    hits = stored(signatures.join(shared.hint("merge"), "sig"), "signature-hits")

    segments = _segments(max_bits)
    whole = F.array(*[F.lit(_signed(sum(1 << b for b in bits))) for bits in segments for _ in bits])
    first = F.array(*[F.lit(b == bits[0]) for bits in segments for b in bits])
    few = hits.filter(F.col("n") <= pairs_within)
    few = few.withColumns({"segment": F.get(whole, "bit"), "first": F.get(first, "bit")})
    left = few.withColumnRenamed("fp", "u")
    right = few.select("sig", F.col("fp").alias("v"))
    # A pair that agrees in the whole segment meets at each of its bits; it counts at the first.
    once = F.col("first") | (
        F.col("u").bitwiseXOR(F.col("v")).bitwiseAND(F.col("segment")) != 0
    )
    close = _distance("u", "v") <= max_bits
    pairs = left.join(right, "sig").filter((F.col("u") < F.col("v")) & once & close).select("u", "v")

    crowded = hits.filter(F.col("n") > pairs_within).select("fp").distinct()
    met = _meeting_places(crowded, max_bits).filter(_distance("u", "v") <= max_bits)
    return pairs.unionByName(met).distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """``doc_id, text_hash, fp, component, component_id`` for each row of ``docs``.

    ``component`` is the least fingerprint of the component, ``component_id`` its least document id.
    """
    rows = stored(fingerprints(docs, shingle), "fingerprints")
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    members = connected_components(links(prints.select("fp"), max_bits))
    members = members.withColumnsRenamed({"node": "fp"})
    rooted = prints.join(members, "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    least = rooted.groupBy("component").agg(F.min("least").alias("component_id"))
    by_print = stored(rooted.select("fp", "component").join(least, "component"), "by-print")
    # Many copies share a print; the join is dealt by print, and AQE splits a large one.
    return rows.join(by_print, "fp")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row for each component: the one of least id, then least text hash."""
    found = stored(near_duplicates(docs, shingle, max_bits), "near-duplicates")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    first = found.groupBy("component").agg(F.min(order).alias("first"))
    first = first.select(F.col("first.doc_id").alias("_first_id"), F.col("first.text_hash").alias("_first_hash"))
    # Id and text settle the component, so a large component is dealt out like any other rows.
    is_first = same(F.col("_id"), F.col("_first_id")) & (F.col("_hash") == F.col("_first_hash"))
    rows = found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    dropped = rows.join(first, is_first, "left_anti")
    dropped = stored(dropped.distinct(), "dropped")
    dropped = dropped.withColumnsRenamed({"_id": "doc_id", "_hash": "text_hash"})
    kept = matched(docs, dropped, "left_anti", "doc_id")
    twice = found.groupBy("doc_id", "text_hash").count().filter("count > 1").limit(1).count()
    if twice:  # rows equal in id and text: one of them stays
        hashed = unused(docs, "_hash")
        kept = kept.withColumn(hashed, text_hash()).dropDuplicates(["doc_id", hashed]).drop(hashed)
    return kept


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
