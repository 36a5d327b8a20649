"""Mixing sources to target token amounts by entropy balancing, in DataFrame functions only.

Each source gets a target; each of its documents a rate (expected copies). Among all rates of at
most ``cap`` that meet the source's target, the ones closest to 1 in relative entropy are

    rate(document) = min(cap, exp(lambda * size / mean size of the source)),

with one multiplier per source. The multipliers solve a convex dual whose gradient is the source's
excess of tokens; Newton steps, kept inside a bracket, find all of them at once: each step is one
aggregation over (source, size) cells. A document's rate depends on its source and size alone, so
cells lose nothing, and there are at most as many per source as there are different sizes.

Rounding: going through a source's cells from the largest size down, each cell takes the whole
number of copies that brings the words so far closest to the words the rates ask for, so the error
never adds up and the small documents at the end even it out. Within a cell, copies are dealt out
in the order of a hash of the id, so reruns agree.

Defined cases: NULL text has size 0 and is never taken; a NULL source is a source of its own, last
in order; an empty table gives no rows; a source without words has target 0; repeated rows are
separate documents.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import same, stored, table, word_count

SHARE = 1.5
WEIGHTS = (5.0, 2.0, 1.0)
CAP = 2
TOLERANCE = 1e-10
# Documents of one cell that one task puts in order.
ORDERED_ROWS = 50_000
# Cells of a source rounded at a time; an appended array is copied, so they are kept short.
ROUNDED_CELLS = 256


def ranked(rows: DataFrame, by: str, name: str) -> DataFrame:
    """Numbers distinct values 0, 1, ... in order, NULL last, over range partitions."""
    order = [F.col(by).isNull(), F.col(by)]
    dealt = rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    dealt = stored(dealt, "ranged")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy("_part").agg(F.count("*").alias("_rows"))
    parts = parts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    numbered = dealt.withColumn(name, inside).join(parts.drop("_rows"), "_part")
    return numbered.withColumn(name, F.col(name) + F.col("_before")).drop("_part", "_before")


def targets(
    sources: DataFrame, share: float = SHARE, weights: Sequence[float] = WEIGHTS, cap: int = CAP
) -> DataFrame:
    """Adds ``target`` to ``source, source_size``: shares by weight, with the excess reshared."""
    pick = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.col("_rank") % len(weights) + 1).cast("int"),
    )
    rows = ranked(sources, "source", "_rank")
    rows = rows.withColumn("_weight", pick).withColumn("_most", F.col("source_size") * float(cap))
    rows = stored(rows, "weighted")
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    wanted, level, full = share * total, None, -1
    while True:
        above = F.lit(False) if level is None else F.col("_weight") * level > F.col("_most")
        count, fixed, open_weight = rows.agg(
            F.count_if(above), F.sum(F.when(above, F.col("_most"))), F.sum(F.when(~above, F.col("_weight")))
        ).first()
        if count == full or not open_weight:
            break
        full, level = count, (wanted - (fixed or 0.0)) / open_weight
    amount = F.least(F.col("_most"), F.col("_weight") * F.lit(float(level or 0.0)))
    if level is not None and not open_weight:
        amount = F.col("_most")
    return rows.select("source", "source_size", amount.alias("target"))


def _log_rate(cap: int) -> Column:
    return F.least(F.lit(math.log(cap)), F.col("lam") * F.col("x"))


def multipliers(cells: DataFrame, goals: DataFrame, cap: int = CAP, steps: int = 100) -> DataFrame:
    """``source, lam`` solving every source's dual; NULL ``lam``: all rates are ``cap``, or no words.

    The rate is monotone in ``lam``, so a bracket always holds the solution: a step that would leave
    it, or has no curvature, halves it instead.
    """
    facts = cells.groupBy("source").agg(
        (F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"), F.min("size").alias("least")
    )
    facts = facts.withColumnRenamed("source", "_s").join(goals, same(F.col("_s"), F.col("source")))
    ratio = F.col("target") / F.col("source_size")
    low = F.when(ratio < 1, F.log(ratio) * F.col("mean") / F.col("least")).otherwise(F.lit(0.0))
    high = F.when(ratio < 1, F.lit(0.0)).otherwise(F.lit(math.log(cap)) * F.col("mean") / F.col("least"))
    inside = (F.col("target") > 0) & (ratio < cap * (1 - 1e-12))
    state = facts.filter(inside).select(
        "source", "target", "mean", low.alias("low"), high.alias("high"), F.lit(0.0).alias("lam"), F.lit(math.inf).alias("off")
    )
    state = stored(state, "dual")
    cells = cells.withColumnRenamed("source", "_s")
    for _ in range(steps):
        joined = cells.join(state, same(F.col("_s"), F.col("source"))).withColumn(
            "x", F.col("size") / F.col("mean")
        )
        words = F.col("n") * F.col("size") * F.exp(_log_rate(cap))
        free = F.col("lam") * F.col("x") < math.log(cap)
        sums = joined.groupBy("source", "target", "mean", "low", "high", "lam").agg(
            (F.sum(words) - F.first("target")).alias("gradient"),
            F.coalesce(F.sum(F.when(free, words * F.col("x"))), F.lit(0.0)).alias("curvature"),
        )
        sums = sums.withColumn("low", F.when(F.col("gradient") < 0, F.col("lam")).otherwise(F.col("low")))
        sums = sums.withColumn("high", F.when(F.col("gradient") > 0, F.col("lam")).otherwise(F.col("high")))
        off = F.abs("gradient") / F.col("target")
        newton = F.col("lam") - F.try_divide(F.col("gradient"), F.col("curvature"))
        bounded = F.when((newton > F.col("low")) & (newton < F.col("high")), newton)
        step = F.coalesce(bounded, (F.col("low") + F.col("high")) / 2)
        state = stored(
            sums.select(
                "source", "target", "mean", "low", "high",
                F.when(off <= TOLERANCE, F.col("lam")).otherwise(step).alias("lam"), off.alias("off"),
            ),
            "dual",
        )
        worst = state.agg(F.max("off")).first()[0]
        if worst is None or worst <= TOLERANCE:
            break
    return state.select("source", "lam", "mean")


def _rounded(cells: DataFrame, cap: int) -> DataFrame:
    """Adds ``copies`` to ``source, size, n, rate``, one list of cells (different sizes) a source."""
    listed = cells.groupBy("source").agg(
        F.sort_array(F.collect_list(F.struct("size", "n", "rate")), asc=False).alias("cells")
    )

    def step(done: Column, cell: Column) -> Column:
        goal = done["goal"] + cell["size"] * cell["n"] * cell["rate"]
        ideal = F.floor((goal - done["taken"]) / cell["size"] + 0.5)
        copies = F.greatest(F.lit(0), F.least(cell["n"] * cap, ideal)).cast("bigint")
        return F.struct(
            goal.alias("goal"),
            (done["taken"] + copies * cell["size"]).alias("taken"),
            F.array_append(done["copies"], copies).alias("copies"),
        )

    none = F.array().cast("array<bigint>")

    def run(done: Column, chunk: Column) -> Column:
        start = F.struct(done["goal"].alias("goal"), done["taken"].alias("taken"), none.alias("copies"))
        # Bound to a lambda variable, the chunk is rounded once and not once a field.
        after = F.array(F.aggregate(chunk, start, step))
        lists = lambda s: F.array_append(done["copies"], s["copies"]).alias("copies")
        return F.get(F.transform(after, lambda s: F.struct(s["goal"].alias("goal"), s["taken"].alias("taken"), lists(s))), F.lit(0))

    last = F.floor((F.size("cells") - 1) / ROUNDED_CELLS).cast("int")
    chunks = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.slice("cells", i * ROUNDED_CELLS + 1, ROUNDED_CELLS)
    )
    start = F.struct(
        F.lit(0.0).alias("goal"),
        F.lit(0).cast("bigint").alias("taken"),
        F.array().cast("array<array<bigint>>").alias("copies"),
    )
    copies = F.flatten(F.aggregate(chunks, start, run, lambda done: done["copies"]))
    zipped = F.arrays_zip("cells", copies.alias("copies"))
    dealt = listed.select("source", F.explode(zipped).alias("c"))
    return dealt.select("source", "c.cells.size", "c.cells.n", "c.cells.rate", F.col("c.copies").alias("copies"))


def _sized(docs: DataFrame, ordered_rows: int) -> DataFrame:
    """``doc_id, source, size, _order, _own, _part`` for each row of ``docs``.

    ``_order`` is a hash of the id. Where more than ``ordered_rows`` rows agree in it and in source and
    size, as rows without an id do, ``_own`` repeats it and ``_part`` is the task that wrote the row:
    they are alike, so any order among them gives the same result, and each task's are ordered alone.
    """
    chance = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    sized = docs.select(
        "doc_id", F.col("source").cast("string"), word_count().alias("size"), chance.alias("_order"),
        F.spark_partition_id().alias("_part"),
    )
    sized = stored(sized, "sized")
    keys = ["source", "size", "_order"]
    many = sized.groupBy(*keys).agg(F.count("*").alias("rows")).filter(F.col("rows") > ordered_rows)
    many = stored(many.select(*[F.col(k).alias(f"_many_{k}") for k in keys]), "repeated-ids")
    met = [same(F.col(k), F.col(f"_many_{k}")) for k in keys]
    own = F.col("_many__order")
    return sized.join(many, met, "left").select(
        "doc_id", "source", "size", "_order", own.alias("_own"), F.when(own.isNotNull(), F.col("_part")).alias("_part")
    )


def mix(
    docs: DataFrame,
    share: float = SHARE,
    weights: Sequence[float] = WEIGHTS,
    cap: int = CAP,
    ordered_rows: int = ORDERED_ROWS,
) -> DataFrame:
    """``doc_id, source, size, source_size, target, rate, copies, taken`` for each row of ``docs``."""
    sized = _sized(docs, ordered_rows)
    cells = stored(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "cells")
    sources = cells.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    goals = stored(targets(sources, share, weights, cap), "targets")

    worded = cells.filter("size > 0")
    solved = multipliers(worded, goals, cap).withColumnsRenamed({"source": "_ls"})
    rated = worded.join(goals.withColumnRenamed("source", "_s"), same(F.col("source"), F.col("_s")))
    rated = rated.join(solved, same(F.col("source"), F.col("_ls")), "left").withColumn(
        "x", F.col("size") / F.col("mean")
    )
    whole = F.when(F.col("target") > 0, F.lit(float(cap))).otherwise(F.lit(0.0))
    rated = rated.withColumn("rate", F.coalesce(F.exp(_log_rate(cap)), whole))
    rounded = _rounded(rated.select("source", "size", "n", "rate"), cap)

    # Order inside a cell, in buckets of about ordered_rows documents, each shifted by the earlier.
    plan = cells.select(F.col("source").alias("_s"), F.col("size").alias("_size"), F.col("n").alias("_n"))
    plan = plan.join(
        rounded.withColumnsRenamed({"source": "_rs", "size": "_rsize"}).drop("n"),
        same(F.col("_s"), F.col("_rs")) & (F.col("_size") == F.col("_rsize")),
        "left",
    )
    plan = plan.join(goals, same(F.col("_s"), F.col("source"))).select(
        "_s", "_size", "_n", "source_size", "target",
        F.coalesce("rate", F.lit(0.0)).alias("rate"), F.coalesce("copies", F.lit(0)).alias("_copies"),
    )
    plan = stored(plan, "plan")
    dealt = sized.join(
        plan, same(F.col("source"), F.col("_s")) & (F.col("size") == F.col("_size"))
    )
    bucket = F.pmod("_order", F.ceil(F.col("_n") / ordered_rows))
    dealt = dealt.withColumn("_bucket", F.struct(bucket.alias("bucket"), "_own", "_part"))
    earlier = Window.partitionBy("_s", "_size").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = dealt.groupBy("_s", "_size", "_bucket").agg(F.count("*").alias("_rows"))
    shift = shift.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).filter("_before > 0")
    shift = shift.select(F.col("_s").alias("_bs"), F.col("_size").alias("_bsize"), F.col("_bucket").alias("_b"), "_before")
    inside = F.row_number().over(Window.partitionBy("_s", "_size", "_bucket").orderBy("_order", "doc_id"))
    placed = dealt.withColumn("_place", inside).join(
        shift,
        same(F.col("_s"), F.col("_bs")) & (F.col("_size") == F.col("_bsize")) & same(F.col("_bucket"), F.col("_b")),
        "left",
    )
    place = F.col("_place") + F.coalesce("_before", F.lit(0)) - 1
    extra = (place < F.col("_copies") % F.col("_n")).cast("bigint")
    copies = F.floor(F.col("_copies") / F.col("_n")) + extra
    return placed.withColumn("copies", copies).select(
        "doc_id", "source", "size", "source_size", "target", "rate", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies"
    )
