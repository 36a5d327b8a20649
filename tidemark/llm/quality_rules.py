"""Quality rules with thresholds that follow each language and source.

One pass measures every document. The measures of each (language, source) go into quantile sketches
with logarithmic buckets (relative error ``ACCURACY``): a sketch is a table of bucket counts, so
sketches of parts merge by adding counts. Every group's sketch is blended with its language's, and
that one with the sketch of all, by weights n / (n + ``BLEND_DOCUMENTS``) for a sketch of n documents:
a small group leans on its language, a large one on itself, and the fences move smoothly in between.
From a blended sketch come the quartiles, and from those the fences

    upper = q75 + REACH * max(q75 - q25, least spread),   lower = q25 - REACH * (the same),

beyond which a measure is an outlier among its own kind. A document is kept if it passes the fixed
base rules (``base_failed``) and none of its measures lies beyond a fence of its group.

Documents that fail the base rules do not enter the sketches.

Defined cases: NULL or empty text has no words and fails; a NULL language or source is a group of its
own; repeated rows get equal results; an empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, matched, same, stored, table, text_hash

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
LEAST_WORDS = 20
MOST_REPEATED = 30
REPEAT_WINDOW = 8

ACCURACY = 0.01
REACH = 3.0
# Documents at which a group's own sketch and the wider one weigh the same.
BLEND_DOCUMENTS = 30
# Measure -> least spread, the tolerance of a group whose documents hardly differ.
MEASURES = {
    "word_length": 0.7,
    "symbol_rate": 0.05,
    "mark_rate": 0.05,
    "upper_rate": 0.08,
    "dup_line_rate": 0.10,
    "repeat_rate": 0.06,
}
TWO_SIDED = {"word_length"}

_GAMMA = (1 + ACCURACY) / (1 - ACCURACY)


def repeated_words(words: list[bytes], width: int = REPEAT_WINDOW) -> int:
    """Words inside windows of ``width`` words that occur twice or more, all occurrences counted."""
    count = len(words) - width + 1
    if count < 2:
        return 0
    ids: dict[bytes, int] = {}
    numbers = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.uint64, len(words))
    # Number the windows of 2, 4 and 8 words exactly, by ranking pairs of shorter ones.
    size = 1
    while size < width:
        step = min(size, width - size)
        pairs = numbers[:-step] * np.uint64(len(words) + 1) + numbers[step:]
        numbers = np.unique(pairs, return_inverse=True)[1].astype(np.uint64)
        size += step
    often = np.bincount(numbers.astype(np.int64)) > 1
    starts = often[numbers.astype(np.int64)]
    if not starts.any():
        return 0
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:count] += starts
    edges[width : width + count] -= starts
    return int((np.cumsum(edges)[:-1] > 0).sum())


def measure(text: str | None) -> tuple:
    text = text or ""
    data = text.encode()
    words = data.split()
    n = len(words)
    chars = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    dup_lines = len(lines) - len(set(lines))
    repeated = repeated_words(words)
    upper = int(((np.frombuffer(data, np.uint8) - 65) < 26).sum())
    rate = lambda part, whole: part / whole if whole else 0.0
    return (
        n, chars, symbols, dup_lines, repeated,
        rate(chars, n), rate(symbols, n), rate(text.count("!"), n), rate(upper, chars),
        rate(dup_lines, len(lines)), rate(repeated, n),
    )


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, lang, source``, the base counts, ``base_failed`` and the measures."""
    names = [*COUNTS, *MEASURES]

    def compute(columns: dict[str, list]) -> dict[str, list]:
        rows = list(zip(*map(measure, columns["text"]))) or [()] * len(names)
        return {k: columns[k] for k in ("doc_id", "text_hash", "lang", "source")} | dict(zip(names, rows))

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, text_hash bigint, lang string, source string"
    schema += "".join(f", {c} bigint" for c in COUNTS) + "".join(f", {m} double" for m in MEASURES)
    text = [F.col(c).cast("string").alias(c) for c in ("lang", "source", "text")]
    rows = map_rows(docs.select("doc_id", text_hash().alias("text_hash"), *text), compute, schema)
    few = F.col("n_words") < LEAST_WORDS
    return rows.withColumn(
        "base_failed", few | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    )


def _bucket(value: Column) -> Column:
    """Bucket of a value of 0 or more; NULL is the bucket of zero."""
    return F.when(value > 1e-9, F.ceil(F.log(value) / math.log(_GAMMA)).cast("int"))


def _middle(bucket: Column) -> Column:
    return F.coalesce(F.pow(F.lit(_GAMMA), bucket) * (2 / (1 + _GAMMA)), F.lit(0.0))


def sketches(rows: DataFrame) -> DataFrame:
    """``level, lang, source, measure, bucket, n``: level 0 by group, 1 by language, 2 of all."""
    each = F.explode(
        F.array(*[F.struct(F.lit(m).alias("measure"), _bucket(F.col(m)).alias("bucket")) for m in MEASURES])
    )
    counts = rows.select("lang", "source", each.alias("m")).groupBy("lang", "source", "m.measure", "m.bucket")
    groups = stored(counts.agg(F.count("*").alias("n")), "sketches")
    merged = groups.withColumn("level", F.lit(0))
    for level, gone in ((1, ["source"]), (2, ["lang", "source"])):
        upper = groups.withColumns({c: F.lit(None).cast("string") for c in gone})
        upper = upper.groupBy("lang", "source", "measure", "bucket").agg(F.sum("n").alias("n"))
        merged = merged.unionByName(upper.withColumn("level", F.lit(level)))
    return merged


def _cells(sketch: DataFrame) -> DataFrame:
    """``level, lang, source, measure, documents, cells``: the buckets of a sketch as one array."""
    cell = F.struct("bucket", F.col("n").cast("double").alias("n"))
    return sketch.groupBy("level", "lang", "source", "measure").agg(
        F.sum("n").cast("double").alias("documents"), F.collect_list(cell).alias("cells")
    )


def _times(cells: Column, factor: Column) -> Column:
    return F.transform(cells, lambda c: F.struct(c["bucket"].alias("bucket"), (c["n"] * factor).alias("n")))


def blended(sketch: DataFrame, groups: DataFrame, blend_documents: int = BLEND_DOCUMENTS) -> DataFrame:
    """``_cells`` of level 0 for each ``lang, source`` of ``groups``, blended with the wider sketches."""
    cells = stored(_cells(sketch), "cells")

    def level(number: int, name: str) -> DataFrame:
        own = cells.filter(F.col("level") == number)
        return own.select(
            F.col("lang").alias("_lang"), F.col("source").alias("_source"), F.col("measure").alias("_measure"),
            F.col("documents").alias(f"{name}_n"), F.col("cells").alias(name),
        )

    none = F.array().cast("array<struct<bucket: int, n: double>>")
    k = F.lit(float(blend_documents))
    every = level(2, "of_all").drop("_lang", "_source").withColumnRenamed("_measure", "measure")
    # The wider sketches weigh ``k`` documents in all: the language's n / (n + k) of them, the one of all the rest.
    langs = groups.select("lang").distinct().crossJoin(every)
    match = same(F.col("lang"), F.col("_lang")) & (F.col("measure") == F.col("_measure"))
    langs = langs.join(level(1, "by_lang").drop("_source"), match, "left").drop("_lang", "_measure")
    n = F.coalesce("by_lang_n", F.lit(0.0))
    of_lang = _times(F.coalesce("by_lang", none), k / (n + k))
    of_all = _times(F.col("of_all"), k * k / (n + k) / F.col("of_all_n"))
    langs = langs.select(F.col("lang").alias("prior_lang"), "measure", F.concat(of_lang, of_all).alias("prior"))
    langs = stored(langs, "prior-sketches")

    found = groups.join(langs, same(F.col("lang"), F.col("prior_lang"))).drop("prior_lang")
    match = match & same(F.col("source"), F.col("_source"))
    found = found.join(level(0, "own"), match, "left")
    return found.select(
        F.lit(0).alias("level"), "lang", "source", "measure",
        (F.coalesce("own_n", F.lit(0.0)) + k).alias("documents"),
        F.concat(F.coalesce("own", none), "prior").alias("cells"),
    )


def _fenced(cells: DataFrame) -> DataFrame:
    """``level, lang, source, documents`` and an array of ``measure, lower, upper``."""

    def quantile(q: float) -> Column:
        wanted = F.col("documents") * (q * (1 - 1e-12))

        def add(state: Column, cell: Column) -> Column:
            upto = state["upto"] + cell["n"]
            reached = F.when(upto >= wanted, _middle(cell["bucket"]))
            return F.struct(upto.alias("upto"), F.coalesce(state["value"], reached).alias("value"))

        start = F.struct(F.lit(0.0).alias("upto"), F.lit(None).cast("double").alias("value"))
        return F.aggregate(F.sort_array("cells"), start, add, lambda state: state["value"])

    found = cells.withColumns({"q25": quantile(0.25), "q75": quantile(0.75)})
    least = F.element_at(F.create_map(*[F.lit(x) for m in MEASURES.items() for x in m]), F.col("measure"))
    reach = REACH * F.greatest(F.col("q75") - F.col("q25"), least)
    lower = F.when(F.col("measure").isin(*TWO_SIDED), F.col("q25") - reach)
    return found.groupBy("level", "lang", "source").agg(
        F.max("documents").alias("documents"),
        F.collect_list(F.struct("measure", lower.alias("lower"), (F.col("q75") + reach).alias("upper"))).alias("fences"),
    )


def fences(sketch: DataFrame) -> DataFrame:
    """The fences of each sketch by itself."""
    return _fenced(_cells(sketch))


def judged(docs: DataFrame, blend_documents: int = BLEND_DOCUMENTS) -> DataFrame:
    """``measured`` rows with ``kept`` and ``outliers``, the measures beyond a fence."""
    rows = stored(measured(docs), "measures")
    groups = stored(rows.select("lang", "source").distinct(), "groups")
    limits = _fenced(blended(sketches(rows.filter("not base_failed")), groups, blend_documents))
    chosen = limits.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), "fences")
    chosen = stored(chosen, "chosen-fences")
    joined = rows.join(
        chosen, same(F.col("lang"), F.col("_lang")) & same(F.col("source"), F.col("_source")), "left"
    )
    values = F.create_map(*[x for m in MEASURES for x in (F.lit(m), F.col(m))])

    def beyond(fence: Column) -> Column:
        value = F.element_at(values, fence["measure"])
        return (value > fence["upper"]) | F.coalesce(value < fence["lower"], F.lit(False))

    outliers = F.transform(F.filter("fences", beyond), lambda fence: fence["measure"])
    joined = joined.withColumn("outliers", F.coalesce(outliers, F.array().cast("array<string>")))
    return joined.withColumn("kept", ~F.col("base_failed") & (F.size("outliers") == 0)).drop("_lang", "_source", "fences")


def passing(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep."""
    keys = ("doc_id", "lang", "source")
    found = judged(docs).filter("not kept").select("text_hash", *keys)
    return matched(docs, stored(found.distinct(), "rejected"), "left_anti", *keys)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judged(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *COUNTS, "base_failed", "kept", F.array_join("outliers", ",").alias("outliers"))
